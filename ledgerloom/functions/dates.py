"""Date parsing and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Single letters accept both '12/1/2010 8:26' and '01/01/2011 00:00'.
INVOICE_TIME_FORMAT = "M/d/yyyy H:mm"


def parse_invoice_time(text: Column) -> Column:
    """Zone-free timestamp; text in another format raises."""
    return F.to_timestamp_ntz(text, F.lit(INVOICE_TIME_FORMAT))


def date_key(date: Column) -> Column:
    """YYYYMMDD as INT, by arithmetic: no text is built per row."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")
