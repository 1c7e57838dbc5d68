"""Typed, filtered and deduplicated line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import parse_invoice_time, real_number, whole_number
from ledgerloom.operators import first_per_key, with_values


def _sales(raw: DataFrame) -> DataFrame:
    """Raw text rows to typed ones; rows without keys or a positive sale are dropped."""
    typed = with_values(raw, "InvoiceNo", "StockCode").select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.trim("Description").alias("description"),
        whole_number(F.col("Quantity")).alias("quantity"),
        parse_invoice_time(F.col("InvoiceDate")).alias("invoice_date"),
        real_number(F.col("UnitPrice")).alias("unit_price"),
        F.col("CustomerID").alias("customer_id"),
        F.trim("Country").alias("country"),
    )
    return typed.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def _with_total(sales: DataFrame) -> DataFrame:
    return sales.withColumn("total_price", F.col("quantity") * F.col("unit_price"))


def clean(raw: DataFrame) -> DataFrame:
    """Typed sales with their total."""
    return _with_total(_sales(raw))


def silver(raw: DataFrame) -> DataFrame:
    """One row per (invoice_no, stock_code): the earliest, ties broken by the other columns.

    Totals are computed for the rows that stay, so they take no part in the shuffle.
    """
    first = first_per_key(
        _sales(raw),
        ["invoice_no", "stock_code"],
        ["invoice_date", "quantity", "unit_price", "description", "customer_id", "country"],
    )
    return _with_total(first)
