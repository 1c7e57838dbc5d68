"""Day spine and calendar attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import date_key


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` up to but excluding ``end``."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1)
    days = F.when(first <= last, F.sequence(first, last))
    return spark.range(0, 1, 1, 1).select(F.explode(days).alias("date_day"))


def calendar(spine: DataFrame) -> DataFrame:
    """Calendar attributes of each day; weeks are ISO weeks, Sunday is day 0."""
    day = F.col("date_day")
    weekday = F.dayofweek(day) - 1
    return spine.select(
        day.alias("date"),
        date_key(day).alias("date_id"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        weekday.alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )
