"""Star schema: customer, product and date dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import date_key, is_sellable, normal_code, surrogate_key
from ledgerloom.functions.money import money_sum
from ledgerloom.operators import calendar, date_spine, first_per_key, with_values

# The calendar of the original data set, end excluded.
CALENDAR_START, CALENDAR_END = "2010-12-01", "2011-12-10"


def dim_customers(silver: DataFrame) -> DataFrame:
    """Each customer with the country first seen."""
    seen = with_values(silver, "customer_id").select(
        "customer_id", "country", "invoice_date"
    )
    return first_per_key(seen, ["customer_id"], ["invoice_date", "country"]).drop("invoice_date")


def dim_products(silver: DataFrame) -> DataFrame:
    """Each product, by normalised code, with the description and price first seen."""
    seen = silver.filter(is_sellable(F.col("stock_code"))).select(
        normal_code(F.col("stock_code")).alias("stock_code"),
        "description",
        "unit_price",
        "invoice_date",
    )
    order = ["invoice_date", "description", "unit_price"]
    return first_per_key(seen, ["stock_code"], order).drop("invoice_date")


def dim_date(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    return calendar(date_spine(spark, start, end))


def calendar_sales(dates: DataFrame, fact: DataFrame) -> DataFrame:
    """Every calendar day with its attributes, sales lines and revenue."""
    by_day = fact.groupBy("date_id").agg(
        F.count("*").alias("lines"), money_sum(F.col("total_price")).alias("revenue")
    )
    return dates.join(by_day, "date_id", "left").select(
        *dates.columns, F.coalesce("lines", F.lit(0)).alias("lines"), "revenue"
    )


def fact_sales(silver: DataFrame) -> DataFrame:
    """Sellable lines of known customers; a projection of silver, with no shuffle.

    The key hashes the code as written, while the column shows it normalised.
    """
    kept = silver.filter(is_sellable(F.col("stock_code")) & F.col("customer_id").isNotNull())
    return kept.select(
        surrogate_key("invoice_no", "stock_code").alias("sales_id"),
        "invoice_no",
        normal_code(F.col("stock_code")).alias("stock_code"),
        "customer_id",
        date_key(F.col("invoice_date")).alias("date_id"),
        "quantity",
        "unit_price",
        "total_price",
    )
