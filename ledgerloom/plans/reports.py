"""Dashboard measures over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import exact_part, money_sum, other_part, total


def _revenue() -> Column:
    return money_sum(F.col("total_price")).alias("revenue")


def headline_totals(invoices: DataFrame) -> DataFrame:
    """Revenue, orders, customers and average order value.

    Lines combine per (invoice, customer) first: two distinct counts at once double the
    rows they read.
    """
    amount = F.col("total_price")
    per_invoice = invoices.groupBy("invoice_no", "customer_id").agg(
        F.sum(exact_part(amount)).alias("spend"), F.sum(other_part(amount)).alias("other_spend")
    )
    totals = per_invoice.agg(
        total(F.sum("spend"), F.sum("other_spend")).alias("revenue"),
        F.countDistinct("invoice_no").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
    )
    return totals.withColumn("average_order_value", F.col("revenue") / F.col("orders"))


def revenue_by_month(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("year", "month_name").agg(_revenue())


def top_products(invoices: DataFrame, k: int = 10) -> DataFrame:
    totals = invoices.groupBy("stock_code", "description").agg(_revenue())
    return totals.orderBy(F.desc("revenue"), F.asc_nulls_last("stock_code")).limit(k)


def top_countries(invoices: DataFrame, k: int = 10) -> DataFrame:
    totals = invoices.groupBy("country").agg(_revenue())
    return totals.orderBy(F.desc("revenue"), F.asc_nulls_last("country")).limit(k)


def customers_by_country(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("country").agg(F.countDistinct("customer_id").alias("customers"))


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def new_and_returning(movement: DataFrame) -> DataFrame:
    """Customers first seen in each month, and those known before it."""
    is_new = F.col("segment_movement") == "New"
    return movement.groupBy("snapshot_month").agg(
        _count_where(is_new).alias("new_customers"),
        _count_where(~is_new).alias("returning_customers"),
    )


def segment_share(snapshot: DataFrame) -> DataFrame:
    """Percent of each month's customers in each segment."""
    sizes = snapshot.groupBy("snapshot_month", "customer_segment").agg(
        F.count("*").alias("customers")
    )
    month = F.sum("customers").over(Window.partitionBy("snapshot_month"))
    return sizes.withColumn("share_pct", F.col("customers") * F.lit(100.0) / month)


def in_month(snapshot: DataFrame, month: str | None = None) -> DataFrame:
    """The rows of one month; the latest by default, which takes a scan to find.

    A snapshot stored by month names its latest one (``Warehouse.latest_month``); given that,
    only the month's own files are read.
    """
    chosen = (
        F.lit(month).cast("date") if month else snapshot.agg(F.max("snapshot_month")).scalar()
    )
    return snapshot.filter(F.col("snapshot_month") == chosen)


def segment_sizes(snapshot: DataFrame, month: str | None = None) -> DataFrame:
    return (
        in_month(snapshot, month)
        .groupBy("customer_segment")
        .agg(F.count("*").alias("customers"), F.avg("rfm_total_score").alias("average_score"))
    )


def score_distribution(snapshot: DataFrame, month: str | None = None) -> DataFrame:
    return (
        in_month(snapshot, month)
        .groupBy("rfm_total_score")
        .agg(F.count("*").alias("customers"))
    )


def score_headline(snapshot: DataFrame, month: str | None = None) -> DataFrame:
    """Customers of one month and their average total score."""
    return (
        in_month(snapshot, month)
        .groupBy("snapshot_month")
        .agg(F.count("*").alias("customers"), F.avg("rfm_total_score").alias("average_score"))
    )


def average_score_by_segment(snapshot: DataFrame) -> DataFrame:
    """Over all months."""
    return snapshot.groupBy("customer_segment").agg(
        F.avg("rfm_total_score").alias("average_score")
    )


def movement_totals(movement: DataFrame) -> DataFrame:
    return movement.groupBy("segment_movement").agg(F.count("*").alias("customer_months"))


def transitions(movement: DataFrame, k: int | None = None) -> DataFrame:
    """How often each transition occurs; the ``k`` most common ones if given."""
    counted = movement.groupBy("segment_transition").agg(F.count("*").alias("customer_months"))
    if k is None:
        return counted
    return counted.orderBy(F.desc("customer_months"), "segment_transition").limit(k)


def movement_by_month(movement: DataFrame) -> DataFrame:
    kind = F.col("segment_movement")
    return movement.groupBy("snapshot_month").agg(
        _count_where(kind == "Upgraded").alias("upgraded"),
        _count_where(kind == "Downgraded").alias("downgraded"),
    )
