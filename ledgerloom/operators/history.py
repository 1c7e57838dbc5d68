"""Totals to date per customer and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import exact_part, other_part, total
from ledgerloom.operators.first import with_values
from ledgerloom.operators.quantiles import within


def spells(lines: DataFrame) -> DataFrame:
    """Each customer's history from one active month up to the next, from ``lines`` with an
    ``order_month``: what holds from ``order_month`` until before ``next_month`` (null: for good).

    Lines shrink to one row per customer and active month, and running windows go over those.

    Distinct orders to date become a sum by counting each invoice in its first month
    only. Lines combine per customer, invoice and month on the map side, each once; what is
    left of an invoice, mostly one row, meets to find that month, and shrinks to
    customer-months. No step gathers raw lines by customer alone.
    """
    lines = with_values(lines, "customer_id", "order_month")

    spent = F.when(F.col("total_price") > 0, F.col("total_price"))
    per_invoice = lines.groupBy("customer_id", "invoice_no", "order_month").agg(
        F.max("date_id").alias("last_order"),
        F.sum(exact_part(spent)).alias("spend"),
        F.sum(other_part(spent)).alias("other_spend"),
    )
    invoice = Window.partitionBy("customer_id", "invoice_no")
    is_first = F.col("order_month") == F.min("order_month").over(invoice)
    per_month = (
        per_invoice.withColumn("is_first", is_first)
        .groupBy("customer_id", "order_month")
        .agg(
            F.max("last_order").alias("last_order"),
            F.count(F.when(F.col("is_first"), F.col("invoice_no"))).alias("new_orders"),
            F.sum("spend").alias("spend"),
            F.sum("other_spend").alias("other_spend"),
        )
    )

    by_customer = Window.partitionBy("customer_id").orderBy("order_month")
    so_far = by_customer.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_month.select(
        "customer_id",
        "order_month",
        F.lead("order_month").over(by_customer).alias("next_month"),
        F.max("last_order").over(so_far).alias("most_recent_order"),
        F.sum("new_orders").over(so_far).alias("number_of_orders"),
        total(F.sum("spend").over(so_far), F.sum("other_spend").over(so_far)).alias("total_spent"),
    )


def months_of(lines: DataFrame) -> Column:
    """The sorted list of order months: one entry per calendar month that has any line."""
    return lines.agg(F.sort_array(F.collect_set("order_month"))).scalar()


def each_month(spells: DataFrame, months: Column) -> DataFrame:
    """A row for each of the ``months`` that a spell covers."""
    covered = within("months", F.col("order_month"), F.col("next_month"))
    return spells.withColumn("months", months).select(
        "customer_id",
        F.explode(covered).alias("snapshot_month"),
        "most_recent_order",
        "number_of_orders",
        "total_spent",
    )


def to_date_by_month(lines: DataFrame) -> DataFrame:
    """Each customer's history up to each month, from ``lines`` with an ``order_month``.

    The plain form joins every line to every later month. Here each spell is repeated for
    the months until the customer's next active one.
    """
    return each_month(spells(lines), months_of(with_values(lines, "customer_id", "order_month")))
