"""Invoice mart, monthly customer scores and their movement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import (
    customer_segment,
    hex_bytes,
    hex_text,
    month_of,
    segment_movement,
    segment_transition,
)
from ledgerloom.operators import (
    bucket_ends,
    each_month,
    months_of,
    place,
    spells,
    to_date_by_month,
    with_values,
)
from ledgerloom.scratch import Scratch, list_folder

BUCKETS = 5
# The snapshot is stored in one folder per month.
MONTH = "snapshot_month"

# Score column -> the measure it ranks.
SCORED = {
    "recency_score": "most_recent_order",
    "frequency_score": "number_of_orders",
    "monetary_score": "total_spent",
}


def with_country_code(df: DataFrame, countries: DataFrame) -> DataFrame:
    """Add the two-letter code of ``country``, null where it is not listed."""
    codes = countries.select(F.col("en").alias("country"), F.col("alpha2").alias("country_code"))
    return df.join(codes, "country", "left")


def mart_invoices(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    countries: DataFrame,
) -> DataFrame:
    """Sales lines with their product, customer and calendar attributes.

    Each side is joined as it is stored, so Spark knows its size when it plans: it
    broadcasts those under its threshold, and then lines do not move at all. It merges
    the others, where the adaptive skew join splits hot customers and products. What a line
    takes along is kept small: days and countries are joined last, and of a key in hexadecimal
    digits move the bytes.
    """
    lines = fact.drop("unit_price").withColumn("_bytes", hex_bytes(F.col("sales_id")))
    lines = lines.withColumn("_other", F.when(F.col("_bytes").isNull(), F.col("sales_id")))
    days = dates.select(
        "date_id", F.col("date").alias("invoice_date"), "month_name", "year", "quarter"
    )
    joined = (
        lines.drop("sales_id")
        .join(customers, "customer_id", "left")
        .join(products, "stock_code", "left")
        .join(days, "date_id", "left")
        .withColumn("sales_id", F.coalesce(hex_text(F.col("_bytes")), "_other"))
    )
    status = F.when(F.col("customer_id").isNull(), "Cancelled").otherwise("Shipped")
    return with_country_code(joined, countries).select(
        "sales_id",
        "invoice_no",
        status.alias("status"),
        "stock_code",
        "description",
        "unit_price",
        "quantity",
        "total_price",
        "customer_id",
        "country",
        "country_code",
        "invoice_date",
        "month_name",
        "year",
        "quarter",
    )


def order_months(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales of known customers with their calendar month; days off the calendar drop out."""
    months = dates.select("date_id", month_of(F.col("date")).alias("order_month"))
    return with_values(fact, "customer_id").join(months, "date_id")


def month_spine(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Months with at least one sale."""
    return (
        order_months(fact, dates).select(F.col("order_month").alias("snapshot_month")).distinct()
    )


def rfm_base(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Latest order day, order count and spend of each customer up to each month."""
    return to_date_by_month(order_months(fact, dates))


def score(base: DataFrame, scratch: Scratch) -> DataFrame:
    """NTILE scores of each month, from a stored table that is counted for the ends of the
    buckets and read again for the scores."""
    found = bucket_ends(
        base, "snapshot_month", "customer_id", list(SCORED.values()), BUCKETS, scratch
    )
    return score_by(base, found, scratch)


def score_by(base: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """One more than the bucket ends ``found`` before a row's place: no more than a join with
    the dozen ends of each month."""
    listed = found.groupBy("snapshot_month").agg(
        *[
            F.collect_list(F.when(F.col("measure") == i, F.col("place"))).alias(m)
            for i, m in enumerate(SCORED.values())
        ]
    )
    # One column an end: plain comparisons are compiled, functions over arrays are not.
    ends = listed.select(
        "snapshot_month",
        *[F.get(m, F.lit(b)).alias(f"{m}_end{b}") for m in SCORED.values() for b in range(BUCKETS - 1)],
    )
    # Written, so that its real size decides whether the join below broadcasts it.
    ends = scratch.keep(ends, "bucket_ends")

    def bucket(measure: str) -> Column:
        here = place(F.col(measure).cast("double"), F.col("customer_id"))
        passed = [
            F.when(F.col(f"{measure}_end{b}") < here, 1).otherwise(0) for b in range(BUCKETS - 1)
        ]
        return reduce(Column.__add__, passed) + 1

    return base.join(ends, "snapshot_month", "left").select(
        *base.columns, *[bucket(m).alias(name) for name, m in SCORED.items()]
    )


def label_scores(scored: DataFrame) -> DataFrame:
    recency, frequency, monetary = (F.col(c) for c in SCORED)
    return scored.select(
        "customer_id",
        "snapshot_month",
        "most_recent_order",
        "number_of_orders",
        "total_spent",
        *SCORED,
        (recency + frequency + monetary).alias("rfm_total_score"),
        customer_segment(recency, frequency, monetary).alias("customer_segment"),
    )


def mart_rfm_snapshot(
    fact: DataFrame, dates: DataFrame, scratch: Scratch, since: str | None = None
) -> DataFrame:
    """Scores 1-5 and a segment per customer and month; ties go by customer_id.

    With ``since`` (a first of a month) only from that month on: a month is scored by itself.
    """
    # Stored as spells: months without a sale of a customer are counted, and scored, from those.
    held = scratch.keep(spells(order_months(fact, dates)), "rfm_spells")
    months = months_of(held)
    if since is not None:
        first = F.lit(since).cast("date")
        months = months_of(held.filter(F.col("order_month") >= first))
        held = held.filter(F.col("next_month").isNull() | (F.col("next_month") > first))
    found = bucket_ends(
        held,
        "order_month",
        "customer_id",
        list(SCORED.values()),
        BUCKETS,
        scratch,
        until="next_month",
        groups=months,
    ).withColumnRenamed("order_month", MONTH)
    return label_scores(score_by(each_month(held, months), found, scratch))


def by_folder(df: DataFrame, column: str) -> DataFrame:
    """Rows of a folder in as few tasks as their size allows: large ones are split, small
    ones share a task."""
    return df.hint("rebalance", column)


def latest_folder(spark: SparkSession, path: str) -> str | None:
    """The largest value among folders named ``column=value``."""
    names = [name.split("=", 1) for name, _ in list_folder(spark, path) if "=" in name]
    return max((value for _, value in names if not value.startswith("__HIVE")), default=None)


def refresh_snapshot(
    path: str, fact: DataFrame, dates: DataFrame, since: str, scratch: Scratch
) -> None:
    """Score the months from ``since`` on again and put them in place of those at ``path``.

    For a snapshot that is kept in one place, by month: new sales change no earlier month. Other
    months' folders are not touched.
    """
    df = mart_rfm_snapshot(fact, dates, scratch, since)
    writer = by_folder(df, MONTH).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def mart_rfm_movement(snapshot: DataFrame) -> DataFrame:
    """Each customer's month against the month before.

    One range shuffle by customer serves the comparison and the stored order; a customer
    has one row per month at most.
    """
    history = Window.partitionBy("customer_id").orderBy("snapshot_month")
    earlier = (
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_total_score",
        "customer_segment",
        "total_spent",
    )
    paired = snapshot.repartitionByRange("customer_id").select(
        "*", *[F.lag(c).over(history).alias(f"prev_{c}") for c in earlier]
    )

    def change(column: str):
        return F.col(column) - F.col(f"prev_{column}")

    segment, previous = F.col("customer_segment"), F.col("prev_customer_segment")
    return paired.select(
        "customer_id",
        "snapshot_month",
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_total_score",
        "customer_segment",
        "prev_recency_score",
        "prev_frequency_score",
        "prev_monetary_score",
        "prev_rfm_total_score",
        "prev_customer_segment",
        change("recency_score").alias("recency_score_change"),
        change("frequency_score").alias("frequency_score_change"),
        change("monetary_score").alias("monetary_score_change"),
        change("rfm_total_score").alias("total_score_change"),
        change("total_spent").alias("mom_spend_change"),
        segment_movement(
            segment, previous, F.col("rfm_total_score"), F.col("prev_rfm_total_score")
        ).alias("segment_movement"),
        segment_transition(segment, previous).alias("segment_transition"),
    )
