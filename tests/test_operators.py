from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.operators import (
    absent_rows,
    calendar,
    date_spine,
    first_per_key,
    insert_if_absent,
    orphans,
    ranked,
    tile,
    to_date_by_month,
    with_row_ids,
)


def test_first_per_key_is_stable_under_shuffling(spark):
    data = [("a", 1, "x"), ("a", 1, "w"), ("a", 2, "v"), ("b", None, "z"), ("b", 3, "y")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, n int, t string").repartition(3)
        first = first_per_key(df, ["k"], ["n", "t"])
        assert rows(first) == [("a", 1, "w"), ("b", 3, "y")]
        assert rows(first_per_key(first, ["k"], ["n", "t"])) == rows(first)


def test_date_spine_leaves_out_the_end(spark):
    spine = date_spine(spark, "2010-12-01", "2011-12-10")
    assert spine.count() == 374
    assert spine.agg(F.max("date_day")).first()[0] == dt.date(2011, 12, 9)
    assert date_spine(spark, "2011-01-01", "2011-01-01").count() == 0


def test_calendar(spark):
    days = calendar(date_spine(spark, "2010-12-05", "2011-01-02"))
    found = {r.date_id: r for r in days.collect()}
    sunday, new_year = found[20101205], found[20110101]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sun", True)
    assert (new_year.week, new_year.year, new_year.quarter) == (52, 2011, 1)
    assert (new_year.month_name, new_year.day_of_week) == ("January", 6)
    assert not found[20101206].is_weekend


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23, 100])
def test_tile_equals_ntile(spark, n):
    df = spark.range(1, n + 1).withColumn("n", F.lit(n).cast("long"))
    both = df.select(
        tile(5, F.col("id"), F.col("n")).alias("t"),
        F.ntile(5).over(Window.orderBy("id")).alias("w"),
    )
    assert both.filter("t <> w").count() == 0


def test_ranked_splits_one_group_over_tasks(spark, scratch):
    """A group with most rows, ties broken by id, and a null group."""
    data = [(i, "big" if i % 3 else ("small" if i % 2 else None), i % 7) for i in range(2000)]
    df = spark.createDataFrame(data, "id int, g string, v int").repartition(5)
    got = ranked(df, ["v", "id"], scratch, within=["g"])
    w = Window.partitionBy("g")
    want = df.select(
        "*",
        F.row_number().over(w.orderBy("v", "id")).cast("long").alias("rank"),
        F.count("*").over(w).alias("group_rows"),
    )
    assert rows(got, *want.columns) == rows(want)


def test_row_ids_are_dense_and_continue(spark, scratch):
    df = spark.createDataFrame([(f"k{i:03}",) for i in range(300)], "k string").repartition(6)
    found = rows(with_row_ids(df, ["k"], scratch, after=10), "id", "k")
    assert found == [(11 + i, f"k{i:03}") for i in range(300)]


def history_by_join(lines):
    """The plain form: every line joined to every later month."""
    months = lines.select(F.col("order_month").alias("snapshot_month")).distinct()
    joined = lines.join(months, F.col("order_month") <= F.col("snapshot_month"))
    spend = F.sum(F.when(F.col("total_price") > 0, F.col("total_price").cast("decimal(18,4)")))
    return joined.groupBy("customer_id", "snapshot_month").agg(
        F.max("date_id"), F.countDistinct("invoice_no"), spend.cast("double")
    )


def test_history_equals_the_plain_join(spark):
    """Invoices over several months, unpaid lines, gaps, and a customer with a third of all."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        customer = "hot" if i % 3 == 0 else f"c{rng.randrange(12)}"
        month = rng.choice([1, 2, 3, 6, 7, 11])
        price = rng.choice([0.1, 0.2, 7.35, None, 0.0, -1.0])
        day = dt.date(2011, month, 1)
        invoice = f"{customer}-{rng.randrange(15)}"
        data.append((customer, invoice, 20110000 + month * 100 + rng.randrange(1, 28), price, day))
    schema = "customer_id string, invoice_no string, date_id int, total_price double, order_month date"
    lines = spark.createDataFrame(data, schema)
    assert rows(to_date_by_month(lines)) == rows(history_by_join(lines))


def test_history_without_spend_is_null(spark):
    lines = spark.createDataFrame(
        [("c", "i", 20110105, None, dt.date(2011, 1, 1)), ("d", "j", 20110205, 1.0, dt.date(2011, 2, 1))],
        "customer_id string, invoice_no string, date_id int, total_price double, order_month date",
    )
    assert rows(to_date_by_month(lines)) == [
        ("c", dt.date(2011, 1, 1), 20110105, 1, None),
        ("c", dt.date(2011, 2, 1), 20110105, 1, None),
        ("d", dt.date(2011, 2, 1), 20110205, 1, 1.0),
    ]


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    once = insert_if_absent(batch, target, ["k"], ["v"])
    assert rows(once) == [(1, "old"), (2, "a")]
    assert absent_rows(batch, once, ["k"], ["v"]).count() == 0


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",)], "id string")
    assert rows(orphans(child, "k", parent, "id")) == [("a", 2)]
