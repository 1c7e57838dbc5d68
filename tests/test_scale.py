"""What the plans must look like to hold at scale, and how they take hot keys."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as entry
from conftest import plan, rows
from ledgerloom.operators import absent_rows, first_per_key, to_date_by_month
from ledgerloom.plans import checks, gold, marts, normalised
from ledgerloom.plans.silver import silver
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.schemas import RAW
from ledgerloom.scratch import Scratch, shared_folder
from ledgerloom.session import shuffle_pieces
from ledgerloom.sources import default_countries
from ledgerloom.store import Store

FOLDER = "/root/testdata/sf0.001"
has_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@has_tables
@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Python|Pandas|ArrowEval", text)


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(first_per_key(df, ["k"], ["id"]))
    before, after = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert before < text.index("Exchange") < after


@pytest.fixture
def small_pieces(spark):
    """Treat anything over a few kilobytes as a hot partition, and never broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def hot_silver(spark, small_pieces, scratch):
    """One customer, one invoice and one product each hold a third of the lines."""
    n = F.col("id")

    def hot(prefix: str, shift: int):
        spread = F.concat(F.lit(prefix), (n % 97).cast("string"))
        return F.when((n + shift) % 3 == 0, prefix + "hot").otherwise(spread)

    df = spark.range(0, 30000, 1, 8).select(
        F.when((n % 3) == 0, "Ihot").otherwise(F.concat(F.lit("I"), n.cast("string"))).alias("invoice_no"),
        hot("P", 1).alias("stock_code"),
        F.md5(n.cast("string")).alias("description"),
        (n % 5 + 1).cast("int").alias("quantity"),
        F.timestamp_add("DAY", (n % 300).cast("int"), F.lit("2011-01-01").cast("timestamp_ntz")).alias("invoice_date"),
        F.lit(2.0).alias("unit_price"),
        hot("C", 2).alias("customer_id"),
        F.lit("Spain").alias("country"),
        ((n % 5 + 1) * 2.0).alias("total_price"),
    )
    return scratch.keep(df, "hot")


def is_split(df) -> bool:
    """Run the plan in full and look for a join that adaptive execution split."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in plan(df)


def test_hot_customers_and_products_are_split_in_the_invoice_mart(spark, hot_silver, scratch):
    fact = scratch.keep(gold.fact_sales(hot_silver), "fact")
    customers = scratch.keep(gold.dim_customers(hot_silver), "customers")
    products = scratch.keep(gold.dim_products(hot_silver), "products")
    countries = spark.createDataFrame([(1, "es", "Spain")], "id int, alpha2 string, en string")
    mart = marts.mart_invoices(fact, customers, products, gold.dim_date(spark), countries)
    assert is_split(mart)
    assert mart.count() == hot_silver.count()


def test_hot_invoices_are_split_in_order_items(spark, hot_silver, scratch):
    orders = scratch.keep(hot_silver.select("invoice_no").distinct(), "orders")
    products = scratch.keep(hot_silver.select("stock_code").distinct(), "products")
    items = normalised.order_items(hot_silver, orders, products)
    assert is_split(items)
    assert items.count() == hot_silver.count()


def test_hot_invoices_are_split_when_loading(spark, hot_silver, scratch):
    """Lines not stored yet, looked up and numbered as the store does it."""
    lines = hot_silver.withColumn("stock_code", F.col("description"))
    orders = scratch.keep(lines.select("invoice_no").distinct(), "orders")
    products = scratch.keep(lines.select("stock_code").distinct(), "products")
    stored = scratch.keep(lines.filter("description < '4'"), "stored")
    key = ["invoice_no", "stock_code"]
    new = absent_rows(lines, stored, key, ["quantity"])
    items = normalised.order_items(new, orders, products).repartitionByRange(*key)
    assert is_split(items)
    assert items.count() == lines.filter("description >= '4'").count()


def by_ntile(base):
    def bucket(measure):
        order = Window.partitionBy("snapshot_month").orderBy(
            F.col(measure).asc_nulls_last(), "customer_id"
        )
        return F.ntile(marts.BUCKETS).over(order)

    return base.select("*", *[bucket(m).alias(c) for c, m in marts.SCORED.items()])


def test_history_moves_each_line_once(spark, hot_silver):
    """Lines are not repeated, one row by invoice and one by month, before they move; and
    they combine before that."""
    lines = marts.order_months(gold.fact_sales(hot_silver), gold.dim_date(spark))
    text = plan(to_date_by_month(lines))
    assert "Expand" not in text
    # Partly summed per invoice and month, and again per month.
    assert text.count("partial_max(date_id") == 1 and text.count("partial_max(last_order") == 1


def test_no_month_is_sorted_in_one_task(spark, hot_silver, scratch):
    base = scratch.keep(marts.rfm_base(gold.fact_sales(hot_silver), gold.dim_date(spark)), "base")
    assert "Window" not in plan(marts.score(base, scratch))


def test_movement_shuffles_once(spark, hot_silver, scratch):
    snapshot = marts.mart_rfm_snapshot(gold.fact_sales(hot_silver), gold.dim_date(spark), scratch)
    stored = scratch.keep(snapshot, "snapshot")
    moved = marts.mart_rfm_movement(stored).sortWithinPartitions("customer_id", "snapshot_month")
    text = plan(moved)
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1


def test_scores_with_a_hot_customer(spark, hot_silver, scratch):
    fact = scratch.keep(gold.fact_sales(hot_silver), "fact")
    base = scratch.keep(marts.rfm_base(fact, gold.dim_date(spark)), "base")
    assert rows(marts.score(base, scratch), *base.columns, *marts.SCORED) == rows(by_ntile(base))


def test_stored_columns_and_filters_reach_the_scan(spark, hot_silver):
    text = plan(gold.dim_customers(hot_silver))
    assert "ReadSchema: struct<invoice_date:timestamp_ntz,customer_id:string,country:string>" in text
    assert "PushedFilters: [IsNotNull(customer_id)]" in text


def test_the_shipped_country_list_is_broadcast_without_a_shuffle(spark, scratch):
    lines = scratch.keep(spark.range(10).select(F.lit("France").alias("country")), "lines")
    text = plan(marts.with_country_code(lines, default_countries(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_scratch_goes_away(spark):
    with Scratch(spark) as scratch:
        scratch.keep(spark.range(3), "x")
        folder = scratch.root.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="yarn"))
    named = Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert shared_folder(named) == "hdfs:///shared"


def test_shuffle_pieces_follow_the_input():
    assert shuffle_pieces(1) == 200
    assert shuffle_pieces(2 * 1024**4) == 8192
    assert shuffle_pieces(100 * 1024**4) == 409_600


def test_only_keys_of_a_small_batch_leave_the_store(spark, scratch):
    """The store's keys meet the batch at the scan: no shuffle below that join."""
    stored = scratch.keep(spark.range(5000).select(F.col("id").alias("k")), "stored")
    batch = scratch.keep(spark.range(4990, 5010).select(F.col("id").alias("k")), "batch")
    new = absent_rows(batch, stored, ["k"])
    assert new.count() == 10
    below = plan(new)[plan(new).index("LeftAnti") :]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below
    stored_scan = below[: below.rindex("LeftSemi")]
    assert "hashpartitioning" not in stored_scan


def test_parents_meet_the_values_of_a_batch_at_their_scan(spark, scratch):
    """Keys of a large parent that no child row names reach no shuffle."""
    parent = scratch.keep(spark.range(5000).select(F.col("id").alias("k")), "parent")
    child = scratch.keep(spark.range(4990, 5010).select(F.col("id").alias("k")), "child")
    check = checks.stored_parent_check(child, "k", parent, "k", scratch.keep)
    report = checks.check_table("child", child, [check])
    assert rows(report, "violations") == [(10,)]
    text = plan(report)
    below = text[text.index("LeftAnti") :]
    semi = below.index("LeftSemi")
    assert "BroadcastHashJoin" in below[semi - 200 : semi]
    assert "Exchange hashpartitioning" not in below[semi : below.index("BroadcastExchange", semi)]


def test_a_load_broadcasts_its_foreign_keys(spark, four_lines, scratch, monkeypatch):
    store = Store(spark, scratch.path("store"))
    store.load(four_lines.filter("invoice_no = 'INV001'"))
    plans = []

    def seen(table, df, declared, real=checks.check_table):
        plans.extend(plan(c.parent.join(c.values, c.parent[c.parent_key] == c.values["value"],
                                        "left_semi"))
                     for c in declared if isinstance(c, checks.ParentCheck))
        return real(table, df, declared)

    monkeypatch.setattr(checks, "check_table", seen)
    store.load(four_lines)
    assert len(plans) == 3
    assert all("BroadcastHashJoin" in p and "hashpartitioning" not in p for p in plans)


def test_totals_take_no_part_in_silvers_shuffle(spark):
    text = plan(silver(spark.createDataFrame([], RAW)))
    assert text.rindex("total_price") < text.index("Exchange")


def test_stored_tables_are_packed_tightly(spark, four_lines, scratch):
    """Hashed keys and codes take half the bytes that the default compression leaves."""
    store = Store(spark, scratch.path("store"))
    store.load(four_lines)
    shop = Warehouse(scratch.keep(spark.createDataFrame([], RAW), "raw"), default_countries(spark))
    with shop:
        stored = [store.table("order_items"), shop.fact_sales, shop.mart_rfm_snapshot]
        names = [n for df in stored for n in df.inputFiles()]
        assert len(names) > 1 and all(n.endswith(".zstd.parquet") for n in names)


@has_tables
def test_raw_rows_are_joined_once_for_their_csv_copy(spark, monkeypatch):
    plans = []

    def seen(writer, path, *args, real=DataFrameWriter.csv, **options):
        plans.append(plan(writer._df))
        return real(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "csv", seen)
    copy = entry.Sample(spark, FOLDER)
    with copy.scratch:
        loaded = copy.csv_load
        assert loaded.rows.count() + loaded.rejects.count() == copy.raw.count()
    assert len(plans) == 3 and not any("Join" in p for p in plans)


def test_quiet_months_of_customers_are_not_stored_for_the_scores(spark, silver_rows, scratch, monkeypatch):
    """Scoring stores and counts a row per customer and active month, not one per month."""
    day = dt.datetime
    lines = silver_rows(
        *[
            dict(invoice_no=f"I{i}", customer_id=f"C{i:03}", invoice_date=day(2011, 1 + i % 10, 3),
                 total_price=float(i * i))
            for i in range(200)
        ]
    )
    fact, dates = scratch.keep(gold.fact_sales(lines), "fact"), gold.dim_date(spark)
    base = scratch.keep(marts.rfm_base(fact, dates), "base")
    kept = []

    def seen(self, df, name, real=Scratch.keep):
        out = real(self, df, name)
        kept.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", seen)
    snapshot = marts.mart_rfm_snapshot(fact, dates, scratch)
    assert rows(snapshot, *base.columns, *marts.SCORED) == rows(by_ntile(base))
    assert max(kept) < base.count() / 2
    late = marts.mart_rfm_snapshot(fact, dates, scratch, since="2011-06-01")
    assert rows(late) == rows(snapshot.filter("snapshot_month >= '2011-06-01'"))


def test_lines_do_not_move_to_their_order_or_product_when_loading(
    spark, four_lines, silver_rows, scratch, monkeypatch
):
    """Keys without a parent are few: they go to the lines. The same lines are loaded."""
    odd = silver_rows(
        dict(invoice_no=None, quantity=3),
        dict(stock_code=None, quantity=4),
        dict(invoice_no="INV003", stock_code="SKU009", quantity=5, customer_id=None),
        dict(invoice_no="INV002", stock_code="SKU009", customer_id="67890", quantity=None),
    )
    lines = scratch.keep(four_lines.unionByName(odd), "lines")
    customers = normalised.customers(lines)
    orders, products = normalised.orders(lines, customers), normalised.products(lines)
    want = rows(normalised.order_items(lines, orders, products))
    seen = []

    def made(*args, real=normalised.order_items):
        seen.append(real(*args))
        return seen[-1]

    monkeypatch.setattr(normalised, "order_items", made)
    store = Store(spark, scratch.path("store"))
    store.load(lines)
    stored = store.table("order_items").select(
        "invoice_no", "stock_code", "quantity", "unit_price", "total_price"
    )
    assert [r[:3] for r in rows(stored)] == [r[:3] for r in want]
    # One exchange of the lines, by their key; none by invoice or product alone.
    text = plan(seen[0])
    assert not re.search(r"hashpartitioning\((invoice_no|stock_code)#\d+, \d+\)", text)


def local_files(spark) -> int:
    """Shuffle files of this session; a local one keeps them in temporary folders."""
    folders = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return sum(
        f.startswith("shuffle_") for d in folders for _, _, names in os.walk(d) for f in names
    )


def test_stored_tables_leave_no_shuffle_files(spark, hot_silver, scratch):
    """They would stay until the driver collects garbage. A kept frame can still run again."""
    before = local_files(spark)
    counted = hot_silver.groupBy("stock_code").count()
    kept = scratch.keep(counted, "counted")
    assert local_files(spark) <= before
    assert rows(kept) == rows(counted)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_invoice_lines_move_with_little(spark, hot_silver, scratch, small_pieces):
    """Neither hexadecimal keys nor attributes of days move; odd keys come through."""
    silver = scratch.keep(hot_silver, "silver")
    fact = gold.fact_sales(silver)
    odd = F.when(F.col("invoice_no") == "INV1", "zz").when(F.col("invoice_no") == "INV2", "0A")
    fact = scratch.keep(fact.withColumn("sales_id", F.coalesce(odd, "sales_id")), "fact")
    dates = scratch.keep(gold.dim_date(spark), "dates")
    customers, products = gold.dim_customers(silver), gold.dim_products(silver)
    df = marts.mart_invoices(fact, customers, products, dates, default_countries(spark))
    assert rows(df, "sales_id") == rows(fact, "sales_id")
    text = plan(df)
    joins = re.findall(r"SortMergeJoin \[(\w+)#", text)
    assert joins == ["country", "date_id", "stock_code", "customer_id"]  # the last one first
    moved = re.search(r"SortMergeJoin \[stock_code#.*?Exchange[^\n]*\n[^\n]*Project \[(.*?)\]\n", text, re.S)
    assert "_bytes" in moved[1] and "sales_id" not in moved[1]


def test_hashed_keys_are_counted_by_their_bytes(spark):
    kind = "k string, n int"
    keys = ["0a", "0A", "0a", "a", "a", "0a0", "", "", None, None, "zz", "zz", "zz", "ff"]
    df = spark.createDataFrame([(k, 1) for k in keys], kind)
    for check, want in ((checks.unique("k"), 4), (checks.UniqueCheck("u", ("k",), False), 5)):
        assert checks.repeated_keys(df, check).count() == want
        assert checks.duplicates(df, ("k",), check.ignore_nulls).count() == want


@has_tables
def test_the_check_report_counts_table_by_table(spark):
    """Its rows are those of the report that counts all at once."""
    sample = entry.Sample(spark, FOLDER)
    report = sample.counted_report(sample.scratch)
    assert "Exchange" not in plan(report)
    assert rows(report) == rows(sample.check_report())
