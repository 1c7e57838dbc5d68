from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.plans import checks, gold, marts
from ledgerloom.plans.warehouse import LAYERS, Warehouse
from ledgerloom.plans.silver import silver
from ledgerloom.schemas import STORE
from ledgerloom.sources import default_countries


def test_number_of_declared_checks(spark):
    declared = [
        checks.raw_checks(), checks.silver_checks(), checks.dim_customers_checks(),
        checks.dim_products_checks(), checks.dim_date_checks(), checks.fact_sales_checks(),
        checks.mart_invoices_checks(), checks.mart_rfm_snapshot_checks(),
        checks.mart_rfm_movement_checks(),
    ]
    names = [c.name for group in declared for c in group]
    found = {n: names.count(n) for n in set(names)}
    assert found == {
        "not_null": 49, "unique": 6, "unique_combination": 4, "accepted_values": 4,
        "between": 15, "column_exists": 2, "column_type": 2, "length_equals": 2,
        "matches_regex": 1,
    }


def test_each_check_counts_its_violations(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 9), ("bb", None, 5), (None, None, None), (None, None, 2)],
        "k string, v string, n int",
    )
    declared = [
        checks.not_null("k"),
        checks.unique("k"),
        checks.unique_combination("k", "v"),
        checks.accepted_values("v", ("y",)),
        checks.between("n", 1, 5),
        checks.length_equals("k", 1),
        checks.max_length("k", 1),
        checks.matches_regex("k", "^a$"),
        checks.column_exists("k"),
        checks.column_exists("gone"),
        checks.column_type("n", "int"),
        checks.column_type("n", "string"),
        checks.not_null("gone"),
        checks.ParentCheck("k", spark.createDataFrame([("a",)], "id string"), "id"),
    ]
    report = checks.check_table("t", df, declared)
    found = {(r.check_name, r.column_name): (r.violations, r.passed) for r in report.collect()}
    assert report.count() == len(declared)
    assert found[("not_null", "k")] == (2, False)
    assert found[("unique", "k")] == (1, False)  # nulls do not count as repeats
    assert found[("unique_combination", "k, v")] == (2, False)  # here they do
    assert found[("accepted_values", "v")] == (2, False)
    assert found[("between", "n")] == (1, False)
    assert found[("length_equals", "k")] == (1, False)
    assert found[("max_length", "k")] == (1, False)
    assert found[("matches_regex", "k")] == (1, False)
    assert found[("column_exists", "k")] == (0, True)
    assert found[("column_exists", "gone")] == (1, False)
    assert found[("not_null", "gone")] == (1, False)
    assert found[("foreign_key", "k")] == (1, False)
    assert sorted(
        r.violations for r in report.collect() if r.check_name == "column_type"
    ) == [0, 1]
    assert rows(checks.violating_rows(df, checks.between("n", 1, 5))) == [("a", "x", 9)]


def test_require_names_the_failures(spark):
    df = spark.createDataFrame([(None,)], "k string")
    with pytest.raises(checks.ChecksFailed, match="t.k not_null: 1"):
        checks.require(checks.check_table("t", df, [checks.not_null("k")]))
    checks.require(checks.check_table("t", df, [checks.unique("k")]))


def test_store_constraints(spark):
    """Five key constraints, eight lengths, three foreign keys."""
    parents = {name: spark.createDataFrame([], t.schema) for name, t in STORE.items()}
    names = [c.name for t in STORE.values() for c in checks.stored_checks(t, parents)]
    assert names.count("unique_combination") == 5
    assert names.count("max_length") == 8
    assert names.count("foreign_key") == 3


def test_codes_that_differ_in_case_fail_the_combination_check(spark, raw):
    lines = silver(raw({"StockCode": "85123a"}, {"StockCode": "85123A"}))
    mart = marts.mart_invoices(
        gold.fact_sales(lines), gold.dim_customers(lines), gold.dim_products(lines),
        gold.dim_date(spark), default_countries(spark),
    )
    repeated = checks.duplicates(mart, ("invoice_no", "stock_code"))
    assert rows(repeated) == [("INV1", "85123A", 2)]


def test_clean_data_passes_every_check(spark, raw):
    lines = [
        {"InvoiceNo": f"I{m}{c}", "CustomerID": f"C{c}", "InvoiceDate": f"{m}/{c + 1}/2011 8:00",
         "StockCode": f"SKU{c}", "UnitPrice": str(c + 1.5)}
        for c in range(7) for m in range(1, 5)
    ]
    warehouse = Warehouse(raw(*lines), default_countries(spark))
    report = warehouse.check_report()
    assert report.count() == 85
    assert rows(report.filter(~F.col("passed"))) == []
    checks.require(report)


def test_a_failed_layer_stops_what_follows(spark, raw, monkeypatch):
    warehouse = Warehouse(raw({"CustomerID": "C1"}, {"InvoiceNo": "I2"}), default_countries(spark))
    failing = checks.dim_customers_checks() + [checks.accepted_values("country", ("Nowhere",))]
    monkeypatch.setattr(checks, "dim_customers_checks", lambda: failing)
    with pytest.raises(checks.ChecksFailed, match="dim_customers.country accepted_values"):
        warehouse.build()
    assert "fact_sales" in vars(warehouse) and "mart_invoices" not in vars(warehouse)
    warehouse.build(tolerated=[("dim_customers", "accepted_values")])
    assert "mart_rfm_movement" in vars(warehouse)


def test_tables_are_reachable_by_name(spark, raw, scratch):
    warehouse = Warehouse(raw({}), default_countries(spark), root=scratch.path("tables"))
    warehouse.create_views()
    warehouse.create_tables()
    for layer, names in LAYERS.items():
        for name in names:
            assert spark.table(name).count() == spark.table(f"{layer}.{name}").count() > 0
    month = spark.sql("SELECT snapshot_month FROM marts.mart_rfm_snapshot").first()[0]
    assert month == dt.date(2011, 1, 1)


def test_rebuilding_replaces_tables(spark, raw, scratch):
    root = scratch.path("tables")
    countries = default_countries(spark)
    first = Warehouse(raw({}, {"StockCode": "B2"}), countries, root)
    first.create_tables()
    assert spark.table("gold.fact_sales").count() == 2
    second = Warehouse(raw({}), countries, root)
    assert second.fact_sales.count() == 1
    # Readers see the old tables, whole, until the catalog is switched.
    assert first.fact_sales.count() == spark.table("gold.fact_sales").count() == 2
    second.create_tables()
    assert spark.table("gold.fact_sales").count() == 1


def test_a_managed_table_is_not_replaced(spark, raw, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    spark.sql("DROP TABLE IF EXISTS silver.silver_ecommerce")
    spark.range(3).write.saveAsTable("silver.silver_ecommerce")
    try:
        with pytest.raises(ValueError, match="managed"):
            Warehouse(raw({}), default_countries(spark), scratch.path("t")).create_tables()
        assert spark.table("silver.silver_ecommerce").count() == 3
    finally:
        spark.sql("DROP TABLE silver.silver_ecommerce")


def test_temporary_tables_are_removed(spark, raw):
    with Warehouse(raw({}), default_countries(spark)) as warehouse:
        assert warehouse.fact_sales.count() == 1
    assert not os.path.exists(warehouse.root)


def test_movement_is_stored_in_customer_order(spark, raw, scratch):
    lines = [
        {"InvoiceNo": f"I{m}{c}", "CustomerID": f"C{c:02}", "InvoiceDate": f"{m}/1/2011 8:00"}
        for c in range(40) for m in (1, 3)
    ]
    warehouse = Warehouse(raw(*lines), default_countries(spark), root=scratch.path("tables"))
    stored = warehouse.mart_rfm_movement.select(
        F.input_file_name().alias("file"), "customer_id", "snapshot_month"
    ).collect()
    files = {}
    for file, *key in stored:
        files.setdefault(file, []).append(key)
    assert all(keys == sorted(keys) for keys in files.values())
    in_order = sorted(files.values())
    assert all(a[-1] < b[0] for a, b in zip(in_order, in_order[1:]))


def test_row_checks_of_stored_tables_cost_no_scan(spark, raw, scratch):
    """Counted while the tables were written: each file scan left serves a uniqueness check."""
    lines = [dict(InvoiceNo=f"A{i}", CustomerID=f"C{i % 3}") for i in range(9)]
    lines += [dict(InvoiceNo="B1", UnitPrice="200001", Country=None), dict(InvoiceNo="B2", Description=None)]
    countries = spark.createDataFrame([(1, "de", "Germany")], "id int, alpha2 string, en string")
    with Warehouse(scratch.keep(raw(*lines), "raw"), countries) as shop:
        report = shop.check_report()
        text = report._jdf.queryExecution().executedPlan().toString()
        declared = shop._checks()
        unique = [c for found in declared.values() for c in found if isinstance(c, checks.UniqueCheck)]
        # One more for the raw rows, which were not written here.
        assert text.count("FileScan") == len(unique) + 1
        scanned = checks.check_report(
            {"raw_ecommerce": (shop.raw, checks.raw_checks())}
            | {name: (getattr(shop, name), found) for name, found in declared.items()}
        )
        assert rows(report) == rows(scanned) and report.count() == 85
        failed = {(r.table_name, r.column_name) for r in report.filter("NOT passed").collect()}
        assert ("silver_ecommerce", "country") in failed and ("fact_sales", "total_price") in failed


def test_row_checks_share_the_scan_of_a_uniqueness_check(spark, scratch):
    df = scratch.keep(
        spark.createDataFrame(
            [(1, None), (1, "x"), (None, "yy"), (None, None), (2, "z")], "k int, v string"
        ),
        "t",
    )
    declared = [checks.unique("k"), checks.not_null("v"), checks.max_length("v", 1),
                checks.unique_combination("k", "v"), checks.not_null("k")]
    report = checks.check_table("t", df, declared)
    assert rows(report, "check_name", "column_name", "violations") == [
        ("max_length", "v", 1), ("not_null", "k", 2), ("not_null", "v", 2),
        ("unique", "k", 1), ("unique_combination", "k, v", 0),
    ]
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    empty = checks.check_table("t", df.limit(0), declared)
    assert {r.violations for r in empty.collect()} == {0}
