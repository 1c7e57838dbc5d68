"""Silver, gold and marts on small inputs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.plans import gold, marts
from ledgerloom.plans.silver import clean, silver
from ledgerloom.schemas import COUNTRIES, SILVER


def test_clean_types_and_names(raw):
    df = clean(raw({"Description": "  Mug ", "Country": " France ", "Quantity": "2", "UnitPrice": "1.5"}))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER]
    r = df.first()
    assert (r.description, r.country, r.quantity, r.total_price) == ("Mug", "France", 2, 3.0)
    assert r.invoice_date == dt.datetime(2011, 1, 5, 8)


@pytest.mark.parametrize(
    "bad",
    [
        {"InvoiceNo": None}, {"StockCode": None}, {"Quantity": "abc"}, {"Quantity": "-1"},
        {"Quantity": "0"}, {"Quantity": None}, {"UnitPrice": "x"}, {"UnitPrice": "0"},
        {"UnitPrice": None},
    ],
)
def test_clean_drops(raw, bad):
    assert clean(raw(bad)).count() == 0


def test_clean_keeps_rows_without_customer_or_description(raw):
    assert clean(raw({"CustomerID": None, "Description": None, "Country": None})).count() == 1


def test_a_dropped_row_may_have_a_bad_date(raw):
    assert clean(raw({"Quantity": "-1", "InvoiceDate": "bad"})).count() == 0


def test_silver_keeps_the_earliest_line(raw):
    df = silver(
        raw(
            {"InvoiceDate": "1/6/2011 8:00", "Quantity": "1"},
            {"InvoiceDate": "1/5/2011 9:00", "Quantity": "9"},
            {"InvoiceDate": "1/5/2011 9:00", "Quantity": "4"},
            {"InvoiceDate": "1/5/2011 9:00", "Quantity": "4"},
            {"StockCode": "sku1"},
        )
    )
    assert rows(df, "stock_code", "quantity") == [("SKU1", 4), ("sku1", 1)]


def test_dimensions_take_the_first_seen(silver_rows):
    later = dt.datetime(2011, 2, 1)
    df = silver_rows(
        dict(country="France", invoice_date=later),
        dict(country="Germany"),
        dict(stock_code=" sku1 ", description="Earlier A", invoice_date=dt.datetime(2010, 12, 1)),
        dict(stock_code="sKu1", description="Earlier B", invoice_date=dt.datetime(2010, 12, 1)),
        dict(customer_id=None, stock_code=" post "),
        dict(customer_id="C2", country=None, stock_code="Bank Charges"),
    )
    assert rows(gold.dim_customers(df)) == [("C1", "Germany"), ("C2", None)]
    assert rows(gold.dim_products(df)) == [("SKU1", "Earlier A", 10.0)]


def test_fact_key_hashes_the_code_as_written(silver_rows):
    df = silver_rows(
        dict(stock_code="85123a"),
        dict(stock_code="85123A"),
        dict(stock_code="DOT"),
        dict(customer_id=None),
    )
    fact = gold.fact_sales(df)
    assert rows(fact, "invoice_no", "stock_code", "date_id") == [("INV1", "85123A", 20110101)] * 2
    assert fact.select("sales_id").distinct().count() == 2


def test_dim_date_default_calendar(spark):
    assert gold.dim_date(spark).count() == 374


def test_mart_invoices(spark, silver_rows):
    df = silver_rows(
        dict(country="Congo, Democratic Republic of the"),
        dict(customer_id="C2", country="Atlantis", unit_price=12.0, total_price=24.0, quantity=2,
             invoice_date=dt.datetime(2012, 1, 1)),
    )
    countries = spark.createDataFrame(
        [(180, "cd", "Congo, Democratic Republic of the")], COUNTRIES
    )
    mart = marts.mart_invoices(
        gold.fact_sales(df), gold.dim_customers(df), gold.dim_products(df),
        gold.dim_date(spark), countries,
    )
    assert len(mart.columns) == 15
    shown = ("customer_id", "country_code", "unit_price", "total_price", "status", "invoice_date",
             "month_name", "quarter")
    assert rows(mart, *shown) == [
        ("C1", "cd", 10.0, 10.0, "Shipped", dt.date(2011, 1, 1), "January", 1),
        # Off the calendar, unlisted country; the price is the product's first.
        ("C2", None, 10.0, 24.0, "Shipped", None, None, None),
    ]


@pytest.fixture
def sales(spark, silver_rows):
    """23 customers over five months, with ties, and days off the calendar."""
    data = []
    for c in range(23):
        for m in range(1 + c % 3, 6, 1 + c % 2):
            for i in range(1 + c % 4):
                price = float(1 + (c * 7 + m + i) % 9)
                data.append(
                    dict(invoice_no=f"{c}-{m}-{i}", customer_id=f"C{c:02}", unit_price=price,
                         invoice_date=dt.datetime(2011, m, 1 + (c + i) % 9), total_price=price)
                )
    data.append(dict(invoice_no="off", customer_id="C99", invoice_date=dt.datetime(2020, 1, 1)))
    return gold.fact_sales(silver_rows(*data)), gold.dim_date(spark)


def test_days_off_the_calendar_have_no_month(sales):
    fact, dates = sales
    assert [m for (m,) in rows(marts.month_spine(fact, dates))] == [
        dt.date(2011, m, 1) for m in range(1, 6)
    ]
    assert marts.rfm_base(fact, dates).filter("customer_id = 'C99'").count() == 0


@pytest.mark.parametrize("customers", [1, 3, 5, 7, 23])
def test_scores_are_ntiles(spark, scratch, customers):
    values = [None, 2.0, 2.0, float("nan"), float("inf"), -1.0, 0.5]
    data = [
        (f"C{c:02}", dt.date(2011, m, 1), 20110101 + c % 4, c % 3, values[(c + m) % 7])
        for c in range(customers)
        for m in (1, 2)
    ]
    base = spark.createDataFrame(
        data,
        "customer_id string, snapshot_month date, most_recent_order int, "
        "number_of_orders long, total_spent double",
    )
    months = Window.partitionBy("snapshot_month")
    want = base.select(
        "customer_id",
        "snapshot_month",
        *[
            F.ntile(5).over(months.orderBy(F.col(m).asc_nulls_last(), "customer_id")).alias(c)
            for c, m in marts.SCORED.items()
        ],
    )
    assert rows(marts.score(base, scratch), *want.columns) == rows(want)


def test_snapshot_is_dense_and_does_not_depend_on_input_order(sales, scratch):
    fact, dates = sales
    snapshot = marts.mart_rfm_snapshot(fact, dates, scratch)
    first = {r[0]: r[1] for r in snapshot.groupBy("customer_id").agg(F.min("snapshot_month")).collect()}
    counts = {r[0]: r[1] for r in snapshot.groupBy("customer_id").count().collect()}
    assert all(counts[c] == 6 - first[c].month for c in first)
    shuffled = marts.mart_rfm_snapshot(fact.orderBy(F.rand(3)), dates, scratch)
    assert rows(shuffled) == rows(snapshot)


def test_movement(spark):
    months = [dt.date(2011, m, 1) for m in (1, 2, 3)]
    data = [
        ("a", months[0], 20110105, 1, 5.0, 1, 1, 1, 3, "Lost"),
        ("a", months[1], 20110205, 2, 9.0, 2, 2, 2, 6, "Lost"),
        ("a", months[2], 20110305, 3, 9.5, 5, 5, 5, 15, "Champion"),
        ("b", months[1], 20110205, 1, 1.0, 5, 1, 1, 7, "New Customer"),
    ]
    schema = (
        "customer_id string, snapshot_month date, most_recent_order int, number_of_orders long, "
        "total_spent double, recency_score int, frequency_score int, monetary_score int, "
        "rfm_total_score int, customer_segment string"
    )
    moved = marts.mart_rfm_movement(spark.createDataFrame(data, schema))
    assert len(moved.columns) == 19
    shown = ("customer_id", "snapshot_month", "total_score_change", "mom_spend_change",
             "segment_movement", "segment_transition")
    assert rows(moved, *shown) == [
        ("a", months[0], None, None, "New", "New → Lost"),
        ("a", months[1], 3, 4.0, "Stable", "Lost → Lost"),
        ("a", months[2], 9, 0.5, "Upgraded", "Lost → Champion"),
        ("b", months[1], None, None, "New", "New → New Customer"),
    ]
