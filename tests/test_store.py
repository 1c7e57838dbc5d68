"""The normalised tables and their store."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import rows
from ledgerloom.plans import normalised
from ledgerloom.plans.checks import ChecksFailed
from ledgerloom.schemas import STORE
from ledgerloom.store import Store, load_store


def keys(spark, column, *values):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def test_row_counts_of_the_four_lines(four_lines):
    customers = normalised.customers(four_lines)
    products = normalised.products(four_lines)
    orders = normalised.orders(four_lines, customers)
    items = normalised.order_items(four_lines, orders, products)
    tables = {"customers": customers, "products": products, "orders": orders, "order_items": items}
    assert rows(normalised.row_counts(tables)) == [
        ("customers", 2), ("order_items", 3), ("orders", 2), ("products", 3),
    ]


def test_column_names_are_lowered(four_lines):
    upper = four_lines.toDF(*[c.upper() for c in four_lines.columns])
    assert normalised.silver_columns(upper).columns == four_lines.columns


def test_customers_without_nulls_or_repeats(silver_rows):
    df = silver_rows(
        dict(customer_id=None), dict(customer_id="A", country=None),
        dict(customer_id="A", country="Spain"), dict(customer_id="A", country="Spain"),
    )
    assert rows(normalised.customers(df)) == [("A", "Spain")]


def test_products_keep_codes_as_written_and_null_descriptions(silver_rows):
    df = silver_rows(dict(description=None), dict(stock_code="sku1"), dict(stock_code="POST"))
    assert rows(normalised.products(df), "stock_code", "description") == [
        ("POST", "Product"), ("SKU1", None), ("sku1", "Product"),
    ]


def test_orders_guard(spark, four_lines):
    orders = normalised.orders(four_lines, keys(spark, "customer_id", "12345"))
    assert rows(orders, "invoice_no") == [("INV001",)]


def test_order_that_starts_with_an_unknown_customer_is_lost(spark, silver_rows):
    df = silver_rows(
        dict(customer_id="unknown", invoice_date=dt.datetime(2011, 1, 1)),
        dict(customer_id="known", invoice_date=dt.datetime(2011, 1, 2), stock_code="SKU2"),
    )
    assert normalised.orders(df, keys(spark, "customer_id", "known")).count() == 0


def test_items_guards_and_null_quantity(spark, silver_rows, four_lines):
    all_orders = keys(spark, "invoice_no", "INV001", "INV002", "INV003")
    all_products = keys(spark, "stock_code", "SKU001", "SKU002", "SKU003")
    one_order = normalised.order_items(
        four_lines, keys(spark, "invoice_no", "INV001"), all_products
    )
    assert rows(one_order, "invoice_no", "stock_code") == [("INV001", "SKU001"), ("INV001", "SKU002")]
    one_product = normalised.order_items(
        four_lines, all_orders, keys(spark, "stock_code", "SKU001")
    )
    assert rows(one_product, "invoice_no") == [("INV001",), ("INV002",)]
    no_quantity = silver_rows(dict(invoice_no="INV001", stock_code="SKU001", quantity=None))
    assert normalised.order_items(no_quantity, all_orders, all_products).count() == 0


def test_load_twice_adds_nothing(spark, four_lines, scratch):
    root = scratch.path("store")
    first = rows(load_store(four_lines, root))
    assert first == [("customers", 2), ("order_items", 3), ("orders", 2), ("products", 3)]
    assert rows(load_store(four_lines, root)) == first
    assert len(Store(spark, root).committed_runs()) == 2


def test_second_batch_continues_ids_and_keeps_old_rows(spark, four_lines, silver_rows, scratch):
    store = Store(spark, scratch.path("store"))
    store.load(four_lines)
    store.load(
        silver_rows(
            dict(invoice_no="INV004", stock_code="SKU001", description="Renamed", customer_id="777"),
            dict(invoice_no="INV001", stock_code="SKU001", quantity=99, customer_id="12345"),
        )
    )
    items = rows(store.table("order_items"), "id", "invoice_no", "stock_code", "quantity")
    assert items == [
        (1, "INV001", "SKU001", 2), (2, "INV001", "SKU002", 3), (3, "INV002", "SKU001", 1),
        (4, "INV004", "SKU001", 1),
    ]
    names = dict(rows(store.table("products"), "stock_code", "description"))
    assert names["SKU001"] == "Product A"


def test_repeated_lines_are_stored_once(spark, silver_rows, scratch):
    store = Store(spark, scratch.path("store"))
    store.load(silver_rows(dict(quantity=None), dict(quantity=3), dict(quantity=2), dict(quantity=2)))
    assert rows(store.table("order_items"), "id", "quantity") == [(1, 2)]


def test_stored_types(spark, silver_rows, scratch):
    store = Store(spark, scratch.path("store"))
    store.load(silver_rows(dict(unit_price=2.675, total_price=2.675)))
    items = store.table("order_items")
    assert [(f.name, f.dataType) for f in items.schema] == [
        (f.name, f.dataType) for f in STORE["order_items"].schema
    ]
    assert str(items.first().unit_price) == "2.68"


@pytest.mark.parametrize(
    "bad, error",
    [
        (dict(country="x" * 101), "customers.country max_length: 1"),
        (dict(stock_code="x" * 21), "products.stock_code max_length: 1"),
        (dict(description="x" * 256), "products.description max_length: 1"),
        (dict(total_price=1e9), "NUMERIC_VALUE_OUT_OF_RANGE"),
    ],
)
def test_a_failed_load_changes_nothing(spark, four_lines, silver_rows, scratch, bad, error):
    store = Store(spark, scratch.path("store"))
    store.load(four_lines)
    before = {t: rows(store.table(t)) for t in STORE}
    with pytest.raises(Exception, match=error):
        store.load(silver_rows(dict(invoice_no="INV9", customer_id="C9") | bad))
    assert {t: rows(store.table(t)) for t in STORE} == before
    assert len(store.committed_runs()) == 1


def test_failed_first_load_leaves_an_empty_store(spark, silver_rows, scratch):
    store = Store(spark, scratch.path("store"))
    with pytest.raises(ChecksFailed):
        store.load(silver_rows(dict(country="x" * 101)))
    assert rows(store.row_counts()) == [(t, 0) for t in sorted(STORE)]


def test_a_commit_that_raises_before_it_is_visible_is_removed(
    spark, four_lines, scratch, monkeypatch
):
    store = Store(spark, scratch.path("store"))
    store.load(four_lines)
    before = rows(store.row_counts())
    monkeypatch.setattr(Store, "_commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.load(four_lines)
    monkeypatch.undo()
    assert rows(store.row_counts()) == before
    store.load(four_lines)


def test_a_commit_that_raises_once_visible_stands(spark, four_lines, scratch, monkeypatch):
    store = Store(spark, scratch.path("store"))
    commit = Store._commit

    def lost_answer(self, *line):
        commit(self, *line)
        raise ConnectionError

    monkeypatch.setattr(Store, "_commit", lost_answer)
    run_id = store.load(four_lines)
    monkeypatch.undo()
    assert store.committed_runs() == [run_id]
    assert store.table("order_items").count() == 3
    store.load(four_lines)
    assert store.table("order_items").count() == 3


def test_of_two_loads_at_once_one_starts_again(
    spark, four_lines, silver_rows, scratch, monkeypatch
):
    first, second = Store(spark, scratch.path("store")), None
    second = Store(spark, first.root)
    other = silver_rows(dict(invoice_no="INV009", stock_code="SKU009", customer_id="12345",
                             country="United Kingdom"))
    commit = Store._commit

    def overtaken(self, *line):
        monkeypatch.setattr(Store, "_commit", commit)
        second.load(other)
        return commit(self, *line)

    monkeypatch.setattr(Store, "_commit", overtaken)
    first.load(four_lines)
    assert len(first.committed_runs()) == 2
    assert sorted(r.id for r in first.table("order_items").collect()) == [1, 2, 3, 4]
    assert first.table("customers").count() == 2


def test_a_damaged_log_raises(spark, four_lines, scratch):
    store = Store(spark, scratch.path("store"))
    store.load(four_lines)
    with open(f"{store._log}/000000000001.json", "w") as f:
        f.write('{"seq": 1, "run_')
    with pytest.raises(Exception, match="(?i)malformed"):
        store.row_counts()
