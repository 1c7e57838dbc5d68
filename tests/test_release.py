from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ledgerloom import release
from ledgerloom.plans import gold, marts, reports
from ledgerloom.plans.warehouse import LAYERS, Warehouse
from ledgerloom.scratch import Scratch

TABLES = [name for names in LAYERS.values() for name in names]


@pytest.fixture
def countries(spark):
    return spark.createDataFrame([(1, "de", "Germany")], "id int, alpha2 string, en string")


def line(invoice, customer="C1", month=1, price="2.0", code="SKU1"):
    return dict(InvoiceNo=invoice, CustomerID=customer, InvoiceDate=f"{month}/5/2011 8:00",
                UnitPrice=price, StockCode=code)


def local(path):
    return path.removeprefix("file:")


def versions(tables):
    return {p.split("/")[-2] if "=" not in p else p.split("/")[-3]
            for df in tables.values() for p in df.inputFiles()}


def test_readers_see_all_of_a_build_or_nothing_of_it(spark, raw, countries, scratch, monkeypatch):
    root = scratch.path("shop")
    first = Warehouse(raw(line("A1")), countries, root)
    with pytest.raises(FileNotFoundError):
        Warehouse.open(spark, root)
    assert first.publish() == 0
    second = Warehouse(raw(line("A1"), line("B2", "C2", 2)), countries, root)
    # The build fails between two tables: its silver and gold are there, its marts are not.
    monkeypatch.setattr(marts, "mart_rfm_snapshot", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        second.publish()
    assert second.fact_sales.count() == 2
    monkeypatch.undo()
    seen = Warehouse.open(spark, root)
    assert sorted(seen) == sorted(TABLES) and versions(seen) == {first.version}
    assert seen["fact_sales"].count() == seen["mart_invoices"].count() == 1
    assert second.publish() == 1
    now = Warehouse.open(spark, root)
    assert versions(now) == {second.version}
    assert now["fact_sales"].count() == now["mart_invoices"].count() == 2
    assert [f.name for f in now["mart_rfm_snapshot"].schema] == second.mart_rfm_snapshot.columns
    # An earlier release and the readers it has stay.
    assert rows(seen["mart_rfm_movement"]) == rows(Warehouse.open(spark, root, 0)["mart_rfm_movement"])


def test_a_release_being_written_does_not_count(spark, raw, countries, scratch):
    root = scratch.path("shop")
    Warehouse(raw(line("A1")), countries, root).publish()
    open(f"{local(root)}/_releases/000000000001.json", "w").close()
    assert Warehouse.open(spark, root)["fact_sales"].count() == 1
    assert Warehouse(raw(line("A1")), countries, root).publish() == 2


def test_old_versions_go_after_a_time(spark, raw, countries, scratch):
    root = scratch.path("shop")
    builds = [Warehouse(raw(line("A1"), line(f"B{i}")), countries, root) for i in range(3)]
    for build in builds:
        build.publish()
    assert release.remove_old(spark, root, dt.timedelta(hours=1)) == []
    time.sleep(0.1)
    removed = release.remove_old(spark, root, dt.timedelta(seconds=-60))
    assert {r.rsplit("/", 1)[1] for r in removed} == {b.version for b in builds[:2]}
    for layer, names in LAYERS.items():
        for name in names:
            assert os.listdir(f"{local(root)}/{layer}/{name}") == [builds[2].version]
    assert Warehouse.open(spark, root)["fact_sales"].count() == 2
    with pytest.raises(FileNotFoundError):
        Warehouse.open(spark, root, 7)


# ── the snapshot's folders by month ──────────────────────────────────────────


@pytest.fixture
def shop(spark, raw, countries):
    lines = [line(f"I{i}", f"C{i % 9}", 1 + i % 4, str(1 + i * i), f"S{i}") for i in range(40)]
    with Warehouse(raw(*lines), countries) as warehouse:
        yield warehouse


@pytest.mark.parametrize(
    "report", [reports.segment_sizes, reports.score_distribution, reports.score_headline]
)
def test_reports_of_one_month_read_its_files_only(spark, shop, report):
    snapshot = shop.mart_rfm_snapshot
    assert shop.latest_month == "2011-04-01"
    found = report(snapshot, shop.latest_month)
    assert rows(found) == rows(report(snapshot))
    text = plan(found)
    assert "PartitionFilters: [isnotnull(snapshot_month" in text
    assert "= 2011-04-01" in text or "= 15065" in text


def test_stored_snapshot_keeps_its_columns(spark, shop, scratch):
    fresh = marts.mart_rfm_snapshot(shop.fact_sales, shop.dim_date, scratch)
    assert shop.mart_rfm_snapshot.columns == fresh.columns
    assert rows(shop.mart_rfm_snapshot) == rows(fresh)
    assert shop.check_report().filter("NOT passed").isEmpty()


def test_months_are_replaced_alone(spark, shop, scratch):
    path = scratch.path("snapshot")
    marts.refresh_snapshot(path, shop.fact_sales, shop.dim_date, "2011-01-01", scratch)
    before = {d: os.stat(f"{local(path)}/{d}").st_mtime_ns for d in os.listdir(local(path))}
    late = gold.fact_sales(shop.silver_ecommerce).filter("date_id >= 20110301").select(
        *[F.concat(F.lit("x"), c).alias(c) if c in ("invoice_no", "sales_id") else c
          for c in shop.fact_sales.columns]
    )
    more = Scratch(spark).keep(shop.fact_sales.unionByName(late), "more")
    marts.refresh_snapshot(path, more, shop.dim_date, "2011-03-01", scratch)
    changed = {d for d in before if os.stat(f"{local(path)}/{d}").st_mtime_ns != before[d]}
    assert changed >= {"snapshot_month=2011-03-01", "snapshot_month=2011-04-01"}
    assert not {d for d in changed if "2011-01" in d or "2011-02" in d}
    stored = spark.read.schema(shop.mart_rfm_snapshot.schema).parquet(path)
    whole = marts.mart_rfm_snapshot(more, shop.dim_date, scratch)
    assert rows(stored.select(*whole.columns)) == rows(whole)
    assert marts.latest_folder(spark, path) == "2011-04-01"
