from __future__ import annotations

import datetime as dt

import pytest

from conftest import rows
from ledgerloom.plans import reports

JAN, FEB = dt.date(2011, 1, 1), dt.date(2011, 2, 1)


@pytest.fixture
def invoices(spark):
    return spark.createDataFrame(
        [
            ("i1", "p1", "Mug", 10.0, "c1", "Spain", "January", 2011),
            ("i1", "p2", "Cup", 5.5, "c1", "Spain", "January", 2011),
            ("i2", "p1", "Mug", 20.0, "c2", "France", "February", 2011),
            ("i3", "p3", "Pot", 0.5, "c2", "France", None, None),
        ],
        "invoice_no string, stock_code string, description string, total_price double, "
        "customer_id string, country string, month_name string, year int",
    )


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame(
        [("c1", JAN, "Lost", 3), ("c1", FEB, "Champion", 15), ("c2", FEB, "Lost", 5),
         ("c3", FEB, "Lost", 4), ("c4", FEB, "Lost", 4)],
        "customer_id string, snapshot_month date, customer_segment string, rfm_total_score int",
    )


@pytest.fixture
def movement(spark):
    return spark.createDataFrame(
        [("c1", JAN, "New", "New → Lost"), ("c1", FEB, "Upgraded", "Lost → Champion"),
         ("c2", FEB, "New", "New → Lost"), ("c3", FEB, "Downgraded", "At Risk → Lost")],
        "customer_id string, snapshot_month date, segment_movement string, segment_transition string",
    )


def test_invoice_reports(invoices):
    assert rows(reports.headline_totals(invoices)) == [(36.0, 3, 2, 12.0)]
    assert rows(reports.revenue_by_month(invoices)) == [
        (2011, "February", 20.0), (2011, "January", 15.5), (None, None, 0.5),
    ]
    assert [tuple(r) for r in reports.top_products(invoices, 2).collect()] == [
        ("p1", "Mug", 30.0), ("p2", "Cup", 5.5),
    ]
    assert [tuple(r) for r in reports.top_countries(invoices, 1).collect()] == [("France", 20.5)]
    assert rows(reports.customers_by_country(invoices)) == [("France", 1), ("Spain", 1)]


def test_snapshot_reports(snapshot):
    assert rows(reports.segment_share(snapshot)) == [
        (JAN, "Lost", 1, 100.0), (FEB, "Champion", 1, 25.0), (FEB, "Lost", 3, 75.0),
    ]
    assert rows(reports.segment_sizes(snapshot)) == [("Champion", 1, 15.0), ("Lost", 3, 13 / 3)]
    assert rows(reports.segment_sizes(snapshot, "2011-01-01")) == [("Lost", 1, 3.0)]
    assert rows(reports.score_distribution(snapshot)) == [(4, 2), (5, 1), (15, 1)]
    assert rows(reports.average_score_by_segment(snapshot)) == [("Champion", 15.0), ("Lost", 4.0)]


def test_movement_reports(movement):
    assert rows(reports.new_and_returning(movement)) == [(JAN, 1, 0), (FEB, 1, 2)]
    assert rows(reports.movement_totals(movement)) == [
        ("Downgraded", 1), ("New", 2), ("Upgraded", 1),
    ]
    assert [tuple(r) for r in reports.transitions(movement, 1).collect()] == [("New → Lost", 2)]
    assert reports.transitions(movement).count() == 3
    assert rows(reports.movement_by_month(movement)) == [(JAN, 0, 0), (FEB, 1, 1)]
