from __future__ import annotations

import datetime as dt

import pytest

from ledgerloom.schemas import RAW, SILVER
from ledgerloom.scratch import Scratch
from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    with Scratch(spark) as s:
        yield s


@pytest.fixture
def raw(spark):
    """Raw rows from partial ones: ``raw({"InvoiceNo": "1", ...})``."""
    base = {
        "InvoiceNo": "INV1",
        "StockCode": "SKU1",
        "Description": "Product",
        "Quantity": "1",
        "InvoiceDate": "1/5/2011 8:00",
        "UnitPrice": "2.0",
        "CustomerID": "C1",
        "Country": "Germany",
    }

    def make(*rows: dict):
        return spark.createDataFrame(
            [tuple((base | r)[c] for c in RAW.fieldNames()) for r in rows], RAW
        )

    return make


@pytest.fixture
def silver_rows(spark):
    base = {
        "invoice_no": "INV1",
        "stock_code": "SKU1",
        "description": "Product",
        "quantity": 1,
        "invoice_date": dt.datetime(2011, 1, 1),
        "unit_price": 10.0,
        "customer_id": "C1",
        "country": "Germany",
        "total_price": 10.0,
    }

    def make(*rows: dict):
        return spark.createDataFrame(
            [tuple((base | r)[c] for c in SILVER.fieldNames()) for r in rows], SILVER
        )

    return make


@pytest.fixture
def four_lines(silver_rows):
    """Two invoices of known customers and one without a customer."""
    day = dt.datetime
    return silver_rows(
        dict(invoice_no="INV001", stock_code="SKU001", description="Product A", quantity=2,
             customer_id="12345", country="United Kingdom", total_price=20.0),
        dict(invoice_no="INV001", stock_code="SKU002", description="Product B", quantity=3,
             unit_price=20.0, customer_id="12345", country="United Kingdom", total_price=60.0),
        dict(invoice_no="INV002", stock_code="SKU001", description="Product A",
             invoice_date=day(2011, 1, 2), customer_id="67890"),
        dict(invoice_no="INV003", stock_code="SKU003", description="Product C", quantity=4,
             invoice_date=day(2011, 1, 3), unit_price=30.0, customer_id=None, country=None,
             total_price=120.0),
    )


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is None, v) for v in r])


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
