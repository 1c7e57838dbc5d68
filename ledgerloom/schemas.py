"""Column layouts of the raw, clean and normalised tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RAW_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)

# Every raw column stays text: typing happens once, in the silver layer.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

SILVER = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("total_price", T.DoubleType()),
    ]
)

COUNTRIES = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("alpha2", T.StringType()),
        T.StructField("en", T.StringType()),
    ]
)


@dataclass(frozen=True)
class StoredTable:
    """One table of the normalised store with the constraints its rows must meet."""

    schema: T.StructType
    key: tuple[str, ...]
    max_lengths: dict[str, int]
    parents: dict[str, str]  # column -> table whose primary key has the same name
    primary_key: tuple[str, ...] = ()  # where it is not ``key``, the conflict target

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema if not f.nullable)

    @property
    def unique_sets(self) -> tuple[tuple[str, ...], ...]:
        return (self.primary_key, self.key) if self.primary_key else (self.key,)


MONEY = T.DecimalType(10, 2)

# Listed parents first: this is also the load order.
STORE = {
    "customers": StoredTable(
        T.StructType(
            [
                T.StructField("customer_id", T.StringType(), False),
                T.StructField("country", T.StringType(), False),
            ]
        ),
        key=("customer_id",),
        max_lengths={"customer_id": 20, "country": 100},
        parents={},
    ),
    "products": StoredTable(
        T.StructType(
            [
                T.StructField("stock_code", T.StringType(), False),
                T.StructField("description", T.StringType()),
                T.StructField("unit_price", MONEY),
            ]
        ),
        key=("stock_code",),
        max_lengths={"stock_code": 20, "description": 255},
        parents={},
    ),
    "orders": StoredTable(
        T.StructType(
            [
                T.StructField("invoice_no", T.StringType(), False),
                T.StructField("customer_id", T.StringType(), False),
                T.StructField("invoice_date", T.TimestampNTZType(), False),
            ]
        ),
        key=("invoice_no",),
        max_lengths={"invoice_no": 20, "customer_id": 20},
        parents={"customer_id": "customers"},
    ),
    "order_items": StoredTable(
        T.StructType(
            [
                T.StructField("id", T.LongType(), False),
                T.StructField("invoice_no", T.StringType(), False),
                T.StructField("stock_code", T.StringType(), False),
                T.StructField("quantity", T.IntegerType(), False),
                T.StructField("unit_price", MONEY),
                T.StructField("total_price", MONEY),
            ]
        ),
        key=("invoice_no", "stock_code"),
        max_lengths={"invoice_no": 20, "stock_code": 20},
        parents={"invoice_no": "orders", "stock_code": "products"},
        primary_key=("id",),
    ),
}
