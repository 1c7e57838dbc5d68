"""The four normalised tables: customers, products, orders, order_items.

These keep product codes as written and keep administrative codes, unlike the gold layer.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import first_per_key, with_values
from ledgerloom.schemas import SILVER
from ledgerloom.scratch import Scratch


def silver_columns(silver: DataFrame) -> DataFrame:
    """The nine silver columns under lower-case names, whatever case they come in."""
    lower = silver.toDF(*[c.lower() for c in silver.columns])
    return lower.select(*SILVER.fieldNames())


def customers(silver: DataFrame) -> DataFrame:
    rows = with_values(silver, "customer_id", "country").select(
        "customer_id", "country", "invoice_date"
    )
    return first_per_key(rows, ["customer_id"], ["invoice_date", "country"]).drop("invoice_date")


def products(silver: DataFrame) -> DataFrame:
    rows = with_values(silver, "stock_code").select(
        "stock_code", "description", "unit_price", "invoice_date"
    )
    order = ["invoice_date", "description", "unit_price"]
    return first_per_key(rows, ["stock_code"], order).drop("invoice_date")


def orders(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """The first row of each invoice, if its customer is known.

    The first row is chosen before customers are looked at: an invoice that starts with
    an unknown customer is left out even when a later row has a known one.
    """
    rows = with_values(silver, "invoice_no", "invoice_date").select(
        "invoice_no", "customer_id", "invoice_date"
    )
    first = first_per_key(rows, ["invoice_no"], ["invoice_date", "customer_id"])
    return first.join(customers.select("customer_id"), "customer_id", "left_semi").select(
        "invoice_no", "customer_id", "invoice_date"
    )


def unknown_values(
    silver: DataFrame, parents: Mapping[str, DataFrame], scratch: Scratch
) -> dict[str, DataFrame]:
    """Per key column the stored values that its parent table lacks: mostly few."""
    return {
        key: scratch.keep(
            with_values(silver, key).select(key).distinct().join(parent.select(key), key, "left_anti"),
            f"unknown_{key}",
        )
        for key, parent in parents.items()
    }


def order_items(
    silver: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    unknown: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Lines with a quantity whose invoice and product are both loaded.

    With ``unknown_values`` of both keys, taken from the same lines or more, those are left out
    instead: where they are few they are broadcast, and no line moves to its order or product.
    """
    rows = with_values(silver, "quantity")
    for key, parent in (("invoice_no", orders), ("stock_code", products)):
        if unknown is None:
            rows = rows.join(parent.select(key), key, "left_semi")
        else:
            rows = with_values(rows, key).join(unknown[key], key, "left_anti")
    return rows.select("invoice_no", "stock_code", "quantity", "unit_price", "total_price")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``, one row per table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
