"""Raw-shaped rows from order/line-item tables.

Every line item becomes one raw row. The tables are clean, so some values are made
dirty on the way (bad numbers, missing keys, mixed case), by rules on the row's own
keys, to give each cleaning rule something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def sample_raw(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders, customers, nations, parts = (
        _read(spark, folder, t) for t in ("lineitem", "orders", "customer", "nation", "part")
    )
    key, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")

    # Partly shipped orders go to the neighbouring nation: customers in two countries.
    nation_key = (F.col("c_nationkey") + (F.col("o_orderstatus") == "P").cast("int")) % 25
    headers = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", nation_key.alias("nation_key"))
    )
    # Both sides grow with the data: merged, which also spreads a one-piece file over tasks.
    joined = lines.join(headers.hint("merge"), key == F.col("o_orderkey")).join(
        parts, part == F.col("p_partkey")
    )
    # The few nations last: names would move with the lines.
    joined = joined.join(nations, F.col("nation_key") == F.col("n_nationkey"))

    code = F.concat(F.lit("SKU"), part.cast("string"))
    # Line 7 is stamped with its ship date: invoices that span months.
    day = F.when(line == 7, F.col("l_shipdate")).otherwise(F.col("o_orderdate"))
    price = F.col("p_retailprice").cast("decimal(18,2)") - F.col("l_discount").cast("decimal(18,2)")
    return joined.select(
        F.when(~((key % 499 == 0) & (line == 2)), key.cast("string")).alias("InvoiceNo"),
        F.when((key % 211 == 0) & (line == 1), None)
        .when(part % 97 == 0, "POST")
        .when(part % 97 == 1, "M")
        .when(part % 97 == 2, " dot ")
        .when(part % 97 == 3, "Bank Charges")
        .when(line == 3, F.lower(code))
        .when(line == 5, F.concat(F.lit(" "), code, F.lit(" ")))
        .otherwise(code)
        .alias("StockCode"),
        F.when(part % 73 != 8, F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("Description"),
        F.when(key % 101 == 7, "abc")
        .when(key % 103 == 5, "-1")
        .when(key % 107 == 3, "2.5")
        .when(key % 109 == 2, " 7 ")
        .when(key % 113 == 4, "2.49999999999")
        .when(key % 113 == 5, "1e2")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("Quantity"),
        F.concat(
            F.concat_ws("/", *[part_of(day).cast("string") for part_of in (F.month, F.day, F.year)]),
            F.lit(" "),
            (line % 2 + 9).cast("string"),
            F.lit(":30"),
        ).alias("InvoiceDate"),
        F.when(part % 89 == 6, "0")
        .when(part % 83 == 5, "x")
        .when(part % 83 == 6, "5d")
        .when(part % 83 == 7, "0.00001")
        .when(part % 83 == 8, " 1e2 ")
        .when(part % 79 == 4, None)
        .otherwise(price.cast("string"))
        .alias("UnitPrice"),
        F.when(key % 19 != 0, F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.when(key % 37 != 0, F.concat(F.lit(" "), "n_name")).alias("Country"),
    )


def sample_countries(spark: SparkSession, folder: str) -> DataFrame:
    """A country list for the nations; those of one region are under another name."""
    name = F.when(
        F.col("n_regionkey") == 4, F.concat("n_name", F.lit(", Territory of"))
    ).otherwise(F.col("n_name"))
    return _read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("alpha2"),
        name.alias("en"),
    )
