"""Declarative data-quality checks.

A check counts violations; zero passes. Column presence and type are read from the schema.
Each uniqueness check is one grouped count. Checks on single rows are counted while a table is
written (``row_counts``, ``observed_report``); for a table that was written before, they
ride along with its first grouped count, so that it is scanned once for both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import hex_bytes
from ledgerloom.functions.labels import MOVEMENTS, SEGMENTS
from ledgerloom.operators import child_values, with_values, without_parent
from ledgerloom.schemas import RAW, SILVER, StoredTable

REPORT = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("violations", T.LongType(), False),
        T.StructField("passed", T.BooleanType(), False),
    ]
)


@dataclass(frozen=True)
class RowCheck:
    """Fails on each row where ``violates`` is true; null values pass unless it says so."""

    name: str
    column: str
    violates: Column


@dataclass(frozen=True)
class UniqueCheck:
    name: str
    columns: tuple[str, ...]
    ignore_nulls: bool


@dataclass(frozen=True)
class SchemaCheck:
    name: str
    column: str
    type_name: str | None = None


@dataclass(frozen=True)
class ParentCheck:
    """Fails on each child row whose key is missing from ``parent``.

    ``values`` may hold the child's values, stored (``stored_parent_check``).
    """

    column: str
    parent: DataFrame
    parent_key: str
    values: DataFrame | None = None
    name: str = field(default="foreign_key")


Check = RowCheck | UniqueCheck | SchemaCheck | ParentCheck


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: tuple[str, ...]) -> RowCheck:
    return RowCheck("accepted_values", column, ~F.col(column).isin(*values))


def between(column: str, low: object, high: object) -> RowCheck:
    return RowCheck("between", column, ~F.col(column).between(low, high))


def length_equals(column: str, n: int) -> RowCheck:
    return RowCheck("length_equals", column, F.length(column) != n)


def max_length(column: str, n: int) -> RowCheck:
    return RowCheck("max_length", column, F.length(column) > n)


def matches_regex(column: str, pattern: str) -> RowCheck:
    return RowCheck("matches_regex", column, ~F.col(column).rlike(pattern))


def unique(column: str) -> UniqueCheck:
    return UniqueCheck("unique", (column,), ignore_nulls=True)


def unique_combination(*columns: str) -> UniqueCheck:
    return UniqueCheck("unique_combination", columns, ignore_nulls=False)


def column_exists(column: str) -> SchemaCheck:
    return SchemaCheck("column_exists", column)


def column_type(column: str, type_name: str) -> SchemaCheck:
    return SchemaCheck("column_type", column, type_name)


def duplicates(df: DataFrame, columns: tuple[str, ...], ignore_nulls: bool = False) -> DataFrame:
    """Key values held by more than one row, with their ``occurrences``."""
    rows = with_values(df, *columns) if ignore_nulls else df
    return (
        rows.groupBy(*columns)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def repeated_keys(df: DataFrame, check: UniqueCheck) -> DataFrame:
    """One row per key held by more than one row. Hashed keys are compared by their bytes."""
    if len(check.columns) > 1 or not isinstance(df.schema[check.columns[0]].dataType, T.StringType):
        return duplicates(df, check.columns, check.ignore_nulls)
    (key,) = (F.col(c) for c in check.columns)
    keys = (with_values(df, *check.columns) if check.ignore_nulls else df).select(
        hex_bytes(key).alias("bytes"), F.when(hex_bytes(key).isNull(), key).alias("other")
    )
    return duplicates(keys, ("bytes", "other"))


def violating_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    return df.filter(check.violates)


def _line(table: str, check: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        violations.cast("long").alias("violations"),
    )


def _schema_violations(df: DataFrame, check: SchemaCheck) -> int:
    if check.column not in df.columns:
        return 1
    found = df.schema[check.column].dataType.simpleString()
    return int(check.type_name is not None and found != check.type_name)


def stored_parent_check(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_key: str,
    keep: Callable[[DataFrame, str], DataFrame],
) -> ParentCheck:
    """A check whose child values are stored, so that Spark knows how few they are."""
    values = keep(child_values(child, column), f"values_{column}")
    return ParentCheck(column, parent, parent_key, values)


def row_checks(df: DataFrame, checks: list[Check]) -> list[RowCheck]:
    """Those on single rows that the table has the column for."""
    return [c for c in checks if isinstance(c, RowCheck) and c.column in df.columns]


def row_counts(checks: list[RowCheck]) -> list[Column]:
    """Violations of each check as ``c0``, ``c1``, ..."""
    return [F.count_if(c.violates).alias(f"c{i}") for i, c in enumerate(checks)]


def _fixed(spark: SparkSession, table: str, found: list[tuple[str, str, int]]) -> DataFrame:
    lines = [_line(table, name, column, F.lit(n)) for name, column, n in found]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*lines)))


def _judged(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


def observed_report(
    spark: SparkSession, table: str, checks: list[RowCheck], seen: dict
) -> DataFrame:
    """Report rows from the ``row_counts`` that were observed while the table was written."""
    found = [(c.name, c.column, seen[f"c{i}"] or 0) for i, c in enumerate(checks)]
    return _judged([_fixed(spark, table, found)])


def check_table(table: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """One report row per check of one table."""
    parts = []
    present = row_checks(df, checks)
    grouped = [c for c in checks if isinstance(c, UniqueCheck)]
    lines = [_line(table, c.name, c.column, F.col(f"c{i}")) for i, c in enumerate(present)]
    if present and grouped:
        # One count per key serves both; combined on the map side, as each alone would be.
        key, grouped = grouped[0], grouped[1:]
        repeated = F.col("occurrences") > 1
        if key.ignore_nulls:
            repeated &= reduce(and_, [F.col(c).isNotNull() for c in key.columns])
        counts = (
            df.groupBy(*key.columns)
            .agg(F.count("*").alias("occurrences"), *row_counts(present))
            .agg(
                F.count_if(repeated).alias("repeated"),
                *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(present))],
            )
        )
        lines.append(_line(table, key.name, ", ".join(key.columns), F.col("repeated")))
        parts.append(counts.select(F.inline(F.array(*lines))))
    elif present:
        parts.append(df.agg(*row_counts(present)).select(F.inline(F.array(*lines))))

    # A row check on a column that is missing would not resolve: it counts as failed.
    fixed = [
        (c.name, c.column, _schema_violations(df, c)) for c in checks if isinstance(c, SchemaCheck)
    ] + [
        (c.name, c.column, 1)
        for c in checks
        if isinstance(c, RowCheck) and c.column not in df.columns
    ]
    if fixed:
        parts.append(_fixed(df.sparkSession, table, fixed))

    for c in grouped:
        found = repeated_keys(df, c).agg(F.count("*").alias("n"))
        line = _line(table, c.name, ", ".join(c.columns), F.col("n"))
        parts.append(found.select(line.alias("s")).select("s.*"))
    for c in checks:
        if isinstance(c, ParentCheck):
            values = child_values(df, c.column) if c.values is None else c.values
            missing = without_parent(values, c.parent, c.parent_key)
            found = missing.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("n"))
            line = _line(table, c.name, c.column, F.col("n"))
            parts.append(found.select(line.alias("s")).select("s.*"))
    return _judged(parts)


def check_report(tables: dict[str, tuple[DataFrame, list[Check]]]) -> DataFrame:
    """``(table_name, check_name, column_name, violations, passed)`` for all tables."""
    return reduce(
        DataFrame.unionByName, [check_table(name, df, cs) for name, (df, cs) in tables.items()]
    )


class ChecksFailed(ValueError):
    def __init__(self, failures: list):
        self.failures = failures
        super().__init__(
            "; ".join(
                f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in failures
            )
        )


def require(report: DataFrame) -> None:
    """Raise if any check failed. The report has one row per check, so it is small."""
    failures = report.filter(~F.col("passed")).collect()
    if failures:
        raise ChecksFailed(failures)


# ── the checks each table is declared with ───────────────────────────────────


def raw_checks() -> list[Check]:
    return [
        column_exists("InvoiceNo"),
        not_null("InvoiceNo"),
        column_exists("StockCode"),
        not_null("StockCode"),
        column_type("Quantity", RAW["Quantity"].dataType.simpleString()),
        column_type("UnitPrice", RAW["UnitPrice"].dataType.simpleString()),
    ]


def silver_checks() -> list[Check]:
    required = [c for c in SILVER.fieldNames() if c != "customer_id"]
    return [unique_combination("invoice_no", "stock_code"), *map(not_null, required)]


def dim_customers_checks() -> list[Check]:
    return [unique("customer_id"), not_null("customer_id"), not_null("country")]


def dim_products_checks() -> list[Check]:
    return [unique("stock_code"), not_null("stock_code"), not_null("unit_price")]


def dim_date_checks() -> list[Check]:
    return [
        unique("date_id"),
        unique("date"),
        *map(not_null, ("date_id", "date", "year", "month", "quarter")),
    ]


# Ranges the original data set is declared to keep to.
QUANTITY_RANGE = (1, 100_000)
LINE_TOTAL_RANGE = (0, 200_000)
MONTH_RANGE = ("2010-12-01", "2011-12-01")
ORDERS_RANGE = (1, 1_000)
SPEND_RANGE = (0, 1_000_000)
SCORE_RANGE = (1, 5)
TOTAL_SCORE_RANGE = (3, 15)
KEY_LENGTH = 32
STATUSES = ("Shipped", "Cancelled")
TRANSITION_PATTERN = ".+ → .+"


def fact_sales_checks() -> list[Check]:
    return [
        unique("sales_id"),
        length_equals("sales_id", KEY_LENGTH),
        *map(not_null, ("sales_id", "invoice_no", "stock_code", "date_id", "quantity")),
        between("quantity", *QUANTITY_RANGE),
        between("total_price", *LINE_TOTAL_RANGE),
    ]


def mart_invoices_checks() -> list[Check]:
    required = ("sales_id", "invoice_no", "status", "stock_code", "quantity", "total_price")
    return [
        unique_combination("invoice_no", "stock_code"),
        unique("sales_id"),
        length_equals("sales_id", KEY_LENGTH),
        accepted_values("status", STATUSES),
        *map(not_null, required),
        between("quantity", *QUANTITY_RANGE),
        between("total_price", *LINE_TOTAL_RANGE),
    ]


def _score_checks() -> list[Check]:
    scores = ("recency_score", "frequency_score", "monetary_score")
    return [
        unique_combination("customer_id", "snapshot_month"),
        *map(not_null, ("customer_id", "snapshot_month", *scores)),
        *[between(s, *SCORE_RANGE) for s in scores],
        not_null("rfm_total_score"),
        between("rfm_total_score", *TOTAL_SCORE_RANGE),
        not_null("customer_segment"),
        accepted_values("customer_segment", SEGMENTS),
    ]


def mart_rfm_snapshot_checks(month_range: tuple[str, str] = MONTH_RANGE) -> list[Check]:
    first, last = (F.lit(m).cast("date") for m in month_range)
    return [
        *_score_checks(),
        between("snapshot_month", first, last),
        not_null("most_recent_order"),
        not_null("number_of_orders"),
        between("number_of_orders", *ORDERS_RANGE),
        not_null("total_spent"),
        between("total_spent", *SPEND_RANGE),
    ]


def mart_rfm_movement_checks() -> list[Check]:
    return [
        *_score_checks(),
        not_null("segment_movement"),
        accepted_values("segment_movement", MOVEMENTS),
        not_null("segment_transition"),
        matches_regex("segment_transition", TRANSITION_PATTERN),
    ]


def stored_row_checks(table: StoredTable) -> list[RowCheck]:
    """Required columns and text lengths of a normalised table."""
    return [
        *map(not_null, table.required),
        *[max_length(c, n) for c, n in table.max_lengths.items()],
    ]


def stored_checks(table: StoredTable, parents: dict[str, DataFrame]) -> list[Check]:
    """Keys, required columns, text lengths and foreign keys of a normalised table."""
    return [
        *[unique_combination(*columns) for columns in table.unique_sets],
        *stored_row_checks(table),
        *[ParentCheck(c, parents[p], c) for c, p in table.parents.items()],
    ]
