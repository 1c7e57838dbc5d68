"""Insert-if-absent and referential operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.first import first_per_key, with_values


def absent_rows(
    batch: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``batch`` to insert: one per key, for keys ``target`` does not hold.

    ``order`` picks the row where the batch repeats a key; leave it out for a batch that
    is unique already. Both sides are then unique on ``key``, so no join key is hot.

    The target's keys first meet the batch's keys: when the batch is small, Spark sends it
    to the target's scan and only keys found in it are shuffled, so the cost of a load
    follows the batch and not the store.
    """
    rows = first_per_key(batch, key, order) if order else batch
    known = target.select(*key).join(batch.select(*key), list(key), "left_semi")
    return rows.join(known, list(key), "left_anti").select(*batch.columns)


def insert_if_absent(
    batch: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """``target`` after the insert; running it again with the same batch adds nothing."""
    new = absent_rows(batch, target, key, order)
    return target.unionByName(new.select(*target.columns))


def child_values(child: DataFrame, column: str) -> DataFrame:
    """Non-null values of a foreign key and how many rows hold each: a hot value is one row."""
    return (
        with_values(child, column)
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("child_rows"))
    )


def without_parent(values: DataFrame, parent: DataFrame, parent_key: str) -> DataFrame:
    """Those ``child_values`` that no row of ``parent`` has as its key.

    The parent's keys first meet the values: where these are few, Spark sends them to the
    parent's scan, and only keys found among them are shuffled. The cost of a check then
    follows the child and not the parent.
    """
    keys = parent.select(F.col(parent_key).alias("value"))
    known = keys.join(values.select("value"), "value", "left_semi")
    return values.join(known, "value", "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null values of a foreign key with no parent, and how many rows hold each."""
    return without_parent(child_values(child, column), parent, parent_key)
