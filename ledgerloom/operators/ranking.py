"""Exact ranks over groups of any size.

A window per group sorts each group in one task. Here the rows are range-partitioned
on (group, order) instead, so one group spreads over as many tasks as it needs. Each
row's place is its place in its partition plus the rows of the group in earlier
partitions; those counts are one small row per (partition, group) pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.scratch import Scratch

# monotonically_increasing_id: partition number above bit 33, row number below.
_ROW_BITS = 33


def ranked(
    df: DataFrame, order: Sequence[str], scratch: Scratch, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``rank`` (1-based, by ``order`` ascending, nulls last) and ``group_rows``.

    ``order`` must be total within a group; that also lets the range split ties.
    The laid-out rows are written before they are counted: range boundaries come from
    sampling, so a second run of the same plan could cut the partitions elsewhere.
    """
    sort = [F.col(c).asc_nulls_last() for c in [*within, *order]]
    rows = scratch.keep(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranked",
    )
    part = F.shiftright("_slot", _ROW_BITS)
    by_group = Window.partitionBy(*[F.col(c) for c in within])
    before = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Rows here: partitions + groups, so this window is small even without a group.
    pieces = (
        rows.groupBy(part.alias("_part"), *within)
        .agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("group_rows", F.sum("_rows").over(by_group))
        .drop("_rows")
    )
    # Written, so that its real size decides whether the join below broadcasts it.
    pieces = scratch.keep(pieces, "pieces").alias("p")
    same_piece = F.col("r._part") == F.col("p._part")
    for c in within:
        same_piece &= F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
    return (
        rows.withColumn("_part", part)
        .alias("r")
        .join(pieces, same_piece)
        .select(
            *[F.col(f"r.{c}") for c in df.columns],
            (F.col("_before") + F.col("_slot") - F.col("_first") + 1).alias("rank"),
            "group_rows",
        )
    )


def tile(buckets: int, rank: Column, group_rows: Column) -> Column:
    """NTILE from a rank: the first ``group_rows mod buckets`` buckets get one row more."""
    size = F.floor(group_rows / buckets)
    extra = group_rows % buckets
    in_larger = extra * (size + 1)
    return (
        F.when(rank <= in_larger, F.floor((rank - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((rank - 1 - in_larger) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def with_row_ids(
    df: DataFrame, order: Sequence[str], scratch: Scratch, after: int = 0
) -> DataFrame:
    """Dense ids ``after + 1``, ``after + 2``, ... in ``order``."""
    out = ranked(df, order, scratch)
    return out.select((F.col("rank") + F.lit(after)).alias("id"), *df.columns)
