"""Hilbert-curve ordering: rows near in several metadata dimensions share a shard.

Each dimension is quantised at equal-depth cut points (of texts, whole strings; a string's rows
stay in one cell), the cell's place on the Hilbert
curve is computed by SQL expressions, rows are ranked by it and the ranking is cut into
runs. A shard then covers a small box in every dimension, so file statistics on any of
them let a reader skip files.

Law ``rows``: shard counts differ by at most one, whatever the skew. Null dimensions go to
cell 0; rows equal in every column take neighbouring places; empty input gives no rows.
All input columns are carried along, except that ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.operators.ranking import ranked
from ledgerloom.scratch import Scratch

# Cut points per dimension come from a quantile sketch of this relative accuracy.
SKETCH_ACCURACY = 2000
_ORDERED = ("integer", "long", "string", "double")


def _ones(value: int) -> int:
    """How many of the lowest bits are set before the first clear one."""
    count = 0
    while value & 1:
        value >>= 1
        count += 1
    return count


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell with ``bits`` bits per dimension.

    Walks from the top bit down, keeping the entry corner and direction of the current
    sub-cube (Hamilton's formulation by Gray codes and rotations).
    """
    n = len(cells)
    size, mask = 1 << n, (1 << n) - 1
    gray = [w ^ (w >> 1) for w in range(size)]
    ungray = [gray.index(g) for g in range(size)]
    entry = [gray[2 * ((w - 1) // 2)] if w else 0 for w in range(size)]
    turn = [0] + [_ones(w if w % 2 else w - 1) % n for w in range(1, size)]

    def numbers(values: Sequence[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    def rotated(x: Column, right: Column) -> Column:
        low = F.call_function("shiftright", x, right.cast("int"))
        high = F.call_function("shiftleft", x, (F.lit(n) - right).cast("int"))
        return low.bitwiseOR(high).bitwiseAND(F.lit(mask))

    def step(state: Column, bit: Column) -> Column:
        corner = F.lit(0).cast("long")
        for j, cell in enumerate(cells):
            one = F.call_function("shiftright", cell, bit.cast("int")).bitwiseAND(F.lit(1))
            corner = corner + one.cast("long") * (1 << j)
        shift = (state["turned"] + 1) % n
        place = F.get(
            numbers(ungray), rotated(corner.bitwiseXOR(state["entry"]), shift).cast("int")
        )
        back = (F.lit(n).cast("long") - shift) % n
        return F.struct(
            state["entry"].bitwiseXOR(
                rotated(F.get(numbers(entry), place.cast("int")), back)
            ).alias("entry"),
            ((state["turned"] + F.get(numbers(turn), place.cast("int")) + 1) % n).alias("turned"),
            (state["index"] * size + place).alias("index"),
        )

    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("entry"), zero.alias("turned"), zero.alias("index"))
    levels = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(levels, start, step, lambda state: state["index"])


def text_cuts(df: DataFrame, value: Column, parts: int, keep) -> list[str]:
    """At most ``parts - 1`` strings that cut the rows, in order of the whole strings, into runs
    of about equal length.

    Distinct strings are counted first; their running totals are taken per range of strings,
    so neither a hot string nor a great many of them gather in one task.
    """
    counts = df.select(value.alias("v")).filter("v IS NOT NULL").groupBy("v").agg(
        F.count("*").alias("n")
    )
    # Ranges come from sampling: written before they are counted, as another run may differ.
    ranges = keep(
        counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "strings"
    )
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("part").agg(F.sum("n").alias("rows"), F.count("*").alias("kinds"))
    before = keep(
        totals.withColumn("before", F.coalesce(F.sum("rows").over(whole), F.lit(0))).withColumn(
            "all", F.sum("rows").over(Window.partitionBy())
        ),
        "ranges",
    )
    running = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    upto = F.col("before") + F.col("running")
    # A string that ends a run: the next one begins another.
    crossed = F.expr(
        f"((before + running) * {parts}) div all > ((before + running - n) * {parts}) div all"
    )
    cuts = (
        ranges.withColumn("running", running)
        .join(before.select("part", "before", "all"), "part")
        .filter(crossed & (upto < F.col("all")))
        .select("v")
        .orderBy("v")
    )
    return [r["v"] for r in cuts.collect()]


def cells(df: DataFrame, dimensions: Mapping[str, Column], bits: int, keep) -> dict[str, Column]:
    """Equal-depth cells; ``2**bits - 1`` cut points per dimension reach the driver.

    Text is cut by whole strings, whatever they begin with.
    """
    parts = 1 << bits
    at = [i / parts for i in range(1, parts)]
    kinds = df.select(*[c.alias(k) for k, c in dimensions.items()]).schema
    texts = {k for k in dimensions if isinstance(kinds[k].dataType, StringType)}
    numbers = [
        F.percentile_approx(c, at, SKETCH_ACCURACY).alias(k)
        for k, c in dimensions.items()
        if k not in texts
    ]
    found = df.agg(*numbers).first() if numbers else {}
    out = {}
    for name, value in dimensions.items():
        if name in texts:
            ends = F.array(*[F.lit(c) for c in text_cuts(df, value, parts, keep)])
            place = _before(ends.cast("array<string>"), value)
        else:
            cuts = F.array(*[F.lit(c) for c in found[name] or []]).cast("array<long>")
            place = _at_most(cuts, value)
        out[name] = F.when(value.isNull(), 0).otherwise(place).cast("long")
    return out


def _at_most(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda cut: cut <= value))


def _before(ends: Column, value: Column) -> Column:
    return F.size(F.filter(ends, lambda end: end < value))


def hilbert_shards(
    df: DataFrame,
    dimensions: Mapping[str, Column],
    scratch: Scratch,
    shards: int,
    bits: int = 5,
) -> DataFrame:
    """Add ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 within a shard).

    ``dimensions`` are numbers or texts of ``df``. Rows move once, in curve order; they are
    stored with their place on the curve, which is then computed once.
    """
    own = [c for c in df.columns if c not in ("shard", "slot")]
    placed = scratch.keep(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in own]).alias("kept"),
            hilbert_index(
                list(cells(df, dimensions, bits, scratch.keep).values()), bits
            ).alias("curve"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "placed",
    )
    # The last key makes the order total, so equal rows never have to stay in one task.
    simple = [c for c in own if df.schema[c].dataType.typeName() in _ORDERED]
    out = ranked(placed, ["curve", *[f"kept.`{c}`" for c in simple], "tie"], scratch)
    return (
        out.withColumn("shard", F.expr(f"cast((rank - 1) * {shards} div group_rows as int)"))
        .withColumn(
            "slot", F.expr(f"rank - 1 - (shard * group_rows + {shards - 1}) div {shards}")
        )
        .select("kept.*", "shard", "slot")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order; expects ``shard`` and ``slot``."""
    (
        df.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
