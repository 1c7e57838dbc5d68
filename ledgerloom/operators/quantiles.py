"""Ends of NTILE buckets, found by counting.

Sorting every row to learn where four buckets end moves all rows to keep a handful. Here
rows are counted per bracket of values first, combined on the map side: whole numbers are
brackets of their own, other numbers share one with those of the same leading bits. The
cumulated counts tell which bracket holds each end. Rows of those brackets are counted again
by finer ones: further bits, or for tied whole numbers the first characters of the key that
breaks ties. Only rows of a finer bracket that holds an end are put in order, by ``ranked``,
which spreads any number of them over tasks. Every step compares exactly, so ends are exact
however values are spread; brackets only decide how many rows are ordered.

Each measure is counted by itself, over plain columns: a scan then reads two of them, and no
row is repeated or packed into a struct on its way into the counts.

A row may stand for a run of groups, such as the months in which a customer's totals stay as
they are. It is then counted where its run begins and taken off where it ends, and sums over the
groups give the counts of each; it is repeated only for groups that need it put in order.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ranking import ranked
from ledgerloom.scratch import Scratch

# Leading bits that numbers of one bracket share, if they are not whole.
BITS, FINER_BITS = 10, 24
# Beyond this, cutting bits could overflow.
_LARGEST = 1e290
PREFIX = 3
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def place(value: Column, key: Column) -> Column:
    """What rows of a group are ordered by: the value, none last, then the key."""
    return F.struct(
        value.isNull().alias("missing"),
        F.coalesce(value, F.lit(0.0)).alias("value"),
        key.alias("key"),
    )


def _rounded(value: Column, bits: int) -> Column:
    """The nearest number of so many bits (Veltkamp); rounding never changes an order.

    Very large numbers share one bracket by sign, NaN stays NaN.
    """
    far = value * float(2 ** (53 - bits) + 1)
    near = far - (far - value)
    return (
        F.when(F.isnan(value), value)
        .when(value >= _LARGEST, _LARGEST)
        .when(value <= -_LARGEST, -_LARGEST)
        .otherwise(near)
    )


def _bracket(value: Column, whole: bool) -> Column:
    """Ordered like the values, null and then NaN last."""
    number = value.cast("double")
    step = number if whole else _rounded(number, BITS)
    return F.struct(value.isNull().alias("missing"), F.coalesce(step, F.lit(0.0)).alias("step"))


def _finer(value: Column, key: Column, whole: bool) -> Column:
    """A finer bracket within a bracket, ordered like (value, key)."""
    if whole:
        return F.struct(F.lit(0.0).alias("part"), F.substring(key, 1, PREFIX).alias("prefix"))
    part = F.coalesce(_rounded(value.cast("double"), FINER_BITS), F.lit(0.0))
    return F.struct(part.alias("part"), F.lit("").alias("prefix"))


def within(groups: Column | str, first: Column, until: Column) -> Column:
    """Those of the listed ``groups`` from ``first`` on and before ``until`` (null: all later)."""
    return F.filter(groups, lambda g: (g >= first) & (until.isNull() | (g < until)))


def _each_group(changes: DataFrame, by: list[str], groups: Column) -> DataFrame:
    """Rows per bracket and group, from what is added and taken off at some groups."""
    bracket = Window.partitionBy(*by).orderBy("grp")
    so_far = bracket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = changes.select(
        *by,
        "grp",
        F.lead("grp").over(bracket).alias("until"),
        F.sum("rows").over(so_far).alias("rows"),
    ).filter(F.col("rows") > 0)
    covered = within("groups", F.col("grp"), F.col("until"))
    return runs.withColumn("groups", groups).select(F.explode(covered).alias("grp"), *by, "rows")


def _holding(counts: DataFrame, within: list[str], by: list[str], ends: Column) -> DataFrame:
    """Brackets that hold one of the ``ends``, which become places within the bracket.

    ``ends`` may use ``group_rows``, the rows of the whole group.
    """
    group = Window.partitionBy(*within)
    before = group.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    here = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).withColumn(
        "group_rows", F.sum("rows").over(group)
    )
    inside = F.transform(ends, lambda e: e - F.col("before"))
    inside = F.filter(inside, lambda e: (e > 0) & (e <= F.col("rows")))
    return here.withColumn("ends", inside).filter(F.size("ends") > 0).select(*within, *by, "ends")


def bucket_ends(
    rows: DataFrame,
    group: str,
    key: str,
    measures: list[str],
    buckets: int,
    scratch: Scratch,
    until: str | None = None,
    groups: Column | None = None,
) -> DataFrame:
    """Per value of ``group`` and measure (by number, from 0) the last place of every bucket
    but the highest: (group, measure, place), a place as ``place`` makes it.

    ``rows`` is a stored table, read three times; ``key`` is unique within a group. With
    ``until``, the name of a column, a row is one of each of the listed ``groups`` from its
    ``group`` on and before its ``until`` (null: all later).
    """
    kinds: Mapping[str, bool] = {
        m: isinstance(rows.schema[m].dataType, _WHOLE) for m in measures
    }
    coarse, brackets, finer = ["grp", "measure"], ["missing", "step"], ["part", "prefix"]
    fine = [*coarse, *brackets]

    def of(measure: str, *parts: Column) -> DataFrame:
        """A measure's rows in flat columns, so that a scan reads no others."""
        number = F.lit(measures.index(measure)).alias("measure")
        run = [] if until is None else [F.col(until).alias("until")]
        return rows.select(F.col(group).alias("grp"), *run, number, *parts)

    def counted(measure: str) -> DataFrame:
        here = of(measure, *flat(_bracket(F.col(measure), kinds[measure]), brackets))
        if until is None:
            return here.groupBy(*fine).agg(count)
        added = here.groupBy(*fine).agg(count)
        over = here.withColumn("grp", F.col("until")).filter(F.col("grp").isNotNull())
        taken = over.groupBy(*fine).agg((-F.count("*")).alias("rows"))
        changes = added.unionByName(taken).groupBy(*fine).agg(F.sum("rows").alias("rows"))
        return _each_group(changes, fine[1:], groups)

    def meeting(placed: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
        """Rows of the ``wanted`` brackets, once for each group that wants them."""
        if until is None:
            return placed.join(wanted, on)
        runs = placed.withColumnRenamed("grp", "first")
        covers = (F.col("grp") >= F.col("first")) & (
            F.col("until").isNull() | (F.col("grp") < F.col("until"))
        )
        return runs.join(wanted, on[1:]).filter(covers).drop("first", "until")

    def flat(struct: Column, names: list[str]) -> list[Column]:
        return [struct.getField(n).alias(n) for n in names]

    name = F.col(key).cast("string")
    count = F.count("*").alias("rows")
    size, extra = F.floor(F.col("group_rows") / buckets), F.col("group_rows") % buckets
    last = [F.lit(b) * size + F.least(F.lit(b), extra) for b in range(1, buckets)]
    ends = F.array_distinct(F.filter(F.array(*last), lambda e: (e > 0) & (e < F.col("group_rows"))))
    counts = reduce(DataFrame.unionByName, [counted(m) for m in measures])
    wanted = scratch.keep(_holding(counts, coarse, brackets, ends), "brackets")

    # Finer brackets of the rows that are left only.
    placed = [
        of(
            m,
            *flat(_bracket(F.col(m), kinds[m]), brackets),
            *flat(_finer(F.col(m), name, kinds[m]), finer),
            F.col(m).cast("double").alias("value"),
            name.alias("key"),
        )
        for m in measures
    ]
    found = [
        meeting(p, wanted.filter(F.col("measure") == i).drop("ends"), fine)
        .groupBy(*fine, *finer)
        .agg(count)
        for i, p in enumerate(placed)
    ]
    found = reduce(DataFrame.unionByName, found).join(wanted, fine)
    wanted = scratch.keep(_holding(found, fine, finer, F.col("ends")), "finer_brackets")
    few = [
        meeting(p, wanted.filter(F.col("measure") == i).drop("ends"), [*fine, *finer])
        for i, p in enumerate(placed)
    ]
    # Written: putting rows in order reads them more than once.
    few = scratch.keep(reduce(DataFrame.unionByName, few), "few")
    ordered = ranked(few, ["value", "key"], scratch, within=[*fine, *finer])
    return (
        ordered.join(wanted, [*fine, *finer])
        .filter(F.array_contains("ends", F.col("rank")))
        .select(
            F.col("grp").alias(group),
            "measure",
            place(F.col("value"), F.col("key")).alias("place"),
        )
    )
