"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in every given column; unlike ``dropna`` this reaches the scan."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def first_per_key(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[str]
) -> DataFrame:
    """The first row of each key in ``order`` (ascending, nulls last).

    ``order`` should decide every tie that shows in the output, so that reruns agree.
    The ``= 1`` filter lets Spark prune to one row per key before the shuffle as well
    as after it, so a key that holds a third of all rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )
