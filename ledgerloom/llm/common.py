"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The learning fold: rows whose crc32(doc_id as text) mod FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 3, 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """Null for a null id: such a row is neither learned from nor held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def text_key(text: Column) -> Column:
    """One key per distinct text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def text_slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Cut a long text at blanks, so that no word is cut; its words stay in memory by slice."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            blank = text.find(" ", end)
            end = len(text) if blank < 0 else blank
        yield text[at:end]
        at = end


def blocks(lengths: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``limit`` characters; a longer row is a run of its own."""
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)
