"""Benchmark decontamination by a prefix-filtered join and exact window checks.

A benchmark window (13 words, or a shorter item whole) occurs in a document only if all its
word shingles do. Shingles are ordered by how often the documents hold them, and the rarest
one of each window is the prefix that must join. A join row must leave room for the window
before and after it (positional and length bounds); then the words around it are compared
with the window itself.

Documents are read once: all benchmark shingles found in them are written with the words
around (few rows), and rarity, prefixes and checks work on that table. The shingle set is
broadcast while it has at most ``BROADCAST_ROWS`` rows; a larger one is joined by shuffle.

Null text has no words; a document without words is not contaminated. Copies of a text
share one key until the end and each gets its own result row. Items that share an id count
as one; an item without an id marks words but is not listed. An empty benchmark leaves
every document clean. All columns of the documents are carried in ``row``. Of equally rare
shingles of a window the one with the smaller hash joins. Texts of any length are read
whole. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_key

WINDOW = 13
SHINGLE = 5
BROADCAST_ROWS = 1_000_000  # of 12 bytes each
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Java looks listed characters up in a table, while it tries ranges one after the other at
# every character: the same classes written by ranges take eight to twelve times as long.
WORD = rf"[0123456789{LOWER}\x{{80}}-\x{{10FFFF}}]+"  # of lower-cased text
ANY_CASE_WORD = rf"[0123456789{LOWER}{UPPER}\x{{80}}-\x{{10FFFF}}]+"


def words_of(text: Column) -> Column:
    # lower() is faster than translate() and the same for pure ASCII.
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(WORD), 0)


def shingle_hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(size)])


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """Distinct (item_id, words): windows of an item, or the whole of a shorter one."""
    words = items.select("item_id", words_of(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (
        words.filter(F.size("words") > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), window).alias("words"))
        .distinct()
    )


def window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """(words, size, hash, offset) of every distinct window; short ones are one shingle."""
    whole = windows.select("words").distinct()
    long = whole.filter(F.size("words") >= size).select(
        "words",
        F.lit(size).alias("size"),
        F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("offset"),
    )
    out = long.withColumn("hash", shingle_hash(F.col("words"), F.col("offset"), size))
    for n in range(1, size):
        short = whole.filter(F.size("words") == n).select(
            "words",
            F.lit(n).alias("size"),
            F.lit(0).alias("offset"),
            shingle_hash(F.col("words"), F.lit(0), n).alias("hash"),
        )
        out = out.unionByName(short)
    return out


def shingle_hits(docs: DataFrame, wanted: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """Where a document holds a wanted (size, hash), with the words around it.

    ``copies`` counts the documents of the same text.
    """
    places = docs.select(
        text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("words")
    ).select("key", "words", F.posexplode("words").alias("pos", "word"))
    kinds = [
        F.struct(
            F.lit(n).alias("size"), shingle_hash(F.col("words"), F.col("pos"), n).alias("hash")
        )
        for n in sizes
    ]
    if len(kinds) == 1:
        places = places.select("*", kinds[0]["size"].alias("size"), kinds[0]["hash"].alias("hash"))
    else:
        places = places.select("*", F.inline(F.array(*kinds)))
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    return (
        places.join(wanted, ["size", "hash"])
        .select(
            "key",
            "pos",
            "size",
            "hash",
            F.size("words").alias("n_words"),
            first.alias("around_at"),
            F.slice("words", first + 1, 2 * window).alias("around"),
        )
        .groupBy("key", "pos", "size", "hash")
        .agg(
            F.first("n_words").alias("n_words"),
            F.first("around_at").alias("around_at"),
            F.first("around").alias("around"),
            F.count("*").alias("copies"),
        )
    )


def occurrences(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """(key, start, words): every occurrence of a window, by its rarest shingle."""
    rarity = hits.groupBy("size", "hash").agg(F.sum("copies").alias("seen"))
    # A window with a shingle that no document holds cannot occur.
    prefix = (
        shingles.join(rarity, ["size", "hash"], "left")
        .groupBy("words")
        .agg(
            F.min(
                F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "hash", "offset", "size")
            ).alias("rarest")
        )
        .filter("rarest.seen > 0")
        .select("words", "rarest.hash", "rarest.offset", "rarest.size")
    )
    start = F.col("pos") - F.col("offset")
    length = F.size("words")
    return (
        hits.join(prefix, ["size", "hash"])
        .filter((start >= 0) & (start + length <= F.col("n_words")))
        .filter(F.slice("around", start - F.col("around_at") + 1, length) == F.col("words"))
        .select("key", start.alias("start"), "words")
    )


def scan(
    docs: DataFrame, items: DataFrame, keep, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """(row, n_words, n_hit, items): each document, its words in windows, and their items."""
    windows = keep(windows_of(items, window), "windows")
    shingles = keep(window_shingles(windows, min(shingle, window)), "shingles")
    wanted = shingles.select("size", "hash").distinct()
    sizes = {r["size"]: r["count"] for r in wanted.groupBy("size").count().collect()}
    if sum(sizes.values()) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    hits = keep(
        shingle_hits(docs, wanted, sorted(sizes) or [min(shingle, window)], window), "hits"
    )
    found = keep(occurrences(hits, shingles), "occurrences")

    # Words in any window: what each one, by start, adds beyond the furthest end so far.
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1
    )
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    added = F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0))
    covered = (
        found.select("key", "start", (F.col("start") + F.size("words")).alias("end"))
        .distinct()
        .select("key", added.alias("added"))
        .groupBy("key")
        .agg(F.sum("added").alias("n_hit"))
    )
    named = (
        found.select("key", "words")
        .distinct()
        .join(windows, "words")
        .select("key", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    marks = keep(covered.join(named, "key"), "marks")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        text_key(F.col("text")).alias("key"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(ANY_CASE_WORD))
        .cast("long")
        .alias("n_words"),
    )
    return rows.join(marks, "key", "left").select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words lies in benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
