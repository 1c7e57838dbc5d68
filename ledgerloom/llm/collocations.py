"""Phrase collocation mining by stripes.

For every prefix of up to four words one stripe (see ``stripes``) counts the words that
follow it. Lengths are counted one after the other: a phrase can be frequent only if its
first and its last words are, so each pass counts only what the filter of the pass before
lets through, and everything it does count is exact. From the merged stripes come the
extensions (a phrase and its count), the totals of their prefixes (counts of the parts of a
cut) and the largest count of an extension (a phrase is dropped inside a longer one). As a
longer phrase is never more frequent than a phrase inside it, looking one word further to
the left and right finds every such case.

Products are taken in ``decimal(38,0)``. Null texts are empty, null languages are ``und``.
Texts of any length are read in blocks, phrases across block ends included. Ties: of cuts
with equal (floored) scores the shortest first part counts; equal scores rank by count, then
by phrase in byte order. Repeated rows count as often as they occur. An empty table, or one
without frequent phrases, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import stripes
from ledgerloom.llm.common import text_slices

LONGEST = 5
LEAST = 100
COVER = 100  # percent
TOP = 2000

UNDETERMINED = "und"
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_KEYS = ["lang", "prefix", "segment"]
WHOLE = -1  # the segment of a prefix that is not cut


def tokens(part: str) -> list[bytes]:
    """Words of a lower-cased slice; ``.`` stands where a piece ends."""
    return part.encode().lower().translate(_ENDS).replace(b".", b" . ").split()


class _Numbers(dict):
    """Numbers of the words of a block; 0 is the end of a piece."""

    def __init__(self):
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Counter:
    """Stripes of one length of prefix, block by block."""

    def __init__(self, size: int, bits: np.ndarray | None, hot: set, segments: int, block: int):
        self.size, self.bits, self.hot = size, bits, hot
        self.segments, self.block = segments, block
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.held, self.filled = _Numbers(), {}, 0

    def add(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        for part in text_slices(text):
            self._hold(lang, tokens(part))
            if self.filled >= self.block:
                yield from self.flush(lang)
        self._hold(lang, [b"."])

    def _hold(self, lang: str, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.held.setdefault(lang, []).append(ids)
        self.filled += len(ids)

    def flush(self, unfinished: str | None = None) -> Iterator[pa.RecordBatch]:
        """Count what is held; the text that is being read keeps its last words."""
        words = list(self.numbers)
        array = pa.array([w.decode() for w in words], pa.string())
        codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        rest: list[bytes] = []
        for lang, parts in self.held.items():
            ids = np.concatenate(parts)
            stop = len(ids)
            if lang == unfinished:
                stop = max(stop - self.size, 0)
                rest = [words[i] for i in ids[stop:].tolist()]
            yield from self._count(lang, ids, stop, array, codes)
        self._clear()
        if rest:
            self._hold(unfinished, rest)

    def _count(self, lang, ids, stop, array, codes) -> Iterator[pa.RecordBatch]:
        size, n = self.size, len(ids)
        padded = np.concatenate([ids, np.zeros(size + 1, ids.dtype)])
        if size == 0:
            at = np.flatnonzero(ids[:stop])
            first, following = np.zeros(len(at), np.int64), ids[at].astype(np.int64)
        else:
            columns = [padded[j : j + n + 1] for j in range(size)]
            seed = np.array([zlib.crc32(lang.encode())], np.uint64)
            may = stripes.may_hold(
                self.bits, stripes.phrase_keys([codes[c] for c in columns], seed)
            )
            for c in columns:
                may &= c != 0
            at = np.flatnonzero(may[:stop])
            first = padded[at].astype(np.int64)
            for j in range(1, size):
                first = np.unique(first * len(array) + padded[at + j], return_inverse=True)[1]
            # What follows counts by itself if the phrase without its first word may matter.
            following = np.where(may[at + 1], padded[at + size], 0).astype(np.int64)
        if not len(at):
            return
        pair, total = np.unique(first * len(array) + following, return_counts=True)
        prefix, following = np.divmod(pair, len(array))
        ends = np.flatnonzero(np.diff(prefix, append=prefix[-1] + 1)) + 1
        number = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        if size:
            place = np.zeros(int(first.max()) + 1, np.int64)
            place[first] = at
            place = place[prefix[ends - 1]]
            texts = [array.take(pa.array(padded[place + j])) for j in range(size)]
            texts = pc.binary_join_element_wise(*texts, " ") if size > 1 else texts[0]
            cut = np.zeros(len(texts), bool)
            mine = [p for other, p in self.hot if other == lang]
            if mine:
                cut = pc.is_in(texts, pa.array(mine, pa.string())).to_numpy(zero_copy_only=False)
        else:
            texts, cut = pa.array([""]), np.ones(1, bool)
        segment = np.where(
            cut[number],
            np.where(following > 0, codes[following] % np.uint64(self.segments), 0).astype(int),
            WHOLE,
        )
        # Rows by prefix and segment; the count of what does not matter goes to the total only.
        order = np.lexsort((following, segment, number))
        number, segment = number[order], segment[order]
        following, total = following[order], total[order]
        new = np.ones(len(order), bool)
        new[1:] = (number[1:] != number[:-1]) | (segment[1:] != segment[:-1])
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(total, starts)
        counted = following > 0
        offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(counted.astype(np.int64), starts))])
        following, total = following[counted], total[counted]
        for a in range(0, len(starts), stripes.BATCH):
            b = min(a + stripes.BATCH, len(starts))
            low, high = offsets[a], offsets[b]
            ends = offsets[a : b + 1] - low
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (b - a), pa.string()),
                    texts.take(pa.array(number[starts[a:b]])),
                    pa.array(segment[starts[a:b]].astype(np.int32)),
                    pa.array(sums[a:b].astype(np.int64)),
                    stripes.words_packed(array.take(pa.array(following[low:high])), ends),
                    stripes.packed_longs(total[low:high], ends),
                ],
                names=[*_KEYS, "total", "following", "n"],
            )


def partial_stripes(
    docs: DataFrame, size: int, bits, hot: set, segments: int, block: int
) -> DataFrame:
    """Stripes of prefixes of ``size`` words, one row per block, prefix and segment."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(size, *shared.value, segments, block)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                yield from counter.add(lang.as_py(), text.as_py())
        yield from counter.flush()

    kind = "lang string, prefix string, segment int, total long, following string, n binary"
    return docs.mapInArrow(run, kind)


def keys_of(phrases: DataFrame, size: int) -> DataFrame:
    """``key`` of each (lang, phrase), as the counting tasks compute it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p.encode().split(b" ") for p in batch["phrase"].to_pylist()]
            codes = [
                np.fromiter((zlib.crc32(w[j]) for w in words), np.uint64, len(words))
                for j in range(size)
            ]
            seeds = (zlib.crc32(lang.encode()) for lang in batch["lang"].to_pylist())
            keys = stripes.phrase_keys(codes, np.fromiter(seeds, np.uint64, len(words)))
            yield pa.RecordBatch.from_pydict({"key": keys.astype(np.int64)})

    return phrases.select("lang", "phrase").mapInArrow(run, "key long")


def extensions(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, prefix) of each frequent extension in merged stripes."""
    pair = F.explode(F.arrays_zip("next", "n")).alias("e")
    return found.select("lang", "prefix", pair).select(
        "lang",
        F.when(F.col("prefix") == "", F.col("e.next"))
        .otherwise(F.concat_ws(" ", "prefix", "e.next"))
        .alias("phrase"),
        F.col("e.n").alias("a"),
        "prefix",
    )


def counted(
    docs: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame],
    least: int,
    longest: int,
    block: int = stripes.BLOCK,
) -> list[DataFrame]:
    """Merged stripes of prefixes of 0, 1, ... words, as far as there are frequent ones."""
    # Small texts are many: whole blocks of tokens need no fewer partitions than the scan has.
    segments = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out: list[DataFrame] = []
    bits, hot, everything = None, set(), 0
    for size in range(longest):
        partial = partial_stripes(docs, size, bits, hot, segments, block)
        out.append(keep(stripes.merge(partial, _KEYS, least, least, words=True), f"stripes{size}"))
        if not size:
            everything = out[0].agg(F.sum("total")).first()[0] or 0
        if size + 1 == longest:
            break
        frequent = extensions(out[size])
        bits = stripes.filter_of(keys_of(frequent, size + 1))
        if not bits.any():
            break
        # Fewer than HOT: counts of phrases of one length add up to ``everything`` at most.
        common = frequent.filter(F.col("a") * stripes.HOT > everything).select("lang", "phrase")
        hot = {(r["lang"], r["phrase"]) for r in common.collect()}
    return out


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact while the products fit 38 digits."""

    def product(*factors: Column) -> Column:
        return reduce(lambda x, y: (x * y).cast("decimal(38,0)"), factors)

    wide = [c.cast("decimal(19,0)") for c in (a, n, left, right)]
    above = product(F.lit(1000).cast("decimal(4,0)"), wide[0], wide[1])
    below = product(wide[2], wide[3])
    return F.call_function("div", above, below).cast("long")


def collocations(
    docs: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame],
    least: int = LEAST,
    longest: int = LONGEST,
    cover: int = COVER,
    top: int = TOP,
    block: int = stripes.BLOCK,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words per language: lang, rank, phrase, a, l,
    r, n, score. ``docs`` has lang and text."""
    texts = docs.select(
        F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"), "text"
    ).filter("text IS NOT NULL")
    found = counted(texts, keep, least, longest, block)
    sizes = found[0].groupBy("lang").agg(F.sum("total").alias("n"))
    longer = found[1:] or [found[0].limit(0)]
    every = reduce(DataFrame.unionByName, longer)
    # Counts of phrases shorter than ``longest``, and the most frequent word after each.
    totals = (
        every.groupBy("lang", F.col("prefix").alias("phrase"))
        .agg(F.sum("total").alias("f"), F.max("best").alias("after"))
        .filter(F.col("f") >= least)
    )
    phrases = keep(extensions(every), "phrases")
    totals = keep(totals, "totals")
    # The most frequent word before a phrase: each longer phrase, without its first word.
    before = (
        phrases.filter(F.instr("prefix", " ") > 0)
        .groupBy("lang", F.expr("substr(phrase, instr(phrase, ' ') + 1)").alias("phrase"))
        .agg(F.max("a").alias("before"))
    )
    inside = F.coalesce(F.greatest("after", "before"), F.lit(0)) * 100 >= F.col("a") * cover
    left_over = (
        phrases.join(totals.select("lang", "phrase", "after"), ["lang", "phrase"], "left")
        .join(before, ["lang", "phrase"], "left")
        .filter(~inside)
        .select("lang", "phrase", "a")
    )
    words = F.split("phrase", " ")
    cuts = left_over.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, longest), " ").alias("right"),
    )

    def part(name: str, count: str) -> DataFrame:
        return totals.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))

    scored = (
        cuts.join(part("left", "l"), ["lang", "left"])
        .join(part("right", "r"), ["lang", "right"])
        .join(sizes, "lang")
        .withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
