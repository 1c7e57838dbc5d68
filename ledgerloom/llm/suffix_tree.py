"""Language-model scoring by a probabilistic suffix tree over words.

Symbols are words and one end per text. A context of 1 to ``DEPTH`` words that occurs twice is
a candidate state, however large the corpus; one stripe (see ``stripes``) counts what follows
it. A state smooths by taking one off the count of each extension; what that leaves of its
occurrences is shared out as the parent predicts, the state of its context without the first
word::

    P_s(w) = max(n(s w) - 1, 0) / n(s) + left(s) / n(s) * P_parent(w)

down to single words, ``P(w) = (c + 0.5) / (N + 0.5 (V + 1))``, of which none is left out;
all unseen words share the place of one word. So each state is a proper distribution. What
occurs once would be left nothing by the one taken off, so no count that matters is left out.
Divergence test: a state stays if its occurrences are likelier than under its parent by
``DIVERGENCE`` nats each; suffixes of a state stay with it. A word is scored by the state of the
longest suffix of what stands before it.

``fit(..., bounded=True)`` is a smaller model for callers that need one which fits in memory: only
contexts and extensions that occur ``LEAST`` times and make up 1/``SHARE`` of all tokens, and both
divergence tests predict each occurrence with itself left out: an extension is kept if its
occurrences together are likelier than under the parent by ``EXTENSION`` nats.

The logarithm of that probability is a sum of parts, each of which belongs to one n-gram: the
word's own, ``log(left / n)`` of every state met on the way to the longest, and a correction
for each kept extension. Scoring is therefore one lookup of n-grams. The most frequent ones,
``SHARE`` at most, travel to every task.
The others, which grow with the corpus, stay in a table; the texts' rare n-grams, less those
that a filter tells are in no table, are dealt to buckets by their keys and meet them there.
Scoring is one job that reads the texts once: a row's number, which its rare n-grams are summed
by, is never computed twice.

Words and n-grams are 63-bit hashes. Counts are exact but for two words with one hash.
Null texts are empty: one end. Nothing to learn from: every token has probability 1 of being
unseen, so scores are 0. Rows with equal texts get equal scores and each row is kept; texts
are read whole, long ones in slices; other columns are carried, not read. An empty table
gives no rows. The order in which Spark adds numbers may change a score's last digits.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm import stripes
from ledgerloom.llm.common import blocks, text_slices
from ledgerloom.llm.shingles import _word_hashes as word_hashes

DEPTH = 2
LEAST = 50
DIVERGENCE = 0.02
EXTENSION = 3.0
SHARE = 1 << 20
RUN = 1 << 20  # characters hashed at once
BUCKET = 1 << 20  # learned tokens for each bucket of n-grams

END = np.uint64(1)
_KEYS = ["ctx", "segment"]
WHOLE = -1

Keep = Callable[[DataFrame, str], DataFrame]


class Model(NamedTuple):
    values: DataFrame  # key, length (words of the n-gram), n, own and part: log10 shares
    tokens: int
    words: int

    @property
    def unseen(self) -> float:
        return math.log10(0.5 / (self.tokens + 0.5 * (self.words + 1)))


# --- tokens ------------------------------------------------------------------------------


def _words(text: str) -> np.ndarray:
    """Codes of the words; A-Z count as a-z."""
    return word_hashes(text.encode().lower())[1] >> np.uint64(1)


def coded(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of texts: the tokens of all, each closed by its end, and tokens per text."""
    for a, b in blocks([len(t or "") for t in texts], RUN):
        run = [t or "" for t in texts[a:b]]
        if b - a == 1:
            codes = np.concatenate([_words(s) for s in text_slices(run[0])] + [[END]])
            yield codes.astype(np.uint64), np.array([len(codes)])
            continue
        encoded = [t.encode().lower() for t in run]
        starts, codes = word_hashes(b" ".join(encoded))
        at = np.searchsorted(starts, np.cumsum([0] + [len(e) + 1 for e in encoded]))
        yield np.insert(codes >> np.uint64(1), at[1:], END), np.diff(at) + 1


def ngrams(codes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1 to ``most``: the key at each place, and whether it lies in one text."""
    keys, ends = codes, codes == END
    inside = np.ones(len(codes), bool)
    yield keys, inside
    for size in range(2, most + 1):
        if len(keys) < 2:
            return
        keys = stripes.pair_keys(keys[:-1], keys[1:])
        inside = inside[:-1] & ~ends[size - 2 : len(ends) - 1]
        yield keys, inside


def _gathered(batches, block: int) -> Iterator[np.ndarray]:
    """Tokens of whole texts, about ``block`` at a time."""
    held, filled = [], 0
    for batch in batches:
        for codes, _ in coded(batch["text"].to_pylist()):
            held.append(codes)
            filled += len(codes)
            if filled >= block:
                yield np.concatenate(held)
                held, filled = [], 0
    if held:
        yield np.concatenate(held)


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary rows of the values between the offsets."""
    ends = pa.py_buffer((offsets * values.itemsize).astype(np.int32).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, data])


def _ordered(first: np.ndarray, *by: np.ndarray) -> np.ndarray:
    """The order by the last column of ``by``, then the others, then ``first``. Columns of small
    whole numbers are sorted by digits, which is much faster."""
    order = np.argsort(first)
    for column in by:
        if len(column) and column.max() < 1 << 16:
            column = column.astype(np.uint16)
        order = order[np.argsort(column[order], kind="stable")]
    return order


def _held(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Whether each value is one of a few sorted ones."""
    if not len(few):
        return np.zeros(len(values), bool)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


def _sorted_sums(table: pa.Table, columns: list[str]) -> list[np.ndarray]:
    """Distinct ``key`` in order, and sums of the columns over each."""
    keys = table["key"].to_numpy()
    order = np.argsort(keys)
    first = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)[: len(keys)])
    sums = [table[c].to_numpy()[order] for c in columns]
    if len(first):
        sums = [np.add.reduceat(x, first) for x in sums]
    return [keys[order][first], *sums]


# --- learning ----------------------------------------------------------------------------


def word_counts(texts: DataFrame, block: int) -> DataFrame:
    """(key, n) of every word and of the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _gathered(batches, block):
            keys, n = np.unique(codes, return_counts=True)
            for a in range(0, len(keys), stripes.BATCH):
                yield pa.RecordBatch.from_pydict(
                    {"key": keys[a : a + stripes.BATCH].view(np.int64), "n": n[a : a + stripes.BATCH]}
                )

    return (
        texts.select("text")
        .mapInArrow(run, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )


def context_stripes(
    texts: DataFrame, size: int, bits: np.ndarray, hot: set[int], segments: int, block: int
) -> DataFrame:
    """Per block and context of ``size`` words: keys of the n-grams one word on, and counts.

    What follows context ``u v`` as ``w`` is kept as the key of ``v w``, the same extension
    of the shorter context.
    """
    common = np.array(sorted(hot), np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast((bits, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, common = shared.value
        for codes in _gathered(batches, block):
            levels = list(ngrams(codes, size + 1))
            if len(levels) <= size:
                continue
            context, (key, inside) = levels[size - 1][0], levels[size]
            may = stripes.may_hold(bits, context)
            at = np.flatnonzero(inside & may[:-1])
            if not len(at):
                continue
            # What follows counts by itself if it may be frequent without the first word.
            own = at[may[at + 1]]
            _, first, n = np.unique(key[own], return_index=True, return_counts=True)
            ctx, lower = context[own[first]], context[own[first] + 1]
            every, total = np.unique(context[at], return_counts=True)
            place = np.searchsorted(every, ctx)
            others = total - np.bincount(place, n, len(every)).astype(np.int64)
            cut = np.isin(every, common)
            segment = np.where(cut[place], (lower % np.uint64(segments)).astype(np.int64), WHOLE)
            # The rest of a context's occurrences, in one row of it.
            ctx, n = np.concatenate([ctx, every]), np.concatenate([n, others])
            segment = np.concatenate([segment, np.where(cut, 0, WHOLE)])
            counted = np.arange(len(ctx)) < len(lower)
            lower = np.concatenate([lower, np.zeros(len(every), np.uint64)])
            order = np.lexsort((segment, ctx))
            ctx, lower, n = ctx[order], lower[order], n[order]
            segment, counted = segment[order], counted[order]
            new = np.ones(len(ctx), bool)
            new[1:] = (ctx[1:] != ctx[:-1]) | (segment[1:] != segment[:-1])
            starts = np.flatnonzero(new)
            total = np.add.reduceat(n, starts)
            ends = np.concatenate([[0], np.cumsum(np.add.reduceat(counted.astype(np.int64), starts))])
            lower, n = lower[counted], n[counted]
            for a in range(0, len(starts), stripes.BATCH):
                b = min(a + stripes.BATCH, len(starts))
                low, high = ends[a], ends[b]
                offsets = ends[a : b + 1] - low
                yield pa.RecordBatch.from_pydict(
                    {
                        "ctx": ctx[starts[a:b]].view(np.int64),
                        "segment": segment[starts[a:b]].astype(np.int32),
                        "total": total[a:b],
                        "following": stripes.packed_longs(lower[low:high].view(np.int64), offsets),
                        "n": stripes.packed_longs(n[low:high], offsets),
                    }
                )

    kind = "ctx long, segment int, total long, following binary, n binary"
    return texts.select("text").mapInArrow(run, kind)


def _extended(found: DataFrame) -> DataFrame:
    """One row per counted extension, with the key of the whole n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = batch["next"].value_lengths().to_numpy()
            lower = batch["next"].flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), owner)
            ctx = batch["ctx"].to_numpy()[row]
            yield pa.RecordBatch.from_pydict(
                {
                    "ctx": ctx,
                    "lower": lower,
                    "key": stripes.pair_keys(ctx.view(np.uint64), lower.view(np.uint64)).view(np.int64),
                    "n": batch["n"].flatten(),
                    "c": batch["c"].to_numpy()[row],
                    "free": batch["free"].to_numpy()[row],
                }
            )

    kind = "ctx long, lower long, key long, n long, c long, free long"
    return found.select("ctx", "next", "n", "c", "free").mapInArrow(run, kind)


def repeated(
    texts: DataFrame, size: int, candidates: DataFrame, bits: np.ndarray, hot: dict[int, int],
    buckets: int, block: int,
) -> DataFrame:
    """(ctx, lower, key, n, c, gone) of every extension of a context of ``size`` words that occurs
    twice: ``c`` is what the context occurs, ``gone`` what is taken off it, one less than the
    count of each of its extensions; null for hot contexts, which lie in many buckets.

    Each block of tokens gives one packed row per bucket of contexts, where counts meet.
    """
    common = np.array(sorted(hot), np.uint64)
    of_common = np.array([hot[k] for k in sorted(hot)], np.int64)
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _gathered(batches, block):
            levels = list(ngrams(codes, size + 1))
            if len(levels) <= size:
                continue
            context, (key, inside) = levels[size - 1][0], levels[size]
            may = stripes.may_hold(shared.value, context)
            own = np.flatnonzero(inside & may[:-1] & may[1:])
            if not len(own):
                continue
            own = own[np.argsort(key[own])]
            first = np.flatnonzero(np.append(True, np.diff(key[own]) != 0))
            n = np.diff(np.append(first, len(own))).astype(np.int32)
            ctx, lower = context[own[first]], context[own[first] + 1]
            bucket = (np.where(_held(ctx, common), lower, ctx) % np.uint64(buckets)).astype(np.int32)
            order = _ordered(ctx, bucket)
            ctx, lower, bucket, n = ctx[order], lower[order], bucket[order], n[order]
            new = np.ones(len(ctx), bool)
            new[1:] = (ctx[1:] != ctx[:-1]) | (bucket[1:] != bucket[:-1])
            first = np.flatnonzero(new)
            kinds = np.diff(np.append(first, len(ctx))).astype(np.int32)
            some, starts = np.unique(bucket, return_index=True)
            offsets = np.append(starts, len(ctx))
            owners = np.searchsorted(first, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some),
                    _packed(ctx[first], owners),
                    _packed(kinds, owners),
                    _packed(lower, offsets),
                    _packed(n, offsets),
                ],
                names=["bucket", "ctx", "kinds", "lower", "n"],
            )

    def merged(found: pa.Table, counts: pa.Table) -> pa.Table:
        ctx, kinds, lower, n = (
            np.frombuffer(b"".join(found[c].to_pylist()), kind)
            for c, kind in (("ctx", "<u8"), ("kinds", "<i4"), ("lower", "<u8"), ("n", "<i4"))
        )
        ctx = np.repeat(ctx, kinds)
        key = stripes.pair_keys(ctx, lower)
        order = np.argsort(key)
        first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)[: len(key)])
        n = np.add.reduceat(n[order].astype(np.int64), first) if len(first) else n.astype(np.int64)
        order, n = order[first][n > 1], n[n > 1]
        ctx, lower, key = ctx[order], lower[order], key[order]
        known, c = _sorted_sums(counts, ["n"])
        known, c = np.append(known.view(np.uint64), common), np.append(c, of_common)
        known, at = np.unique(known, return_index=True)
        c = c[at][np.searchsorted(known, ctx)] if len(ctx) else np.zeros(0, np.int64)
        _, owner = np.unique(ctx, return_inverse=True)
        gone = np.bincount(owner, n - 1).astype(np.int64)[owner] if len(ctx) else c
        keys = [pa.array(x.view(np.int64)) for x in (ctx, lower, key)]
        gone = pa.array(gone, mask=_held(ctx, common))
        return pa.table([*keys, pa.array(n), pa.array(c), gone], names=names)

    names = ["ctx", "lower", "key", "n", "c", "gone"]
    kind = "bucket int, ctx binary, kinds binary, lower binary, n binary"
    found = texts.select("text").mapInArrow(run, kind)
    counts = candidates.select((F.col("key") % buckets).cast("int").alias("bucket"), "key", "n")
    return (
        found.groupBy("bucket")
        .cogroup(counts.groupBy("bucket"))
        .applyInArrow(merged, ", ".join(f"{name} long" for name in names))
    )


def _every(
    found: DataFrame, parent: DataFrame, any_hot: bool, last: bool, divergence: float, keep: Keep
) -> tuple:
    """Extensions with their probability and part, and states, of which those of little divergence
    are ``weak``.

    ``found`` is from ``repeated``; ``parent`` has (lower, below): the parent's probability of
    each extension. Suffixes of the longest ones are not asked for.
    """
    n, c, free = F.col("n"), F.col("c"), F.col("free")
    joined = found.join(parent, "lower")
    extensions = keep(joined.drop("lower") if last else joined, "extensions")
    if any_hot:
        cut = extensions.filter(F.col("gone").isNull()).groupBy("ctx").agg(F.sum(n - 1).alias("all"))
        extensions = extensions.join(keep(cut, "cut"), "ctx", "left")
        extensions = extensions.withColumn("gone", F.coalesce("gone", "all")).drop("all")
    freed = F.log10(free / c)
    extensions = (
        extensions.withColumn("free", c - F.col("gone"))
        .withColumn("p", (n - 1) / c + free / c * F.col("below"))
        .withColumn("part", F.log10("p") - freed - F.log10("below"))
    )
    states = extensions.groupBy("ctx").agg(
        F.max("c").alias("c"),
        F.max("free").alias("free"),
        F.count("*").alias("kinds"),
        F.sum(n * (F.col("part") + freed)).alias("gain"),
    )
    gain = (F.col("gain") + (free - F.col("kinds")) * freed) * math.log(10)
    weak = (gain / c < divergence).alias("weak")
    return extensions, keep(states.select("ctx", "c", "free", weak), "states")


def _tree(levels: list[tuple], counts: DataFrame, own: Column, keep: Keep) -> DataFrame:
    """Values of words, of the states that stay and of their extensions, which may share a key.

    Few states go, so those are what is joined.
    """
    gone: dict[int, DataFrame] = {}
    for size in range(len(levels), 0, -1):
        extensions, states = levels[size - 1]
        weak = states.filter("weak").select("ctx")
        if size < len(levels):
            # Suffixes of states stay.
            longer = levels[size][1].join(gone[size + 1], "ctx", "left_anti")
            ends = extensions.select(F.col("key"), F.col("lower").alias("ctx")).join(weak, "ctx", "left_semi")
            needed = ends.join(longer.select(F.col("ctx").alias("key")), "key", "left_semi")
            weak = weak.join(needed, "ctx", "left_anti")
        gone[size] = keep(weak, f"weak{size}")
    nothing = F.lit(0.0)
    parts = [
        counts.select("key", F.lit(1).alias("length"), "n", own.alias("own"), nothing.alias("part"))
    ]
    for size, (extensions, states) in enumerate(levels, 1):
        freed = F.log10(F.col("free") / F.col("c"))
        states, kept = (df.join(gone[size], "ctx", "left_anti") for df in (states, extensions))
        parts.append(
            states.select(
                F.col("ctx").alias("key"), F.lit(size).alias("length"), F.col("c").alias("n"),
                nothing.alias("own"), freed.alias("part"),
            )
        )
        parts.append(kept.select("key", F.lit(size + 1).alias("length"), "n", nothing.alias("own"), "part"))
    return reduce(DataFrame.unionByName, parts)


def _level(found: DataFrame, parent: DataFrame, least: int, keep: Keep) -> tuple:
    """The same for a bounded model: extensions that are not kept have no part.

    ``parent`` has (lower, below): the parent's probability of each extension. Extensions that
    are not kept stay in the table: longer contexts need what they are predicted with.
    """
    inside = F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y)
    states = (
        found.groupBy("ctx")
        .agg(
            F.sum("total").alias("c"),
            F.sum(inside).alias("inside"),
            F.sum(F.size("next")).cast("long").alias("extensions"),
        )
        .filter(F.col("c") >= least)
        .select("ctx", "c", (F.col("c") - F.col("inside") + F.col("extensions")).alias("free"))
    )
    n, c, below = F.col("n"), F.col("c"), F.col("below")

    def left_out(free: Column) -> Column:
        return (n - 2) / (c - 1) + free / (c - 1) * below

    rows = _extended(found.join(states, "ctx")).join(parent, "lower")
    kept = n * F.log(left_out(F.col("free")) / below) >= EXTENSION
    rows = keep(rows.withColumn("kept", kept).drop("free"), "extensions")
    held = rows.filter("kept").groupBy("ctx").agg(F.sum("n").alias("held"), F.count("*").alias("kinds"))
    held_n = F.coalesce("held", F.lit(0))
    free = (c - held_n + F.coalesce("kinds", F.lit(0))).alias("free")
    states = keep(states.select("ctx", "c").join(held, "ctx", "left").select(
        "ctx", "c", free, (c - held_n).alias("others")
    ), "candidates")
    own = F.when(F.col("kept"), (n - 1) / c).otherwise(0.0)
    above = F.log10("p") - F.log10(F.col("free") / F.col("c")) - F.log10("below")
    extensions = keep(
        rows.join(states.select("ctx", "free"), "ctx")
        .withColumn("p", own + F.col("free") / c * below)
        .withColumn("part", F.when(F.col("kept"), above)),
        "extensions",
    )
    gains = (
        extensions.filter("kept")
        .groupBy("ctx")
        .agg(F.sum(n * F.log(left_out(F.col("free")) / below)).alias("gain"))
    )
    alone = F.log(F.greatest(F.col("free") - 1, F.lit(0.5)) / F.greatest(c - 1, F.lit(1)))
    gain = F.coalesce("gain", F.lit(0.0)) + F.col("others") * alone
    states = states.join(gains, "ctx", "left").select(
        "ctx", "c", "free", (gain / c).alias("divergence")
    )
    return extensions, keep(states, "states")


def fit(
    texts: DataFrame,
    keep: Keep,
    depth: int = DEPTH,
    least: int = LEAST,
    divergence: float = DIVERGENCE,
    block: int = stripes.BLOCK,
    bounded: bool = True,
) -> Model:
    """Learn from the column ``text``. ``keep(df, name)`` stores a table and reads it.

    ``least`` is for bounded models; else it is two.
    """
    segments = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = keep(word_counts(texts, block), "words")
    tokens, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    chance = (F.col("n") + 0.5) / (tokens + 0.5 * (words + 1))
    parent = counts.select(F.col("key").alias("lower"), chance.alias("below"))
    # The end is no context, but may follow one.
    candidates = counts
    least = max(least, tokens // SHARE + 1) if bounded else 2
    levels = []
    for size in range(1, depth + 1):
        candidates = candidates.filter(F.col("n") >= least).select("key", "n")
        bits = stripes.filter_of(candidates.select("key"))
        if not bits.any():
            break
        # Fewer than HOT: counts of n-grams of one length add up to ``tokens`` at most.
        hot = candidates.filter(F.col("n") * stripes.HOT > tokens).select("key", "n").collect()
        if bounded:
            partial = context_stripes(texts, size, bits, {r[0] for r in hot}, segments, block)
            found = keep(stripes.merge(partial, _KEYS, least, least, words=False), f"stripes{size}")
            levels.append(_level(found, parent, least, keep))
        else:
            buckets = tokens // BUCKET + 1
            found = repeated(texts, size, candidates, bits, dict(map(tuple, hot)), buckets, block)
            levels.append(_every(found, parent, bool(hot), size == depth, divergence, keep))
        extensions = levels[-1][0]
        parent = extensions.select(F.col("key").alias("lower"), F.col("p").alias("below"))
        candidates = extensions

    own = F.log10(chance)
    if not bounded:
        return Model(_tree(levels, counts, own, keep), tokens, words)
    parts = [
        counts.select("key", F.lit(1).alias("length"), "n", own.alias("own"), F.lit(0.0).alias("part"))
    ]
    needed = None  # suffixes of states one word longer
    for size in range(len(levels), 0, -1):
        extensions, states = levels[size - 1]
        stay = F.col("divergence") >= divergence
        if needed is not None:
            states = states.join(needed.withColumn("needed", F.lit(True)), "ctx", "left")
            stay = stay | F.col("needed").isNotNull()
        states = keep(states.filter(stay).select("ctx", "c", "free"), f"tree{size}")
        if size > 1:
            shorter = levels[size - 2][0].select(F.col("key").alias("ctx"), "lower")
            needed = states.join(shorter, "ctx").select(F.col("lower").alias("ctx")).distinct()
        freed = F.log10(F.col("free") / F.col("c"))
        nothing = F.lit(0.0).alias("own")
        parts.append(
            states.select(
                F.col("ctx").alias("key"), F.lit(size).alias("length"), F.col("c").alias("n"),
                nothing, freed.alias("part"),
            )
        )
        kept = extensions.filter(F.col("part").isNotNull())
        parts.append(
            kept.join(states.select("ctx"), "ctx", "left_semi").select(
                "key", F.lit(size + 1).alias("length"), "n", nothing, "part"
            )
        )
    values = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("key", "length")
        .agg(F.max("n").alias("n"), F.sum("own").alias("own"), F.sum("part").alias("part"))
    )
    return Model(keep(values, "values"), tokens, words)


# --- scoring -----------------------------------------------------------------------------


class Head(NamedTuple):
    """Values at hand in every task: those with counts above ``below``."""

    below: int
    longer: int  # values of two words or more, at hand or not
    more: bool  # some of those are not


def _head(model: Model) -> Head:
    """The most frequent values, ``SHARE`` at most."""
    # Counts of n-grams of one length add up to ``tokens`` at most, and a state's value goes
    # beside its n-gram's; so fewer than ``SHARE`` values have counts above this.
    most = 2 * (DEPTH + 1) * model.tokens // SHARE + 1
    n = F.least("n", F.lit(most)).alias("n")
    found = model.values.groupBy(n, (F.col("length") > 1).alias("longer")).count().collect()
    below, room = most, SHARE
    by_n = Counter()
    for r in found:
        by_n[r["n"]] += r["count"]
    for times in sorted(by_n, reverse=True):
        room -= by_n[times]
        if room < 0:
            break
        below = times - 1
    longer = [r for r in found if r["longer"]]
    return Head(below, sum(r["count"] for r in longer), any(r["n"] <= below for r in longer))


def _lookup(docs: DataFrame, model: Model, at_hand: Head, longest: int, buckets: int) -> DataFrame:
    """Per row what the common n-grams add up to, in ``sums``; and per run of rows and bucket
    the rare ones: ``steps`` from row to row of the run, ``keys`` and ``times``."""
    common = F.col("n") > at_hand.below
    head = model.values.filter(common).select("key", "own", "part").toArrow()
    arrays = _sorted_sums(head, ["own", "part"])
    arrays[0] = arrays[0].view(np.uint64)
    # Which n-grams of two words or more to look up at all, and whether any is not in the head.
    longer, more = model.values.filter("length > 1").select("key"), at_hand.more
    bits = stripes.filter_of(longer, at_hand.longer)
    shared = docs.sparkSession.sparkContext.broadcast((arrays, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, own, part), bits = shared.value
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            done = 0
            texts = batch["text"].to_pylist()
            longs, doubles = [pa.int64()] * 2, [pa.float64()] * 2
            kind = pa.struct(list(zip(told.names, [batch["row"].type, *longs, *doubles])))
            for codes, sizes in coded(texts):
                rows = len(sizes)
                ends = np.cumsum(sizes)
                owner = np.repeat(np.arange(rows), sizes)
                sums, hits = np.zeros((2, rows)), np.zeros(rows, np.int64)
                rest = []
                for size, (keys, inside) in enumerate(ngrams(codes, longest), 1):
                    if size > 1:
                        inside = inside & stripes.may_hold(bits, keys)
                    at = np.flatnonzero(inside)
                    key, row = keys[at], owner[at]
                    met = np.zeros(len(key), bool)
                    if len(known):
                        spot = np.minimum(np.searchsorted(known, key), len(known) - 1)
                        met = known[spot] == key
                        for total, share in zip(sums, (own, part)):
                            total += np.bincount(row[met], share[spot[met]], rows)
                    if size == 1:
                        hits += np.bincount(row[met], minlength=rows)
                    if size == 1 or more:
                        rest.append((row[~met], key[~met]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(((place + np.arange(rows)) % buckets).astype(np.int32)),
                        pa.array(place + np.arange(rows)),
                        *[pa.nulls(rows, pa.binary())] * 3,
                        pa.StructArray.from_arrays(
                            [
                                batch["row"].slice(done, rows),
                                pa.array(sizes.astype(np.int64)),
                                pa.array(hits),
                                pa.array(sums[0]),
                                pa.array(sums[1]),
                            ],
                            names=told.names,
                        ),
                    ],
                    names=names,
                )
                row, key = (np.concatenate(x) for x in zip(*rest))
                bucket = (key % np.uint64(buckets)).astype(np.int32)
                order = _ordered(key, row, bucket)
                bucket, row, key = bucket[order], row[order], key[order]
                new = np.ones(len(key), bool)
                new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(key))).astype(np.int32)
                bucket, row, key = bucket[first], row[first].astype(np.int32), key[first]
                some, starts = np.unique(bucket, return_index=True)
                offsets = np.append(starts, len(bucket))
                steps = np.diff(row, prepend=np.int32(0))
                steps[starts] = row[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some),
                        pa.array(np.full(len(some), place)),
                        *[_packed(x, offsets) for x in (steps, key, times)],
                        pa.nulls(len(some), kind),
                    ],
                    names=names,
                )
                done += rows
                place += rows

    told = docs.select("row").schema.add("n_tokens", "long").add("hits", "long")
    told = told.add("own", "double").add("part", "double")
    schema = StructType().add("bucket", "integer").add("place", "long")
    schema = schema.add("steps", "binary").add("keys", "binary").add("times", "binary")
    schema = schema.add("sums", told)
    names = schema.names
    return docs.select("row", "text").mapInArrow(run, schema)


def _dealt(values: DataFrame, buckets: int) -> DataFrame:
    """Values packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filled = [], 0
        for batch in batches:
            held.append(batch)
            filled += batch.num_rows
            if filled >= RUN:
                yield packed(held)
                held, filled = [], 0
        if filled:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        bucket = (rows["key"].to_numpy() % buckets).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        some, starts = np.unique(bucket[order], return_index=True)
        offsets = np.append(starts, len(order))
        columns = [rows[c].to_numpy()[order] for c in ("key", "word", "own", "part")]
        return pa.RecordBatch.from_arrays(
            [pa.array(some), *[_packed(c, offsets) for c in columns]],
            names=["bucket", "key", "word", "own", "part"],
        )

    # Only words have a probability of their own; a state of one word shares its key.
    word = (F.col("own") < 0).cast("int").alias("word")
    kind = "bucket int, key binary, word binary, own binary, part binary"
    return values.select("key", word, "own", "part").mapInArrow(run, kind)


def _added(found: pa.Table, rare: pa.Table) -> pa.Table:
    """What the rare n-grams of one bucket add to each row, and the rows' ``sums`` as they are."""
    out = []
    told = found.filter(found["sums"].is_valid())
    if told.num_rows:
        zero = np.zeros(told.num_rows)
        columns = [told["place"], told["sums"], zero.astype(np.int64), zero, zero]
        out.append(pa.table(columns, names=_ADDED))
    met = found.filter(found["keys"].is_valid())
    if met.num_rows and rare.num_rows:
        kinds = {"key": "<i8", "word": "<i4", "own": "<f8", "part": "<f8"}
        unpacked = {c: np.frombuffer(b"".join(rare[c].to_pylist()), k) for c, k in kinds.items()}
        known, word, own, part = _sorted_sums(pa.table(unpacked), ["word", "own", "part"])
        steps, keys, times = (
            np.frombuffer(b"".join(met[c].to_pylist()), kind)
            for c, kind in (("steps", "<i4"), ("keys", "<i8"), ("times", "<i4"))
        )
        lengths = np.array([len(k) // 8 for k in met["keys"].to_pylist()])
        starts = np.cumsum(lengths) - lengths
        place = np.cumsum(steps, dtype=np.int64)
        place += np.repeat(met["place"].to_numpy() - place[starts] + steps[starts], lengths)
        spot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        held = np.flatnonzero(known[spot] == keys)
        spot, times = spot[held], times[held]
        rows, row = np.unique(place[held], return_inverse=True)
        hits, own, part = (np.bincount(row, v[spot] * times, len(rows)) for v in (word, own, part))
        nothing = pa.nulls(len(rows), found["sums"].type)
        columns = [rows, nothing, hits.astype(np.int64), own, part]
        out.append(pa.table(columns, names=_ADDED))
    if out:
        return pa.concat_tables(out)
    empty = [found["place"][:0], found["sums"][:0], np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
    return pa.table(empty, names=_ADDED)


_ADDED = ["place", "sums", "hits", "own", "part"]


def score(
    docs: DataFrame, model: Model, columns: list[str], longest: int = DEPTH + 1
) -> DataFrame:
    """(row, n_tokens, n_known, base_score, score) of every row of ``docs``.

    ``row`` holds ``columns``. Both scores are log10 probabilities: of single words, and of
    the tree's states.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    buckets = model.tokens // BUCKET + 1
    at_hand = _head(model)
    found = _lookup(rows, model, at_hand, longest, buckets)
    rare = _dealt(model.values.filter(F.col("n") <= at_hand.below), buckets)
    kind = found.select("place", "sums").schema
    kind = kind.add("hits", "long").add("own", "double").add("part", "double")
    summed = (
        found.groupBy("bucket")
        .cogroup(rare.groupBy("bucket"))
        .applyInArrow(_added, kind)
        .groupBy("place")
        .agg(
            F.first("sums", ignorenulls=True).alias("sums"),
            *[F.sum(c).alias(c) for c in ("hits", "own", "part")],
        )
    )
    hits = F.col("sums.hits") + F.col("hits")
    base = F.col("sums.own") + F.col("own") + (F.col("sums.n_tokens") - hits) * model.unseen
    return summed.select(
        "sums.row",
        "sums.n_tokens",
        hits.alias("n_known"),
        base.alias("base_score"),
        # Parts that cancel may leave a last digit above a probability of 1.
        F.least(base + F.col("sums.part") + F.col("part"), F.lit(0.0)).alias("score"),
    )
