"""Stripes: for each prefix one counter of what follows it.

A task counts a block of tokens at a time, with exact ids of its own, and emits one row per
prefix: what follows it (words joined by blanks, or integer keys) and how often. Rows of one
prefix then meet in a sorted partition, where their counters are added elementwise as a
stream; no prefix is ever held by more than one open row. Prefixes that hold more than
1/``HOT`` of all tokens (so fewer than ``HOT`` of them) are cut into segments by what
follows, so that no task gets all of a common one.

Filters of bits, bounded by ``MOST_BITS``, tell tasks which phrases may matter. They only
save work: a phrase that passes by chance is counted like the others and dropped exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

BLOCK = 1 << 21  # tokens counted at once
HOT = 1000
LEAST_BITS, MOST_BITS = 16, 27  # 16 MB
BITS_PER_KEY = 16
BATCH = 1 << 14  # rows of one Arrow batch

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(29))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Non-negative 63-bit keys (as unsigned) of ordered pairs of keys."""
    return mixed(mixed(first + _ODD) * _ODD + second) >> np.uint64(1)


def phrase_keys(words: list[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """Keys of phrases from the codes of their first, second, ... words."""
    out = words[0]
    for w in words[1:]:
        out = pair_keys(out, w)
    return mixed(out + seed * _ODD) >> np.uint64(1)


# --- filters -----------------------------------------------------------------------------


def filter_of(keys: DataFrame, rows: int | None = None) -> np.ndarray:
    """Bits of the column ``key`` (63-bit longs); tests by ``may_hold``. ``rows`` counts them, if
    known."""
    rows = keys.count() if rows is None else rows
    bits = min(max((rows * BITS_PER_KEY).bit_length(), LEAST_BITS), MOST_BITS)
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    # At most 2^MOST_BITS / 64 rows.
    found = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).cast("int").alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(len(bits) * 64 - 1)
    found = bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))
    return (found & np.uint64(1)).astype(bool)


# --- merging -----------------------------------------------------------------------------


def runs(key_columns: list[pa.Array]) -> np.ndarray:
    """Starts of runs of equal rows; nulls are equal."""
    n = len(key_columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in key_columns:
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _merged_rows(batch: pa.RecordBatch, keys: list[str], flatten) -> tuple[pa.Table, np.ndarray]:
    """(group, next, n) summed, ordered by group; and the groups' first rows."""
    starts = runs([batch[k] for k in keys])
    group = np.zeros(batch.num_rows, np.int64)
    group[starts[1:]] = 1
    group = group.cumsum()
    following, owner = flatten(batch["following"])
    n = np.frombuffer(b"".join(batch["n"].to_pylist()), "<i8")
    pairs = pa.table({"group": group[owner], "next": following, "n": n})
    pairs = pairs.group_by(["group", "next"]).aggregate([("n", "sum")]).sort_by("group")
    return pairs.rename_columns(["group", "next", "n"]), starts


def words_flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of blank-joined rows (null: none) and the row of each."""
    lists = pc.split_pattern(column, " ")
    owner = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    return lists.flatten(), owner


def words_packed(words: pa.Array, offsets: np.ndarray) -> pa.Array:
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words)
    return pc.if_else(
        pa.array(offsets[1:] > offsets[:-1]), pc.binary_join(lists, " "), pa.scalar(None, pa.string())
    )


def keys_flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """64-bit keys of binary rows and the row of each."""
    rows = column.to_pylist()
    sizes = np.array([len(r) // 8 for r in rows], np.int64)
    flat = np.frombuffer(b"".join(rows), "<i8")
    return pa.array(flat), np.repeat(np.arange(len(rows)), sizes)


def packed_longs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary rows of little-endian 64-bit integers."""
    data = np.ascontiguousarray(values, "<i8").tobytes()
    ends = pa.py_buffer(np.ascontiguousarray(offsets * 8, np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(data)])


def merge(
    partial: DataFrame, keys: list[str], least: int, keep_total: int, words: bool
) -> DataFrame:
    """Add up stripes: (keys..., total, best, next, n) with counts of ``least`` or more.

    ``partial`` holds the keys (the last one is the segment, -1 for a prefix in one piece),
    ``total``, ``following`` (words, else 64-bit keys) and ``n``. ``best`` is the largest count. Stripes whose total stays below ``keep_total`` are
    dropped unless they are a segment of a prefix that was cut.
    """
    flatten, pack = (words_flat, words_packed) if words else (keys_flat, packed_longs)
    names = [*keys, "total", "following", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.RecordBatch | None = None

        def emit(batch: pa.RecordBatch, last: bool):
            """Finished groups as a batch, and the unfinished last one as a merged row."""
            pairs, starts = _merged_rows(batch, keys, flatten)
            group, n = pairs["group"].to_numpy(), pairs["n"].to_numpy()
            total = np.add.reduceat(batch["total"].to_numpy(), starts)
            offsets = np.searchsorted(group, np.arange(len(starts) + 1))
            following = pairs["next"].combine_chunks()
            open_row = None
            done = len(starts)
            if not last:
                done -= 1
                a, b = offsets[done], offsets[done + 1]
                part = following[a:b] if words else following.to_numpy()[a:b]
                row = batch.slice(int(starts[done]), 1)
                open_row = pa.RecordBatch.from_arrays(
                    [row[k] for k in keys]
                    + [
                        pa.array([total[done]], pa.int64()),
                        pack(part, np.array([0, b - a])),
                        packed_longs(n[a:b], np.array([0, b - a])),
                    ],
                    names=names,
                )
            best = np.zeros(len(starts), np.int64)
            np.maximum.at(best, group, n)
            cut = batch[keys[-1]].to_numpy()[starts] >= 0
            chosen = np.flatnonzero(((total >= keep_total) | cut)[:done])
            enough = (n >= least) & np.isin(group, chosen)
            sizes = np.bincount(group[enough], minlength=len(starts))[chosen]
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            index = np.flatnonzero(enough)
            out = pa.RecordBatch.from_arrays(
                [batch[k].take(pa.array(starts[chosen])) for k in keys]
                + [
                    pa.array(total[chosen]),
                    pa.array(best[chosen]),
                    pa.ListArray.from_arrays(ends, following.take(pa.array(index))),
                    pa.ListArray.from_arrays(ends, pa.array(n[index])),
                ],
                names=[*keys, "total", "best", "next", "n"],
            )
            return out, open_row

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(names)
            if carry is not None:
                batch = pa.concat_batches([carry, batch.cast(carry.schema)])
            out, carry = emit(batch, False)
            if out.num_rows:
                yield out
        if carry is not None:
            out, _ = emit(carry, True)
            if out.num_rows:
                yield out

    kind = StringType() if words else LongType()
    schema = partial.select(*keys).schema.add("total", "long").add("best", "long")
    schema = schema.add("next", ArrayType(kind)).add("n", ArrayType(LongType()))
    return (
        partial.select(*names)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(run, schema)
    )

