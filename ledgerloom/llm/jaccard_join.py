"""Exact n-gram Jaccard join, grouped by prefix, with components of linked documents.

1. Every document's set of word shingles is hashed; equal sets are one class.
2. Classes send their shingles by hash range to be counted and get back those that other
   classes hold too. Shingles in a large share of documents are found beforehand (a list
   bounded by the mean set size over that share) and counted as most common without moving.
3. In the order (number of holders, hash), with shingles nobody else holds first, a class's
   prefix is short enough that two linked classes share a prefix shingle. A class whose
   prefix nobody shares is finished.
4. Classes whose prefixes meet, directly or over others, form a cluster. A cluster is cut
   into blocks by set size and a task compares two blocks: classes of one prefix and size
   are one group, pairs of groups pass the length and the positional bound, then their
   members are expanded and verified by exact intersection sizes.
5. Components of the verified links give each class the smallest document id.

Sets are compared as 60-bit hashes. Null text, or text without words, has an empty set and
no links. Repeated rows are copies, linked when not empty. Rows with a null id take part but
cannot name a component. Only ``doc_id`` and ``text`` are read. A text of any length is
hashed whole in one task. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import TOKEN_BITS, digest, shingle_sets
from ledgerloom.operators.ranking import ranked
from ledgerloom.scratch import Scratch

BLOCK_DOCS, BLOCK_TOKENS = 4096, 1 << 21  # classes numbered together
COMMON = 1 / 500  # a shingle in more of the documents than this is not moved
RANGE_TOKENS = 1 << 15  # shingles counted together, about
LEAST_RANGE_BITS = 2
CLUSTER_BLOCK = 1024  # classes on each side of a comparison task
SMALL_TASK = 512  # classes of small clusters compared in one task
COMPARED = 256  # rows and columns of one intersection matrix
_MOST = np.iinfo(np.int32).max


class Law(NamedTuple):
    """Linked when ``100 * intersection >= percent * union``."""

    percent: int

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))


def _sets(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield part, list(shingle_sets(part["text"].to_pylist(), size))


def _scan(size: int):
    """Documents with their class, and shingles common in a block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        docs = tokens = 0

        def common() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= max(8, docs * COMMON / 2)
            return row_batch(
                token=pa.array(found[often].astype(np.int64)), times=pa.array(times[often])
            )

        def row_batch(**columns: pa.Array) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays(
                [columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema
            )

        schema = None
        for part, sets in _sets(batches, size):
            schema = schema or pa.schema(
                [
                    ("doc_id", part.schema.field("doc_id").type),
                    ("n", pa.int64()),
                    ("cls", pa.binary()),
                    ("token", pa.int64()),
                    ("times", pa.int64()),
                ]
            )
            yield row_batch(
                doc_id=part["doc_id"],
                n=pa.array([len(s) for s in sets], pa.int64()),
                cls=pa.array([digest(s) for s in sets], pa.binary()),
            )
            held += sets
            docs, tokens = docs + len(sets), tokens + sum(map(len, sets))
            if docs >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                yield common()
                held, docs, tokens = [], 0, 0
        if docs:
            yield common()

    return run


# Rows of the counting shuffle: shingles to count, those known to be common, and the
# classes of a block.
_POSTINGS, _HOT, _CLASSES = 0, 1, 2
_MOVED = "range long, block long, kind int, a binary, b binary"


def _send(size: int, hot, range_bits: int):
    width = -(-(TOKEN_BITS - range_bits) // 8)
    shift = np.uint64(TOKEN_BITS - range_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = hot.value
        task = TaskContext.get().partitionId()
        block = task << 32
        known: dict[bytes, int] = {}
        sets: list[np.ndarray] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal known, sets, tokens, block
            sizes = np.array([len(s) for s in sets], np.int64)
            token = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets), dtype="<u2"), sizes)
            at = np.minimum(np.searchsorted(common, token), max(len(common) - 1, 0))
            is_hot = common[at] == token if len(common) else np.zeros(len(token), bool)
            # Rows that only pass through are spread over the ranges.
            home = (task + 7919 * (block & 0xFFFFFFFF)) % (1 << range_bits)
            rows = [
                (home, _CLASSES, b"".join(known), sizes.astype("<i8").tobytes()),
                (home, _HOT, token[is_hot].astype("<u8").tobytes(), owner[is_hot].tobytes()),
            ]
            token, owner = token[~is_hot], owner[~is_hot]
            order = np.argsort(token)
            token, owner = token[order], owner[order]
            ranges = (token >> shift).astype(np.int64)
            cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
            low = token.astype("<u8").view(np.uint8).reshape(-1, 8)
            rows += [
                (int(ranges[p]), _POSTINGS, low[p:q, :width].tobytes(), owner[p:q].tobytes())
                for p, q in zip(cuts, [*cuts[1:], len(token)])
            ]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                names=["range", "block", "kind", "a", "b"],
            )
            known, sets, tokens, block = {}, [], 0, block + 1
            return out

        for _, found in _sets(batches, size):
            for s in found:
                name = digest(s)
                if len(s) and name not in known:
                    known[name] = len(known)
                    sets.append(s)
                    tokens += len(s)
                    if len(sets) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                        yield flush()
        if sets:
            yield flush()

    return run


_RETURNED = "block long, kind int, a binary, b binary, c binary"


def _count(range_bits: int):
    """Send the shingles that several classes hold back to their blocks, with the number."""
    width = -(-(TOKEN_BITS - range_bits) // 8)
    low_bits = np.uint64((1 << (TOKEN_BITS - range_bits)) - 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        passed = pdf[pdf["kind"] != _POSTINGS]
        out = [
            passed[["block", "kind", "a", "b"]].assign(c=b""),
        ]
        pdf = pdf[pdf["kind"] == _POSTINGS]
        if len(pdf):
            packed = np.frombuffer(b"".join(pdf["a"]), np.uint8).reshape(-1, width)
            token = np.zeros((len(packed), 8), np.uint8)
            token[:, :width] = packed
            token = token.view("<u8").ravel() & low_bits
            owner = np.frombuffer(b"".join(pdf["b"]), "<u2")
            block = np.repeat(pdf["block"].to_numpy(), [len(b) // 2 for b in pdf["b"]])
            order = np.argsort(token, kind="stable")
            first = np.flatnonzero(np.diff(token[order], prepend=token[order[0]] ^ np.uint64(1)))
            times = np.diff(np.append(first, len(order)))
            times = np.repeat(times, times)
            shared = times > 1
            order, times = order[shared], times[shared]
            token = token[order] | np.uint64(int(pdf["range"].iloc[0]) << (TOKEN_BITS - range_bits))
            owner, block = owner[order], block[order]
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order], prepend=-1))
            rows = [order[p:q] for p, q in zip(cuts, [*cuts[1:], len(order)])]
            out.append(
                pd.DataFrame(
                    {
                        "block": [block[r[0]] for r in rows],
                        "kind": _POSTINGS,
                        "a": [token[r].tobytes() for r in rows],
                        "b": [owner[r].tobytes() for r in rows],
                        "c": [np.minimum(times[r], _MOST).astype("<i4").tobytes() for r in rows],
                    }
                )
            )
        return pd.concat(out)

    return run


_CLASS = "cls binary, n long, prefix array<long>, shared binary"


def _survivors(law: Law):
    """Classes of a block whose prefix holds a shared shingle; in it, the shared ones."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = {kind: part for kind, part in pdf.groupby("kind")}
        names = kinds[_CLASSES]["a"].iloc[0]
        sizes = np.frombuffer(kinds[_CLASSES]["b"].iloc[0], "<i8")
        token, owner, times = [], [], []
        for kind, part in kinds.items():
            if kind == _CLASSES:
                continue
            token.append(np.frombuffer(b"".join(part["a"]), "<u8"))
            owner.append(np.frombuffer(b"".join(part["b"]), "<u2").astype(np.int64))
            times.append(
                np.full(len(token[-1]), _MOST, np.int32)
                if kind == _HOT
                else np.frombuffer(b"".join(part["c"]), "<i4")
            )
        token, owner, times = map(np.concatenate, (token, owner, times))
        order = np.lexsort((token, times, owner))
        token, owner = token[order], owner[order]
        ends = np.searchsorted(owner, np.arange(len(sizes) + 1))
        found = np.diff(ends)
        room = law.prefix(sizes) - (sizes - found)
        rows = np.flatnonzero((room > 0) & (found > 0))
        held = [token[ends[i] : ends[i + 1]] for i in rows]
        found = {
            "cls": [names[16 * i : 16 * i + 16] for i in rows],
            "n": list(sizes[rows]),
            "prefix": [h[: room[i]].astype(np.int64) for h, i in zip(held, rows)],
            "shared": [np.sort(h).tobytes() for h in held],
        }
        # Objects, so that Arrow knows the types of a block without survivors.
        return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in found.items()})

    return run


class Side(NamedTuple):
    """Classes of one block in a comparison."""

    at: np.ndarray  # rows of the task
    n: np.ndarray
    copies: np.ndarray
    group: np.ndarray  # of each class
    group_n: np.ndarray
    prefixes: list[np.ndarray]  # of each group
    shared: list[np.ndarray]

    @classmethod
    def of(cls, pdf: pd.DataFrame) -> Side:
        keys: dict[tuple, int] = {}
        prefixes = []
        group = []
        for n, prefix in zip(pdf["n"], pdf["prefix"]):
            key = (n, np.asarray(prefix, np.int64).tobytes())
            if key not in keys:
                keys[key] = len(keys)
                prefixes.append(np.asarray(prefix, np.int64))
            group.append(keys[key])
        return cls(
            pdf["at"].to_numpy(),
            pdf["n"].to_numpy(np.int64),
            pdf["copies"].to_numpy(np.int64),
            np.array(group),
            np.array([n for n, _ in keys], np.int64),
            prefixes,
            [np.frombuffer(s, "<u8") for s in pdf["shared"]],
        )


def _incidence(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """0/1 matrices over the values that occur in all of ``parts``; sums are exact."""
    values = [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]
    both = np.intersect1d(*values)
    out = []
    for part, flat in zip(parts, values):
        matrix = np.zeros((len(part), len(both)), np.float32)
        row = np.repeat(np.arange(len(part)), [len(p) for p in part])
        at = np.minimum(np.searchsorted(both, flat), max(len(both) - 1, 0))
        if len(both):
            known = both[at] == flat
            matrix[row[known], at[known]] = 1
        out.append(matrix)
    return out


def _linked(x: Side, y: Side, law: Law) -> np.ndarray:
    """Matrix of linked classes of two sides."""
    # Pairs of groups: lengths, then what the shared prefix leaves possible.
    n, m = x.group_n[:, None], y.group_n[None, :]
    possible = 100 * np.minimum(n, m) >= law.percent * np.maximum(n, m)
    if possible.any():
        a, b = _incidence([x.prefixes, y.prefixes])
        met = a @ b.T
        rest = np.maximum(n - law.prefix(n), m - law.prefix(m))
        possible &= (met > 0) & (met + rest >= law.overlap(n, m))
    # Members of possible pairs, verified.
    pairs = possible[np.ix_(x.group, y.group)]
    rows, columns = np.flatnonzero(pairs.any(1)), np.flatnonzero(pairs.any(0))
    out = np.zeros(pairs.shape, bool)
    if len(rows):
        a, b = _incidence([[x.shared[i] for i in rows], [y.shared[i] for i in columns]])
        met = (a @ b.T).astype(np.int64)
        union = x.n[rows][:, None] + y.n[columns][None, :] - met
        out[np.ix_(rows, columns)] = 100 * met >= law.percent * union
    return out & pairs


_LINKS = "cls binary, root binary, links long"


def _compare(law: Law):
    """Per class of a task: its links there, and the least class it is connected with."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), part in pdf.groupby(["cluster", "i", "j"]):
            part = part.sort_values(["cls"]).reset_index(drop=True)
            part["at"] = np.arange(len(part))
            label, links = part["at"].to_numpy().copy(), np.zeros(len(part), np.int64)
            sides = [part[part["block"] == k].sort_values(["n", "at"]) for k in sorted({i, j})]
            for x, y, same in _tiles(sides):
                met = _linked(x, y, law)
                if same:
                    np.fill_diagonal(met, False)
                links[x.at] += met @ y.copies
                if not same:
                    links[y.at] += x.copies @ met
                for p in np.flatnonzero(met.any(1)):
                    joined = np.unique(label[np.append(y.at[met[p]], x.at[p])])
                    if len(joined) > 1:
                        label[np.isin(label, joined)] = joined[0]
            found = links > 0
            names = part["cls"].to_numpy(object)
            columns = {"cls": names[found], "root": names[label][found], "links": links[found]}
            out.append(pd.DataFrame(columns, dtype=object))
        return pd.concat(out)

    return run


def _tiles(sides: list[pd.DataFrame]) -> Iterator[tuple[Side, Side, bool]]:
    parts = [
        [Side.of(s.iloc[a : a + COMPARED]) for a in range(0, len(s), COMPARED)] for s in sides
    ]
    if len(parts) == 2:
        for x in parts[0]:
            for y in parts[1]:
                yield x, y, False
        return
    for k, x in enumerate(parts[0]):
        yield x, x, True
        for y in parts[0][k + 1 :]:
            yield x, y, False


def _clusters(classes: DataFrame, keep) -> DataFrame:
    """(cls, cluster): classes whose prefixes meet, directly or over others."""
    held = classes.select("cls", F.explode("prefix").alias("token"))
    first = (
        held.groupBy("token")
        .agg(F.min("cls").alias("lead"), F.count("*").alias("holders"))
        .filter("holders > 1")
        .drop("holders")
    )
    # A star per shingle connects its holders; comparing them comes later.
    star = (
        held.join(first, "token")
        .filter("cls <> lead")
        .select(F.col("lead").alias("a"), F.col("cls").alias("b"))
        .distinct()
    )
    return components(star, keep).select(
        F.col("node").alias("cls"), F.col("root").alias("cluster")
    )


def _tasks(classes: DataFrame, clusters: DataFrame, copies: DataFrame, law: Law, scratch: Scratch):
    """Classes with the comparison tasks (task, cluster, i, j) they take part in."""
    narrow = clusters.join(classes.select("cls", "n"), "cls").select("cls", "cluster", "n")
    placed = scratch.keep(
        ranked(narrow, ["n", "cls"], scratch, within=["cluster"]).select(
            "cls",
            "cluster",
            F.expr(f"(rank - 1) div {CLUSTER_BLOCK}").alias("block"),
            "n",
            "group_rows",
        ),
        "placed",
    )
    spans = placed.groupBy("cluster", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.first("group_rows").alias("size")
    )
    a, b = spans.alias("a"), spans.alias("b")
    small = max(1, placed.count() // SMALL_TASK)
    pairs = (
        a.join(b, "cluster")
        .filter("a.block <= b.block")
        .filter(F.expr(f"100 * a.high >= {law.percent} * b.low"))
        .select(
            "cluster",
            F.col("a.block").alias("i"),
            F.col("b.block").alias("j"),
            F.when(F.col("a.size") <= SMALL_TASK, F.pmod(F.xxhash64("cluster"), F.lit(small)))
            .otherwise(F.xxhash64("cluster", "a.block", "b.block"))
            .alias("task"),
        )
    )
    sides = pairs.select("cluster", "i", "j", "task", F.explode(
        F.array_distinct(F.array("i", "j"))
    ).alias("block"))
    return (
        placed.select("cls", "cluster", "block")
        .join(classes, "cls")
        .join(copies, "cls")
        .join(sides, ["cluster", "block"])
    )


def jaccard_join(docs: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of ``docs``."""
    law, keep = Law(percent), scratch.keep
    texts = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = keep(
        texts.mapInArrow(
            _scan(size), f"doc_id {kind}, n long, cls binary, token long, times long"
        ),
        "scanned",
    )
    rows = scanned.filter("n IS NOT NULL").select("doc_id", "n", "cls")
    whole = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("tokens")).first()
    # At most twice the mean set size over the share.
    common = (
        scanned.filter("token IS NOT NULL")
        .groupBy("token")
        .agg(F.sum("times").alias("times"))
        .filter(F.col("times") >= max(8, whole["docs"] * COMMON / 2))
        .select("token")
        .collect()
    )
    hot = docs.sparkSession.sparkContext.broadcast(
        np.array(sorted(r["token"] for r in common), np.uint64)
    )
    range_bits = max(LEAST_RANGE_BITS, ((whole["tokens"] or 0) // RANGE_TOKENS).bit_length())
    classes = keep(
        texts.mapInArrow(_send(size, hot, range_bits), _MOVED)
        .groupBy("range")
        .applyInPandas(_count(range_bits), _RETURNED)
        .groupBy("block")
        .applyInPandas(_survivors(law), _CLASS)
        .dropDuplicates(["cls"]),
        "classes",
    )
    by_class = keep(
        rows.groupBy("cls").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies")
        ),
        "by_class",
    )
    clusters = _clusters(classes, keep)
    links = keep(
        _tasks(classes, clusters, by_class.select("cls", "copies"), law, scratch)
        .groupBy("task")
        .applyInPandas(_compare(law), _LINKS),
        "links",
    )
    roots = components(
        links.filter("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")), keep
    ).select(F.col("node").alias("cls"), "root")
    named = roots.join(by_class, "cls").groupBy("root").agg(F.min("first_id").alias("least_id"))
    classes_out = keep(
        by_class.join(roots.join(named, "root").select("cls", "least_id"), "cls", "left")
        .join(links.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
        .select(
            "cls",
            F.coalesce("least_id", "first_id").alias("least_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        ),
        "classes_out",
    )
    empty = F.col("n") == 0
    return rows.join(classes_out, "cls").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("least_id")).alias("component_id"),
        F.when(empty, F.lit(0)).otherwise(F.col("links")).cast("long").alias("n_links"),
    )
