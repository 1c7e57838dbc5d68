"""Exact top-k by inner product with a KD-tree per shard.

Shards lie in space: median splits of a bounded sample cut it into at most ``MOST_CELLS``
cells, and a cell that holds more than ``SHARD_ROWS`` rows (it may be one vector, repeated) is
dealt by hash into pieces. Each shard's tree (median splits of the widest dimension, tight
bounding boxes) is built once and stored as a row. A query first meets the tree of its own
cell. The k-th result found there goes with it to those shards only whose cell's box allows
an inner product as large; each walks its tree best-first by the boxes' bounds. Many queries
of one tree come in blocks of about ``QUERY_BLOCK``.

Components are ``floor(scale * x)``; scores are exact integers. A query's own row is no
candidate, other rows with its id are. Vectors that are null or hold a null or non-finite
component, and rows without an id, take no part; shorter vectors count as padded with
zeros. Ties go to the smaller id. Empty input gives no rows. Only the two named columns are
read.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
MOST_CELLS = 2048  # boxes of all cells travel to every task
SAMPLE_PER_CELL = 16
QUERY_BLOCK = 4096
LEAF_ROWS = 128
_FOUND = "query_row long, query_id long, vec_id long, score long"
_NO_ID = np.iinfo(np.int64).max


class Tree(NamedTuple):
    rows: np.ndarray  # in tree order, as are ids and points
    ids: np.ndarray
    points: np.ndarray
    low: np.ndarray  # per node
    high: np.ndarray
    span: list[tuple[int, int]]
    children: list[tuple[int, int] | None]
    least_id: list[int]


def build(rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> Tree:
    order = np.arange(len(rows))
    low, high, span, children = [], [], [], []
    waiting = [(0, len(rows), -1, 0)]
    while waiting:
        a, b, parent, side = waiting.pop()
        node = len(span)
        part = points[order[a:b]]
        low.append(part.min(0))
        high.append(part.max(0))
        span.append((a, b))
        children.append(None)
        if parent >= 0:
            pair = children[parent] or (-1, -1)
            children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
        if b - a > LEAF_ROWS:
            middle = (b - a) // 2
            widest = int((high[-1] - low[-1]).argmax())
            order[a:b] = order[a:b][np.argpartition(part[:, widest], middle)]
            waiting += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
    ids = ids[order]
    return Tree(
        rows[order], ids, points[order], np.array(low), np.array(high), span, children,
        [int(ids[a:b].min()) for a, b in span],
    )


class Best:
    """The k best (score, id) so far, starting from a known k-th result."""

    def __init__(self, k: int, score: float, vec_id: int):
        self.k, self.score, self.vec_id = k, score, vec_id
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def beaten_by(self, bound: float, least_id: int) -> bool:
        return bound > self.score or (bound == self.score and least_id < self.vec_id)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        better = (scores > self.score) | ((scores == self.score) & (ids < self.vec_id))
        if not better.any():
            return
        scores = np.concatenate([self.scores, scores[better]])
        ids = np.concatenate([self.ids, ids[better]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.score, self.vec_id = self.scores[-1], int(self.ids[-1])


def search(tree: Tree, query: np.ndarray, row: int, bounds: np.ndarray, best: Best) -> None:
    """Open boxes in the order of their bounds until none can beat the k-th result."""
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if not best.beaten_by(-bound, tree.least_id[node]):
            if -bound < best.score:
                return
            continue
        pair = tree.children[node]
        if pair:
            for child in pair:
                if best.beaten_by(bounds[child], tree.least_id[child]):
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        a, b = tree.span[node]
        other = tree.rows[a:b] != row
        best.add((tree.points[a:b] @ query)[other], tree.ids[a:b][other])


def _matrix(vectors: pd.Series | list, width: int, kind: type) -> np.ndarray:
    out = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def packed(tree: Tree) -> bytes:
    children = np.array([c or (-1, -1) for c in tree.children], np.int64)
    out = io.BytesIO()
    np.savez(out, *tree[:5], np.array(tree.span), children, np.array(tree.least_id))
    return out.getvalue()


def unpacked(data: bytes) -> Tree:
    held = np.load(io.BytesIO(data))
    rows, ids, points, low, high, span, children, least = (held[f"arr_{i}"] for i in range(8))
    pairs = [tuple(c) if c[0] >= 0 else None for c in children.tolist()]
    return Tree(rows, ids, points, low, high, [tuple(x) for x in span.tolist()], pairs, least.tolist())


class Splits(NamedTuple):
    """A tree of median splits: dimension and value of each, and where both sides lead."""

    dimension: np.ndarray
    value: np.ndarray
    sides: np.ndarray  # a node, or -1 - cell

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        if not len(self.dimension):
            return at
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            right = points[inner, self.dimension[node]] > self.value[node]
            at[inner] = self.sides[node, right.astype(int)]
        return -1 - at


def splits_of(sample: np.ndarray, wanted: int) -> Splits:
    """About ``wanted`` cells of equal shares of the sample, cut where it is widest."""
    dimension, value, sides = [], [], []
    cells = 0
    waiting = [(sample, wanted, -1, 0)] if wanted > 1 and len(sample) else []
    while waiting:
        part, share, parent, side = waiting.pop()
        spread = part.max(0) - part.min(0) if len(part) else np.zeros(1)
        if share > 1 and spread.max() > 0:
            node, widest = len(dimension), int(spread.argmax())
            middle = float(np.median(part[:, widest]))
            if middle >= part[:, widest].max():  # the median is the largest: cut below it
                middle = float(part[part[:, widest] < middle][:, widest].max())
            dimension.append(widest)
            value.append(middle)
            sides.append([0, 0])
            right = part[:, widest] > middle
            waiting += [(part[~right], share // 2, node, 0), (part[right], share - share // 2, node, 1)]
            place = node
        else:
            place, cells = -1 - cells, cells + 1
        if parent >= 0:
            sides[parent][side] = place
    return Splits(np.array(dimension, np.int64), np.array(value), np.array(sides).reshape(-1, 2))


def _exact(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles where their inner products are exact, and then much faster."""
    largest = max(int(abs(points).max(initial=0)), 1) * max(int(abs(queries).max(initial=0)), 1)
    if largest * max(points.shape[1], 1) < 1 << 53:
        return points.astype(float), queries.astype(float)
    return points, queries


def _search_block(k: int, width: int):
    def run(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {c.split()[0]: [] for c in _FOUND.split(", ")}
        if len(trees) and len(asked):
            tree = unpacked(trees["tree"].iloc[0])
            points, queries = _exact(tree.points, _matrix(asked["query"], width, np.int64))
            tree = tree._replace(points=points)
            low, high = tree.low.astype(points.dtype), tree.high.astype(points.dtype)
            for i, q in enumerate(asked.itertuples(index=False)):
                known = not pd.isna(q.kth_score)
                best = Best(
                    k, q.kth_score if known else -np.inf, int(q.kth_id) if known else _NO_ID
                )
                bounds = high @ np.maximum(queries[i], 0) + low @ np.minimum(queries[i], 0)
                search(tree, queries[i], q.query_row, bounds, best)
                out["query_row"] += [q.query_row] * len(best.ids)
                out["query_id"] += [q.query_id] * len(best.ids)
                out["vec_id"] += best.ids.tolist()
                out["score"] += [int(s) for s in best.scores]
        return pd.DataFrame(out)

    return run


_SHARD = ["cell", "piece"]


def _searched(trees: DataFrame, asked: DataFrame, k: int, width: int, keep, name: str) -> DataFrame:
    """Each query against the trees it is sent to; a tree moves once per block of queries."""
    asked = keep(asked, f"{name}_asked")
    block = F.ceil(F.col("count") / QUERY_BLOCK).cast("long")
    blocks = keep(asked.groupBy(*_SHARD).count().withColumn("blocks", block).drop("count"), name)
    asked = asked.join(blocks, _SHARD).withColumn(
        "block", F.pmod(F.xxhash64("query_row"), F.col("blocks"))
    )
    moved = trees.join(blocks, _SHARD).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    by = [*_SHARD, "block"]
    found = moved.select(*by, "tree").groupBy(*by).cogroup(asked.drop("blocks").groupBy(*by))
    return keep(found.applyInPandas(_search_block(k, width), _FOUND), f"{name}_found")


def _placed(rows: DataFrame, splits: Splits, width: int) -> DataFrame:
    """``rows`` with the cell each vector lies in."""
    shared = rows.sparkSession.sparkContext.broadcast(tuple(splits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = Splits(*shared.value)
        for batch in batches:
            points = _matrix(batch["vector"].to_pylist(), width, np.int64)
            yield batch.append_column("cell", pa.array(splits.cells(points), pa.int64()))

    return rows.mapInArrow(run, rows.select("*").schema.add("cell", "long"))


def _tree_rows(width: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        points = _matrix(shard["vector"], width, np.int64)
        tree = build(shard["row"].to_numpy(), shard["vec_id"].to_numpy(), points)
        return pd.DataFrame(
            {
                "cell": [shard["cell"].iloc[0]],
                "piece": [shard["piece"].iloc[0]],
                "low": [tree.low[0].tolist()],
                "high": [tree.high[0].tolist()],
                "tree": [packed(tree)],
            }
        )

    return run


def _reached(asked: DataFrame, boxes: list, width: int) -> DataFrame:
    """(query_row, cell, ...) for each cell whose box may hold a result, by the k-th score."""
    cells = np.array([b["cell"] for b in boxes], np.int64)
    low, high = (np.array([b[x] for b in boxes], np.int64).reshape(-1, width) for x in ("low", "high"))
    shared = asked.sparkSession.sparkContext.broadcast((cells, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, low, high = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                queries = _matrix(part["query"].to_pylist(), width, np.int64)
                corners, asking = _exact(np.concatenate([low, high]), queries)
                under, over = corners[: len(low)], corners[len(low) :]
                bounds = np.maximum(asking, 0) @ over.T + np.minimum(asking, 0) @ under.T
                kth = part["kth_score"].to_pylist()
                # An equal bound may still bring a smaller id.
                open_ = np.array(
                    [b >= s if s is not None else np.ones(len(cells), bool) for b, s in zip(bounds, kth)]
                ).reshape(part.num_rows, len(cells))
                row, cell = np.nonzero(open_)
                for a in range(0, len(row), 4096):
                    taken = part.take(pa.array(row[a : a + 4096]))
                    held = dict(zip(taken.schema.names, taken.columns))
                    held["cell"] = pa.array(cells[cell[a : a + 4096]])
                    yield pa.RecordBatch.from_arrays(list(held.values()), names=list(held))

    return asked.mapInArrow(run, asked.schema)


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(row, vec_id, vector) of the rows that take part, components as whole numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (
        vectors.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & finite)
        .select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("vector"))
        .withColumn("row", F.monotonically_increasing_id())
    )


def top_k(
    vectors: DataFrame, is_query: Column, keep, k: int, scale: int,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row; ``is_query`` is on ``vec_id``."""
    rows = keep(quantised(vectors, vec_id, vector, scale), "vectors")
    total, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 0, 1)
    cells = min(max(1, -(-total // SHARD_ROWS)), MOST_CELLS)
    wanted = cells * SAMPLE_PER_CELL
    # Bounded by the number of cells, whatever the table holds.
    few = rows.filter(F.pmod(F.xxhash64("row"), F.lit(max(total // wanted, 1))) == 0)
    sample = _matrix([r[0] for r in few.select("vector").limit(2 * wanted).collect()], width, np.int64)
    placed = keep(_placed(rows, splits_of(sample, cells), width), "placed")
    sizes = placed.groupBy("cell").count()
    pieces = keep(
        sizes.select("cell", F.ceil(F.col("count") / SHARD_ROWS).cast("long").alias("pieces")), "sizes"
    )
    placed = placed.join(pieces, "cell").withColumn(
        "piece", F.pmod(F.xxhash64("row"), F.col("pieces"))
    )
    box = "low array<long>, high array<long>, tree binary"
    trees = keep(
        placed.select(*_SHARD, "row", "vec_id", "vector")
        .groupBy(*_SHARD)
        .applyInPandas(_tree_rows(width), f"cell long, piece long, {box}"),
        "trees",
    )
    queries = placed.filter(is_query).select(
        F.col("row").alias("query_row"),
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        *_SHARD,
    )
    none = F.lit(None).cast("long")
    home = queries.select("*", none.alias("kth_score"), none.alias("kth_id"))
    first = _searched(trees, home, k, width, keep, "home")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    kth = (
        first.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") == k)
        .select("query_row", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    )
    # One box per cell: the pieces of a cell share it.
    corners = [F.array(*[f(F.element_at(c, i + 1)) for i in range(width)]).alias(c)
               for c, f in (("low", F.min), ("high", F.max))]
    boxes = trees.groupBy("cell").agg(*corners).collect()
    asked = queries.withColumnRenamed("piece", "own_piece").withColumn("own_cell", F.col("cell"))
    routed = _reached(asked.join(kth, "query_row", "left"), boxes, width)
    own = (F.col("cell") == F.col("own_cell")) & (F.col("piece") == F.col("own_piece"))
    routed = (
        routed.join(pieces, "cell")
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
        .filter(~own)
        .select("query_row", "query_id", "query", *_SHARD, "kth_score", "kth_id")
    )
    later = _searched(trees, routed, k, width, keep, "others")
    return (
        first.unionByName(later)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
