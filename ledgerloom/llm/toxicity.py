"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and their first three and four letters. Out of a bounded sample
of labelled texts come the vocabulary (the terms most typical of toxic texts, and the most
common terms as background) and the example vectors. Examples lie in blocks; the inverted
index of a block keeps its postings, and a table keeps each term's largest weight per block.
A text's blocks are opened in the order of their bounds until none can beat its k-th
neighbour, so the neighbours are exact. Votes are weighted by closeness and mapped to
probabilities by an isotonic fit on the examples' own leave-one-out votes.

Whole texts are read, long ones in slices. Null or empty text, or text without a known
term, has no neighbours and gets the probability of no votes. Rows with a null label or id
teach nothing; without both classes every score is 0. Repeated rows are scored alike. Only
``doc_id`` and ``text`` (and ``toxic`` for learning) are read; ids are never scored. Of
examples as close as the k-th the first in index order counts. No documents give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import text_slices

SAMPLE_PER_CLASS = 3000  # about this many labelled texts of each class are learned from
TYPICAL_TERMS, COMMON_TERMS = 512, 64
LEAST_TEXTS = 3  # a vocabulary term is in so many examples
NEIGHBOURS = 15
BLOCK = 64  # examples
BATCH = 256  # texts scored together
PREFIXES = (3, 4)
EVIDENCE = 3  # neighbours that are shown

_EXAMPLE = T.StructType().add("doc_id", "long").add("similarity", "double").add("toxic", "integer")
_WORD = re.compile(r"[^\W\d_]+")


def term_counts(text: str | None, known: dict[str, tuple] | None = None) -> Counter:
    """How often each term occurs; ``known`` maps words to their terms' numbers instead."""
    words: Counter = Counter()
    for part in text_slices(text or ""):
        words.update(_WORD.findall(part.lower()))
    out: Counter = Counter()
    for word, n in words.items():
        for term in terms_of(word) if known is None else known[word]:
            out[term] += n
    return out


def terms_of(word: str) -> list[str]:
    return [word] + ["^" + word[:n] for n in PREFIXES if len(word) > n]


class _Known(dict):
    """Terms of a word by number, for those in the vocabulary; remembers words it has met."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple:
        if len(self) > 200_000:
            self.clear()
        found = [self.vocabulary.get(t) for t in terms_of(word)]
        self[word] = out = tuple(n for n in found if n is not None)
        return out


def vectors(texts: list[str | None], known: _Known, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1, or 0 without a known term."""
    out = np.zeros((len(texts), len(idf)))
    for i, text in enumerate(texts):
        counts = term_counts(text, known)
        if counts:
            at = np.fromiter(counts.keys(), np.int64, len(counts))
            out[i, at] = 1 + np.log(np.fromiter(counts.values(), float, len(counts)))
    out *= idf
    length = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(length > 0, length, 1)


class Index(NamedTuple):
    """Blocks of examples: which terms have postings, and their weights per example."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]  # per block, terms x examples
    most: np.ndarray  # per term and block, the largest weight


def build_index(examples: np.ndarray) -> Index:
    terms, weights, most = [], [], []
    for a in range(0, len(examples), BLOCK):
        block = examples[a : a + BLOCK]
        held = np.flatnonzero(block.any(0))
        terms.append(held)
        weights.append(np.ascontiguousarray(block[:, held].T))
        most.append(block.max(0))
    return Index(terms, weights, np.array(most).T.copy())


def nearest(
    queries: np.ndarray, index: Index, k: int, own: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, example) of the k nearest of each query, best first; -1 for none.

    ``own`` names an example that each query must not find.
    """
    n = len(queries)
    near, which = np.zeros((n, k)), np.full((n, k), -1)
    bounds = queries @ index.most
    order = np.argsort(-bounds, axis=1, kind="stable")
    active = np.arange(n)
    for turn in range(order.shape[1]):
        block = order[active, turn]
        # Ties go to the smaller example, so an equal bound may still matter.
        open_ = bounds[active, block] >= near[active, -1]
        open_ &= bounds[active, block] > 0
        active, block = active[open_], block[open_]
        for b in np.unique(block):
            asked = active[block == b]
            scores = queries[np.ix_(asked, index.terms[b])] @ index.weights[b]
            ids = np.broadcast_to(np.arange(scores.shape[1]) + b * BLOCK, scores.shape)
            if own is not None:
                scores = np.where(ids == own[asked, None], 0, scores)
            scores = np.concatenate([near[asked], scores], axis=1)
            ids = np.concatenate([which[asked], ids], axis=1)
            best = np.lexsort((ids, -scores), axis=1)[:, :k]
            near[asked] = np.take_along_axis(scores, best, 1)
            which[asked] = np.where(near[asked] > 0, np.take_along_axis(ids, best, 1), -1)
    return near, which


def votes(near: np.ndarray, which: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Share of the toxic among the neighbours, weighted by closeness."""
    weight = np.where(which >= 0, 1 / (1.02 - np.clip(near, 0, 1)), 0)
    return (weight * labels[which]).sum(1) / (weight.sum(1) + 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (x, probability) of the rising fit, each from its observations' weighted mean."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # weighted sums of x and y, weight
    for i in order:
        steps.append([x[i] * weight[i], y[i] * weight[i], weight[i]])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    table = np.array(steps)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


class Model(NamedTuple):
    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray  # of the examples, in index order
    labels: np.ndarray
    index: Index
    steps: tuple[np.ndarray, np.ndarray]


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic, text, rate) of about ``per_class`` labelled rows a class, by hash."""
    known = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rate = F.lit(0.0)
    for label, n in sizes.items():
        rate = F.when(F.col("toxic") == label, min(1.0, per_class / n)).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    # Bounded by the sample's size, whatever the tables hold.
    drawn = known.withColumn("rate", rate).filter(draw <= F.col("rate"))
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list[float]] = {}
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            for term, n in term_counts(text.as_py()).items():
                row = total.setdefault(term, [0, 0.0, 0.0])
                row[0] += 1
                row[1 + toxic.as_py()] += 1 + math.log(n)
    yield pa.RecordBatch.from_pydict(
        {
            "term": pa.array(total, pa.string()),
            "texts": pa.array([r[0] for r in total.values()], pa.int64()),
            "clean": pa.array([r[1] for r in total.values()], pa.float64()),
            "toxic": pa.array([r[2] for r in total.values()], pa.float64()),
        }
    )


def _isolated(model: Model) -> np.ndarray:
    """Each example's votes without itself, in index order."""
    near, which = [], []
    rows = np.zeros((len(model.ids), len(model.idf)))
    for b, (terms, weights) in enumerate(zip(model.index.terms, model.index.weights)):
        rows[b * BLOCK : b * BLOCK + weights.shape[1], terms] = weights.T
    for a in range(0, len(rows), BATCH):
        own = np.arange(a, min(a + BATCH, len(rows)))
        found = nearest(rows[a : a + BATCH], model.index, NEIGHBOURS, own)
        near.append(found[0])
        which.append(found[1])
    return votes(np.concatenate(near), np.concatenate(which), model.labels)


def fit(docs: DataFrame, labels: DataFrame, keep, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Learn from the labelled rows given; None unless both classes have examples."""
    examples = keep(sample(docs, labels, per_class), "examples")
    classes = examples.groupBy("toxic").count().collect()
    if len(classes) < 2:
        return None
    n = sum(r["count"] for r in classes)
    share = sum(r["count"] for r in classes if r["toxic"] == 1) / n
    expected = (F.col("clean") + F.col("toxic")) * share
    terms = keep(
        examples.select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(_term_rows, "term string, texts long, clean double, toxic double")
        .groupBy("term")
        .agg(*[F.sum(c).alias(c) for c in ("texts", "clean", "toxic")])
        .filter(F.col("texts") >= LEAST_TEXTS)
        .select(
            "term",
            "texts",
            # Rounded: sums in another order must not change the choice of terms.
            F.round((F.col("toxic") - expected) / F.sqrt(expected), 6).alias("typical"),
        ),
        "terms",
    )
    chosen = [
        *terms.orderBy(F.desc("typical"), "term").limit(TYPICAL_TERMS).collect(),
        *terms.orderBy(F.desc("texts"), "term").limit(COMMON_TERMS).collect(),
    ]
    texts = {r["term"]: r["texts"] for r in chosen}
    if not texts:
        return None
    vocabulary = {term: i for i, term in enumerate(texts)}
    idf = np.array([math.log((n + 1) / (m + 1)) + 1 for m in texts.values()])

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                found = vectors(part["text"].to_pylist(), known, idf)
                held = [np.flatnonzero(v) for v in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["toxic"],
                        part["rate"],
                        pa.array(held, pa.list_(pa.int64())),
                        pa.array([v[h] for v, h in zip(found, held)], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "toxic", "rate", "at", "weight"],
                )

    # Examples x vocabulary, both bounded.
    rows = (
        examples.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("toxic").cast("int").alias("toxic"),
            "rate",
            "text",
        )
        .mapInArrow(
            embed, "doc_id long, toxic int, rate double, at array<long>, weight array<double>"
        )
        .toPandas()
    )
    matrix = np.zeros((len(rows), len(idf)))
    for i, (at, weight) in enumerate(zip(rows["at"], rows["weight"])):
        matrix[i, np.asarray(at, np.int64)] = weight
    # Examples with the same heaviest terms share blocks, which keeps bounds tight.
    heaviest = np.argsort(-matrix, axis=1, kind="stable")[:, :3]
    order = np.lexsort((rows["doc_id"], heaviest[:, 2], heaviest[:, 1], heaviest[:, 0]))
    rows, matrix = rows.iloc[order], matrix[order]
    labels_ = rows["toxic"].to_numpy(np.int64)
    model = Model(
        vocabulary, idf, rows["doc_id"].to_numpy(np.int64), labels_, build_index(matrix),
        (np.zeros(1), np.zeros(1)),
    )
    alone = _isolated(model)
    # Classes are sampled at different rates; weights give them back their share.
    return model._replace(steps=isotonic(alone, labels_, 1 / rows["rate"].to_numpy(float)))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, evidence): the evidence is the closest examples with their labels."""
    schema = docs.select("doc_id").schema.add("score", "double")
    if model is None:
        return docs.select(
            "doc_id", F.lit(0.0).alias("score"), F.array().cast(T.ArrayType(_EXAMPLE)).alias("evidence")
        )
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        known = _Known(model.vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                queries = vectors(part["text"].to_pylist(), known, model.idf)
                near, which = nearest(queries, model.index, NEIGHBOURS)
                share = votes(near, which, model.labels)
                evidence = [
                    [
                        {"doc_id": model.ids[w], "similarity": s, "toxic": model.labels[w]}
                        for s, w in zip(near[i, :EVIDENCE], which[i, :EVIDENCE])
                        if w >= 0
                    ]
                    for i in range(len(share))
                ]
                kind = pa.list_(
                    pa.struct(
                        [("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]
                    )
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(np.interp(share, *model.steps), pa.float64()),
                        pa.array(evidence, kind),
                    ],
                    names=["doc_id", "score", "evidence"],
                )

    schema = schema.add("evidence", T.ArrayType(_EXAMPLE))
    return docs.select("doc_id", "text").mapInArrow(run, schema)
