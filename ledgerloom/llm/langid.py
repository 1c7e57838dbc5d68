"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else counts as a blank. Counts per language and bucket
are summed by Spark; the log-probability matrix (buckets x languages, bounded by
``BUCKETS``) travels to every task, which scores whole texts in blocks: n-gram buckets are
gathered from the matrix and summed per text. Long texts are scored in overlapping slices,
so no n-gram is lost and no block grows with a text.

Null text, or text without a letter, is ``und`` with score 0; signs of numbers (fractions,
raised digits, Roman numerals) are no letters. With nothing to learn from, every text is
``und``. Of equally likely languages the first by name is taken. Repeated rows get equal
predictions; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
# About this many labelled rows per language are learned from (whole texts, by hash).
SAMPLE_PER_LANGUAGE = 4000
SLICE = 1 << 20  # characters scored at once
UNDETERMINED = "und"

_BLANK = 32
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # also takes signs of numbers, such as fractions


class Model(NamedTuple):
    languages: list[str]
    log_prob: np.ndarray  # BUCKETS + 1 rows; the last is zero, for positions that hold no n-gram
    log_prior: np.ndarray


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def letters_table() -> np.ndarray:
    """Lower-case code point of each BMP letter, blank for the rest."""
    out = np.full(1 << 16, _BLANK, np.uint32)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def slices(text: str, limit: int = SLICE) -> Iterator[tuple[str, int]]:
    """(slice with the next n-grams' rest, how many n-grams start in it)."""
    for at in range(0, max(len(text), 1), limit):
        yield text[at : at + limit + max(ORDERS) - 1], min(limit, len(text) - at)


def bucket_rows(parts: list[tuple[str, int]], table: np.ndarray) -> Iterator[np.ndarray]:
    """Per n-gram order, the bucket of each position of the joined parts, else ``BUCKETS``."""
    codes = np.frombuffer("".join(p for p, _ in parts).encode("utf-32-le"), np.uint32)
    codes = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], codes)
    ends = np.cumsum([len(p) for p, _ in parts])
    own = ends - [len(p) for p, _ in parts] + [n for _, n in parts]
    hashed = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(codes), np.uint32)
        shifted[: len(codes) - n + 1] = codes[n - 1 :]
        hashed = (hashed ^ shifted) * np.uint32(0x9E3779B1)
        if n not in ORDERS:
            continue
        mixed = hashed ^ (hashed >> np.uint32(15))
        out = ((mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)
        for end, stop in zip(ends, own):
            out[max(min(stop, end - n + 1), 0) : end] = BUCKETS
        # A part shorter than the order holds none.
        for (part, _), end in zip(parts, ends):
            if len(part) < n:
                out[end - len(part) : end] = BUCKETS
        yield out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, seen = letters_table(), {}

    def drain() -> Iterator[pa.RecordBatch]:
        for lang, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(at), pa.string()), "bucket": at, "n": counts[at]}
            )
        seen.clear()

    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            counts = seen.setdefault(lang.as_py(), np.zeros(BUCKETS + 1, np.int64))
            for part in slices(text.as_py()):
                for rows in bucket_rows([part], table):
                    counts += np.bincount(rows, minlength=BUCKETS + 1)
            counts[BUCKETS] = 0
            if len(seen) > 64:
                yield from drain()
    yield from drain()


def fit(labelled: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from (id, text, lang); rows with a null among text and lang teach nothing."""
    rows = labelled.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS + 1, 0)), np.zeros(0))
    shares = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))]
    )
    # Uniform in [0, 1) by id, so the same rows teach at every run.
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    counts = (
        rows.filter(draw <= F.element_at(shares, F.col("lang")))
        .select("text", "lang")
        .mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(sizes)
    matrix = np.zeros((BUCKETS, len(languages)))
    column = counts["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.int64)
    matrix[counts["bucket"].to_numpy(np.int64), column] = counts["n"].to_numpy(float)
    matrix += SMOOTHING
    log_prob = np.zeros((BUCKETS + 1, len(languages)))
    log_prob[:BUCKETS] = np.log(matrix / matrix.sum(0))
    prior = np.array([sizes[lang] for lang in languages], float)
    return Model(languages, log_prob, np.log(prior / prior.sum()))


def score_texts(texts: list[str | None], model: Model, table: np.ndarray):
    """(language, posterior probability) per text."""
    out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
    known = len(model.languages)
    asked = [i for i, t in enumerate(texts) if known and t and has_letter(t)]
    limit = max(1 << 14, min(SLICE, (1 << 22) // max(known, 1)))
    parts = [(i, p) for i in asked for p in slices(texts[i], limit)]
    total = np.tile(model.log_prior, (len(texts), 1))
    for a, b in blocks([len(p[0]) for _, p in parts], limit):
        run = [p for _, p in parts[a:b]]
        starts = np.cumsum([0] + [len(p[0]) for p in run[:-1]])
        owner = [i for i, _ in parts[a:b]]
        for rows in bucket_rows(run, table):
            sums = np.add.reduceat(model.log_prob[rows], starts, axis=0)
            np.add.at(total, owner, sums)
    for i in asked:
        likely = np.exp(total[i] - total[i].max())
        best = int(likely.argmax())
        out[i] = (model.languages[best], float(likely[best] / likely.sum()))
    return out


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """(row, lang_pred, score): the columns ``keep`` of ``docs`` as a struct, predicted."""
    broadcast = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = Model(*broadcast.value), letters_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = score_texts(part["text"].to_pylist(), model, table)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["row"],
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=["row", "lang_pred", "score"],
                )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)
