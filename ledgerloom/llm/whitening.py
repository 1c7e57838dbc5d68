"""Embedding whitening by QDWH spectral divide-and-conquer.

Entries become integers, so the fit's sums and second moments are exact whatever order tasks
finish in: each task adds up the outer products of its vectors, taken from a common integer
centre within half a unit of the mean, and Spark adds these matrices entry by entry. The
covariance (dimension x dimension, all that reaches the driver) is then split: the polar
factor of ``V - shift * I``, found by the QDWH iteration, is the matrix sign, which gives
the projectors on the eigenvectors above and below the shift; a pivoted QR of each projector
gives a basis, and both halves are split again until they are diagonal. Halves that hold
only components beyond those asked for are left alone. The projection travels to every task.

Vectors that are null, empty or hold null or non-finite entries, or entries too large for
exact integers (beyond 2^52), take no part; nor do vectors of another length than the most
frequent one (of equally frequent ones the longest). Components are numbered by falling
eigenvalue; those without spread (eigenvalue zero to double precision) cannot be whitened
and are left out, so identical vectors or a single one give no rows, as does an empty table.
Equal eigenvalues: any orthonormal basis of their space, the same for all rows. Repeated rows
count and are returned as often as they occur; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

LARGEST = 2.0**52
EPS = np.finfo(float).eps


class Fit(NamedTuple):
    rows: int
    sums: list[int]  # of the integer entries, by dimension
    covariance: np.ndarray


class Whitening(NamedTuple):
    vectors: np.ndarray  # one column per component
    values: np.ndarray  # falling
    trace: float


# --- spectral divide and conquer ---------------------------------------------------------


def polar_factor(a: np.ndarray, limit: int = 40) -> np.ndarray:
    """The symmetric orthogonal polar factor of a symmetric matrix, by QDWH.

    Each step maps the singular values through the weighted Halley function that is best
    for the interval they are known to lie in; the QR form needs no inverse.
    """
    n = len(a)
    x = a / np.linalg.norm(a)  # singular values at most 1
    low = EPS
    for _ in range(limit):
        gap = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + gap)
        wa = root + np.sqrt(8 - 4 * gap + 8 * (2 - low**2) / (low**2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x = after
        low = min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        if moved < 1e-14 * n and 1 - low < 1e-12:
            break
        if 1 - low < 1e-15:
            low = 1.0 - 1e-15
    return x


def pivoted_basis(p: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement (pivoted QR)."""
    r, q = p.copy(), np.eye(len(p))
    for k in range(rank):
        norms = (r[k:, k:] ** 2).sum(0)
        best = k + int(norms.argmax())
        r[:, [k, best]] = r[:, [best, k]]
        v = r[k:, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        r[k:] -= 2 * np.outer(v, v @ r[k:])
        q[:, k:] -= 2 * np.outer(q[:, k:] @ v, v)
    return q[:, :rank], q[:, rank:]


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if ``a`` is diagonal.

    A shift that lies on an eigenvalue gives no clean projector, so others follow: the
    median of the diagonal balances the halves, the mean parts any two eigenvalues.
    """
    n = len(a)
    off = a - np.diag(np.diag(a))
    if n == 1 or np.abs(off).max() <= 4 * EPS * scale:
        return None
    diagonal = np.diag(a)
    mean, spread = diagonal.mean(), np.linalg.norm(a - diagonal.mean() * np.eye(n)) / np.sqrt(n)
    tries = [float(np.median(diagonal)), mean]
    tries += [mean + spread * f for f in (0.1, -0.1, 0.37, -0.37, 0.73, -0.73, 0.013, -0.013)]
    best = None
    for shift in tries:
        moved = a - shift * np.eye(n)
        if not np.linalg.norm(moved) > 0:
            continue
        p = (polar_factor(moved) + np.eye(n)) / 2
        rank = int(round(np.trace(p)))
        if not 0 < rank < n:
            continue
        above, below = pivoted_basis(p, rank)
        left = np.abs(above.T @ a @ below).max()
        if best is None or left < best[0]:
            best = (left, above, below)
        if left <= 16 * n * EPS * scale:
            break
    return None if best is None else best[1:]


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors (columns)."""
    n, scale = len(a), max(float(np.linalg.norm(a)), np.finfo(float).tiny)
    found: list[tuple[float, np.ndarray]] = []
    # Halves by falling eigenvalue, so those left when enough are found are not needed.
    waiting = [np.eye(n)]
    while waiting and len(found) < wanted:
        basis = waiting.pop()
        part = basis.T @ a @ basis
        halves = split((part + part.T) / 2, scale)
        if halves is None:
            order = np.argsort(-np.diag(part), kind="stable")
            found += [(part[i, i], basis[:, i]) for i in order]
        else:
            waiting += [basis @ halves[1], basis @ halves[0]]
    found = sorted(found[:wanted], key=lambda f: -f[0]) if found else []
    values = np.array([f[0] for f in found])
    vectors = np.array([f[1] for f in found]).T.reshape(n, len(found))
    vectors = np.linalg.qr(vectors)[0] if len(found) else vectors
    # One sign for all rows: the largest entry of a component is positive.
    top = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[top, np.arange(len(found))] < 0, -1, 1)
    values = np.array([v @ a @ v for v in vectors.T])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- the table ---------------------------------------------------------------------------


def matrix(column: pa.Array, kind) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def integers(vectors: DataFrame, vec_id: Column, vector: Column, scale: int, add: int) -> DataFrame:
    """(vec_id, x): whole entries of the vectors that take part, not yet of one length."""
    c = vector.cast("array<double>")
    usable = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        c, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e * scale) + abs(add) < LARGEST), F.lit(False))
    )
    x = F.transform(c, lambda e: F.floor(e * scale).cast("long") + add)
    return vectors.select(vec_id.alias("vec_id"), F.when(usable, x).alias("x")).filter("x IS NOT NULL")


def one_length(rows: DataFrame) -> DataFrame:
    top = (
        rows.groupBy(F.size("x").alias("size"))
        .count()
        .orderBy(F.desc("count"), F.desc("size"))
        .first()
    )
    return rows.filter(F.size("x") == (top["size"] if top else 0))


def fit(rows: DataFrame) -> Fit | None:
    """Exact sums and the covariance (divisor n) of (vec_id, x); None without rows."""
    found = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")
    )
    sums = {r["i"]: (int(r["s"]), r["n"]) for r in found.collect()}  # one row per dimension
    if not sums:
        return None
    n, total = sums[0][1], [sums[i][0] for i in range(len(sums))]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(centre)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = shared.value
        out = np.zeros((len(centre), len(centre)))
        for batch in batches:
            u = (matrix(batch["x"], np.int64) - centre).astype(float)
            out += u.T @ u  # whole numbers: exact below 2^53
        i, j = np.triu_indices(len(centre))
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "m": out[i, j]})

    pairs = (
        rows.select("x")
        .mapInArrow(moments, "i long, j long, m double")
        .groupBy("i", "j")
        .agg(F.sum("m").alias("m"))
        .toPandas()
    )
    v = np.zeros((len(centre), len(centre)))
    i, j = pairs["i"].to_numpy(np.int64), pairs["j"].to_numpy(np.int64)
    v[i, j] = v[j, i] = pairs["m"].to_numpy(float)
    # What the centre lacks to the mean, at most half a unit an entry.
    rest = np.array([(s - n * int(c)) / n for s, c in zip(total, centre)])
    return Fit(n, total, v / n - np.outer(rest, rest))


def decompose(found: Fit, wanted: int) -> Whitening:
    values, vectors = components(found.covariance, wanted)
    trace = float(np.trace(found.covariance))
    real = values > len(found.covariance) * EPS * max(trace, 0.0)
    return Whitening(vectors[:, real], values[real], trace)


def squares(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each row of whole numbers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(y.shape[1], 1) < 1 << 63:
        return (y * y).sum(1).tolist()
    return [sum(int(e) * int(e) for e in row) for row in y]


def project(rows: DataFrame, found: Fit, white: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): one row per vector, its components in an array.

    ``deviation`` is the exact sum of (n * x - S)^2, as decimal(38,0).
    """
    n = found.rows
    columns = white.vectors / np.sqrt(white.values) if len(white.values) else white.vectors
    # n * x - S without overflow: from the centre, whose part is taken off in whole numbers.
    centre = [(2 * s + n) // (2 * n) for s in found.sums]
    rest = [s - n * c for s, c in zip(found.sums, centre)]
    shared = rows.sparkSession.sparkContext.broadcast(
        (np.array(centre, np.int64), np.array(rest, np.int64), columns)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, rest, columns = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            u = matrix(batch["x"], np.int64) - centre
            if int(np.abs(u).max()) < (1 << 62) // max(n, 1):
                y = u * n - rest
            else:
                y = u.astype(object) * n - rest
            out = (u - rest / n) @ columns
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    pa.array([str(s) for s in squares(y)], pa.string()),
                    pa.FixedSizeListArray.from_arrays(
                        pa.array(out.ravel(), pa.float64()), max(out.shape[1], 1)
                    ).cast(pa.list_(pa.float64())),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    if not len(white.values):
        rows = rows.limit(0)
    schema = rows.select("vec_id").schema.add("deviation", "string")
    schema = schema.add("whitened", ArrayType(DoubleType()))
    return rows.mapInArrow(run, schema).withColumn(
        "deviation", F.col("deviation").try_cast("decimal(38,0)")
    )


def identity_error(white: DataFrame, size: int) -> float | None:
    """Largest absolute entry of the covariance of ``whitened``, less the identity.

    Measured over all rows; centred before multiplying.
    """
    means = white.select(
        *[F.avg(F.element_at("whitened", i + 1)).alias(f"m{i}") for i in range(size)]
    ).first()
    if not size or means[0] is None:
        return None
    c = [F.element_at("whitened", i + 1) - F.lit(float(means[i])) for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    got = white.select(*[F.avg(c[i] * c[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, got))


def whitened(
    vectors: DataFrame,
    vec_id: Column,
    vector: Column,
    keep: Callable[[DataFrame, str], DataFrame],
    wanted: int = 8,
    scale: int = 1024,
    add: int = 100_000,
) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained (share of the spread) and identity_error (one value for all rows)."""
    rows = one_length(keep(integers(vectors, vec_id, vector, scale, add), "integers"))
    found = fit(rows)
    if found is None:
        found = Fit(0, [], np.zeros((0, 0)))
        white = Whitening(np.zeros((0, 0)), np.zeros(0), 0.0)
    else:
        white = decompose(found, wanted)
    out = keep(project(rows, found, white), "whitened")
    error = identity_error(out, len(white.values))
    share = F.array(*[F.lit(float(e / white.trace)) for e in white.values])
    return out.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(found.rows).cast("long").alias("n"),
        "deviation",
        "whitened",
        (F.element_at(share, F.col("place") + 1) if len(white.values) else F.lit(None))
        .cast("double")
        .alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
