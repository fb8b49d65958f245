"""Embedding whitening: leading components of the covariance by FEAST contour integration.

Spark does the work that grows: exact sums, the centred covariance, the projection of
every row and the covariance of what came out. Each is a pass in which a task gives
one small summary; summaries are added by Spark. What the driver sees is ``d x d``
for vectors of length ``d``.

The spectrum of that matrix is cut into intervals by inertia counts (the signs of an
``LDL'`` factorisation of a shifted matrix tell how many eigenvalues lie above the
shift). For each interval a quadrature of shifted complex solves along a circle through
its ends projects a random block onto the interval's eigenvectors, Rayleigh-Ritz
extracts them, and both repeat until the residuals vanish. Every interval must give as
many components as its inertia count says.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Quadrature points on the upper half of a contour.
POINTS = 16
#: Eigenvalues of one interval, unless closer ones cannot be told apart.
SLICE = 4
#: Eigenvalues below this share of the largest are numerical zeros: no component.
ZERO = 1e-12
#: Sums of the integer vectors stay exact in 64 bits below this.
_SAFE = 1 << 31


def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: signs of a pivoted block ``LDL'``."""
    left = matrix - shift * np.eye(len(matrix))
    above, ratio = 0, (1 + math.sqrt(17)) / 8
    while len(left):
        size = np.abs(left)
        r, c = divmod(int(size.argmax()), len(left))
        p = int(size.diagonal().argmax())
        if size[r, c] == 0:
            break
        if size[p, p] >= ratio * size[r, c]:
            above += left[p, p] > 0
            rest = np.delete(np.arange(len(left)), p)
            column = left[rest, p]
            left = left[np.ix_(rest, rest)] - np.outer(column, column / left[p, p])
        else:
            above += 1  # a pivot of two rows has one positive and one negative eigenvalue
            rest = np.delete(np.arange(len(left)), [r, c])
            block, columns = left[np.ix_([r, c], [r, c])], left[np.ix_(rest, [r, c])]
            left = left[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
        left = (left + left.T) / 2
    return above


def cut_spectrum(matrix: np.ndarray, top: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, count), from above, that hold at least the ``top`` largest eigenvalues."""
    bound = float(np.abs(matrix).sum(1).max()) * (1 + 1e-9)
    if bound == 0:
        return []
    floor = ZERO * bound
    out: list[tuple[float, float, int]] = []
    todo = [(floor, bound, inertia_above(matrix, floor), 0)]
    while todo:
        low, high, over_low, over_high = todo.pop()
        if over_low == over_high or over_high >= top:
            continue
        middle = (low + high) / 2
        if over_low - over_high <= SLICE or high - low <= 1e-10 * bound:
            out.append((*_shrunk(matrix, low, high, over_low, over_high), over_low - over_high))
            continue
        over = min(max(inertia_above(matrix, middle), over_high), over_low)
        todo += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return out


def _shrunk(matrix: np.ndarray, low: float, high: float, over_low: int, over_high: int, steps: int = 14) -> tuple[float, float]:
    """The interval with its ends moved into the gaps beside its outermost eigenvalues."""
    a, b = low, high
    for _ in range(steps):
        middle = (a + b) / 2
        a, b = (middle, b) if inertia_above(matrix, middle) == over_low else (a, middle)
    c, d = low, high
    for _ in range(steps):
        middle = (c + d) / 2
        c, d = (c, middle) if inertia_above(matrix, middle) == over_high else (middle, d)
    return (low + a) / 2, (d + high) / 2


def feast(matrix: np.ndarray, low: float, high: float, count: int, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and vectors of ``(low, high]``, which holds ``count`` of them."""
    size = len(matrix)
    block = min(size, max(count + 6, 2 * count))
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angle = np.pi * (nodes + 1) / 2
    centre, radius = (low + high) / 2, (high - low) / 2
    turn = np.exp(1j * angle)
    norm = float(np.abs(matrix).sum(1).max())
    basis = np.random.default_rng(size * 1009 + count).standard_normal((size, block))
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    stale = 0
    for _ in range(rounds):
        projected = np.zeros_like(basis)
        for z, w in zip(turn, weights):
            solved = np.linalg.solve((centre + radius * z) * np.eye(size) - matrix, basis)
            projected += (w / 2 * radius * z * solved).real
        basis, _ = np.linalg.qr(projected)
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ small
        inside = (values > low) & (values <= high)
        basis = vectors
        if inside.sum() != count:
            continue
        found, own = values[inside][::-1], vectors[:, inside][:, ::-1]
        error = float(np.abs(matrix @ own - own * found).max()) / norm
        stale = 0 if best is None or error < best[0] / 2 else stale + 1
        if best is None or error < best[0]:
            best = error, found, own
        if error < 1e-15 or stale >= 3:
            break
    if best is None or best[0] > 1e-11:
        raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}], but the contour did not give them")
    return best[1], best[2]


def components_of(matrix: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues, falling, and their unit vectors as columns; fewer if the rank is lower."""
    values, vectors = [], []
    for low, high, count in cut_spectrum(matrix, top):
        found = feast(matrix, low, high, count)
        values.append(found[0])
        vectors.append(found[1])
    if not values:
        return np.zeros(0), np.zeros((len(matrix), 0))
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-values, kind="stable")[:top]
    return values[order], vectors[:, order]


@dataclass
class Whitening:
    """What is learned: row count, exact sums, eigenvalues, unit vectors (columns) and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    covariance: np.ndarray


def scaled(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """Integer vectors of a batch, one row each: ``floor(1024 c) + 100000``."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    big = np.floor(1024.0 * flat)
    if not len(flat) or np.abs(big).max() < _SAFE:
        return big.astype(np.int64) + 100000
    exact = [[math.floor(float(c) * 1024) if abs(c) < 1e290 else int(c) * 1024 for c in row] for row in flat]
    return np.array(exact, object) + 100000


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, v`` (doubles) of the vectors without null, NaN or infinite entries."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(F.col("v").isNotNull())
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~bad)


def _summed(rows: DataFrame, summary, size: int) -> np.ndarray:
    """Sum over all tasks of ``summary(integers)``, an array of ``size`` doubles; added by Spark per place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += summary(batch).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["place", "value"])

    table = rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[table["place"].to_numpy()] = table["value"].to_numpy()
    return out


def exact_sums(rows: DataFrame, size: int) -> list[int]:
    """Sums of the integer vectors, without rounding at any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            if batch.num_rows:
                some = scaled(batch, size)
                total += some.sum(0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([str(t) for t in total])], ["place", "total"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"place": part["place"].iloc[:1], "total": [str(sum(map(int, part["total"])))]})

    parts = rows.mapInArrow(run, "place int, total string").groupBy("place").applyInPandas(add, "place int, total string")
    found = {r["place"]: int(r["total"]) for r in parts.collect()}
    return [found.get(i, 0) for i in range(size)]


def fit(rows: DataFrame, top: int = 8) -> Whitening | None:
    """Learn the whitening of ``usable`` rows, all of one length; None without rows."""
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, size = shape["n"], shape["d"] or 0
    if not n:
        return None
    sums = exact_sums(rows, size)
    mean = _mean(sums, n)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        centred = _centred(scaled(batch, size), mean)
        return centred.T @ centred

    covariance = _summed(rows, products, size * size).reshape(size, size) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = components_of(covariance, min(top, size))
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)), covariance)


def _mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over n as whole part and fraction, so that a centred entry loses nothing to its size."""
    return np.array([s // n for s in sums], object), np.array([(s % n) / n for s in sums], float)


def _centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    whole = mean[0]
    if x.dtype != object and all(abs(w) < 1 << 62 for w in whole):
        return (x - whole.astype(np.int64)).astype(float) - mean[1]
    return (x.astype(object) - whole).astype(float) - mean[1]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of ``(n x - S)^2`` of each row; None beyond a long."""
    if x.dtype != object and n * (2 * _SAFE) < 1 << 62:
        apart = n * x - np.array(sums, np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (apart * apart).sum(1).tolist()
    exact = n * x.astype(object) - np.array(sums, object)
    return [d if d < 1 << 63 else None for d in (exact * exact).sum(1)]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 8) -> DataFrame:
    """One row per usable vector and component: ``component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or hold a null, NaN or infinite entry are dropped. The others
    must share one length: empty vectors, and those of another length than the most
    frequent one (of equally frequent ones the longest), cannot be projected and are
    left out of the fit too. Entries become ``floor(1024 c) + 100000``. Components are
    numbered from 1 by falling eigenvalue; those without variance (a share under 1e-12
    of the largest eigenvalue's bound) have no whitened value and no row, so a table
    of one vector, or of equal ones, gives no rows, like an empty one. ``deviation`` is
    null where its exact value exceeds a long. Repeated rows count each, null ids are
    ids, other columns are left out and may have any name.
    """
    rows = usable(vectors, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    lengths = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], f"{schema}, identity_error double")
    size = common["d"]
    rows = rows.where(F.size("v") == size)
    model = fit(rows, top)
    mean, count = _mean(model.sums, model.n), len(model.values)
    scale = model.vectors / np.sqrt(model.values) if count else np.zeros((size, 0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            x = scaled(batch, size)
            times = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(times)), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(times), model.n), pa.int64()),
                    pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(times)),
                    pa.array((_centred(x, mean) @ scale).ravel()), pa.array(np.tile(model.values / model.trace, len(x))),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained"],
            )

    out = written(rows.mapInArrow(project, schema), "whitened") if count else vectors.sparkSession.createDataFrame([], schema)
    return out.withColumn("identity_error", F.lit(_identity_error(rows, model, mean, scale, size)))


def _identity_error(rows: DataFrame, model: Whitening, mean, scale: np.ndarray, size: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""
    count = scale.shape[1]
    if not count:
        return 0.0
    white = lambda batch: _centred(scaled(batch, size), mean) @ scale
    middle = _summed(rows, lambda batch: white(batch).sum(0), count) / model.n

    def products(batch: pa.RecordBatch) -> np.ndarray:
        centred = white(batch) - middle
        return centred.T @ centred

    covariance = _summed(rows, products, count * count).reshape(count, count) / model.n
    return float(np.abs(covariance - np.eye(count)).max())
