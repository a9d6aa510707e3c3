"""Whitening of embeddings: the leading components of their covariance by contour integration.

Counts, sums and the covariance are gathered by Spark over all distinct vectors. The covariance has as many
rows as a vector has entries, whatever the number of vectors; its leading eigenpairs are found by
the FEAST method. Inertia counts (how many eigenvalues lie above a number) enclose the wanted ones in
intervals; a quadrature over a circle around each, every point one complex shifted solve, projects a
few vectors onto its eigenspace; Rayleigh-Ritz extracts the components; the count of eigenvalues in
the interval tells that none is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import stored

#: Points of the quadrature on the upper half circle.
POINTS = 16
#: Rounds of projection, and the residual (against the matrix's norm) at which they end.
ROUNDS, RESIDUAL = 40, 2e-15
#: Eigenvalues below this share of the largest are no components: their direction is rounding.
FLAT = 1e-10


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``v`` (Householder)."""
    v = v.copy()
    d = len(v)
    for i in range(d - 2):
        x = v[i + 1 :, i].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        x[0] += math.copysign(length, x[0])
        x /= np.linalg.norm(x)
        v[i + 1 :, i:] -= 2 * np.outer(x, x @ v[i + 1 :, i:])
        v[i:, i + 1 :] -= 2 * np.outer(v[i:, i + 1 :] @ x, x)
    return np.diag(v).copy(), np.diag(v, -1).copy()


def above(diagonal: np.ndarray, beside: np.ndarray, at: float) -> int:
    """Inertia: the number of eigenvalues above ``at``, as positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny
    count, pivot = 0, 1.0
    squares = np.concatenate(([0.0], beside**2))
    for a, b in zip(diagonal.tolist(), squares.tolist(), strict=True):
        pivot = (a - at) - b / (pivot if pivot else tiny)
        count += pivot > 0
    return count


def eigenvalue_at(diagonal: np.ndarray, beside: np.ndarray, place: int, top: float) -> float:
    """The eigenvalue of that place, falling from 1, by halving on inertia counts."""
    low, high = -top, top
    while high - low > 1e-14 * top:
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if above(diagonal, beside, middle) >= place else (low, middle)
    return (low + high) / 2


def intervals(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, count): intervals that together hold the ``wanted`` largest eigenvalues, and how many each holds.

    Eigenvalues closer than a hundredth of their size share an interval; each ends in the middle of the gaps beside it.
    A cluster at the lower end that cannot be told apart goes in whole, so the last may hold more than is wanted;
    eigenvalues that are zero up to rounding stay out.
    """
    radius = np.abs(diagonal) + np.append(np.abs(beside), 0) + np.append(0, np.abs(beside))
    top = max(float(radius.max()), np.finfo(float).tiny) * (1 + 1e-12)
    curved = above(diagonal, beside, FLAT * eigenvalue_at(diagonal, beside, 1, top))
    wanted = min(wanted, curved)
    values = [eigenvalue_at(diagonal, beside, place, top) for place in range(1, min(wanted + 1, len(diagonal)) + 1)]
    while wanted < curved and values[wanted - 1] - values[wanted] < 1e-9 * top:
        wanted += 1
        if wanted < len(diagonal):
            values.append(eigenvalue_at(diagonal, beside, wanted + 1, top))
    starts = [0] + [i for i in range(1, wanted) if values[i - 1] - values[i] > 0.01 * abs(values[i - 1])]
    out = []
    for first, after in zip(starts, [*starts[1:], wanted], strict=True):
        gaps = [values[i] - values[i + 1] for i in (first - 1, after - 1) if 0 <= i < len(values) - 1]
        edge = min([*gaps, max(values[first] - values[after - 1], 0.1 * top)]) / 2
        low, high = values[after - 1] - edge, values[first] + edge
        out.append((low, high, above(diagonal, beside, low) - above(diagonal, beside, high)))
    return out


def contour_projection(v: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """``y`` projected on the eigenspace of the interval: one complex shifted solve per quadrature point."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    middle, radius = (low + high) / 2, (high - low) / 2
    total = np.zeros_like(y)
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(1j * math.pi * (1 - x) / 2)
        shifted = np.linalg.solve((middle + radius * turn) * np.eye(len(v)) - v, y.astype(complex))
        total += w * (radius * turn * shifted).real / 2
    return total


def eigenspace(v: np.ndarray, low: float, high: float, held: int, seed: int) -> np.ndarray:
    """Orthonormal vectors of the ``held`` eigenvalues of the interval; fails if it does not find as many."""
    size = min(len(v), max(held + 4, 2 * held))
    rng = np.random.default_rng(seed)
    best, best_gap, waited = None, math.inf, 0
    y = rng.normal(size=(len(v), size))
    for _ in range(ROUNDS):
        q = np.linalg.qr(contour_projection(v, y, low, high))[0]
        e, turn = np.linalg.eigh(q.T @ v @ q)
        y = q @ turn
        inside = (e > low) & (e < high)
        gap = float(np.abs(v @ y[:, inside] - y[:, inside] * e[inside]).max(initial=0.0))
        waited += 1
        if inside.sum() == held and gap < best_gap / 2:
            best, best_gap, waited = y[:, inside], gap, 0
        if best_gap < RESIDUAL or (best_gap < 1e-13 and waited):
            break
        if waited > 4 and size < len(v):  # more eigenvalues press on the circle than there are vectors
            y = np.concatenate((y, rng.normal(size=(len(v), min(size, len(v) - size)))), axis=1)
            size, waited = y.shape[1], 0
    if best is None or best_gap > 1e-10:
        raise ArithmeticError(f"{held} eigenvalues lie in {low} .. {high}, found {inside.sum()} with residual {gap}")
    return best


def leading(v: np.ndarray, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Fewer where the matrix has fewer that are not zero up to rounding.
    """
    scale = float(np.abs(v).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    v = v / scale
    found = [eigenspace(v, *each, seed) for each in intervals(*tridiagonal(v), wanted)]
    q = np.linalg.qr(np.concatenate(found, axis=1))[0]
    e, turn = np.linalg.eigh(q.T @ v @ q)
    e, u = e[::-1], (q @ turn)[:, ::-1]
    keep = (np.arange(len(e)) < wanted) & (e > FLAT * e[0])
    return e[keep] * scale, u[:, keep]


@dataclass
class Fit:
    """What whitens a vector: exact count and sums, mean, components as columns, eigenvalues, their shares."""

    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    shares: np.ndarray


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): usable vectors with each entry c as floor(256 c), of the length that most have."""
    c = F.col("embedding")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select("vec_id", "embedding").where(c.isNotNull() & ~bad & (F.size(c) > 0))
    sizes = rows.groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    x = F.transform(c, lambda v: F.floor(v.cast("double") * 256).cast("long"))
    return rows.where(F.size(c) == (sizes[0]["d"] if sizes else 0)).select("vec_id", x.alias("x"))


def entries(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def summed(parts: DataFrame) -> np.ndarray:
    """Rows (i, values) of all tasks added up by i: bounded by the length of a vector."""
    added = (
        parts.select("i", F.posexplode("values").alias("j", "value"))
        .groupBy("i", "j")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    i, j = added.column("i").to_numpy(), added.column("j").to_numpy()
    out = np.zeros((i.max(initial=-1) + 1, j.max(initial=-1) + 1))
    out[i, j] = added.column("value").to_numpy()
    return out


def products(rows: DataFrame, mean: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """The sum over all rows of (x - mean)(x - mean)^T, the difference first turned by ``turn``, if given."""
    shared = rows.sparkSession.sparkContext.broadcast((mean, turn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, turn = shared.value
        total = None
        for batch in batches:
            if batch.num_rows:
                away = entries(batch.column("x")) - mean
                away = away if turn is None else away @ turn
                total = away.T @ away + (0 if total is None else total)
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], names=["i", "values"])

    return summed(rows.mapInArrow(run, "i int, values array<double>"))


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension, exact beyond 64 bits."""
    each = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
    told = rows.agg(F.count(F.lit(1)).alias("n"), *each).first()
    return told["n"], [int(told[f"s{i}"] or 0) for i in range(d)]


def fit(rows: DataFrame, wanted: int) -> tuple[Fit, float] | None:
    """The whitening fitted on each distinct x once, and the largest entry by which its covariance misses the identity."""
    once = stored(rows.select("x").distinct(), "distinct-vectors")
    first = once.limit(1).collect()
    if not first:
        return None
    n, sums = exact_sums(once, len(first[0]["x"]))
    mean = np.array([s / n for s in sums])
    v = products(once, mean) / n
    e, u = leading((v + v.T) / 2, wanted)
    if not len(e):
        return None
    white = products(once, mean, u / np.sqrt(e)) / n
    trace = float(np.trace(v))
    return Fit(n, sums, mean, u, e, e / trace), float(np.abs(white - np.eye(len(e))).max())


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 per row; null where it needs more than 64 bits."""
    bound = max(n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)), 1)
    if bound * bound * x.shape[1] < 1 << 63:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    if n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)) < 1 << 62:
        # high and low halves: exact in 64 bits as long as the sum is
        away = (n * x - np.array(sums, np.int64)).astype(object)
    else:
        away = x.astype(object) * n - np.array(sums, object)
    return [value if value < 1 << 63 else None for value in (away * away).sum(1).tolist()]


def whitened(vectors: DataFrame, wanted: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per usable vector and component.

    Vectors that are null or empty, hold null or non-finite entries, or have another length than most of the
    table's take no part; zero vectors do. Every other row is whitened, repeated ones and those with a null id too, but
    the fit holds each distinct vector once. Components without variance are left out: none for a single
    distinct vector or an empty table. A deviation of more than 64 bits is null. Columns besides vec_id and
    embedding do not matter.
    """
    rows = whole_numbers(vectors)
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    told = fit(rows, wanted)
    if told is None:
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, error = shared.value
        width = len(model.eigenvalues)
        turn = model.components / np.sqrt(model.eigenvalues)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = entries(batch.column("x"))
            count = len(x) * width
            of = pa.array(np.repeat(np.arange(len(x)), width))
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(of),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(count, model.n)),
                    pa.array(exact_deviations(x, model.n, model.sums), pa.int64()).take(of),
                    pa.array(((x - model.mean) @ turn).ravel()),
                    pa.array(np.tile(model.shares, len(x))),
                    pa.array(np.full(count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
