"""Vector columns: ``array<float>`` in, computed in double.

The lambda forms suit per-row projections. Scoring many rows against given vectors goes through
the Arrow functions at the end, where one matrix product handles a whole batch. Those are marked
nondeterministic so that the optimizer never evaluates them a second time inside a filter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are ranked after rounding to this many places, so that the order does not depend on the
# summation order of a float32 product; the row id settles ties.
RANK_DIGITS = 6

INNER = "inner"
L2 = "l2"
METRICS = (INNER, L2)
# Only for scoring against one vector; searches normalise first and use the inner product.
COSINE = "cosine"


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda total, x: total + x)


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_sq(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""

    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return _sum(F.zip_with(a, b, square))


def norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null when one has length zero."""
    return inner_product(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def l2_normalize(v: Column) -> Column:
    """Unit vector as ``array<float>``; a zero vector gives null and so stays out of searches."""
    # The one-element transform makes the length a lambda variable: it is computed once per row.
    scaled = F.transform(
        F.array(norm(v)),
        lambda length: F.when(
            length > 0, F.transform(v, lambda x: (x.cast("double") / length).cast("float"))
        ),
    )
    return F.element_at(scaled, 1)


def vector_dim(v: Column) -> Column:
    return F.array_size(v)


def require_dim(v: Column, dim: int) -> Column:
    """The vector as ``array<float>``; the job fails on any other dimension. Null passes."""
    message = F.concat(F.lit(f"expected dimension {dim}, found "), F.array_size(v).cast("string"))
    fits = v.isNull() | (F.array_size(v) == dim)
    return F.when(fits, v.cast("array<float>")).otherwise(F.raise_error(message))


def parse_vector(text: Column) -> Column:
    """'[0.1,0.2]' as ``array<float>``."""
    return F.from_json(text, "array<float>")


def format_vector(v: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(v.cast("array<string>"), ","), F.lit("]"))


def rounded(score: Column, digits: int = RANK_DIGITS) -> Column:
    """Score for display and comparison; minus zero becomes zero."""
    return F.round(score, digits) + F.lit(0.0)


# ---- batch helpers, run inside tasks ---------------------------------------------------------


def dense(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the non-null vectors, their matrix in double)."""
    present = np.flatnonzero(np.asarray(vectors.is_valid()))
    if len(present) == 0:
        return present, np.empty((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width, rest = divmod(len(flat), len(present))
    lengths = vectors.value_lengths().drop_null()
    if rest or pc.min(lengths).as_py() != width:
        raise ValueError("vectors of unequal dimension in one table")
    return present, flat.astype(np.float64).reshape(len(present), width)


def gains(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """queries x rows scores, larger is better: inner product, or minus the squared distance."""
    product = queries @ rows.T
    if metric == INNER:
        return product
    squares = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
    return -np.maximum(squares - 2.0 * product, 0.0)


def rank_keys(gain: np.ndarray, digits: int = RANK_DIGITS) -> np.ndarray:
    """Integer sort keys, smaller is better: the gain rounded half away from zero."""
    steps = np.floor(np.abs(gain) * 10.0**digits + 0.5)
    return -np.copysign(steps, gain).astype(np.int64)


def score_against(vector: np.ndarray, metric: str):
    """Arrow function scoring each row against one fixed vector.

    The cosine of a zero vector is null.
    """
    fixed = np.asarray(vector, dtype=np.float64)[None, :]

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        present, matrix = dense(vectors)
        out = np.full(len(vectors), np.nan)
        if len(present) and metric == L2:
            out[present] = -gains(fixed, matrix, L2)[0]
        elif len(present):
            out[present] = gains(fixed, matrix, INNER)[0]
        if len(present) and metric == COSINE:
            lengths = np.sqrt((matrix**2).sum(1) * (fixed**2).sum())
            out[present] /= np.where(lengths > 0, lengths, np.nan)
        return pa.array(out, mask=np.isnan(out))

    return score.asNondeterministic()


def nearest_ids(ids: np.ndarray, matrix: np.ndarray, metric: str, count: int):
    """Arrow function giving the ``count`` best of some fixed vectors per row, best first.

    Each entry holds its sort key and the vector's number, so that lists from several blocks of
    fixed vectors can be merged by sorting.
    """
    order = np.argsort(ids, kind="stable")
    labels, points = np.asarray(ids)[order].astype(np.int32), np.asarray(matrix)[order]
    count = min(count, len(labels))

    @F.arrow_udf("array<struct<key: bigint, cell: int>>")
    def nearest(vectors: pa.Array) -> pa.Array:
        present, rows = dense(vectors)
        best = np.empty((len(present), count), dtype=np.int64)
        keys = np.empty((len(present), count), dtype=np.int64)
        step = max(1, 4_000_000 // len(labels))
        for start in range(0, len(present), step):
            part = slice(start, start + step)
            all_keys = rank_keys(gains(rows[part], points, metric))
            best[part] = np.argsort(all_keys, axis=1, kind="stable")[:, :count]
            keys[part] = np.take_along_axis(all_keys, best[part], axis=1)
        lengths = np.zeros(len(vectors) + 1, dtype=np.int32)
        lengths[1:][present] = count
        pairs = pa.StructArray.from_arrays(
            [pa.array(keys.ravel()), pa.array(labels[best.ravel()])], names=["key", "cell"]
        )
        missing = ~np.asarray(vectors.is_valid())
        ends = pa.array(np.cumsum(lengths), pa.int32())
        return pa.ListArray.from_arrays(ends, pairs, mask=pa.array(missing))

    return nearest.asNondeterministic()
