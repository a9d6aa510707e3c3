"""Approximate nearest neighbours: inverted lists scanned dimension block by dimension block.

Vectors are rotated at random, so that any few coordinates tell as much as any others, and kept in
blocks of coordinates. Within each probed list a hypothesis test on the partial distance abandons
most candidates after the first blocks. Survivors are measured exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlode.llm.common import stored

#: The list centres are fitted on at most so many rows, those with the smallest id hashes.
SAMPLE_ROWS = 16_384
MAX_LISTS = 1024
#: Share of the lists that each query looks into, nearest centres first, and the least number of them. Vectors that
#: hardly cluster need three quarters for 0.98 of their neighbours (0.55: 0.9); clustered ones far fewer.
PROBE_SHARE, LEAST_PROBES = 0.75, 32
#: Rows of a list, and queries of a list, that meet in one task.
CHUNK_ROWS, CHUNK_QUERIES = 16_384, 4096
#: Coordinates in a block, and how far a partial distance may lie under its expectation.
BLOCK, MARGIN = 16, 2.1
#: Rotated distances are single precision; this much slack keeps every possible winner.
SLACK = 1 + 1e-4


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) rows that take part: neither null nor zero, all components finite numbers.

    Vectors of another length than most of the table's take no part either.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select("vec_id", "embedding").where(x.isNotNull() & F.col("vec_id").isNotNull() & ~bad & F.exists(x, lambda v: v != 0))
    sizes = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size(x) == (sizes[0]["d"] if sizes else 0))


def centres(rows: DataFrame, n: int, seed: int = 1) -> np.ndarray:
    """List centres by a few rounds of k-means on a bounded sample."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("embedding").toArrow()
    if not sample.num_rows:
        return np.zeros((1, 1))
    x = np.unique(np.array(sample.column(0).to_pylist(), np.float64), axis=0)
    n_lists = max(1, min(MAX_LISTS, len(x), round(np.sqrt(n))))
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), n_lists, replace=False)]
    for _ in range(8):
        own = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=n_lists)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def rotation(d: int, seed: int = 1) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """A column of lists of equal length as a matrix."""
    n = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(n, -1)


def placed(rows: DataFrame, c: np.ndarray, probes: int, turn: np.ndarray | None = None) -> DataFrame:
    """Per row its ``probes`` nearest lists (rank 0 is its own) and, with ``turn``, the rotated vector."""
    shared = rows.sparkSession.sparkContext.broadcast((c, turn))  # at most MAX_LISTS centres
    kind = dict(rows.dtypes)["embedding"]
    names = ["vec_id", "list", "nth", "vector"] + ["rotated"] * (turn is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, turn = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("embedding"), np.float64)
            near = np.argsort((c * c).sum(1) - 2 * x @ c.T, axis=1, kind="stable")[:, :probes]
            width = near.shape[1]
            of = pa.array(np.repeat(np.arange(len(x)), width))
            columns = [
                batch.column("vec_id").take(of),
                pa.array(near.ravel().astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(x))),
                batch.column("embedding").take(of),
            ]
            if turn is not None:
                flat = pa.array((x @ turn).astype(np.float32).ravel())
                borders = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                columns.append(pa.ListArray.from_arrays(borders, flat).take(of))
            yield pa.record_batch(columns, names=names)

    schema = f"vec_id long, list int, nth int, vector {kind}" + ", rotated array<float>" * (turn is not None)
    return rows.mapInArrow(run, schema)


def scan(query: np.ndarray, blocks: list[np.ndarray], limit: float, k: int) -> np.ndarray:
    """Positions of candidates that may be among the ``k`` nearest within squared distance ``limit``.

    ``blocks`` hold the candidates' rotated coordinates, one matrix (coordinates x candidates) per
    block. A candidate is abandoned when its partial distance, scaled up to all dimensions,
    lies above the limit by more than the test's margin.
    """
    n, d = blocks[0].shape[1], len(query)
    found, squares = [np.zeros(0, np.int64)], np.zeros(0)
    start, size = 0, 4 * k
    while start < n:
        at = np.arange(start, min(n, start + size))
        partial, done = np.zeros(len(at)), 0
        for block in blocks:
            step = block.shape[0]
            gap = block[:, at] - query[done : done + step, None]
            partial = partial + np.einsum("ij,ij->j", gap, gap)
            done += step
            bound = limit * SLACK if done == d else limit * done / d * (1 + MARGIN / np.sqrt(done)) ** 2
            alive = partial <= bound
            at, partial = at[alive], partial[alive]
            if not len(at):
                break
        found.append(at)
        squares = np.concatenate((squares, partial))
        if len(squares) > k:
            limit = min(limit, float(np.partition(squares, k - 1)[k - 1]))
        start, size = start + size, 2048
    at = np.concatenate(found)
    return at[squares <= limit * SLACK]


def chunk_counts(rows: DataFrame, each: int) -> dict[int, int]:
    """How many chunks each list is cut into; one number per list."""
    return {r["list"]: -(-r["count"] // each) for r in rows.groupBy("list").count().collect()}


def chunked(rows: DataFrame, own: dict[int, int], other: dict[int, int], mine: str, theirs: str) -> DataFrame:
    """Spread the rows of a list over its own chunks, and repeat each for the other side's chunks."""
    lists = max([0, *own, *other]) + 1
    counts = F.array(*(F.lit(own.get(i, 1)) for i in range(lists)))
    repeats = F.array(*(F.lit(other.get(i, 0)) for i in range(lists)))
    spread = F.pmod(F.xxhash64("vec_id"), F.get(counts, F.col("list"))).cast("int")
    numbers = F.sequence(F.lit(0), F.get(repeats, F.col("list")) - 1)
    return (
        rows.where(F.get(repeats, F.col("list")) > 0)
        .withColumn(mine, spread)
        .withColumn(theirs, F.explode(numbers))
    )


def search_lists(index: DataFrame, probes: DataFrame, sizes: dict[int, int], turn: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` nearest per query and chunk of a probed list.

    ``probes`` hold (vec_id, list, vector, reach): lists to look into, and the distance that
    a find must not exceed. No chunk holds more than CHUNK_ROWS rows and CHUNK_QUERIES queries.
    """
    wanted = chunk_counts(probes, CHUNK_QUERIES)
    left = chunked(index, sizes, wanted, "part", "q_part")
    right = chunked(probes, wanted, sizes, "q_part", "part")

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if rows.num_rows and queries.num_rows:
            x, rotated = matrix(rows.column("vector"), np.float64), matrix(rows.column("rotated"), np.float32)
            blocks = [
                np.ascontiguousarray(rotated[:, i : i + BLOCK].T) for i in range(0, rotated.shape[1], BLOCK)
            ]
            ids = rows.column("vec_id").to_numpy()
            q = matrix(queries.column("vector"), np.float64)
            turned = (q @ turn).astype(np.float32)
            reach = queries.column("reach").to_numpy()
            for i, query_id in enumerate(queries.column("vec_id").to_numpy()):
                # the query's own row may be among the finds, so one more is kept
                at = scan(turned[i], blocks, float(reach[i]) ** 2 * SLACK, k + 1)
                at = at[ids[at] != query_id]
                distance = np.sqrt(((x[at] - q[i]) ** 2).sum(1))
                best = np.lexsort((ids[at], distance))[:k]
                for column, values in zip(out, (np.full(len(best), query_id), ids[at][best], distance[best]), strict=True):
                    column.append(values)
        kinds = (np.int64, np.int64, np.float64)
        arrays = [np.concatenate([np.zeros(0, kind), *c]) for c, kind in zip(out, kinds, strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, arrays), strict=True)))

    keys = ["list", "part", "q_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id long, vec_id long, score double"
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` nearest finds by Euclidean distance.

    Ties go to the smaller vec_id; a row with the query's own id is no candidate. Null, zero and
    non-finite vectors take no part, as query or candidate. Repeated query ids count once;
    repeated rows are separate candidates. Empty tables give an empty result. All rows are
    indexed; only the centres come from a sample (SAMPLE_ROWS).

    A query first scans its nearest list, then the others knowing how near its finds are.
    """
    rows = usable(vectors)
    counted = rows.agg(F.count(F.lit(1))).first()[0]
    c = centres(rows, counted)
    turn = rotation(c.shape[1])
    index = stored(placed(rows, c, 1, turn).drop("nth"), "vector-lists")
    sizes = chunk_counts(index, CHUNK_ROWS)
    asked = usable(queries).dropDuplicates(["vec_id"])
    looks = stored(placed(asked, c, max(LEAST_PROBES, int(np.ceil(share * len(c))))).withColumn("reach", F.lit(float("inf"))), "vector-probes")

    first = stored(search_lists(index, looks.where("nth = 0"), sizes, turn, k), "first-finds")
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    reach = (
        first.withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") == k)
        .select(F.col("query_id").alias("vec_id"), F.col("score").alias("near"))
    )
    rest = looks.where("nth > 0").join(reach, "vec_id", "left")
    rest = rest.withColumn("reach", F.coalesce("near", "reach")).drop("near")
    finds = first.unionByName(search_lists(index, rest, sizes, turn, k))
    ranked = finds.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
