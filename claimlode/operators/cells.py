"""Cell index: k-means centroids, corpus laid out by cell, search in the nearest cells only."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlode.functions.vectors import INNER, METRICS, dense, gains, nearest_ids, rank_keys
from claimlode.operators.joins import grid_cut
from claimlode.operators.search import (
    BLOCK_QUERIES,
    CHUNK_ROWS,
    QueryBlock,
    _Best,
    _merge,
    _query_scans,
    _scan,
    hit_schema,
    narrowed,
    offer,
    require_unique,
    told,
)
from claimlode.session import stored

# Centroids handed to the tasks at once.
BLOCK_CENTROIDS = 16_384
# Rows of one cell that meet its probes in one task; a larger cell is cut.
CELL_ROWS = 65_536
# Blocks of probes that meet them there; more probes are cut too, and the cell's rows repeated for each part.
CELL_BLOCKS = 8
# Above so many probes, if they cover DENSE of all pairs of a query and a row, cells are scanned by blocks of queries instead.
DENSE_PROBES, DENSE = CELL_BLOCKS * BLOCK_QUERIES, 0.25


def train_cells(
    sample: DataFrame,
    nlist: int = 1000,
    metric: str = INNER,
    seed: int = 42,
    iterations: int = 20,
    vector: str = "embedding",
    row_id: str = "row_id",
) -> DataFrame:
    """k-means centroids (cell, centroid) of a training part of the corpus.

    The part is sorted by row id first, so a rerun starts from the same points. Null vectors and those with a
    NaN or infinite value take no part, nor do zero vectors for the inner product: they have no direction.
    """
    measure = "cosine" if metric == INNER else "euclidean"
    usable = F.forall(vector, lambda x: F.abs(x) < float("inf"))  # NaN is above infinity
    if metric == INNER:
        usable &= F.exists(vector, lambda x: x != 0)
    points = (
        sample.where(usable)
        .repartitionByRange(row_id)
        .sortWithinPartitions(row_id)
        .select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    )
    model = KMeans(k=nlist, seed=seed, maxIter=iterations, distanceMeasure=measure).fit(points)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return sample.sparkSession.createDataFrame(rows, "cell int, centroid array<double>")


def cell_centroids(df: DataFrame, cell: str = "cell", vector: str = "embedding") -> DataFrame:
    """Mean vector per cell, combined on the map side."""
    features = array_to_vector(F.col(vector).cast("array<double>"))
    means = df.where(F.col(vector).isNotNull()).groupBy(cell).agg(
        Summarizer.mean(features).alias("_mean")
    )
    return means.select(
        F.col(cell).cast("int").alias("cell"), vector_to_array("_mean").alias("centroid")
    )


def centroid_blocks(centroids: DataFrame, size: int = BLOCK_CENTROIDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cells, matrix) of all centroids, in blocks of ``size``: a model's parameters, never rows of the corpus."""
    usable = centroids.select("cell", "centroid").where(F.col("centroid").isNotNull()).orderBy("cell")
    table = usable.toArrow().combine_chunks()
    cells = table.column("cell").to_numpy()
    _, matrix = dense(table.column("centroid").combine_chunks()) if len(cells) else (None, None)
    for start in range(0, len(cells), size):
        yield cells[start : start + size], matrix[start : start + size]


def nearest_cells(
    df: DataFrame,
    centroids: DataFrame,
    count: int,
    metric: str,
    vector: str = "embedding",
    block_centroids: int = BLOCK_CENTROIDS,
) -> DataFrame:
    """Add ``cells``, the ``count`` nearest cells of each vector, best first.

    Centroids go to the tasks in blocks of bounded size; the blocks' lists are merged by score.
    """
    lists = [
        nearest_ids(cells, matrix, metric, count)(F.col(vector))
        for cells, matrix in centroid_blocks(centroids, block_centroids)
    ]
    if not lists:
        raise ValueError("no centroids")
    best = lists[0] if len(lists) == 1 else F.slice(F.array_sort(F.concat(*lists)), 1, count)
    return df.withColumn("cells", F.transform(best, lambda pair: pair["cell"]))


def assign_cells(
    corpus: DataFrame, centroids: DataFrame, metric: str = INNER, vector: str = "embedding"
) -> DataFrame:
    """Add each row's ``cell``; equal scores go to the lowest cell. Row-local, no shuffle."""
    found = nearest_cells(corpus.where(F.col(vector).isNotNull()), centroids, 1, metric, vector)
    return found.withColumn("cell", F.element_at("cells", 1)).drop("cells")


@dataclass
class CellTree:
    """Cells grouped under coarse cells, and how many coarse cells a vector has to look into."""

    cells: np.ndarray
    matrix: np.ndarray
    group: np.ndarray
    coarse: np.ndarray
    looks: int


def nearest_in_tree(tree: CellTree, rows: np.ndarray, metric: str, looks: int) -> tuple[np.ndarray, int]:
    """(each row's best cell among its ``looks`` nearest coarse cells, comparisons made)."""
    order = np.argsort(-gains(rows, tree.coarse, metric), axis=1, kind="stable")[:, :looks]
    best = np.full(len(rows), -1, np.int64)
    keys = np.full(len(rows), np.iinfo(np.int64).max)
    compared = rows.shape[0] * len(tree.coarse)
    for group in np.unique(order):
        inside = np.flatnonzero((order == group).any(1))
        members = np.flatnonzero(tree.group == group)
        if not len(members):
            continue
        found = rank_keys(gains(rows[inside], tree.matrix[members], metric))
        compared += found.size
        place = found.argmin(1)
        key, cell = found[np.arange(len(inside)), place], tree.cells[members[place]]
        # equal scores go to the lowest cell, whichever group it is in
        nearer = (key < keys[inside]) | (key == keys[inside]) & (cell < best[inside])
        keys[inside[nearer]], best[inside[nearer]] = key[nearer], cell[nearer]
    return best, compared


def cell_tree(
    centroids: DataFrame,
    sample: DataFrame,
    metric: str = INNER,
    agreement: float = 0.995,
    sample_rows: int = 2_000,
    vector: str = "embedding",
    row_id: str = "row_id",
    seed: int = 42,
) -> CellTree:
    """A two-level quantiser over trained centroids: cells of cells.

    The centroids are clustered into about the square root of their number. How many coarse cells a vector looks
    into is the least that gives ``agreement`` with the flat assignment on ``sample_rows`` rows of ``sample``,
    those of lowest id hash; with clustered data that is a few, and an assignment compares some multiple of the square root of
    the number of cells. Looking into all of them is the flat assignment. Fails without centroids.
    """
    blocks = list(centroid_blocks(centroids))
    if not blocks:
        raise ValueError("no centroids")
    cells, matrix = (np.concatenate(part) for part in zip(*blocks))
    n_coarse = math.ceil(math.sqrt(len(cells)))
    points = centroids.select(F.col("cell").alias(row_id), F.col("centroid").alias(vector))
    groups = train_cells(points, n_coarse, metric, seed, vector=vector, row_id=row_id)
    coarse = np.concatenate([block for _, block in centroid_blocks(groups)])
    tree = CellTree(cells, matrix, np.argmax(gains(matrix, coarse, metric), axis=1), coarse, len(coarse))
    some = sample.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(row_id), row_id).limit(sample_rows)
    _, rows = dense(some.select(vector).toArrow().column(0).combine_chunks())
    rows = rows[np.isfinite(rows).all(1)] if len(rows) else rows
    if len(rows):
        flat, _ = nearest_in_tree(tree, rows, metric, len(coarse))
        for looks in range(1, len(coarse)):
            if (nearest_in_tree(tree, rows, metric, looks)[0] == flat).mean() >= agreement:
                tree.looks = looks
                break
    return tree


def assign_cells_by_tree(
    corpus: DataFrame, tree: CellTree, metric: str = INNER, vector: str = "embedding", looks: int | None = None
) -> DataFrame:
    """Add each row's ``cell`` and the ``compared`` centroids; row-local. ``looks`` overrides the tree's own.

    Rows without a vector are left out, as in :func:`assign_cells`; a vector with a NaN or infinite value gets a null cell.
    """
    wide = tree.looks if looks is None else looks

    @F.arrow_udf("struct<cell: int, compared: double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        _, rows = dense(vectors)
        cells, each = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        good = np.isfinite(rows).all(1) if len(rows) else np.zeros(0, bool)
        for start in range(0, int(good.sum()), 8192):
            at = np.flatnonzero(good)[start : start + 8192]
            cells[at], compared = nearest_in_tree(tree, rows[at], metric, wide)
            each[at] = compared / len(at)
        return pa.StructArray.from_arrays([pa.array(cells.astype(np.int32), mask=~good), pa.array(each)], names=["cell", "compared"])

    found = corpus.where(F.col(vector).isNotNull()).withColumn("_found", nearest.asNondeterministic()(F.col(vector)))
    return found.withColumns({"cell": F.col("_found.cell"), "compared": F.col("_found.compared")}).drop("_found")


def write_cells(assigned: DataFrame, path: str) -> None:
    """Lay the corpus out as one folder per cell.

    The rebalance hint gathers each cell's rows and lets the adaptive planner cut a hot cell into
    several tasks, and so files, of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    gathered = assigned.hint("rebalance", F.col("cell"))
    gathered.write.mode("overwrite").partitionBy("cell").parquet(path)


def probe_join(probes: DataFrame, cells: DataFrame) -> DataFrame:
    """Corpus rows of the probed cells only.

    On a table partitioned by cell the semi join prunes the other folders at run time.
    """
    return cells.join(probes.select("cell").distinct(), "cell", "left_semi")


def _dense(asked: DataFrame, cells: DataFrame) -> tuple[bool, int]:
    """(whether the probes are many and cover a large share of all pairs of a query and a row, probes of a query on average)."""
    probes, queries = asked.agg(F.sum(F.size("cells")), F.count("*")).first()
    if (probes or 0) <= DENSE_PROBES:
        return False, 0
    asking = asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("_asking"))
    held = cells.groupBy("cell").agg(F.count("*").alias("_rows"))
    pairs = F.sum(F.col("_asking").cast("double") * F.col("_rows"))
    pairs, rows = held.join(asking, "cell", "left").agg(pairs, F.sum("_rows")).first()
    return (pairs or 0) >= DENSE * (rows or 0) * queries, -(-probes // queries)


def _search_probes(
    near: DataFrame,
    cells: DataFrame,
    k: int,
    metric: str,
    query_id: str,
    row_id: str,
    vector: str,
    carry: tuple[str, ...],
    distinct: str | None,
    block_queries: int,
) -> DataFrame:
    """Candidates of the probed cells; ``near`` holds (query id, the cells it probes, vector), stored. Only folders of probed cells are read.

    Where the probes cover a large share of all pairs, a task takes a part of the rows and of the queries, as in the exact search,
    and compares a query with the rows of its cells: vectors are neither repeated per probe nor shuffled, and a query has k candidates
    per part, not per cell. Otherwise the probes and the rows of a cell meet in tasks of bounded size: a cell with more than
    CELL_ROWS rows or CELL_BLOCKS x ``block_queries`` probes is cut into parts on both sides. Inside a task a block of
    probes goes through the rows in chunks, so that its best hits so far already drop most rows of the next chunk.
    """
    probes = near.select(query_id, F.explode("cells").alias("cell"), vector)
    dense_probes, each = _dense(near, cells)
    if dense_probes:
        wanted = stored(probes.select("cell").distinct(), "probed-cells")
        rows = probe_join(wanted, narrowed(cells, row_id, vector, carry, "cell"))
        blocks, scans = _query_scans(near, query_id, vector, block_queries, None, k, "cells", each)
        return _scan(rows, blocks, near.schema[query_id], k, metric, row_id, vector, carry, distinct, scans, "cell")
    kept = [row_id, *carry]
    rows = probe_join(probes, narrowed(cells, row_id, vector, carry, "cell"))
    asked = probes.select("cell", F.col(query_id).alias("_query"), F.col(vector).alias("_asked"))
    left, right = grid_cut(rows, asked, "cell", CELL_ROWS, CELL_BLOCKS * block_queries)
    schema = hit_schema(near.schema[query_id], [rows.schema[name] for name in kept])
    names = schema.fieldNames()

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        kinds = [asked.schema.field("_query").type, *(rows.schema.field(name).type for name in kept), pa.int64(), pa.float64()]
        found = [pa.table([pa.array([], kind) for kind in kinds], names=names)]
        for first in range(0, asked.num_rows if rows.num_rows else 0, block_queries):
            some = asked.slice(first, block_queries)
            _, wanted = dense(some.column("_asked").combine_chunks())
            block = QueryBlock(some.column("_query").combine_chunks(), wanted)
            best = _Best(block, k, distinct)
            for start in range(0, rows.num_rows, CHUNK_ROWS):
                chunk = rows.slice(start, CHUNK_ROWS)
                _, matrix = dense(chunk.column(vector).combine_chunks())
                offer(best, block, matrix, chunk.select(kept).combine_chunks(), metric)
            best.settle()
            if len(best.query):
                found.append(told(best, block, metric, names))
        return pa.concat_tables(found)

    keys = ["cell", "_left_part", "_right_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def search_cells(
    queries: DataFrame,
    cells: DataFrame,
    centroids: DataFrame,
    k: int = 10,
    nprobe: int = 1,
    metric: str = INNER,
    *,
    query_id: str = "query_id",
    row_id: str = "row_id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
    distinct: str | None = None,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Approximate top-k: each query meets only the rows of its ``nprobe`` nearest cells.

    Probes and cell rows meet by cell on the executors, hot cells cut on both sides; only the probed
    cells' folders are read, each once. A query may get fewer than k rows; nothing is padded. A
    repeated query id is an error.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    carry = tuple(carry)
    if distinct is not None and distinct not in carry:
        carry += (distinct,)
    usable = queries.select(query_id, vector).where(F.col(vector).isNotNull())
    require_unique(usable, query_id)
    near = stored(nearest_cells(usable, centroids, nprobe, metric, vector), "cell-order")
    found = _search_probes(near, cells, k, metric, query_id, row_id, vector, carry, distinct, block_queries)
    return _merge(found, query_id, row_id, carry, k, distinct)


def search_cells_until(
    queries: DataFrame,
    cells: DataFrame,
    centroids: DataFrame,
    group: str = "patent_id",
    k: int = 10,
    nprobe: int = 1,
    metric: str = INNER,
    *,
    query_id: str = "query_id",
    row_id: str = "row_id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k best groups per query, each by its best row, probing further cells while a query has fewer than k.

    A query reads its ``nprobe`` nearest cells first. While it has found fewer than k different values of ``group``, its
    number of cells doubles, until all are read. So a result is only short if the whole corpus has fewer groups,
    and a search that starts with all cells is the exact one. ``probed`` tells how many cells a query has
    read. Each round reads only the cells it adds, for the queries that are short.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    carry = tuple(dict.fromkeys([*carry, group]))
    usable = queries.select(query_id, vector).where(F.col(vector).isNotNull())
    require_unique(usable, query_id)
    total = centroids.where(F.col("centroid").isNotNull()).count()
    order = stored(nearest_cells(usable, centroids, total, metric, vector), "cell-order")
    pending, hits, read, upto, rounds = order, None, 0, min(nprobe, total), []
    while True:
        some = F.slice("cells", read + 1, upto - read).alias("cells")
        near = pending.select(query_id, some, vector)
        found = _search_probes(near, cells, k, metric, query_id, row_id, vector, carry, group, block_queries)
        hits = found if hits is None else hits.unionByName(found)
        rounds.append(pending.select(query_id, F.lit(upto).alias("probed")))
        if upto >= total:
            break
        hits = stored(hits, "cell-hits")
        full = hits.groupBy(query_id).agg(F.count_distinct(group).alias("_groups")).where(F.col("_groups") >= k)
        pending = stored(pending.join(full, query_id, "left_anti"), "short-queries")
        if pending.isEmpty():
            break
        read, upto = upto, min(total, 2 * upto)
    probed = rounds[0]
    for more in rounds[1:]:
        probed = probed.unionByName(more)
    probed = probed.groupBy(query_id).agg(F.max("probed").alias("probed"))
    best = _merge(hits, query_id, row_id, carry, k, group)
    return best.join(probed, query_id).select(*best.columns, "probed")


@dataclass
class CellIndex:
    """A corpus laid out by cell with its centroids, and how many cells a query reads at first."""

    cells: DataFrame
    centroids: DataFrame
    nprobe: int = 1


def build_index(
    corpus: DataFrame, sample: DataFrame, path: str, nlist: int = 1000, nprobe: int = 1, metric: str = INNER, **training
) -> CellIndex:
    """Train centroids on ``sample``, lay the corpus out by cell below ``path``, open the result.

    Rows without a vector have no cell and are not in the index.
    """
    centroids = stored(train_cells(sample, nlist, metric, **training), "centroids")
    write_cells(assign_cells(corpus, centroids, metric), path)
    return CellIndex(corpus.sparkSession.read.parquet(path), centroids, nprobe)
