"""Exact top-k search: blocks of queries meet chunks of the corpus inside the tasks.

Queries and corpus rows are packed into rows of some thousand vectors. Every task pairs the chunks of one
part of the corpus with one part of the query blocks, both read from stored tables: neither a query
vector nor a corpus row passes the driver, and the corpus is not shuffled. Each task keeps the k
best rows per query, so only those are. With many queries the parts of the corpus are few and large: the
rows to merge are queries x k x parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlode.functions.vectors import (
    INNER,
    L2,
    METRICS,
    RANK_DIGITS,
    dense,
    gains,
    rank_keys,
    score_against,
)
from claimlode.session import stored

# Queries in a block, and corpus rows in a chunk: 6 MB each at 384 floats.
BLOCK_QUERIES = 4_096
CHUNK_ROWS = 4_096
# Query values and hits that one task holds (16 MB of doubles); more queries scan the corpus again.
SCAN_VALUES = 1 << 21
# What a held hit counts as: its row, key, score, place and carried columns.
HIT_VALUES = 16
# Corpus values that one task reads when there are several scans (256 MB of floats).
PART_VALUES = 1 << 26
# Tasks per core that a search with several scans is cut into, where the corpus has so many splits.
TASKS_PER_CORE = 3
# Score cells computed at once inside a task (32 MB of doubles).
TILE_CELLS = 4_000_000
# Queries and rows whose single-precision products are looked at together (1 MB, so that they stay in a core's cache).
SIFT_QUERIES, SIFT_ROWS = 256, 1_024
# Rows that give a task its first floors; then it takes as many as it has seen.
FIRST_ROWS = 512
# Longest vectors whose single-precision products can neither overflow nor lose their bound.
SINGLE_LENGTH = 1e15
# Candidates that a task holds unsorted at most.
HELD_CELLS = 1_000_000
# Candidates of a query are ranked in so many slices first, then the slices' best.
SLICES = 16
# Rounding moves a score by at most half a step; one step of slack keeps every possible tie.
SLACK = 10.0**-RANK_DIGITS


@dataclass
class QueryBlock:
    """A bounded set of queries: ids, their matrix and the gains below which a row cannot enter a result."""

    ids: pa.Array
    matrix: np.ndarray
    floor: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.lengths = np.sqrt((self.matrix**2).sum(1))
        # False also for NaN
        self.short = bool((self.lengths < SINGLE_LENGTH).all())
        self.single = self.matrix.astype(np.float32) if self.short else None

    def __len__(self) -> int:
        return len(self.ids)


def packed(rows: DataFrame, vector: str, size: int) -> DataFrame:
    """Up to ``size`` rows of a task as one: every column becomes an array, ``vector`` one flat array of all values."""
    names = rows.columns
    schema = T.StructType(
        [
            field if field.name == vector else T.StructField(field.name, T.ArrayType(field.dataType))
            for field in rows.schema
        ]
    )

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        columns = []
        for name in names:
            column = table.column(name).combine_chunks()
            if name == vector:
                lengths = column.value_lengths().to_numpy()
                if lengths.min() != lengths.max():
                    raise ValueError("vectors of unequal dimension in one table")
                column = column.flatten()
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, size - count)
                held.append(part)
                start, count = start + part.num_rows, count + part.num_rows
                if count == size:
                    yield one(held)
                    held, count = [], 0
        if held:
            yield one(held)

    return rows.mapInArrow(pack, schema)


def require_unique(queries: DataFrame, query_id: str) -> None:
    """Two vectors under one id would share its k hits. Only a number reaches the driver."""
    most = queries.groupBy(query_id).count().agg(F.max("count")).first()[0]
    refuse_repeats(most, query_id)


def refuse_repeats(most: int | None, query_id: str) -> None:
    if (most or 0) > 1:
        raise ValueError(f"{query_id} is not unique among the queries")


def query_table(
    queries: DataFrame, query_id: str, vector: str, block_queries: int, floor: str | None = None, k: int = 1
) -> DataFrame:
    """All queries with a vector as a stored table of blocks (_block, _ids, _floors, _values).

    A repeated id is an error. The table has one partition per SCAN_VALUES values, hits included.
    """
    return _query_scans(queries, query_id, vector, block_queries, floor, k)[0]


def _query_scans(
    queries: DataFrame, query_id: str, vector: str, block_queries: int, floor: str | None, k: int, cells: str | None = None, probes: int = 0
) -> tuple[DataFrame, int]:
    """(:func:`query_table`, its number of partitions); with the ``cells`` that a query probes, ``probes`` of them on average, as _cells."""
    usable = queries.where(F.col(vector).isNotNull()).select(
        F.col(query_id).alias("_ids"),
        (F.col(floor) if floor else F.lit(None)).cast("double").alias("_floors"),
        F.col(vector).alias("_values"),
        *([F.col(cells).alias("_cells")] if cells else []),
    )
    blocks = packed(usable.repartition("_ids"), "_values", block_queries)
    blocks = stored(blocks.withColumn("_block", F.monotonically_increasing_id()), "query-blocks")
    each = blocks.select(F.posexplode("_ids").alias("_at", "_id"), F.size("_values").cast("bigint").alias("_size"))
    counted = each.groupBy("_id").agg(F.count("*").alias("_n"), F.sum(F.when(F.col("_at") == 0, F.col("_size"))).alias("_size"))
    most, values, asked = counted.agg(F.max("_n"), F.sum("_size"), F.count("*")).first()
    refuse_repeats(most, query_id)
    scans = max(1, -(-((values or 0) + asked * (k * HIT_VALUES + probes)) // SCAN_VALUES))
    # By range the blocks are dealt evenly: they are few, so all of them are in the planner's sample.
    return (blocks.coalesce(1) if scans == 1 else blocks.repartitionByRange(scans, "_block")), scans


class _Best:
    """The k best rows (or groups) per query seen so far by one task, in long form."""

    def __init__(self, block: QueryBlock, k: int, distinct: str | None):
        self.k, self.distinct = k, distinct
        self.query = np.empty(0, np.int64)
        self.gain = np.empty(0)
        self.rows: pa.Table | None = None
        self.seen = 0
        self.held: list[tuple[np.ndarray, np.ndarray, pa.Table]] = []
        self.held_cells = 0
        # A row below its query's floor can no longer enter the result.
        self.floor = np.full(len(block), -np.inf) if block.floor is None else block.floor.copy()

    def hold(self, query: np.ndarray, gain: np.ndarray, rows: pa.Table) -> None:
        """Take candidates; they are ranked when they are many beside the hits, as few hardly move the floors."""
        self.held.append((query, gain, rows))
        self.held_cells += len(query)
        if self.held_cells > min(HELD_CELLS, self.k * len(self.floor) // 4):
            self.settle()

    def settle(self) -> None:
        """Rank the candidates held so far."""
        if self.held_cells:
            query, gain, rows = zip(*self.held)
            self.add(np.concatenate(query), np.concatenate(gain), pa.concat_tables(rows))
        self.held, self.held_cells = [], 0

    def add(self, query: np.ndarray, gain: np.ndarray, rows: pa.Table) -> None:
        query = np.concatenate([self.query, query])
        gain = np.concatenate([self.gain, gain])
        rows = rows if self.rows is None else pa.concat_tables([self.rows, rows])
        row_id, key = rows.column(0).to_numpy(), rank_keys(gain)
        if self.distinct is None:
            order = np.lexsort((row_id, key, query))
        else:
            group = group_codes(rows.column(self.distinct))
            order = np.lexsort((row_id, key, group, query))
            order = order[_changes(query[order], group[order])]
            order = order[np.lexsort((row_id[order], key[order], query[order]))]
        ranked = query[order]
        place = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        order, place = order[place < self.k], place[place < self.k]
        self.query, self.gain, self.rows = query[order], gain[order], rows.take(pa.array(order))
        full = place == self.k - 1
        kth = self.query[full]
        self.floor[kth] = np.maximum(self.floor[kth], self.gain[full] - SLACK)

    def candidates(
        self, queries: np.ndarray, gain: np.ndarray, group: np.ndarray | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query place, row place) of the tile's cells that may enter the result."""
        floor = self.floor[queries]
        keep = gain >= floor[:, None]
        if np.count_nonzero(keep) > 4 * self.k * len(queries):
            best = gain
            if group is not None:
                order = np.argsort(group, kind="stable")
                starts = np.flatnonzero(_changes(group[order]))
                best = np.maximum.reduceat(gain[:, order], starts, axis=1)
                slot = np.empty(len(group), np.int64)
                slot[order] = np.cumsum(_changes(group[order])) - 1
            if best.shape[1] > self.k:
                kth = np.partition(best, -self.k, axis=1)[:, -self.k]
                floor = np.maximum(floor, kth - SLACK)
            keep = gain >= floor[:, None]
            if group is not None:
                keep &= gain >= best[:, slot] - SLACK
        return np.nonzero(keep)


class _Some:
    """The best rows of some queries of a block, by their places in it."""

    def __init__(self, best: _Best, at: np.ndarray):
        self.best, self.at, self.k, self.distinct = best, at, best.k, best.distinct

    @property
    def floor(self) -> np.ndarray:
        return self.best.floor[self.at]

    @property
    def seen(self) -> int:
        return self.best.seen

    @seen.setter
    def seen(self, rows: int) -> None:
        self.best.seen = rows

    def candidates(self, queries: np.ndarray, gain: np.ndarray, group: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        return self.best.candidates(self.at[queries], gain, group)

    def hold(self, query: np.ndarray, gain: np.ndarray, rows: pa.Table) -> None:
        self.best.hold(self.at[query], gain, rows)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted sequence of key columns starts a new key."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def group_codes(column: pa.ChunkedArray) -> np.ndarray:
    codes = column.combine_chunks().dictionary_encode().indices
    return codes.fill_null(-1).to_numpy(zero_copy_only=False)


def usable_rows(matrix: np.ndarray, metric: str) -> np.ndarray:
    """One NaN would blur the ranking of its whole tile, and a zero vector has no direction."""
    finite = np.isfinite(matrix).all(1)
    return finite & matrix.any(1) if metric == INNER else finite


def set_cells(mask: np.ndarray) -> np.ndarray:
    """Places of the true cells in the flat mask; true ones are few, so eight cells are looked at together."""
    flat = mask.reshape(-1)
    if flat.size % 8:
        return np.flatnonzero(flat)
    eights = np.flatnonzero(flat.view(np.uint64))
    at = np.flatnonzero(flat.reshape(-1, 8)[eights])
    return eights[at >> 3] * 8 + (at & 7)


def sift(
    block: QueryBlock, part: slice, single: np.ndarray, longest: float, floor: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray] | None:
    """(query place in the part, row place) of all cells whose inner product may reach the query's floor.

    Products are taken in single precision; the limit lies below the floor by more than their rounding can
    amount to (half an epsilon per input and step of the sum), so no cell is missed. None if there are more than ``most``.
    """
    queries, dim = block.single[part], single.shape[1]
    error = (dim + 4) * float(np.finfo(np.float32).eps) * block.lengths[part] * longest
    limit = np.nextafter((floor[part] - error - dim * 1e-37).astype(np.float32), np.float32(-np.inf))
    found, count = [], 0
    for start in range(0, len(single), SIFT_ROWS):
        product = queries @ single[start : start + SIFT_ROWS].T
        cells = set_cells(product >= limit[:, None])
        count += len(cells)
        if count > most:
            return None
        query, row = np.divmod(cells, product.shape[1])
        found.append((query, row + start))
    query, row = zip(*found)
    return np.concatenate(query), np.concatenate(row)


def offer(best: _Best | _Some, block: QueryBlock, matrix: np.ndarray, rows: pa.Table, metric: str) -> None:
    """Score rows against all queries of a block, tile by tile, and keep what may enter the result.

    Inner products are sifted in single precision, and computed in double where they come near a floor. Where many
    cells do, or floors are not known yet, all products of the tile are computed in double.
    """
    good = usable_rows(matrix, metric)
    if not good.all():
        matrix, rows = matrix[good], rows.filter(pa.array(good))
    if not len(block) or not len(matrix):
        return
    group = group_codes(rows.column(best.distinct)) if best.distinct else None
    longest = float(np.sqrt((matrix**2).sum(1).max()))
    quick = metric == INNER and block.short and longest < SINGLE_LENGTH
    single = matrix.astype(np.float32) if quick else None
    first = 0
    while first < len(matrix):
        end = min(len(matrix), first + max(FIRST_ROWS, best.seen))
        step = max(1, min(SIFT_QUERIES, TILE_CELLS // (end - first)))
        found, count = [], 0
        for start in range(0, len(block), step):
            part = slice(start, min(len(block), start + step))
            some = np.arange(part.start, part.stop)
            near = None
            if quick and np.isfinite(best.floor[part]).all():
                near = sift(block, part, single[first:end], longest, best.floor, 4 * best.k * len(some))
            if near is None:
                gain = gains(block.matrix[part], matrix[first:end], metric)
                q, r = best.candidates(some, gain, None if group is None else group[first:end])
                query, gain, place = some[q], gain[q, r], r + first
            else:
                query, place = near[0] + start, near[1] + first
                gain = np.einsum("ij,ij->i", block.matrix[query], matrix[place])
                reach = gain >= best.floor[query]
                query, gain, place = query[reach], gain[reach], place[reach]
            found.append((query, gain, place))
            count += len(query)
            if count > HELD_CELLS or part.stop == len(block):
                query, gain, place = (np.concatenate(column) for column in zip(*found))
                best.hold(query, gain, rows.take(pa.array(place)))
                found, count = [], 0
        best.seen += end - first
        first = end


def probing(cells: pa.ListArray) -> dict[int, np.ndarray]:
    """Places of the queries that probe each cell."""
    cell = cells.flatten().to_numpy()
    query = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy())
    order = np.argsort(cell, kind="stable")
    starts = np.flatnonzero(_changes(cell[order]))
    return dict(zip(cell[order][starts].tolist(), np.split(query[order], starts[1:]), strict=True))


def offer_cells(
    best: _Best, block: QueryBlock, asked: dict[int, np.ndarray], cell: np.ndarray, matrix: np.ndarray, rows: pa.Table, metric: str
) -> None:
    """:func:`offer` where a query takes only rows of the cells it probes."""
    found = np.unique(cell)
    if all(len(asked.get(c, ())) == len(block) for c in found.tolist()):
        offer(best, block, matrix, rows, metric)
        return
    for c in found.tolist():
        if c in asked:
            at, inside = asked[c], np.flatnonzero(cell == c)
            some = QueryBlock(block.ids.take(pa.array(at)), block.matrix[at])
            offer(_Some(best, at), some, matrix[inside], rows.take(pa.array(inside)), metric)


def told(best: _Best, block: QueryBlock, metric: str, names: list[str]) -> pa.Table:
    """A task's settled candidates: (query id, row id, carried columns, _key, score)."""
    score = best.gain if metric == INNER else -best.gain
    columns = [
        block.ids.take(pa.array(best.query)),
        *[column.combine_chunks() for column in best.rows.columns],
        pa.array(rank_keys(best.gain)),
        pa.array(score),
    ]
    return pa.Table.from_arrays(columns, names=names)


def hit_schema(query_field: T.StructField, fields: list[T.StructField]) -> T.StructType:
    return T.StructType(
        [query_field, *fields, T.StructField("_key", T.LongType()), T.StructField("score", T.DoubleType())]
    )


def narrowed(corpus: DataFrame, row_id: str, vector: str, carry: tuple[str, ...], *more: str) -> DataFrame:
    return corpus.select(F.col(row_id).cast("long").alias(row_id), *carry, *more, vector).where(F.col(vector).isNotNull())


def _scan(
    corpus: DataFrame,
    blocks: DataFrame,
    query_field: T.StructField,
    k: int,
    metric: str,
    row_id: str,
    vector: str,
    carry: tuple[str, ...],
    distinct: str | None,
    scans: int = 1,
    cell: str | None = None,
) -> DataFrame:
    """Candidates of every task: (query id, row id, carried columns, _key, score).

    With the corpus' column ``cell`` a query takes only rows of its _cells.
    """
    kept = [row_id, *carry]
    narrow = narrowed(corpus, row_id, vector, carry, *([F.col(cell).cast("int").alias("_cell")] if cell else []))
    schema = hit_schema(query_field, [narrow.schema[name] for name in kept])
    names = schema.fieldNames()
    chunks = packed(narrow, vector, CHUNK_ROWS)
    if scans > 1:
        chunks = _corpus_parts(chunks, vector, scans)
    # Each task reads its chunks once and goes through its blocks for each; no row is shuffled or broadcast.
    met = chunks.crossJoin(blocks.hint("shuffle_replicate_nl"))

    def best_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[QueryBlock, _Best, dict[int, np.ndarray]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column("_block")[i].as_py()
                if number not in seen:
                    ids = batch.column("_ids")[i].values
                    matrix = batch.column("_values")[i].values.to_numpy(zero_copy_only=False)
                    floor = batch.column("_floors")[i].values.to_numpy(zero_copy_only=False)
                    floor = np.where(np.isnan(floor), -np.inf, floor)
                    block = QueryBlock(ids, matrix.astype(np.float64).reshape(len(ids), -1), floor)
                    asked = probing(batch.column("_cells")[i].values) if cell else {}
                    seen[number] = block, _Best(block, k, distinct), asked
                block, best, asked = seen[number]
                rows = pa.table([batch.column(name)[i].values for name in kept], names=kept)
                matrix = batch.column(vector)[i].values.to_numpy(zero_copy_only=False)
                matrix = matrix.astype(np.float64).reshape(len(rows), -1)
                if cell:
                    offer_cells(best, block, asked, batch.column("_cell")[i].values.to_numpy(), matrix, rows, metric)
                else:
                    offer(best, block, matrix, rows, metric)
        for block, best, _ in seen.values():
            best.settle()
            if len(best.query):
                yield from told(best, block, metric, names).to_batches(max_chunksize=10_000)

    return met.mapInArrow(best_rows, schema)


def _corpus_parts(chunks: DataFrame, vector: str, scans: int) -> DataFrame:
    """The chunks as a stored table, packed once for all scans, in parts of PART_VALUES or as many as keep the cores busy."""
    kept = stored(chunks.withColumn("_size", F.size(vector).cast("bigint")), "corpus-chunks")
    values = kept.agg(F.sum("_size")).first()[0] or 0
    cores = kept.sparkSession.sparkContext.defaultParallelism
    return kept.drop("_size").coalesce(max(1, -(-values // PART_VALUES), -(-TASKS_PER_CORE * cores // scans)))


def _merge(
    found: DataFrame, query_id: str, row_id: str, carry: tuple[str, ...], k: int, distinct: str | None
) -> DataFrame:
    """The final k per query from the tasks' candidates, with their rank, in two steps.

    First the k best of each (query, slice), then of each query: however many tasks there were, the last
    step sees at most SLICES x k rows of a query.
    """
    sliced = F.pmod(F.xxhash64(distinct or row_id), F.lit(SLICES)).cast("int")
    # One shuffle serves the grouping and the first ranking; equal groups fall into one slice.
    found = found.withColumn("_slice", sliced).repartition(query_id, "_slice")
    if distinct is not None:
        rest = [name for name in found.columns if name not in (query_id, "_slice", distinct)]
        ordered = F.struct("_key", row_id, *[n for n in rest if n not in ("_key", row_id)])
        found = (
            found.groupBy(query_id, "_slice", distinct)
            .agg(F.min(ordered).alias("_first"))
            .select(query_id, "_slice", distinct, "_first.*")
        )
    for keys in ([query_id, "_slice"], [query_id]):
        order = Window.partitionBy(*keys).orderBy("_key", row_id)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select(query_id, "rank", row_id, *carry, "score")


def _floors(seed_hits: DataFrame, query_id: str, k: int, metric: str) -> DataFrame:
    """The gain that a query's k-th hit in a part of the corpus already reaches."""
    gain = F.col("score") if metric == INNER else -F.col("score")
    full = seed_hits.groupBy(query_id).agg(F.count("*").alias("_n"), F.min(gain).alias("_gain"))
    return full.where(F.col("_n") >= k).select(query_id, (F.col("_gain") - SLACK).alias("_floor"))


def topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    metric: str = INNER,
    *,
    query_id: str = "query_id",
    row_id: str = "row_id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
    distinct: str | None = None,
    seed: DataFrame | None = None,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Exact k best corpus rows per query: (query_id, rank, row_id, carried columns, score).

    Best means the largest inner product or the smallest squared distance, rounded to
    ``RANK_DIGITS`` places, ties by ``row_id``. With ``distinct`` only the best row of each value
    of that column counts, so a query gets k different values whenever the corpus has them.

    Queries come in blocks of ``block_queries``; the corpus is scanned once for every SCAN_VALUES of their
    values and hits, which bounds what a task holds. ``seed`` may be any part of the corpus, e.g. one batch: its k-th scores let every task
    drop hopeless rows at once, which keeps the shuffle small when the corpus has very many
    partitions. It never changes the result.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    carry = tuple(carry)
    if distinct is not None and distinct not in carry:
        carry += (distinct,)
    asked = queries.select(query_id, vector)
    blocks, scans = _query_scans(asked, query_id, vector, block_queries, None, k)
    plan = (queries.schema[query_id], k, metric, row_id, vector, carry, distinct, scans)
    if seed is not None:
        early = _merge(_scan(seed, blocks, *plan), query_id, row_id, carry, k, distinct)
        floors = _floors(early, query_id, k, metric)
        blocks, _ = _query_scans(asked.join(floors, query_id, "left"), query_id, vector, block_queries, "_floor", k)
    return _merge(_scan(corpus, blocks, *plan), query_id, row_id, carry, k, distinct)


def topk_inner(queries: DataFrame, corpus: DataFrame, k: int = 10, **options) -> DataFrame:
    """The k largest inner products per query."""
    return topk(queries, corpus, k, INNER, **options)


def topk_l2(queries: DataFrame, corpus: DataFrame, k: int = 5, **options) -> DataFrame:
    """The k smallest squared distances per query."""
    return topk(queries, corpus, k, L2, **options)


def first_occurrence(
    df: DataFrame, group: str, key: str, order: tuple[str, ...], carry: tuple[str, ...] = ()
) -> DataFrame:
    """Each key once per group, at its smallest ``order``, with the carried columns of that row."""
    if len(order) == 1 and not set(carry) - set(order):
        # A plain minimum aggregates by hash; a struct minimum would sort.
        return df.groupBy(group, key).agg(F.min(order[0]).alias(order[0]))
    first = F.min(F.struct(*order, *[name for name in carry if name not in order]))
    return df.groupBy(group, key).agg(first.alias("_first")).select(group, key, "_first.*")


def rerank(df: DataFrame, group: str, order: tuple[str, ...], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows per group in ``order``, numbered from 1."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def topk_distinct(
    queries: DataFrame,
    corpus: DataFrame,
    group: str = "patent_id",
    k: int = 10,
    overfetch: int | None = None,
    metric: str = INNER,
    **options,
) -> DataFrame:
    """The k best groups per query, each by its best row.

    With ``overfetch`` only the k * overfetch best rows are looked at, so one group with many good
    rows can leave fewer than k groups. ``overfetch=None`` is exact and never short.
    """
    if overfetch is None:
        return topk(queries, corpus, k, metric, distinct=group, **options)
    query_id, row_id = options.get("query_id", "query_id"), options.get("row_id", "row_id")
    carry = tuple(dict.fromkeys([*options.pop("carry", ()), group]))
    hits = topk(queries, corpus, k * overfetch, metric, carry=carry, **options)
    rest = tuple(name for name in (row_id, *carry, "score") if name != group)
    firsts = first_occurrence(hits, query_id, group, ("rank",), rest)
    return rerank(firsts, query_id, ("rank",), k, "place").select(
        query_id, F.col("place").alias("rank"), row_id, *carry, "score"
    )


def pick_query(df: DataFrame, position: str, text: str) -> DataFrame:
    """The row of lowest position as the one query of a list."""
    first = F.min(F.struct(position, *[c for c in df.columns if c != position])).alias("_first")
    return df.where(F.col(text).isNotNull()).agg(first).select("_first.*")


def rank_all(
    query: DataFrame,
    corpus: DataFrame,
    metric: str = INNER,
    *,
    vector: str = "embedding",
    name: str = "score",
) -> DataFrame:
    """Every corpus row with its score for one query; a projection, nothing is shuffled."""
    rows = query.select(vector).where(F.col(vector).isNotNull()).limit(2).toArrow()
    if rows.num_rows != 1:
        raise ValueError("rank_all takes exactly one query vector")
    _, matrix = dense(rows.column(0).combine_chunks())
    score = score_against(matrix[0], metric)
    return corpus.where(F.col(vector).isNotNull()).withColumn(name, score(F.col(vector)))
