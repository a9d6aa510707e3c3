"""Near copies among vectors: a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order. Vectors that share many
pivots are near each other, whatever the metric's values. Every vector is listed under its nearest
pivot and looks into the lists of its first few pivots; there the shared pivots are counted by
walking the inverted lists of the chunk, and only pairs with enough of them are verified on the
original vectors, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import spare_name, stored
from claimlode.llm.graph import components

#: Pivots that describe a vector.
WIDTH = 16
#: At least so many pivots; beyond that the square root of the largest group of comparable vectors.
LEAST_PIVOTS = 64
#: Share of pairs exactly at the threshold that the index must name, by which it is calibrated. Nearer pairs
#: share more pivots, so the share of all links that are found is higher.
RECALL = 0.98
#: Vectors, and random partners of each, on which the index is calibrated.
TRIALS, PARTNERS = 512, 4
#: Vectors, and vectors looking for them, of one list that meet in one task.
CHUNK = 2048
#: Pairs verified at once (32 MB of doubles at 64 dimensions).
VERIFIED = 65_536


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest entry goes to about one first, so that no square under- or overflows."""
    x = np.asarray(x, np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def fitted(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors of any length as rows of ``width`` values, cut or filled with zeros: only for describing them."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row[:width]
    return out


def described(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The ordered nearest pivots of each unit row."""
    width = min(WIDTH, len(pivots))
    near = x @ pivots.T
    some = np.argpartition(-near, width - 1, axis=1)[:, :width]
    order = np.lexsort((some, -np.take_along_axis(near, some, 1)), axis=1)
    return np.take_along_axis(some, order, 1).astype(np.int32)


def calibrated(x: np.ndarray, pivots: np.ndarray, threshold: float, seed: int = 1) -> tuple[int, int]:
    """(shared pivots to ask for, lists to look into) that name RECALL of the pairs at the threshold.

    Partners lie at exactly the threshold from given vectors, in random directions.
    """
    rng = np.random.default_rng(seed)
    x = np.repeat(x, PARTNERS, axis=0)
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1)[:, None] * x
    aside /= np.maximum(np.sqrt((aside * aside).sum(1)), 1e-300)[:, None]
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * aside
    a, b = described(x, pivots), described(y, pivots)
    shared = (a[:, :, None] == b[:, None, :]).sum((1, 2))
    least = max(1, int(np.quantile(shared, (1 - RECALL) / 2, method="lower")))
    width = a.shape[1]
    # place of one vector's nearest pivot in the other's order
    places = [np.where((of == first[:, :1]).any(1), (of == first[:, :1]).argmax(1), width) for first, of in ((a, b), (b, a))]
    place = np.where(shared >= least, np.minimum(*places), width)
    looks = next((r for r in range(1, width) if (place < r).mean() >= RECALL), width)
    return least, looks


def comparable(vectors: DataFrame, group: str) -> DataFrame:
    """(low, group_, size, copies, k1, k2, vector): each usable vector once per group, with its copies."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col(group).isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0))
    return (
        usable.groupBy(F.col(group).alias("group_"), x.alias("vector"))
        .agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
        .select("low", "group_", F.size("vector").alias("size"), "copies", *vector_key("group_", "vector"), "vector")
    )


def vector_key(group: str, vector: str) -> list:
    """128 bits that stand for a group and a vector."""
    return [F.xxhash64(F.lit(i), group, vector).alias(f"k{i}") for i in (1, 2)]


def apart(x: np.ndarray, wanted: int, threshold: float) -> np.ndarray:
    """The first ``wanted`` unit rows of which no two lie within twice the angle of the threshold.

    Reference points inside one group of near copies would tell its members apart by their order.
    """
    nearest = 2 * threshold * threshold - 1
    kept = np.zeros((0, x.shape[1]))
    for start in range(0, len(x), 256):
        some = x[start : start + 256]
        some = some[(some @ kept.T < nearest).all(1)]
        near = np.tril(some @ some.T >= nearest, -1)
        alone = np.ones(len(some), bool)
        for i in range(len(some)):
            alone[i] = not near[i, :i][alone[:i]].any()
        kept = np.concatenate((kept, some[alone]))
        if len(kept) >= wanted:
            break
    return kept[:wanted]


def reference_points(classes: DataFrame, wanted: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, vectors to calibrate on): unit vectors from a sample by hash, 4 x ``wanted`` + TRIALS rows at most."""
    rows = classes.select("k1", "k2", "vector").orderBy("k1", "k2").limit(4 * wanted + TRIALS).toArrow().column("vector")
    rows = [np.asarray(v, np.float64) for v in rows.to_pylist()]
    sizes, counts = np.unique([len(r) for r in rows], return_counts=True)
    x = fitted(rows, int(sizes[counts.argmax()]))
    x = unit_rows(x[(x != 0).any(1)])
    return apart(x[: 4 * wanted], wanted, threshold), x[-TRIALS:]


def indexed(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``classes`` with the ordered nearest pivots of each vector."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots = shared.value
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = fitted([np.asarray(v, np.float64) for v in part.column("vector").to_pylist()], pivots.shape[1])
                some = (x != 0).any(1)
                order = np.tile(np.arange(min(WIDTH, len(pivots)), dtype=np.int32), (len(x), 1))
                if some.any():
                    order[some] = described(unit_rows(x[some]), pivots)
                flat = pa.array(order.ravel())
                borders = pa.array(np.arange(len(x) + 1, dtype=np.int32) * order.shape[1])
                lists = pa.ListArray.from_arrays(borders, flat)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "pivots"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in classes.dtypes)
    return classes.mapInArrow(run, f"{kinds}, pivots array<int>")


def matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def shared_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many pivots each row of ``a`` shares with each row of ``b``, by walking the inverted lists."""
    counts = np.zeros((len(a), len(b)), np.uint8)
    both = np.intersect1d(a, b)
    lists = []
    for rows in (a, b):
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        lists.append((order // rows.shape[1], np.searchsorted(flat[order], both), np.searchsorted(flat[order], both, side="right")))
    (of_a, first_a, last_a), (of_b, first_b, last_b) = lists
    for i in range(len(both)):
        counts[of_a[first_a[i] : last_a[i], None], of_b[first_b[i] : last_b[i]]] += 1
    return counts


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` places reaches over links (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def verified(rows: pa.Table, lookers: pa.Table, least: int, looks: int, threshold: float) -> pa.Table:
    """(node, added, root): what the links between a chunk of a list and those who look into it add to each node.

    A pair may meet in two lists; it counts where the smaller node is the listed one, or where that is the
    only meeting.
    """
    empty = pa.table({"node": pa.array([], pa.int64()), "added": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    if not rows.num_rows or not lookers.num_rows:
        return empty
    a, b = matrix(rows.column("pivots"), np.int32), matrix(lookers.column("pivots"), np.int32)
    na, nb = rows.column("node").to_numpy(), lookers.column("node").to_numpy()
    i, j = np.nonzero(shared_counts(a, b) >= least)
    other = (a[i, :looks] == b[j, :1]).any(1)
    once = (na[i] != nb[j]) & ((na[i] < nb[j]) | ~other)
    i, j = i[once], j[once]
    x, y = unit_rows(matrix(rows.column("vector"), np.float64)), unit_rows(matrix(lookers.column("vector"), np.float64))
    parts = [slice(k, k + VERIFIED) for k in range(0, len(i), VERIFIED)]
    near = [np.einsum("ij,ij->i", x[i[p]], y[j[p]]) >= threshold for p in parts]
    if not near:
        return empty
    near = np.concatenate(near)
    i, j = i[near], j[near]
    nodes, at = np.unique(np.concatenate((na[i], nb[j])), return_inverse=True)
    at_a, at_b = at[: len(i)], at[len(i) :]
    copies_a, copies_b = rows.column("copies").to_numpy(), lookers.column("copies").to_numpy()
    added = np.zeros(len(nodes), np.int64)
    np.add.at(added, at_a, copies_b[j])
    np.add.at(added, at_b, copies_a[i])
    return pa.table({"node": nodes, "added": added, "root": nodes[local_roots(len(nodes), at_a, at_b)]})


LIST = ["group_", "size", "pivot"]


def cut_counts(rows: DataFrame, name: str) -> DataFrame:
    """Lists longer than a chunk, and into how many chunks each is cut."""
    long = rows.groupBy(*LIST).count().where(F.col("count") > CHUNK)
    return long.select(*LIST, F.ceil(F.col("count") / CHUNK).cast("int").alias(name))


def meet(index: DataFrame, least: int, looks: int, threshold: float) -> DataFrame:
    """(node, added, root) of all tasks. No task sees more than about CHUNK listed and CHUNK looking vectors."""
    columns = ["node", "group_", "size", "copies", "pivots", "vector"]
    listed = index.select(*columns, F.get("pivots", F.lit(0)).alias("pivot"))
    looking = index.select(*(F.col(c).alias(c) for c in columns), F.explode(F.slice("pivots", 1, looks)).alias("pivot"))
    # One row per list of more than CHUNK vectors: a table smaller than the index by that factor at least.
    cuts = cut_counts(listed, "parts").join(cut_counts(looking, "looker_parts"), LIST, "full")
    cuts = stored(cuts.select(*LIST, F.coalesce("parts", F.lit(1)).alias("parts"), F.coalesce("looker_parts", F.lit(1)).alias("looker_parts")), "pivot-cuts")

    def dealt(rows: DataFrame, mine: str, theirs: str, part: str, other: str) -> DataFrame:
        rows = rows.join(cuts, LIST, "left")
        own = F.pmod(F.xxhash64("node"), F.coalesce(mine, F.lit(1))).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.coalesce(theirs, F.lit(1)) - 1))
        return rows.withColumn(part, own).withColumn(other, each).drop("parts", "looker_parts")

    left = dealt(listed, "parts", "looker_parts", "part", "looker_part")
    right = dealt(looking, "looker_parts", "parts", "looker_part", "part")
    keys = [*LIST, "part", "looker_part"]

    def run(rows: pa.Table, lookers: pa.Table) -> pa.Table:
        return verified(rows, lookers, least, looks, threshold)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "node long, added long, root long")


def near_copies(vectors: DataFrame, threshold: float = 0.93, group: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector, links between vectors of one ``group``.

    Vectors of a group link when their cosine in double precision is at least ``threshold``; those of different
    length never do. Null, zero and non-finite vectors, and rows without a group or an id, link with nothing:
    their component is their own id. Equal vectors are one node of the index and link with each other.
    Repeated rows are vectors of their own. Every vector is indexed and described by the same pivots, a sample
    by hash of the table; how many pivots two vectors must share and how many lists a vector looks into is
    calibrated for RECALL of the pairs exactly at the threshold. An empty table gives an empty result; columns
    besides vec_id, embedding and ``group`` do not matter.
    """
    own = spare_name(vectors, "group_")
    rows = vectors.select("vec_id", "embedding", F.col(group).alias(own)).withColumnRenamed(own, "group_")
    classes = stored(comparable(rows, "group_").withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("group_", "size").count().agg(F.max("count")).first()[0]
    alone = [F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
    if not largest:
        return rows.select("vec_id", *alone)
    pivots, trials = reference_points(classes, max(LEAST_PIVOTS, math.ceil(math.sqrt(largest))), threshold)
    least, looks = calibrated(trials, pivots, threshold)
    index = stored(indexed(classes, pivots), "pivot-index")
    found = stored(meet(index, least, looks, threshold), "pivot-links")
    labels = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("node").agg(F.sum("added").alias("added"))
    nodes = index.select("node", "low", "copies", "k1", "k2").join(sums, "node", "left").join(labels, "node", "left")
    nodes = nodes.withColumn("label", F.coalesce("label", "node"))
    lowest = nodes.groupBy("label").agg(F.min("low").alias("component_id"))
    told = nodes.join(lowest, "label").select(
        "k1", "k2", "component_id", (F.col("copies") - 1 + F.coalesce("added", F.lit(0))).alias("n_links")
    )
    keyed = rows.select("vec_id", *vector_key("group_", "embedding"))
    # Rows that take no part have no class; their key matches nothing.
    joined = keyed.join(told, ["k1", "k2"], "left")
    takes_part = F.col("vec_id").isNotNull() & F.col("n_links").isNotNull()
    return joined.select(
        "vec_id",
        F.when(takes_part, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(takes_part, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
