"""Exact Jaccard join of shingle sets: count-vector R-trees over blocks of sets that share a rare-enough shingle.

Two sets that are alike share one of their first shingles in any fixed order; here the less common come first, then
the smaller hash. Each shingle names a block. A set's shingles are hashed into groups and counted; the sum of the
smaller counts bounds how many two sets share. In a block, all sets are first held against its first one, the head, and what is alike is
linked. Blocks of one head make a star. Only stars whose sets are not all connected by then go on: an R-tree over
the counts finds the pairs of different components whose bound is high enough. Surviving pairs are verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import (
    list_array,
    merged_sections,
    mixed,
    sections,
    shingle_hashes,
    shingle_rows,
    slices,
    spare_name,
    stored,
    utf8,
    whole_array,
    word_borders,
    word_keys,
)
from claimlode.llm.graph import components

#: Words in a shingle; sets are linked when 100 * shared >= PERCENT * all.
SHINGLE, PERCENT = 5, 75
#: Mean count of a group at most: so few that sets that are not alike seldom look so by their counts.
PER_GROUP = 2
#: Sets of a part of a star, and shingles of the sets held against one other, that meet in one task.
BLOCK_ROWS, ROOM_SHINGLES = 4096, 1 << 18
#: Stars of at most LEAF sets are one leaf; larger ones are trees of FAN children a box.
LEAF, FAN = 32, 8
#: Cells of the count vectors, and pairs of boxes, that a tree join holds against each other at once.
PAIR_CELLS, PAIR_ROWS = 1 << 20, 1 << 15
#: Shingles fall into 2**COMMON_BITS buckets; a bucket above these shares of all buckets in use is common, the more the later.
COMMON_BITS, COMMON = 22, (0.75, 0.94, 0.985, 0.996, 0.999)
#: Shingles of a range that one task names blocks by, and shingles that a task sorts before it deals them out.
SECTION_SHINGLES, DEALT_SHINGLES = 1 << 16, 1 << 20
#: Documents to read again fall into so many numbers.
WANTED_NUMBERS = 1 << 20
#: Cells of the table of buckets that travel in one row.
SECTION = 1 << 14
#: Texts hashed at once: few enough that the arrays stay in a core's cache.
_SLICE = 512 << 10


def required(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that sets of ``n`` and ``m`` must share: 100 s >= percent (n + m - s)."""
    return -(-percent * (n + m) // (100 + percent))


def groups(n: np.ndarray) -> np.ndarray:
    """Number of groups for sets of ``n`` shingles, a power of two."""
    return 1 << np.ceil(np.log2(np.maximum(n / PER_GROUP, 1))).astype(np.int64)


def text_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes per text in ascending order, and their borders; A-Z lower-cased."""
    data, offsets = utf8(column)
    starts, ends, rows = word_borders(data, offsets)
    return shingle_hashes(word_keys(data, starts, ends), rows, len(column), SHINGLE)


def commonness(docs: DataFrame) -> np.ndarray:
    """How common the shingles of each of 2**COMMON_BITS buckets are, from 0 to len(COMMON).

    Counted over all texts, repeats included. A bucket's rank among all tells, not its count, so at any size the same share of
    them is common, and a passage of many texts stands out from the sum of the rare ones. The table has the same size for any corpus;
    the driver gets a byte per bucket. It only orders shingles, so what shares a bucket costs time and changes no result.
    """

    bits = COMMON_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                data, offsets = utf8(part.column("text"))
                starts, ends, rows = word_borders(data, offsets)
                hashes, _ = shingle_rows(word_keys(data, starts, ends), rows, part.num_rows, SHINGLE)
                np.add.at(total, bucket(hashes, bits), np.uint32(1))
        yield from sections(np.minimum(total, 65_535).astype(np.uint16).astype(np.uint32), SECTION)

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = [(8 * np.log2(1 + np.frombuffer(c.as_buffer(), np.uint32))).astype(np.uint8).tobytes() for c in batch.column("cells")]
            yield pa.record_batch({"section": batch.column("section"), "cells": pa.array(steps, pa.binary())})

    counted = docs.select("text").mapInArrow(run, "section int, cells binary")
    summed = merged_sections(counted, np.add, "u4").mapInArrow(as_bytes, "section int, cells binary")
    steps = whole_array(summed, 1 << bits, SECTION, "u1")
    used = steps[steps > 0]
    limits = np.quantile(used, COMMON, method="higher") if len(used) else np.zeros(len(COMMON))
    return np.searchsorted(limits, steps, side="left").astype(np.uint8)


def bucket(hashes: np.ndarray, bits: int | None = None) -> np.ndarray:
    return (hashes >> np.uint64(64 - (bits or COMMON_BITS))).astype(np.int64)


def places(hashes: np.ndarray, row: np.ndarray, n: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Each shingle's place in its set when the less common come first, then the smaller hash.

    ``hashes`` are in the order of ``row`` and hash, ``n`` of them in each row.
    """
    key = row * (len(COMMON) + 1) + level[bucket(hashes)]
    if len(n) * (len(COMMON) + 1) <= 65_536:
        key = key.astype(np.uint16)  # sorted by digits
    place = np.empty(len(hashes), np.int64)
    place[np.argsort(key, kind="stable")] = np.arange(len(hashes)) - (np.cumsum(n) - n)[row]
    return place


def describe(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, digest, n, node, counts, first) per row of (doc_id, text): digest of the text, size of
    the set and its digest (null for an empty set), the count vector, and the shingles of which two alike
    sets share one."""
    common = docs.sparkSession.sparkContext.broadcast(commonness(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                hashes, borders = text_sets(part.column("text"))
                n = np.diff(borders)
                row = np.repeat(np.arange(len(n)), n)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes), dtype=np.uint64)))
                node = mixed((sums[borders[1:]] - sums[borders[:-1]]) ^ n.astype(np.uint64)).view(np.int64)
                width = groups(n)
                begin = np.concatenate(([0], np.cumsum(width)))
                cell = begin[row] + (hashes & (width[row] - 1).astype(np.uint64)).astype(np.int64)
                counts = np.minimum(np.bincount(cell, minlength=begin[-1]), 255).astype(np.uint8)
                first = np.where(n > 0, n - (-(-percent * n // 100)) + 1, 0)
                kept = places(hashes, row, n, common.value) < first[row]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "digest": part.column("digest"),
                        "n": pa.array(n),
                        "node": pa.array(node, mask=n == 0),
                        "counts": pa.Array.from_buffers(
                            pa.binary(), len(n), [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(counts)]
                        ),
                        "first": list_array(hashes[kept].view(np.int64), np.concatenate(([0], np.cumsum(first)))),
                    }
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("digest")).mapInArrow(
        run, "doc_id long, digest long, n long, node long, counts binary, first array<long>"
    )


def blocks(sets: DataFrame) -> DataFrame:
    """(head, node): sets other than the smallest node, the head, of every block of two or more.

    Takes (node, first) with one row per set, so copies add nothing. Shingles are dealt once, by ranges of about SECTION_SHINGLES
    of them: a row holds those of one range from many sets, as two arrays. A task holds one range, 16 bytes a shingle.
    """
    total = sets.agg(F.sum(F.size("first"))).first()[0] or 0
    ranges = np.uint64(max(1, -(-total // SECTION_SHINGLES)))

    def dealt(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        tokens, nodes = (np.concatenate(column) for column in zip(*held, strict=True))
        order = np.argsort(tokens)
        tokens, nodes = tokens[order], nodes[order]
        section = (tokens >> np.uint64(32)) * ranges >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(section, prepend=section[:1] + np.uint64(1)))
        borders = pa.py_buffer((8 * np.append(cuts, len(tokens))).astype(np.int32))
        packed = [pa.Array.from_buffers(pa.binary(), len(cuts), [None, borders, pa.py_buffer(x)]) for x in (tokens, nodes)]
        return pa.RecordBatch.from_arrays([pa.array(section[cuts].astype(np.int64)), *packed], names=["section", "tokens", "nodes"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for part in (batch.slice(start, 256) for start in range(0, batch.num_rows, 256)):
                first = part.column("first")
                tokens = first.flatten().to_numpy().view(np.uint64)
                held.append((tokens, np.repeat(part.column("node").to_numpy(), first.value_lengths().to_numpy())))
                count += len(tokens)
                if count >= DEALT_SHINGLES:
                    yield dealt(held)
                    held, count = [], 0
        if count:
            yield dealt(held)

    def named(table: pa.Table) -> pa.Table:
        tokens, nodes = (
            np.concatenate([np.frombuffer(cell.as_buffer(), np.int64) for cell in table.column(c)]) for c in ("tokens", "nodes")
        )
        order = np.argsort(tokens)
        tokens, nodes = tokens[order], nodes[order]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        head = np.repeat(np.minimum.reduceat(nodes, starts), np.diff(np.append(starts, len(tokens))))
        others = nodes != head
        return pa.table({"head": head[others], "node": nodes[others]})

    packed = sets.select("node", "first").mapInArrow(deal, "section long, tokens binary, nodes binary")
    return packed.groupBy("section").applyInArrow(named, "head long, node long")


def vector(counts: bytes, width: int) -> np.ndarray:
    """A count vector folded to ``width`` groups; a full byte stands for any larger number."""
    cells = np.frombuffer(counts, np.uint8).astype(np.int32)
    cells[cells == 255] = 1 << 24
    return cells.reshape(-1, width).sum(0, dtype=np.int32)


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose count vectors leave room for enough shared shingles."""

    @F.arrow_udf("boolean")
    def may_link(n: pa.Array, m: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
        need = required(n.to_numpy(), m.to_numpy(), percent).tolist()
        out = []
        for least, x, y in zip(need, one.to_pylist(), other.to_pylist(), strict=True):
            width = min(len(x), len(y))
            out.append(bool(np.minimum(vector(x, width), vector(y, width)).sum() >= least))
        return pa.array(out, pa.bool_())

    shapes = sets.select("node", "n", "counts")
    left = shapes.withColumnsRenamed({"node": "a", "n": "n_a", "counts": "c_a"})
    right = shapes.withColumnsRenamed({"node": "b", "n": "n_b", "counts": "c_b"})
    sized = pairs.join(left, "a").join(right, "b")
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sized.where(near).where(may_link("n_a", "n_b", "c_a", "c_b")).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, owners: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets are alike.

    A room holds the set of one ``a`` and sets ``b`` to hold against it, of about ROOM_SHINGLES together.
    Texts are read again and their sets sent to the rooms; ``owners`` names one document per node.
    """
    held = pairs.join(sets.select(F.col("node").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("n"))
    sizes = held.select("a", F.ceil(F.col("n") / ROOM_SHINGLES).cast("int").alias("rooms"))
    seats = pairs.join(sizes, "a").withColumn("room", F.pmod(F.xxhash64("b"), F.col("rooms")).cast("int"))
    guests = seats.select(F.col("b").alias("node"), "a", "room")
    hosts = seats.select(F.col("a").alias("node"), "a", "room").distinct()
    lists = guests.unionByName(hosts).groupBy("node").agg(F.collect_list(F.struct("a", "room")).alias("rooms"))
    wanted = stored(lists.join(owners, "node").select("doc_id", "digest", "node", "rooms"), "wanted-sets")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                hashes, borders = text_sets(part.column("text"))
                packed = [hashes[i:j].tobytes() for i, j in zip(borders[:-1], borders[1:], strict=True)]
                yield pa.record_batch(
                    [part.column("node"), part.column("rooms"), pa.array(packed, pa.binary())],
                    names=["node", "rooms", "hashes"],
                )

    room = "array<struct<a: long, room: int>>"
    # few texts are wanted: the others go before any text is shuffled; the list is at most WANTED_NUMBERS long
    number = F.pmod(F.xxhash64("doc_id"), F.lit(WANTED_NUMBERS)).cast("int")
    numbers = wanted.select(number.alias("number")).distinct()
    texts = docs.select("doc_id", "text").withColumn("number", number).join(F.broadcast(numbers), "number", "left_semi")
    texts = texts.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["digest"] == wanted["digest"])
    # the same document may be there more than once
    sent = texts.join(wanted, same).select("node", "rooms", "text").dropDuplicates(["node"])
    placed = sent.mapInArrow(send, f"node long, rooms {room}, hashes binary")
    placed = placed.select("node", F.explode("rooms").alias("at"), "hashes").select("at.a", "at.room", "node", "hashes")

    def compare(table: pa.Table) -> pa.Table:
        nodes, packed = table.column("node").to_pylist(), table.column("hashes")
        a = table.column("a")[0].as_py()
        host = np.frombuffer(packed[nodes.index(a)].as_py(), np.uint64)
        found = []
        for node, other in zip(nodes, packed, strict=True):
            guest = np.frombuffer(other.as_py(), np.uint64)
            if node != a:
                at = np.minimum(np.searchsorted(host, guest), len(host) - 1)
                shared = int((host[at] == guest).sum())
                if 100 * shared >= percent * (len(host) + len(guest) - shared):
                    found.append(node)
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return placed.groupBy("a", "room").applyInArrow(compare, "a long, b long")


class Tree:
    """R-tree over count vectors of one width: points packed by component and set size, boxes of FAN points, boxes of
    FAN boxes, and so on up to one root.

    Per level, from the points up: the upper corner, the smallest and the largest set, and the component if there is only one (else -1).
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> None:
        self.order = np.lexsort((*points.T[:2], sizes, label))
        sizes, label = sizes[self.order], label[self.order]
        self.levels = [(points[self.order], sizes, sizes, label)]
        while len(self.levels[-1][1]) > 1:
            upper, small, large, only = self.levels[-1]
            cuts = np.arange(0, len(small), FAN)
            low, high = np.minimum.reduceat(only, cuts), np.maximum.reduceat(only, cuts)
            self.levels.append(
                (
                    np.maximum.reduceat(upper, cuts),
                    np.minimum.reduceat(small, cuts),
                    np.maximum.reduceat(large, cuts),
                    np.where(low == high, low, -1),
                )
            )

    def children(self, level: int, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of ``boxes`` one level below, and for each the place of its parent in ``boxes``."""
        below = boxes[:, None] * FAN + np.arange(FAN)
        there = below < len(self.levels[level - 1][1])
        return below[there], np.nonzero(there)[0]

    def join(self, other: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(own point, other point, bound over requirement) of pairs of different components that may be alike.

        Both trees are descended together. A pair of boxes is left out, with all below, if the sum of the smaller
        upper corners is under what their smallest sets must share, if no sizes fit, or if they hold one component.
        """
        root = np.zeros(1, np.int64)
        step = min(PAIR_ROWS, max(FAN, PAIR_CELLS // self.levels[0][0].shape[1]))
        todo = [(len(self.levels) - 1, len(other.levels) - 1, root, root)]
        while todo:
            one, two, i, j = todo.pop()
            if len(i) > step:
                todo.append((one, two, i[step:], j[step:]))
                i, j = i[:step], j[:step]
            (upper, small, large, only), (upper2, small2, large2, only2) = self.levels[one], other.levels[two]
            fits = (100 * large2[j] >= percent * small[i]) & (percent * small2[j] <= 100 * large[i])
            fits &= (only[i] < 0) | (only[i] != only2[j])
            i, j = i[fits], j[fits]
            over = np.minimum(upper[i], upper2[j]).sum(1) - required(small[i], small2[j], percent)
            i, j, over = i[over >= 0], j[over >= 0], over[over >= 0]
            if not len(i):
                continue
            if not one and not two:
                yield self.order[i], other.order[j], over
                continue
            one_down, two_down = one >= two, two >= one  # the higher box is opened, of equal ones both
            if one_down:
                i, at = self.children(one, i)
                j = j[at]
            if two_down:
                j, at = other.children(two, j)
                i = i[at]
            todo.append((one - one_down, two - two_down, i, j))


def crossing_pairs(table: pa.Table, percent: int, nearest: bool) -> pa.Table:
    """Pairs of different components in a block, or between two parts of one, whose bound is high enough.

    With ``nearest`` only the best one for each set of the one side.
    """
    node, size = table.column("node").to_numpy(), table.column("n").to_numpy()
    label, side = table.column("label").to_numpy(), table.column("side").to_numpy()
    label = np.unique(label, return_inverse=True)[1]
    counts = table.column("counts").to_pylist()
    width = np.array([len(c) for c in counts])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    classes = np.unique(width)
    for w in classes:
        for v in classes[(classes == w // 2) | (classes == w) | (classes == 2 * w)]:  # no others are alike
            ones, others = np.flatnonzero((width == w) & (side == side.min())), np.flatnonzero((width == v) & (side == side.max()))
            if len(ones) and len(others):
                fold = min(v, w)
                one, other = (
                    Tree(np.array([vector(counts[i], fold) for i in at]), size[at], label[at]) for at in (ones, others)
                )
                found += [(ones[i], others[j], over) for i, j, over in one.join(other, percent)]
    i, j, over = (np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    if nearest:
        order = np.lexsort((-over, i))
        best = order[np.concatenate(([True], i[order][1:] != i[order][:-1]))] if len(order) else order
        i, j = i[best], j[best]
    pairs = np.unique(np.stack((np.minimum(node[i], node[j]), np.maximum(node[i], node[j]))), axis=1)
    return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})


def leaf_pairs(table: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """As ``crossing_pairs``, for many stars of one leaf each: rows (head, node, label, n, counts) in the order of head."""
    head, node, label, size = (table.column(c).to_numpy() for c in ("head", "node", "label", "n"))
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(head), 1), bool), head[1:] != head[:-1])))
    ends = np.repeat(np.append(starts[1:], len(head)), np.diff(np.append(starts, len(head))))
    later = ends - np.arange(len(head)) - 1  # rows of the same star that follow
    i = np.repeat(np.arange(len(head)), later)
    j = np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later) + i + 1
    fits = (label[i] != label[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
    i, j = i[fits], j[fits]
    counts = table.column("counts").cast(pa.large_binary())
    begin = np.frombuffer(counts.buffers()[1], np.int64)[counts.offset : counts.offset + len(counts) + 1]
    cells = np.frombuffer(counts.buffers()[2] or b"", np.uint8)
    width = np.diff(begin)
    fold = np.minimum(width[i], width[j])
    kept = [np.zeros(0, np.int64)]
    for w in np.unique(fold):
        at = np.flatnonzero(fold == w)
        for part in np.array_split(at, -(-len(at) * int(w) // (1 << 20))):
            one, other = (folded(cells, begin[rows[part]], width[rows[part]], int(w)) for rows in (i, j))
            bound = np.minimum(one, other).sum(1)
            kept.append(part[bound >= required(size[i[part]], size[j[part]], percent)])
    at = np.concatenate(kept)
    x, y = node[i[at]], node[j[at]]
    pairs = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y))), axis=1)
    return pa.record_batch({"a": pairs[0], "b": pairs[1]})


def folded(cells: np.ndarray, begin: np.ndarray, width: np.ndarray, w: int) -> np.ndarray:
    """Count vectors that begin at ``begin`` as rows of ``w`` groups; each is ``w`` or twice as wide."""
    out = np.zeros((len(begin), w), np.int32)
    for half in (0, w):
        rows = np.flatnonzero(width > half)
        got = cells[begin[rows][:, None] + half + np.arange(w)].astype(np.int32)
        got[got == 255] = 1 << 24
        out[rows] += got
    return out


def whole_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in the order of head, cut anew so that no star lies in two."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        head = batch.column("head").to_numpy()
        cut = int(np.flatnonzero(head == head[-1])[0])
        rest = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if rest is not None:
        yield rest


def open_pairs(stars: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs still to verify: around heads whose sets are not all in one component, between components.

    All blocks of one head are taken together, so what several of them name is compared once. With ``nearest``
    only the best partner of each set is told, around heads of more than one leaf. A large star is cut into
    parts that meet pairwise, each pair of parts in a task of its own.
    """
    label = labels.withColumnRenamed("label", "known")

    def labelled(rows: DataFrame, column: str, name: str) -> DataFrame:
        one = label.withColumnRenamed("node", column)
        return rows.join(one, column, "left").withColumn(name, F.coalesce("known", column)).drop("known")

    members = labelled(labelled(stars, "head", "head_label"), "node", "label")
    split = members.groupBy("head").agg(
        F.max(F.col("label") != F.col("head_label")).alias("open"),
        F.count(F.lit(1)).alias("size"),
        F.any_value("head_label").alias("label"),
    )
    # a star of one has been held against its head
    split = split.where(F.col("open") & (F.col("size") > (LEAF if nearest else 1)))
    split = split.withColumn("parts", F.ceil((F.col("size") + 1) / BLOCK_ROWS).cast("int"))
    shapes = sets.select("node", "n", "counts")

    def everyone(split: DataFrame) -> DataFrame:
        inner = members.join(split.select("head", "parts"), "head").select("head", "parts", "node", "label")
        return inner.unionByName(split.select("head", "parts", F.col("head").alias("node"), "label")).join(shapes, "node")

    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = (
        everyone(split.where(F.col("size") > LEAF))
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "head", "node", "label", "n", "counts",
            F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), F.col("part").alias("side"),
        )
    )
    found = dealt.groupBy("head", "low", "high").applyInArrow(
        lambda table: crossing_pairs(table, percent, nearest), "a long, b long"
    )
    if not nearest:  # stars of one leaf, many in a batch
        small = everyone(split.where(F.col("size") <= LEAF)).select("head", "node", "label", "n", "counts")
        small = small.repartition("head").sortWithinPartitions("head")
        found = found.unionByName(
            small.mapInArrow(
                lambda batches: (leaf_pairs(stars, percent) for stars in whole_stars(batches)), "a long, b long"
            )
        )
    return found.distinct()


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of (doc_id, text).

    Equal sets are one node, so copies are linked without pairs. Null, empty and word-less texts
    have no set and are their own component. Repeated rows are separate rows of one component; with
    null ids the smallest other id counts, null if there is none. Other columns are ignored.
    """
    described = stored(describe(docs, percent), "shingle-sets")
    sets = described.where("node IS NOT NULL").select("node", "n", "counts", "first").dropDuplicates(["node"])
    sets = stored(sets, "distinct-sets")
    stars = stored(blocks(sets).distinct(), "blocks")
    pairs = stars.select(F.col("head").alias("a"), F.col("node").alias("b"))
    likely = stored(bounded(pairs, sets, percent), "bounded-pairs")
    owner = F.min(F.struct("doc_id", "digest")).alias("owner")
    owners = described.where("node IS NOT NULL").groupBy("node").agg(owner).select("node", "owner.*")
    owners = stored(owners, "owners")
    links = stored(verified(likely, sets, owners, docs, percent), "links")
    tested = likely
    for nearest in (True, False):  # what the nearest partners connect needs no pairs any more
        labels = components(links)
        found = open_pairs(stars, sets, labels, percent, nearest)
        rest = stored(found.join(tested, ["a", "b"], "left_anti"), "open-pairs")
        more = stored(verified(rest, sets, owners, docs, percent), "links")
        tested, links = tested.unionByName(rest), links.unionByName(more)
    labels = components(links)
    marked = described.select("doc_id", "n", "node").join(labels, "node", "left")
    group = F.coalesce("label", "node")
    smallest = marked.where("node IS NOT NULL").groupBy(group.alias("group")).agg(F.min("doc_id").alias("low"))
    joined = marked.withColumn("group", group).join(smallest, "group", "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component: the smallest id.

    Of rows equal in id and text one stays. Rows of one id with different texts count one by one if their
    component's smallest id is theirs; a component of null ids only keeps one row per text.
    """
    found = stored(jaccard_components(docs.select("doc_id", "text"), percent), "components")
    low = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    low = low.withColumnRenamed("doc_id", spare_name(docs, "kept_id"))
    kept = docs.join(low, docs["doc_id"].eqNullSafe(low[low.columns[0]]), "left_semi")
    digest = spare_name(docs, "digest")
    return kept.withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", digest]).drop(digest)
