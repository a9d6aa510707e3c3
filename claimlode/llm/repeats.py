"""Removal of long byte strings that occur more than once, by a hash-compared suffix sort.

Only suffixes near shared anchors are sorted. An anchor is the place of the smallest k-gram hash in
a window; equal windows have it at the same place, so every string that repeats lies around an
anchor whose k-gram repeats. The text around such an anchor (a fragment: all windows it stands for)
is shipped to the other fragments of its k-gram. There the suffixes from the anchor, and the reversed
prefixes before it, are merge-sorted; prefix polynomial hashes and binary search give the common
extension of two of them in a logarithmic number of steps, and bytes confirm each finding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import WORD, _byte_value, mixed, powers, slices, spare_name, stored, utf8, word_borders, word_hashes

#: Bytes of a repeated string, and of the k-gram that an anchor is chosen by.
LENGTH, GRAM = 400, 64
#: Words of a repeated passage: the shortest that is over 50 words.
PASSAGE = 51
#: Bytes that stand for a word where passages are compared word by word.
CODE = 8
#: A k-gram with more different fragments than this is counted window by window over many tasks.
HOT_FRAGMENTS = 20_000
#: Fragments that one sort takes together: whole groups up to this many.
SORT_FRAGMENTS = 8_192
#: Bytes of text that are searched for anchors at once: this takes some seventy times their memory.
_SLICE = 1 << 19
_BASES = (0x9E6C63D0876A9A35, 0xD1342543DE82EF95, 0xA0761D6478BD642F)


class Hashes:
    """Prefix polynomial hashes of a byte buffer modulo 2**64."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_value[data] * powers(base, len(data)), out=self.prefix[1:])
        self.back = powers(pow(base, -1, 1 << 64), len(data) + 1)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.back[start]


#: A text column as bytes to compare, and the row borders in them.
Bytes = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every word of a text column as the CODE bytes of its hash, and the row borders: white space does not count."""
    data, offsets = utf8(column)
    starts, ends, rows = word_borders(data, offsets)
    codes = word_hashes(data, starts, ends, lower=False)
    return codes.view(np.uint8), np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(column))))) * CODE


def window_anchors(data: np.ndarray, base: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window start the place of its smallest k-gram hash, leftmost; and all k-gram hashes."""
    hashes = mixed(Hashes(data, base).of(np.arange(len(data) - gram + 1), gram))
    width = length - gram + 1
    n = len(hashes)
    bits = np.uint64(width.bit_length())  # room for a place within a block
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = hashes
    blocks = (padded.reshape(-1, width) >> bits << bits) | np.arange(width, dtype=np.uint64)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    beyond = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - width + 1)
    here, there = beyond[: len(starts)], upto[width - 1 :][: len(starts)]
    early = here >> bits <= there >> bits
    block = np.where(early, starts, starts + width - 1) // width * width
    low = (np.uint64(1) << bits) - np.uint64(1)
    return block + (np.where(early, here, there) & low).astype(np.int64), hashes


def inner_repeats(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of one text that repeat inside it: (all of them, those that are not the first of their kind)."""
    hashes = mixed(Hashes(data, _BASES[1]).of(np.arange(len(data) - length + 1), length))
    order = np.argsort(hashes, kind="stable")
    later = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    if not len(later):
        return later, later
    here, before = order[later + 1], order[later]
    by_place = np.argsort(here)
    here, before = here[by_place], before[by_place]
    # runs of one distance are confirmed byte by byte, each in one comparison
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(here) != 1) | (np.diff(before) != 1), [True])))
    good = np.zeros(len(here), bool)
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        a, b, size = here[i], before[i], j - i + length - 1
        if np.array_equal(data[a : a + size], data[b : b + size]):
            good[i:j] = True
        else:
            for k in range(i, j):
                good[k] = np.array_equal(data[here[k] : here[k] + length], data[before[k] : before[k] + length])
    return np.union1d(here[good], before[good]), here[good]


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of every run of consecutive numbers."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate(([0], cut + 1))], places[np.concatenate((cut, [len(places) - 1]))]


def text_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """(row, k-gram hash or None, anchor, first window, last window) of the texts in a buffer.

    Rows without a hash are windows that repeat inside their own text; of those only the first of a
    kind stands for the others. Places count from the start of a text.
    """
    if len(data) < length:
        return
    anchor, hashes = window_anchors(data, _BASES[0], length, gram)
    row = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
    valid = np.arange(len(anchor)) + length <= offsets[row + 1]
    fresh = np.zeros(len(anchor), bool)
    fresh[0] = True
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    mark = np.flatnonzero(fresh & valid)
    # a text in which one k-gram is an anchor twice may repeat inside itself
    order = np.lexsort((hashes[anchor[mark]], row[mark]))
    same = (np.diff(row[mark][order]) == 0) & (hashes[anchor[mark]][order][1:] == hashes[anchor[mark]][order][:-1])
    for r in np.unique(row[mark][order][1:][same]):
        begin, end = offsets[r], offsets[r + 1]
        every, later = inner_repeats(data[begin:end], length)
        valid[begin + later] = False
        for lo, hi in zip(*runs(every), strict=True):
            yield int(r), None, int(lo), int(lo), int(hi)
    fresh[1:] |= valid[1:] & ~valid[:-1]
    first = np.flatnonzero(fresh & valid)
    stop = np.ones(len(anchor), bool)
    stop[:-1] = fresh[1:] | ~valid[1:]
    last = np.flatnonzero(stop & valid)
    base = offsets[row[first]]
    yield from zip(
        row[first].tolist(),
        hashes[anchor[first]].view(np.int64).tolist(),
        (anchor[first] - base).tolist(),
        (first - base).tolist(),
        (last - base).tolist(),
        strict=True,
    )


def merge_sorted(group: np.ndarray, less: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Order of items within their groups (which lie together) by a stable merge sort.

    ``less(a, b)`` compares arrays of items. Runs are merged by finding each item's rank in the
    sibling run by binary search, all items of a level at once.
    """
    n = len(group)
    order = np.arange(n)
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.repeat(np.diff(np.append(begin, n)), np.diff(np.append(begin, n)))
    first = np.repeat(begin, np.diff(np.append(begin, n)))
    width = 1
    while n and (at := np.flatnonzero(size > width)).size:
        place = at - first[at]
        run = place // width
        left = run % 2 == 0
        other = (run + np.where(left, 1, -1)) * width
        low = np.minimum(other, size[at])
        high = np.minimum(other + width, size[at])
        base, item = low.copy(), order[at]
        while (todo := np.flatnonzero(low < high)).size:
            middle = (low[todo] + high[todo]) // 2
            rival = order[first[at][todo] + middle]
            # equal items keep the left run first
            ahead = np.where(left[todo], less(rival, item[todo]), ~less(item[todo], rival))
            low[todo] = np.where(ahead, middle + 1, low[todo])
            high[todo] = np.where(ahead, high[todo], middle)
        target = first[at] + (run // 2) * 2 * width + place % width + (low - base)
        order[target] = item
        width *= 2
    return order


def covered_fragments(
    group: np.ndarray, texts: list[bytes], anchors: np.ndarray, length: int, bases: tuple[int, ...] = _BASES
) -> list[tuple[int, int, int]]:
    """(fragment, first byte, end) of the part of each fragment that lies in others of its group too.

    All parts that a fragment shares hold its anchor, so together they are one piece of it.

    ``group`` numbers the fragments' k-grams, groups lie together; ``anchors`` are places in the
    fragments. Only parts of at least ``length`` bytes around the anchor are told. A fragment has
    common bytes [anchor - L, anchor + R) with another if the reversed prefixes agree for L bytes and
    the suffixes for R. In the order of suffixes, the fragments that agree for R bytes are neighbours;
    among them the largest L is found next to a fragment in the order of prefixes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    begin = np.concatenate(([0], end[:-1]))
    mid = begin + anchors
    hashes = Hashes(data, bases[0])

    def extension(a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Common bytes from the anchors on, or before them: binary search on hashes."""
        room = np.minimum(end[a] - mid[a], end[b] - mid[b]) if forward else np.minimum(mid[a] - begin[a], mid[b] - begin[b])
        low, high = np.zeros(len(a), np.int64), room.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            shift = 0 if forward else half
            same = hashes.of(mid[a] - shift, half) == hashes.of(mid[b] - shift, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def byte(a: np.ndarray, step: np.ndarray, forward: bool) -> np.ndarray:
        at = mid[a] + step if forward else mid[a] - step - 1
        inside = at < end[a] if forward else at >= begin[a]
        return np.where(inside, data[np.clip(at, 0, len(data) - 1)].astype(np.int64), -1)

    def less(forward: bool) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        def compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            step = extension(a, b, forward)
            return byte(a, step, forward) < byte(b, step, forward)

        return compare

    by_suffix = merge_sorted(group, less(True))
    by_prefix = merge_sorted(group, less(False))
    rank = np.empty(len(group), np.int64)
    rank[by_prefix] = np.arange(len(group))
    same_group = group[by_suffix][1:] == group[by_suffix][:-1]
    agree = np.where(same_group, extension(by_suffix[1:], by_suffix[:-1], True), -1)
    low, high = anchors.copy(), np.full(len(group), -1, np.int64)
    for r in np.unique(agree[agree > 0])[::-1]:
        together = np.concatenate(([0], np.cumsum(agree < r)))
        changed = np.zeros(len(group) + 1, bool)
        changed[together[1:][agree == r]] = True
        inside = np.flatnonzero(changed[together])
        member, of = by_suffix[inside], together[inside]
        order = np.lexsort((rank[member], of))
        member, of = member[order], of[order]
        near = np.flatnonzero(of[1:] == of[:-1])
        a, b = member[near], member[near + 1]
        back = extension(a, b, False)
        enough = back + r >= length
        for x, y, left in zip(a[enough].tolist(), b[enough].tolist(), back[enough].tolist(), strict=True):
            one, two = anchors[x], anchors[y]
            if texts[x][one - left : one + r] != texts[y][two - left : two + r]:  # a hash collision
                return covered_fragments(group, texts, anchors, length, bases[1:])
            for i, at in ((x, one), (y, two)):
                low[i], high[i] = min(low[i], at - left), max(high[i], at + r)
    return [(int(i), int(low[i]), int(high[i])) for i in np.flatnonzero(high >= 0)]


def sort_groups(length: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over fragments ordered by k-gram: the parts of them that repeat, group by group."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        group = np.unique(np.array([r["gram"] for r in rows]), return_inverse=True)[1]
        found = [(i, 0, len(r["fragment"])) for i, r in enumerate(rows) if r["n"] > 1]
        found += covered_fragments(group, [r["fragment"] for r in rows], np.array([r["at"] for r in rows]), length)
        return pa.record_batch(
            {
                "gram": pa.array([rows[i]["gram"] for i, _, _ in found], pa.int64()),
                "digest": pa.array([rows[i]["digest"] for i, _, _ in found], pa.binary()),
                "from": pa.array([a for _, a, _ in found], pa.int64()),
                "to": pa.array([b for _, _, b in found], pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= limit and row["gram"] != held[-1]["gram"]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return run


def anchor_rows(batch: pa.RecordBatch, length: int, gram: int, coded: Bytes) -> Iterator[pa.RecordBatch]:
    """The anchors of the texts of (doc, doc_id, text), slice by slice."""
    names = ["doc", "doc_id", "gram", "anchor", "lo", "hi"]
    for part in slices(batch, "text", _SLICE):
        data, offsets = coded(part.column("text"))
        rows = list(text_anchors(data, offsets, length, gram))
        row, *rest = zip(*rows, strict=True) if rows else [()] * 5
        of = pa.array(row, pa.int64())
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        columns = [pa.array(c, kind) for c, kind in zip(rest, kinds, strict=True)]
        ids = [part.column("doc").take(of), part.column("doc_id").take(of)]
        yield pa.record_batch([*ids, *columns], names=names)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_FRAGMENTS, coded: Bytes = utf8
) -> DataFrame:
    """(doc, doc_id, from, to): bytes of the texts of (doc, doc_id, text) that repeat anywhere.

    ``doc`` is a hash of id and text; rows equal in both count as one document here. ``coded`` says which bytes
    stand for a text. A k-gram with more than ``hot`` different surroundings is counted by SHA-256 digests, which
    are trusted; elsewhere bytes confirm each repeat.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from anchor_rows(batch, length, gram, coded)

    anchors = stored(
        docs.mapInArrow(find, "doc long, doc_id long, gram long, anchor int, lo int, hi int"), "anchors"
    )
    shared = anchors.where("gram IS NOT NULL").groupBy("gram").count().where("count > 1").select("gram")
    near = anchors.join(shared, "gram", "left_semi")
    marks = near.groupBy("doc", "doc_id").agg(F.collect_list(F.struct("gram", "anchor", "lo", "hi")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part in slices(batch, "text", _SLICE):
                data, offsets = coded(part.column("text"))
                for i, row in enumerate(part.drop_columns(["text"]).to_pylist()):
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    for mark in row["marks"]:
                        piece = text[mark["lo"] : mark["hi"] + length]
                        at = mark["anchor"] - mark["lo"]
                        digest = hashlib.blake2b(piece, digest_size=16, key=at.to_bytes(4, "little")).digest()
                        rows.append((row["doc"], row["doc_id"], mark["lo"], mark["gram"], at, digest, piece))
            columns = zip(*rows, strict=True) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            names = ["doc", "doc_id", "lo", "gram", "at", "digest", "fragment"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    same = docs["doc"].eqNullSafe(marks["doc"]) & docs["doc_id"].eqNullSafe(marks["doc_id"])
    once = docs.join(marks, same).select(docs["doc"], docs["doc_id"], "text", "marks")
    pieces = stored(
        once.mapInArrow(cut, "doc long, doc_id long, lo int, gram long, at int, digest binary, fragment binary"),
        "fragments",
    )
    distinct = pieces.groupBy("gram", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.any_value("at").alias("at"), F.any_value("fragment").alias("fragment")
    )
    distinct = stored(distinct, "distinct-fragments")
    crowded = distinct.groupBy("gram").count().where(F.col("count") > hot).select("gram")
    sortable = distinct.join(crowded, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    found = sortable.mapInArrow(sort_groups(length, SORT_FRAGMENTS), "gram long, digest binary, from long, to long")
    found = found.unionByName(counted_windows(distinct.join(crowded, "gram", "left_semi"), length))
    places = pieces.select("doc", "doc_id", "lo", "gram", "digest")
    spans = places.join(found.groupBy("gram", "digest").agg(F.collect_list(F.struct("from", "to")).alias("parts")), ["gram", "digest"])
    spans = spans.select("doc", "doc_id", "lo", F.explode("parts").alias("part")).select(
        "doc", "doc_id", (F.col("lo") + F.col("part.from")).alias("from"), (F.col("lo") + F.col("part.to")).alias("to")
    )
    inner = anchors.where("gram IS NULL").select(
        "doc", "doc_id", F.col("lo").cast("long").alias("from"), (F.col("hi") + length).cast("long").alias("to")
    )
    return spans.unionByName(inner)


def counted_windows(fragments: DataFrame, length: int) -> DataFrame:
    """The same answer for k-grams with very many different fragments: every window is counted by its digest.

    Counts are summed up in each task first, and windows of one k-gram meet by their own content, so
    no task gets them all.
    """
    places = F.explode(F.expr(f"sequence(0, length(fragment) - {length})")).alias("from")
    windows = fragments.select("gram", "digest", "n", "fragment", places).select(
        "gram", "digest", "n", "from", F.sha2(F.expr(f"substring(fragment, `from` + 1, {length})"), 256).alias("window")
    )
    often = windows.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window")
    return windows.join(often, "window", "left_semi").select(
        "gram", "digest", F.col("from").cast("long").alias("from"), (F.col("from") + length).cast("long").alias("to")
    )


def with_spans(
    docs: DataFrame, length: int, gram: int, hot: int, coded: Bytes = utf8, size: Column | None = None
) -> tuple[DataFrame, str]:
    """``docs`` with a column that lists the repeated spans of each text, and that column's name.

    Rows of equal id and text are copies of each other, so all of a long enough one repeats. ``size`` is the number
    of bytes that ``coded`` makes of a text.
    """
    key, copies, spans = (spare_name(docs, name) for name in ("_doc", "_copies", "_spans"))
    doc, doc_id = spare_name(docs, "_of_doc"), spare_name(docs, "_of_doc_id")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", text))
    entries = keyed.select(F.col(key).alias("doc"), "doc_id", text.alias("text"))
    found = repeated_spans(entries, length, gram, hot, coded)
    lists = found.groupBy("doc", "doc_id").agg(F.collect_list(F.struct("from", "to")).alias(spans))
    twice = entries.groupBy("doc", "doc_id").agg(F.count(F.lit(1)).alias(copies)).where(F.col(copies) > 1)
    for side in (lists, twice):
        side = side.withColumnsRenamed({"doc": doc, "doc_id": doc_id})
        same = (F.col(key) == F.col(doc)) & F.col("doc_id").eqNullSafe(F.col(doc_id))
        keyed = keyed.join(side, same, "left").drop(doc, doc_id)
    size = F.octet_length(text).cast("long") if size is None else size
    whole = F.array(F.struct(F.lit(0).cast("long").alias("from"), size.alias("to")))
    column = F.when(F.col(copies).isNotNull() & (size >= length), whole).otherwise(F.col(spans))
    return keyed.withColumn(spans, column).drop(key, copies), spans


def merged_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans in order, touching ones joined."""
    out: list[list[int]] = []
    for start, end in sorted((s["from"], s["to"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remaining(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    borders = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True))


def removal_report(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_FRAGMENTS, show: bool = False
) -> DataFrame:
    """Per row of (doc_id, text): n_bytes (before), n_removed, n_spans, kept_sha256 and, to ``show``, text (what is left).

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else as well. A null
    text is empty; ids may be null or repeated; equal rows are copies of each other. Other columns
    are ignored. Where a cut falls inside a character, the text shows a replacement sign; the digest is of the bytes.
    """
    wide, column = with_spans(docs.select("doc_id", "text"), length, gram, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                cut = merged_spans(spans.as_py())
                kept = remaining(data, cut)
                told = (len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest())
                out.append((*told, kept.decode(errors="replace")) if show else told)
            columns = zip(*out, strict=True) if out else [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.record_batch([batch.column(0), *arrays], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * show
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * show
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * show
    return wide.select("doc_id", "text", column).mapInArrow(run, fields)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_FRAGMENTS) -> DataFrame:
    """``docs``, all rows and columns, with repeated strings cut out of ``text``.

    A span is shortened to whole characters. An ``n_chars`` column follows the new text. A null
    text stays null.
    """
    wide, column = with_spans(docs, length, gram, hot)

    @F.arrow_udf("string")
    def keep(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for one, parts in zip(text, spans, strict=True):
            value = one.as_py()
            if value is not None and parts.is_valid:
                data = value.encode()
                cut = []
                for start, end in merged_spans(parts.as_py()):
                    while start < end and data[start] & 0xC0 == 0x80:
                        start += 1
                    while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                        end -= 1
                    cut.append((start, end))
                value = remaining(data, cut).decode()
            out.append(value)
        return pa.array(out, pa.string())

    return with_text(docs, wide, keep("text", column))


def with_text(docs: DataFrame, wide: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with a new ``text``, which ``n_chars`` follows."""
    kept = wide.withColumn("text", text)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def without_passages(docs: DataFrame, words: int = PASSAGE, gram: int = GRAM, hot: int = HOT_FRAGMENTS) -> DataFrame:
    """``docs``, all rows and columns, with every passage of ``words`` words and more that occurs more than once cut out.

    The suffixes that are sorted are those of the word sequences: passages are the same if their words are, whatever
    white space stands between them; case counts. A passage is judged on the texts as given: every
    occurrence goes, the first too, and one that repeats inside its own text. White space around a cut stays. An
    ``n_chars`` column follows the new text. A null text stays null, an empty one or one of fewer words stays as it is; rows equal
    in id and text are copies of each other. Words are compared by 64-bit hashes.
    """
    size = (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) * CODE).cast("long")
    wide, column = with_spans(docs, CODE * words, gram, hot, word_codes, size)

    @F.arrow_udf("string")
    def keep(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for one, parts in zip(text, spans, strict=True):
            value = one.as_py()
            if value is not None and parts.is_valid:
                data = value.encode()
                starts, ends, _ = word_borders(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                cut = [(-(-a // CODE), b // CODE) for a, b in merged_spans(parts.as_py())]
                value = remaining(data, [(int(starts[a]), int(ends[b - 1])) for a, b in cut if b - a >= words]).decode()
            out.append(value)
        return pa.array(out, pa.string())

    return with_text(docs, wide, keep("text", column))
