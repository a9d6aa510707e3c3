"""Best-two-fit packing of documents into token sequences of fixed capacity.

A bin is filled greedily with the longest piece that still fits. Then its smallest piece gives way
to two unpacked pieces if they fill the widened gap better. Lengths are whole numbers up to the
capacity, so the method runs on the number of pieces of each length: a filled bin is repeated as
often as all its lengths last, which gives the bins that one piece after the other would give. The
plan holds a few thousand bin patterns at any input size; pieces find their place in it by their
rank among the pieces of their length.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlode.llm.common import bucket_count, spare_name, stored

Encoder = Callable[[str], np.ndarray]


@lru_cache(maxsize=2)
def byte_bpe() -> Encoder:
    """Ids of ``byte_bpe_50k.json``; the same vocabulary is read as ranks, which is four times faster.

    A text with an added token such as ``<|endoftext|>`` goes to the other library, which gives the
    token its own id, as does one on which the rank encoder gives up (its pattern can overflow on
    huge runs of one character class).
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    added = [token.content for token in slow.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if any(token in text for token in added):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # the panics of the Rust side are not Exceptions
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def token_pieces(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    encoder: Callable[[], Encoder] = byte_bpe,
    keep_ids: bool = False,
) -> DataFrame:
    """Encode (doc_id, text), close every document with ``end_id``, cut documents over ``capacity``.

    Pieces are cut from the end, so only the first may be shorter. A null text is empty: a piece of
    the closing id alone. ``keep_ids`` adds the ids as little-endian 32-bit binary ``ids``. Other
    columns are ignored; repeated rows give repeated pieces.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    names = [part.split()[0] for part in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(np.asarray(encode(text.as_py() or ""), "<u4"), np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity)]
                for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    own = ids[start:stop].tobytes()
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(own), own)[: len(names)])
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types[: len(names)], strict=True)], names=names
            )

    return docs.select("doc_id", "text").mapInArrow(run, fields)


def fill_plan(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-two-fit bins for ``counts[l]`` pieces of length l: (pieces of each length, repeats)."""
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    plan = []

    def longest(room: int, free: np.ndarray) -> int:
        found = np.flatnonzero(free[: room + 1])
        return int(found[-1]) if len(found) else 0

    while left.any():
        free, items, room = left.copy(), Counter(), capacity
        while room and (length := longest(room, free)):
            n = min(int(free[length]), room // length)
            items[length] += n
            free[length] -= n
            room -= n * length
        smallest = min(items)
        widened = room + smallest
        if room and longest(widened, free):
            usable = np.where(free > 0, lengths, 0)
            at_most = np.maximum.accumulate(usable)
            larger = np.flatnonzero(free[: widened + 1])
            smaller = at_most[np.minimum(larger, widened - larger)]
            alone = (smaller == larger) & (free[larger] < 2)
            smaller = np.where(alone, at_most[np.minimum(larger - 1, widened - larger)], smaller)
            both = np.where(smaller > 0, larger + smaller, 0)
            best = int(both.argmax())
            if both[best] > smallest:
                items[smallest] -= 1
                items.update((int(larger[best]), int(smaller[best])))
        items = {length: n for length, n in items.items() if n}
        repeats = min(int(left[length]) // n for length, n in items.items())
        for length, n in items.items():
            left[length] -= n * repeats
        plan.append((items, repeats))
    return plan


def pack(pieces: DataFrame, order_by: list[str], capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    ``order_by`` makes ranks repeatable (with all columns as tie-break of equal rows). ``pieces`` is
    read twice: pass a stored table. Only the count of each length reaches the driver, and a hot
    length is ranked in many buckets. An empty table gives an empty table; a null length or one out
    of range is an error.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in counted:
        if row["length"] is None or not 0 < row["length"] <= capacity:
            raise ValueError(f"length {row['length']} is not between 1 and {capacity}")
        counts[row["length"]] = row["count"]
    slots = plan_slots(fill_plan(counts, capacity))

    bucket, rank, before = (spare_name(pieces, name) for name in ("_bucket", "_rank", "_before"))
    n_buckets = bucket_count(int(counts.sum()))
    keyed = pieces.withColumn(bucket, F.pmod(F.xxhash64(*order_by), F.lit(n_buckets)).cast("int"))
    sizes = keyed.groupBy("length", bucket).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    own = Window.partitionBy("length", bucket).orderBy(*order_by, *pieces.columns)
    ranked = keyed.withColumn(rank, F.row_number().over(own) - 1).join(
        F.broadcast(starts) if n_buckets == 1 else starts, ["length", bucket]
    )
    ranked = ranked.select(*pieces.columns, (F.col(before) + F.col(rank)).alias(rank))
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    shared = spark.sparkContext.broadcast(slots)  # as many rows as the plan has patterns x lengths
    columns, names = list(pieces.columns), list(schema.names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rank0, each, sequence0, offset0 = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column(rank).to_numpy()
            at = np.searchsorted(key, (length << 40) | number, side="right") - 1
            nth = number - rank0[at]
            sequence = sequence0[at] + nth // each[at]
            offset = offset0[at] + nth % each[at] * length
            kept = [batch.column(name) for name in columns]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], names=names)

    return ranked.mapInArrow(place, schema)


def plan_slots(plan: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, ...]:
    """Per (length, pattern): key of its first rank, that rank, pieces a bin, first bin, offset."""
    rows, used, bins = [], Counter(), 0
    for items, repeats in plan:
        offset = 0
        for length, n in sorted(items.items(), reverse=True):
            rows.append((length << 40 | used[length], used[length], n, bins, offset))
            used[length] += n * repeats
            offset += n * length
        bins += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(np.ascontiguousarray(table[:, i]) for i in range(5))


def pack_documents(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """Encode, cut and pack (doc_id, text): one row per piece with its place in a sequence."""
    return pack(stored(token_pieces(docs, capacity), "token-pieces"), ["doc_id", "piece", "ids_crc32"], capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves, one row per sequence; ``packed`` must hold ``ids``. Bounded by the capacity."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("unhex(array_join(transform(p.ids, x -> hex(x)), ''))")
    return packed.groupBy("sequence_id").agg(ordered.alias("p")).select("sequence_id", joined.alias("ids"))
