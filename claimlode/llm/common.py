"""What the operators share: tables, stored intermediate results, texts as byte arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlode.session import shared_path

#: White space between words, as byte values.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, safe against lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece hold about ``limit`` bytes; a longer text is one piece."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the row borders in them; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_borders(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the row that holds it."""
    word = (data != SPACES[0]) & (data - np.uint8(0x09) > 0x04)
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]  # a row's border parts a word too
    start[cuts], end[cuts - 1] = word[cuts], word[cuts - 1]
    starts = np.flatnonzero(start)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    return starts, np.flatnonzero(end) + 1, rows


def word_counts(column: pa.Array) -> np.ndarray:
    data, offsets = utf8(column)
    rows = word_borders(data, offsets)[2]
    return np.bincount(rows, minlength=len(column)).astype(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = values + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_byte_value = mixed(np.arange(256, dtype=np.uint64))
#: Longer words are hashed byte by byte.
LONG_WORD = 32
#: Masks of the first 0 to 8 bytes of eight.
_first_bytes = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit polynomial hash of each word, A-Z lower-cased if asked."""
    value = (_byte_value[_lower] if lower else _byte_value)[data]
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value * powers(_BASE, len(data)), out=prefix[1:])
    back = powers(_INVERSE, len(data) + 1)
    return mixed((prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def lowered(eights: np.ndarray) -> np.ndarray:
    """A-Z lower-cased in values of eight bytes each."""
    low = eights & np.uint64(0x7F7F7F7F7F7F7F7F)
    from_a = low + np.uint64(0x3F3F3F3F3F3F3F3F)  # the top bit of a byte tells
    past_z = low + np.uint64(0x2525252525252525)
    return eights | ((from_a ^ past_z) & ~eights & np.uint64(0x8080808080808080)) >> np.uint64(2)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``word_hashes``, A-Z lower-cased, with other values: words are read eight bytes at a time, only long ones byte by byte."""
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    length = ends - starts
    keys = mixed(lowered(eights[starts] & _first_bytes[np.minimum(length, 8)]) ^ (length.astype(np.uint64) * GOLDEN))
    rest = np.flatnonzero(length > 8)
    for at in range(8, LONG_WORD, 8):
        some = eights[starts[rest] + at] & _first_bytes[np.minimum(length[rest] - at, 8)]
        keys[rest] = mixed(keys[rest] ^ lowered(some))
        rest = rest[length[rest] > at + 8]
    long = np.flatnonzero(length > LONG_WORD)
    if len(long):
        borders = np.concatenate(([0], np.cumsum(length[long])))
        letters = np.concatenate([data[a:b] for a, b in zip(starts[long], ends[long], strict=True)])
        keys[long] = word_hashes(letters, borders[:-1], borders[1:])
    return keys


def shingle_rows(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle in text order, repeats included, and the row of each.

    A row with fewer than ``size`` words has its whole word sequence as one shingle; one without
    words has none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    begin = np.cumsum(counts) - counts
    factors = powers(_BASE, size + 1)
    total = np.zeros(len(words), np.uint64)
    for i in range(min(size, len(words))):
        total[: len(words) - i] += words[i:] * factors[i]
    kept = np.ones(len(words), bool)
    for i in range(size - 1):  # no shingle begins at a row's last words
        kept[(begin + counts - 1 - i)[counts > i]] = False
    short = np.flatnonzero((counts > 0) & (counts < size))
    total[begin[short]] = counts[short].astype(np.uint64) * factors[size]
    for i in range(size - 1):
        more = short[counts[short] > i]
        total[begin[more]] += words[begin[more] + i] * factors[i]
    kept[begin[short]] = True
    return mixed(total[kept]), rows[kept]


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every row, ordered by row and hash, and the row borders."""
    total, of = shingle_rows(words, rows, n_rows, size)
    ends = np.cumsum(np.bincount(of, minlength=n_rows))
    for a, b in zip(ends - np.diff(ends, prepend=0), ends, strict=True):
        total[a:b].sort()
    fresh = np.ones(len(total), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (of[1:] != of[:-1])
    total, of = total[fresh], of[fresh]
    return total, np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n_rows))))


def merged_sections(parts: DataFrame, merge: np.ufunc, kind: str) -> DataFrame:
    """(section, cells) of (section, cells) rows of many tasks, ``merge``d cell by cell; ``kind`` is the type of the cells.

    A task holds each of its sections once, however many tasks gave them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for section, cells in zip(batch.column("section").to_pylist(), batch.column("cells"), strict=True):
                given = np.frombuffer(cells.as_buffer(), kind)
                held[section] = merge(held[section], given) if section in held else given.copy()
        for section, cells in held.items():
            yield pa.record_batch({"section": pa.array([section], pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary())})

    return parts.repartition("section").mapInArrow(run, "section int, cells binary")


def sections(cells: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """An array in (section, cells) rows of ``size`` cells each; those of zeros only are left out."""
    for section, some in enumerate(np.split(cells, range(size, len(cells), size))):
        if some.any():
            yield pa.record_batch({"section": pa.array([section], pa.int32()), "cells": pa.array([some.tobytes()], pa.binary())})


def whole_array(found: DataFrame, length: int, size: int, kind: str) -> np.ndarray:
    """The array of ``length`` cells whose sections are the rows of ``found``."""
    out = np.zeros(length, kind)
    table = found.toArrow()
    for section, cells in zip(table.column("section").to_pylist(), table.column("cells"), strict=True):
        out[section * size : (section + 1) * size] = np.frombuffer(cells.as_buffer(), kind)
    return out


def list_array(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values))


def bucket_count(rows: int) -> int:
    """Into how many buckets a hot group is split: both buckets and rows in one grow as the square root."""
    return max(1, math.ceil(math.sqrt(rows) / 32))
