"""Mixing sources to target weights by systematic sampling.

Each source gets a target size. A document's expected number of copies is its source's target over
its source's size. The expected copies are summed up in a fixed order within the source, one random
offset is added, and a document is emitted once for every whole number that its part of the sum
crosses. Documents are ordered by size, so that short and long ones are taken in equal shares.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlode.llm.common import bucket_count, slices, spare_name, stored, word_counts

#: Expected copies are whole multiples of 1 / UNIT, so that their sums are exact in any order.
UNIT = 1 << 24


@F.arrow_udf(T.LongType())
def count_words(text: pa.Array) -> pa.Array:
    """Words of a text, 0 for null."""
    batch = pa.record_batch([text], names=["text"])
    return pa.concat_arrays(
        [pa.array([], pa.int64()), *(pa.array(word_counts(x.column(0))) for x in slices(batch, "text", 4 << 20))]
    )


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = 3) -> list[float]:
    """Share out the sum of ``sizes`` by ``weights``, none above ``most`` times its size.

    The excess of a capped source goes to the others by weight until none is above its cap.
    """
    total = sum(sizes)
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    rest, weight = total, sum(weights)
    out = [0.0] * len(sizes)
    for n, i in enumerate(order):
        if most * sizes[i] * weight >= rest * weights[i]:
            for j in order[n:]:
                out[j] = rest / weight * weights[j]
            break
        out[i] = float(most * sizes[i])
        rest, weight = rest - most * sizes[i], weight - weights[i]
    return out


def source_targets(sized: DataFrame, cycle: Sequence[float] = (1, 2, 3), most: float = 3) -> DataFrame:
    """source, source_size, target for rows of (source, size): weights repeat ``cycle`` by source name.

    One row per source passes through the driver: names of sources, never documents. Null is the
    last source. Names are ordered by code point (their UTF-8 bytes have the same order).
    """
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda row: (row["source"] is None, (row["source"] or "").encode("utf-8", "surrogatepass")))
    sizes = [row["size"] for row in rows]
    shares = targets(sizes, [cycle[i % len(cycle)] for i in range(len(rows))], most)
    data = [(row["source"], row["size"], share) for row, share in zip(rows, shares, strict=True)]
    return sized.sparkSession.createDataFrame(data, "source string, source_size long, target double")


def systematic_copies(docs: DataFrame, key: list[str], seed: int = 1) -> DataFrame:
    """Add ``copies`` to rows of (source, size, expected): how often the mix takes each.

    ``key`` orders documents of equal size and spreads a hot size over buckets; rows equal in all
    of it are taken in any order. ``docs`` is read twice: pass a stored table. Sums are windows over
    (source, size class, bucket), never over a whole source; only their totals are summed per source. The totals
    join on the very columns of the windows, so whole rows are shuffled once.
    """
    part, band, bucket, own, before, named, nameless = (
        spare_name(docs, name) for name in ("_part", "_band", "_bucket", "_own", "_before", "_named", "_nameless")
    )
    n = docs.agg(F.count(F.lit(1))).first()[0]
    keyed = docs.select(
        "*",
        F.floor(F.col("expected") * UNIT).alias(part),
        F.floor(F.log2(F.greatest("size", F.lit(1))) * 16).cast("int").alias(band),
        F.pmod(F.xxhash64(*key), F.lit(bucket_count(n))).cast("int").alias(bucket),
        F.coalesce("source", F.lit("")).alias(named),
        F.isnull("source").alias(nameless),
    )
    group = [named, nameless, band, bucket]
    sums = keyed.groupBy(*group).agg(F.sum(part).alias(before))
    earlier = Window.partitionBy(named, nameless).orderBy(band, bucket).rowsBetween(Window.unboundedPreceding, -1)
    other = {name: spare_name(docs, f"_of_{name}") for name in group}
    starts = sums.select(
        *(F.col(name).alias(other[name]) for name in group),
        F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before),
    )
    running = Window.partitionBy(*group).orderBy("size", *key).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(name) == F.col(other[name]) for name in group]
    # the first 24 bits of a digest, one number for each source
    digest = F.md5(F.concat_ws("\n", F.lit(str(seed)), "source").cast("binary"))
    offset = F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")
    end = F.col(before) + F.col(own) + offset
    crossed = F.floor(end / UNIT) - F.floor((end - F.col(part)) / UNIT)
    return (
        keyed.withColumn(own, F.sum(part).over(running))
        .join(starts, same)
        .select(*docs.columns, crossed.cast("long").alias("copies"))
    )


def _expected(sized: DataFrame, cycle: Sequence[float], most: float) -> DataFrame:
    named = spare_name(sized, "_of_source")
    shares = source_targets(sized, cycle, most).withColumnRenamed("source", named)
    share = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # one row per source, which the driver has held already
    wide = sized.join(F.broadcast(shares), F.col("source").eqNullSafe(F.col(named))).drop(named)
    return wide.withColumn("expected", share)


def mix(docs: DataFrame, cycle: Sequence[float] = (1, 2, 3), most: float = 3, seed: int = 1) -> DataFrame:
    """Mix (doc_id, source, text): size, source_size, target, copies and taken words per document.

    A null text has size 0, a null source is one source, the last. Empty documents and sources take
    nothing. Equal rows are separate documents. Other columns are ignored. An empty table gives an
    empty one.
    """
    sized = stored(docs.select("doc_id", "source", count_words("text").alias("size")), "mix-sizes")
    taken = systematic_copies(_expected(sized, cycle, most), ["doc_id"], seed)
    return taken.withColumn("taken", F.col("copies") * F.col("size")).drop("expected")


def mixed_documents(docs: DataFrame, cycle: Sequence[float] = (1, 2, 3), most: float = 3, seed: int = 1) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken. Nulls as in ``mix``."""
    sized = docs.select("doc_id", "source", count_words("text").alias("size"), F.struct(*docs.columns).alias("doc"))
    taken = systematic_copies(_expected(sized, cycle, most), ["doc_id"], seed)
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return taken.select("doc", repeated.alias("nth")).select("doc.*")
