"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range is kept.

Sketches of parts merge into the sketch of the whole by union, and since the threshold does not
depend on the text, the share of a small text's hashes found in a large one's estimates
containment. Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlode.llm.common import WORD, stored

#: Words in a shingle.
SHINGLE = 5
#: Kept fraction of all hashes: one in this many.
SCALE = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` is evaluated for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """Hashes of all word shingles; a text of fewer words is one shingle, one without words has none."""

    def hashes(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
        whole = F.transform(places, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE))))
        return F.when(F.size(words) > 0, whole).otherwise(F.expr("CAST(array() AS array<bigint>)"))

    return let(F.regexp_extract_all(text, F.lit(WORD), 0), hashes)


def _kept(hashes: Column, scale: int) -> Column:
    limit = F.lit(min(-(1 << 63) + (1 << 64) // scale, (1 << 63) - 1))

    def filtered(all_: Column) -> Column:
        return let(F.array_min(all_), lambda low: F.filter(all_, lambda h: (h < limit) | (h == low)))

    return F.array_sort(F.array_distinct(let(hashes, filtered)))


def sketch(text: Column, scale: int = SCALE) -> Column:
    """The kept hashes, ordered; the smallest hash always stays, so no text with words has none."""
    return _kept(shingle_hashes(text), scale)


def merged(one: Column, other: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together."""
    return _kept(F.array_union(one, other), scale)


def containment(one: Column, other: Column) -> Column:
    """Share of the smaller sketch's hashes in the larger, 0 to 1; two empty sketches are alike."""
    least = F.least(F.size(one), F.size(other))
    shared = F.size(F.array_intersect(one, other)) / least
    both_empty = (F.size(one) == 0) & (F.size(other) == 0)
    return F.when(both_empty, F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(shared)


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, F.hex), ",")


def neighbours(ids: DataFrame) -> DataFrame:
    """For distinct (doc_id, digest, n_chars): the document before each, in order, and its length.

    The first document's is the last. Ranges of ids are sorted side by side; only the borders of the
    ranges meet in one task, a row each.
    """
    ranged = stored(ids.repartitionByRange("doc_id", "digest").withColumn("part", F.spark_partition_id()), "id-ranges")
    here = F.struct(F.col("doc_id"), F.col("digest"), F.col("n_chars"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "digest")
    place = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("digest"))
    last = ranged.groupBy("part").agg(F.max_by(here, place).alias("last"))
    over = Window.orderBy("part")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = last.select(
        "part", F.coalesce(F.lag("last").over(over), F.last("last").over(whole)).alias("border")
    )
    before = F.coalesce(F.lag(here).over(inside), "border")
    return (
        ranged.join(borders, "part")
        .select("doc_id", "digest", before.alias("before"))
        .select(
            "doc_id",
            "digest",
            F.col("before.doc_id").alias("before_id"),
            F.col("before.digest").alias("before_digest"),
            F.floor(F.col("before.n_chars") / 4).cast("int").alias("before_quarter"),
        )
    )


def edited_fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of (doc_id, text), of each text edited, and their likeness.

    Edited: the last quarter of the code points gives way to the first as many of the next
    document. A null text is empty. Documents of one id are ordered by digest; equal rows have one
    neighbour and equal results. Ids may be null (the first). Other columns are ignored.

    A text is shuffled once, by id; its first part and its sketch travel to the document before it.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("digest", F.xxhash64("text"))
    lengths = keyed.withColumn("n_chars", F.length("text")).select("doc_id", "digest", "n_chars").distinct()
    before = neighbours(lengths)
    same = keyed["doc_id"].eqNullSafe(before["doc_id"]) & (keyed["digest"] == before["digest"])
    located = keyed.join(before, same, "inner").select(keyed["doc_id"], keyed["digest"], "text", *before.columns[2:])
    located = located.withColumn("sketch", sketch(F.col("text"), scale))
    sent = located.select(
        F.col("before_id").alias("to_id"),
        F.col("before_digest").alias("to_digest"),
        F.struct(F.expr("left(text, before_quarter)").alias("text"), F.col("sketch")).alias("next"),
    ).dropDuplicates(["to_id", "to_digest"])
    meet = F.col("doc_id").eqNullSafe(F.col("to_id")) & (F.col("digest") == F.col("to_digest"))
    kept = F.length("text") - F.floor(F.length("text") / 4).cast("int")
    edited = (
        located.join(sent, meet)
        .withColumn("edited", F.concat(F.substr("text", F.lit(1), kept), F.col("next.text")))
        .withColumn("edited_sketch", sketch(F.col("edited"), scale))
    )
    return edited.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next.sketch")).alias("near_next"),
    )
