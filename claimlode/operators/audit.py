"""Row counts per batch, pairing of text and vector batches, load audit."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimlode.session import stored

# A failing load is cut in halves down to so many batches, which are then tried one by one.
LOAD_GROUP = 32
# The three verdicts of a load.
VERDICT_DELTA = "WARNING"
VERDICT_SKIPPED = "NOTE"
VERDICT_OK = "OK"


def rows_per_batch(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    return df.groupBy(batch).agg(F.count("*").alias("rows"))


def row_count(df: DataFrame) -> DataFrame:
    """One-row table with the number of rows."""
    return df.agg(F.count("*").alias("rows"))


def union_batches(*parts: DataFrame) -> DataFrame:
    """All rows of several batches, matched by column name."""
    return reduce(lambda left, right: left.unionByName(right), parts)


def pair_batches(meta: DataFrame, vectors: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Status per batch number: ok, missing (one side absent) or mismatch (row counts differ)."""
    left = meta.groupBy(batch).agg(F.count("*").alias("meta_rows"))
    right = vectors.groupBy(batch).agg(F.count("*").alias("vector_rows"))
    status = (
        F.when(F.col("meta_rows").isNull() | F.col("vector_rows").isNull(), "missing")
        .when(F.col("meta_rows") != F.col("vector_rows"), "mismatch")
        .otherwise("ok")
    )
    return left.join(right, batch, "full").withColumn("status", status)


def zip_rows(
    meta: DataFrame, vectors: DataFrame, batch: str = "batch_id", position: str = "pos"
) -> DataFrame:
    """Vector i beside metadata row i, in the batches whose two sides have equal row counts."""
    good = pair_batches(meta, vectors, batch).where(F.col("status") == "ok").select(batch)
    return meta.join(good, batch, "left_semi").join(vectors, [batch, position])


def load_manifest(
    meta: DataFrame, vectors: DataFrame, written: DataFrame, batch: str = "batch_id"
) -> DataFrame:
    """Per batch: its status, the rows its metadata lists and the rows that were written."""
    done = written.groupBy(batch).agg(F.count("*").alias("written_rows"))
    return (
        pair_batches(meta, vectors, batch)
        .join(done, batch, "left")
        .select(
            batch,
            "status",
            F.coalesce("meta_rows", F.lit(0)).alias("manifest_rows"),
            F.coalesce("written_rows", F.lit(0)).alias("written_rows"),
        )
    )


def audit_totals(manifest: DataFrame) -> DataFrame:
    """Expected and reported row totals."""
    return manifest.agg(
        F.coalesce(F.sum("manifest_rows"), F.lit(0)).alias("expected"),
        F.coalesce(F.sum("written_rows"), F.lit(0)).alias("reported"),
    )


def load_audit(manifest: DataFrame, before: int | DataFrame, after: int | DataFrame) -> DataFrame:
    """Totals, table rows before and after, their difference and the verdict, in one row.

    ``before`` and ``after`` are counts, or one-row tables of them. The expected total counts
    skipped batches too, so a skipped batch always shows.
    """

    def value(count: int | DataFrame):
        return count.scalar() if isinstance(count, DataFrame) else F.lit(count)

    totals = audit_totals(manifest).withColumns(
        {"before": value(before).cast("bigint"), "after": value(after).cast("bigint")}
    )
    verdict = (
        F.when(F.col("delta") != F.col("reported"), VERDICT_DELTA)
        .when(F.col("reported") != F.col("expected"), VERDICT_SKIPPED)
        .otherwise(VERDICT_OK)
    )
    return totals.withColumn("delta", F.col("after") - F.col("before")).withColumn(
        "verdict", verdict
    )


def load_batches(
    meta: DataFrame,
    vectors: DataFrame,
    write: Callable[[DataFrame], None],
    batch: str = "batch_id",
    position: str = "pos",
    group: int = LOAD_GROUP,
) -> DataFrame:
    """Load paired batches and return what became of each: (batch, status, manifest_rows, written_rows).

    Batches with one side missing or of unequal length are skipped. The others are paired once, stored in the order of
    their numbers and handed to ``write`` all together; what is written is counted on the way (an observation) and must
    be the rows stored. If ``write`` fails, the halves are tried, and so on down to ``group`` batches, whose batches are
    tried one by one; those that still fail get the status ``failed``. A load without failures is one write, and a failing
    batch costs some more of ever fewer rows. ``write`` must write the table it is given, once, and put either all of its
    rows or none, as Spark's own sinks do. Batch numbers and their row counts reach the driver, nothing else.
    """
    manifest = stored(pair_batches(meta, vectors, batch), "load-manifest")
    # By range: a part of the batches is read from the files that hold it.
    ranged = zip_rows(meta, vectors, batch, position).repartitionByRange(batch).sortWithinPartitions(batch)
    rows = stored(ranged, "load-rows")
    sizes = {row[batch]: row["rows"] for row in rows_per_batch(rows, batch).collect()}
    good = [row[batch] for row in manifest.where("status = 'ok'").select(batch).orderBy(batch).collect()]
    outcomes: dict = {}
    waiting = [good] if good else []
    while waiting:
        some = waiting.pop()
        seen = Observation()
        try:
            write(rows.where(F.col(batch).between(some[0], some[-1])).observe(seen, F.count("*").alias("n")))
        except PySparkException:
            if len(some) == 1:
                outcomes[some[0]] = "failed"
            else:
                step = 1 if len(some) <= group else -(-len(some) // 2)
                waiting += [some[start : start + step] for start in range(0, len(some), step)][::-1]
            continue
        if seen.get["n"] != sum(sizes.get(number, 0) for number in some):
            raise RuntimeError(f"{seen.get['n']} rows of the batches {some[0]} to {some[-1]} were written")
        outcomes |= dict.fromkeys(some, "ok")
    told = [(number, outcome, sizes.get(number, 0) if outcome == "ok" else 0) for number, outcome in outcomes.items()]
    kind = manifest.schema[batch].dataType.simpleString()
    results = meta.sparkSession.createDataFrame(told, f"{batch} {kind}, outcome string, loaded bigint")
    return manifest.join(results, batch, "left").select(
        batch,
        F.coalesce("outcome", "status").alias("status"),
        F.coalesce("meta_rows", F.lit(0)).alias("manifest_rows"),
        F.coalesce("loaded", F.lit(0)).alias("written_rows"),
    )
