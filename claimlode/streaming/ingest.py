"""Incremental embedding: each run takes the not yet processed files and stops when none is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlode.functions.text import clean_claim
from claimlode.operators.numbering import split_narrow


def ingest_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    encode: Callable[[DataFrame, str], DataFrame],
    *,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    pattern: str = "*.parquet",
    files_per_trigger: int = 1_000,
    first_batch: int = 0,
    spread_by: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Clean, encode and store all new claim files below ``source``.

    Every micro-batch becomes one ``batch_id`` folder below ``target``. The number follows the
    stream's own batch number, so a batch repeated after a failure replaces itself. ``checkpoint``
    remembers the files already done. ``spread_by`` names a key column that spreads a micro-batch
    of too few splits over all cores before the encoder.
    """

    def store(claims: DataFrame, number: int) -> None:
        if spread_by is not None:
            claims = split_narrow(claims, spread_by)
        ready = claims.withColumn("cleaned_claim", clean_claim(F.col("claim_text")))
        numbered = encode(ready, "cleaned_claim").withColumn("batch_id", F.lit(first_batch + number))
        # No repartitioning: the micro-batch is one batch, its tasks write side by side.
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(target)

    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(source)
    )
    if prepare is not None:
        stream = prepare(stream)
    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
