"""Contiguous row numbers, fixed-size batches and pages, without a single-partition window."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlode.session import pinned

INDEX_BITS = 33


def _sorting(order_by: Sequence[str], descending: Sequence[str]) -> list[Column]:
    return [F.desc(name) if name in descending else F.asc(name) for name in order_by]


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    key: Sequence[str],
    descending: Sequence[str] = (),
    partitions: int | None = None,
    name: str = "position",
) -> DataFrame:
    """Add 0-based ``name`` following ``order_by``; ``key`` names the unique columns of a row.

    ``order_by`` must end in a unique tiebreak. Only order and key columns are range-partitioned
    and pinned; one count per partition reaches the driver, and the wide columns join back by key.
    A repeated key is an error.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorting = _sorting(order_by, descending)
    located = pinned(
        df.select(*dict.fromkeys([*key, *order_by]))
        .repartitionByRange(count, *sorting)
        .sortWithinPartitions(*sorting)
        # High bits: partition in range order. Low bits: place inside the sorted partition.
        .select(*key, F.monotonically_increasing_id().alias("_slot"))
    )
    repeated = located.groupBy(*key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"key {list(key)} is not unique: {repeated[0]}")
    part = F.shiftright("_slot", INDEX_BITS).cast("int")
    counted = located.groupBy(part.alias("part")).agg(F.count("*").alias("size")).collect()
    sizes = {row["part"]: row["size"] for row in counted}
    starts, total = [0], 0
    for index in range(max(sizes, default=0)):
        total += sizes.get(index, 0)
        starts.append(total)
    before = F.get(F.lit(starts).cast("array<bigint>"), part)
    place = F.col("_slot").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    positions = located.select(*key, (before + place).alias(name))
    if set(df.columns) <= set(key):
        return positions.select(*df.columns, name)
    return df.join(positions, list(key)).select(*df.columns, name)


def assign_batches(
    df: DataFrame,
    order_by: Sequence[str],
    key: Sequence[str],
    size: int = 50_000,
    start_offset: int = 0,
    first_batch: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Cut the ordered rows into batches of ``size``, from row ``start_offset`` on.

    Adds ``batch_id`` (counting from ``first_batch``) and ``position`` (over all rows).
    """
    numbered = number_rows(df, order_by, key, partitions=partitions)
    batch = F.lit(first_batch) + F.floor((F.col("position") - start_offset) / size)
    return numbered.where(F.col("position") >= start_offset).withColumn(
        "batch_id", batch.cast("int")
    )


def page(
    df: DataFrame,
    order_by: Sequence[str],
    key: Sequence[str],
    offset: int,
    size: int,
) -> DataFrame:
    """Rows ``offset .. offset + size - 1`` of the ordered table, at any depth; a repeated key is an error."""
    inside = (F.col("position") >= offset) & (F.col("position") < offset + size)
    return number_rows(df, order_by, key).where(inside).drop("position")


@dataclass
class PageIndex:
    """A stored table in range order, one folder per range, and the position at which each range starts."""

    path: str
    order_by: tuple[str, ...]
    schema: T.StructType
    starts: list[int]
    rows: int

    def parts_of(self, offset: int, size: int) -> list[int]:
        """The ranges that hold rows ``offset .. offset + size - 1``."""
        if size <= 0 or offset + size <= 0 or offset >= self.rows:
            return []
        first = bisect_right(self.starts, max(offset, 0)) - 1
        last = bisect_right(self.starts, min(offset + size, self.rows) - 1) - 1
        return [part for part in range(first, last + 1)]


def write_page_index(
    df: DataFrame, order_by: Sequence[str], key: Sequence[str], path: str, partitions: int | None = None
) -> PageIndex:
    """Store ``df`` in the order of ``order_by``, cut into ranges, with the number of rows of each.

    The sort is paid once; a page then reads the one or two ranges it lies in. ``order_by`` must end in a
    unique tiebreak, ``key`` names the unique columns of a row; a repeated key is an error. One number per range
    reaches the driver.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *order_by).sortWithinPartitions(*order_by)
    ranged.withColumn("_part", F.spark_partition_id()).write.mode("overwrite").partitionBy("_part").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    repeated = stored.groupBy(*key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"key {list(key)} is not unique: {repeated[0]}")
    sizes = {row["_part"]: row["count"] for row in stored.groupBy("_part").count().collect()}
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    return PageIndex(path, tuple(order_by), schema, starts, total)


def read_page(spark: SparkSession, index: PageIndex, offset: int, size: int) -> DataFrame:
    """Rows ``offset .. offset + size - 1`` of an indexed table, at any depth, read from the ranges that hold them."""
    parts = index.parts_of(offset, size)
    stored = spark.read.schema(index.schema).parquet(index.path)
    rows = stored.where(F.col("_part").isin(parts))
    begin = F.get(F.lit(index.starts).cast("array<bigint>"), F.col("_part"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*index.order_by)) - 1
    numbered = rows.withColumn("_position", begin + place)
    inside = (F.col("_position") >= offset) & (F.col("_position") < offset + size)
    return numbered.where(inside).drop("_part", "_position")


def split_work(df: DataFrame, pieces: int) -> DataFrame:
    """Spread rows evenly over ``pieces`` partitions, e.g. before an expensive encoder."""
    return df.repartition(pieces)


def split_narrow(df: DataFrame, key: str, pieces: int | None = None) -> DataFrame:
    """Spread a scan by ``key``, but only when it has fewer splits than there are cores.

    Large tables have many splits and pass unchanged, without a shuffle. Meant for plain scans:
    counting the splits of a plan with joins or groupings would run them.
    """
    wanted = pieces or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, key)


def sort_desc(
    df: DataFrame, score: str, row_id: str, numbered: bool = False, key: Sequence[str] | None = None
) -> DataFrame:
    """Best score first, ties by ``row_id``; optionally with a fresh 0-based ``position``."""
    if not numbered:
        return df.orderBy(F.desc(score), F.asc(row_id))
    return number_rows(df, [score, row_id], key or [row_id], descending=[score])


def head(df: DataFrame, score: str, row_id: str, n: int) -> DataFrame:
    """The ``n`` best rows."""
    return df.orderBy(F.desc(score), F.asc(row_id)).limit(n)
