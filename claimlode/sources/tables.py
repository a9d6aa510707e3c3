"""Claim, result and vector tables: parquet, CSV and JDBC in and out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlode.functions.text import pack_list
from claimlode.functions.vectors import format_vector, require_dim

CLAIM_COLUMNS = ("patent_id", "claim_text")
# Fixed value: rows per insert page of a database load.
INSERT_PAGE = 1000
# Headers of the check table, in order; the outside tool's name is the caller's.
CHECK_HEADERS = {
    "claim": "claim",
    "patent_id": "patent_id",
    "top_patents": "top 10 retrieved patents",
    "found_itself": "found itself (Y/N)",
    "external_patents": "top 100 retrieved {source} patents",
    "total_found": "total found",
    "similarities": "similarities_top10",
}


def read_claims(
    spark: SparkSession,
    source: str | Mapping[str, str],
    columns: Sequence[str] = CLAIM_COLUMNS,
) -> DataFrame:
    """Claims from a parquet path or from a database.

    A mapping holds Spark JDBC options (url, dbtable, ...); give partitionColumn, lowerBound,
    upperBound and numPartitions there so that the read is parallel.
    """
    if isinstance(source, str):
        return spark.read.parquet(source).select(*columns)
    return spark.read.format("jdbc").options(**source).load().select(*columns)


def text_schema(columns: Iterable[str]) -> T.StructType:
    """All columns as text: ids stay text even where they are all digits."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_metadata_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    header: Sequence[str],
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with a header and quoted, possibly multi-line text.

    ``header`` names all columns of the file in order, ``columns`` those wanted.
    """
    frame = (
        spark.read.schema(text_schema(header))
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .csv(path if isinstance(path, str) else list(path))
    )
    return frame.select(*(columns or header))


def write_result_csv(df: DataFrame, path: str, headers: Mapping[str, str] | None = None) -> None:
    """Result table as CSV with header; array columns are packed, columns renamed by ``headers``."""
    packed = [
        pack_list(F.col(f.name).cast("array<string>")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name)
        for f in df.schema
    ]
    renamed = df.select(*packed).withColumnsRenamed(dict(headers or {}))
    writer = renamed.write.mode("overwrite").option("header", True)
    writer.option("quote", '"').option("escape", '"').csv(path)


def check_headers(source: str) -> dict[str, str]:
    """Header names of a check table whose outside lists come from ``source``."""
    return {name: title.format(source=source) for name, title in CHECK_HEADERS.items()}


def create_vector_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the (id, text, vector) table unless it exists."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} "
        f"(patent_id STRING, cleaned_claim STRING, embedding ARRAY<FLOAT>) USING parquet{place}"
    )


def vector_rows(df: DataFrame, dim: int) -> DataFrame:
    """The table's three columns, with the dimension enforced."""
    return df.select(
        F.col("patent_id").cast("string").alias("patent_id"),
        "cleaned_claim",
        require_dim(F.col("embedding"), dim).alias("embedding"),
    )


def append_vectors(df: DataFrame, target: str | Mapping[str, str], dim: int) -> None:
    """Append (id, text, vector) rows.

    ``target`` is a table name, a path (with a slash), or Spark JDBC options; databases get the
    vector as literal text in pages of ``INSERT_PAGE`` rows.
    """
    rows = vector_rows(df, dim)
    if isinstance(target, str):
        writer = rows.write.mode("append")
        writer.parquet(target) if "/" in target else writer.insertInto(target)
        return
    literal = rows.withColumn("embedding", format_vector(F.col("embedding")))
    options = {"batchsize": str(INSERT_PAGE), **target}
    literal.write.format("jdbc").options(**options).mode("append").save()


def values_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Literal rows, e.g. a check table or an id list."""
    return spark.createDataFrame(list(rows), schema)
