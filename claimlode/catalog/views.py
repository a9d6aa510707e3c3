"""Claim-shaped views over the test tables, so that every registered query has real input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlode.functions.text import clean_claim
from claimlode.operators.cells import cell_centroids
from claimlode.operators.encode import hash_encoder
from claimlode.operators.numbering import split_narrow
from claimlode.session import shared_path
from claimlode.sources.tables import read_claims

DIM = 64
BATCH_ROWS = 64


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def documents(spark: SparkSession, root: str, *extra: str) -> DataFrame:
    path = f"{root}/documents.parquet"
    return read_claims(spark, path, ("doc_id", "text", *extra))


def as_claims(docs: DataFrame, *extra: str) -> DataFrame:
    """Four claims per patent; some carry a tag, some the set phrase, some are null."""
    doc = F.col("doc_id")
    decorated = F.concat(
        F.when(doc % 3 == 0, "<b>1.</b> ").otherwise(""),
        F.when(doc % 5 == 0, " The Present Invention is shown. ").otherwise(""),
        F.col("text"),
    )
    return docs.select(
        doc.alias("row_id"),
        F.expr("string(1000000 + doc_id div 4)").alias("patent_id"),
        (doc % 4).cast("int").alias("claim_no"),
        F.when(doc % 97 != 0, decorated).alias("claim_text"),
        *extra,
    )


def claims(spark: SparkSession, root: str, *extra: str) -> DataFrame:
    """The claims, on all cores even where the file is a single split."""
    return as_claims(split_narrow(documents(spark, root, *extra), "doc_id"), *extra)


def cleaned_claims(spark: SparkSession, root: str) -> DataFrame:
    return claims(spark, root).withColumn("cleaned_claim", clean_claim(F.col("claim_text")))


def encode(df: DataFrame, text: str) -> DataFrame:
    return hash_encoder(df, text, DIM)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a parquet table in the shared folder, so that texts are encoded only once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def claim_table(spark: SparkSession, root: str) -> DataFrame:
    """The stored text table of an embedding job: row id, patent and cleaned claim."""
    rows = cleaned_claims(spark, root).select("row_id", "patent_id", "cleaned_claim")
    return stored(rows, "claims")


def encoded_claims(spark: SparkSession, root: str) -> DataFrame:
    return encode(cleaned_claims(spark, root), "cleaned_claim").drop("claim_text")


def check_table(spark: SparkSession, root: str) -> DataFrame:
    """Each claim as a retrieval test of its own patent; the raw text is encoded."""
    rows = claims(spark, root).select(
        F.col("row_id").alias("query_id"), "patent_id", F.col("claim_text").alias("claim")
    )
    return encode(rows, "claim")


def corpus(spark: SparkSession, root: str) -> DataFrame:
    """Five vectors per patent."""
    return table(spark, root, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.expr("string(1000000 + vec_id div 5)").alias("patent_id"),
        "label",
        "embedding",
    )


def queries(spark: SparkSession, root: str) -> DataFrame:
    """Every vector as a query."""
    rows = corpus(spark, root)
    return rows.select(F.col("row_id").alias("query_id"), "patent_id", "label", "embedding")


def external(spark: SparkSession, root: str) -> DataFrame:
    """Outside result lists: one per supplier, its order lines in order; returned ones lack a number."""
    number = F.expr("concat('US', string(1000000 + l_partkey div 4), 'B2')")
    return table(spark, root, "lineitem").select(
        F.col("l_suppkey").cast("bigint").alias("query_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("pos"),
        F.when(F.col("l_returnflag") != "R", number).alias("publication_number"),
    )


def numbers(spark: SparkSession, root: str) -> DataFrame:
    """Publication numbers of several kinds."""
    key = F.col("p_partkey")

    def made(prefix: str, width: int, suffix: str):
        return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"), F.lit(suffix))

    number = (
        F.when(key % 6 == 0, made("US", 7, "B2"))
        .when(key % 6 == 1, made("US2006", 7, "A1"))
        .when(key % 6 == 2, made("USD", 6, "S1"))
        .when(key % 6 == 3, made(" EP", 7, "A1 "))
        .when(key % 6 == 4, "US1")
    )
    return table(spark, root, "part").select(
        key.cast("bigint").alias("item"), number.alias("publication_number")
    )


def listed_patents(spark: SparkSession, root: str) -> DataFrame:
    """The patents of all outside results as one list: each once, at its first position."""
    numbered = table(spark, root, "lineitem").where("l_returnflag <> 'R'")
    firsts = numbered.groupBy(F.expr("1000000 + l_partkey div 4").alias("number")).agg(
        F.min(F.expr("bigint(l_orderkey * 8 + l_linenumber)")).alias("pos")
    )
    return stored(firsts.select(F.col("number").cast("string").alias("patent_id"), "pos"), "list")


def metadata_batches(spark: SparkSession, root: str) -> DataFrame:
    """Text rows of the claims, cut by row id."""
    return cleaned_claims(spark, root).select(
        F.expr(f"int(row_id div {BATCH_ROWS})").alias("batch_id"),
        (F.col("row_id") % BATCH_ROWS).alias("pos"),
        "patent_id",
        "cleaned_claim",
    )


def vector_batches(spark: SparkSession, root: str) -> DataFrame:
    """Vector rows, cut alike; there are fewer of them, so later batches lack or mismatch."""
    return corpus(spark, root).select(
        F.expr(f"int(row_id div {BATCH_ROWS})").alias("batch_id"),
        (F.col("row_id") % BATCH_ROWS).alias("pos"),
        "embedding",
    )


def label_centroids(spark: SparkSession, root: str) -> DataFrame:
    return cell_centroids(corpus(spark, root), "label")
