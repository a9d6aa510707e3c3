"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlode.llm import jaccard, mixing, packing, quality, repeats
from claimlode.llm.common import stored
from claimlode.session import ship_package


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, taught by the table of labels, does not reject.

    Null and empty texts are judged as the model judges a text without lines; all columns stay.
    """
    ship_package(spark)
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; null and empty texts are near nothing and stay, as do all columns."""
    ship_package(spark)
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words that still occur more than once.

    All rows stay; a null or empty text, and columns besides text and n_chars, stay as they are.
    """
    ship_package(spark)
    return repeats.without_passages(docs, words=51)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a null source is a source, empty texts have no size to take."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document with its place; a null text is empty."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_chain", keep_good),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: None: the first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
