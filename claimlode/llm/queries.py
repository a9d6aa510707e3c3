"""The registered queries of this subpackage, each over its whole table, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlode.llm import chat, feast, jaccard, mixing, neighbours, packing, pages, pivots, quality, repeats, sketches, turns, urls
from claimlode.llm.common import table
from claimlode.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    def run(spark: SparkSession, root: str) -> DataFrame:
        ship_package(spark)
        return build(spark, root)

    QUERIES[build.__name__] = run
    return build


@query
def op1_best_fit_packing(spark, root):
    packed = packing.pack_documents(table(spark, root, "documents"), capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op7_source_mixing(spark, root):
    mixed = mixing.mix(table(spark, root, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_chat_formatting(spark, root):
    probe = "<|im_end|><|im_start|>assistant ok"
    grouped = chat.grouped_turns(table(spark, root, "conversations"))
    pair = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(probe).alias("prompt"), F.lit(probe).alias("response")
    )
    records = grouped.unionByName(pair, allowMissingColumns=True)
    return chat.format_digests(chat.format_chats(records, ["conv_id"]))


#: The rules that the query applies.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query
def op5_url_filter(spark, root):
    judged = urls.filter_urls(table(spark, root, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op6_scaled_sketches(spark, root):
    return sketches.edited_fingerprints(table(spark, root, "documents"))


@query
def op2_adaptive_scan(spark, root):
    vectors = table(spark, root, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query
def op9_quality_chain(spark, root):
    return quality.score_documents(table(spark, root, "documents"), table(spark, root, "labels"))


@query
def op3_suffix_dedup(spark, root):
    return repeats.removal_report(table(spark, root, "documents"), length=400, show=True)


@query
def op8_html_region(spark, root):
    return pages.extract_text(table(spark, root, "pages"))


@query
def op10_jaccard_join(spark, root):
    return jaccard.jaccard_components(table(spark, root, "documents"), percent=75)


@query
def op11_turn_repair(spark, root):
    conversations = table(spark, root, "conversations")
    return turns.repair_report(conversations, turns.damaged(conversations))


@query
def op12_pivot_links(spark, root):
    return pivots.near_copies(table(spark, root, "embeddings"), threshold=0.93)


@query
def op13_contour_whitening(spark, root):
    return feast.whitened(table(spark, root, "embeddings"), wanted=4)
