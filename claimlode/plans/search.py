"""Whole searches: from query texts to readable result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.functions.text import is_blank, run_tag
from claimlode.functions.vectors import INNER
from claimlode.operators.cells import CellIndex, search_cells
from claimlode.operators.joins import attach_metadata
from claimlode.operators.search import topk
from claimlode.sources.tables import write_result_csv

Encode = Callable[[DataFrame, str], DataFrame]


def search_text(
    queries: DataFrame,
    corpus: DataFrame,
    encode: Encode,
    k: int = 10,
    metric: str = INNER,
    *,
    text: str = "query",
    claim: str = "cleaned_claim",
    query_id: str = "query_id",
    row_id: str = "row_id",
    index: CellIndex | None = None,
) -> DataFrame:
    """Rank, query, patent, claim and score of the k best claims per query text.

    ``encode`` adds an ``embedding`` column from a text column. ``corpus`` holds row id, patent id,
    claim text and embedding; its text joins only after the search. With an ``index`` of the same corpus only the
    cells near a query are read. The queries are counted first:
    queries x k bounds the hits, and few enough of them are broadcast, so that the text table is
    scanned but not shuffled.
    """
    asked = queries.where(~is_blank(F.col(text)))
    named = {"query_id": query_id, "row_id": row_id, "carry": ("patent_id",)}
    if index is None:
        hits = topk(encode(asked, text), corpus, k, metric, **named)
    else:
        hits = search_cells(encode(asked, text), index.cells, index.centroids, k, index.nprobe, metric, **named)
    found = attach_metadata(hits, corpus.select(row_id, claim), row_id, queries.count() * k)
    return found.join(queries.select(query_id, text), query_id).select(
        query_id, "rank", text, "patent_id", claim, "score"
    )


def write_stamped(results: DataFrame, folder: str, name: str = "query_results") -> str:
    """Write a search result as CSV below ``folder``, named with the time of writing; returns its path."""
    tag = results.sparkSession.range(1).select(run_tag()).first()[0]
    path = f"{folder.rstrip('/')}/{name}_{tag}.csv"
    write_result_csv(results, path)
    return path


def compare_metrics(
    hits_a: DataFrame, hits_b: DataFrame, query_id: str = "query_id", item: str = "patent_id"
) -> DataFrame:
    """Per query: sizes of two result sets and of their intersection."""
    tagged = hits_a.select(query_id, item, F.lit(1).alias("side")).unionByName(
        hits_b.select(query_id, item, F.lit(2).alias("side"))
    )
    sides = tagged.groupBy(query_id, item).agg(
        F.max(F.col("side") == 1).alias("in_a"), F.max(F.col("side") == 2).alias("in_b")
    )
    return sides.groupBy(query_id).agg(
        F.count_if("in_a").alias("found_a"),
        F.count_if("in_b").alias("found_b"),
        F.count_if(F.col("in_a") & F.col("in_b")).alias("agreed"),
    )
