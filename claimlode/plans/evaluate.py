"""Retrieval checks: self-retrieval, similarity log, overlap with an outside list, one-vs-list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.functions.text import (
    fmt4,
    found_flag,
    id_string,
    is_blank,
    normalize_id,
    overlap_size,
    pack_list,
    publication_digits,
    unpack_list,
)
from claimlode.functions.vectors import COSINE, INNER
from claimlode.operators.cells import CellIndex, search_cells_until
from claimlode.operators.joins import attach_external, id_difference, keep_in_list, left_join_1n
from claimlode.operators.search import first_occurrence, pick_query, rank_all, rerank, topk_distinct
from claimlode.session import stored

Encode = Callable[[DataFrame, str], DataFrame]

TOP_PATENTS = 10
EXTERNAL_ITEMS = 100


def collect_ranked(hits: DataFrame, query_id: str = "query_id", rank: str = "rank") -> DataFrame:
    """One row per query with its hits as an array ordered by rank (at most k items)."""
    items = F.struct(rank, *[c for c in hits.columns if c not in (query_id, rank)])
    return hits.groupBy(query_id).agg(F.sort_array(F.collect_list(items)).alias("hits"))


def similarity_log(
    check: DataFrame,
    corpus: DataFrame,
    k: int = TOP_PATENTS,
    overfetch: int | None = None,
    metric: str = INNER,
    *,
    query_id: str = "query_id",
    claim: str = "claim",
    index: CellIndex | None = None,
) -> DataFrame:
    """Check rows with packed top patents, packed 4-decimal scores and the found-itself flag.

    ``check`` has query id, claim, patent_id and embedding. Blank claims stay, with empty lists
    and 'N'. With an ``index`` of the same corpus a query reads its nearest cells, and further ones while it
    has fewer than k patents.
    """
    asked = check.where(~is_blank(F.col(claim))).select(query_id, "embedding")
    if index is None:
        hits = topk_distinct(asked, corpus, "patent_id", k, overfetch, metric, query_id=query_id)
    else:
        hits = search_cells_until(
            asked, index.cells, index.centroids, "patent_id", k, index.nprobe, metric, query_id=query_id
        )
    named = hits.withColumn("patent_id", id_string(F.col("patent_id")))
    packed = collect_ranked(named.select(query_id, "rank", "patent_id", "score"), query_id)
    lists = packed.select(
        query_id,
        F.col("hits.patent_id").alias("_ids"),
        F.transform("hits.score", fmt4).alias("_scores"),
    )
    # The lists grow with the queries, but their estimate follows the corpus: no broadcast here.
    return (
        check.drop("embedding")
        .join(lists.hint("merge"), query_id, "left")
        .withColumns(
            {
                "top_patents": F.coalesce(pack_list(F.col("_ids")), F.lit("")),
                "similarities": F.coalesce(pack_list(F.col("_scores")), F.lit("")),
                "found_itself": found_flag(F.col("_ids"), id_string(F.col("patent_id"))),
            }
        )
        .drop("_ids", "_scores")
    )


def self_retrieval(check: DataFrame, corpus: DataFrame, **options) -> DataFrame:
    """:func:`similarity_log` without the scores."""
    return similarity_log(check, corpus, **options).drop("similarities")


def first_n_unique(
    df: DataFrame, group: str, key: str, position: str, n: int = EXTERNAL_ITEMS
) -> DataFrame:
    """The first ``n`` distinct non-null keys per group, in position order, ranked from 1."""
    firsts = first_occurrence(df.where(F.col(key).isNotNull()), group, key, (position,))
    return rerank(firsts, group, (position, key), n)


def external_lists(
    external: DataFrame, n: int = EXTERNAL_ITEMS, query_id: str = "query_id"
) -> DataFrame:
    """One packed list of publication digits per query, from (query id, pos, publication_number)."""
    numbers = external.withColumn("number", publication_digits(F.col("publication_number")))
    firsts = first_n_unique(numbers, query_id, "number", "pos", n)
    listed = collect_ranked(firsts.select(query_id, "rank", "number"), query_id)
    return listed.select(query_id, pack_list(F.col("hits.number")).alias("external_patents"))


def external_overlap(
    check: DataFrame, external: DataFrame, n: int = EXTERNAL_ITEMS, query_id: str = "query_id"
) -> DataFrame:
    """Check rows with their outside list and the number of top patents found in it."""
    joined = attach_external(check, external_lists(external, n, query_id), query_id)
    found = overlap_size(unpack_list(F.col("top_patents")), unpack_list(F.col("external_patents")))
    return joined.withColumn("total_found", found)


def one_vs_list_ranked(
    query: DataFrame, corpus: DataFrame, ids: DataFrame, metric: str = INNER, sort: bool = True
) -> DataFrame:
    """Every corpus claim of the listed patents with its score for one query, best first.

    The list filter goes before the scoring: the rows that remain are the same.
    """
    listed = ids.select(normalize_id(F.col("patent_id")).alias("norm_id"))
    wanted = keep_in_list(
        corpus.withColumn("norm_id", normalize_id(F.col("patent_id"))), listed, "norm_id"
    )
    scored = rank_all(query, wanted, metric, name="similarity").drop("embedding")
    return scored.orderBy(F.desc("similarity"), "row_id") if sort else scored


def list_with_claims(ids: DataFrame, corpus: DataFrame) -> DataFrame:
    """The list (pos, patent_id) with all claims of each patent; absent patents keep null."""
    return left_join_1n(ids, corpus, "patent_id")


def one_vs_list_direct(
    ids: DataFrame,
    corpus: DataFrame,
    encode: Encode,
    claim: str = "cleaned_claim",
    sort: bool = True,
) -> DataFrame:
    """Listed, non-blank claims with their cosine to the list's first claim, best first.

    ``ids`` has pos and patent_id; the first claim is that of lowest pos, then lowest row id.
    Only the listed claims are encoded, each once: their table is stored.
    """
    claims = list_with_claims(ids, corpus).where(~is_blank(F.col(claim)))
    coded = stored(encode(claims, claim), "listed-claims")
    place = F.struct("pos", "row_id").alias("_place")
    first = pick_query(coded.select(place, claim, "embedding"), "_place", claim)
    scored = rank_all(first, coded, COSINE, name="similarity_to_first")
    kept = scored.drop("embedding")
    return kept.orderBy(F.desc("similarity_to_first"), "pos", "row_id") if sort else kept


def list_coverage(ids: DataFrame, corpus: DataFrame) -> DataFrame:
    """Distinct normalised ids of list and corpus, and how many of the list the corpus lacks."""
    listed = ids.select(normalize_id(F.col("patent_id")).alias("norm_id"))
    known = corpus.select(normalize_id(F.col("patent_id")).alias("norm_id"))
    missing = id_difference(listed, known, "norm_id").agg(F.count("*"))
    size = F.count_distinct("norm_id")
    return listed.agg(size.alias("list_ids")).select(
        "list_ids",
        known.agg(size).scalar().alias("corpus_ids"),
        missing.scalar().alias("missing_ids"),
    )
