from __future__ import annotations

import numpy as np
import pytest

from claimlode.operators import joins
from claimlode.operators.encode import hash_encoder
from claimlode.plans import evaluate
from claimlode.plans.search import search_text

CORPUS = [
    (0, "100", "a door motor with a mirror"),
    (1, "100", "a mirror with a door motor"),
    (2, "200", "ultrasound imaging of a patient"),
    (3, "300", "voxel features of a three dimensional image"),
    (4, "D400", ""),
]


def encode(df, text):
    return hash_encoder(df, text, 64)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = spark.createDataFrame(CORPUS, "row_id long, patent_id string, cleaned_claim string")
    return encode(rows, "cleaned_claim")


@pytest.fixture(scope="module")
def check(spark):
    rows = [
        (0, "a door motor with a mirror", "100"),
        (1, " \n", "200"),
        (2, None, "300"),
        (3, "imaging of a patient, ultrasound", "999"),
    ]
    return encode(spark.createDataFrame(rows, "query_id long, claim string, patent_id string"), "claim")


def by_query(df):
    return {r.query_id: r for r in df.collect()}


def test_self_retrieval_keeps_blank_claims(check, corpus):
    got = by_query(evaluate.self_retrieval(check, corpus, k=2))
    assert {q: r.found_itself for q, r in got.items()} == {0: "Y", 1: "N", 2: "N", 3: "N"}
    assert got[1].top_patents == got[2].top_patents == ""
    assert got[0].top_patents.split(" | ")[0] == "100"
    assert got[3].top_patents.split(" | ")[0] == "200"


def test_similarity_log_packs_scores_in_the_same_order(check, corpus):
    got = by_query(evaluate.similarity_log(check, corpus, k=3))[0]
    ids, scores = got.top_patents.split(" | "), got.similarities.split(" | ")
    assert len(ids) == len(scores) == len(set(ids)) == 3 and scores[0] == "1.0000"
    assert [float(s) for s in scores] == sorted(map(float, scores), reverse=True)
    exact = by_query(evaluate.similarity_log(check, corpus, k=3, overfetch=None))[0]
    assert exact.top_patents == got.top_patents


def test_external_overlap(spark, check, corpus):
    rows = [(0, 2, "US100B2"), (0, 1, "US300B1"), (0, 3, "US100A1"), (0, 4, None), (0, 5, "D7"), (3, 1, "US5B2")]
    external = spark.createDataFrame(rows, "query_id long, pos long, publication_number string")
    log = evaluate.self_retrieval(check, corpus, k=2)
    got = by_query(evaluate.external_overlap(log, external))
    assert got[0].external_patents == "300 | 100" and got[0].total_found >= 1
    assert got[1].external_patents is None and got[1].total_found == 0 and got[3].total_found == 0
    short = by_query(evaluate.external_overlap(log, external, n=1))
    assert short[0].external_patents == "300"


def test_first_n_unique_with_a_hot_group(spark):
    rows = [(0, i, f"n{i % 150}") for i in range(900)] + [(1, 0, "n0"), (1, 1, None)]
    df = spark.createDataFrame(rows, "q int, pos int, number string")
    got = evaluate.first_n_unique(df, "q", "number", "pos", 100).collect()
    assert {(r.q, r["rank"], r.number) for r in got} == {(0, i + 1, f"n{i}") for i in range(100)} | {(1, 1, "n0")}


def test_one_vs_list(spark, corpus):
    ids = spark.createDataFrame([(1, "300"), (0, "100"), (2, "777"), (3, "D400")], "pos int, patent_id string")
    query = corpus.where("row_id = 0")
    ranked = evaluate.one_vs_list_ranked(query, corpus, ids).collect()
    assert [r.row_id for r in ranked][0] == 0 and {r.row_id for r in ranked} == {0, 1, 3}
    assert ranked[0].similarity == pytest.approx(1, abs=1e-6)
    direct = evaluate.one_vs_list_direct(ids, corpus.drop("embedding"), encode).collect()
    assert {r.row_id: round(r.similarity_to_first, 6) for r in direct} == {
        r.row_id: round(r.similarity, 6) for r in ranked
    }
    coverage = evaluate.list_coverage(ids, corpus).first()
    # D400 normalises to nothing and counts nowhere.
    assert tuple(coverage) == (3, 3, 1)


@pytest.mark.parametrize("bound", [0, 500_000])
def test_search_text_shows_rank_and_claim(spark, corpus, bound, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_HITS", bound)
    asked = spark.createDataFrame([(7, "mirror motor door"), (8, "  ")], "query_id long, query string")
    got = search_text(asked, corpus, encode, k=2).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.patent_id) for r in got] == [(7, 1, "100"), (7, 2, "100")]
    assert got[0].cleaned_claim in (CORPUS[0][2], CORPUS[1][2])
    assert got[0].score >= got[1].score and np.isfinite(got[0].score)
