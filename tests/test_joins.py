from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimlode.operators import joins


@pytest.fixture(scope="module")
def claims(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"p{i % 10}", f" text {i % 4}\n") for i in range(90)]
    rows += [(90, None, None), (91, "p1", "same"), (92, "p1", "same")]
    return spark.createDataFrame(rows, "row_id int, patent_id string, claim_text string")


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame([("hot", 0), ("p1", 1), ("absent", 2)], "patent_id string, pos int")


def bag(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(claims, listed, how):
    plain = claims.join(listed, "patent_id", how)
    spread = joins.spread_join(claims, listed, "patent_id", how, hot_rows=4)
    assert bag(spread.select(*plain.columns)) == bag(plain)


def test_hot_key_is_sliced(claims, listed):
    plan = joins.spread_join(claims, listed, "patent_id", hot_rows=4)._jdf.queryExecution().toString()
    assert "_slice" in plan
    plan = joins.spread_join(claims, listed, "patent_id")._jdf.queryExecution().toString()
    assert "_slice" not in plan


@pytest.mark.parametrize("hot_rows", [4, 1_000])
def test_left_join_1n(claims, listed, hot_rows):
    got = joins.left_join_1n(listed, claims, "patent_id", hot_rows=hot_rows)
    assert bag(got) == bag(listed.join(claims, "patent_id", "left"))
    assert got.where("patent_id = 'absent'").first().claim_text is None


def test_left_join_1n_rejects_repeats(claims, listed):
    with pytest.raises(ValueError, match="not unique on patent_id"):
        joins.left_join_1n(listed.union(listed), claims, "patent_id")


def test_exact_text_match_against_nested_loop(claims):
    a, b = claims.where("row_id % 2 = 0"), claims.where("row_id % 2 = 1")
    want = sorted(
        (x.patent_id, y.patent_id, x.claim_text)
        for x in a.collect()
        for y in b.collect()
        if x.claim_text and y.claim_text and x.claim_text.strip() == y.claim_text.strip()
    )
    for hot_rows in (3, 1_000):
        got = joins.exact_text_match(a, b, "patent_id", "claim_text", hot_rows=hot_rows)
        assert sorted(map(tuple, got.collect())) == want and want


def test_match_groups_counts(claims):
    a, b = claims.where("row_id < 60"), claims.where("row_id >= 60")
    got = joins.match_groups(a, b, "patent_id", "claim_text").collect()
    assert sorted((r.rows_a, r.rows_b) for r in got) == sorted(
        (sum(i % 4 == t for i in range(60)), sum(i % 4 == t for i in range(60, 90))) for t in range(4)
    )


def test_filter_ids_literal_and_joined(spark, claims, listed):
    literal = joins.filter_ids(claims, ["hot"], ["p1", "hot"], "patent_id")
    frame_a = spark.createDataFrame([("hot",)], "patent_id string")
    joined = joins.filter_ids(claims, frame_a, ["p1", "hot"], "patent_id")
    assert bag(joined.select(*literal.columns)) == bag(literal)
    assert literal.where("in_a and in_b").count() == 30


def test_sets_and_coverage(spark, claims, listed):
    assert [r[0] for r in joins.missing_ids(listed, claims, "patent_id").collect()] == ["absent"]
    assert {r[0] for r in joins.id_intersection(listed, claims, "patent_id").collect()} == {"hot", "p1"}
    kept = joins.keep_in_list(claims, listed, "patent_id")
    assert kept.count() == claims.where("patent_id in ('hot', 'p1')").count()


def test_attach_metadata_broadcasts_only_bounded_hits(claims):
    hits = claims.select("row_id").limit(3)
    meta = claims.select("row_id", "claim_text")
    plan = joins.attach_metadata(hits, meta, hit_rows=3)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    assert joins.attach_metadata(hits, meta).count() == 3


def test_drop_nulls_and_distinct_count(claims):
    assert joins.drop_nulls(claims, "patent_id").count() == 92
    exact = claims.agg(joins.distinct_count(claims, "patent_id")).first()[0]
    rough = claims.agg(joins.distinct_count(claims, "patent_id", approximate=True)).first()[0]
    assert exact == claims.select("patent_id").dropna().distinct().count() == rough
    assert joins.attach_external(claims.select(F.col("row_id").alias("query_id")), claims.select(
        F.col("row_id").alias("query_id"), "claim_text").where("row_id < 5")).count() == 93


@pytest.mark.parametrize("limit", [1_000_000, 40, 7])
def test_a_text_copied_on_both_sides_is_cut_into_a_grid(spark, limit):
    left = spark.createDataFrame([("hot" if i < 100 else f"k{i}", i) for i in range(120)] + [(None, 1)], "key string, a int")
    right = spark.createDataFrame([("hot" if i < 90 else f"k{i + 15}", i) for i in range(110)] + [(None, 2)], "key string, b int")
    got = joins.grid_join(left, right, "key", limit, limit)
    want = sorted(map(tuple, left.join(right, "key").collect()))
    assert sorted(map(tuple, got.collect())) == want
    a, b = joins.grid_cut(left, right, "key", limit, limit)
    parts = a.where("key = 'hot'").select("_left_part", "_right_part").distinct().count()
    assert parts == (1 if limit > 100 else -(-100 // limit) * -(-90 // limit))
    most = a.where("key = 'hot'").groupBy("_left_part", "_right_part").count().agg({"count": "max"}).first()[0]
    assert most <= 100 if limit > 100 else most < 100


def test_pairs_of_equal_texts_do_not_depend_on_the_cut(spark):
    rows = [(f"p{i}", " same text " if i % 2 else f"text {i % 7}") for i in range(60)]
    a, b = (spark.createDataFrame(part, "patent_id string, claim string") for part in (rows[:35], rows[20:]))
    whole = joins.exact_text_match(a, b, "patent_id", "claim")
    cut = joins.exact_text_match(a, b, "patent_id", "claim", hot_rows=4)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_overlap_counts_different_items(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None), (None, "a")], "g int, item string")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (1, "z"), (2, "a"), (3, None)], "g int, item string")
    assert sorted(map(tuple, joins.overlap_counts(left, right, "g", "item").collect())) == [(1, 2), (2, 0), (3, 0)]
