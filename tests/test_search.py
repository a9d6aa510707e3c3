from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlode.operators import search
from claimlode.plans.search import compare_metrics

DIM = 6
SCHEMA = "row_id long, patent_id string, embedding array<float>"


def unit(rng, n):
    points = rng.normal(size=(n, DIM))
    return (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)


@pytest.fixture(scope="module")
def data(spark):
    """Rows with exact copies (ties), one patent with a third of all rows, some null vectors."""
    rng = np.random.default_rng(7)
    points = unit(rng, 240)
    points[100:120] = points[0:20]
    groups = ["hot" if i % 3 == 0 else f"p{i % 40}" for i in range(240)]
    rows = [(i, groups[i], points[i].tolist()) for i in range(240)]
    rows += [(240, "p1", None), (241, "none", None)]
    corpus = spark.createDataFrame(rows, SCHEMA).repartition(5, "row_id")
    asked = unit(rng, 30)
    asked[:10] = points[:10]
    queries = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(asked)] + [(99, None)],
        "query_id long, embedding array<float>",
    )
    return queries, corpus, asked.astype(float), points.astype(float), groups


def brute(asked, points, k, metric, groups=None):
    out = set()
    for q, query in enumerate(asked):
        gain = points @ query if metric == "inner" else -((points - query) ** 2).sum(1)
        order = np.lexsort((np.arange(len(points)), -np.round(gain, 6)))
        seen, rank = set(), 0
        for row in order:
            if groups is not None:
                if groups[row] in seen:
                    continue
                seen.add(groups[row])
            rank += 1
            out.add((q, rank, int(row)))
            if rank == k:
                break
    return out


def found(df):
    return {(r.query_id, r["rank"], r.row_id) for r in df.collect()}


@pytest.mark.parametrize("metric", ["inner", "l2"])
@pytest.mark.parametrize("block_queries", [1_000, 7])
@pytest.mark.parametrize("seeded", [False, True])
def test_topk_against_brute_force(data, metric, block_queries, seeded):
    queries, corpus, asked, points, _ = data
    seed = corpus.where("row_id % 4 = 0") if seeded else None
    got = search.topk(queries, corpus, 9, metric, block_queries=block_queries, seed=seed)
    assert found(got) == brute(asked, points, 9, metric)


def test_k_above_row_count_gives_all_rows(data):
    queries, corpus, asked, points, _ = data
    assert found(search.topk(queries, corpus, 500)) == brute(asked, points, 500, "inner")


@pytest.mark.parametrize("tile", [16, 4_000_000])
def test_small_tiles_change_nothing(data, tile, monkeypatch):
    queries, corpus, asked, points, groups = data
    monkeypatch.setattr(search, "TILE_CELLS", tile)
    assert found(search.topk(queries, corpus, 3)) == brute(asked, points, 3, "inner")
    exact = search.topk_distinct(queries, corpus, k=3, overfetch=None)
    assert found(exact) == brute(asked, points, 3, "inner", groups)


@pytest.mark.parametrize("metric", ["inner", "l2"])
@pytest.mark.parametrize("seeded", [False, True])
def test_exact_distinct_against_brute_force(data, metric, seeded):
    queries, corpus, asked, points, groups = data
    seed = corpus.where("row_id % 2 = 0") if seeded else None
    got = search.topk_distinct(queries, corpus, k=10, overfetch=None, metric=metric, seed=seed)
    assert found(got) == brute(asked, points, 10, metric, groups)
    assert got.groupBy("query_id", "patent_id").count().where("count > 1").isEmpty()


def test_overfetch_may_be_short_but_agrees_where_long_enough(spark, data):
    queries, _, _, _, _ = data
    # The hot patent owns the 50 best rows of every query.
    rng = np.random.default_rng(1)
    near = [(i, "hot", [1.0] + [0.0] * 5) for i in range(60)]
    far = [(100 + i, f"p{i}", (-unit(rng, 1)[0]).tolist()) for i in range(20)]
    corpus = spark.createDataFrame(near + far, SCHEMA)
    one = spark.createDataFrame([(0, [1.0] + [0.0] * 5)], "query_id long, embedding array<float>")
    short = search.topk_distinct(one, corpus, k=10, overfetch=5)
    exact = search.topk_distinct(one, corpus, k=10, overfetch=None)
    assert short.count() == 1 and exact.count() == 10
    assert found(short) <= found(exact)


def test_both_metrics_rank_unit_vectors_alike(data):
    queries, corpus, *_ = data
    near, far = search.topk_inner(queries, corpus, 5), search.topk_l2(queries, corpus, 5)
    assert found(near) == found(far)
    joined = near.join(far.withColumnRenamed("score", "d"), ["query_id", "row_id"]).collect()
    assert all(abs(r.d - (2 - 2 * r.score)) < 1e-6 for r in joined)
    named = [search.topk(queries, corpus, 5, m, carry=("patent_id",)) for m in ("inner", "l2")]
    assert compare_metrics(*named).where("found_a <> agreed or found_b <> agreed").isEmpty()


def test_own_vector_comes_first(data):
    queries, corpus, *_ = data
    best = search.topk(queries, corpus, 1).where("query_id < 10").collect()
    assert {(r.query_id, r.row_id) for r in best} == {(i, i) for i in range(10)}
    assert all(abs(r.score - 1) < 1e-6 for r in best)


def test_no_queries_and_bad_metric(data):
    queries, corpus, *_ = data
    assert search.topk(queries.where("false"), corpus, 3).count() == 0
    with pytest.raises(ValueError, match="unknown metric"):
        search.topk(queries, corpus, 3, "hamming")


def test_candidates_are_cut_before_the_shuffle(data):
    queries, corpus, *_ = data
    blocks = search.query_table(queries, "query_id", "embedding", 1000)
    part = search._scan(
        corpus, blocks, queries.schema["query_id"], 3, "inner", "row_id", "embedding", (), None
    )
    per_task = part.groupBy("query_id", F.spark_partition_id().alias("p")).count()
    assert per_task.where("count > 3").isEmpty()
    assert blocks.agg(F.sum(F.size("_ids"))).first()[0] == 30


def test_only_needed_columns_are_scanned(data, tmp_path):
    queries, corpus, *_ = data
    path = str(tmp_path / "corpus")
    corpus.withColumn("cleaned_claim", F.lit("text")).write.parquet(path)
    stored = corpus.sparkSession.read.parquet(path)
    plan = search.topk(queries, stored, 3)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<row_id:bigint,embedding:array<float>>" in plan
    assert "IsNotNull(embedding)" in plan and "WindowGroupLimit" in plan


def test_rank_all_scores_every_row(data):
    queries, corpus, asked, points, _ = data
    got = search.rank_all(queries.where("query_id = 3"), corpus).collect()
    assert len(got) == 240
    assert all(abs(r.score - points[r.row_id] @ asked[3]) < 1e-6 for r in got)
    with pytest.raises(ValueError, match="exactly one"):
        search.rank_all(queries, corpus)


def test_pick_query_takes_the_lowest_position(spark):
    rows = spark.createDataFrame([(3, "c"), (1, None), (2, "b")], "pos int, claim string")
    assert search.pick_query(rows, "pos", "claim").collect() == [(2, "b")]


def test_unrankable_vectors_stay_out(spark):
    nan = float("nan")
    rows = [(0, "a", [1.0, 0.0]), (1, "b", [nan, 1.0]), (2, "c", [0.0, 1.0]), (3, "d", [float("inf"), 0.0])]
    corpus = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    asked = spark.createDataFrame([(0, [1.0, 1.0]), (1, [nan, 0.0])], "query_id long, embedding array<float>")
    for metric in ("inner", "l2"):
        assert found(search.topk(asked, corpus, 1, metric)) == {(0, 1, 0)}


@pytest.mark.parametrize("block", [4, 1000])
def test_repeated_query_id_is_an_error(data, block):
    queries, corpus = data[:2]
    twice = queries.unionByName(queries.where("query_id = 3"))
    with pytest.raises(ValueError, match="not unique"):
        search.topk_inner(twice, corpus, 3, block_queries=block)


def test_zero_vectors_stay_out_of_inner_searches(spark, data):
    queries, corpus = data[:2]
    odd = spark.createDataFrame([(900, "z", [0.0] * DIM), (901, "z", [float("nan")] * DIM)], SCHEMA)
    found = search.topk_inner(queries, corpus.unionByName(odd), 300)
    assert found.where("row_id >= 900").count() == 0
    assert search.topk_l2(queries, corpus.unionByName(odd), 300).where("row_id = 900").count() == 30


@pytest.mark.parametrize("distinct", [False, True])
def test_no_query_vector_reaches_the_driver(data, monkeypatch, distinct):
    queries, corpus, asked, points, groups = data
    frame = type(queries)
    seen = []

    def watched(name):
        real = getattr(frame, name)

        def call(self, *args, **options):
            seen.append([field.dataType.simpleString() for field in self.schema])
            return real(self, *args, **options)

        return call

    for name in ("collect", "toArrow", "toPandas", "first", "head", "take", "toLocalIterator"):
        monkeypatch.setattr(frame, name, watched(name))
    got = search.topk(queries, corpus, 4, block_queries=7, distinct="patent_id" if distinct else None, carry=("patent_id",))
    plan = got._jdf.queryExecution().toString()
    monkeypatch.undo()
    assert seen and not [kinds for kinds in seen if any("array" in kind for kind in kinds)]
    assert "CartesianProduct" in plan and "BroadcastExchange" not in plan
    assert plan.split("== Physical Plan ==")[1].count("embedding") and found(got) == brute(asked, points, 4, "inner", groups if distinct else None)


def test_queries_beyond_one_scan_are_answered_in_several(data, monkeypatch):
    queries, corpus, asked, points, _ = data
    monkeypatch.setattr(search, "SCAN_VALUES", 40)
    monkeypatch.setattr(search, "CHUNK_ROWS", 16)
    blocks = search.query_table(queries, "query_id", "embedding", 3)
    assert blocks.rdd.getNumPartitions() > 1
    assert found(search.topk(queries, corpus, 5, block_queries=3)) == brute(asked, points, 5, "inner")


def test_the_last_ranking_sees_slices_times_k_rows(spark):
    rows = spark.range(6000).selectExpr(
        "id % 3 AS query_id", "id AS row_id", "concat('g', id % 900) AS patent_id", "id * 7919 % 6007 AS _key", "-double(id) AS score"
    ).repartition(40)
    for distinct in (None, "patent_id"):
        merged = search._merge(rows, "query_id", "row_id", ("patent_id",), 5, distinct)
        want = {}
        for r in sorted(rows.collect(), key=lambda r: (r["_key"], r.row_id)):
            best = want.setdefault(r.query_id, [])
            if len(best) < 5 and (distinct is None or r.patent_id not in {p for _, p in best}):
                best.append((r.row_id, r.patent_id))
        got = {}
        for r in merged.orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.row_id, r.patent_id))
        assert got == want
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "[query_id" in plan and plan.count("WindowGroupLimit") >= 2


def test_unequal_dimensions_are_an_error(spark, data):
    odd = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "query_id long, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="unequal dimension"):
        search.topk(odd, data[1], 3).collect()


def test_many_queries_meet_few_large_parts_of_the_corpus(data, monkeypatch):
    queries, corpus, asked, points, groups = data
    monkeypatch.setattr(search, "SCAN_VALUES", 400)
    monkeypatch.setattr(search, "CHUNK_ROWS", 16)
    monkeypatch.setattr(search, "TASKS_PER_CORE", 1)
    split = corpus.repartition(12)
    blocks, scans = search._query_scans(queries, "query_id", "embedding", 3, None, 5)
    # hits count towards what a task holds: 30 queries x 5 hits alone are 2400 values
    assert scans >= 6 and blocks.rdd.getNumPartitions() == scans
    plan = (queries.schema["query_id"], 5, "inner", "row_id", "embedding", ("patent_id",), "patent_id", scans)
    part = search._scan(split, blocks, *plan)
    parts = part.select("query_id", F.spark_partition_id().alias("p")).distinct().groupBy("query_id").count()
    assert parts.agg(F.max("count")).first()[0] <= 4
    got = search.topk_distinct(queries, split, k=5, block_queries=3)
    assert found(got) == brute(asked, points, 5, "inner", groups)


def _offered(block, points, k, distinct=None):
    import pyarrow as pa

    best = search._Best(block, k, distinct)
    for start in range(0, len(points), 1000):
        rows = pa.table({"row_id": np.arange(start, min(len(points), start + 1000)), "patent_id": [str(i % 300) for i in range(start, min(len(points), start + 1000))]})
        search.offer(best, block, points[start : start + 1000].astype(float), rows, "inner")
    best.settle()
    return best


@pytest.mark.parametrize("distinct", [None, "patent_id"])
def test_few_products_are_taken_in_double(monkeypatch, distinct):
    """Only the first rows, which give the floors, meet all queries in double; the result is that of brute force."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    points, asked = unit(rng, 6000), unit(rng, 300)
    points[3000:3050] = points[:50]
    cells = []
    plain = search.gains
    monkeypatch.setattr(search, "gains", lambda q, r, m: cells.append(len(q) * len(r)) or plain(q, r, m))
    block = search.QueryBlock(pa.array(np.arange(300)), asked.astype(float))
    best = _offered(block, points, 4, distinct)
    assert sum(cells) < len(points) * len(asked) / 4
    groups = [str(i % 300) for i in range(6000)] if distinct else None
    rank = np.arange(len(best.query)) - np.searchsorted(best.query, best.query) + 1
    got = set(zip(best.query.tolist(), rank.tolist(), best.rows["row_id"].to_pylist()))
    assert got == brute(asked.astype(float), points.astype(float), 4, "inner", groups)


@pytest.mark.parametrize("scale", [1.0, 1e-12, 1e12])
def test_the_sift_misses_no_cell(scale):
    """A floor at the very gain of a cell: rounding to single precision must not lose it."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    points, asked = rng.normal(size=(501, 64)) * scale, rng.normal(size=(40, 64))
    block = search.QueryBlock(pa.array(np.arange(40)), asked)
    gain = asked @ points.T
    floor = np.sort(gain, axis=1)[:, -5]
    longest = float(np.sqrt((points**2).sum(1).max()))
    query, row = search.sift(block, slice(0, 40), points.astype(np.float32), longest, floor, 10**9)
    assert set(zip(*np.nonzero(gain >= floor[:, None]))) <= set(zip(query, row))
    assert len(query) < 40 * 10
    assert search.sift(block, slice(0, 40), points.astype(np.float32), longest, floor, 10) is None


def test_set_cells():
    rng = np.random.default_rng(5)
    for shape in [(3, 8), (5, 7), (16, 1024)]:
        mask = rng.random(shape) < 0.1
        assert search.set_cells(mask).tolist() == np.flatnonzero(mask).tolist()
