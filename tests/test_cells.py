from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlode.operators import cells, search

DIM = 4


@pytest.fixture(scope="module")
def data(spark):
    """A third of all rows lies in one tight cluster."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, DIM))
    points[::3] = [5.0, 0, 0, 0] + 0.01 * rng.normal(size=(100, DIM))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = [(i, f"p{i // 5}", [float(x) for x in v]) for i, v in enumerate(points)]
    corpus = spark.createDataFrame(rows, "row_id long, patent_id string, embedding array<float>")
    corpus = corpus.repartition(4, "row_id")
    queries = corpus.select(F.col("row_id").alias("query_id"), "embedding")
    return queries, corpus


@pytest.fixture(scope="module")
def trained(data):
    return cells.train_cells(data[1], nlist=6)


def rows(df):
    return {(r.query_id, r["rank"], r.row_id) for r in df.collect()}


def test_training_is_repeatable(data, trained):
    again = cells.train_cells(data[1].repartition(3), nlist=6)
    assert again.orderBy("cell").collect() == trained.orderBy("cell").collect()
    assert trained.count() == 6


@pytest.mark.parametrize("metric", ["inner", "l2"])
@pytest.mark.parametrize("block_queries", [10_000, 300])
def test_all_cells_probed_equals_exact_search(data, trained, metric, block_queries):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained, metric)
    got = cells.search_cells(
        queries, assigned, trained, 5, nprobe=6, metric=metric, block_queries=block_queries
    )
    assert rows(got) == rows(search.topk(queries, corpus, 5, metric))


@pytest.mark.parametrize("block_queries", [10_000, 100])
def test_one_probe_is_exact_inside_the_cell(data, trained, block_queries):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    got = cells.search_cells(queries, assigned, trained, 3, block_queries=block_queries)
    home = assigned.select(F.col("row_id").alias("query_id"), F.col("cell").alias("own"))
    hits = got.join(assigned.select("row_id", "cell"), "row_id").join(home, "query_id")
    assert hits.where("cell <> own").isEmpty()
    assert hits.where("rank = 1").count() == 300


def test_recall_is_reported(data, trained):
    queries, corpus = data
    exact = rows(search.topk(queries, corpus, 5))
    assigned = cells.assign_cells(corpus, trained)
    close = rows(cells.search_cells(queries, assigned, trained, 5, nprobe=2))
    recall = len({(q, r) for q, _, r in close} & {(q, r) for q, _, r in exact}) / len(exact)
    print(f"recall with 2 of 6 cells: {recall:.3f}")
    assert 0 < recall <= 1


def test_ties_go_to_the_lowest_cell(spark, data):
    equal = spark.createDataFrame(
        [(4, [1.0, 0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])], "cell int, centroid array<double>"
    )
    assigned = cells.assign_cells(data[1], equal)
    assert [r.cell for r in assigned.select("cell").distinct().collect()] == [2]


def test_centroid_blocks_change_nothing(data, trained):
    queries, _ = data
    whole = cells.nearest_cells(queries, trained, 3, "inner").select("query_id", "cells")
    parts = cells.nearest_cells(queries, trained, 3, "inner", block_centroids=2)
    assert sorted(parts.select("query_id", "cells").collect()) == sorted(whole.collect())


def test_layout_cuts_hot_cells_and_prunes(spark, data, trained, tmp_path):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    path = str(tmp_path / "cells")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "100")
    cells.write_cells(assigned, path)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    stored = spark.read.parquet(path)
    assert stored.count() == 300
    files = stored.withColumn("file", F.input_file_name()).groupBy("cell").agg(
        F.count_distinct("file").alias("files"), F.count("*").alias("rows")
    )
    hot = files.orderBy(F.desc("rows")).first()
    assert hot.rows >= 100 and hot.files > 1
    one = queries.where("query_id = 0")
    plan = cells.search_cells(one, stored, trained, 3)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    assert rows(cells.search_cells(queries, stored, trained, 3)) == rows(
        cells.search_cells(queries, assigned, trained, 3)
    )


def test_probe_join_keeps_probed_cells(data, trained):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    probes = cells.nearest_cells(queries.where("query_id < 3"), trained, 2, "inner")
    wanted = {c for r in probes.collect() for c in r.cells}
    kept = cells.probe_join(probes.select(F.explode("cells").alias("cell")), assigned)
    assert {r.cell for r in kept.collect()} == wanted
    assert kept.count() == assigned.where(F.col("cell").isin(wanted)).count()


def test_probe_join_prunes_folders_at_run_time(spark, data, trained, tmp_path):
    queries, corpus = data
    path = str(tmp_path / "cells")
    cells.write_cells(cells.assign_cells(corpus, trained), path)
    probes = spark.createDataFrame([(0, 1), (1, 1)], "query_id int, cell int").where("query_id < 5")
    kept = cells.probe_join(probes, spark.read.parquet(path))
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()
    assert {r.cell for r in kept.collect()} == {1}


def test_cell_means(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 3.0]), (0, [3.0, 5.0]), (1, [7.0, 7.0]), (1, None)], "cell int, embedding array<float>"
    )
    got = {r.cell: r.centroid for r in cells.cell_centroids(df).collect()}
    assert got == {0: [2.0, 4.0], 1: [7.0, 7.0]}


def test_training_leaves_out_vectors_without_direction(spark, data):
    odd = [(900, "z", [0.0] * DIM), (901, "z", None), (902, "z", [float("nan")] * DIM), (903, "z", [float("inf")] * DIM)]
    more = data[1].unionByName(spark.createDataFrame(odd, data[1].schema))
    found = cells.train_cells(more, nlist=6)
    assert found.count() == 6
    assert all(np.isfinite(r.centroid).all() for r in found.collect())


def test_hot_cells_are_cut_on_both_sides(data, trained, monkeypatch):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    whole = rows(cells.search_cells(queries, assigned, trained, 4, nprobe=2))
    monkeypatch.setattr(cells, "CELL_ROWS", 20)
    assert rows(cells.search_cells(queries, assigned, trained, 4, nprobe=2, block_queries=30)) == whole


def test_repeated_query_id_is_an_error(data, trained):
    queries, corpus = data
    with pytest.raises(ValueError, match="not unique"):
        cells.search_cells(queries.union(queries.limit(1)), corpus.withColumn("cell", F.lit(0)), trained, 2)


def test_further_cells_until_enough_groups(data, trained):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained).withColumn("family", F.col("cell") * 2 + F.col("row_id") % 2)
    some = queries.where("query_id % 20 = 0")
    for k in (1, 2, 5, 11):
        got = cells.search_cells_until(some, assigned, trained, "family", k)
        counts = got.groupBy("query_id").agg(F.count("*").alias("n"), F.count_distinct("family").alias("d"), F.max("probed").alias("p"))
        told = counts.collect()
        assert len(told) == 15 and all(r.n == r.d == k for r in told)
        # each cell holds two families, and the cells read double
        assert max(r.p for r in told) <= {1: 1, 2: 2, 5: 4, 11: 6}[k]
    short = cells.search_cells_until(some, assigned, trained, "family", 40)
    families = assigned.select("family").distinct().count()
    assert short.count() == 15 * families and short.where("probed <> 6").isEmpty()


def test_all_cells_at_first_is_the_exact_distinct_search(data, trained):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    got = cells.search_cells_until(queries, assigned, trained, "patent_id", 7, nprobe=6)
    assert rows(got) == rows(search.topk_distinct(queries, corpus, "patent_id", 7))


@pytest.mark.parametrize("metric", ["inner", "l2"])
def test_tree_agrees_with_the_flat_assignment(spark, metric):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 12))
    points = centres[rng.integers(0, 30, 3000)] + 0.25 * rng.normal(size=(3000, 12))
    corpus = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "row_id long, embedding array<float>")
    centroids = cells.train_cells(corpus, nlist=144, metric=metric, iterations=5)
    tree = cells.cell_tree(centroids, corpus, metric)
    flat = cells.assign_cells(corpus, centroids, metric).select("row_id", F.col("cell").alias("flat"))
    quick = cells.assign_cells_by_tree(corpus, tree, metric).join(flat, "row_id")
    told = quick.agg(F.avg((F.col("cell") == F.col("flat")).cast("int")).alias("same"), F.avg("compared").alias("compared")).first()
    assert told.same >= 0.99
    assert len(tree.coarse) == 12 and told.compared < 0.75 * 144
    whole = cells.assign_cells_by_tree(corpus, tree, metric, looks=12).join(flat, "row_id")
    assert whole.where("cell <> flat").isEmpty()
    print(f"{metric}: {tree.looks} of 12 coarse cells, {told.compared:.0f} of 144 comparisons, agreement {told.same:.4f}")


def test_tree_leaves_out_null_vectors_and_marks_odd_ones(spark, data, trained):
    tree = cells.cell_tree(trained, data[1])
    odd = spark.createDataFrame([(1, None), (2, [float("nan")] * DIM), (3, [1.0] * DIM)], "row_id long, embedding array<float>")
    got = {r.row_id: r.cell for r in cells.assign_cells_by_tree(odd, tree).collect()}
    assert set(got) == {2, 3} and got[2] is None and got[3] is not None
    with pytest.raises(ValueError, match="no centroids"):
        cells.cell_tree(trained.where("false"), data[1])


def test_blocks_of_probes_share_one_part_of_a_cell(data, trained, monkeypatch):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    whole = rows(cells.search_cells(queries, assigned, trained, 4, nprobe=2))
    real, limits = cells.grid_cut, []
    monkeypatch.setattr(cells, "grid_cut", lambda *given: limits.append(given[-1]) or real(*given))
    monkeypatch.setattr(cells, "CHUNK_ROWS", 16)
    assert rows(cells.search_cells(queries, assigned, trained, 4, nprobe=2, block_queries=7)) == whole
    assert limits == [7 * cells.CELL_BLOCKS]


@pytest.mark.parametrize("scan_values", [1 << 21, 6_000])
def test_many_probes_are_scanned_and_not_dealt_out(data, trained, monkeypatch, scan_values):
    queries, corpus = data
    assigned = cells.assign_cells(corpus, trained)
    dealt = {n: rows(cells.search_cells(queries, assigned, trained, 4, nprobe=n)) for n in (1, 3, 6)}
    monkeypatch.setattr(cells, "grid_cut", None)
    monkeypatch.setattr(cells, "DENSE_PROBES", 10)
    monkeypatch.setattr(cells, "DENSE", 0)
    monkeypatch.setattr(search, "SCAN_VALUES", scan_values)
    for n, want in dealt.items():
        assert rows(cells.search_cells(queries, assigned, trained, 4, nprobe=n, block_queries=70)) == want
    exact = rows(search.topk_distinct(queries, corpus, "patent_id", 7))
    assert rows(cells.search_cells_until(queries, assigned, trained, "patent_id", 7, nprobe=6)) == exact
    # there are 60 patents, so all cells are read in the end
    every = cells.search_cells_until(queries, assigned, trained, "patent_id", 61, nprobe=1)
    assert rows(every) == rows(search.topk_distinct(queries, corpus, "patent_id", 61))


def test_dense_probes_are_many_and_cover_many_pairs(spark, monkeypatch):
    held = spark.createDataFrame([(0,)] * 90 + [(1,)] * 9 + [(2,)], "cell int")
    near = lambda *probed: spark.createDataFrame([(i, list(probed)) for i in range(20)], "query_id long, cells array<int>")
    assert cells._dense(near(0), held) == (False, 0)
    monkeypatch.setattr(cells, "DENSE_PROBES", 10)
    assert cells._dense(near(0), held) == (True, 1)
    assert not cells._dense(near(1, 2), held)[0]
    assert cells._dense(near(0, 1, 2), held) == (True, 3)
    assert not cells._dense(near(0).where("false"), held)[0]


def test_cells_of_claims_hold_no_text(spark, monkeypatch):
    from claimlode.catalog.register import REGISTER

    real, columns = cells.write_cells, []
    monkeypatch.setattr(cells, "write_cells", lambda assigned, path: columns.append(assigned.columns) or real(assigned, path))
    for name in ("self_retrieval_cells", "external_overlap_cells", "search_text_cells"):
        assert REGISTER[name](spark, "/root/testdata/sf0.001").columns
    assert columns == [["row_id", "patent_id", "embedding", "cell"]] * 3
