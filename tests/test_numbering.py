from __future__ import annotations

import pytest

from claimlode.operators import numbering


@pytest.fixture(scope="module")
def claims(spark):
    # One patent holds a third of all rows; order within it is settled by claim_no.
    rows = [("p0" if i % 3 == 0 else f"p{i % 7}", i, f"text {i}") for i in range(300)]
    return spark.createDataFrame(rows, "patent_id string, claim_no int, claim_text string")


ORDER = ["patent_id", "claim_no"]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_positions_are_contiguous_and_ordered(claims, partitions):
    got = numbering.number_rows(claims, ORDER, ["claim_no"], partitions=partitions).collect()
    expected = sorted(claims.collect(), key=lambda r: (r.patent_id, r.claim_no))
    by_position = {r.position: (r.patent_id, r.claim_no, r.claim_text) for r in got}
    assert by_position == {i: tuple(r) for i, r in enumerate(expected)}


def test_descending_and_ties(spark):
    rows = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.5)], "row_id int, score double")
    got = numbering.sort_desc(rows, "score", "row_id", numbered=True).collect()
    assert {r.row_id: r.position for r in got} == {2: 0, 1: 1, 3: 2}
    assert [r.row_id for r in numbering.head(rows, "score", "row_id", 2).collect()] == [2, 1]


def test_batches_resume_where_a_run_stopped(claims):
    whole = numbering.assign_batches(claims, ORDER, ["claim_no"], size=64).collect()
    later = numbering.assign_batches(
        claims, ORDER, ["claim_no"], size=64, start_offset=128, first_batch=2
    ).collect()
    want = {r.claim_no: r.batch_id for r in whole if r.position >= 128}
    assert {r.claim_no: r.batch_id for r in later} == want
    assert sorted(set(want.values())) == [2, 3, 4]


def test_page_has_one_rule_at_any_depth(claims):
    want = sorted(map(tuple, claims.orderBy(*ORDER).offset(100).limit(50).collect()))
    found = numbering.page(claims, ORDER, ["claim_no"], 100, 50).collect()
    assert sorted(map(tuple, found)) == want and len(want) == 50
    for offset in (0, 20_000):
        with pytest.raises(ValueError, match="not unique"):
            numbering.page(claims, ORDER, ["patent_id"], offset, 50)
    assert numbering.page(claims, ORDER, ["claim_no"], 400, 50).count() == 0


def test_empty_table_and_repeated_key(spark, claims):
    empty = numbering.number_rows(claims.where("false"), ORDER, ["claim_no"])
    assert empty.count() == 0
    with pytest.raises(ValueError, match="not unique"):
        numbering.number_rows(claims, ORDER, ["patent_id"])


def test_split_work(claims):
    assert numbering.split_work(claims, 12).rdd.getNumPartitions() == 12
    assert numbering.split_narrow(claims.coalesce(1), "claim_no", 5).rdd.getNumPartitions() == 5
    assert numbering.split_narrow(claims.repartition(9), "claim_no", 5).rdd.getNumPartitions() == 9


def test_a_page_reads_the_ranges_it_lies_in(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 10 AS bucket", "concat('t', id) AS text")
    index = numbering.write_page_index(rows, ["bucket", "id"], ["id"], str(tmp_path / "index"), partitions=8)
    want = sorted(((r.bucket, r.id, r.text) for r in rows.collect()))
    assert index.rows == 1000 and len(index.starts) >= 4
    for offset, size in ((0, 10), (495, 20), (990, 50), (0, 1000), (250, 1)):
        got = numbering.read_page(spark, index, offset, size)
        assert sorted((r.bucket, r.id, r.text) for r in got.collect()) == want[offset : offset + size]
        files = {f for f in got.inputFiles()}
        if size <= 50:
            assert len(index.parts_of(offset, size)) <= 2
            metrics = spark.read.schema(index.schema).parquet(index.path).where(
                f"_part in ({','.join(map(str, index.parts_of(offset, size)))})"
            )
            assert metrics.select("_metadata.file_path").distinct().count() <= 2 and files
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters" in plan and "_part" in plan.split("PartitionFilters")[1][:40]
    assert numbering.read_page(spark, index, 1000, 5).isEmpty() and numbering.read_page(spark, index, -5, 5).isEmpty()


def test_page_index_of_nothing_and_of_repeated_keys(spark, tmp_path):
    rows = spark.range(5).selectExpr("id", "1 AS bucket")
    empty = numbering.write_page_index(rows.where("id > 9"), ["bucket", "id"], ["id"], str(tmp_path / "empty"))
    assert empty.rows == 0 and numbering.read_page(spark, empty, 0, 5).isEmpty()
    with pytest.raises(ValueError, match="not unique"):
        numbering.write_page_index(rows.union(rows), ["bucket", "id"], ["id"], str(tmp_path / "twice"))
