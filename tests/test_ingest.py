from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from claimlode.catalog import views
from claimlode.streaming.ingest import ingest_incremental

SCHEMA = "row_id long, patent_id string, claim_text string"


def add_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_each_file_is_taken_once(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        ingest_incremental(
            spark, source, target, state, SCHEMA, views.encode, files_per_trigger=1, first_batch=7,
            spread_by="row_id",
        )
        return spark.read.parquet(target)

    add_file(spark, source, [(0, "p0", "<b>1.</b> A first claim"), (1, "p0", None)])
    add_file(spark, source, [(2, "p1", "A second claim")])
    done = run()
    assert sorted(r.row_id for r in done.collect()) == [0, 1, 2]
    assert sorted(r.batch_id for r in done.select("batch_id").distinct().collect()) == [7, 8]
    assert done.where("row_id = 0").first().cleaned_claim == "1. A first claim"
    assert run().count() == 3
    add_file(spark, source, [(3, "p2", "A third claim")])
    again = run()
    assert sorted(r.row_id for r in again.collect()) == [0, 1, 2, 3]
    assert again.where(F.col("row_id") == 3).first().batch_id == 9


def test_a_failed_micro_batch_is_replayed(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    calls = []

    def fails_second(claims, text):
        calls.append(text)
        if len(calls) == 2:
            raise RuntimeError("the encoder is gone")
        return views.encode(claims, text)

    def run(encoder):
        ingest_incremental(spark, source, target, state, SCHEMA, encoder, files_per_trigger=1)

    add_file(spark, source, [(0, "p0", "A first claim")])
    add_file(spark, source, [(1, "p1", "A second claim")])
    with pytest.raises(StreamingQueryException, match="the encoder is gone"):
        run(fails_second)
    assert len(calls) == 2 and spark.read.parquet(target).count() == 1
    add_file(spark, source, [(2, "p2", "A third claim")])
    run(views.encode)
    rows = spark.read.parquet(target).collect()
    assert sorted(r.row_id for r in rows) == [0, 1, 2] and len({r.batch_id for r in rows}) == 3


def test_an_arrival_has_the_splits_of_its_table(spark, tmp_path):
    from pathlib import Path

    from claimlode.catalog.register import REGISTER
    from claimlode.session import shared_dir

    docs = spark.range(60).selectExpr("id AS doc_id", "concat('a claim ', id) AS text")
    docs.repartition(4).write.option("maxRecordsPerFile", 15).parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", 64 << 20)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("arrivals-*"))
    try:
        rows = REGISTER["ingest_incremental"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r.row_id for r in rows.select("row_id").collect()) == list(range(60))
    (arrivals,) = set(folder.glob("arrivals-*")) - before
    assert len(list(arrivals.glob("part-*"))) > 3
