from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlode.operators import audit
from claimlode.sources import batch_files, tables

CLAIMS = [("7311042", 'quoted "text", with comma'), ("D655501", "two\nlines"), ("007", "plain | bar")]


def test_read_claims_from_parquet(spark, tmp_path):
    path = str(tmp_path / "claims")
    spark.createDataFrame([("1", "a", 5)], "patent_id string, claim_text string, other int").write.parquet(path)
    assert tables.read_claims(spark, path).collect() == [("1", "a")]


def test_csv_keeps_ids_as_text_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_result_csv(spark.createDataFrame(CLAIMS, "patent_id string, claim string"), path)
    back = tables.read_metadata_csv(spark, path, ["patent_id", "claim"])
    assert sorted(map(tuple, back.collect())) == sorted(CLAIMS)
    only = tables.read_metadata_csv(spark, path, ["patent_id", "claim"], ["patent_id"])
    assert only.columns == ["patent_id"]


def test_latin1_list(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_bytes("Publication Number,Title\nUS7311042B2,Präzision\n,leer\n".encode("latin-1"))
    header = ["Publication Number", "Title"]
    got = tables.read_metadata_csv(spark, str(path), header, encoding="ISO-8859-1").collect()
    assert got == [("US7311042B2", "Präzision"), (None, "leer")]


def test_check_table_headers_and_packing(spark, tmp_path):
    check = tables.values_table(
        spark, [("c", "1", ["1", "2"], "Y")], "claim string, patent_id string, top_patents array<string>, found_itself string"
    )
    path = tmp_path / "check"
    tables.write_result_csv(check, str(path), tables.check_headers("outside"))
    files = [part.read_text().splitlines() for part in path.glob("*.csv")]
    assert max(files, key=len) == ["claim,patent_id,top 10 retrieved patents,found itself (Y/N)", "c,1,1 | 2,Y"]
    assert tables.check_headers("x")["external_patents"] == "top 100 retrieved x patents"


def batch_dir(tmp_path):
    """Batches 0 and 10 fit, 2 lacks vectors, 3 lacks text, 5 has one vector too few."""
    rng = np.random.default_rng(0)
    sizes = {0: (4, 4), 2: (3, None), 3: (None, 3), 5: (5, 4), 10: (6, 6)}
    for number, (texts, points) in sizes.items():
        if texts is not None:
            rows = "".join(f'"{number}-{i}","claim\n{i}",x\n' for i in range(texts))
            (tmp_path / f"metadata_batch_{number}.csv").write_text("patent_id,cleaned_claim,more\n" + rows)
        if points is not None:
            matrix = rng.normal(size=(points, 3)) + 100 * number
            np.save(tmp_path / f"embeddings_batch_{number}.npy", matrix.astype(np.float64))
    return str(tmp_path)


def test_import_pairs_files_by_number(spark, tmp_path):
    path = batch_dir(tmp_path)
    meta = batch_files.read_metadata_batches(spark, path)
    vectors = batch_files.read_vector_batches(spark, path)
    status = {r.batch_id: r.status for r in audit.pair_batches(meta, vectors).collect()}
    assert status == {0: "ok", 2: "missing", 3: "missing", 5: "mismatch", 10: "ok"}
    rows = audit.zip_rows(meta, vectors).collect()
    assert len(rows) == 10
    for row in rows:
        matrix = np.load(tmp_path / f"embeddings_batch_{row.batch_id}.npy").astype(np.float32)
        assert row.patent_id == f"{row.batch_id}-{row.pos}" and row.cleaned_claim == f"claim\n{row.pos}"
        assert row.embedding == matrix[row.pos].tolist()


def test_reading_in_small_parts_keeps_positions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batch_files, "READ_ROWS", 2)
    path = batch_dir(tmp_path)
    for rows in (batch_files.read_metadata_batches(spark, path), batch_files.read_vector_batches(spark, path)):
        places = rows.where("batch_id = 10").select("pos").collect()
        assert sorted(r.pos for r in places) == list(range(6))


def test_writing_a_batch_again_replaces_only_it(spark, tmp_path):
    path = str(tmp_path / "batches")
    rows = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("batch_id"))
    batch_files.write_batches(rows, path)
    batch_files.write_batches(rows.where("batch_id = 1 and id < 10"), path)
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    assert counts == {0: 10, 1: 3, 2: 10}


def test_vector_table_append_and_dimension(spark, tmp_path):
    rows = spark.createDataFrame(
        [("P-77", "a lid", [0.5, -1.5, 2.0])], "patent_id string, cleaned_claim string, embedding array<float>"
    )
    for _ in range(2):
        tables.create_vector_table(spark, "claim_vectors", str(tmp_path / "table"))
    tables.append_vectors(rows, "claim_vectors", 3)
    tables.append_vectors(rows, "claim_vectors", 3)
    assert spark.table("claim_vectors").count() == 2
    path = str(tmp_path / "plain")
    tables.append_vectors(rows, path, 3)
    assert spark.read.parquet(path).first().embedding == pytest.approx([0.5, -1.5, 2.0])
    with pytest.raises(Exception, match="expected dimension 4, found 3"):
        tables.append_vectors(rows, path, 4)
    spark.sql("DROP TABLE claim_vectors")


def test_audit_verdicts(spark):
    def verdict(rows, before, after):
        manifest = spark.createDataFrame(rows, "batch_id int, manifest_rows long, written_rows long")
        return tuple(audit.load_audit(manifest, before, after).select("delta", "verdict").first())

    assert verdict([(0, 5, 5), (1, 4, 4)], 10, 19) == (9, "OK")
    assert verdict([(0, 5, 5), (1, 4, 0)], 10, 15) == (5, "NOTE")
    assert verdict([(0, 5, 5)], 10, 14) == (4, "WARNING")
    assert verdict([], 3, 3) == (0, "OK")


def test_union_and_counts(spark):
    a = spark.createDataFrame([(1, "a")], "i int, t string")
    b = spark.createDataFrame([("b", 2)], "t string, i int")
    joined = audit.union_batches(a, b)
    assert sorted(map(tuple, joined.collect())) == [(1, "a"), (2, "b")]
    assert audit.row_count(joined).first().rows == 2


@pytest.mark.parametrize("slice_bytes", [64 << 20, 1000, 37])
def test_vector_files_larger_than_a_slice(spark, tmp_path, slice_bytes):
    rng = np.random.default_rng(1)
    folder = tmp_path / "some folder %41"
    folder.mkdir()
    matrices = {
        1: rng.normal(size=(301, 5)).astype(np.float32),
        2: rng.normal(size=(40, 5)),
        3: np.asfortranarray(rng.normal(size=(40, 5))),
        4: np.zeros((0, 5), np.float32),
        7: rng.integers(0, 9, size=(3, 5)),
    }
    for number, matrix in matrices.items():
        np.save(folder / f"embeddings_batch_{number}.npy", matrix)
    rows = batch_files.read_vector_batches(spark, str(folder), slice_bytes=slice_bytes)
    got = {}
    for r in rows.orderBy("batch_id", "pos").collect():
        got.setdefault(r.batch_id, []).append(r.embedding)
        assert r.pos == len(got[r.batch_id]) - 1
    assert set(got) == {1, 2, 3, 7}
    for number, values in got.items():
        assert np.array_equal(np.array(values, np.float32), matrices[number].astype(np.float32))
    if slice_bytes == 1000:
        spread = rows.where("batch_id = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert spread > 1


def test_not_a_matrix_and_stores_that_only_spark_reads(spark, tmp_path, monkeypatch):
    np.save(tmp_path / "b_1.npy", np.zeros(4))
    with pytest.raises(Exception, match="not a dense matrix"):
        batch_files.read_vector_batches(spark, str(tmp_path)).collect()
    assert not batch_files.ranged_access("viewfs://store/x") and batch_files.ranged_access("file:/tmp/a b")
    (tmp_path / "more").mkdir()
    path = batch_dir(tmp_path / "more")
    monkeypatch.setattr(batch_files, "ranged_access", lambda name: False)
    assert batch_files.read_vector_batches(spark, path, "embeddings*.npy").count() == 17


def test_older_layout_round_trip(spark, tmp_path):
    meta = spark.createDataFrame(
        [(b, i, f"p{i}", [f'a "quoted", text\n{i}', "", "007"][i % 3]) for b in (0, 4) for i in range(7)],
        "batch_id int, pos long, patent_id string, cleaned_claim string",
    )
    vectors = meta.selectExpr("batch_id", "pos", "array(float(pos), float(batch_id), float(0.5)) AS embedding")
    path = str(tmp_path / "files")
    for _ in range(2):
        batch_files.write_batch_files(meta, vectors, path)
    back = audit.zip_rows(batch_files.read_metadata_batches(spark, path), batch_files.read_vector_batches(spark, path))
    want = meta.join(vectors, ["batch_id", "pos"])
    assert sorted(map(str, back.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("group", [1, 3, 32])
def test_a_load_counts_each_batch_while_it_writes(spark, tmp_path, group):
    meta = spark.createDataFrame([(b, i, f"p{b}", "t") for b in range(6) for i in range(3 + b)], "batch_id int, pos long, patent_id string, cleaned_claim string")
    sizes = {0: 3, 1: 4, 2: 5, 4: 2, 5: 8}  # 3 has no vectors, 4 too few; those of 2 have another dimension
    vectors = spark.createDataFrame(
        [(b, i, [0.5] * (3 if b == 2 else 2)) for b, n in sizes.items() for i in range(n)], "batch_id int, pos long, embedding array<float>"
    )
    path, calls = str(tmp_path / "target"), []

    def write(rows):
        calls.append(1)
        tables.append_vectors(rows, path, 2)

    got = {r.batch_id: tuple(r)[1:] for r in audit.load_batches(meta, vectors, write, group=group).collect()}
    assert got == {0: ("ok", 3, 3), 1: ("ok", 4, 4), 2: ("failed", 5, 0), 3: ("missing", 6, 0), 4: ("mismatch", 7, 0), 5: ("ok", 8, 8)}
    assert spark.read.parquet(path).count() == 15
    manifest = audit.load_batches(meta.where("batch_id < 2"), vectors, write, group=group)
    assert manifest.where("status = 'missing'").count() == 3 and spark.read.parquet(path).count() == 22


def test_a_load_takes_few_writes_however_many_batches(spark, tmp_path):
    meta = spark.range(200).selectExpr("int(id div 2) AS batch_id", "id % 2 AS pos", "string(id) AS patent_id", "'t' AS cleaned_claim")
    vectors = spark.range(200).selectExpr("int(id div 2) AS batch_id", "id % 2 AS pos", "array(float(id)) AS embedding")
    path, calls = str(tmp_path / "target"), []

    def write(rows):
        calls.append(1)
        tables.append_vectors(rows, path, 1)

    got = audit.load_batches(meta, vectors, write, group=4)
    assert len(calls) == 1 and got.where("status = 'ok' AND written_rows = 2").count() == 100
    assert spark.read.parquet(path).count() == 200
    odd = vectors.withColumn("embedding", F.when(F.col("batch_id") == 70, F.array()).otherwise(F.col("embedding")).cast("array<float>"))
    again = audit.load_batches(meta, odd, write, group=4)
    assert len(calls) < 18 and [r.batch_id for r in again.where("status = 'failed'").collect()] == [70]
    assert again.where("written_rows = 2").count() == 99 and spark.read.parquet(path).count() == 398
    half = lambda rows: write(rows.limit(50))
    with pytest.raises(RuntimeError, match="50 rows of the batches 0 to 99"):
        audit.load_batches(meta, vectors, half, group=4)


def test_small_slices_share_tasks(spark, tmp_path, monkeypatch):
    matrix = np.arange(4000, dtype=np.float32).reshape(1000, 4)
    for number in range(3):
        np.save(tmp_path / f"b_{number}.npy", matrix + number)
    monkeypatch.setattr(batch_files, "TASK_SLICES", 50)
    rows = batch_files.read_vector_batches(spark, str(tmp_path), slice_bytes=64)
    # 753 slices of 64 bytes
    assert rows.rdd.getNumPartitions() == 16
    assert rows.count() == 3000 and rows.where("embedding[0] = pos * 4 + batch_id").count() == 3000
