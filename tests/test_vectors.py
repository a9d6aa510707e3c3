from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimlode.functions import vectors as vc


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(0, [3.0, 4.0], [1.0, 2.0]), (1, [0.0, 0.0], [1.0, 1.0]), (2, None, [1.0, 0.0])]
    return spark.createDataFrame(rows, "i int, a array<float>, b array<float>").orderBy("i")


def test_pair_functions(pairs):
    got = pairs.select(
        vc.inner_product(F.col("a"), F.col("b")).alias("ip"),
        vc.l2_sq(F.col("a"), F.col("b")).alias("l2"),
        vc.cosine(F.col("a"), F.col("b")).alias("cos"),
        vc.vector_dim(F.col("a")).alias("dim"),
    ).collect()
    assert got[0].ip == 11 and got[0].l2 == 8 and got[0].dim == 2
    assert got[0].cos == pytest.approx(11 / 5 / 5**0.5)
    assert got[1].cos is None and got[2].ip is None and got[2].dim is None


def test_normalize(pairs):
    got = [r.u for r in pairs.select(vc.l2_normalize(F.col("a")).alias("u")).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1:] == [None, None]


def test_require_dim(pairs):
    assert pairs.select(vc.require_dim(F.col("a"), 2)).count() == 3
    with pytest.raises(Exception, match="expected dimension 3, found 2"):
        pairs.select(vc.require_dim(F.col("a"), 3)).collect()


def test_vector_literals(spark):
    rows = spark.createDataFrame([("TEST-1", "[0.1,0.2,0.3]"), ("TEST-2", "[0.4,0.5,0.6]")], "id string, v string")
    parsed = rows.withColumn("v", vc.parse_vector(F.col("v")))
    assert parsed.collect()[0].v == pytest.approx([0.1, 0.2, 0.3])
    again = parsed.select(vc.parse_vector(vc.format_vector(F.col("v"))).alias("w"), "v").collect()
    assert all(r.w == r.v for r in again)


def test_score_against(pairs):
    cosine = vc.score_against(np.array([1.0, 2.0]), vc.COSINE)
    far = vc.score_against(np.array([1.0, 2.0]), vc.L2)
    got = pairs.select(cosine("a").alias("c"), far("a").alias("d")).collect()
    assert got[0].c == pytest.approx(11 / 5 / 5**0.5) and got[1].c is None and got[2].c is None
    assert [r.d for r in got] == [pytest.approx(8.0), pytest.approx(5.0), None]


def test_rank_keys_round_half_away_from_zero():
    assert vc.rank_keys(np.array([1 / 128, -1 / 128, 0.25])).tolist() == [-7813, 7813, -250000]


def test_dense_rejects_unequal_lengths():
    with pytest.raises(ValueError, match="unequal"):
        vc.dense(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0], [1.0]]))
    present, matrix = vc.dense(pa.array([None, [1.0, 2.0], None, [3.0, 4.0]]))
    assert present.tolist() == [1, 3] and matrix.tolist() == [[1, 2], [3, 4]]
