"""Recall of the adaptive scan as shipped, on vectors that do not cluster and on vectors that do."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from claimlode.llm import neighbours


def recall(spark, ids, x, every):
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    got = neighbours.nearest(frame, frame.where(f"vec_id % {every} = 0"), k=10).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    x, hits, wanted = x.astype(np.float64), 0, 0
    for q in np.flatnonzero(ids % every == 0):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = {int(ids[i]) for i in np.lexsort((ids, distance)) if i != q and distance[i] <= np.sort(distance)[10]}
        hits += len(found[int(ids[q])] & best)
        wanted += 10
    return hits / wanted


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_on_made_vectors(spark, clusters):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 64))
    if clusters:
        x = 3 * rng.normal(size=(clusters, 64))[rng.integers(0, clusters, 3000)] + x
    assert recall(spark, np.arange(3000), x.astype(np.float32), 50) >= 0.95


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_tables(spark, size):
    path = f"/root/testdata/{size}/embeddings.parquet"
    if not Path(path).exists():
        pytest.skip("test tables absent")
    rows = spark.read.parquet(path).select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32)
    assert recall(spark, ids, x, 100) >= 0.95
