"""Pivot-permutation links against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from claimlode.llm import pivots

ROWS = "vec_id long, embedding array<float>, label int, node long, k1 long, pivots int, group_ string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, "x") for i, v, label in rows], ROWS)


def planted(seed=4, clusters=60, d=64):
    """Vectors around a few hundred directions: partners at cosines from 0.90 to 1, copies, and loners."""
    rng = np.random.default_rng(seed)
    out = []
    for c in range(clusters):
        centre = rng.normal(size=d)
        centre /= np.linalg.norm(centre)
        label = int(c % 3)
        for _ in range(int(rng.integers(1, 9))):
            aside = rng.normal(size=d)
            aside -= aside @ centre * centre
            aside /= np.linalg.norm(aside)
            near = rng.uniform(0.9, 1.0)
            out.append(((near * centre + np.sqrt(1 - near * near) * aside) * rng.uniform(0.1, 9), label))
    loners = rng.normal(size=(200, d))
    out += [(v, int(i % 3)) for i, v in enumerate(loners)]
    out += [(out[0][0], out[0][1]), (out[0][0] * 2, out[0][1]), (out[0][0], (out[0][1] + 1) % 3)]
    ids = rng.permutation(len(out)) * 3
    return [(int(i), [float(x) for x in np.float32(v)], label) for i, (v, label) in zip(ids, out, strict=True)]


def all_pairs(rows, threshold=0.93):
    x = np.array([v for _, v, _ in rows])
    x /= np.sqrt((x * x).sum(1))[:, None]
    labels = np.array([label for _, _, label in rows])
    near = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    return near


def components(ids, near):
    low = np.array(ids)
    while True:
        new = np.minimum(low, np.where(near, low[None, :], low.max()).min(1))
        if (new == low).all():
            return low
        low = new


@pytest.mark.parametrize("chunk", [2048, 5])
def test_links_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(pivots, "CHUNK", chunk)
    monkeypatch.setattr(pivots, "VERIFIED", 7 if chunk == 5 else 65_536)
    rows = planted()
    near = all_pairs(rows)
    got = {r.vec_id: r for r in pivots.near_copies(frame(spark, rows)).collect()}
    ids = [i for i, _, _ in rows]
    found = np.array([got[i].n_links for i in ids])
    assert (found <= near.sum(1)).all()  # no link below the threshold
    assert found.sum() >= 0.97 * near.sum()
    same = np.array([got[i].component_id for i in ids]) == components(ids, near)
    assert same.mean() > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_two_chunk_sizes_count_the_same_pairs(spark, monkeypatch):
    rows = planted(seed=8)
    whole = sorted(pivots.near_copies(frame(spark, rows)).collect())
    monkeypatch.setattr(pivots, "CHUNK", 3)
    assert sorted(pivots.near_copies(frame(spark, rows)).collect()) == whole


def test_recall_at_the_threshold_itself():
    rng = np.random.default_rng(0)
    points = pivots.unit_rows(rng.normal(size=(128, 64)))
    trials = pivots.unit_rows(rng.normal(size=(400, 64)))
    least, looks = pivots.calibrated(trials, points, 0.93)
    fresh = pivots.unit_rows(rng.normal(size=(2000, 64)))
    aside = rng.normal(size=fresh.shape)
    aside -= (aside * fresh).sum(1)[:, None] * fresh
    other = 0.93 * fresh + np.sqrt(1 - 0.93**2) * pivots.unit_rows(aside)
    a, b = pivots.described(fresh, points), pivots.described(other, points)
    meet = (a[:, :1] == b[:, :looks]).any(1) | (b[:, :1] == a[:, :looks]).any(1)
    enough = (a[:, :, None] == b[:, None, :]).sum((1, 2)) >= least
    assert (meet & enough).mean() >= 0.96
    strangers = pivots.described(pivots.unit_rows(rng.normal(size=(2000, 64))), points)
    assert ((a[:, :, None] == strangers[:, None, :]).sum((1, 2)) >= least).mean() < 0.02


def test_shared_counts_are_set_intersections():
    rng = np.random.default_rng(5)
    a, b = (np.array([rng.choice(40, 16, replace=False) for _ in range(n)], np.int32) for n in (30, 25))
    want = [[len(set(x) & set(y)) for y in b.tolist()] for x in a.tolist()]
    assert (pivots.shared_counts(a, b) == np.array(want)).all()


def test_odd_rows(spark):
    one = [1.0, 0.0, 0.5]
    rows = [
        (1, one, 0),
        (2, one, 0),
        (3, [2.0, 0.0, 1.0], 0),
        (4, one, None),
        (5, None, 0),
        (6, [0.0, 0.0, 0.0], 0),
        (7, [float("nan"), 1.0, 0.0], 0),
        (8, [float("inf"), 1.0, 0.0], 0),
        (9, [1.0, None, 0.5], 0),
        (10, [1.0, 0.0, 0.5, 0.0], 0),
        (11, [1.0, 0.0], 0),
        (12, [], 0),
        (13, one, 1),
        (None, one, 0),
        (14, [1e-30, 0.0, 5e-31], 0),
        (15, [-1.0, 0.0, -0.5], 0),
        (10, [1.0, 0.0, 0.5, 0.0], 0),
    ]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_copies(frame(spark, rows)).collect()), key=str)
    want = [(i, 3, 1, i == 1) for i in (1, 2, 3, 14)] + [(10, 1, 10, True)] * 2 + [(None, 0, None, True)]
    want += [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 11, 12, 13, 15)]
    assert got == sorted(want, key=str)


def test_a_hot_group_of_copies_and_of_near_copies(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in np.float32(centre)], 0) for i in range(300)]
    rows += [(300 + i, [float(x) for x in np.float32(centre + 0.01 * rng.normal(size=16))], 0) for i in range(200)]
    rows += [(600 + i, [float(x) for x in np.float32(rng.normal(size=16))], 0) for i in range(100)]
    near = all_pairs(rows)
    got = {r.vec_id: r for r in pivots.near_copies(frame(spark, rows)).collect()}
    assert all(got[i].n_links == 499 and got[i].component_id == 0 for i in range(500))
    assert sum(r.n_links for r in got.values()) >= 0.99 * near.sum()


def test_reference_points_lie_apart():
    rng = np.random.default_rng(6)
    centres = pivots.unit_rows(rng.normal(size=(20, 32)))
    x = pivots.unit_rows(np.repeat(centres, 30, axis=0) + 0.01 * rng.normal(size=(600, 32)))
    points = pivots.apart(x[rng.permutation(600)], 64, 0.93)
    assert len(points) == 20
    assert (points @ points.T)[~np.eye(20, dtype=bool)].max() < 2 * 0.93**2 - 1
    assert len(pivots.apart(x, 7, 0.93)) == 7


def test_no_rows_and_nothing_usable(spark):
    assert pivots.near_copies(frame(spark, [])).collect() == []
    got = pivots.near_copies(frame(spark, [(1, None, 0), (2, [0.0], 0), (3, [1.0], None)])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(i, 0, i, True) for i in (1, 2, 3)]
