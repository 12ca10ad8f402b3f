"""Bounded k-means against plain integer k-means that compares every vector with every centroid."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from marquee.llm import shallot as S

SF = "/root/testdata/sf0.001"


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * Fraction(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in first[:k]]
    if not cents:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(cents)]
    found = [(i, *nearest(v)) for i, v in kept]
    per = {}
    for _, d, j in found:
        per[j] = per.get(j, 0) + d
    whole = sum(per.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]

    def fit(x):
        return x if x < 1 << 63 else None

    return [(i, j, fit(d), fit(per[j]), fit(whole), digest[j]) for i, d, j in found]


def check(spark, rows, schema="vec_id long, embedding array<float>", **kw):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = [tuple(r) for r in S.clusters(df, **kw).collect()]
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def cloud(rng, n, spread=0.1, groups=8):
    centres = [[rng.gauss(0, 0.3) for _ in range(64)] for _ in range(groups)]
    return [[x + rng.gauss(0, spread) for x in rng.choice(centres)] for _ in range(n)]


def test_table_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = [tuple(r) for r in S.clusters(df).collect()]
    assert sorted(got) == sorted(brute([(r.vec_id, r.embedding) for r in df.collect()]))


def test_clusters_of_unequal_size_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 37)
    rng = random.Random(4)
    rows = cloud(rng, 400, 0.2, 3) + cloud(rng, 60, 0.01, 9)
    check(spark, list(enumerate(rows)))


def test_ties_repeated_rows_and_odd_vectors(spark):
    grid = [[float(i % 2) / 512] * 32 + [float(i // 2 % 3) / 512] * 32 for i in range(60)]
    rows = list(enumerate(grid)) + [(5, grid[5]), (5, grid[7]), (None, grid[1]), (None, None)]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [1.0] * 63 + [None]),
             (905, [1.0] * 63 + [float("nan")]), (906, [float("inf")] + [0.0] * 63)]
    check(spark, rows)


def test_few_vectors_and_none(spark):
    check(spark, [])
    check(spark, [(1, [0.5] * 64)])
    check(spark, [(1, [0.5] * 64), (2, [0.5] * 64), (None, [0.25] * 64)])
    check(spark, [(None, [0.25] * 64)])


@pytest.mark.parametrize("size", [2.0**17 - 1, 2.0**40, 2.0**127])
def test_large_components(spark, size):
    rng = random.Random(9)
    rows = [(i, [size * rng.uniform(-1, 1) if i % 3 else rng.uniform(-1, 1) for _ in range(64)]) for i in range(40)]
    check(spark, rows, "vec_id long, embedding array<double>")


def test_extra_and_clashing_columns(spark):
    rng = random.Random(1)
    rows = [(i, v, 7, "x", "y") for i, v in enumerate(cloud(rng, 30))]
    check(spark, rows, "vec_id int, embedding array<float>, cluster int, ids string, distance string")


def test_search_skips_most_distances(monkeypatch):
    rng = np.random.default_rng(2)
    centres = np.arange(40)[:, None] * 500 + rng.integers(-100, 100, (40, 64))     # far and near ones, as on a line
    rows = centres[rng.integers(0, 40, 3000)] + rng.integers(-300, 300, (3000, 64))
    measured = []
    plain = S._square
    monkeypatch.setattr(S, "_square", lambda a, b: measured.append(len(a)) or plain(a, b))
    now = S.Centroids.of(centres.tolist())
    state = S.search(rows, now, np.zeros(3000, np.int32), np.zeros(3000, np.int32), np.full(3000, np.inf), np.zeros(3000))
    want = np.argmin(((rows[:, None] - centres[None]) ** 2).sum(axis=2), axis=1)
    assert (state[0] == want).all() and sum(measured) < 3000 * 40 * 0.6
    measured.clear()
    moved = S.Centroids.of((centres + 3).tolist(), centres.tolist())
    upper, lower = S._moved(moved, state[0], *state[2:])
    again = S.search(rows, moved, state[0], state[1], upper, lower)
    assert (again[0] == np.argmin(((rows[:, None] - centres[None] - 3) ** 2).sum(axis=2), axis=1)).all()
    assert sum(measured) < 3000 * 3
