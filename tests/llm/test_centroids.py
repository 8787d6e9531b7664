"""Centroid clustering against a plain version."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from docweave.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, cluster string, x int"


def plain(rows, k, dim, scale, rounds):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, [math.floor(scale * float(np.float32(c))) for c in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [r[1][:] for r in order[:k]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        member = [best(x)[1] for _, x in kept]
        for n in range(len(cents)):
            own = [x for (_, x), m in zip(kept, member) if m == n]
            if own:
                cents[n] = [sum(col) // len(own) for col in zip(*own)]
    last = [(i, *best(x)) for i, x in kept]
    inertia = {}
    for _, d, n in last:
        inertia[n] = inertia.get(n, 0) + d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), tuple(cents[n])) for i, d, n in last), key=repr)


def found(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.01), (3, 40.0)])
def test_equals_plain_rounds(spark, seed, spread):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(6)] for _ in range(5)]
    rows = [(i, [rng.choice(middles)[j] + rng.gauss(0, spread / 4) for j in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], SCHEMA).repartition(3)
    assert found(C.cluster(df, k=5, dim=6, scale=64, rounds=4)) == plain(rows, 5, 6, 64, 4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, -2.5, 0.125, 0.0]
    rows = [(1, good), (2, None), (3, []), (4, good[:3]), (5, good + [1.0]), (6, [1.0, nan, 0.0, 0.0]), (7, [inf, 0.0, 0.0, 0.0])]
    rows += [(8, [0.0, None, 0.0, 0.0]), (9, [0.0] * 4), (9, [0.0] * 4), (9, good), (None, [5.0, 5.0, 5.0, 5.0]), (None, None), (10, [-0.0001, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    assert found(C.cluster(df, k=3, dim=4, scale=1024, rounds=3)) == plain(rows, 3, 4, 1024, 3)
    # more centroids than vectors
    assert found(C.cluster(df, k=30, dim=4, scale=1024, rounds=2)) == plain(rows, 30, 4, 1024, 2)
    # a component too large to be squared exactly takes no part
    huge = spark.createDataFrame([(1, good, None, None), (2, [3e38, 0.0, 0.0, 0.0], None, None)], SCHEMA)
    assert [r.vec_id for r in C.cluster(huge, k=2, dim=4).collect()] == [1]


def test_empty_table(spark):
    out = C.cluster(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and out.count() == 0


@pytest.mark.parametrize("k,dim,top", [(1, 3, 5), (8, 64, 300), (200, 16, 1000), (40, 2, 3), (12, 64, C.LARGEST - 1)])
def test_search_is_exact_and_ties_go_to_the_smaller_number(k, dim, top):
    rng = np.random.default_rng(k * dim)
    cents = rng.integers(-top, top + 1, (k, dim))
    cents[k // 2 :] = cents[: k - k // 2]  # equal centroids
    x = np.concatenate([rng.integers(-top, top + 1, (300, dim)), cents])
    d = ((x[:, None, :] - cents[None, :, :]) ** 2).sum(axis=2)
    which, distance, _ = C.Search(cents).nearest(x)
    assert (distance == d.min(axis=1)).all()
    assert (which == d.argmin(axis=1)).all()


def test_inequalities_reject_most_centroids():
    rng = np.random.default_rng(7)
    cents = rng.integers(-50, 50, (64, 16)) + rng.integers(-2000, 2000, (64, 1))
    x = cents[rng.integers(0, 64, 2000)] + rng.integers(-20, 20, (2000, 16))
    which, distance, compared = C.Search(cents).nearest(x)
    assert (distance == ((x - cents[which]) ** 2).sum(axis=1)).all()
    assert compared < 0.2 * len(x) * len(cents)


def test_sums_that_exceed_a_long():
    assert int(C._total(np.full(1000, (1 << 62) + 5))) == 1000 * ((1 << 62) + 5)
