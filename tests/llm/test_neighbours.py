import numpy as np
import pytest
from helpers import collect
from pyspark.sql import functions as F

from docweave.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and None not in v]
    ok = [(i, v) for i, v in ok if len(v) and np.isfinite(v).all() and (v != 0).any()]
    out = {}
    for i, q in ok:
        if is_query(i):
            found = {(-float(v @ q) / np.sqrt(v @ v) / np.sqrt(q @ q), j) for j, v in ok if j != i and len(v) == len(q)}
            out.setdefault(i, []).extend(sorted(found)[:k])
    return out


def test_recall(spark, sf):
    from docweave.llm.queries import op1_nearest

    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(vectors, lambda i: i % 50 == 0, 5)
    got = {}
    for r in collect(op1_nearest(spark, sf)):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    hit = [len({v for v, _ in got[q].values()} & {j for _, j in w}) / len(w) for q, w in want.items()]
    assert np.mean(hit) >= 0.9
    for q, w in want.items():
        score = {j: -s for s, j in w}
        assert sorted(got[q]) == list(range(1, len(w) + 1))
        assert all(abs(s - score[v]) < 1e-12 for v, s in got[q].values() if v in score)


def gaussian(rng, n=6000, d=64):
    return rng.standard_normal((n, d))


def clustered(rng, n=6000, d=64):
    return np.repeat(rng.standard_normal((n // 30, d)), 30, axis=0) + 0.4 * rng.standard_normal((n, d))


@pytest.mark.parametrize("make, most", [(gaussian, 0.6), (clustered, 0.05)])
def test_forest_narrows_and_still_finds(make, most):
    """Recall comes through the prefixes: no query reaches length 0, and few rows are scored where neighbours are near."""
    x = make(np.random.default_rng(4))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    forest = N.Forest(unit, N.TREES)
    share, hit = [], []
    for q, (rows, _, depth) in zip(range(0, 6000, 60), forest.search(unit[::60], 6, N.HIT_RATE)):
        assert depth > 0
        share.append(len(rows) / 6000)
        hit.append(np.isin(np.argsort(-(unit @ unit[q]))[1:6], rows).mean())
    assert np.mean(share) < most and np.mean(hit) >= 0.9


@pytest.mark.parametrize("make", [gaussian, clustered])
def test_recall_over_blocks(spark, make):
    x = make(np.random.default_rng(5), 3000, 32).astype(np.float32)
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {}
    for r in collect(N.nearest(df, F.col("vec_id") % 50 == 0, block_rows=800, query_rows=25)):
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, lambda i: i % 50 == 0, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(got[q] & {j for _, j in w}) / 5 for q, w in want.items()]) >= 0.9


def test_strings_share_prefixes_by_angle():
    """The chance of a common first character is 1 - angle / pi, over many trees."""
    rng = np.random.default_rng(7)
    a, b = rng.standard_normal((2, 48))
    b = a + 0.8 * b
    angle = np.arccos(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    shared = [N.common_prefix(s[:1], s[1:])[0] for s in (N.hash_strings(np.stack([a, b]), t) for t in range(2000))]
    for depth in (1, 3):
        assert abs(np.mean(np.array(shared) >= depth) - (1 - angle / np.pi) ** depth) < 0.04
    words = np.array([0, 1, 1 << 63, (1 << 64) - 1], np.uint64)
    assert N.common_prefix(words, np.zeros(4, np.uint64)).tolist() == [64, 63, 0, 0]


def test_blocks_agree_with_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[4][1]) for i in range(60)]  # one vector many times
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    want = brute(rows, lambda i: i % 50 == 0, 5)
    for size in (16_384, 40):
        got = collect(N.nearest(df, F.col("vec_id") % 50 == 0, block_rows=size, query_rows=3, hit_rate=1.0))
        for q, w in want.items():
            mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
            assert [v for _, v in mine] == [j for _, j in w]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (10, [-0.0, 3.0]), (0, [1.0, 0.0]), (11, [1e-30, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA).selectExpr("*", "1 AS block", "'x' AS score")
    got = collect(N.nearest(df, F.col("vec_id") % 2 == 0))
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0] == [1, 11, 2, 10]
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 2] == [10, 0, 1, 11]
    assert {r["query_id"] for r in got} == {0, 2, 10}
    assert collect(N.nearest(df.limit(0), F.lit(True))) == []
