"""The neighbour graph against exact search."""

from __future__ import annotations

import numpy as np
import pytest

from docweave.operators import graph as G
from docweave.operators import knn as KN
from docweave.operators.embed import embed_questions
from docweave.options import DEFAULT as OPTS
from docweave.plans import catalog
from docweave.plans import fixtures as fx

KEY = ["request_id", "q_no", "filename", "chunk_no"]
CHUNKS = "filename string, chunk_no long, vector array<float>"
QUESTIONS = "request_id long, q_no long, qvec array<float>"


def recall(hits, exact):
    return hits.join(exact, KEY).count() / exact.count()


@pytest.mark.parametrize("size,every", [("0.01", 1), ("0.1", 16)])
def test_recall_at_two_sizes_without_an_exact_way(spark, sf, size, every, monkeypatch):
    sf = sf.replace("0.001", size)
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS).where(f"request_id % {every} = 0").checkpoint()
    ch = catalog.fx_chunks(spark, sf)
    exact = KN.knn_exact(qv, ch, 20, OPTS).select(*KEY).checkpoint()
    index = G.build_graph(ch, OPTS)

    def never(*a, **kw):
        raise AssertionError("exact plan")

    monkeypatch.setattr(KN, "knn_exact", never)
    hits = G.knn_graph(qv, None, 20, OPTS, index=index).checkpoint()
    assert recall(hits, exact) >= 0.9
    assert hits.where("n_found <> 20").count() == 0
    # a list holds the neighbours of a node and the nearest of those that name it
    assert index.links.selectExpr("max(size(near))").first()[0] <= 2 * OPTS.graph_degree


def _table(spark, rows, schema):
    return spark.createDataFrame([(*r[:2], [float(x) for x in r[2]]) if r[2] is not None else r for r in rows], schema)


@pytest.mark.parametrize("metric", ["L2", "COSINE", "IP"])
def test_clusters_copies_and_odd_rows(spark, metric):
    """20 far clusters, a vector that a third of all chunks share, nulls."""
    rng = np.random.default_rng(3)
    o = OPTS.with_(embed_dim=8, metric=metric)
    centres = 10 * rng.standard_normal((20, 8))
    vectors = [centres[i % 20] + 0.3 * rng.standard_normal(8) for i in range(600)]
    rows = [("f", i, v) for i, v in enumerate(vectors)] + [("hot", i, vectors[5]) for i in range(300)] + [("none", 1, None)]
    ch = _table(spark, rows, CHUNKS)
    asked = [(i, 1, centres[i % 20] + 0.2 * rng.standard_normal(8)) for i in range(40)] + [(99, 1, vectors[5]), (100, 1, None)]
    qv = _table(spark, asked, QUESTIONS)
    exact = KN.knn_exact(qv.where("qvec is not null"), ch.where("vector is not null"), 10, o)
    hits = G.knn_graph(qv, ch, 10, o).checkpoint()
    assert recall(hits, exact) >= 0.9
    assert hits.where("request_id = 100").count() == 0 and hits.where("filename = 'none'").count() == 0
    if metric == "L2":
        # of the copies the smallest keys, at distance 0
        own = sorted((r["filename"], r["chunk_no"]) for r in hits.where("request_id = 99").collect())
        assert own == [("f", 5), *[("hot", i) for i in range(9)]]
        same = hits.join(exact.withColumnRenamed("distance", "e").withColumnRenamed("rank", "er"), KEY)
        assert same.where("abs(distance - e) > 1e-12").count() == 0


def test_small_and_empty_tables(spark):
    o = OPTS.with_(embed_dim=2)
    qv = _table(spark, [(1, 1, [0.0, 0.0])], QUESTIONS)
    few = _table(spark, [("f", i, [i, 0.0]) for i in range(3)], CHUNKS)
    assert [(r["chunk_no"], r["rank"], r["n_found"]) for r in G.knn_graph(qv, few, 20, o).orderBy("rank").collect()] == [(0, 1, 3), (1, 2, 3), (2, 3, 3)]
    one = G.knn_graph(qv, few.where("chunk_no = 2"), 20, o).collect()
    assert [(r["chunk_no"], r["distance"]) for r in one] == [(2, 2.0)]
    none = G.knn_graph(qv, few.where("chunk_no > 5"), 20, o)
    assert none.columns == ["request_id", "q_no", "filename", "chunk_no", "distance", "rank", "n_found"] and none.count() == 0
    assert G.knn_graph(qv.where("q_no > 5"), few, 20, o).count() == 0


def test_rounds_do_not_multiply_size_estimates(spark):
    """A checkpoint keeps the estimate its joins gave: its digits grew with every round, and the driver's time with them."""
    rng = np.random.default_rng(6)
    o = OPTS.with_(embed_dim=8, graph_width=3, graph_beam=12, graph_entries=4)
    ch = _table(spark, [("f", i, v) for i, v in enumerate(rng.random((400, 8)))], CHUNKS)
    qv = _table(spark, [(i, 1, v) for i, v in enumerate(rng.random((10, 8)))], QUESTIONS)
    index = G.build_graph(ch, o)
    hits = G.knn_graph(qv, None, 10, o, index=index)
    for df in (index.links, hits):
        assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 2_000
    assert hits.count() == 100
