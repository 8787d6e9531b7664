"""Search and scoring steps whose cost must not grow beyond their input's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from docweave.operators import graph as G
from docweave.operators import knn as KN
from docweave.operators import retrieve as RT
from docweave.options import DEFAULT as OPTS

KEY = ["request_id", "q_no", "filename", "chunk_no"]
CHUNKS = "filename string, chunk_no long, vector array<float>"
QUESTIONS = "request_id long, q_no long, qvec array<float>"


def _rows(spark, vectors, schema, name=None):
    return spark.createDataFrame([((name or i), (i if name else 1), [float(x) for x in v]) for i, v in enumerate(vectors)], schema)


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e20])
def test_products_in_floats_lose_no_neighbour(metric, scale):
    """Distances that differ by less than a float can tell, over several tiles."""
    rng = np.random.default_rng(1)
    base = rng.random((4, 16))
    C = np.concatenate([b + 1e-7 * rng.standard_normal((3_000, 16)) for b in base])[rng.permutation(12_000)] * scale
    Q = base * scale
    assert (KN._Scan(C, metric, KN._kind(Q, C), chunks=True).rows.dtype == np.float32) == (scale == 1.0)
    qi, ci, d = KN.topk_block(Q, C, 20, metric)
    for i, q in enumerate(Q):
        e = KN._exact(np.broadcast_to(q, C.shape), C, metric)
        want = np.lexsort((np.arange(len(C)), np.round(e, KN.RANK_DIGITS)))[:20]
        assert ci[qi == i].tolist() == want.tolist()


def test_a_cell_takes_arrow_tables():
    """No object a vector: the kernel of a cell reads lists as one matrix."""
    rng = np.random.default_rng(2)
    V = rng.random((50, 8)).astype(np.float32)
    cs = pa.table({"filename": [f"f{i:02d}" for i in range(50)][::-1], "chunk_no": [1] * 50, "_cv": V[::-1].tolist()}, schema=pa.schema([("filename", pa.string()), ("chunk_no", pa.int64()), ("_cv", pa.list_(pa.float32()))]))
    qs = pa.table({"request_id": [7], "_qv": V[3:4].tolist()}, schema=pa.schema([("request_id", pa.int64()), ("_qv", pa.list_(pa.float32()))]))
    out = KN._cell_kernel(2, "L2", ["request_id"], ["filename", "chunk_no"])(qs, cs)
    assert out["filename"][0].as_py() == "f03" and out["distance"][0].as_py() == 0.0
    with pytest.raises(ValueError):
        KN._arrow_matrix(pa.chunked_array([[[1.0], None]]))


def test_far_questions_are_not_probed_to_the_end(spark, monkeypatch):
    """Only questions with a close chunk in their likeliest buckets get all probes; the rest is exact."""
    rng = np.random.default_rng(4)
    o = OPTS.with_(embed_dim=16)
    centre = 5 * rng.standard_normal(16)
    chunks = _rows(spark, np.concatenate([centre + 0.1 * rng.standard_normal((40, 16)), rng.standard_normal((400, 16))]), CHUNKS, "f")
    qv = _rows(spark, np.concatenate([centre + 0.05 * rng.standard_normal((3, 16)), 0.3 * rng.standard_normal((30, 16))]), QUESTIONS)
    real, probed = KN.probe_keys, []

    def counted(df, *a, first=None, **kw):
        if not first:
            probed.append(df.count())
        return real(df, *a, first=first, **kw)

    monkeypatch.setattr(KN, "probe_keys", counted)
    exact = KN.knn_exact(qv, chunks, 10, o)
    hits = KN.knn_lsh(qv, chunks, 10, o, bits=10)
    assert 3 <= probed[0] < 33
    assert hits.join(exact, KEY).count() >= 0.9 * exact.count()
    assert hits.where("n_found <> 10").count() == 0


def test_graph_rounds_in_many_cells(spark, monkeypatch):
    """Fronts and vectors meet in cells; several of them give what one gives."""
    rng = np.random.default_rng(5)
    o = OPTS.with_(embed_dim=8)
    chunks, qv = _rows(spark, rng.random((300, 8)), CHUNKS, "f"), _rows(spark, rng.random((20, 8)), QUESTIONS)
    index = G.build_graph(chunks, o)
    monkeypatch.setattr(G, "CELL_PAIRS", 2_000)
    small = o.with_(knn_block_bytes=100 * 8 * 8)
    assert G._cells(20, 300, o.graph_width, small, 4)[1] == 3 and G._cells(20, 300, o.graph_width, small, 4)[0] > 1
    hits = G.knn_graph(qv, None, 10, small, index=index)
    exact = KN.knn_exact(qv, chunks, 10, o)
    assert hits.join(exact, KEY).count() >= 0.9 * exact.count()


def test_a_chunk_of_many_pairs_is_scored_in_parts(spark, monkeypatch):
    chunks = spark.createDataFrame([("a", 1, "red green red"), ("b", 1, "blue"), ("c", 1, None)], "filename string, chunk_no long, text string")
    asked = spark.createDataFrame([(i, 1, "red or blue" if i % 2 else "") for i in range(40)], "request_id long, q_no long, question string")
    pairs = asked.select("request_id", "q_no").crossJoin(chunks.select("filename", "chunk_no"))
    whole = {tuple(r) for r in RT.lexical_score(pairs, asked, chunks).collect()}
    monkeypatch.setattr(RT, "PAIRS", 3)
    assert {tuple(r) for r in RT.lexical_score(pairs, asked, chunks).collect()} == whole and len(whole) == 120
    by = {r[:1] + r[2:3]: r[-1] for r in whole}
    assert by[(1, "a")] > by[(1, "b")] * 0 and by[(1, "c")] == 0.0 and by[(0, "a")] == 0.0


def test_a_task_is_one_cell_of_the_exact_search(spark, monkeypatch):
    """Cells that share a partition add up in one task; by hash some do."""

    def place(k, m, qkey, ckey):
        from pyspark import TaskContext

        def kernel(qs: pa.Table, cs: pa.Table) -> pa.Table:
            if not len(qs) or not len(cs):
                return pa.table({c: side[c].slice(0, 0) for side, key in ((qs, qkey), (cs, ckey)) for c in key} | {"distance": pa.array([], pa.float64())})
            first = {c: side[c].slice(0, 1) for side, key in ((qs, qkey), (cs, ckey)) for c in key}
            return pa.table(first | {"distance": pa.array([float(TaskContext.get().partitionId())])})

        return kernel

    vectors = np.random.default_rng(3).random((600, 8))
    q, c = _rows(spark, vectors[:300], QUESTIONS), _rows(spark, vectors, CHUNKS, "f")
    c = c.selectExpr("filename", "monotonically_increasing_id() as chunk_no", "vector")
    monkeypatch.setattr(KN, "_one_cell", place)
    opts = OPTS.with_(embed_dim=8, knn_block_bytes=100 * 64)
    cells = [r["distance"] for r in KN.knn_exact(q, c, 50, opts).collect()]
    assert len(cells) == 18 and len(set(cells)) == 18


def test_bound_of_pairs_a_cell_changes_no_hit(spark, monkeypatch):
    vectors = np.random.default_rng(4).random((400, 8))
    q, c = _rows(spark, vectors[:50], QUESTIONS), _rows(spark, vectors, CHUNKS, "f")
    c = c.selectExpr("filename", "monotonically_increasing_id() as chunk_no", "vector")
    found = lambda: sorted(map(tuple, KN.knn_exact(q, c, 5, OPTS.with_(embed_dim=8)).collect()))
    whole = found()
    monkeypatch.setattr(KN, "CELL_PAIRS", 1_000)
    assert found() == whole and len(whole) == 250


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_only_the_last_candidates_are_scored_exactly(metric, monkeypatch):
    """Products bound the candidates tile by tile; exact distances are for those left at the end."""
    rng = np.random.default_rng(7)
    Q, C = rng.standard_normal((40, 16)).astype(np.float32), rng.standard_normal((30_000, 16)).astype(np.float32)
    real, pairs = KN._exact, []
    monkeypatch.setattr(KN, "_exact", lambda q, c, m: pairs.append(len(q)) or real(q, c, m))
    qi, ci, d = KN.topk_block(Q, C, 20, metric)
    assert sum(pairs) <= 40 * 24
    for i, q in enumerate(Q):
        e = real(np.broadcast_to(q, C.shape).astype(float), C.astype(float), metric)
        assert ci[qi == i].tolist() == np.lexsort((np.arange(len(C)), np.round(e, KN.RANK_DIGITS)))[:20].tolist()


def test_rare_marks_are_found_eight_at_a_time():
    for shape in ((5, 64), (3, 13), (1, 8)):
        mask = np.random.default_rng(8).random(shape) < 0.05
        assert KN._places(mask).tolist() == np.flatnonzero(mask).tolist()
