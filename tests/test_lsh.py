import pytest

from docweave.operators import knn as KN
from docweave.operators.embed import embed_questions
from docweave.options import JobOptions
from docweave.plans import catalog
from docweave.plans import fixtures as fx

OPTS = JobOptions()


def _clustered(spark, n, seed=5):
    """Questions and chunks: 30 close neighbours around each of 20 centres, the others anywhere."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, OPTS.embed_dim))
    near = lambda k, x: (centres[np.arange(k) % 20] + x * rng.standard_normal((k, OPTS.embed_dim))).tolist()
    vectors = near(600, 0.3) + rng.standard_normal((n - 600, OPTS.embed_dim)).tolist()
    ch = spark.createDataFrame([("f", i, v) for i, v in enumerate(vectors)], "filename string, chunk_no long, vector array<float>")
    return spark.createDataFrame([(i, 1, v) for i, v in enumerate(near(40, 0.2))], "request_id long, q_no long, qvec array<float>"), ch


@pytest.mark.parametrize("rows,bits", [(700, 14), (2_000, 21)])
def test_lsh_recall_with_the_bits_of_a_large_table(spark, rows, bits, monkeypatch):
    """The probes alone, without the exact way for the rest, find close neighbours."""
    qv, ch = _clustered(spark, rows)
    key = ["request_id", "q_no", "filename", "chunk_no"]
    exact = KN.knn_exact(qv, ch, 20, OPTS).select(*key)
    real, left = KN.knn_exact, []

    def counted(questions, *a):
        left.append(questions.count())
        return real(questions, *a)

    monkeypatch.setattr(KN, "knn_exact", counted)
    hits = KN.knn_lsh(qv, ch, 20, OPTS, bits=bits).checkpoint()
    assert left == [0]
    assert hits.join(exact, key).count() / exact.count() >= 0.9


@pytest.mark.parametrize("size,bits", [("0.01", 14), ("0.1", None)])
def test_lsh_recall_of_far_neighbours(spark, sf, size, bits):
    """Documents' neighbours are far (centred cosine 0.2 to 0.5) at both sizes."""
    sf = sf.replace("0.001", size)
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS).where("request_id % 8 = 0")
    ch = catalog.fx_chunks(spark, sf)
    key = ["request_id", "q_no", "filename", "chunk_no"]
    exact = KN.knn_exact(qv, ch, 20, OPTS).select(*key)
    hits = KN.knn_lsh(qv, ch, 20, OPTS, bits=bits).checkpoint()
    assert hits.join(exact, key).count() / exact.count() >= 0.9
    assert hits.where("n_found <> 20").count() == 0


def test_probes_send_a_vector_once_a_cell(spark, monkeypatch):
    """Neither side is multiplied by its bands or probes; copies of the rows go to the blocks of the other side only."""
    import numpy as np

    rng = np.random.default_rng(9)
    o = OPTS.with_(embed_dim=8)
    rows = lambda n, name: [(name or i, i if name else 1, v) for i, v in enumerate(rng.random((n, 8)).tolist())]
    ch = spark.createDataFrame(rows(300, "f"), "filename string, chunk_no long, vector array<float>")
    qv = spark.createDataFrame(rows(40, None), "request_id long, q_no long, qvec array<float>")
    whole = {tuple(r) for r in KN.knn_lsh(qv, ch, 5, o, bits=6).collect()}
    real, met = KN._out_schema, []
    monkeypatch.setattr(KN, "_out_schema", lambda qkey, ckey, q, c, k=None: met.append((q.count(), c.count())) or real(qkey, ckey, q, c, k))
    small = o.with_(knn_block_bytes=100 * 4 * 8)
    assert {tuple(r) for r in KN.knn_lsh(qv, ch, 5, small, bits=6).collect()} == whole and len(whole) == 200
    # rows that go into the cells of the two rounds of probes, before they are dealt to blocks
    assert all(q <= 40 and c <= 300 for q, c in met[:2])
