import math

import numpy as np
from helpers import collect, empty_docs, odd_docs

from docweave.llm import quality as Q


def test_held_out_labels(spark, sf):
    """Fit on a part of the labels, judge on the rest."""
    sf = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    models = Q.fit(docs, labels.where("doc_id % 4 <> 0"))
    got = {r["doc_id"]: r for r in collect(Q.classify(docs, models))}
    held = [(r["quality"], r["toxic"], got[r["doc_id"]]) for r in labels.where("doc_id % 4 = 0").collect()]
    assert np.mean([(r["p_quality"] >= 0.5) == (q == 1) for q, _, r in held]) >= 0.9
    assert np.mean([(r["p_toxic"] >= 0.5) == (t == 1) for _, t, r in held]) >= 0.88
    assert len(got) == docs.count()


def test_shrinkage_is_the_grouped_formula(spark):
    import random

    rng = random.Random(3)
    rows = []
    for h in range(6):
        for p in range(3):
            for _ in range([40, 5, 1][p]):
                q = min(0.99, max(0.01, 0.15 * h + 0.1 * p + 0.1 * rng.random()))
                rows.append((f"h{h}", f"p{p}", q, 0.5))
    rows.append(("lone", "", 0.9, 0.5))
    scored = spark.createDataFrame(rows, "host string, path string, doc_quality double, doc_toxic double")
    got = {(r["host"], r["path"]): r for r in collect(Q.site_posteriors(scored))}
    mean = np.mean([r[2] for r in rows])
    hosts = sorted({r[0] for r in rows})
    n = {h: sum(r[0] == h for r in rows) for h in hosts}
    s = {h: sum(r[2] for r in rows if r[0] == h) for h in hosts}
    noise = np.mean([mean * (1 - mean) / n[h] for h in hosts])
    spread = np.mean([(s[h] / n[h] - mean) ** 2 for h in hosts])
    strength = max(1.0, mean * (1 - mean) / max(1e-6, spread - noise) - 1)
    for (h, p), r in got.items():
        assert math.isclose(r["mean_quality"], mean) and math.isclose(r["strength_host_quality"], strength)
        assert r["n_host"] == n[h] and math.isclose(r["sum_host_quality"], s[h])
        assert r["n_path"] == sum(x[0] == h and x[1] == p for x in rows)
        assert 1 <= r["strength_path_quality"] <= 1e6


def test_sites_move_documents(spark):
    """Equal texts: the better site gives the better posterior; a lone document keeps the global mean."""
    good, bad = "the quiet river runs along old trees", "### $$$ %%% &&&"
    rows = [(i, good, "good.org/a") for i in range(30)] + [(100 + i, bad, "bad.org/x") for i in range(30)]
    rows += [(200, "unseen words only", "good.org/a"), (201, "unseen words only", "bad.org/x"), (202, "unseen words only", "new.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(100 + i, 0, 1) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in collect(Q.classify(docs, Q.fit(docs, labels)))}
    assert got[200]["p_quality"] > got[202]["p_quality"] > got[201]["p_quality"]
    assert got[0]["keep"] and not got[100]["keep"]
    assert (got[0]["host"], got[0]["path"], got[202]["path"]) == ("good.org", "a", "")


def test_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "'x' AS host", "1 AS n_host", "2 AS keep")
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = collect(Q.classify(df, Q.fit(df, labels)))
    assert len(got) == 11 and all(0 <= r["p_quality"] <= 1 and 0 <= r["p_toxic"] <= 1 for r in got)
    none = Q.fit(df, labels.limit(0))
    assert all(abs(r["doc_quality"] - 0.5) < 1e-6 for r in collect(Q.classify(df, none)))
    assert collect(Q.classify(empty_docs(spark), none)) == []
