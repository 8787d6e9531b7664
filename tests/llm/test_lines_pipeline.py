import random
from collections import Counter

from helpers import collect, docs, empty_docs, odd_docs, prose

from docweave.llm import lines as L


def sets_of(text):
    return [] if text is None else [frozenset(x.lower().split()) for x in text.split("\n")]


def brute_removed(rows, t=0.8):
    """rows: (doc_id, text) in order; line numbers that match any earlier line."""
    seen, out = [], []
    for _, text in rows:
        gone = []
        for no, s in enumerate(sets_of(text)):
            if s and any(len(s & o) >= t * len(s | o) - 1e-9 for o in seen):
                gone.append(no)
            if s:
                seen.append(s)
        out.append(gone)
    return out


def corpus(seed, n=70):
    rng = random.Random(seed)
    pool = [prose(rng, rng.choice([1, 2, 3, 4, 5, 6, 9, 10, 20, 40]), 80) for _ in range(60)]
    texts = []
    for _ in range(n):
        out = []
        for _ in range(rng.randrange(1, 8)):
            w = list(rng.choice(pool)) if rng.random() < 0.7 else prose(rng, rng.randrange(0, 30), 80)
            for _ in range(rng.randrange(0, 4)):
                if w:
                    k = rng.randrange(len(w))
                    w[k : k + 1] = rng.choice([[], ["New" + str(rng.randrange(9))], [w[k], "more"]])
            out.append(rng.choice([" ", "  ", "\t"]).join(w))
        texts.append("\n".join(out))
    return texts


def test_against_brute_force(spark):
    for seed in (1, 2):
        texts = [*corpus(seed), None, "", "a b c\n\na b c\nA  c b"]
        got = {r["doc_id"]: r for r in collect(L.report(docs(spark, texts)))}
        for i, gone in enumerate(brute_removed(list(enumerate(texts)))):
            assert got[i]["removed"] == gone, (i, texts[i])
            assert got[i]["n_lines"] == len(sets_of(texts[i])) and got[i]["n_removed"] == len(gone)


def test_disk_is_released_on_the_way(spark, monkeypatch):
    """No two parts of the index are on disk as shuffle files at a time, no token is in
    two parts, and the session's setting comes back."""
    import os

    seen, stage = [], L._bucketed

    def shuffled():
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(os.path.getsize(f) for i in range(local.size()) if os.path.exists(f := local.apply(i).getPath()) and f.endswith(".data"))

    def bucketed(df, key, name):
        out = stage(df, key, name)
        seen.append((shuffled(), {r["token"] for r in out.select("token").distinct().collect()}))
        return out

    monkeypatch.setattr(L, "_bucketed", bucketed)
    before, held = spark.conf.get(L.RELEASE, None), shuffled()
    texts = corpus(3, 120)
    got = {r["doc_id"]: r["removed"] for r in collect(L.report(docs(spark, texts)))}
    assert got == dict(enumerate(brute_removed(list(enumerate(texts)))))
    assert spark.conf.get(L.RELEASE, None) == before
    assert len(seen) == L.SLICES > 1 and all(files <= held for files, _ in seen)
    assert sum(len(t) for _, t in seen) == len(set().union(*(t for _, t in seen))) > 0


def test_other_thresholds(spark):
    texts = corpus(5, 40)
    for t in (0.5, 1.0):
        got = {r["doc_id"]: r["removed"] for r in collect(L.report(docs(spark, texts), t))}
        assert got == dict(enumerate(brute_removed(list(enumerate(texts)), t)))


def test_texts_after_dedup(spark):
    texts = [*corpus(9, 30), "only here once upon a time\nand this"]
    texts.append(texts[-1])
    got = {r["doc_id"]: r for r in collect(L.dedup_lines(docs(spark, texts)))}
    for i, gone in enumerate(brute_removed(list(enumerate(texts)))):
        kept = [x for k, x in enumerate(texts[i].split("\n")) if k not in gone]
        if gone and not any(x.split() for x in kept):
            assert i not in got
        else:
            assert got[i]["text"] == "\n".join(kept) and got[i]["n_chars"] == len(got[i]["text"])
    assert len(texts) - 1 not in got


def test_native_plan(spark, sf):
    df = L.lines_of(spark.read.parquet(f"{sf}/documents.parquet"), [0] * L.RANK_SLOTS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "1 AS line_no", "'x' AS words", "2 AS cls", "3 AS removed")
    got = collect(L.report(df))
    assert len(got) == 11
    # ids in order: -3, 1 (two texts), 7, 8, 9, 10, null; the null id repeats text 1
    assert Counter((r["doc_id"], r["n_removed"]) for r in got)[(None, 1)] == 1
    assert [r["n_removed"] for r in got if r["doc_id"] == 1] == [0, 0, 0]
    kept = collect(L.dedup_lines(df))
    assert len(kept) == 10 and set(kept[0]) == set(df.columns)
    assert collect(L.report(empty_docs(spark))) == [] == collect(L.dedup_lines(empty_docs(spark)))


def test_pipeline_stages(spark, tmp_path):
    """run() against the stages' brute-force rules on a small table."""
    import re

    import corpus_pipeline as C
    from test_decontaminate import brute
    from test_sharding_packing import check_packing
    from test_simhash import brute_components, plain_fingerprint

    rng = random.Random(12)
    word = [f"{a}{b}{c}o" for a in "bdgklm" for b in "aeiou" for c in "nrst"]
    make = lambda n: " ".join(rng.choice(word) for _ in range(n))
    bench = [(1, make(14)), (2, make(6))]
    texts = ["\n".join(make(rng.randrange(8, 30)) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    texts += [texts[0], texts[1] + "\n" + make(12), bench[0][1], "start " + bench[1][1] + " end " + make(10), "1234 5678", "", None]
    texts += [texts[2].replace("\n", " ")]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = collect(C.run(spark, str(tmp_path)))

    rows = [(i, t) for i, t in enumerate(texts) if t and re.search(r"[^\W\d_]", t)]
    out = []
    for (i, t), gone in zip(rows, brute_removed(rows)):
        kept = [x for k, x in enumerate(t.split("\n")) if k not in gone]
        if not gone or any(x.split() for x in kept):
            out.append((i, "\n".join(kept)))
    best = {d for d, _, c in brute_components([(i, plain_fingerprint(t)) for i, t in out]) if d == c}
    out = [(i, t) for i, t in out if i in best and not brute(t, bench)[1]]
    check_packing(got, out, 2048)


def test_stages_keep_columns(spark, sf):
    import corpus_pipeline as C

    frame = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, frame, sf).columns == frame.columns
    assert 4 <= len(C.STAGES) <= 5


def test_pipeline_odd_rows(spark, tmp_path):
    import corpus_pipeline as C

    for name, frame in (("odd", odd_docs(spark)), ("empty", empty_docs(spark))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = collect(C.run(spark, f"{tmp_path}/{name}"))
        assert (len(got) > 0) == (name == "odd")


def test_lines_are_numbered_once(spark, sf):
    """No filter repeats the numbering, and lines of white space alone have no set."""
    df = L.lines_of(docs(spark, ["a  b\n \t\r\f\x0b \n\nB a", "", None]), [0] * L.RANK_SLOTS)
    assert df._jdf.queryExecution().executedPlan().toString().count("array_distinct(") == 1
    got = {(r["doc_id"], r["line_no"]): r["words"] for r in df.collect()}
    assert set(got) == {(0, 0), (0, 3)} and got[0, 0] == got[0, 3] and len(got[0, 0]) == 2


def test_groups_of_two_need_no_join(spark, monkeypatch):
    """The first class of a group meets the others before the join: a group of two has no row left for it."""
    held, stage = [], L._bucketed

    def bucketed(df, key, name):
        out = stage(df, key, name)
        held.append((out.count(), out.where("meets").count()))
        return out

    monkeypatch.setattr(L, "_bucketed", bucketed)
    words = [f"u{i}" for i in range(40)]
    for copies, joined in ((2, False), (3, True)):
        held.clear()
        texts = [" ".join(words[:39] + [f"v{i}"]) for i in range(copies)]
        got = {r["doc_id"]: r["removed"] for r in collect(L.report(docs(spark, texts)))}
        assert got == dict(enumerate(brute_removed(list(enumerate(texts)))))
        assert sum(n for n, _ in held) > 0 and (sum(m for _, m in held) > 0) == joined
