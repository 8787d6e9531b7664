import hashlib
import random
import re

from helpers import collect, docs, empty_docs, odd_docs, prose

from docweave.llm import decontaminate as D


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window=10):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        p = words(t)
        m = min(window, len(p))
        for k in range(len(p) - m + 1 if m else 0):
            for i in range(len(w) - m + 1):
                if w[i : i + m] == p[k : k + m]:
                    hit.update(range(i, i + m))
                    found.add(item)
    return len(w), len(hit), sorted(found)


def fixture():
    rng = random.Random(7)
    items = [(i, " ".join(prose(rng, n, 20))) for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 14, 25, 40, 0])] + [(90, None), (91, "...")]
    items += [(100, items[8][1]), (101, "Étude Über x1 — y")]
    texts = [" ".join(prose(rng, rng.randrange(0, 200), 20)) for _ in range(40)]
    for i, t in items[4:]:
        texts.append("before " + (t or "").upper().replace(" ", " ,\n") + " after " + (t or ""))
    return items, [*texts, None, "", "étude über X1 y", "A" * 5000]


def test_search_matches_brute_force():
    items, texts = fixture()
    tables = D.PatternTables(items)
    for t in texts:
        spans, found = tables.search(words(t) if t is None else D.words_of(t))
        n, hit, want = brute(t, items)
        assert (D.covered(spans), sorted(found)) == (hit, want)


def test_operator(spark):
    items, texts = fixture()
    bench = spark.createDataFrame([*items, (None, "no id")], "item_id long, text string")
    df = docs(spark, texts).selectExpr("*", "1 AS n_words", "2 AS items")
    want = {i: brute(t, items) for i, t in enumerate(texts)}
    for chunk in (D.CHUNK_BYTES, 100):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in collect(D.contamination(df, bench, chunk_bytes=chunk))}
        assert got == want
        assert {r["doc_id"] for r in collect(D.clean(df, bench, chunk_bytes=chunk))} == {i for i, x in want.items() if not x[1]}
    assert D.digest([10, 9]) == hashlib.sha256(b"10,9").hexdigest()


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "text with seven words")], "item_id long, text string")
    none = bench.limit(0)
    assert len(collect(D.contamination(odd_docs(spark), bench))) == 11
    assert len(collect(D.contamination(odd_docs(spark), bench.union(bench), chunk_bytes=1))) == 11
    assert len(collect(D.clean(odd_docs(spark), bench))) == 8
    assert len(collect(D.clean(odd_docs(spark), none))) == 11
    assert all(r["n_hit"] == 0 for r in collect(D.contamination(odd_docs(spark), none)))
    assert collect(D.contamination(empty_docs(spark), bench)) == []
    assert D.clean(odd_docs(spark), bench).columns == odd_docs(spark).columns
