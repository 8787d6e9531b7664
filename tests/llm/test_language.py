from helpers import collect, empty_docs, odd_docs

from docweave.llm import language as L


def test_held_out_accuracy(spark, sf):
    from docweave.llm.queries import op9_language

    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = collect(op9_language(spark, sf))
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and len(held) > 20
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_filter_has_no_false_negatives(spark):
    """Every n-gram above the share is found, and false positives are corrected for."""
    texts = {"aa": "der hund und die katze", "bb": "the cat and the dog", "cc": "le chat et le chien"}
    df = spark.createDataFrame([(t, k) for k, t in texts.items() for _ in range(5)], "text string, lang string")
    m = L.train(df)
    for k, t in texts.items():
        hits, n = m.counts(L._normal(t))
        assert hits[m.languages.index(k)] == n
        assert m.predict(t)[0] == k
    assert m.false_rate.max() < 1e-6
    # a text longer than one piece is counted whole
    long = (texts["aa"] + " ") * 120_000
    assert len(long) > L.PIECE and m.counts(L._normal(long))[1] > 2_000_000


def test_many_languages(spark):
    """More languages than one mask word holds."""
    rows = [(" ".join([f"{chr(97 + i // 26)}{chr(97 + i % 26)}zq{j}x{chr(97 + i % 26)}{chr(97 + i // 26)}wv" for j in "abcd"]), f"l{i:03d}") for i in range(130)]
    m = L.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(m.slots) == 3
    assert sum(m.predict(t)[0] == k for t, k in rows) >= 128


def test_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "0 AS score", "'x' AS lang_pred")
    m = L.train(df)
    got = collect(L.predict(df, m))
    assert len(got) == 11 and set(got[0]) == set(df.columns)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if not (r["text"] or "").strip())
    assert all(r["lang_pred"] in m.languages for r in got if (r["text"] or "").strip())
    # the words of document 10 are single letters: no n-gram to tell, so it stays
    assert {r["doc_id"] for r in collect(L.accepted(df, m))} == {1, None, 10, -3}
    foreign = spark.createDataFrame([(99, "zqxj vkwq jjxz qqvk zxqj vwkz", None, None, 1)], odd_docs(spark).schema)
    assert collect(L.accepted(foreign, m)) == []
    nothing = L.train(empty_docs(spark))
    assert nothing.languages == ()
    assert {r["lang_pred"] for r in collect(L.predict(df, nothing))} == {"und"}
    assert collect(L.predict(empty_docs(spark), m)) == []
    assert m.predict("12 34 !?") == ("und", 0.0, 0)
    assert m.predict("a")[0] in m.languages


def test_number_characters_are_no_letters(spark):
    m = L.train(odd_docs(spark))
    assert all(m.predict(t)[0] == "und" for t in ("½", "12 ²", "Ⅷ ⅳ", "①②", "٣"))
    assert all(m.predict(t)[0] in m.languages for t in ("ª", "漢", "ß 12", "ǅ"))


def test_training_counts_in_bounded_memory(monkeypatch):
    """Counts of n-grams are those of all texts, whatever is held at a time; a batch is never held as Python objects."""
    import random
    import tracemalloc
    from collections import Counter

    import pyarrow as pa

    from docweave.llm import language as L

    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(300)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "fr"] * 1000), pa.array(texts)], ["lang", "text"])
    tracemalloc.start()
    for _ in L._count_grams(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32_000_000

    want = Counter()
    for k, t in enumerate(texts[:60]):
        code, ok = L._grams(L._normal(t))
        want.update((("en", "de", "fr")[k % 3], int(c)) for c in code[ok])
    for piece, held, step in ((1 << 19, 1_000_000, 256), (1000, 300, 7)):
        monkeypatch.setattr(L, "PIECE", piece)
        monkeypatch.setattr(L, "HELD", held)
        monkeypatch.setattr(L, "STEP", step)
        got = Counter()
        for b in L._count_grams(iter([batch.slice(0, 40), batch.slice(40, 20)])):
            for r in b.to_pylist():
                got[r["lang"], r["gram"]] += r["n"]
        assert got == want


def test_training_holds_a_bounded_number_of_grams(monkeypatch):
    """Many languages share one bound: sums are handed on before the input ends, and add up."""
    import random

    import pyarrow as pa

    monkeypatch.setattr(L, "PIECE", 500)
    monkeypatch.setattr(L, "HELD", 3000)
    rng = random.Random(4)
    rows = [(f"l{i % 30}", " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60))) for i in range(240)]
    taken = 0

    def batches():
        nonlocal taken
        for k in range(0, len(rows), 30):
            taken += 1
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows[k : k + 30]]), pa.array([t for _, t in rows[k : k + 30]])], ["lang", "text"])

    total, began = {}, None
    for b in L._count_grams(batches()):
        began = began or taken
        for lang, gram, n in zip(*(c.to_pylist() for c in b.columns)):
            total[lang, gram] = total.get((lang, gram), 0) + n
    assert began < len(rows) // 30
    monkeypatch.undo()
    whole = {}
    for b in L._count_grams(batches()):
        for lang, gram, n in zip(*(c.to_pylist() for c in b.columns)):
            whole[lang, gram] = whole.get((lang, gram), 0) + n
    assert total == whole


def test_arrow_batches_are_small(spark):
    from pyspark.sql import functions as F

    from docweave.llm import common

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    before = spark.conf.get(common.BATCH_LIMIT)
    try:
        spark.conf.set(common.BATCH_LIMIT, str(64 << 20))
        common.prepare(spark)
        texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 500).alias("text"))
        assert max(r["n"] for r in texts.mapInArrow(sizes, "n long").collect()) < 2 * common.BATCH_BYTES
        spark.conf.set(common.BATCH_LIMIT, "1000000")
        common.prepare(spark)
        assert spark.conf.get(common.BATCH_LIMIT).removesuffix("b") == "1000000"
    finally:
        spark.conf.set(common.BATCH_LIMIT, before)
