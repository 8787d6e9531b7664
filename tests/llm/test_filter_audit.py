"""The audit against every document in every order, and the retractions one by one."""

from __future__ import annotations

import random
from itertools import permutations

import pandas as pd
import pytest

from docweave.llm import filter_audit as A

SCHEMA = "doc_id long, text string, lang string, mask int, n long"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = []
    for i, t, lang in docs:
        text = t or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if i is not None and i > least[text]:
            fails.add("E")
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        rows.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    shapley, out = {}, {}
    for order in permutations("ABCDE"):
        for part in {r[0] for r in rows}:
            for k, own in enumerate(order):
                kept = removed = redundant = unique = good = toxic = 0
                for p, fails, g, t in rows:
                    if p != part:
                        continue
                    gone = fails & set(order[:k])
                    if own in fails:
                        redundant += bool(gone)
                        unique += fails == {own}
                        if not gone:
                            removed, good, toxic = removed + 1, good + g, toxic + t
                    elif not gone:
                        kept += 1
                out[part, "".join(order), k + 1] = [kept, removed, redundant, unique, good, toxic]
                shapley[part, own] = shapley.get((part, own), 0) + removed
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def texts(rng):
    long = " ".join(f"w{i}" for i in range(220))
    return [
        None, "", " \t\n", "Short TEXT", "a # b", long, long + " $", "X" * 9 + " " + long, "rep " * 250, "rep " * 250 + "|",
        " ".join(f"w{i} {i}" for i in range(210)), "ÄÖÜ " * 230, "漢字 😀", f"noise {rng.random()}",
    ]


@pytest.mark.parametrize("seed,files", [(1, 1), (2, 7), (3, 12)])
def test_equals_plain_version(spark, tmp_path, seed, files):
    rng = random.Random(seed)
    pool = texts(rng)
    docs = [(rng.randrange(200), rng.choice(pool), rng.choice(["en", "de", None, ""])) for _ in range(250)]
    docs += [(None, rng.choice(pool), "en") for _ in range(20)]
    docs += [(1000 - i, pool[5], "en") for i in range(130)]  # a third of all rows, ids falling from file to file
    docs += [docs[0]] * 3
    labels = [(rng.randrange(200), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)] + [(None, 1, 1), (1000, 1, 0), (880, 0, 1)]
    path = str(tmp_path / "documents.parquet")
    step = -(-len(docs) // files)
    for k in range(files):
        part = [(*d, 7, 7) for d in docs[k * step : (k + 1) * step]]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    got = found(A.audit(spark, path, spark.createDataFrame(labels, LABELS)))
    assert got == plain(docs, labels)
    assert len(got) == 600 * len({d[2] or "" for d in docs})


def test_one_file_and_no_labels(spark, tmp_path, sf):
    import glob

    one = glob.glob(f"{sf}/documents.parquet")[0]
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(one).collect()]
    assert found(A.audit(spark, one, spark.createDataFrame([], LABELS))) == plain(docs, [])


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert A.audit(spark, path, spark.createDataFrame([], LABELS)).count() == 0


def test_masks():
    assert A.text_mask(None) == A.text_mask("") == 1
    fine = " ".join(f"w{i}" for i in range(200))
    assert A.text_mask(fine) == 0
    assert A.text_mask(fine.rsplit(" ", 1)[0]) == 1
    assert A.text_mask("a b " * 100) == 2
    assert A.text_mask(" ".join(f"w{i // 2}" for i in range(200))) == 0  # exactly half are distinct
    assert A.text_mask(fine + "&") == 8
    text = fine + "x" * (1000 - len(fine) - 30)
    assert A.text_mask(text + "A" * 30) == 0 and A.text_mask(text + "A" * 31) == 4


def row(digest, doc_id, part="en", mask=0, flags=0, n=1):
    return {"digest": digest, "doc_id": doc_id, "part": part, "mask": mask, "flags": flags, "n": n}


def counted(frame):
    return {(r.part, r.mask, r.flags): r.n for r in frame.itertuples()}


def test_a_smaller_id_retracts_the_earlier_mask():
    state, log = A.merge(None, pd.DataFrame([row(b"t", 9, flags=1), row(b"t", 12)]))
    assert counted(log) == {("en", 0, 1): 1, ("en", 16, 0): 1}
    state, log = A.merge(state, pd.DataFrame([row(b"t", 5, "de"), row(b"t", 5, "de"), row(b"u", 1)]))
    # the holder 9 is taken back and counted with E; both rows of 5 hold the text now
    assert counted(log) == {("en", 0, 1): -1, ("en", 16, 1): 1, ("de", 0, 0): 2, ("en", 0, 0): 1}
    state, log = A.merge(state, pd.DataFrame([row(b"t", 7), row(b"t", 5, "fr")]))
    assert counted(log) == {("en", 16, 0): 1, ("fr", 0, 0): 1}
    assert sorted((r.digest, r.doc_id, r.part, r.n) for r in state.itertuples()) == [(b"t", 5, "de", 2), (b"t", 5, "fr", 1), (b"u", 1, "en", 1)]
    assert A.pa.ipc.open_stream(A._pack(state)).read_pandas().to_dict("records") == state.to_dict("records")


def test_the_order_of_batches_does_not_matter():
    rng = random.Random(4)
    rows = [row(rng.choice([b"a", b"b", b"c"]), rng.randrange(30), rng.choice(["en", "de"]), flags=rng.randrange(4)) for _ in range(80)]
    totals = set()
    for _ in range(5):
        rng.shuffle(rows)
        state, logs, at = None, [], 0
        while at < len(rows):
            step = rng.randrange(1, 20)
            state, log = A.merge(state, pd.DataFrame(rows[at : at + step]))
            logs.append(log)
            at += step
        totals.add(tuple(sorted(counted(A._added(logs)).items())))
    assert len(totals) == 1
