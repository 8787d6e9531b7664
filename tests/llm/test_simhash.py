import random
from collections import defaultdict

import numpy as np
import xxhash
from helpers import collect, docs, empty_docs, odd_docs, prose

from docweave.llm import simhash
from docweave.llm.common import components


def plain_fingerprint(text, k=3):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    sh = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs):
    """pairs: (doc_id, fp) -> component id by all-pairs comparison."""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 3:
                parent[find(a)] = find(b)
    low = defaultdict(lambda: None)
    for d, f in pairs:
        r = find(f)
        if d is not None and (low[r] is None or d < low[r]):
            low[r] = d
    return [(d, f, low[find(f)]) for d, f in pairs]


def test_fingerprint_matches_definition():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 700):
        t = " \n".join(prose(rng, n)) + "\t É Ünï ABC\x0b"
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_every_close_pair_meets(spark):
    """Fingerprints 0 to 5 bits apart, both parities: links iff at most 3 bits."""
    rng = np.random.default_rng(5)
    fps = set()
    for _ in range(60):
        x = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        fps.add(x)
        for d in range(1, 6):
            y = x
            for b in rng.choice(64, d, replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    pairs = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(f - (1 << 64) if f >> 63 else f,) for _, f in pairs]
    df = spark.createDataFrame(signed, "fp long")
    for per_bucket in (2_000_000, 20_000):
        roots = dict(components(simhash.links(df, len(signed), per_bucket)).collect())
        got = defaultdict(set)
        for (f,) in signed:
            got[roots.get(f, f)].add(f & (1 << 64) - 1)
        want = defaultdict(set)
        for _, f, c in brute_components(pairs):
            want[c].add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(prose(rng, 120)) for _ in range(60)]
    for t in texts[:25]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += texts[:10] + [None, "", "one"]
    got = sorted((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in collect(simhash.near_duplicates(docs(spark, texts))))
    assert got == sorted(brute_components([(i, plain_fingerprint(t)) for i, t in enumerate(texts)]))
    kept = {r["doc_id"] for r in collect(simhash.keep_one(docs(spark, texts)))}
    assert kept == {c for _, _, c in got}


def test_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "1 AS fp", "'x' AS component_id", "2 AS text_key")
    rows = collect(df)
    got = collect(simhash.near_duplicates(df))
    assert len(got) == len(rows)
    want = brute_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    assert sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got), key=key) == sorted(want, key=key)
    kept = collect(simhash.keep_one(df))
    assert len(kept) == len({f for f in (plain_fingerprint(r["text"]) for r in rows)})
    assert set(kept[0]) == set(df.columns)
    assert collect(simhash.near_duplicates(empty_docs(spark))) == []
    assert collect(simhash.keep_one(empty_docs(spark))) == []


def test_components_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1500)], "u long, v long")
    got = dict(components(edges).collect())
    assert all(got[i] == 0 for i in range(1, 301))
    assert got[2000] == got[1500] == 1000


def test_packed_variants_lie_in_place():
    """Pieces are views of one buffer, read again without a copy; a slice has its own rows only."""
    import pyarrow as pa

    fps = np.random.default_rng(5).integers(0, 1 << 64, 300, dtype=np.uint64)
    b = simhash._emit(fps, 7)
    v, m = simhash._packed(pa.chunked_array([b.column(1)]), np.uint64), simhash._packed(pa.chunked_array([b.column(2)]), np.uint16)
    assert sorted(zip((v ^ simhash.MASKS[m]).tolist(), m.tolist())) == sorted((int(f), k) for f in fps for k in (range(1, 65) if int(f).bit_count() % 2 else range(len(simhash.MASKS))))
    assert not v.flags.owndata
    assert (np.concatenate([np.full(len(x.as_py()) // 8, k) for k, x in zip(b.column(0).to_pylist(), b.column(1))]) == simhash._bucket(v, 7)).all()
    two = simhash._packed(pa.chunked_array([b.column(1).slice(2, 1), b.column(1).slice(4, 2)]), np.uint64)
    assert two.tobytes() == b.column(1)[2].as_py() + b.column(1)[4].as_py() + b.column(1)[5].as_py()


def test_a_bucket_is_compared_in_parts():
    """The working memory of a bucket stays below twice its variants; links are those of the whole."""
    import tracemalloc

    rng = np.random.default_rng(6)
    fps = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    near = np.concatenate([fps, fps[:200] ^ np.uint64(1 << 9), fps[:90] ^ np.uint64((1 << 40) + 6)])
    b = simhash._emit(near, 1)
    v, m = b.column(1)[0].as_buffer(), b.column(2)[0].as_buffer()
    v, m = np.frombuffer(v, np.uint64), np.frombuffer(m, np.uint16)
    tracemalloc.start()
    got = simhash._meet(v, m)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * (v.nbytes + m.nbytes)
    whole = simhash._stars_of(v, m)
    assert {*zip(*map(np.ndarray.tolist, got))} == {*zip(*map(np.ndarray.tolist, whole))} and len(got[0]) >= 290
