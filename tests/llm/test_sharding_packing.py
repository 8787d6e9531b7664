import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, collect, docs, empty_docs, odd_docs, prose

from docweave.llm import packing, sharding


def test_pack_vectors_follows_the_dot_product():
    rng = np.random.default_rng(2)
    v = rng.random((200, 3)) * [1000, 200, 1]
    got = sharding.pack_vectors(v, 7)
    share = v / (v.sum(axis=0) / 7)
    residual = np.ones((7, 3))
    for i in sorted(range(200), key=lambda i: (-share[i].max(), i)):
        dots = [float(residual[b] @ share[i]) for b in range(7)]
        assert dots[got[i]] >= max(dots) - 1e-12
        residual[got[i]] -= share[i]


def check_shards(rows, texts, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert all(0 <= r["shard"] < shards for r in rows)


def test_shards_are_even(spark):
    rng = random.Random(5)
    texts = [" ".join(prose(rng, rng.randrange(20, 200))) for _ in range(1500)]
    texts += [texts[0]] * 700 + [texts[1]] * 3
    for units in (20_000, 100):  # one level, and several
        rows = collect(sharding.shard(docs(spark, texts), 8, block_units=units, fan_in=4, cell_rows=50))
        check_shards(rows, list(enumerate(texts)), 8)
        size = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
        n = Counter(r["shard"] for r in rows)
        assert max(size) / min(size) < 1.05, size
        assert max(n.values()) / min(n.values()) < 1.1, n
        # a small group stays whole, a third of all rows does not
        small = {r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(texts[1].encode())}
        large = {r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(texts[0].encode())}
        assert len(small) == 1 and len(large) == 8


def test_shard_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "1 AS size", "2 AS unit", "3 AS shard")
    rows = collect(sharding.shard(df, 4))
    check_shards(rows, [(r["doc_id"], r["text"]) for r in collect(df)], 4)
    assert collect(sharding.shard(empty_docs(spark), 4)) == []


def plain_best_fit(pieces, capacity):
    bins, out = [], []
    for size, s, c in pieces:
        fit = [(b[0], i) for i, b in enumerate(bins) if b[0] >= size and b[0] > 0 and not (s & b[1]) and not (c & b[2])]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([capacity, 0, 0])
        out.append((i, capacity - bins[i][0]))
        bins[i] = [bins[i][0] - size, bins[i][1] | s, bins[i][2] | c]
    return out


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(9)
    for _ in range(30):
        pieces = sorted(((rng.randrange(0, 60), 1 << rng.randrange(6) if rng.random() < 0.8 else 0, 1 << rng.randrange(30)) for _ in range(120)), key=lambda p: -p[0])
        assert packing.best_fit(pieces, 60) == plain_best_fit(pieces, 60)


def check_packing(rows, texts, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["block"], r["bin"]].append(r)
    for held in bins.values():
        assert sum(r["n_tokens"] for r in held) <= capacity
        reach = 0
        for r in sorted(held, key=lambda r: (r["offset"], r["n_tokens"])):
            assert r["offset"] == reach
            reach += r["n_tokens"]
        named = [r["source"] for r in held if r["source"] is not None]
        assert len(named) == len(set(named))
        assert len({r["cluster"] for r in held}) == len(held)
    want, got = Counter(), Counter()
    for i, t in texts:
        n = len((t or "").split())
        want[i] += n
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
    assert got == want


def test_packing(spark):
    rng = random.Random(11)
    texts = [" ".join(prose(rng, rng.randrange(0, 300))) for _ in range(400)] + [" ".join(["x"] * 2000), " ".join(["y"] * 256)]
    texts += [texts[3]] * 50
    df = docs(spark, texts)
    for block in (4096, 60):
        packed = packing.pack(df, 256, block_docs=block)
        rows = collect(packed)
        check_packing(rows, list(enumerate(texts)), 256)
        text = {(r["block"], r["bin"]): r for r in collect(packing.sequences(packed, df))}
        assert Counter(w for r in text.values() for w in r["text"].split()) == Counter(w for t in texts for w in t.split())
        assert all(len(r["text"].split()) == r["n_tokens"] for r in text.values())


def test_packing_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "1 AS bin", "2 AS n_tokens", "3 AS block", "4 AS row", "'k' AS cluster")
    rows = collect(packing.pack(df, 512))
    check_packing(rows, [(r["doc_id"], r["text"]) for r in collect(df)], 512)
    assert collect(packing.pack(empty_docs(spark), 512)) == []


@pytest.mark.parametrize("doc_id", [None, 5])
def test_large_group_of_one_doc_id_is_split(spark, doc_id):
    """Equal texts that also share their doc_id, or have none, are spread like any other."""
    rows = [(doc_id, "same words here", "en", "s", 15)] * 300 + [(i, f"text number {i:04d}", "en", "s", 16) for i in range(700)]
    placed = collect(sharding.shard(spark.createDataFrame(rows, DOCS), 8))
    sizes = [sum(r["size"] for r in placed if r["shard"] == s) for s in range(8)]
    assert len(placed) == 1000 and max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 8 + 64
    for s in range(8):
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(sum(r["shard"] == s for r in placed)))
