"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within 3 bits meet on a common variant: one flips at most 2 bits,
the other at most 1 (half the radius, rounded up and down). Which of the two
flips 2 bits is settled by parity, so that no distance is covered twice:

* an odd distance joins an even and an odd fingerprint: the even one flips 0
  or 2 bits, the odd one 1 bit;
* distance 2 joins two fingerprints of one parity: each flips 1 bit.

Of three bits two always lie in the same half of the fingerprint, so the even
side needs only its 992 same-half pairs, not all 2,016. That leaves 1,057
variants of an even and 64 of an odd fingerprint, 560 on average.

Variants travel as packed arrays (8-byte variant, 2-byte mask number) keyed by
a hash bucket; buckets are sized by the number of distinct fingerprints. As
equal fingerprints are merged before, one variant is shared by at most 2,081
fingerprints, so no bucket can become hot whatever the groups of copies are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TOKEN, components, local_components, lower_ascii, popcount, small

SEED = 42
_EVERY = [np.uint64(1) << np.uint64(i) for i in range(64)]
_PAIRS = [_EVERY[i] | _EVERY[j] for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)]
#: mask 0 flips nothing, 1..64 one bit, 65.. two bits of one half
MASKS = np.array([np.uint64(0), *_EVERY, *_PAIRS], dtype=np.uint64)
MAX_DISTANCE = 3
#: a bucket's variants are compared in so many parts, by their hash (a power of two)
PARTS = 8
#: fingerprints whose variants are made at a time
STEP = 1000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of word shingles (repeats count); 0 without words."""
    words = TOKEN.findall(lower_ascii(text))
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=SEED)
    n = len(words) - shingle + 1
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate([[0], np.cumsum(length[:-1] + 1)])
    stop = (start + length)[shingle - 1 :].tolist()
    start = start[:n].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    step = 1 << 16  # shingles unpacked at a time
    for k in range(0, n, step):
        h = np.array([digest(joined[a:b], seed=SEED) for a, b in zip(start[k : k + step], stop[k : k + step])], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` of every row: ``text_key`` tells texts under one
    doc_id apart, ``fp`` is the fingerprint as a signed long."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, len(b)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], ["doc_id", "text_key", "fp"])

    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return narrow.mapInArrow(kernel, "doc_id long, text_key long, fp long")


def _bucket(v: np.ndarray, buckets: int) -> np.ndarray:
    mixed = _mixed(v)
    mixed >>= np.uint64(32)
    mixed %= np.uint64(buckets)
    return mixed.view(np.int64)


def _mixed(v: np.ndarray) -> np.ndarray:
    mixed = v >> np.uint64(31)
    mixed ^= v
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return mixed


def _pieces(values: np.ndarray, starts: np.ndarray) -> pa.BinaryArray:
    """The bytes of an array cut at ``starts``, where they lie."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _emit(fps: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Variants of some fingerprints, packed per bucket."""
    odd = (popcount(fps) & 1).astype(bool)
    n = int(np.sum(~odd)) * len(MASKS) + int(np.sum(odd)) * 64
    v, m, at = np.empty(n, np.uint64), np.empty(n, np.uint16), 0
    for part, masks in ((fps[~odd], np.arange(len(MASKS), dtype=np.uint16)), (fps[odd], np.arange(1, 65, dtype=np.uint16))):
        shape = len(part), len(masks)
        here = slice(at, at + len(part) * len(masks))
        np.bitwise_xor(part[:, None], MASKS[masks][None, :], out=v[here].reshape(shape))
        m[here].reshape(shape)[:] = masks
        at = here.stop
    key = _bucket(v, buckets)
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.diff(key, prepend=-1))
    v, m = v[order], m[order]
    return pa.RecordBatch.from_arrays([pa.array(key[cut]), _pieces(v, cut), _pieces(m, cut)], ["bucket", "variants", "masks"])


def _packed(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The numbers packed in a binary column, one after the other."""
    parts = []
    for c in column.chunks:
        wide = np.int64 if pa.types.is_large_binary(c.type) else np.int32
        offsets = np.frombuffer(c.buffers()[1], wide)[c.offset : c.offset + len(c) + 1]
        parts.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind) if len(c) and c.buffers()[2] else np.empty(0, kind))
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, kind)


def _meet(variants: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints that share a variant, found part by part of
    the variants, so that only a part is sorted and copied at a time."""
    # bits that the bucket does not fix
    part = _mixed(variants)
    part >>= np.uint64(8)
    part &= np.uint64(PARTS - 1)
    part = part.astype(np.uint8)
    found = []
    for k in range(PARTS):
        here = np.flatnonzero(part == k)
        found.append(_stars_of(variants[here], masks[here]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _stars_of(variants: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints that share a variant: a star per variant.

    At a variant of even parity the centre must be a fingerprint one bit away
    (an odd one): it is within 3 bits of all that meet there. At a variant of
    odd parity all that meet are one bit away, so any may be the centre.
    """
    order = np.argsort(variants, kind="stable")
    v, m = variants[order], masks[order]
    shared = np.zeros(len(v), bool)
    same = v[1:] == v[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    v, m = v[shared], m[shared]
    if not len(v):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    fp = v ^ MASKS[m]
    run = np.cumsum(np.concatenate([[0], (v[1:] != v[:-1]).astype(np.int64)]))
    centre = (m >= 1) & (m <= 64)
    root = np.full(run[-1] + 1, np.iinfo(np.uint64).max, np.uint64)
    has = np.zeros(run[-1] + 1, bool)
    np.minimum.at(root, run[centre], fp[centre])
    has[run[centre]] = True
    ok = has[run]
    a, b = fp[ok], root[run[ok]]
    different = a != b
    pairs = np.unique(np.stack([a[different], b[different]], axis=1), axis=0)
    near = popcount(pairs[:, 0] ^ pairs[:, 1]) <= MAX_DISTANCE  # verify every pair that met
    return pairs[near, 0], pairs[near, 1]


def links(distinct: DataFrame, fingerprints_count: int, entries_per_bucket: int = 2_000_000) -> DataFrame:
    """Spanning links ``(u, v)`` between distinct fingerprints (signed longs) at
    most 3 bits apart; every pair that close is connected through them."""
    buckets = max(1, -(-fingerprints_count * 560 // entries_per_bucket))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(fps), STEP):
                yield _emit(fps[k : k + STEP], buckets)

    def meet(group: pa.Table) -> pa.Table:
        a, b = _meet(_packed(group["variants"], np.uint64), _packed(group["masks"], np.uint16))
        if len(a):
            a, b = local_components(a, b)
        return pa.table({"u": a.view(np.int64), "v": b.view(np.int64)})

    # a bounded number of fingerprints for each task, whatever the partitions before
    packed = distinct.select("fp").repartition(buckets, "fp").mapInArrow(emit, "bucket long, variants binary, masks binary")
    return packed.groupBy("bucket").applyInArrow(meet, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp, component_id)`` for every row of ``docs(doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id reachable over links of at most 3
    differing bits. Null and wordless texts have fingerprint 0 and link like
    any other; rows with a null doc_id take part but are never the smallest;
    repeated rows get equal answers; an empty table gives an empty result.
    Extra columns are ignored.
    """
    fps = fingerprints(docs, shingle).checkpoint()  # three uses below; texts are read once
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low")).checkpoint()
    roots = components(links(distinct, distinct.count()))
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = labelled.select("fp", "root").join(smallest, "root").select("fp", F.col("root").alias("component"), "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest
    doc_id (nulls last; among several texts under it, one fixed choice). All columns stay."""
    found = near_duplicates(docs, shingle)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    keep = (
        found.groupBy("component", "doc_id", "text_key")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("component")
        .agg(F.min(F.struct(*[first.getField(c).alias(c) for c in ("no_id", "doc_id", "text_key")], "copies")).alias("k"))
        .select(F.col("k.doc_id").alias("__id"), F.col("k.text_key").alias("__key"), F.col("k.copies").alias("__copies"))
        .checkpoint()
    )

    def chosen(which: DataFrame) -> DataFrame:
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
        # texts are shuffled only when the list of kept documents is too long to broadcast
        return docs.join(small(which, 40 * kept), same, "left_semi")

    kept = keep.count()
    one = chosen(keep.where("__copies = 1"))
    repeated = keep.where("__copies > 1")
    if not repeated.take(1):
        return one
    # whole rows repeat: one of them stays
    tagged = chosen(repeated).withColumn("__id", F.col("doc_id").cast("long")).withColumn("__key", F.xxhash64(F.col("text").cast("string")))
    return one.unionByName(tagged.dropDuplicates(["__id", "__key"]).drop("__id", "__key"))
