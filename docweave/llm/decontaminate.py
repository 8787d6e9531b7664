"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items. For the patterns of one length
m a shift table tells, for each block of two consecutive words, how far the
search may move on; a block in no pattern skips m - 1 words. Where the shift is
zero, the bucket of that suffix block lists the patterns that end there, and a
direct comparison confirms each.

The pattern tables go to the tasks in chunks of bounded size; a benchmark
beyond one chunk is searched chunk by chunk, so nothing that grows is broadcast.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, lower_ascii

WINDOW = 10
#: benchmark text per broadcast chunk, in bytes
CHUNK_BYTES = 2_000_000


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(lower_ascii(text))


class PatternTables:
    """Wu-Manber tables for every pattern length."""

    def __init__(self, items: Iterable[tuple[int, str | None]], window: int = WINDOW):
        owners: dict[int, dict[tuple[bytes, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            m = min(window, len(words))
            for k in range(len(words) - m + 1 if m else 0):
                owners[m][tuple(words[k : k + m])].add(item)
        self.by_length = []
        for m, patterns in sorted(owners.items()):
            block = min(2, m)
            shift: dict[bytes, int] = {}
            suffix: dict[bytes, list[tuple[list[bytes], tuple[int, ...]]]] = defaultdict(list)
            for p, items_of in patterns.items():
                for end in range(block, m + 1):
                    key = b" ".join(p[end - block : end])
                    shift[key] = min(shift.get(key, m), m - end)
                suffix[b" ".join(p[m - block :])].append((list(p), tuple(items_of)))
            self.by_length.append((m, block, shift, dict(suffix)))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words (start, end exclusive) that are occurrences, and their items."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        n = len(words)
        for m, block, shift, suffix in self.by_length:
            far = m - block + 1
            move = shift.get
            i = m - 1
            while i < n:
                key = words[i - 1] + b" " + words[i] if block == 2 else words[i]
                s = move(key, far)
                if s:
                    i += s
                    continue
                for p, owner in suffix[key]:
                    if words[i - m + 1 : i + 1] == p:
                        spans.append((i - m + 1, i + 1))
                        items.update(owner)
                i += 1
        return spans, items


def covered(spans: list[tuple[int, int]]) -> int:
    """Number of words in the union of spans."""
    total, reach = 0, 0
    for a, z in sorted(spans):
        if z > reach:
            total += z - max(a, reach)
            reach = z
    return total


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def digest(items: Iterable[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _chunks(benchmark: DataFrame, chunk_bytes: int) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark's items in driver-side chunks whose text is bounded in bytes."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
    part: list[tuple[int, str | None]] = []
    held = 0
    for item, text in items.toLocalIterator():
        size = len((text or "").encode("utf-8", "replace"))
        if part and held + size > chunk_bytes:
            yield part
            part, held = [], 0
        part.append((item, text))
        held += size
    if part:
        yield part


def _search(docs: DataFrame, items: list[tuple[int, str | None]], window: int) -> DataFrame:
    tables = docs.sparkSession.sparkContext.broadcast(items)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = PatternTables(tables.value, window)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text in b.column(2):
                words = words_of(text.as_py())
                spans, hit = found.search(words)
                out[0].append(len(words))
                out[1].append(covered(spans))
                out[2].append([{"start": a, "stop": z} for a, z in merged(spans)])
                out[3].append(sorted(hit))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), span, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(x, k) for x, k in zip(out, kinds)]],
                ["doc_id", "text_key", "n_words", "n_hit", "spans", "items"],
            )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(
        kernel,
        "doc_id long, text_key long, n_words long, n_hit long, spans array<struct<start:long,stop:long>>, items array<long>",
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, spans, items)`` for every row of ``docs``.

    ``spans`` are the merged hit word ranges, ``items`` the benchmark items with
    a window in the text. Null and wordless texts have no words and no hits;
    items without words or without an id have no window; repeated rows get
    equal answers; an empty benchmark hits nothing; extra columns are ignored.
    """
    parts = [_search(docs, c, window) for c in _chunks(benchmark, chunk_bytes)]
    if len(parts) <= 1:
        return parts[0] if parts else _search(docs, [], window)
    one = parts[0]
    for p in parts[1:]:
        one = one.unionByName(p)
    # several chunks: unite the spans and items of a document (rows that repeat keep their number)
    return (
        one.groupBy("doc_id", "text_key", "n_words")
        .agg(
            F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
        )
        .withColumn("spans", _merge_spans("spans"))
        .withColumn("n_hit", F.expr("aggregate(spans, 0L, (s, x) -> s + x.stop - x.start)"))
        .withColumn("copies", F.explode(F.expr("sequence(1, copies)")))
        .select("doc_id", "text_key", "n_words", "n_hit", "spans", "items")
    )


def _merge_spans(col: str):
    @F.pandas_udf("array<struct<start:long,stop:long>>")
    def unite(spans):
        return spans.map(lambda v: [{"start": a, "stop": z} for a, z in merged([(x["start"], x["stop"]) for x in v])])

    return unite(F.col(col))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` (all columns) without the rows that hold a benchmark window: one
    pass over the texts per benchmark chunk, no shuffle."""
    out = docs
    for items in _chunks(benchmark, chunk_bytes):
        tables = docs.sparkSession.sparkContext.broadcast(items)

        def free(texts, tables=tables):
            import pandas as pd

            found = PatternTables(tables.value, window)
            return pd.Series([not found.search(words_of(t))[0] for t in texts], dtype=bool)

        out = out.where(F.pandas_udf(free, "boolean")(F.col("text").cast("string")))
    return out
