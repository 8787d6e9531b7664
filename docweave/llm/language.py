"""Language ID by language-bitmask n-gram filters.

Training counts the 4-byte n-grams of every labelled text (lower-cased, other
ASCII than letters as blanks) per language with a grouped aggregation. The
n-grams that make up at least ``min_share`` of a language are entered in a
bit-sliced Bloom filter: slot s of word w holds one bit for each of 63
languages, so that one look-up (the AND of the slots) returns all languages
that contain an n-gram. A prediction counts, for each language, the n-grams of
the text with its bit set, corrects the count for the language's false-positive
rate, and takes the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
_BLANK = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
#: bytes handled at a time, so that one long text needs no more memory than many short ones
PIECE = 1 << 16
#: distinct n-grams of all languages together that a task holds before they are summed, and after that hands on
HELD = 250_000
#: texts that are Python objects at a time
STEP = 256


def _normal(text: str | None) -> bytes:
    return b"" if text is None else b" " + text.lower().encode("utf-8", "replace").translate(_BLANK) + b" "


def _grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """4-byte codes at each position, and which of them count (no double blank)."""
    a = np.frombuffer(data, np.uint8)
    if len(a) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    w = a.astype(np.uint32)
    code = w[:-3] | (w[1:-2] << 8) | (w[2:-1] << 16) | (w[3:] << 24)
    blank = a == 32
    two = blank[:-1] & blank[1:]
    return code, ~(two[:-2] | two[1:-1] | two[2:])


def _slots(code: np.ndarray, bits: int) -> list[np.ndarray]:
    out = []
    for k in _MIX:
        h = code * np.uint32(k)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits))
    return out


@dataclass(frozen=True)
class LanguageFilter:
    languages: tuple[str, ...]  # in order of frequency, then name
    bits: int
    slots: np.ndarray  # uint64[words of 63 languages, 2 ** bits]
    false_rate: np.ndarray  # per language

    def counts(self, data: bytes) -> tuple[np.ndarray, int]:
        """Per language the n-grams of ``data`` it contains, and all n-grams."""
        hits, n = np.zeros(len(self.languages), np.int64), 0
        for k in range(0, len(data), PIECE):
            code, ok = _grams(data[k : k + PIECE + 3])
            code = code[ok]
            n += len(code)
            slots = _slots(code, self.bits)
            for w, row in enumerate(self.slots):
                mask = row[slots[0]] & row[slots[1]] & row[slots[2]]
                for b in range(min(63, len(self.languages) - 63 * w)):
                    hits[63 * w + b] += np.count_nonzero(mask & (np.uint64(1) << np.uint64(b)))
        return hits, n

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """(language, corrected share of the text's n-grams that it contains, n-grams)."""
        if not self.languages or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0, 0
        hits, n = self.counts(_normal(text))
        if not n:
            return self.languages[0], 0.0, 0
        share = (hits / n - self.false_rate) / (1 - self.false_rate)
        best = int(share.argmax())  # ties: the more frequent language
        return self.languages[best], float(min(1.0, max(0.0, share[best]))), n


def _texts_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """A language with its texts, for some rows of ``(lang, text)`` at a time."""
    for b in batches:
        for k in range(0, len(b), STEP):
            part: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).slice(k, STEP).to_pylist(), b.column(1).slice(k, STEP).to_pylist()):
                part.setdefault(lang, []).append(text)
            yield from part.items()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) sums, flushed whenever the languages together hold many distinct n-grams."""

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        code, inv = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
        return code, np.bincount(inv, np.concatenate([x for _, x in held])).astype(np.int64)

    def rows(lang: str, code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(code), 1 << 16):
            c, x = code[k : k + (1 << 16)], n[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(c)), pa.array(c.astype(np.int64)), pa.array(x)], ["lang", "gram", "n"])

    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size: dict[str, int] = {}
    waiting: dict[str, list[bytes]] = {}
    length: dict[str, int] = {}

    def count(lang: str) -> None:
        data = b" ".join(waiting.pop(lang))  # blanks at the seams: no n-gram across texts
        length[lang] = 0
        for k in range(0, len(data), PIECE):
            code, ok = _grams(data[k : k + PIECE + 3])
            c, n = np.unique(code[ok], return_counts=True)
            held.setdefault(lang, []).append((c, n))
            size[lang] = size.get(lang, 0) + len(c)

    for lang, texts in _texts_by_language(batches):
        for t in texts:
            waiting.setdefault(lang, []).append(_normal(t))
            length[lang] = length.get(lang, 0) + len(waiting[lang][-1])
            if length[lang] < PIECE:
                continue
            count(lang)
            if sum(size.values()) > HELD:
                for x, h in held.items():
                    held[x] = [summed(h)]
                    size[x] = len(held[x][0][0])
                if sum(size.values()) > HELD // 2:
                    for x, h in held.items():
                        yield from rows(x, *h[0])
                    held.clear()
                    size.clear()
    for lang in list(waiting):
        count(lang)
    for lang, h in held.items():
        yield from rows(lang, *summed(h))


def train(docs: DataFrame, min_share: float = 1e-5, bits: int = 21) -> LanguageFilter:
    """Learn from all rows of ``docs(text, lang)`` with neither null.

    Only the filter itself (2 ** bits slots) and one row per language come to
    the driver: an n-gram needs ``min_share`` of its language, so a language
    enters at most 1 / min_share of them.
    """
    spark = docs.sparkSession
    labelled = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        "lang is not null and text is not null"
    )
    counts = (
        labelled.mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # a language whose texts are too short for any n-gram can't be told apart, and isn't learned
    langs = [(r["lang"], r["total"]) for r in totals.orderBy(F.desc("total"), "lang").collect()]
    words = max(1, -(-len(langs) // 63))
    slots = np.zeros((words, 1 << bits), np.uint64)
    if langs:
        number = spark.createDataFrame([(x, i, t) for i, (x, t) in enumerate(langs)], "lang string, number int, total long")
        kept = counts.join(F.broadcast(number), "lang").where(F.col("n") >= F.greatest(F.lit(1.0), min_share * F.col("total")))

        def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                number = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                word, mask = pa.array((number // 63).astype(np.int32)), pa.array(np.int64(1) << (number % 63))
                for s in _slots(b.column(0).to_numpy(zero_copy_only=False).astype(np.uint32), bits):
                    yield pa.RecordBatch.from_arrays([word, pa.array(s.astype(np.int32)), mask], ["word", "slot", "mask"])

        table = (
            kept.select("gram", "number")
            .mapInArrow(enter, "word int, slot int, mask long")
            .groupBy("word", "slot")
            .agg(F.bit_or("mask").alias("mask"))
        )
        got = table.toPandas()
        slots[got["word"].to_numpy(), got["slot"].to_numpy()] = got["mask"].to_numpy().astype(np.uint64)
    filled = np.array([np.count_nonzero(slots[i // 63] & np.uint64(1 << (i % 63))) for i in range(len(langs))], float)
    return LanguageFilter(tuple(x for x, _ in langs), bits, slots, (filled / (1 << bits)) ** len(_MIX))


def _predictor(spark, model: LanguageFilter):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, n_grams long")
    def predict(texts: pa.Array) -> pa.Array:
        m = shared.value
        found = zip(*(m.predict(t.as_py()) for t in texts))
        kinds = {"lang_pred": pa.string(), "score": pa.float64(), "n_grams": pa.int64()}
        columns = list(found) or [()] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds.values())], list(kinds))

    return predict.asNondeterministic()  # evaluated once, also below a filter


def predict(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of these names are replaced).

    ``und`` (score 0) stands for null texts, texts without a letter, and any
    text when no language was learned; a text of one or two letters counts as
    the most frequent language with score 0. lang, source and doc_id are not read.
    """
    found = _predictor(docs.sparkSession, model)(F.col("text").cast("string"))
    other = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*[F.col(f"`{c}`") for c in other], found.alias("__found")).select(
        *[F.col(f"`{c}`") for c in other], F.col("__found.lang_pred"), F.col("__found.score")
    )


def accepted(docs: DataFrame, model: LanguageFilter, min_score: float = 0.2, min_grams: int = 20) -> DataFrame:
    """``docs`` (all columns) without texts in no known language: ``und``, or less
    than ``min_score`` of at least ``min_grams`` n-grams in the language found. A
    text with fewer n-grams tells too little to go."""
    found = _predictor(docs.sparkSession, model)(F.col("text").cast("string"))
    known = f"__found.lang_pred <> '{UNKNOWN}' and (__found.score >= {min_score} or __found.n_grams < {min_grams})"
    return docs.withColumn("__found", found).where(known).drop("__found")
