"""Small tables for the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema=DOCS):
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "plain text with seven words in it", "en", "a/b", 33),
        (1, "plain text with seven words in it", "en", "a/b", 33),
        (1, "another text under the same id entirely", "en", None, None),
        (None, "plain text with seven words in it", None, "a", 1),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (7, "", "en", "", 0),
        (8, " \n\t \n", "en", "a", 5),
        (9, None, "en", "a", None),
        (10, long, "en", "a", len(long)),
        (-3, "Ünïcödé — ß 漢字 😀 text", "de", "b", 20),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng: random.Random, n: int, vocabulary: int = 300) -> list[str]:
    # common words are drawn more often
    return [f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n)]


def collect(df):
    return [r.asDict(recursive=True) for r in df.collect()]
