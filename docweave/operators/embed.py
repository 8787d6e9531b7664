"""Vectors for chunks and questions.

Default: feature hashing as a column expression (JVM-side). Hook: any
``pandas_udf`` returning array<float> (Arrow batches), e.g. a local model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.vectors import hashed_embedding
from docweave.options import JobOptions

Embedder = Callable[[Column], Column]


def default_embedder(opts: JobOptions) -> Embedder:
    return lambda c: hashed_embedding(c, opts.embed_dim)


def embed_chunks(chunks: DataFrame, opts: JobOptions, embedder: Embedder | None = None, text: str = "text", out: str = "vector") -> DataFrame:
    """Adds the vector column (once per chunk)."""
    e = embedder or default_embedder(opts)
    return chunks.withColumn(out, e(F.col(text)))


def embed_questions(questions: DataFrame, opts: JobOptions, embedder: Embedder | None = None, text: str = "question") -> DataFrame:
    """The same vector space for questions."""
    return embed_chunks(questions, opts, embedder, text=text, out="qvec")


def pandas_embedder(fn, dim: int) -> Embedder:
    """Wrap a ``pandas.Series[str] -> pandas.Series[list[float]]`` function as an
    Arrow-batched UDF hook."""
    import pandas as pd

    @F.pandas_udf("array<float>")
    def _udf(s: pd.Series) -> pd.Series:
        return fn(s)

    return lambda c: _udf(c)
