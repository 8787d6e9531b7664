"""Vector functions: F13 distances and the E1 feature-hashing embedding,
all as higher-order column expressions accumulated in DOUBLE."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.arrow import STEP_ROWS
from docweave.functions.regex import sql_lit

EMBED_TOKEN_RE = "[\\p{L}\\p{N}]+"
EMBED_TOKEN_RE_SQL = "[\\pL\\pN]+"

# Metric names as they are spelled; every other spelling is L2.
METRIC_NAMES = {"L2": "L2", "IP": "IP", "INNER_PRODUCT": "IP", "COSINE": "COSINE"}


def normalise_metric(metric: str | None) -> str:
    """L2, IP or COSINE; names are matched as spelled and unknown ones are L2."""
    return METRIC_NAMES.get(metric or "L2", "L2")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def _sqdiff(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
        F.lit(0.0),
        lambda s, v: s + v,
    )


def distance(a, b, metric: str = "L2") -> Column:
    """L2 distance, negated inner product, or cosine distance (smaller = nearer)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    m = normalise_metric(metric)
    if m == "IP":
        return -_dot(a, b)
    if m == "COSINE":
        return F.lit(1.0) - _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))
    return F.sqrt(_sqdiff(a, b))


def _sum_sql(list_expr: str) -> str:
    return f"list_reduce({list_expr}, lambda s, v: s + v, 0.0::DOUBLE)"


def distance_sql(a: str, b: str, metric: str = "L2") -> str:
    m = normalise_metric(metric)
    dot = lambda x, y: _sum_sql(f"list_transform(list_zip({x}, {y}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)")
    if m == "IP":
        return f"(-{dot(a, b)})"
    if m == "COSINE":
        return f"(1.0 - {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))"
    sq = _sum_sql(f"list_transform(list_zip({a}, {b}), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))")
    return f"sqrt({sq})"


def hashed_embedding(text, dim: int = 64) -> Column:
    """E1 default: lower-case word runs hashed to ``dim`` buckets by the first 32
    bits of their MD5, counted, and L2-normalised (zero vector for no words).

    One pass over the words whatever ``dim`` is: the words become bucket numbers
    in the JVM, an Arrow UDF counts and normalises them batch by batch.
    """
    t = F.col(text) if isinstance(text, str) else text
    toks = F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(EMBED_TOKEN_RE), 0)
    buckets = F.transform(toks, lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int"))
    return _counter(dim)(buckets)


def bucket_vectors(buckets: pa.ListArray, dim: int) -> pa.ListArray:
    """The counted and L2-normalised buckets of every row, STEP_ROWS rows at a time."""
    out = np.empty((len(buckets), dim), np.float32)
    for at in range(0, len(buckets), STEP_ROWS):
        some = buckets.slice(at, STEP_ROWS)
        row = np.repeat(np.arange(len(some)), some.value_lengths().to_numpy(zero_copy_only=False))
        numbers = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        c = np.bincount(row * dim + numbers, minlength=len(some) * dim).astype(np.float64).reshape(-1, dim)
        norm = np.sqrt((c * c).sum(axis=1, keepdims=True))
        out[at : at + len(some)] = c / np.where(norm > 0, norm, 1.0)
    return pa.ListArray.from_arrays(np.arange(0, out.size + 1, dim, dtype=np.int32), out.ravel())


def _counter(dim: int):
    @F.arrow_udf("array<float>")
    def count(buckets: pa.Array) -> pa.Array:
        return bucket_vectors(buckets, dim)

    return count


def hashed_embedding_sql(e: str, dim: int = 64) -> str:
    toks = f"regexp_extract_all(lower(coalesce({e}, '')), {sql_lit(EMBED_TOKEN_RE_SQL)})"
    buckets = f"list_transform({toks}, lambda w: (('0x' || substr(md5(w), 1, 8))::BIGINT % {dim}))"
    counts = f"list_transform(range({dim}), lambda i: len(list_filter({buckets}, lambda b: b = i))::DOUBLE)"
    return (
        f"(SELECT list_transform(c, lambda v: (CASE WHEN n > 0 THEN v / n ELSE 0.0 END)::FLOAT) "
        f"FROM (SELECT c, sqrt({_sum_sql('list_transform(c, lambda v: v * v)')}) AS n FROM (SELECT {counts} AS c)))"
    )
