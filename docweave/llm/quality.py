"""Document quality by hierarchical empirical Bayes.

A document classifier (logistic regression over word presence and text shape,
fitted on a bounded sample of labelled rows) gives each document its own
evidence. Hosts and paths add theirs: the mean of a host is shrunk towards the
global mean, that of a path towards its host, with prior strengths estimated by
the method of moments over all documents. A document's own part is taken out
before its site's mean is used. All sums are grouped aggregations that combine
before the shuffle, so one host may hold any share of the rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
#: labelled rows the classifier is fitted on at most (those with the smallest hash of doc_id)
MAX_TRAIN = 3_000
#: a word feature must occur in so many of them, and so many standard
#: deviations more or less often with the label than by chance
MIN_DOCS, MIN_DEVIATION = 5, 5.0
#: besides whole words, beginnings of so many letters are features
STEMS = (5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHAPES = 10


def _number(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & (BUCKETS - 1)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words and word beginnings, the logarithms of their counts, and shape values in 0..1."""
    text = text or ""
    words = _WORD.findall(text.lower())
    counts = Counter(words)
    hashed: dict[int, int] = {}
    for w, c in counts.items():
        for part in {w, *(w[:k] + "*" for k in STEMS if len(w) >= k)}:
            h = _number(part)
            hashed[h] = hashed.get(h, 0) + c
    n, chars = len(words), len(text)
    letters = sum(map(len, words))
    lines = text.split("\n")
    bytes_ = text.encode("utf-8", "replace")
    punct = len(bytes_) - len(bytes_.translate(None, b"#$%&*|=<>{}[]~^@!\\/"))
    shape = [
        min(1.0, np.log1p(n) / 10),
        len(counts) / n if n else 0.0,
        min(1.0, punct / (n + 1)),
        letters / chars if chars else 0.0,
        min(1.0, letters / n / 20) if n else 0.0,
        1 - len(set(lines)) / len(lines),
        float(text[-1:] in (".", "!", "?")),
        min(1.0, len(lines) / (n + 1) * 10),
        len(_UPPER.findall(text)) / chars if chars else 0.0,
        sum(map(eq, words, words[1:])) / n if n else 0.0,
    ]
    values = np.fromiter(hashed.values(), float, len(hashed))
    return np.fromiter(hashed, np.int64, len(hashed)), np.log1p(values), np.array(shape)


@dataclass(frozen=True)
class Logistic:
    words: np.ndarray
    shapes: np.ndarray
    bias: float

    def probability(self, words: np.ndarray, counts: np.ndarray, shape: np.ndarray) -> float:
        z = self.bias + float(self.words[words] @ counts) + float(shape @ self.shapes)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_logistic(rows: list[np.ndarray], counts: list[np.ndarray], shapes: np.ndarray, y: np.ndarray, rounds: int = 500, ridge: float = 1e-4) -> Logistic:
    """Full-batch Adagrad on the logistic loss, with a penalty on the weights, over
    the shape values and the words that go with the label beyond chance."""
    n = len(y)
    rate = float(y.mean()) if n else 0.5
    bias0 = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    w, s, b = np.zeros(BUCKETS), np.zeros(SHAPES), bias0
    if n == 0 or rate in (0.0, 1.0):
        return Logistic(w, s, b)
    flat, value = np.concatenate(rows), np.concatenate(counts)
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    held, positive = np.bincount(flat, minlength=BUCKETS), np.bincount(flat, y[doc], BUCKETS)
    deviation = np.abs(positive - held * rate) / np.sqrt(held * rate * (1 - rate) + 1)
    telling = ((held >= MIN_DOCS) & (deviation >= MIN_DEVIATION))[flat]
    flat, value, doc = flat[telling], value[telling], doc[telling]
    used, flat = np.unique(flat, return_inverse=True)
    v = np.zeros(len(used))
    gw, gs, gb = np.full(len(used), 1e-8), np.full(SHAPES, 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(doc, v[flat] * value, n) + shapes @ s
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        dw = np.bincount(flat, error[doc] * value, len(used)) + ridge * v
        ds, db = shapes.T @ error, error.sum()
        gw += dw * dw
        gs += ds * ds
        gb += db * db
        v -= 0.1 * dw / np.sqrt(gw)
        s -= 0.5 * ds / np.sqrt(gs)
        b -= 0.1 * db / np.sqrt(gb)
    w[used] = v
    return Logistic(w, s, float(b))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> dict[str, Logistic]:
    """Classifiers for ``quality`` and ``toxic`` from at most ``max_train``
    labelled rows: those whose doc_id hashes lowest, whatever the input's size."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .where("doc_id is not null and quality is not null and toxic is not null")
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [features(t) for t in f["text"]]
            columns = {"words": [g[0].astype(np.int32) for g in got], "counts": [g[1].astype(np.float32) for g in got], "shapes": [g[2] for g in got]}
            yield pd.DataFrame({"doc_id": f["doc_id"], **columns, "quality": f["quality"], "toxic": f["toxic"]})

    # at most max_train rows of three numbers: a bounded broadcast
    sample = narrow.join(F.broadcast(chosen), "doc_id").mapInPandas(
        extract, "doc_id long, words array<int>, counts array<float>, shapes array<double>, quality int, toxic int"
    )
    got = sample.toPandas().sort_values("doc_id", kind="stable")
    rows = [np.asarray(w, np.int32) for w in got["words"]]
    counts = [np.asarray(c, np.float32) for c in got["counts"]]
    shapes = np.stack(got["shapes"].to_list()) if len(got) else np.zeros((0, SHAPES))
    targets = {k: (got[k].to_numpy() > 0).astype(float) for k in ("quality", "toxic")}
    del got
    return {k: fit_logistic(rows, counts, shapes, y) for k, y in targets.items()}


def host_of(source: Column) -> Column:
    """Host of a source or URL: what comes before the first slash, without a scheme; null counts as ''."""
    return F.coalesce(F.regexp_extract(source.cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/]*)", 1), F.lit(""))


def path_of(source: Column) -> Column:
    """First path segment of a source or URL, or ''."""
    return F.coalesce(F.regexp_extract(source.cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/]*/+([^/?#]*)", 1), F.lit(""))


def evidence(docs: DataFrame, models: dict[str, Logistic]) -> DataFrame:
    """``(doc_id, host, path, doc_quality, doc_toxic)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("doc_quality double, doc_toxic double")
    def score(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        got = [features(t) for t in texts]
        return pd.DataFrame({f"doc_{k}": [m[k].probability(*g) for g in got] for k in ("quality", "toxic")}, columns=["doc_quality", "doc_toxic"])

    source = F.col("source") if "source" in docs.columns else F.lit(None)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        host_of(source).alias("host"),
        path_of(source).alias("path"),
        score.asNondeterministic()(F.col("text").cast("string")).alias("s"),
    ).select("doc_id", "host", "path", "s.doc_quality", "s.doc_toxic")


def _strength(mean: Column, prior: Column, n: Column) -> Column:
    """Prior strength (in documents) from the spread of group means around their
    prior: noise p(1-p)/n is taken off the observed spread; an aggregate."""
    noise = F.avg(prior * (1 - prior) / n)
    spread = F.avg((mean - prior) * (mean - prior))
    between = F.greatest(spread - noise, F.lit(1e-6))
    return F.least(F.greatest(F.avg(prior * (1 - prior)) / between - 1, F.lit(1.0)), F.lit(1e6))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """``(host, path, n_host, n_path, ...)``: sums, prior strengths and the global
    mean of both targets, one row per path."""
    kinds = ("quality", "toxic")
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"), *[F.sum(f"doc_{k}").alias(f"sum_path_{k}") for k in kinds])
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), *[F.sum(f"sum_path_{k}").alias(f"sum_host_{k}") for k in kinds])
    world = hosts.agg(*[(F.sum(f"sum_host_{k}") / F.sum("n_host")).alias(f"mean_{k}") for k in kinds])
    hosts = hosts.join(F.broadcast(world))  # one row
    strengths = hosts.agg(*[_strength(F.col(f"sum_host_{k}") / F.col("n_host"), F.col(f"mean_{k}"), F.col("n_host")).alias(f"strength_host_{k}") for k in kinds])
    hosts = hosts.join(F.broadcast(strengths))  # one row
    sites = paths.join(hosts, "host")
    post = {k: (F.col(f"strength_host_{k}") * F.col(f"mean_{k}") + F.col(f"sum_host_{k}")) / (F.col(f"strength_host_{k}") + F.col("n_host")) for k in kinds}
    strengths = sites.agg(*[_strength(F.col(f"sum_path_{k}") / F.col("n_path"), post[k], F.col("n_path")).alias(f"strength_path_{k}") for k in kinds])
    return sites.join(F.broadcast(strengths))  # one row


def classify(docs: DataFrame, models: dict[str, Logistic], min_quality: float = 0.5, max_toxic: float = 0.5) -> DataFrame:
    """``(doc_id, host, path, doc_quality, host_quality, path_quality, p_quality,
    doc_toxic, p_toxic, keep)`` for every row of ``docs(doc_id, text, source)``.

    Host and path means are those of the other documents there, so a lone
    document falls back to its host, and a lone host to the global mean. A null
    source is host '' and path ''. Null and empty texts are scored by their
    empty features. Repeated rows are scored alike and count each; an empty
    table gives an empty result; extra columns are ignored.
    """
    scored = evidence(docs, models).checkpoint()  # the texts are read once
    joined = scored.join(site_posteriors(scored), ["host", "path"])
    out = joined
    for k in ("quality", "toxic"):
        own, mean = F.col(f"doc_{k}"), F.col(f"mean_{k}")
        a, b = F.col(f"strength_host_{k}"), F.col(f"strength_path_{k}")
        out = (
            out.withColumn(f"host_{k}", (a * mean + F.col(f"sum_host_{k}") - own) / (a + F.col("n_host") - 1))
            .withColumn(f"path_{k}", (b * F.col(f"host_{k}") + F.col(f"sum_path_{k}") - own) / (b + F.col("n_path") - 1))
            .withColumn(f"z_{k}", _logit(own) + _logit(F.col(f"path_{k}")) - _logit(mean))
            .withColumn(f"p_{k}", 1 / (1 + F.exp(-F.col(f"z_{k}"))))
        )
    return out.select(
        "doc_id", "host", "path", "doc_quality", "host_quality", "path_quality", "p_quality", "doc_toxic", "p_toxic",
        ((F.col("p_quality") >= min_quality) & (F.col("p_toxic") < max_toxic)).alias("keep"),
    )
