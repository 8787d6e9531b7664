"""Batch retrieval over tables of questions: E4 lexical score, L3 rerank, E5
retrieve, O1 result order, F10 request normalisation, W2 prompt budget, F12
blocks, E6 prompts, E7/A5 usage, E8 document lookup."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docweave.functions.text import format_doc_block, metadata_text, scrub_question
from docweave.functions.tokens import token_count
from docweave.functions.vectors import EMBED_TOKEN_RE
from docweave.operators.embed import embed_questions
from docweave.operators.knn import knn_exact
from docweave.options import NO_DOCS_TEXT, JobOptions

# Own wording of the prompt texts (option strings).
DEFAULT_SYSTEM_PROMPT = "Answer the questions with the documentation excerpts given below; say so when they do not cover it."
DEFAULT_USER_TEMPLATE = "Questions: {questions}\nContext: {context}\nDocumentation:{docs}"

BM25_K1 = 1.2
BM25_B = 0.75
#: pairs of one chunk that are scored in one place
PAIRS = 1024
QKEY = ["request_id", "q_no"]
CKEY = ["filename", "chunk_no"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(EMBED_TOKEN_RE), 0)


# ------------------------------------------------------------------ F10

def normalise_requests(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(request_id, q_no, question, context) -> (accepted, rejected).

    Empty / absent context -> the request's first question. Requests with no
    non-empty question go to the reject output."""
    w = Window.partitionBy("request_id")
    ok = F.col("question").isNotNull() & (F.col("question") != "")
    q = questions.withColumn("_valid", F.max(ok.cast("int")).over(w))
    first_q = F.first("question").over(w.orderBy("q_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ctx = F.coalesce(F.nullif(F.col("context"), F.lit("")), first_q)
    accepted = q.where(F.col("_valid") == 1).select("request_id", "q_no", "question", ctx.alias("context"))
    rejected = q.where(F.col("_valid") == 0).select("request_id").distinct().withColumn(
        "error", F.lit("a request needs at least one question that is not empty")
    )
    return accepted, rejected


# ------------------------------------------------------------------ E4 / L3

def chunk_lengths(chunks: DataFrame) -> DataFrame:
    """One row: number of chunks and their mean length in words."""
    return chunks.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.size(words(F.col("text")))).alias("avgdl"))


def term_frequencies(chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """(term, df) of the terms of the questions only: a chunk is cut down to the
    question terms it has by a semi join before anything is counted, and the
    counts are combined before the shuffle, so a common term is one row per task."""
    terms = questions.select(F.explode(F.array_distinct(words(F.col("question")))).alias("term")).distinct()
    have = chunks.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return have.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(terms, "term", "left_semi")


def term_index(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """BM25 statistics of a whole chunk table, (term, df) and one row (n_docs,
    avgdl): written next to the chunk table when that is written, and read by
    every batch of questions."""
    have = chunks.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return have.groupBy("term").agg(F.count(F.lit(1)).alias("df")), chunk_lengths(chunks)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _occurrences(sorted_words: pd.Series, terms: pd.Series) -> pd.Series:
    """How often each term is among a chunk's sorted words."""
    out = [None if w is None or t is None else np.searchsorted(w, t, "right") - np.searchsorted(w, t, "left") for w, t in zip(sorted_words, terms)]
    return pd.Series(out, dtype=object)


def lexical_score(pairs: DataFrame, questions: DataFrame, chunks: DataFrame, index=None) -> DataFrame:
    """BM25 score of each (question, chunk) candidate pair; 0 when no term is
    shared. ``index``: a stored ``term_index`` (else derived here).

    The words of a chunk become sorted 64-bit hashes once per chunk; a pair looks up
    the question's terms in them, and its score is one expression in its row. No
    row per (chunk, term) is made, and a question's terms carry their document
    frequencies as one array, so no term is a join key of the pairs."""
    dfreq, coll = index if index is not None else (term_frequencies(chunks, questions), chunk_lengths(chunks))
    per_term = questions.select(*QKEY, F.explode(F.array_distinct(words(F.col("question")))).alias("term")).join(dfreq, "term")
    number = F.xxhash64("term")
    terms = per_term.groupBy(*QKEY).agg(F.collect_list(F.struct(number.alias("term"), "df")).alias("_terms"))
    # a chunk near to very many questions is dealt to several tasks, PAIRS of its pairs each
    parts = pairs.groupBy(*CKEY).agg(F.ceil(F.count(F.lit(1)) / PAIRS).cast("int").alias("_parts"))
    texts = chunks.select(*CKEY, "text").join(parts, CKEY)
    # the collection statistics are one row, joined as such; they meet the chunks, which are fewer than the pairs
    numbers = F.array_sort(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))
    texts = texts.select(*CKEY, numbers.alias("_words"), "_parts").join(F.broadcast(coll))
    texts = texts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    # the words of a chunk are shuffled once a part, not per pair
    dealt = pairs.join(parts, CKEY, "left").withColumn("_part", F.pmod(F.xxhash64(*QKEY), F.col("_parts")).cast("int"))
    p = dealt.join(terms, QKEY, "left").join(texts, [*CKEY, "_part"], "left")
    found = _occurrences(F.col("_words"), F.col("_terms.term"))
    p = p.select(*pairs.columns, "_terms", found.alias("_found"), F.size("_words").alias("_dl"), "n_docs", "avgdl")

    def part(t: Column, tf: Column) -> Column:
        idf = F.log(F.lit(1.0) + (F.col("n_docs") - t["df"] + F.lit(0.5)) / (t["df"] + F.lit(0.5)))
        weight = idf * tf * F.lit(BM25_K1 + 1) / (tf + F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("_dl") / F.col("avgdl")))
        # terms are summed as integers of 1e-9: exact and independent of their
        # order, so equal scores stay equal on every run
        return F.when(tf > 0, F.round(weight * 1e9).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    score = F.aggregate(F.zip_with("_terms", "_found", part), F.lit(0).cast("bigint"), lambda s, x: s + x) / 1e9
    return p.withColumn("score", F.coalesce(score, F.lit(0.0))).drop("_terms", "_found", "_dl", "n_docs", "avgdl")


def rerank(hits: DataFrame, questions: DataFrame, chunks: DataFrame, top_n: int, index=None, scorer=None) -> DataFrame:
    """L3: second stage over the candidates: score desc (ties: distance, key), keep top_n.

    ``scorer(hits, questions, chunks)`` returns the hits with a ``score``
    column; without one the score is BM25."""
    scored = scorer(hits, questions, chunks) if scorer is not None else lexical_score(hits, questions, chunks, index)
    w = Window.partitionBy(*QKEY).orderBy(F.desc(F.round("score", 9)), F.round("distance", 9), *CKEY)
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= top_n)


# ------------------------------------------------------------------ E5 / O1

def retrieve(questions: DataFrame, chunks: DataFrame, opts: JobOptions, k: int | None = None, use_rerank: bool = False, embedder=None, scorer=None, index=None) -> DataFrame:
    """E5: every question of every request -> its hits (k = 20 by default; with
    the rerank stage 20 candidates then top_docs). Questions without hits are
    kept with NULL hit columns."""
    kk = k or opts.k_neighbours
    qv = embed_questions(questions, opts, embedder)
    hits = knn_exact(qv, chunks, kk, opts, qkey=QKEY, ckey=CKEY)
    if use_rerank:
        hits = rerank(hits, questions, chunks, opts.top_docs, index, scorer)
    return questions.select(*QKEY).join(hits, QKEY, "left")


def concat_results(hits: DataFrame) -> DataFrame:
    """O1: per request, hits of its questions in question order then rank,
    duplicates kept; ``pos`` is the 1-based place in the concatenated list."""
    w = Window.partitionBy("request_id").orderBy("q_no", "rank")
    return hits.where(F.col("rank").isNotNull()).withColumn("pos", F.row_number().over(w).cast("bigint"))


# ------------------------------------------------------------------ W2 / F12 / E6

def chunk_blocks(chunks: DataFrame) -> DataFrame:
    """F12 + F11 per chunk: the prompt block of a chunk and its token count
    (a block depends on the chunk only, so it is built once per chunk, not per hit)."""
    meta = metadata_text(F.col("filename"), F.col("doc_link"), F.col("header1"), F.col("header2"), F.col("header3"))
    c = chunks.select(*CKEY, format_doc_block(F.col("text"), meta).alias("block"))
    return c.withColumn("n_tokens", token_count(F.col("block")))


def doc_blocks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """F12 + F11: one prompt block per hit with its token count."""
    return hits.join(chunk_blocks(chunks.join(hits.select(*CKEY).distinct(), CKEY, "left_semi")), CKEY)


def prompt_budget(blocks: DataFrame, budget: int) -> DataFrame:
    """Blocks in (q_no, rank) order while the running token sum stays within
    the budget; token counts are non-negative so this is the stop-at-first-overflow prefix."""
    w = Window.partitionBy("request_id").orderBy("q_no", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return blocks.withColumn("cum_tokens", F.sum("n_tokens").over(w)).where(F.col("cum_tokens") <= budget)


def _questions_text(qs: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(qs, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def build_prompts(
    questions: DataFrame,
    chunks: DataFrame,
    opts: JobOptions,
    budget: int | None = None,
    template: str = DEFAULT_USER_TEMPLATE,
    use_rerank: bool = False,
    embedder=None,
    scorer=None,
    index=None,
) -> DataFrame:
    """Scrub -> retrieve -> blocks -> budget -> one prompt per request.

    No hits -> the no-docs text; hits all over the budget -> empty docs text."""
    bud = opts.max_prompt_tokens if budget is None else budget
    accepted, _ = normalise_requests(questions)
    cleaned = accepted.withColumn("question", scrub_question(F.col("question"), opts.scrub_phrase))
    hits = retrieve(cleaned, chunks, opts, use_rerank=use_rerank, embedder=embedder, scorer=scorer, index=index).where(F.col("rank").isNotNull())
    kept = prompt_budget(doc_blocks(hits, chunks), bud)
    docs = kept.groupBy("request_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("q_no", "rank", "block"))), lambda x: x["block"]), "").alias("_docs"),
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("docs_tokens"),
    )
    has_hits = hits.select("request_id").distinct().withColumn("_hit", F.lit(True))
    reqs = cleaned.groupBy("request_id").agg(
        _questions_text(F.transform(F.array_sort(F.collect_list(F.struct("q_no", "question"))), lambda x: x["question"])).alias("_qs"),
        F.first("context").alias("_ctx"),
    )
    j = reqs.join(has_hits, "request_id", "left").join(docs, "request_id", "left")
    docs_text = F.when(F.col("_hit").isNull(), F.lit(NO_DOCS_TEXT)).otherwise(
        F.regexp_replace(F.coalesce(F.col("_docs"), F.lit("")), F.lit("^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$"), F.lit(""))
    )
    pre, rest = template.split("{questions}")
    mid, rest2 = rest.split("{context}")
    mid2, post = rest2.split("{docs}")
    prompt = F.concat(F.lit(pre), F.col("_qs"), F.lit(mid), F.coalesce(F.col("_ctx"), F.lit("None")), F.lit(mid2), docs_text, F.lit(post))
    return j.select(
        "request_id",
        prompt.alias("user_prompt"),
        F.coalesce(F.col("n_docs"), F.lit(0)).cast("bigint").alias("n_docs"),
        F.coalesce(F.col("docs_tokens"), F.lit(0)).cast("bigint").alias("docs_tokens"),
    )


# ------------------------------------------------------------------ E7 / A5

def usage_report(prompts: DataFrame, answers: DataFrame, system_prompt: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """prompt = tok(system) + tok(user prompt); completion = tok(answer); total."""
    j = prompts.join(answers, "request_id", "left")
    pt = token_count(F.lit(system_prompt)) + token_count(F.col("user_prompt"))
    ct = token_count(F.coalesce(F.col("answer"), F.lit("")))
    return j.select(
        "request_id",
        pt.alias("prompt_tokens"),
        ct.alias("completion_tokens"),
        (pt + ct).alias("total_tokens"),
        F.struct(pt.alias("prompt_tokens"), ct.alias("completion_tokens"), (pt + ct).alias("total_tokens")).alias("usage"),
    )


def token_usage(usage: DataFrame) -> DataFrame:
    """A5 batch totals."""
    return usage.agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.sum("prompt_tokens").cast("bigint").alias("prompt_tokens"),
        F.sum("completion_tokens").cast("bigint").alias("completion_tokens"),
        F.sum("total_tokens").cast("bigint").alias("total_tokens"),
    )


# ------------------------------------------------------------------ E8

def docs_lookup(lookups: DataFrame, chunks: DataFrame, opts: JobOptions, embedder=None) -> DataFrame:
    """Raw (unscrubbed) question with a per-row count of any size (0 -> the
    default number; negative -> rejected) -> (request_id, rank, page_content, metadata)."""
    k_row = F.when(F.col("count") == 0, F.lit(opts.k_neighbours)).otherwise(F.col("count"))
    valid = lookups.where(F.col("count") >= 0).select("request_id", F.lit(1).cast("bigint").alias("q_no"), "question", k_row.alias("_k"))
    hits = knn_exact(embed_questions(valid, opts, embedder), chunks, "_k", opts, qkey=QKEY, ckey=CKEY)
    meta = metadata_text(F.col("filename"), F.col("doc_link"), F.col("header1"), F.col("header2"), F.col("header3"))
    docs = chunks.select(*CKEY, F.col("text").alias("page_content"), meta.alias("metadata"))
    return hits.join(docs, CKEY).select("request_id", "rank", "page_content", "metadata")
