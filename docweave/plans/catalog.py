"""Registry of named queries: each has a Spark job (spark, sf_dir) -> DataFrame
and, where SQL can state it, an SQL twin for the DuckDB check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docweave.options import DEFAULT, JobOptions
from docweave.plans import fixtures as fx
from docweave.plans import sqlcheck as S
from docweave.plans.pipelines import build_release_chunks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, Callable[[], str]] = {}

OPTS: JobOptions = DEFAULT


def query(name: str, sql: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def sql_of(name: str):
    def deco(fn):
        SQL[name] = fn
        return fn

    return deco


CHUNK_COLS = "filename, chunk_no, header1, header2, header3, doc_link, text"


# ------------------------------------------------------------ T3 (flagship)
@query("build_release_chunks")
def q_build_release_chunks(spark, sf):
    from docweave.session import ensure_checkpoint_dir, ship_package

    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return build_release_chunks(fx.fx_pages(spark, sf), OPTS)


@sql_of("build_release_chunks")
def s_build_release_chunks():
    q = S.Q()
    c = S.build_release_chunks(q, S.fx_pages(q), OPTS)
    return q.render(f"SELECT {CHUNK_COLS} FROM {c}")


# ------------------------------------------------------------ chunking
from pyspark.sql import functions as F  # noqa: E402

from docweave.functions import html as H  # noqa: E402
from docweave.functions import text as TX  # noqa: E402
from docweave.functions.tokens import token_count, token_count_sql  # noqa: E402
from docweave.functions.vectors import distance, distance_sql  # noqa: E402
from docweave.operators import chunk as CH  # noqa: E402
from docweave.operators import diff as DF  # noqa: E402
from docweave.plans.pipelines import build_repo_chunks, drop_ignored_paths, release_markdown  # noqa: E402
from docweave.session import table  # noqa: E402
from docweave.sources import scan as SC  # noqa: E402


def _pair(name, spark_fn, sql_fn=None):
    from functools import wraps

    from docweave.session import ensure_checkpoint_dir, ship_package

    @wraps(spark_fn)
    def run(spark, sf):
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return spark_fn(spark, sf)

    QUERIES[name] = run
    if sql_fn is not None:
        SQL[name] = sql_fn


def _t1_spark(spark, sf):
    return CH.split_by_heading(fx.fx_markdown(spark, sf), key="doc", text="text").select(
        "doc", "chunk_no", "header1", "header2", "content"
    )


def _t1_sql():
    q = S.Q()
    t = S.split_by_heading(q, S.fx_markdown(q), "doc", "text")
    return q.render(f"SELECT k AS doc, chunk_no, header1, header2, content FROM {t}")


_pair("split_by_heading", _t1_spark, _t1_sql)


def _t2_spark(spark, sf):
    return CH.chunk_docs(fx.fx_markdown(spark, sf), OPTS, key="doc", text="text")


def _t2_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT {CHUNK_COLS} FROM {c}")


_pair("chunk_docs", _t2_spark, _t2_sql)


def _w1_spark(spark, sf):
    lines = CH.split_lines(fx.fx_markdown(spark, sf), key="doc", text="text")
    return CH.heading_carry(lines, key="doc").select(
        "doc", F.col("pos").cast("bigint").alias("pos"), "header1", "header2", "is_content"
    )


def _w1_sql():
    q = S.Q()
    S.split_by_heading(q, S.fx_markdown(q), "doc", "text")
    return q.render(
        "SELECT k AS doc, CAST(pos AS BIGINT) AS pos, v1 AS header1, CASE WHEN p2 > coalesce(p1, -1) THEN v2 END AS header2, "
        "(in_code OR (lvl = 0 AND s <> '')) AS is_content FROM t1_carry"
    )


_pair("heading_carry", _w1_spark, _w1_sql)


def _w4_spark(spark, sf):
    return _t2_spark(spark, sf).select("filename", "chunk_no", "header1", "header2")


def _w4_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT filename, chunk_no, header1, header2 FROM {c}")


_pair("chunk_numbers", _w4_spark, _w4_sql)


def _t4_spark(spark, sf):
    paths = SC.list_markdown_files(fx.fx_listing(spark, sf), OPTS)
    return build_repo_chunks(paths, fx.fx_content(spark, sf), OPTS)


def _t4_sql():
    q = S.Q()
    c = S.repo_chunks(q, OPTS)
    return q.render(f"SELECT {CHUNK_COLS} FROM {c}")


_pair("build_repo_chunks", _t4_spark, _t4_sql)


# ------------------------------------------------------------ sources
def _s1_spark(spark, sf):
    snap = SC.snapshot_from_table(fx.release_pages(spark, sf).select("rel_path", "html"), "pages")
    return snap.select("rel_path", "sha256", F.length("html").cast("bigint").alias("n_chars"))


def _s1_sql():
    q = S.Q()
    rp = S.release_pages(q)
    return q.render(f"SELECT rel_path, sha256(html) AS sha256, CAST(length(html) AS BIGINT) AS n_chars FROM {rp}")


_pair("scan_html_snapshot", _s1_spark, _s1_sql)


def _s2_spark(spark, sf):
    return SC.list_markdown_files(fx.fx_listing(spark, sf), OPTS)


def _s2_sql():
    q = S.Q()
    lp = S.listing_paths(q)
    return q.render(f"SELECT path FROM {lp} WHERE {S.path_predicate_sql('path', OPTS)}")


_pair("list_markdown_files", _s2_spark, _s2_sql)


def _s3_spark(spark, sf):
    c = fx.fx_content(spark, sf)
    return c.select("filename", SC.decode_content(F.col("encoding"), F.col("content")).alias("markdown"))


def _s3_sql():
    q = S.Q()
    d = S.decoded_content(q)
    return q.render(f"SELECT filename, markdown FROM {d}")


_pair("decode_content", _s3_spark, _s3_sql)


def _s4_spark(spark, sf):
    return SC.latest_ref(fx.fx_versions(spark, sf))


def _s4_sql():
    q = S.Q()
    lr = S.latest_ref(q, S.fx_versions(q))
    return q.render(f"SELECT product, ref, ts FROM {lr}")


_pair("latest_ref", _s4_spark, _s4_sql)


def _s5_spark(spark, sf):
    return SC.release_assets(fx.fx_release(spark, sf))


def _s5_sql():
    q = S.Q()
    r = S.fx_release_flat(q)
    return q.render(f"SELECT tag, CAST(row_number() OVER (PARTITION BY tag ORDER BY k) - 1 AS BIGINT) AS pos, name, url FROM {r}")


_pair("release_assets", _s5_spark, _s5_sql)


def _s6_spark(spark, sf):
    return SC.changed_files(fx.fx_changed_files(spark, sf))


def _s6_sql():
    q = S.Q()
    c = S.changed_file_rows(q)
    return q.render(f"SELECT filename, status FROM {c}")


_pair("changed_files", _s6_spark, _s6_sql)


# ------------------------------------------------------------ filters
def _p2_spark(spark, sf):
    f = SC.changed_files(fx.fx_changed_files(spark, sf))
    return f.where(SC.ignore_paths_predicate(F.col("filename"), OPTS))


def _p2_sql():
    q = S.Q()
    c = S.changed_file_rows(q)
    return q.render(f"SELECT filename, status FROM {c} WHERE {S.path_predicate_sql('filename', OPTS)}")


_pair("filter_changed_files", _p2_spark, _p2_sql)


def _p3_spark(spark, sf):
    return drop_ignored_paths(fx.fx_pages(spark, sf), OPTS).select("rel_path")


def _p3_sql():
    q = S.Q()
    o = S.fx_pages(q)
    ign = ", ".join(TX.sql_lit(x) for x in OPTS.ignore_rel_paths) if OPTS.ignore_rel_paths else "NULL"
    return q.render(f"SELECT rel_path FROM {o} WHERE rel_path NOT IN ({ign})")


_pair("filter_ignored_paths", _p3_spark, _p3_sql)


def _p4_spark(spark, sf):
    md = release_markdown(fx.fx_pages(spark, sf), OPTS)
    return md.select("filename", F.length("markdown").cast("bigint").alias("n_chars"))


def _p4_sql():
    q = S.Q()
    md = S.release_markdown(q, S.fx_pages(q), OPTS)
    return q.render(f"SELECT filename, CAST(length(markdown) AS BIGINT) AS n_chars FROM {md}")


_pair("drop_no_article", _p4_spark, _p4_sql)


# ------------------------------------------------------------ scalar functions
def _docs(spark, sf):
    return table(spark, sf, "documents")


_pair(
    "heading_anchor",
    lambda spark, sf: _docs(spark, sf).select("doc_id", TX.heading_anchor(F.col("text")).alias("anchor")),
    lambda: f"SELECT doc_id, {TX.heading_anchor_sql('text')} AS anchor FROM documents",
)


def _f2_spark(spark, sf):
    p = fx.listing_paths(spark, sf)
    h2 = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(F.lit("Section "), F.col("doc_id").cast("string")))
    return p.select("doc_id", TX.doc_link(F.col("path"), h2, F.lit(None).cast("string"), OPTS.web_path, OPTS.doc_path).alias("doc_link"))


def _f2_sql():
    q = S.Q()
    lp = S.listing_paths(q)
    h2 = "CASE WHEN doc_id % 2 = 0 THEN 'Section ' || CAST(doc_id AS VARCHAR) END"
    return q.render(f"SELECT doc_id, {TX.doc_link_sql('path', h2, 'CAST(NULL AS VARCHAR)', OPTS.web_path, OPTS.doc_path)} AS doc_link FROM {lp}")


_pair("doc_link", _f2_spark, _f2_sql)

_pair(
    "rewrite_links",
    lambda spark, sf: _docs(spark, sf).select("doc_id", TX.rewrite_links(F.col("text"), OPTS.web_path).alias("text")),
    lambda: f"SELECT doc_id, {TX.rewrite_links_sql('text', OPTS.web_path)} AS text FROM documents",
)


def _f4_spark(spark, sf):
    c = table(spark, sf, "conversations")
    h2 = F.when(F.pmod("turn", F.lit(2)) == 0, F.concat(F.lit("Turn "), F.col("turn").cast("string")))
    return c.select("conv_id", "turn", TX.prefix_headings(F.col("role"), h2, F.lit(None).cast("string"), F.col("text")).alias("text"))


_pair(
    "prefix_headings",
    _f4_spark,
    lambda: "SELECT conv_id, turn, "
    + TX.prefix_headings_sql("role", "CASE WHEN turn % 2 = 0 THEN 'Turn ' || CAST(turn AS VARCHAR) END", "CAST(NULL AS VARCHAR)", "text")
    + " AS text FROM conversations",
)


def _f5_sql():
    q = S.Q()
    o = S.fx_pages(q)
    return q.render(f"SELECT rel_path, {TX.format_file_path_sql('rel_path')} AS filename FROM {o}")


_pair(
    "format_file_path",
    lambda spark, sf: fx.fx_pages(spark, sf).select("rel_path", TX.format_file_path(F.col("rel_path")).alias("filename")),
    _f5_sql,
)

_pair(
    "extract_article",
    lambda spark, sf: table(spark, sf, "pages").select("page_id", H.extract_article(F.col("html")).alias("article")),
    lambda: f"SELECT page_id, {S.article_sql('html')} AS article FROM pages",
)

_pair(
    "html_to_markdown",
    lambda spark, sf: table(spark, sf, "pages").select("page_id", H.article_markdown(F.col("html")).alias("markdown")),
    lambda: f"SELECT page_id, {S.markdown_sql(S.article_sql('html'))} AS markdown FROM pages",
)

_pair(
    "content_hash",
    lambda spark, sf: table(spark, sf, "pages").select("page_id", TX.content_hash(F.col("html")).alias("sha256")),
    lambda: "SELECT page_id, sha256(html) AS sha256 FROM pages",
)


def _f9_sql():
    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    return q.render(f"SELECT request_id, q_no, {TX.scrub_question_sql('question', OPTS.scrub_phrase)} AS question FROM {fq}")


_pair(
    "scrub_question",
    lambda spark, sf: fx.fx_questions(spark, sf, OPTS).select(
        "request_id", "q_no", TX.scrub_question(F.col("question"), OPTS.scrub_phrase).alias("question")
    ),
    _f9_sql,
)

_pair(
    "token_count",
    lambda spark, sf: _docs(spark, sf).select("doc_id", token_count(F.col("text")).alias("n_tokens")),
    lambda: f"SELECT doc_id, {token_count_sql('text')} AS n_tokens FROM documents",
)


def _f13_spark(spark, sf):
    e = table(spark, sf, "embeddings")
    a = e.select("vec_id", F.col("embedding").alias("a"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    j = a.join(b, "vec_id")
    return j.select(
        "vec_id",
        *[F.round(distance(F.col("a"), F.col("b"), m), 6).alias(f"d_{c}") for c, m in F13_METRICS.items()],
    )


# column -> spelling of the metric
F13_METRICS = {"l2": "L2", "ip": "IP", "inner": "INNER_PRODUCT", "cosine": "COSINE", "lower": "cosine", "unknown": "HAMMING"}


def _f13_sql():
    s = lambda e: f"list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: {e}))"
    l2 = f"sqrt({s('(p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)')})"
    dot, aa, bb = s("p[1]::DOUBLE * p[2]::DOUBLE"), s("p[1]::DOUBLE * p[1]::DOUBLE"), s("p[2]::DOUBLE * p[2]::DOUBLE")
    by = {"l2": l2, "ip": f"-{dot}", "inner": f"-{dot}", "cosine": f"1.0 - {dot} / (sqrt({aa}) * sqrt({bb}))", "lower": l2, "unknown": l2}
    cols = ", ".join(f"round({e}, 6) AS d_{c}" for c, e in by.items())
    return f"SELECT a.vec_id, {cols} FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


_pair("metric_distance", _f13_spark, _f13_sql)


# ------------------------------------------------------------ diffs
def _snaps(spark, sf):
    return fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf)


def _j1_sql():
    q = S.Q()
    d = S.snapshot_diff(q, OPTS)
    return q.render(f"SELECT rel_path, filename, status FROM {d}")


_pair("snapshot_diff", lambda spark, sf: DF.snapshot_diff(*_snaps(spark, sf), OPTS), _j1_sql)


def _j1_digests_spark(spark, sf):
    old, new = (DF.write_digests(x, scratch_path(spark, "digests"), OPTS) for x in _snaps(spark, sf))
    return DF.changed_paths(old, new)


_pair("snapshot_diff_digests", _j1_digests_spark, lambda: f"SELECT * FROM ({_j1_sql()}) WHERE status <> 'unchanged'")


def _jmd_sql(status):
    def f():
        q = S.Q()
        m = S.changed_markdown(q, OPTS, status)
        return q.render(f"SELECT filename, markdown FROM {m}")

    return f


_pair("diff_added", lambda spark, sf: DF.diff_added(*_snaps(spark, sf), OPTS), _jmd_sql("added"))
_pair("diff_modified", lambda spark, sf: DF.diff_modified(*_snaps(spark, sf), OPTS), _jmd_sql("modified"))


def _j4_sql():
    q = S.Q()
    d = S.snapshot_diff(q, OPTS)
    return q.render(f"SELECT filename FROM {d} WHERE status = 'deleted'")


_pair("diff_deleted", lambda spark, sf: DF.diff_deleted(*_snaps(spark, sf), OPTS), _j4_sql)


def _j5_spark(spark, sf):
    return DF.commit_diff(SC.changed_files(fx.fx_changed_files(spark, sf)), OPTS)


def _j5_sql():
    q = S.Q()
    c = S.changed_file_rows(q)
    return q.render(
        "SELECT filename, CASE WHEN status IN ('added', 'modified') THEN 'upsert' ELSE 'delete' END AS action "
        f"FROM {c} WHERE {S.path_predicate_sql('filename', OPTS)} AND status IN ('added', 'modified', 'removed')"
    )


_pair("commit_diff", _j5_spark, _j5_sql)


def _a1_sql():
    q = S.Q()
    d = S.snapshot_diff(q, OPTS)
    return q.render(
        "SELECT count(*) FILTER (WHERE status = 'added') AS n_added, count(*) FILTER (WHERE status = 'modified') AS n_modified, "
        f"count(*) FILTER (WHERE status = 'deleted') AS n_deleted FROM {d}"
    )


_pair("change_summary", lambda spark, sf: DF.change_summary(DF.snapshot_diff(*_snaps(spark, sf), OPTS)), _a1_sql)


def _a2_spark(spark, sf):
    return DF.records_per_file(build_release_chunks(fx.fx_pages(spark, sf), OPTS))


def _a2_sql():
    q = S.Q()
    c = S.build_release_chunks(q, S.fx_pages(q), OPTS)
    return q.render(
        "SELECT filename, count(*) AS n_records, 'Successfully added ' || CAST(count(*) AS VARCHAR) || ' records from ' || filename AS message "
        f"FROM {c} GROUP BY filename"
    )


_pair("records_per_file", _a2_spark, _a2_sql)


# ------------------------------------------------------------ tables
from docweave.operators import tables as TB  # noqa: E402
from docweave.plans import refresh as RF  # noqa: E402
from docweave.session import scratch_path  # noqa: E402


def _kv(spark, sf):
    d = _docs(spark, sf)
    target = d.select(F.col("doc_id").alias("pk"), "lang", "source", "n_chars")
    new = d.select((F.col("doc_id") * 2).alias("pk"), F.upper("lang").alias("lang"), (F.col("n_chars") + 1).alias("n_chars"), F.lit("extra").alias("note"), F.lit(2).alias("seq"))
    # an earlier update of the same keys, greater in value
    stale = new.withColumn("lang", F.lit("zz")).withColumn("n_chars", F.col("n_chars") + 1000).withColumn("seq", F.lit(1))
    return target, new, new.unionByName(stale)


def _k2_sql():
    q = S.Q()
    S.fx_kv(q)
    return q.render("SELECT pk, lang, source, n_chars FROM kv_target UNION ALL SELECT pk, lang, CAST(NULL AS VARCHAR) AS source, n_chars FROM kv_src")


_pair("insert_align", lambda spark, sf: TB.insert_align(*_kv(spark, sf)[:2]), _k2_sql)


def _k3_sql():
    q = S.Q()
    S.fx_kv(q)
    return q.render(
        "SELECT pk, lang, source, n_chars FROM kv_target WHERE pk NOT IN (SELECT pk FROM kv_src) "
        "UNION ALL SELECT pk, lang, CAST(NULL AS VARCHAR) AS source, n_chars FROM kv_src"
    )




def _k3_spark(spark, sf):
    target, _, updates = _kv(spark, sf)
    return TB.upsert_pk(target, updates, "pk", order="seq")


_pair("upsert_pk", _k3_spark, _k3_sql)


def _repo_chunks(spark, sf):
    return _t4_spark(spark, sf)


def _actions(spark, sf):
    return DF.commit_diff(SC.changed_files(fx.fx_changed_files(spark, sf)), OPTS)


def _k4_spark(spark, sf):
    dels = _actions(spark, sf).where(F.col("action") == "delete")
    return TB.delete_by_file(_repo_chunks(spark, sf), dels).select("filename", "chunk_no", "doc_link")


def _k4_sql():
    q = S.Q()
    c = S.repo_chunks(q, OPTS)
    a = S.commit_actions(q, OPTS)
    return q.render(f"SELECT filename, chunk_no, doc_link FROM {c} WHERE filename NOT IN (SELECT filename FROM {a} WHERE action = 'delete')")


_pair("delete_by_file", _k4_spark, _k4_sql)


def _j6_spark(spark, sf):
    """The table after the delete, with what the report says for each file kept apart."""
    dels = _actions(spark, sf).where(F.col("action") == "delete")
    return TB.deleted_counts(_repo_chunks(spark, sf), dels)


def _j6_sql():
    q = S.Q()
    c = S.repo_chunks(q, OPTS)
    a = S.commit_actions(q, OPTS)
    return q.render(
        "SELECT d.filename, CAST(count(c.filename) AS BIGINT) AS n_records, "
        "'Successfully deleted ' || CAST(count(c.filename) AS VARCHAR) || ' records of ' || d.filename AS message "
        f"FROM (SELECT DISTINCT filename FROM {a} WHERE action = 'delete') d LEFT JOIN {c} c ON c.filename = d.filename GROUP BY d.filename"
    )


_pair("delete_report", _j6_spark, _j6_sql)


def _j6_keys_spark(spark, sf):
    """Delete by a key set: every file of the commit, whatever its action."""
    return TB.delete_by_file(_repo_chunks(spark, sf), _actions(spark, sf)).select("filename", "chunk_no", "text")


def _j6_keys_sql():
    q = S.Q()
    c = S.repo_chunks(q, OPTS)
    a = S.commit_actions(q, OPTS)
    return q.render(f"SELECT c.filename, c.chunk_no, c.text FROM {c} c WHERE NOT EXISTS (SELECT 1 FROM {a} a WHERE a.filename = c.filename)")


_pair("delete_in_keys", _j6_keys_spark, _j6_keys_sql)


def _k5_spark(spark, sf):
    d = _docs(spark, sf).select(TX.content_hash(F.col("text")).alias("pk"), "doc_id")
    return TB.primary_key_violations(d, "pk")


_pair("create_table", _k5_spark, lambda: "SELECT sha256(text) AS pk, count(*) AS n_rows FROM documents GROUP BY 1 HAVING count(*) > 1")


def _k7_spark(spark, sf):
    reg = fx.fx_versions(spark, sf).select(F.col("product").alias("name"))
    return TB.registry_has(reg, "click")


_pair("table_exists", _k7_spark, lambda: "SELECT count(*) > 0 AS \"exists\" FROM (SELECT 1 FROM events WHERE event_type = 'click' LIMIT 1)")


def _a4_spark(spark, sf):
    ch = _t2_spark(spark, sf)
    return TB.registry_has(ch, "en/conversations/c7.md", col="filename")


def _a4_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT count(*) > 0 AS \"exists\" FROM (SELECT 1 FROM {c} WHERE filename = 'en/conversations/c7.md' LIMIT 1)")


_pair("exists_check", _a4_spark, _a4_sql)


def _k1_spark(spark, sf):
    chunks = build_release_chunks(fx.fx_pages(spark, sf), OPTS)
    return TB.full_load(chunks, scratch_path(spark, "full_load"), OPTS).drop("bucket")


def _k1_sql():
    q = S.Q()
    c = S.build_release_chunks(q, S.fx_pages(q), OPTS)
    return q.render(f"SELECT {CHUNK_COLS} FROM {c}")


_pair("full_load", _k1_spark, _k1_sql)


def _k9_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT filename, 'chunk_' || CAST(chunk_no AS VARCHAR) || '.md' AS chunk_file, text FROM {c}")


_pair("export_chunk_files", lambda spark, sf: TB.export_chunk_files(_t2_spark(spark, sf)), _k9_sql)


def _k10_sql():
    q = S.Q()
    rp = S.release_pages(q)
    return q.render(f"SELECT replace(rel_path, '.html', '.md') AS md_path, {S.markdown_sql('html')} AS markdown FROM {rp}")


_pair("html_tree_to_md", lambda spark, sf: TB.html_tree_to_md(fx.release_pages(spark, sf)), _k10_sql)


# ------------------------------------------------------------ set operations
def _o2_spark(spark, sf):
    rel = build_release_chunks(fx.fx_pages(spark, sf), OPTS)
    return TB.union_chunks(rel, _repo_chunks(spark, sf)).select("filename", "chunk_no", "doc_link")


def _o2_sql():
    q = S.Q()
    a = S.build_release_chunks(q, S.fx_pages(q), OPTS)
    b = S.repo_chunks(q, OPTS)
    return q.render(f"SELECT filename, chunk_no, doc_link FROM {a} UNION ALL SELECT filename, chunk_no, doc_link FROM {b}")


_pair("union_chunks", _o2_spark, _o2_sql)


def _o3_sql():
    q = S.Q()
    a = S.commit_actions(q, OPTS)
    return q.render(f"SELECT filename FROM {a} WHERE action = 'upsert'")


_pair("upsert_set", lambda spark, sf: TB.upsert_set(_actions(spark, sf)), _o3_sql)


def _o4_spark(spark, sf):
    old, new = _snaps(spark, sf)
    old_chunks = build_release_chunks(old, OPTS)
    return TB.apply_changes(old_chunks, DF.release_changes(old, new, OPTS), OPTS)


def _o4_sql():
    q = S.Q()
    oc = S.build_release_chunks(q, S.fx_snapshot_old(q), OPTS, "oldc")
    ch = S.release_changes(q, OPTS)
    a = S.apply_changes(q, oc, ch, OPTS)
    return q.render(f"SELECT {CHUNK_COLS} FROM {a}")


_pair("apply_changes", _o4_spark, _o4_sql)


def _repo_changes(spark, sf):
    acts = _actions(spark, sf)
    content = fx.fx_content(spark, sf).select("filename", SC.decode_content(F.col("encoding"), F.col("content")).alias("markdown"))
    ups = acts.where(F.col("action") == "upsert").join(content, "filename").select("filename", F.col("action").alias("status"), "markdown")
    dels = acts.where(F.col("action") == "delete").select("filename", F.col("action").alias("status"), F.lit(None).cast("string").alias("markdown"))
    return _with_stale_changes(ups.unionByName(dels))


def _with_stale_changes(last):
    """Before the last change of each file an earlier one: an old version, an
    add before a delete, a delete before an add."""
    kind = F.pmod(F.xxhash64("filename"), F.lit(3))
    version = F.concat(F.lit("# stale\nline one\n\nline two "), "filename")
    earlier = last.select(
        "filename",
        F.when(kind == 0, F.lit("delete")).otherwise(F.lit("upsert")).alias("status"),
        F.when(kind != 0, version).alias("markdown"),
        F.lit(1).cast("bigint").alias("seq"),
    )
    return last.withColumn("seq", F.lit(2).cast("bigint")).unionByName(earlier)


def _o5_spark(spark, sf):
    return TB.apply_changes(_repo_chunks(spark, sf), _repo_changes(spark, sf), OPTS)


def _o5_sql():
    q = S.Q()
    oc = S.repo_chunks(q, OPTS)
    a = S.commit_actions(q, OPTS)
    dc = S.decoded_content(q)
    q.add(
        "repo_changes",
        f"SELECT a.filename, a.action AS status, d.markdown FROM {a} a JOIN {dc} d ON a.filename = d.filename WHERE a.action = 'upsert' "
        f"UNION ALL SELECT filename, action AS status, CAST(NULL AS VARCHAR) AS markdown FROM {a} WHERE action = 'delete'",
    )
    ap = S.apply_changes(q, oc, "repo_changes", OPTS, "repo_applied")
    return q.render(f"SELECT {CHUNK_COLS} FROM {ap}")


_pair("apply_repo_changes", _o5_spark, _o5_sql)


# ------------------------------------------------------------ predicates on chunks
def _p1_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT filename, chunk_no, header2 FROM {c} WHERE chunk_no > 2")


_pair("query_table", lambda spark, sf: TB.query_table(_t2_spark(spark, sf), "chunk_no > 2", ["filename", "chunk_no", "header2"]), _p1_sql)


def _meta_text_of_map(m):
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")


def _p5_spark(spark, sf):
    c = _t2_spark(spark, sf)
    return c.select("filename", "chunk_no", _meta_text_of_map(TB.chunk_metadata(c)).alias("metadata"))


def _p5_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    parts = ", ".join(f"'{k}=' || {v}" for k, v in (("filename", "filename"), ("doc_link", "doc_link"), ("Header3", "header3"), ("Header2", "header2"), ("Header1", "header1")))
    return q.render(f"SELECT filename, chunk_no, concat_ws('; ', {parts}) AS metadata FROM {c}")


_pair("chunk_metadata", _p5_spark, _p5_sql)


def _p6_spark(spark, sf):
    c = _t2_spark(spark, sf)
    m = c.withColumn("metadata", TB.chunk_metadata(c))
    return TB.metadata_lookup(m, "filename", "en/conversations/c3.md").select("filename", "chunk_no", "header2")


def _p6_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT filename, chunk_no, header2 FROM {c} WHERE filename = 'en/conversations/c3.md'")


_pair("metadata_lookup", _p6_spark, _p6_sql)


def _p7_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT text AS page_content, {TX.metadata_text_sql('filename', 'doc_link', 'header1', 'header2', 'header3')} AS metadata FROM {c}")


_pair("to_documents", lambda spark, sf: TB.to_documents(_t2_spark(spark, sf)), _p7_sql)


def _a3_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT count(*) AS insert_count FROM {c}")


def _a3_spark(spark, sf):
    """A3: the insert count observed during the write itself (no second pass)."""
    from pyspark.sql import Observation

    obs = Observation("insert_count")
    TB.full_load(_t2_spark(spark, sf), scratch_path(spark, "write_counts"), OPTS, observation=obs)
    return spark.createDataFrame([(int(obs.get["insert_count"]),)], "insert_count bigint")


_pair("write_counts", _a3_spark, _a3_sql)


def _w3_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(
        "SELECT filename, chunk_no, CAST(rn - 1 AS BIGINT) AS row_index, CAST(floor((rn - 1) / 100) AS BIGINT) AS batch_no FROM ("
        f"SELECT filename, chunk_no, row_number() OVER (ORDER BY filename, chunk_no) AS rn FROM {c})"
    )


_pair(
    "batch_slices",
    lambda spark, sf: TB.batch_slices(_t2_spark(spark, sf).select("filename", "chunk_no"), ["filename", "chunk_no"], 100),
    _w3_sql,
)


def _w5_sql():
    q = S.Q()
    r = S.fx_release_flat(q)
    p = TX.sql_lit(OPTS.asset_name)
    return q.render(
        f"SELECT tag, arg_min(name, k) FILTER (WHERE starts_with(name, {p})) AS name, arg_min(url, k) FILTER (WHERE starts_with(name, {p})) AS url "
        f"FROM {r} GROUP BY tag"
    )


_pair("first_per_key", lambda spark, sf: TB.first_per_key(fx.fx_release(spark, sf), OPTS.asset_name), _w5_sql)


# ------------------------------------------------------------ refresh control
def _latest(spark, sf):
    return SC.latest_ref(fx.fx_versions(spark, sf))


def _r1_sql():
    q = S.Q()
    t = S.fx_tracking(q, OPTS)
    return q.render(f"SELECT l.product, t.last_updated_ref, t.last_updater_version FROM latest_ref l LEFT JOIN {t} t ON l.product = t.product")


_pair("read_tracking", lambda spark, sf: RF.read_tracking(fx.fx_tracking(spark, sf, OPTS), _latest(spark, sf)), _r1_sql)


def _r2_spark(spark, sf):
    upd = _latest(spark, sf).select("product", F.col("ref").alias("last_updated_ref"), F.lit(OPTS.updater_version).alias("last_updater_version"), F.lit(2).alias("seq"))
    # an earlier update of each product, greater as text
    upd = upd.unionByName(upd.withColumn("last_updated_ref", F.lit("v~")).withColumn("seq", F.lit(1)))
    return RF.write_tracking(fx.fx_tracking(spark, sf, OPTS), upd)


def _r2_sql():
    q = S.Q()
    S.fx_tracking(q, OPTS)
    return q.render(f"SELECT product, ref AS last_updated_ref, {TX.sql_lit(OPTS.updater_version)} AS last_updater_version FROM latest_ref")


_pair("write_tracking", _r2_spark, _r2_sql)


def _r4_spark(spark, sf):
    latest = _latest(spark, sf).withColumn("has_asset", F.col("product") != "view")
    plan = lambda there: RF.plan_refresh(latest, fx.fx_tracking(spark, sf, OPTS), OPTS, collection_exists=there, has_asset="has_asset").withColumn("present", F.lit(there))
    return plan(True).unionByName(plan(False))


def _r4_sql():
    q = S.Q()
    t = S.fx_tracking(q, OPTS)
    v = TX.sql_lit(OPTS.updater_version)
    after = f"WHEN t.last_updated_ref = l.ref THEN 'SKIP' WHEN t.last_updater_version IS DISTINCT FROM {v} THEN 'REBUILD' ELSE 'INCREMENTAL' END"
    release = (
        "CASE WHEN l.product = 'view' THEN 'SKIP' WHEN NOT p.present THEN 'FULL_LOAD' "
        f"WHEN t.product IS NULL THEN 'REBUILD' {after}"
    )
    repo = f"CASE WHEN NOT p.present OR t.product IS NULL THEN 'FULL_LOAD' {after}"
    return q.render(
        f"SELECT l.product, l.ref AS latest_ref, t.last_updated_ref, t.last_updater_version, {release} AS release_action, {repo} AS repo_action, "
        f"{release} AS action, p.present FROM latest_ref l LEFT JOIN {t} t ON l.product = t.product, (VALUES (true), (false)) p(present)"
    )


_pair("plan_refresh", _r4_spark, _r4_sql)


# ------------------------------------------------------------ retrieval
from docweave.operators import knn as KN  # noqa: E402
from docweave.operators import retrieve as RT  # noqa: E402
from docweave.operators.embed import embed_chunks, embed_questions  # noqa: E402


#: where the chunk table of an input was stored by this application
_CHUNK_TABLES: dict = {}
_TERM_INDEX: dict = {}


def fx_chunks(spark, sf):
    """The chunk table with vectors (T2 over the conversation corpus + T3 over all
    pages + E1), stored once per application as K1 writes it and read from
    there, as the retriever reads the table the updater wrote."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CHUNK_TABLES:
        path = scratch_path(spark, "chunk-table")
        TB.full_load(_new_fx_chunks(spark, sf), path, OPTS.with_(chunk_buckets=8))
        _CHUNK_TABLES[key] = path
    return spark.read.parquet(_CHUNK_TABLES[key]).drop("bucket")


def fx_term_index(spark, sf):
    """The stored BM25 statistics of the chunk table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TERM_INDEX:
        path = scratch_path(spark, "term-index")
        for name, df in zip(("terms", "lengths"), RT.term_index(fx_chunks(spark, sf))):
            df.write.parquet(f"{path}/{name}")
        _TERM_INDEX[key] = path
    return tuple(spark.read.parquet(f"{_TERM_INDEX[key]}/{name}") for name in ("terms", "lengths"))


def _new_fx_chunks(spark, sf):
    a = CH.chunk_docs(fx.fx_markdown(spark, sf), OPTS, key="doc", text="text")
    b = build_release_chunks(fx.fx_pages(spark, sf), OPTS)
    return embed_chunks(a.unionByName(b), OPTS)


def _e1_spark(spark, sf):
    c = _new_fx_chunks(spark, sf)
    return c.select("filename", "chunk_no", F.posexplode("vector").alias("dim", "v")).select(
        "filename", "chunk_no", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("v").cast("double"), 6).alias("value")
    )


def _e1_sql():
    q = S.Q()
    c = S.fx_chunks(q, OPTS)
    return q.render(
        f"SELECT filename, chunk_no, CAST(unnest(range(len(vector))) AS BIGINT) AS dim, round(unnest(vector)::DOUBLE, 6) AS value FROM {c}"
    )


_pair("embed_chunks", _e1_spark, _e1_sql)


def _e2_spark(spark, sf):
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS)
    return qv.select("request_id", "q_no", F.posexplode("qvec").alias("dim", "v")).select(
        "request_id", "q_no", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("v").cast("double"), 6).alias("value")
    )


def _e2_sql():
    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    e = S.embed_sql(q, fq, "request_id, q_no", "question", "qe", OPTS.embed_dim)
    return q.render(f"SELECT request_id, q_no, CAST(unnest(range(len(vec))) AS BIGINT) AS dim, round(unnest(vec)::DOUBLE, 6) AS value FROM {e}")


_pair("embed_questions", _e2_spark, _e2_sql)

HIT_COLS = "request_id, q_no, filename, chunk_no, round(distance, 6) AS distance, rank"


def _hits_out(df):
    return df.select("request_id", "q_no", "filename", "chunk_no", F.round("distance", 6).alias("distance"), "rank")


def _j7_spark(spark, sf):
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS)
    return _hits_out(KN.knn_exact(qv, fx_chunks(spark, sf), OPTS.k_neighbours, OPTS))


def _j7_sql():
    q = S.Q()
    h = S.knn_sql(q, S.fx_questions(q, OPTS), "request_id, q_no", "question", S.fx_chunks(q, OPTS), OPTS.k_neighbours, OPTS)
    return q.render(f"SELECT {HIT_COLS} FROM {h}")


_pair("knn_join", _j7_spark, _j7_sql)


def _query_vec(spark, sf):
    row = table(spark, sf, "embeddings").where(F.col("vec_id") == 0).select("embedding").first()
    return list(row["embedding"])


def _l1_spark(spark, sf):
    e = table(spark, sf, "embeddings")
    r = KN.topk_search(e, _query_vec(spark, sf), 0, OPTS, ckey=("vec_id",), cvec="embedding")
    return r.select("vec_id", F.round("distance", 6).alias("distance"))


def _l_sql(k, extra=""):
    from docweave.functions.vectors import distance_sql

    return lambda: (
        f"SELECT vec_id, {extra}round(d, 6) AS distance FROM (SELECT e.vec_id, e.label, {distance_sql('e.embedding', 'q.embedding', 'L2')} AS d "
        f"FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q) ORDER BY round(d, 9), vec_id LIMIT {k}"
    )


_pair("topk_search", _l1_spark, _l_sql(20))


def _l2_spark(spark, sf):
    from docweave.options import LIBRARY_DEFAULT_K

    e = table(spark, sf, "embeddings")
    r = KN.topk_search(e, _query_vec(spark, sf), LIBRARY_DEFAULT_K, OPTS, ckey=("vec_id", "label"), cvec="embedding")
    return r.select("vec_id", F.col("label").alias("doc"), F.round("distance", 6).alias("distance"))


_pair("topk_with_scores", _l2_spark, _l_sql(4, "label AS doc, "))


def _e4_spark(spark, sf):
    fq = fx.fx_questions(spark, sf, OPTS)
    ch = fx_chunks(spark, sf)
    hits = KN.knn_exact(embed_questions(fq, OPTS), ch, OPTS.k_neighbours, OPTS)
    s = RT.lexical_score(hits, fq, ch, fx_term_index(spark, sf))
    return s.select("request_id", "q_no", "filename", "chunk_no", F.round("score", 6).alias("score"))


def _e4_sql():
    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    ch = S.fx_chunks(q, OPTS)
    h = S.knn_sql(q, fq, "request_id, q_no", "question", ch, OPTS.k_neighbours, OPTS)
    b = S.bm25(q, h, fq, ch)
    return q.render(f"SELECT request_id, q_no, filename, chunk_no, round(score, 6) AS score FROM {b}")


_pair("lexical_score", _e4_spark, _e4_sql)


def _l3_spark(spark, sf):
    fq = fx.fx_questions(spark, sf, OPTS)
    ch = fx_chunks(spark, sf)
    hits = KN.knn_exact(embed_questions(fq, OPTS), ch, OPTS.k_neighbours, OPTS)
    return RT.rerank(hits, fq, ch, OPTS.top_docs, fx_term_index(spark, sf)).select("request_id", "q_no", "filename", "chunk_no", "rank")


def _l3_sql():
    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    ch = S.fx_chunks(q, OPTS)
    h = S.knn_sql(q, fq, "request_id, q_no", "question", ch, OPTS.k_neighbours, OPTS)
    b = S.bm25(q, h, fq, ch)
    return q.render(
        "SELECT request_id, q_no, filename, chunk_no, rank FROM (SELECT * EXCLUDE (rank), CAST(row_number() OVER (PARTITION BY request_id, q_no "
        f"ORDER BY round(score, 9) DESC, round(distance, 9), filename, chunk_no) AS BIGINT) AS rank FROM {b}) WHERE rank <= {OPTS.top_docs}"
    )


_pair("rerank_topn", _l3_spark, _l3_sql)


def _clean_questions(spark, sf):
    acc, _ = RT.normalise_requests(fx.fx_questions(spark, sf, OPTS))
    return acc.withColumn("question", TX.scrub_question(F.col("question"), OPTS.scrub_phrase))


def _e5_spark(spark, sf):
    return _hits_out(RT.retrieve(_clean_questions(spark, sf), fx_chunks(spark, sf), OPTS))


def _e5_sql():
    q = S.Q()
    cq = S.scrubbed_questions(q, OPTS)
    h = S.knn_sql(q, cq, "request_id, q_no", "question", S.fx_chunks(q, OPTS), OPTS.k_neighbours, OPTS, "e5")
    return q.render(f"SELECT {HIT_COLS} FROM {h}")


_pair("retrieve", _e5_spark, _e5_sql)


def _e5_rerank_spark(spark, sf):
    return _hits_out(RT.retrieve(_clean_questions(spark, sf), fx_chunks(spark, sf), OPTS, use_rerank=True, index=fx_term_index(spark, sf)))


def _e5_rerank_sql():
    q = S.Q()
    cq, ch = S.scrubbed_questions(q, OPTS), S.fx_chunks(q, OPTS)
    h = S.knn_sql(q, cq, "request_id, q_no", "question", ch, OPTS.k_neighbours, OPTS, "e5")
    return q.render(f"SELECT {HIT_COLS} FROM {S.reranked(q, h, cq, ch, OPTS.top_docs)}")


_pair("retrieve_rerank", _e5_rerank_spark, _e5_rerank_sql)


def _o1_spark(spark, sf):
    h = RT.concat_results(RT.retrieve(_clean_questions(spark, sf), fx_chunks(spark, sf), OPTS))
    return h.select("request_id", "pos", "q_no", "rank", "filename", "chunk_no")


def _o1_sql():
    q = S.Q()
    cq = S.scrubbed_questions(q, OPTS)
    h = S.knn_sql(q, cq, "request_id, q_no", "question", S.fx_chunks(q, OPTS), OPTS.k_neighbours, OPTS, "e5")
    return q.render(
        "SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY q_no, rank) AS BIGINT) AS pos, q_no, rank, filename, chunk_no "
        f"FROM {h}"
    )


_pair("concat_results", _o1_spark, _o1_sql)


def _f10_spark(spark, sf):
    acc, _ = RT.normalise_requests(fx.fx_questions(spark, sf, OPTS))
    return acc


def _f10_sql():
    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    return q.render(
        "SELECT request_id, q_no, question, coalesce(nullif(context, ''), first(question ORDER BY q_no) OVER (PARTITION BY request_id)) AS context "
        f"FROM {fq}"
    )


_pair("normalise_request", _f10_spark, _f10_sql)


def _blocks_spark(spark, sf):
    ch = fx_chunks(spark, sf)
    hits = RT.retrieve(_clean_questions(spark, sf), ch, OPTS).where(F.col("rank").isNotNull())
    return RT.doc_blocks(hits, ch)


def _blocks_sql():
    q = S.Q()
    cq = S.scrubbed_questions(q, OPTS)
    ch = S.fx_chunks(q, OPTS)
    h = S.knn_sql(q, cq, "request_id, q_no", "question", ch, OPTS.k_neighbours, OPTS, "e5")
    return q, S.blocks(q, h, ch)


def _f12_sql():
    q, b = _blocks_sql()
    return q.render(f"SELECT request_id, q_no, rank, block, n_tokens FROM {b}")


_pair("format_doc_block", lambda spark, sf: _blocks_spark(spark, sf).select("request_id", "q_no", "rank", "block", "n_tokens"), _f12_sql)


def _w2(b):
    def sp(spark, sf):
        return RT.prompt_budget(_blocks_spark(spark, sf), b).select("request_id", "q_no", "rank", "n_tokens", "cum_tokens")

    def sq():
        q, blk = _blocks_sql()
        k = S.budget(q, blk, b, "kept")
        return q.render(f"SELECT request_id, q_no, rank, n_tokens, CAST(cum_tokens AS BIGINT) AS cum_tokens FROM {k}")

    return sp, sq


_pair("prompt_budget", *_w2(OPTS.max_prompt_tokens))
_pair("prompt_budget_small", *_w2(1000))


def _e6(b, rerank=False):
    def sp(spark, sf):
        index = fx_term_index(spark, sf) if rerank else None
        return RT.build_prompts(fx.fx_questions(spark, sf, OPTS), fx_chunks(spark, sf), OPTS, budget=b, use_rerank=rerank, index=index)

    def sq():
        q = S.Q()
        p = S.prompts(q, OPTS, b, rerank=rerank)
        return q.render(f"SELECT request_id, user_prompt, n_docs, docs_tokens FROM {p}")

    return sp, sq


_pair("build_prompts_rerank", *_e6(OPTS.max_prompt_tokens, rerank=True))
_pair("build_prompts", *_e6(OPTS.max_prompt_tokens))
_pair("build_prompts_small", *_e6(1000))


def _usage_spark(spark, sf):
    p = RT.build_prompts(fx.fx_questions(spark, sf, OPTS), fx_chunks(spark, sf), OPTS)
    return RT.usage_report(p, fx.fx_answers(spark, sf))


def _usage_sql_parts():
    from docweave.functions.tokens import token_count_sql

    q = S.Q()
    p = S.prompts(q, OPTS, OPTS.max_prompt_tokens)
    a = S.fx_answers(q)
    sp = TX.sql_lit(RT.DEFAULT_SYSTEM_PROMPT)
    ans = token_count_sql("coalesce(a.answer, '')")
    q.add(
        "usage",
        f"SELECT p.request_id, ({token_count_sql(sp)} + {token_count_sql('p.user_prompt')}) AS prompt_tokens, "
        f"{ans} AS completion_tokens FROM {p} p LEFT JOIN {a} a ON p.request_id = a.request_id",
    )
    return q


def _e7_sql():
    q = _usage_sql_parts()
    return q.render("SELECT request_id, prompt_tokens, completion_tokens, prompt_tokens + completion_tokens AS total_tokens FROM usage")


_pair("usage_report", lambda spark, sf: _usage_spark(spark, sf).drop("usage"), _e7_sql)


def _a5_sql():
    q = _usage_sql_parts()
    return q.render(
        "SELECT count(*) AS n_requests, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, "
        "CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens FROM usage"
    )


_pair("token_usage", lambda spark, sf: RT.token_usage(_usage_spark(spark, sf)), _a5_sql)


def _e8_spark(spark, sf):
    return RT.docs_lookup(fx.fx_lookup(spark, sf), fx_chunks(spark, sf), OPTS)


def _e8_sql():
    q = S.Q()
    lk = S.fx_lookup(q)
    q.add("lk_q", f"SELECT request_id, CAST(1 AS BIGINT) AS q_no, question, CASE WHEN count = 0 THEN {OPTS.k_neighbours} ELSE count END AS k FROM {lk} WHERE count >= 0")
    ch = S.fx_chunks(q, OPTS)
    h = S.knn_sql(q, "lk_q", "request_id, q_no", "question", ch, 1 << 40, OPTS, "e8")
    meta = TX.metadata_text_sql("c.filename", "c.doc_link", "c.header1", "c.header2", "c.header3")
    return q.render(
        f"SELECT h.request_id, h.rank, c.text AS page_content, {meta} AS metadata FROM {h} h JOIN lk_q l ON h.request_id = l.request_id "
        f"JOIN {ch} c ON h.filename = c.filename AND h.chunk_no = c.chunk_no WHERE h.rank <= l.k"
    )


_pair("docs_lookup", _e8_spark, _e8_sql)


# ------------------------------------------------------------ ANN, hits, streams
def _ann_inputs(spark, sf):
    return embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS), fx_chunks(spark, sf)


def _ann_out(df):
    return df.select("request_id", "q_no", "filename", "chunk_no", F.round("distance", 6).alias("distance"), "rank", "n_found")


def _l4_spark(spark, sf):
    qv, ch = _ann_inputs(spark, sf)
    # fixed centroids (a rule both sides can state); by default KMeans trains them
    cents = KN.sample_centroids(ch, OPTS.ivf_lists)
    hits = KN.knn_ivf(qv, ch, OPTS.k_neighbours, OPTS, centroids=cents)
    return _ann_out(hits)


def _l4_sql():
    from docweave.functions.vectors import distance_sql

    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    ch = S.fx_chunks(q, OPTS)
    qe = S.embed_sql(q, fq, "request_id, q_no", "question", "ivf_qe", OPTS.embed_dim)
    q.add(
        "cents",
        f"SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cid, vector AS cv FROM "
        f"(SELECT md5(concat_ws('#', filename, CAST(chunk_no AS VARCHAR))) AS h, vector FROM {ch} ORDER BY h LIMIT {OPTS.ivf_lists})",
    )
    q.add(
        "c_assign",
        f"SELECT filename, chunk_no, vector, arg_min(cid, (d, cid)) AS list_id FROM (SELECT c.filename, c.chunk_no, c.vector, k.cid, "
        f"{distance_sql('c.vector', 'k.cv', OPTS.metric)} AS d FROM {ch} c, cents k) GROUP BY filename, chunk_no, vector",
    )
    q.add(
        "q_probe",
        f"SELECT request_id, q_no, vec, cid AS list_id FROM (SELECT q.request_id, q.q_no, q.vec, k.cid, row_number() OVER "
        f"(PARTITION BY q.request_id, q.q_no ORDER BY round({distance_sql('q.vec', 'k.cv', OPTS.metric)}, 9), k.cid) AS r FROM {qe} q, cents k) "
        f"WHERE r <= {OPTS.ivf_nprobe}",
    )
    q.add(
        "ivf_pairs",
        f"SELECT p.request_id, p.q_no, c.filename, c.chunk_no, {distance_sql('p.vec', 'c.vector', OPTS.metric)} AS distance "
        "FROM q_probe p JOIN c_assign c ON p.list_id = c.list_id",
    )
    return q.render(
        f"SELECT {HIT_COLS}, count(*) OVER (PARTITION BY request_id, q_no) AS n_found FROM (SELECT *, "
        "CAST(row_number() OVER (PARTITION BY request_id, q_no ORDER BY round(distance, 9), filename, chunk_no) AS BIGINT) AS rank "
        f"FROM ivf_pairs) WHERE rank <= {OPTS.k_neighbours}"
    )


_pair("ann_ivf", _l4_spark, _l4_sql)


def _l5_spark(spark, sf):
    qv, ch = _ann_inputs(spark, sf)
    hits = KN.knn_lsh(qv, ch, OPTS.k_neighbours, OPTS)
    return _ann_out(hits)


_pair("ann_lsh", _l5_spark)


def _l5_graph_spark(spark, sf):
    from docweave.operators.graph import knn_graph

    qv, ch = _ann_inputs(spark, sf)
    return _ann_out(knn_graph(qv, ch, OPTS.k_neighbours, OPTS))


# a walk over a graph: held against exact search by the tests
_pair("ann_graph", _l5_graph_spark)


def fx_hits_json(spark, sf):
    """Search responses: the hits of each question as [[{entity, distance}]], its
    id being '{request}/{question}'; odd chunk numbers carry no 'text' field."""
    one = fx.fx_questions(spark, sf, OPTS).select(F.concat_ws("/", "request_id", "q_no").alias("request_id"), F.lit(1).cast("bigint").alias("q_no"), "question")
    qv = embed_questions(one, OPTS)
    ch = fx_chunks(spark, sf)
    hits = KN.knn_exact(qv, ch, OPTS.k_neighbours, OPTS).join(ch.select("filename", "chunk_no", "text"), ["filename", "chunk_no"])
    item = F.struct(
        F.col("rank"),
        F.concat_ws("#", "filename", F.col("chunk_no").cast("string")).alias("pk"),
        F.col("filename"),
        F.when(F.pmod("chunk_no", F.lit(2)) == 0, F.col("text")).alias("text"),
        F.round("distance", 6).alias("distance"),
    )
    g = hits.groupBy("request_id").agg(F.array_sort(F.collect_list(item)).alias("_h"))

    def hit(x):
        ent = F.map_filter(
            F.create_map(F.lit("pk"), x["pk"], F.lit("filename"), x["filename"], F.lit("text"), x["text"]),
            lambda k, v: v.isNotNull(),
        )
        return F.struct(ent.alias("entity"), x["distance"].alias("distance"))

    return g.select("request_id", F.to_json(F.array(F.transform("_h", hit))).alias("body"))


def _s8_spark(spark, sf):
    return SC.flatten_hits(fx_hits_json(spark, sf))


def _s8_sql():
    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    q.add("fq1", f"SELECT request_id || '/' || q_no AS request_id, CAST(1 AS BIGINT) AS q_no, question FROM {fq}")
    ch = S.fx_chunks(q, OPTS)
    h = S.knn_sql(q, "fq1", "request_id, q_no", "question", ch, OPTS.k_neighbours, OPTS, "s8")
    return q.render(
        "SELECT h.request_id, h.rank, concat_ws('#', h.filename, CAST(h.chunk_no AS VARCHAR)) AS pk, CASE WHEN h.chunk_no % 2 = 0 THEN c.text END AS text, "
        f"h.filename, round(h.distance, 6) AS distance FROM {h} h JOIN {ch} c ON h.filename = c.filename AND h.chunk_no = c.chunk_no"
    )


_pair("flatten_hits", _s8_spark, _s8_sql)


def _s9_spark(spark, sf):
    """By name, which the catalog does not know, falling back to the default
    collection; the latter is opened by name from the catalog."""
    path = scratch_path(spark, "collection")
    TB.full_load(_t2_spark(spark, sf), path, OPTS)
    name = f"docs_{path.rsplit('-', 1)[-1]}"
    SC.read_collection(spark, name, fmt="parquet", path=path).createOrReplaceTempView(name)
    return SC.read_collection(spark, f"no_{name}", default=name).select("filename", "chunk_no", "doc_link")


def _s9_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT filename, chunk_no, doc_link FROM {c}")


_pair("read_collection", _s9_spark, _s9_sql)


def _s7_spark(spark, sf):
    """Zip archives of at most 64 documents each, built as rows by Spark, then unpacked."""
    from docweave.sources.scan import unpack_archive_rows

    docs = fx.listing_paths(spark, sf).withColumn("blk", F.floor(F.col("doc_id") / 64))

    def zip_group(pdf):
        import io
        import zipfile

        import pandas as pd

        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for p, t in sorted(zip(pdf["path"], pdf["text"])):
                z.writestr(p, t or "")
        return pd.DataFrame({"path": [f"archive-{int(pdf['blk'].iloc[0])}.zip"], "content": [buf.getvalue()]})

    archives = docs.groupBy("blk").applyInPandas(zip_group, "path string, content binary")
    out = unpack_archive_rows(archives)
    return out.select("member", F.sha2("content", 256).alias("sha256"))


def _s7_sql():
    q = S.Q()
    lp = S.listing_paths(q)
    return q.render(f"SELECT path AS member, sha256(coalesce(text, '')) AS sha256 FROM {lp}")


_pair("unpack_archives", _s7_spark, _s7_sql)


def _x1_spark(spark, sf):
    """The release change set arrives as a file; a streaming run applies it."""
    from docweave.streaming.refresh_stream import ChunkTableState, stream_refresh

    old, new = _snaps(spark, sf)
    base = scratch_path(spark, "x1-base")
    TB.full_load(build_release_chunks(old, OPTS), base, OPTS)
    changes_dir = scratch_path(spark, "x1-changes")
    # two change files per file name, each a micro-batch of its own; the earlier change comes in the later batch
    # the pages are converted once, by all tasks; the one task of a file only copies rows
    staged = scratch_path(spark, "x1-staged")
    DF.release_changes(old, new, OPTS).write.parquet(staged)
    both = _with_stale_changes(spark.read.parquet(staged))
    both.where("seq = 2").coalesce(1).write.mode("append").parquet(changes_dir)
    both.where("seq = 1").coalesce(1).write.mode("append").parquet(changes_dir)
    st = stream_refresh(spark, changes_dir, ChunkTableState(spark, base), OPTS, files_per_batch=1)
    return st.read().select("filename", "chunk_no", "doc_link", "text")


def _x1_sql():
    q = S.Q()
    oc = S.build_release_chunks(q, S.fx_snapshot_old(q), OPTS, "oldc")
    ch = S.release_changes(q, OPTS)
    a = S.apply_changes(q, oc, ch, OPTS)
    return q.render(f"SELECT filename, chunk_no, doc_link, text FROM {a}")


_pair("stream_refresh", _x1_spark, _x1_sql)


def _x2_spark(spark, sf):
    from docweave.streaming.refresh_stream import stream_chunks

    src = scratch_path(spark, "x2-in")
    md = fx.fx_markdown(spark, sf)
    md.write.parquet(src)
    return stream_chunks(spark, src, scratch_path(spark, "x2-out"), OPTS, md.schema, key="doc", text="text").select(
        "filename", "chunk_no", "header1", "header2", "doc_link", "text"
    )


def _x2_sql():
    q = S.Q()
    c = S.chunk_docs(q, S.fx_markdown(q), "doc", "text", OPTS)
    return q.render(f"SELECT filename, chunk_no, header1, header2, doc_link, text FROM {c}")


_pair("stream_chunks", _x2_spark, _x2_sql)


# ------------------------------------------------------------ E3 / R6
CHUNK_TABLE_SCHEMA = "filename string, chunk_no bigint, header1 string, header2 string, header3 string, doc_link string, text string, vector array<float>"


def _e3_spark(spark, sf):
    from pyspark.sql import types as T

    old, new = _snaps(spark, sf)
    schema = T._parse_datatype_string(CHUNK_TABLE_SCHEMA)
    rows_ = TB.add_records(DF.release_changes(old, new, OPTS), schema, OPTS, lambda d: embed_chunks(d, OPTS))
    return DF.records_per_file(rows_)


def _e3_sql():
    q = S.Q()
    ch = S.release_changes(q, OPTS)
    q.add("e3_ups", f"SELECT filename, markdown FROM {ch} WHERE markdown IS NOT NULL AND status NOT IN ('deleted', 'delete')")
    c = S.chunk_docs(q, "e3_ups", "filename", "markdown", OPTS, "e3")
    return q.render(
        "SELECT filename, count(*) AS n_records, 'Successfully added ' || CAST(count(*) AS VARCHAR) || ' records from ' || filename AS message "
        f"FROM {c} GROUP BY filename"
    )


_pair("add_records", _e3_spark, _e3_sql)


def _r6_spark(spark, sf):
    """R6 on storage: a first run loads the old snapshot, a second one finds nothing
    to do, a third applies the new snapshot's changes; then the table is read back."""
    old, new = _snaps(spark, sf)
    base = scratch_path(spark, "refresh")

    def run(ref, snapshot, expect):
        got = RF.run_refresh(
            spark, "docs", ref, f"{base}/tracking", f"{base}/chunks",
            full_chunks=lambda: build_release_chunks(snapshot, OPTS),
            changes_since=lambda last: DF.release_changes(old, snapshot, OPTS),
            opts=OPTS,
        )
        if got != expect:
            raise RuntimeError(f"refresh to {ref}: {got}, not {expect}")

    run("v1", old, RF.FULL_LOAD)
    run("v1", old, RF.SKIP)
    run("v2", new, RF.INCREMENTAL)
    ref = RF.read_tracking_log(spark, f"{base}/tracking").select(F.col("last_updated_ref").alias("ref"))
    return spark.read.parquet(f"{base}/chunks").select(*CHUNK_COLS.split(", ")).join(ref)


def _r6_sql():
    return f"SELECT *, 'v2' AS ref FROM ({_o4_sql()})"


_pair("run_refresh", _r6_spark, _r6_sql)


def _l5_sql():
    from docweave.functions.vectors import distance_sql

    q = S.Q()
    fq = S.fx_questions(q, OPTS)
    ch = S.fx_chunks(q, OPTS)
    qe = S.embed_sql(q, fq, "request_id, q_no", "question", "lsh_qe", OPTS.embed_dim)
    planes = KN.hyperplanes(OPTS.lsh_bands, KN.MAX_BITS, OPTS.embed_dim)
    vals = ", ".join(
        f"({b}, {j}, [{', '.join(repr(float(x)) for x in h)}]::DOUBLE[])" for b, band in enumerate(planes) for j, h in enumerate(band)
    )
    dot = "list_sum(list_transform(list_zip({v}, p.h), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
    q.add("mean_v", f"SELECT list(m ORDER BY i) AS v FROM (SELECT i, round(avg(x::DOUBLE), 6) AS m FROM (SELECT unnest(vector) AS x, unnest(range(len(vector))) AS i FROM {ch}) GROUP BY i)")
    bits = f"(SELECT greatest({OPTS.lsh_bits}, least({KN.MAX_BITS}, ceil(log2(greatest(1.0, count(*) / {OPTS.lsh_bucket_rows}.0))))) FROM {ch})"
    q.add("planes", f"SELECT p.*, {dot.format(v='m.v')} AS shift FROM (VALUES {vals}) p(b, j, h), mean_v m WHERE p.j < {bits}")
    for name, keys, src, vec in (("ck", "c.filename, c.chunk_no", f"{ch} c", "c.vector"), ("qk", "e.request_id, e.q_no", f"{qe} e", "e.vec")):
        q.add(
            name,
            f"SELECT {keys}, p.b * {1 << KN.MAX_BITS} + sum(CASE WHEN {dot.format(v=vec)} >= p.shift THEN (1 << p.j) ELSE 0 END) AS bucket "
            f"FROM {src}, planes p GROUP BY {keys}, p.b",
        )
    q.add("cand", "SELECT DISTINCT qk.request_id, qk.q_no, ck.filename, ck.chunk_no FROM qk JOIN ck ON qk.bucket = ck.bucket")
    q.add(
        "lsh_pairs",
        f"SELECT a.request_id, a.q_no, a.filename, a.chunk_no, {distance_sql('e.vec', 'c.vector', OPTS.metric)} AS distance FROM cand a "
        f"JOIN {qe} e ON a.request_id = e.request_id AND a.q_no = e.q_no JOIN {ch} c ON a.filename = c.filename AND a.chunk_no = c.chunk_no",
    )
    return q.render(
        f"SELECT {HIT_COLS}, count(*) OVER (PARTITION BY request_id, q_no) AS n_found FROM (SELECT *, "
        "CAST(row_number() OVER (PARTITION BY request_id, q_no ORDER BY round(distance, 9), filename, chunk_no) AS BIGINT) AS rank "
        f"FROM lsh_pairs) WHERE rank <= {OPTS.k_neighbours}"
    )


SQL["ann_lsh"] = _l5_sql
