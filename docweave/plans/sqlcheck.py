"""SQL twins of the jobs, for the DuckDB check (views of the driver tables are
registered by the checker). Each builder appends CTEs to a ``Q``."""

from __future__ import annotations

from docweave.functions.regex import sql_lit
from docweave.functions.text import (
    doc_link_sql,
    format_file_path_sql,
    prefix_headings_sql,
    rewrite_links_sql,
)
from docweave.operators.chunk import NONPRINT_RE, STRIP_RE
from docweave.options import JobOptions

NL = "chr(10)"


class Q:
    def __init__(self):
        self.ctes: list[tuple[str, str]] = []
        self._names: set[str] = set()

    def add(self, name: str, sql: str) -> str:
        if name not in self._names:
            self.ctes.append((name, sql))
            self._names.add(name)
        return name

    def has(self, name: str) -> bool:
        return name in self._names

    def render(self, final: str) -> str:
        if not self.ctes:
            return final
        return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in self.ctes) + "\n" + final


# ---------------------------------------------------------------- pages
# A second reading of the HTML jobs for the check, as a chain of replacements for
# the kind of page the tables hold (flat lists, no tables, no marked inline text);
# it shares nothing with the walk of docweave.functions.html.

def article_sql(e: str) -> str:
    return f"CASE WHEN regexp_matches({e}, '(?is)<article[ >]') THEN '<article>' || regexp_extract({e}, '(?is)<article(\\s[^>]*)?>(.*?)</article>', 2) || '</article>' END"


def markdown_sql(e: str) -> str:
    for pattern, by in (
        ("(?is)<script[ >].*?</script>|<style[ >].*?</style>|<!--.*?-->|<![a-z][^>]*>", "''"),
        ("[ \\t\\r\\n]+", "' '"),
        *((f"(?i)<h{n}>(.*?)</h{n}>", f"'<p>{'#' * n} \\1<p>'") for n in range(1, 7)),
        ('(?i)<a href="([^"]*)">([^<]*)</a>', "'[\\2](\\1)'"),
        ("(?i) ?<br/?> ?", "'  ' || chr(10)"),
        ("(?i) ?<li> ?", "chr(10) || '* '"),
        ("(?i)</li>", "''"),
        ("(?i)</?(p|div|ul|nav|footer|title|head|body|html)( [^>]*)?>", "chr(10) || chr(10)"),
        ("(?i)</?[a-z][^>]*>", "''"),
        ("&copy;", "'©'"),
        ("&middot;", "'·'"),
        ("&quot;", "chr(34)"),
        ("&lt;", "'<'"),
        ("&gt;", "'>'"),
        ("&amp;?", "'&'"),
        ("[ \\n]*\\n\\n[ \\n]*", "chr(10) || chr(10)"),
        ("^[ \\n]+|[ \\n]+$", "''"),
    ):
        e = f"regexp_replace({e}, '{pattern}', {by}, 'g')"
    return f"nullif({e}, '')"


# ---------------------------------------------------------------- fixtures

def release_pages(q: Q) -> str:
    return q.add(
        "release_pages",
        "SELECT page_id, 'out-prod/docs/p' || CAST(page_id AS VARCHAR) || '/index.html' AS rel_path, html FROM pages",
    )


def fx_pages(q: Q) -> str:
    rp = release_pages(q)
    return q.add(
        "fx_pages",
        "SELECT page_id, rel_path, CASE WHEN page_id % 13 = 0 THEN "
        f"replace(replace(html, '<article>', '<div>'), '</article>', '</div>') ELSE html END AS html FROM {rp}",
    )


def fx_snapshot_old(q: Q) -> str:
    rp = release_pages(q)
    return q.add(
        "fx_snapshot_old",
        f"SELECT page_id, rel_path, CASE WHEN page_id % 7 = 0 THEN html || '<!-- v1 -->' ELSE html END AS html "
        f"FROM {rp} WHERE page_id % 10 <> 0",
    )


def fx_snapshot_new(q: Q) -> str:
    rp = release_pages(q)
    return q.add(
        "fx_snapshot_new",
        "SELECT page_id, rel_path, CASE WHEN page_id % 13 = 0 THEN "
        "replace(replace(html, '<article>', '<div>'), '</article>', '</div>') ELSE html END AS html "
        f"FROM {rp} WHERE page_id % 10 <> 1",
    )


def fx_markdown(q: Q) -> str:
    return q.add(
        "fx_markdown",
        f"SELECT 'en/conversations/c' || CAST(conv_id AS VARCHAR) || '.md' AS doc, "
        f"'# Conversation ' || CAST(conv_id AS VARCHAR) || {NL} || {NL} || "
        f"string_agg('## Turn ' || CAST(turn AS VARCHAR) || ' ' || role || {NL} || {NL} || text, {NL} || {NL} ORDER BY turn) AS text "
        f"FROM conversations GROUP BY conv_id",
    )


def listing_paths(q: Q) -> str:
    return q.add(
        "listing_paths",
        "SELECT doc_id, (['en/docs/', 'en/drafts/', 'site/'])[(doc_id % 3) + 1] || 'source/d' || CAST(doc_id AS VARCHAR) || "
        "CASE WHEN doc_id % 5 = 0 THEN '.txt' ELSE '.md' END AS path, text FROM documents",
    )


def changed_file_rows(q: Q) -> str:
    lp = listing_paths(q)
    return q.add(
        "changed_file_rows",
        "SELECT doc_id, path AS filename, (['added', 'modified', 'removed', 'renamed', 'unchanged'])[(doc_id % 5) + 1] AS status, text "
        f"FROM {lp}",
    )


def fx_content(q: Q) -> str:
    lp = listing_paths(q)
    return q.add(
        "fx_content",
        "SELECT path AS filename, CASE WHEN doc_id % 2 = 0 THEN 'base64' ELSE '' END AS encoding, "
        f"CASE WHEN doc_id % 2 = 0 THEN to_base64(encode(text)) ELSE text END AS content FROM {lp}",
    )


def fx_versions(q: Q) -> str:
    return q.add("fx_versions", "SELECT event_type AS product, 'v' || CAST(event_id AS VARCHAR) AS ref, ts FROM events")


def latest_ref(q: Q, src: str, name: str = "latest_ref") -> str:
    return q.add(
        name,
        f"SELECT product, arg_max(ref, (ts, ref)) AS ref, max(ts) AS ts FROM {src} GROUP BY product",
    )


def fx_tracking(q: Q, opts: JobOptions) -> str:
    v = fx_versions(q)
    lr = latest_ref(q, v)
    q.add(
        "older_ref",
        f"SELECT v.product, arg_max(v.ref, (v.ts, v.ref)) AS older_ref FROM {v} v JOIN {lr} l ON v.product = l.product "
        "WHERE v.ts < l.ts GROUP BY v.product",
    )
    cur = sql_lit(opts.updater_version)
    return q.add(
        "fx_tracking",
        "SELECT product, CASE WHEN r IN (1, 4) THEN ref ELSE older_ref END AS last_updated_ref, "
        f"CASE WHEN r IN (3, 4) THEN '0.9' ELSE {cur} END AS last_updater_version FROM ("
        f"SELECT l.product, l.ref, o.older_ref, dense_rank() OVER (ORDER BY l.product) AS r FROM {lr} l "
        "LEFT JOIN older_ref o ON l.product = o.product) WHERE r <= 4",
    )


def fx_release_flat(q: Q) -> str:
    return q.add(
        "fx_release_flat",
        "SELECT p_brand || '/r' || CAST(floor(p_partkey / 64) AS BIGINT) AS tag, p_partkey AS k, p_name AS name, "
        "'https://downloads.example.org/assets/' || CAST(p_partkey AS VARCHAR) || '.zip' AS url FROM part",
    )


def fx_questions(q: Q, opts: JobOptions) -> str:
    suffix = sql_lit(f" In {opts.product_name}")
    return q.add(
        "fx_questions",
        "SELECT conv_id AS request_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS q_no, "
        f"CASE WHEN turn % 4 = 0 THEN text || {suffix} ELSE text END AS question, "
        "CASE WHEN conv_id % 2 = 0 THEN '' ELSE 'conversation ' || CAST(conv_id AS VARCHAR) END AS context "
        "FROM conversations WHERE role = 'user'",
    )


def fx_lookup(q: Q) -> str:
    return q.add(
        "fx_lookup",
        "SELECT item_id AS request_id, text AS question, CAST([0, 4, 35, 1000000][item_id % 4 + 1] AS BIGINT) AS count FROM benchmark",
    )


def fx_answers(q: Q) -> str:
    return q.add(
        "fx_answers",
        "SELECT conv_id AS request_id, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id",
    )


# ---------------------------------------------------------------- chunking

def clean_line_sql(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, {sql_lit(STRIP_RE)}, '', 'g'), {sql_lit(NONPRINT_RE)}, '', 'g')"


def split_by_heading(q: Q, src: str, key: str, text: str, p: str = "t1") -> str:
    """T1 as window SQL; the code-fence state machine is a list_reduce fold."""
    W = f"PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    kind = (
        "CASE WHEN starts_with(x, '```') THEN CASE WHEN (length(x) - length(replace(x, '```', ''))) // 3 = 1 THEN 1 ELSE 2 END "
        "WHEN starts_with(x, '~~~') THEN 3 ELSE 0 END"
    )
    opens = "(acc.open = 0 AND (f.kind = 1 OR f.kind = 3))"
    closes = "((acc.open = 1 AND (f.kind = 1 OR f.kind = 2)) OR (acc.open = 3 AND f.kind = 3))"
    step = (
        f"lambda acc, f: {{'open': CASE WHEN {opens} THEN f.kind WHEN {closes} THEN 0 ELSE acc.open END, "
        f"'opens': CASE WHEN {opens} THEN list_append(acc.opens, f.pos) ELSE acc.opens END, "
        f"'closes': CASE WHEN {closes} THEN list_append(acc.closes, f.pos) ELSE acc.closes END}}"
    )
    init = "{'open': 0, 'opens': []::BIGINT[], 'closes': []::BIGINT[]}"
    fences = f"list_filter(list_transform(arr, lambda x, i: {{'pos': (i - 1)::BIGINT, 'kind': {kind}}}), lambda f: f.kind > 0)"
    q.add(
        f"{p}_arr",
        f"SELECT k, arr, list_reduce({fences}, {step}, {init}) AS st FROM ("
        f"SELECT {key} AS k, list_transform(string_split({text}, {NL}), lambda x: {clean_line_sql('x')}) AS arr "
        f"FROM {src} WHERE {text} IS NOT NULL)",
    )
    q.add(f"{p}_lines", f"SELECT k, unnest(arr) AS s, unnest(range(len(arr))) AS pos, st FROM {p}_arr")
    q.add(
        f"{p}_code",
        "SELECT k, s, pos, (o_last IS NOT NULL AND (c_prev IS NULL OR o_last > c_prev)) AS in_code FROM ("
        "SELECT *, max(CASE WHEN role = 1 THEN pos END) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o_last, "
        "max(CASE WHEN role = 2 THEN pos END) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c_prev FROM ("
        "SELECT k, s, pos, CASE WHEN list_contains(st.opens, pos) THEN 1 WHEN list_contains(st.closes, pos) THEN 2 END AS role "
        f"FROM {p}_lines))",
    )
    q.add(
        f"{p}_lvl",
        "SELECT *, trim(substring(s, lvl + 1)) AS v FROM (SELECT *, CASE "
        "WHEN NOT in_code AND (s = '##' OR starts_with(s, '## ')) THEN 2 "
        "WHEN NOT in_code AND (s = '#' OR starts_with(s, '# ')) THEN 1 ELSE 0 END AS lvl "
        f"FROM {p}_code)",
    )
    q.add(
        f"{p}_carry",
        "SELECT k, pos, s, in_code, lvl, "
        "max(CASE WHEN lvl = 1 THEN pos END) OVER w AS p1, last_value(CASE WHEN lvl = 1 THEN v END IGNORE NULLS) OVER w AS v1, "
        "max(CASE WHEN lvl = 2 THEN pos END) OVER w AS p2, last_value(CASE WHEN lvl = 2 THEN v END IGNORE NULLS) OVER w AS v2 "
        f"FROM {p}_lvl WINDOW w AS ({W})",
    )
    q.add(
        f"{p}_content",
        "SELECT k, pos, s, v1 AS header1, CASE WHEN p2 > coalesce(p1, -1) THEN v2 END AS header2, "
        f"CAST(NULL AS VARCHAR) AS header3 FROM {p}_carry WHERE in_code OR (lvl = 0 AND s <> '')",
    )
    q.add(
        f"{p}_isl",
        "SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER "
        "(PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chunk_no, "
        f"CASE WHEN is_new THEN s WHEN pos - prev_pos = 1 THEN {NL} || s ELSE '  ' || {NL} || s END AS piece FROM ("
        "SELECT *, lag(pos) OVER w2 AS prev_pos, (lag(pos) OVER w2 IS NULL OR header1 IS DISTINCT FROM lag(header1) OVER w2 "
        f"OR header2 IS DISTINCT FROM lag(header2) OVER w2) AS is_new FROM {p}_content WINDOW w2 AS (PARTITION BY k ORDER BY pos))",
    )
    return q.add(
        p,
        "SELECT k, CAST(chunk_no AS BIGINT) AS chunk_no, any_value(header1) AS header1, any_value(header2) AS header2, "
        f"any_value(header3) AS header3, string_agg(piece, '' ORDER BY pos) AS content FROM {p}_isl GROUP BY k, chunk_no",
    )


def chunk_docs(q: Q, src: str, key: str, text: str, opts: JobOptions, p: str = "t2") -> str:
    t1 = split_by_heading(q, src, key, text, p + "_t1")
    return q.add(
        p,
        "SELECT k AS filename, chunk_no, header1, header2, header3, "
        f"{doc_link_sql('k', 'header2', 'header3', opts.web_path, opts.doc_path)} AS doc_link, "
        f"{prefix_headings_sql('header1', 'header2', 'header3', rewrite_links_sql('content', opts.web_path))} AS text FROM {t1}",
    )


def release_markdown(q: Q, snap: str, opts: JobOptions, p: str = "rmd") -> str:
    ign = ""
    if opts.ignore_rel_paths:
        ign = "WHERE rel_path NOT IN (" + ", ".join(sql_lit(x) for x in opts.ignore_rel_paths) + ")"
    return q.add(
        p,
        f"SELECT filename, markdown FROM (SELECT {format_file_path_sql('rel_path')} AS filename, "
        f"{markdown_sql(article_sql('html'))} AS markdown FROM {snap} {ign}) WHERE markdown IS NOT NULL AND markdown <> ''",
    )


def build_release_chunks(q: Q, snap: str, opts: JobOptions, p: str = "rel") -> str:
    md = release_markdown(q, snap, opts, p + "_md")
    return chunk_docs(q, md, "filename", "markdown", opts, p)


# ---------------------------------------------------------------- diffs

def snapshot_diff(q: Q, opts: JobOptions) -> str:
    old, new = fx_snapshot_old(q), fx_snapshot_new(q)
    ign = ""
    if opts.ignore_rel_paths:
        ign = "WHERE rel_path NOT IN (" + ", ".join(sql_lit(x) for x in opts.ignore_rel_paths) + ")"
    q.add("old_h", f"SELECT rel_path, sha256(html) AS o_sha FROM {old} {ign}")
    q.add("new_h", f"SELECT rel_path, sha256(html) AS n_sha FROM {new} {ign}")
    return q.add(
        "diff",
        f"SELECT rel_path, {format_file_path_sql('rel_path')} AS filename, status FROM ("
        "SELECT coalesce(o.rel_path, n.rel_path) AS rel_path, CASE WHEN o.o_sha IS NULL THEN 'added' "
        "WHEN n.n_sha IS NULL THEN 'deleted' WHEN o.o_sha <> n.n_sha THEN 'modified' ELSE 'unchanged' END AS status "
        "FROM old_h o FULL OUTER JOIN new_h n ON o.rel_path = n.rel_path)",
    )


def changed_markdown(q: Q, opts: JobOptions, status: str) -> str:
    d = snapshot_diff(q, opts)
    new = fx_snapshot_new(q)
    q.add(f"pages_{status}", f"SELECT * FROM {new} WHERE rel_path IN (SELECT rel_path FROM {d} WHERE status = '{status}')")
    return release_markdown(q, f"pages_{status}", opts, f"md_{status}")


def path_predicate_sql(col: str, opts: JobOptions) -> str:
    p = f"(ends_with({col}, '.md') AND contains({col}, {sql_lit(opts.main_dir)})"
    for x in opts.ignore_files:
        p += f" AND NOT contains({col}, {sql_lit(x)})"
    return p + ")"


def decoded_content(q: Q) -> str:
    c = fx_content(q)
    return q.add(
        "decoded_content",
        f"SELECT filename, CASE WHEN contains(coalesce(encoding, ''), 'base64') THEN coalesce(decode(from_base64(content)), '') "
        f"ELSE content END AS markdown FROM {c}",
    )


def repo_chunks(q: Q, opts: JobOptions, p: str = "repo") -> str:
    lp = listing_paths(q)
    dc = decoded_content(q)
    q.add(
        f"{p}_files",
        f"SELECT d.filename, d.markdown FROM {dc} d JOIN {lp} l ON d.filename = l.path WHERE {path_predicate_sql('l.path', opts)}",
    )
    return chunk_docs(q, f"{p}_files", "filename", "markdown", opts, p)


# ---------------------------------------------------------------- tables / refresh

def fx_kv(q: Q) -> str:
    q.add("kv_target", "SELECT doc_id AS pk, lang, source, n_chars FROM documents")
    return q.add("kv_src", "SELECT doc_id * 2 AS pk, upper(lang) AS lang, n_chars + 1 AS n_chars, 'extra' AS note FROM documents")


def commit_actions(q: Q, opts: JobOptions) -> str:
    c = changed_file_rows(q)
    return q.add(
        "commit_actions",
        "SELECT filename, CASE WHEN status IN ('added', 'modified') THEN 'upsert' ELSE 'delete' END AS action "
        f"FROM {c} WHERE {path_predicate_sql('filename', opts)} AND status IN ('added', 'modified', 'removed')",
    )


def release_changes(q: Q, opts: JobOptions) -> str:
    d = snapshot_diff(q, opts)
    new = fx_snapshot_new(q)
    q.add("chg_pages", f"SELECT n.*, d.status FROM {new} n JOIN {d} d ON n.rel_path = d.rel_path WHERE d.status IN ('added', 'modified')")
    md = release_markdown(q, "chg_pages", opts, "chg_md")
    return q.add(
        "release_changes",
        f"SELECT filename, 'upsert' AS status, markdown FROM {md} UNION ALL "
        f"SELECT filename, status, CAST(NULL AS VARCHAR) AS markdown FROM {d} WHERE status = 'deleted'",
    )


def apply_changes(q: Q, old_chunks: str, changes: str, opts: JobOptions, p: str = "applied") -> str:
    q.add(f"{p}_ups", f"SELECT filename, markdown FROM {changes} WHERE markdown IS NOT NULL AND status NOT IN ('deleted', 'delete')")
    fresh = chunk_docs(q, f"{p}_ups", "filename", "markdown", opts, f"{p}_fresh")
    cols = "filename, chunk_no, header1, header2, header3, doc_link, text"
    return q.add(
        p,
        f"SELECT {cols} FROM {old_chunks} WHERE filename NOT IN (SELECT filename FROM {changes}) UNION ALL SELECT {cols} FROM {fresh}",
    )


# ---------------------------------------------------------------- retrieval

def embed_sql(q: Q, src: str, keys: str, text: str, name: str, dim: int) -> str:
    """E1 in SQL: (keys, vec FLOAT[])."""
    from docweave.functions.vectors import EMBED_TOKEN_RE_SQL

    toks = f"regexp_extract_all(lower(coalesce({text}, '')), {sql_lit(EMBED_TOKEN_RE_SQL)})"
    q.add(
        f"{name}_c",
        f"SELECT {keys}, list_transform(range({dim}), lambda i: len(list_filter(b, lambda x: x = i))::DOUBLE) AS c FROM "
        f"(SELECT {keys}, list_transform({toks}, lambda w: (('0x' || substr(md5(w), 1, 8))::BIGINT % {dim})) AS b FROM {src})",
    )
    return q.add(
        name,
        f"SELECT {keys}, list_transform(c, lambda v: (CASE WHEN n > 0 THEN v / n ELSE 0.0 END)::FLOAT) AS vec FROM "
        f"(SELECT *, sqrt(list_reduce(list_transform(c, lambda v: v * v), lambda s, t: s + t, 0.0::DOUBLE)) AS n FROM {name}_c)",
    )


def fx_chunks(q: Q, opts: JobOptions) -> str:
    a = chunk_docs(q, fx_markdown(q), "doc", "text", opts, "fxc_md")
    b = build_release_chunks(q, fx_pages(q), opts, "fxc_rel")
    q.add("fxc_all", f"SELECT * FROM {a} UNION ALL SELECT * FROM {b}")
    e = embed_sql(q, "fxc_all", "filename, chunk_no", "text", "fxc_emb", opts.embed_dim)
    return q.add("fx_chunks", f"SELECT a.*, e.vec AS vector FROM fxc_all a JOIN {e} e USING (filename, chunk_no)")


def knn_sql(q: Q, qsrc: str, qkeys: str, qtext: str, chunks: str, k: int, opts: JobOptions, name: str = "hits") -> str:
    from docweave.functions.vectors import distance_sql

    qe = embed_sql(q, qsrc, qkeys, qtext, f"{name}_qe", opts.embed_dim)
    part = ", ".join(x.strip() for x in qkeys.split(","))
    q.add(
        f"{name}_pairs",
        f"SELECT {', '.join('q.' + x.strip() for x in qkeys.split(','))}, c.filename, c.chunk_no, "
        f"{distance_sql('q.vec', 'c.vector', opts.metric)} AS distance FROM {qe} q, {chunks} c",
    )
    return q.add(
        name,
        f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {part} ORDER BY round(distance, 9), filename, chunk_no) AS BIGINT) AS rank "
        f"FROM {name}_pairs) WHERE rank <= {k}",
    )


def scrubbed_questions(q: Q, opts: JobOptions) -> str:
    from docweave.functions.text import scrub_question_sql

    fq = fx_questions(q, opts)
    return q.add(
        "clean_q",
        f"SELECT request_id, q_no, {scrub_question_sql('question', opts.scrub_phrase)} AS question, "
        f"coalesce(nullif(context, ''), first(question ORDER BY q_no) OVER (PARTITION BY request_id)) AS context FROM {fq}",
    )


def bm25(q: Q, pairs: str, questions: str, chunks: str, name: str = "bm25") -> str:
    from docweave.functions.vectors import EMBED_TOKEN_RE_SQL

    w = lambda e: f"regexp_extract_all(lower(coalesce({e}, '')), {sql_lit(EMBED_TOKEN_RE_SQL)})"
    q.add(f"{name}_tf", f"SELECT filename, chunk_no, term, count(*) AS tf FROM (SELECT filename, chunk_no, unnest({w('text')}) AS term FROM {chunks}) GROUP BY ALL")
    q.add(f"{name}_df", f"SELECT term, count(*) AS df FROM {name}_tf GROUP BY term")
    q.add(f"{name}_len", f"SELECT filename, chunk_no, len({w('text')}) AS dl FROM {chunks}")
    q.add(f"{name}_coll", f"SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM {name}_len")
    q.add(f"{name}_qt", f"SELECT DISTINCT request_id, q_no, unnest({w('question')}) AS term FROM {questions}")
    q.add(
        f"{name}_s",
        "SELECT p.request_id, p.q_no, p.filename, p.chunk_no, sum(CAST(round(ln(1.0 + (c.n_docs - d.df + 0.5) / (d.df + 0.5)) * t.tf * 2.2 / "
        "(t.tf + 1.2 * (0.25 + 0.75 * l.dl / c.avgdl)) * 1e9) AS BIGINT)) / 1e9 AS score "
        f"FROM {pairs} p JOIN {name}_qt qt ON p.request_id = qt.request_id AND p.q_no = qt.q_no "
        f"JOIN {name}_tf t ON t.filename = p.filename AND t.chunk_no = p.chunk_no AND t.term = qt.term "
        f"JOIN {name}_df d ON d.term = qt.term JOIN {name}_len l ON l.filename = p.filename AND l.chunk_no = p.chunk_no, {name}_coll c "
        "GROUP BY ALL",
    )
    return q.add(
        name,
        f"SELECT p.*, coalesce(s.score, 0.0) AS score FROM {pairs} p LEFT JOIN {name}_s s "
        "ON p.request_id = s.request_id AND p.q_no = s.q_no AND p.filename = s.filename AND p.chunk_no = s.chunk_no",
    )


def blocks(q: Q, hits: str, chunks: str, name: str = "blocks") -> str:
    from docweave.functions.text import format_doc_block_sql, metadata_text_sql
    from docweave.functions.tokens import token_count_sql

    meta = metadata_text_sql("c.filename", "c.doc_link", "c.header1", "c.header2", "c.header3")
    q.add(
        f"{name}_b",
        f"SELECT h.request_id, h.q_no, h.rank, h.filename, h.chunk_no, {format_doc_block_sql('c.text', meta)} AS block "
        f"FROM {hits} h JOIN {chunks} c ON h.filename = c.filename AND h.chunk_no = c.chunk_no",
    )
    return q.add(name, f"SELECT *, {token_count_sql('block')} AS n_tokens FROM {name}_b")


def budget(q: Q, blk: str, b: int, name: str) -> str:
    return q.add(
        name,
        "SELECT * FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY request_id ORDER BY q_no, rank "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tokens FROM {blk}) WHERE cum_tokens <= {b}",
    )


def reranked(q: Q, hits: str, questions: str, chunks: str, top_n: int, name: str = "reranked") -> str:
    b = bm25(q, hits, questions, chunks, f"{name}_bm25")
    return q.add(
        name,
        "SELECT * EXCLUDE (rank, score), rank2 AS rank, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY request_id, q_no "
        f"ORDER BY round(score, 9) DESC, round(distance, 9), filename, chunk_no) AS BIGINT) AS rank2 FROM {b}) WHERE rank2 <= {top_n}",
    )


def prompts(q: Q, opts: JobOptions, b: int, name: str = "prompts", rerank: bool = False) -> str:
    from docweave.operators.retrieve import DEFAULT_USER_TEMPLATE
    from docweave.options import NO_DOCS_TEXT

    cq = scrubbed_questions(q, opts)
    ch = fx_chunks(q, opts)
    hits = knn_sql(q, cq, "request_id, q_no", "question", ch, opts.k_neighbours, opts, "e5")
    if rerank:
        hits = reranked(q, hits, cq, ch, opts.top_docs)
    blk = blocks(q, hits, ch, "e6_blocks")
    kept = budget(q, blk, b, f"{name}_kept")
    q.add(
        f"{name}_docs",
        f"SELECT request_id, string_agg(block, '' ORDER BY q_no, rank) AS docs, count(*) AS n_docs, sum(n_tokens) AS docs_tokens FROM {kept} GROUP BY request_id",
    )
    q.add(
        f"{name}_reqs",
        "SELECT request_id, '[' || string_agg('''' || question || '''', ', ' ORDER BY q_no) || ']' AS qs, first(context ORDER BY q_no) AS ctx "
        f"FROM {cq} GROUP BY request_id",
    )
    pre, rest = DEFAULT_USER_TEMPLATE.split("{questions}")
    mid, rest2 = rest.split("{context}")
    mid2, post = rest2.split("{docs}")
    ws = "[ \\t\\n\\r\\f\\x0B]"
    docs_text = (
        f"CASE WHEN r.request_id NOT IN (SELECT request_id FROM {hits}) THEN {sql_lit(NO_DOCS_TEXT)} "
        f"ELSE regexp_replace(coalesce(d.docs, ''), {sql_lit('^' + ws + '+|' + ws + '+$')}, '', 'g') END"
    )
    return q.add(
        name,
        f"SELECT r.request_id, {sql_lit(pre)} || r.qs || {sql_lit(mid)} || coalesce(r.ctx, 'None') || {sql_lit(mid2)} || {docs_text} || {sql_lit(post)} AS user_prompt, "
        "CAST(coalesce(d.n_docs, 0) AS BIGINT) AS n_docs, CAST(coalesce(d.docs_tokens, 0) AS BIGINT) AS docs_tokens "
        f"FROM {name}_reqs r LEFT JOIN {name}_docs d ON r.request_id = d.request_id",
    )
