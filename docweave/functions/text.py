"""Scalar text functions of the chunking and retrieval jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.regex import Rule, regex_quote, sql_lit

# The link rewrites applied to chunk text, in this order.
LINK_REWRITES = (("../../", "<web>"), ("../", "<web>"), (".md", ""), ("{.cInlineImage-full}", ""))
# Release path rewrites, in this order.
PATH_REWRITES = (("out-prod/", "en/"), ("/index.html", ".md"))

ANCHOR_DROP = Rule("[^0-9a-zA-Z-]", "")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def heading_anchor(text) -> Column:
    """lower-case, spaces to '-', keep [0-9a-zA-Z-], prefix '#'."""
    t = _c(text)
    return F.concat(F.lit("#"), ANCHOR_DROP.col(F.replace(F.lower(t), F.lit(" "), F.lit("-"))))


def heading_anchor_sql(e: str) -> str:
    inner = f"replace(lower({e}), ' ', '-')"
    return f"('#' || {ANCHOR_DROP.sql(inner)})"


def doc_link(filename, header2, header3, web_path: str, doc_path: str) -> Column:
    """web path + file name without the doc-path prefix and '.md' + '/' + anchor.

    The prefix is cut by length, as the reference does; H1 never gives an anchor.
    """
    f = _c(filename)
    n = len(doc_path)
    body = F.substring(f, F.lit(n + 1), F.length(f) - F.lit(n + 3))
    suffix = F.coalesce(heading_anchor(_c(header3)), heading_anchor(_c(header2)), F.lit(""))
    return F.concat(F.lit(web_path), body, F.lit("/"), suffix)


def doc_link_sql(f: str, h2: str, h3: str, web_path: str, doc_path: str) -> str:
    n = len(doc_path)
    body = f"substring({f}, {n + 1}, greatest(length({f}) - {n + 3}, 0))"
    suffix = f"coalesce({heading_anchor_sql(h3)}, {heading_anchor_sql(h2)}, '')"
    return f"({sql_lit(web_path)} || {body} || '/' || {suffix})"


def rewrite_links(text, web_path: str) -> Column:
    """four literal replacements in order."""
    c = _c(text)
    for a, b in LINK_REWRITES:
        c = F.replace(c, F.lit(a), F.lit(b.replace("<web>", web_path)))
    return c


def rewrite_links_sql(e: str, web_path: str) -> str:
    for a, b in LINK_REWRITES:
        e = f"replace({e}, {sql_lit(a)}, {sql_lit(b.replace('<web>', web_path))})"
    return e


def prefix_headings(h1, h2, h3, body) -> Column:
    """'#H1' + '\\n##H2' + '\\n###H3' (present ones only, no space) + '\\n' + body."""
    return F.concat(
        F.coalesce(F.concat(F.lit("#"), _c(h1)), F.lit("")),
        F.coalesce(F.concat(F.lit("\n##"), _c(h2)), F.lit("")),
        F.coalesce(F.concat(F.lit("\n###"), _c(h3)), F.lit("")),
        F.lit("\n"),
        _c(body),
    )


def prefix_headings_sql(h1: str, h2: str, h3: str, body: str) -> str:
    nl = "chr(10)"
    return (
        f"(coalesce('#' || {h1}, '') || coalesce({nl} || '##' || {h2}, '') || "
        f"coalesce({nl} || '###' || {h3}, '') || {nl} || {body})"
    )


def format_file_path(path) -> Column:
    """separators to '/', 'out-prod/' -> 'en/', '/index.html' -> '.md'."""
    c = F.replace(_c(path), F.lit("\\"), F.lit("/"))
    for a, b in PATH_REWRITES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def format_file_path_sql(e: str) -> str:
    e = f"replace({e}, chr(92), '/')"
    for a, b in PATH_REWRITES:
        e = f"replace({e}, {sql_lit(a)}, {sql_lit(b)})"
    return e


def content_hash(content) -> Column:
    """F8: SHA-256 hex of the bytes (strings hash as UTF-8)."""
    return F.sha2(_c(content), 256)


def scrub_question(q, phrase: str) -> Column:
    """drop the phrase everywhere, case-insensitively, leaving the spaces."""
    return F.regexp_replace(_c(q), F.lit("(?i)" + regex_quote(phrase)), F.lit(""))


def scrub_question_sql(e: str, phrase: str) -> str:
    return f"regexp_replace({e}, {sql_lit('(?i)' + regex_quote(phrase))}, '', 'g')"


def metadata_text(filename, doc_link_, h1, h2, h3=None) -> Column:
    """Metadata rendered as a dict-like text with only the keys that exist."""
    def kv(k, v):
        return F.concat(F.lit(f"'{k}': '"), v, F.lit("'"))

    parts = [kv("filename", _c(filename)), kv("doc_link", _c(doc_link_))]
    if h3 is not None:
        parts.append(kv("Header3", _c(h3)))
    parts += [kv("Header2", _c(h2)), kv("Header1", _c(h1))]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def metadata_text_sql(f: str, dl: str, h1: str, h2: str, h3: str | None = None) -> str:
    def kv(k, v):
        return f"('''{k}'': ''' || {v} || '''')"

    parts = [kv("filename", f), kv("doc_link", dl)]
    if h3 is not None:
        parts.append(kv("Header3", h3))
    parts += [kv("Header2", h2), kv("Header1", h1)]
    return "('{' || concat_ws(', ', " + ", ".join(parts) + ") || '}')"


def format_doc_block(content, metadata) -> Column:
    """'Document: {content: …, metadata:…}' + newline."""
    return F.concat(F.lit("Document: {content: "), _c(content), F.lit(", metadata:"), _c(metadata), F.lit("}\n"))


def format_doc_block_sql(content: str, metadata: str) -> str:
    return f"('Document: {{content: ' || {content} || ', metadata:' || {metadata} || '}}' || chr(10))"
