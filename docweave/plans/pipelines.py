"""Composed page -> chunk jobs (T3, T4) and the change-set jobs built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.html import article_markdown
from docweave.functions.text import format_file_path
from docweave.operators.chunk import chunk_docs
from docweave.options import JobOptions
from docweave.sources.scan import decode_content, ignore_paths_predicate


def drop_ignored_paths(snapshot: DataFrame, opts: JobOptions, col: str = "rel_path") -> DataFrame:
    """Drop exact relative paths of the ignore set (full relative path)."""
    if not opts.ignore_rel_paths:
        return snapshot
    return snapshot.where(~F.col(col).isin(list(opts.ignore_rel_paths)))


def release_markdown(snapshot: DataFrame, opts: JobOptions, drop_empty: bool = True, keep: tuple = ()) -> DataFrame:
    """P3 -> F6/F7 -> P4 -> F5: snapshot (rel_path, html) -> (filename, markdown).

    The Markdown is produced through a one-element ``explode_outer`` so the
    P4 filter stays above it and the conversion runs once per page.
    """
    s = drop_ignored_paths(snapshot, opts)
    md = s.select(
        *keep,
        format_file_path(F.col("rel_path")).alias("filename"),
        F.explode_outer(F.array(article_markdown(F.col("html")))).alias("markdown"),
    )
    if not drop_empty:
        return md
    return md.where(F.col("markdown").isNotNull() & (F.col("markdown") != ""))


def build_release_chunks(snapshot: DataFrame, opts: JobOptions) -> DataFrame:
    """Every page of a release snapshot -> chunks (pages without an article
    give no section). No exchange: each page is converted and split in its row."""
    s = drop_ignored_paths(snapshot, opts)
    md = s.select(format_file_path(F.col("rel_path")).alias("filename"), article_markdown(F.col("html")).alias("markdown"))
    return chunk_docs(md, opts, key="filename", text="markdown")


def build_repo_chunks(paths: DataFrame, contents: DataFrame, opts: JobOptions) -> DataFrame:
    """T4: listed Markdown paths -> fetched (decoded) content -> chunks.

    ``paths``: (path); ``contents``: (filename, encoding, content).
    """
    body = contents.select("filename", decode_content(F.col("encoding"), F.col("content")).alias("markdown"))
    files = paths.where(ignore_paths_predicate(F.col("path"), opts)).select(F.col("path").alias("filename"))
    return chunk_docs(files.join(body, "filename"), opts, key="filename", text="markdown")
