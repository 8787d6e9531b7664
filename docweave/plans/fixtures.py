"""Fixtures derived by Spark from the driver tables (never stored).

Each ``fx_*`` function has an SQL twin in ``docweave.plans.sqlcheck`` with
the same definition, used by the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.options import JobOptions
from docweave.session import table

REL_PREFIX = "out-prod/docs/p"
REL_SUFFIX = "/index.html"


def release_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` in snapshot shape (rel_path, html)."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        "page_id",
        F.concat(F.lit(REL_PREFIX), F.col("page_id").cast("string"), F.lit(REL_SUFFIX)).alias("rel_path"),
        "html",
    )


def fx_snapshot_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = release_pages(spark, sf_dir).where(F.pmod("page_id", F.lit(10)) != 0)
    return p.withColumn(
        "html", F.when(F.pmod("page_id", F.lit(7)) == 0, F.concat("html", F.lit("<!-- v1 -->"))).otherwise(F.col("html"))
    )


def fx_snapshot_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = release_pages(spark, sf_dir).where(F.pmod("page_id", F.lit(10)) != 1)
    no_article = F.replace(F.replace("html", F.lit("<article>"), F.lit("<div>")), F.lit("</article>"), F.lit("</div>"))
    return p.withColumn("html", F.when(F.pmod("page_id", F.lit(13)) == 0, no_article).otherwise(F.col("html")))


def fx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `pages` as one snapshot; every 13th page has no article."""
    no_article = F.replace(F.replace("html", F.lit("<article>"), F.lit("<div>")), F.lit("</article>"), F.lit("</div>"))
    return release_pages(spark, sf_dir).withColumn("html", F.when(F.pmod("page_id", F.lit(13)) == 0, no_article).otherwise(F.col("html")))


def fx_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Markdown document per conversation: '# Conversation {id}', then per turn
    '## Turn {turn} {role}' and the text, blank lines between."""
    c = table(spark, sf_dir, "conversations")
    piece = F.concat(F.lit("## Turn "), F.col("turn").cast("string"), F.lit(" "), F.col("role"), F.lit("\n\n"), F.col("text"))
    turns = F.array_sort(F.collect_list(F.struct("turn", piece.alias("piece"))))
    return c.groupBy("conv_id").agg(
        F.concat(
            F.lit("# Conversation "),
            F.col("conv_id").cast("string"),
            F.lit("\n\n"),
            F.array_join(F.transform(turns, lambda x: x["piece"]), "\n\n"),
        ).alias("text")
    ).select(
        F.concat(F.lit("en/conversations/c"), F.col("conv_id").cast("string"), F.lit(".md")).alias("doc"), "text"
    )


def listing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of `documents` as a repository tree: directory by doc_id % 3, then
    source/d{doc_id}, '.txt' when doc_id % 5 = 0 else '.md'."""
    d = table(spark, sf_dir, "documents")
    folder = F.element_at(F.array(F.lit("en/docs/"), F.lit("en/drafts/"), F.lit("site/")), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    ext = F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit(".txt")).otherwise(F.lit(".md"))
    return d.select("doc_id", F.concat(folder, F.lit("source/d"), F.col("doc_id").cast("string"), ext).alias("path"), "text")


def fx_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree listing as JSON bodies, one body per block of 100 paths (a
    paged listing), so no body holds the whole tree."""
    p = listing_paths(spark, sf_dir)
    return p.groupBy(F.floor(F.col("doc_id") / 100).alias("page")).agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(F.struct(F.col("path").alias("path")))).alias("tree"))).alias("body")
    )


STATUSES = ("added", "modified", "removed", "renamed", "unchanged")


def changed_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = listing_paths(spark, sf_dir)
    st = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    return p.select("doc_id", F.col("path").alias("filename"), st.alias("status"), "text")


def fx_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compare payload as JSON bodies, one per block of 100 files."""
    c = changed_file_rows(spark, sf_dir)
    return c.groupBy(F.floor(F.col("doc_id") / 100).alias("page")).agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("filename", "status"))).alias("files"))).alias("body")
    )


def fx_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File bodies: base64 of the text where doc_id is even, plain otherwise."""
    p = listing_paths(spark, sf_dir)
    b64 = F.pmod("doc_id", F.lit(2)) == 0
    return p.select(
        F.col("path").alias("filename"),
        F.when(b64, F.lit("base64")).otherwise(F.lit("")).alias("encoding"),
        F.when(b64, F.base64(F.encode("text", "UTF-8"))).otherwise(F.col("text")).alias("content"),
    )


def fx_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("product"),
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("ref"),
        "ts",
    )


def fx_tracking(spark: SparkSession, sf_dir: str, opts: JobOptions) -> DataFrame:
    """Tracking rows built from fx_versions: products sorted by name get, in
    order: the latest ref; an older ref; an older ref with version '0.9'; the
    latest ref with '0.9'; no row."""
    from docweave.sources.scan import latest_ref

    v = fx_versions(spark, sf_dir)
    latest = latest_ref(v)
    older = v.join(latest.select("product", F.col("ts").alias("_lts")), "product").where(F.col("ts") < F.col("_lts"))
    older_ref = older.groupBy("product").agg(F.max_by("ref", F.struct("ts", "ref")).alias("older_ref"))
    # the window runs over the per-product aggregate (one row per product)
    r = F.dense_rank().over(Window.orderBy("product"))
    j = latest.join(older_ref, "product", "left").withColumn("_r", r)
    cur = opts.updater_version
    return j.where(F.col("_r") <= 4).select(
        "product",
        F.when(F.col("_r").isin(1, 4), F.col("ref")).otherwise(F.col("older_ref")).alias("last_updated_ref"),
        F.when(F.col("_r").isin(3, 4), F.lit("0.9")).otherwise(F.lit(cur)).alias("last_updater_version"),
    )


def fx_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases: tag = brand + '/r' + block of 64 part keys; assets ordered by key."""
    p = table(spark, sf_dir, "part")
    tag = F.concat(F.col("p_brand"), F.lit("/r"), F.floor(F.col("p_partkey") / 64).cast("string"))
    asset = F.struct(
        F.col("p_partkey").alias("k"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("https://downloads.example.org/assets/"), F.col("p_partkey").cast("string"), F.lit(".zip")).alias("url"),
    )
    g = p.groupBy(tag.alias("tag")).agg(F.array_sort(F.collect_list(asset)).alias("_a"))
    return g.select("tag", F.transform("_a", lambda a: F.struct(a["name"].alias("name"), a["url"].alias("url"))).alias("assets"))


def fx_questions(spark: SparkSession, sf_dir: str, opts: JobOptions) -> DataFrame:
    """User turns as questions: request = conversation, q_no = order of the user
    turn; ' In <product>' appended where turn % 4 = 0; empty context on even ids."""
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    q = F.when(F.pmod("turn", F.lit(4)) == 0, F.concat("text", F.lit(f" In {opts.product_name}"))).otherwise(F.col("text"))
    ctx = F.when(F.pmod("conv_id", F.lit(2)) == 0, F.lit("")).otherwise(F.concat(F.lit("conversation "), F.col("conv_id").cast("string")))
    return c.select(
        F.col("conv_id").alias("request_id"),
        F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("bigint").alias("q_no"),
        q.alias("question"),
        ctx.alias("context"),
    )


def lookup_count(n):
    """Counts 0 (the default), 4, 35, and more than there are chunks."""
    return F.element_at(F.array(*[F.lit(x).cast("bigint") for x in (0, 4, 35, 1_000_000)]), (n + 1).cast("int"))


def fx_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("request_id"), F.col("text").alias("question"), lookup_count(F.pmod("item_id", F.lit(4))).alias("count"))


def fx_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    return c.groupBy(F.col("conv_id").alias("request_id")).agg(F.max_by("text", "turn").alias("answer"))
