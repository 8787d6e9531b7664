"""Table maintenance (K1-K10), change application (O2-O5), predicates on chunk
tables (P1, P5-P7), write counts and existence checks (A3, A4), batch numbers
(W3) and first-match lookups (W5).

Parquet tables take no MERGE or DELETE, so every mutation is an anti join
plus a union written to a fresh staged path, then swapped in; a job never
reads and overwrites the same path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docweave.functions.html import html_to_markdown
from docweave.functions.text import metadata_text
from docweave.operators.chunk import chunk_docs
from docweave.options import JobOptions
from docweave.session import stored

# ------------------------------------------------------------------ K5 / K6


# Declared field types -> Spark types (everything else is text).
TYPE_MAP = {"VARCHAR": T.StringType(), "FLOAT_VECTOR": T.ArrayType(T.FloatType())}
VARCHAR_LENGTH = 100


def build_schema(fields) -> T.StructType:
    """K5 schema builder: fields are (name, type, max_length, is_primary)."""
    out = []
    for name, typ, *_ in fields:
        out.append(T.StructField(name, TYPE_MAP.get(str(typ), T.StringType()), True))
    return T.StructType(out)


def ddl_of(fields) -> str:
    """Column DDL; VARCHAR maps to VARCHAR(100) whatever max_length says, every
    other scalar to text."""
    sql = {"VARCHAR": f"VARCHAR({VARCHAR_LENGTH})", "FLOAT_VECTOR": "ARRAY<FLOAT>"}
    return ", ".join(f"`{name}` {sql.get(str(typ), 'STRING')}" for name, typ, *_ in fields)


def create_table(spark: SparkSession, name: str, fields, location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS … USING parquet."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_of(fields)}) USING parquet{loc}")


def primary_key_violations(df: DataFrame, pk: str) -> DataFrame:
    """K5 primary key as a check: keys held by more than one row."""
    return df.groupBy(pk).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def describe_table(spark: SparkSession, df_or_name) -> DataFrame:
    """K6: (name, type, max_length) per column; ``max_length`` is the declared
    length of a VARCHAR column, else null. An unknown table gives no rows."""
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()), T.StructField("max_length", T.LongType())])
    if isinstance(df_or_name, str):
        if not spark.catalog.tableExists(df_or_name):
            return spark.createDataFrame([], schema)
        # the declared types, which a read of the table shows as text; partition details follow after an empty name
        described = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE {df_or_name}").collect()]
        names = [n for n, _ in described]
        declared = dict(described[: next((i for i, n in enumerate(names) if n in ("", "# Partition Information")), len(names))])
    else:
        declared = dict(df_or_name.dtypes)
    rows = []
    for name, kind in declared.items():
        length = kind[len("varchar(") : -1] if kind.startswith("varchar(") else None
        rows.append((name, "string" if length else kind, int(length) if length else None))
    return spark.createDataFrame(rows, schema)


def table_exists(spark: SparkSession, name: str) -> bool:
    """K7 catalog form."""
    return spark.catalog.tableExists(name)


def registry_has(registry: DataFrame, name: str, col: str = "name") -> DataFrame:
    """K7 registry form / A4: one row, ``exists`` = a row with this name is present."""
    return registry.where(F.col(col) == name).limit(1).agg((F.count(F.lit(1)) > 0).alias("exists"))


def drop_table(spark: SparkSession, name: str) -> None:
    """K8."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# ------------------------------------------------------------------ K1-K4


def bucket_of(filename: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(filename), F.lit(n)).cast("int")


def buckets_for(rows: int, opts: JobOptions) -> int:
    """Buckets of a chunk table of ``rows`` rows; set it as ``chunk_buckets`` when
    the table is created, so that a bucket stays near ``bucket_rows`` rows."""
    return max(1, -(-rows // opts.bucket_rows))


def full_load(df: DataFrame, path: str, opts: JobOptions, observation: Observation | None = None) -> DataFrame:
    """K1: rebuild a chunk table in one job, partitioned by a file-name bucket so
    later change sets rewrite only the buckets they touch. A3: the insert count
    is observed during the write."""
    out = df.withColumn("bucket", bucket_of(F.col("filename"), opts.chunk_buckets))
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("insert_count"))
    # rebalance, not repartition: AQE splits a large bucket over several write
    # tasks (and merges small ones) by bytes, so files come out near the
    # advisory partition size and no task writes a whole bucket
    out.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def align_to(target_schema: T.StructType, src: DataFrame) -> DataFrame:
    """K2: rows in the target's columns: absent -> NULL, extra dropped."""
    cols = []
    have = set(src.columns)
    for f in target_schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return src.select(*cols)


def insert_align(target: DataFrame, src: DataFrame) -> DataFrame:
    """K2: the target's rows plus the aligned new rows (the table after an append)."""
    return target.unionByName(align_to(target.schema, src))


def upsert_pk(target: DataFrame, src: DataFrame, pk: str | None, order: str | None = None) -> DataFrame:
    """K3: INSERT … ON CONFLICT(pk) DO UPDATE of all non-key columns; absent
    columns overwrite with NULL. ``order`` names the source column that tells
    which of several rows of a key is the last; without it the rows of a key
    must be equal or any order is right (the greatest row stays). Without a key
    it is a plain insert."""
    aligned = align_to(target.schema, src)
    if pk is None:
        return target.unionByName(aligned)
    others = [c for c in aligned.columns if c != pk]
    if order is None:
        last = F.max(F.struct(*others))
    else:
        aligned = align_to(T.StructType([*target.schema.fields, T.StructField("_order", src.schema[order].dataType)]), src.withColumn("_order", F.col(order)))
        last = F.max_by(F.struct(*others), F.struct("_order", *others))
    one = aligned.groupBy(pk).agg(last.alias("_r")).select(pk, *[F.col(f"_r.{c}").alias(c) for c in others])
    return target.join(one.select(pk), pk, "left_anti").unionByName(one.select(*target.columns))


def delete_by_file(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """Chunks of the given files removed (anti join, no key list on the driver)."""
    return chunks.join(files.select("filename").distinct(), "filename", "left_anti")


# Fixed value: the message's wording
DELETED_MESSAGE = "Successfully deleted %d records of %s"


def deleted_counts(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """K4 report: records removed per file, files without chunks shown with 0."""
    hit = chunks.join(files.select("filename").distinct(), "filename", "left_semi").groupBy("filename").count()
    f = files.select("filename").distinct().join(hit, "filename", "left")
    n = F.coalesce(F.col("count"), F.lit(0)).cast("bigint")
    return f.select("filename", n.alias("n_records"), F.format_string(DELETED_MESSAGE, n, F.col("filename")).alias("message"))


# ------------------------------------------------------------------ O2-O5


def union_chunks(*parts: DataFrame) -> DataFrame:
    """O2: chunks of all sources together."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def last_changes(changes: DataFrame) -> DataFrame:
    """One row per file: with a ``seq`` column the row of the greatest ``seq`` (the
    last change wins, whatever it is); a change set without one holds a file once."""
    if "seq" not in changes.columns:
        return changes
    # equal seq: a fixed choice
    last = F.max(F.struct("seq", "status", "markdown"))
    return changes.groupBy("filename").agg(last.alias("_c")).select("filename", "_c.status", "_c.markdown", "_c.seq")


def apply_changes(old_chunks: DataFrame, changes: DataFrame, opts: JobOptions, embed=None) -> DataFrame:
    """New table = old minus chunks of every touched file (added
    included, so a replay is idempotent) plus fresh chunks of added and
    modified files. ``changes``: (filename, status, markdown[, seq]); status
    'deleted' / 'delete' removes, any other with Markdown upserts; of several
    changes of a file the last by ``seq`` counts.

    The change set feeds two branches (touched files, fresh chunks); it is
    materialised once with a reliable checkpoint so the snapshot diff and the
    Markdown conversion behind it run once."""
    return _with_last(old_chunks, last_changes(changes).checkpoint(eager=True), opts, embed)


def _with_last(old_chunks: DataFrame, changes: DataFrame, opts: JobOptions, embed) -> DataFrame:
    touched = changes.select("filename").distinct()
    kept = old_chunks.join(touched, "filename", "left_anti")
    ups = changes.where(F.col("markdown").isNotNull() & ~F.col("status").isin("deleted", "delete"))
    fresh = chunk_docs(ups.select("filename", "markdown"), opts, key="filename", text="markdown")
    if embed is not None:
        fresh = embed(fresh)
    return kept.unionByName(fresh.select(*kept.columns))


def upsert_set(actions: DataFrame) -> DataFrame:
    """O3: files to (re)load in repository mode: added ∪ modified."""
    return actions.where(F.col("action") == "upsert").select("filename")


# ------------------------------------------------------------------ P1, P5-P7


def query_table(df: DataFrame, filter_expr: str | None = None, output_fields=None) -> DataFrame:
    """Filter expression + column list (none = all)."""
    out = df.where(F.expr(filter_expr)) if filter_expr else df
    return out.select(*output_fields) if output_fields else out


def chunk_metadata(chunks: DataFrame) -> Column:
    """P5: metadata map with filename, doc_link and only the headers present."""
    m = F.create_map(
        F.lit("filename"), F.col("filename"),
        F.lit("doc_link"), F.col("doc_link"),
        F.lit("Header3"), F.col("header3"),
        F.lit("Header2"), F.col("header2"),
        F.lit("Header1"), F.col("header1"),
    )
    return F.map_filter(m, lambda k, v: v.isNotNull())


#: metadata keys and the columns that hold them
METADATA_COLUMNS = {"filename": "filename", "doc_link": "doc_link", "Header1": "header1", "Header2": "header2", "Header3": "header3"}


def metadata_lookup(chunks: DataFrame, key: str, value: str, col: str = "metadata") -> DataFrame:
    """Rows whose metadata[key] equals value. A key that has a column of its
    own is compared there, where the scan can skip row groups."""
    column = METADATA_COLUMNS.get(key)
    if column in chunks.columns:
        return chunks.where(F.col(column) == value)
    return chunks.where(F.col(col).getItem(key) == value)


def to_documents(chunks: DataFrame) -> DataFrame:
    """(page_content, metadata text)."""
    return chunks.select(
        F.col("text").alias("page_content"),
        metadata_text(F.col("filename"), F.col("doc_link"), F.col("header1"), F.col("header2"), F.col("header3")).alias("metadata"),
    )


# ------------------------------------------------------------------ K9, K10


def export_chunk_files(chunks: DataFrame) -> DataFrame:
    """K9: chunk files named chunk_{i}.md, i = 1..n per document."""
    return chunks.select("filename", F.format_string("chunk_%d.md", F.col("chunk_no")).alias("chunk_file"), "text")


def write_chunk_files(chunks: DataFrame, path: str) -> None:
    """K9: the text of each chunk in its own folder ``chunk_{i}.md`` below the
    folder of its file (Spark names the part file inside and ends it with a line feed)."""
    named = export_chunk_files(chunks).select("filename", "chunk_file", F.col("text").alias("value"))
    named.write.mode("overwrite").partitionBy("filename", "chunk_file").text(path)


def html_tree_to_md(snapshot: DataFrame) -> DataFrame:
    """Whole-page HTML -> Markdown (no article extraction), '.html' -> '.md'."""
    return snapshot.select(
        F.replace(F.col("rel_path"), F.lit(".html"), F.lit(".md")).alias("md_path"),
        html_to_markdown(F.col("html")).alias("markdown"),
    )


# ------------------------------------------------------------------ A3, W3, W5


def batch_slices(df: DataFrame, order_cols, batch_size: int) -> DataFrame:
    """Global 0-based row index in ``order_cols`` order and batch number.

    No single-partition window: the frame is range-sorted, checkpointed to
    the shared folder (so both uses below see the same rows in the same
    partitions), rows are counted per partition, and partition offsets come
    from a running sum over the per-partition counts (one row per partition).
    """
    sorted_ = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    sorted_ = sorted_.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    local = F.col("_mid") - F.shiftleft(pid, 33)
    counts = sorted_.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    j = sorted_.join(F.broadcast(offs), pid == F.col("_pid"))
    idx = (F.coalesce(F.col("_off"), F.lit(0)) + local).cast("bigint")
    return j.select(*df.columns, idx.alias("row_index"), F.floor(idx / batch_size).cast("bigint").alias("batch_no"))


def first_per_key(releases: DataFrame, prefix: str) -> DataFrame:
    """First asset whose name starts with the prefix, per release (in-row,
    no shuffle); no match -> NULL name / url."""
    hit = F.get(F.filter("assets", lambda a: F.startswith(a["name"], F.lit(prefix))), 0)
    return releases.select("tag", hit["name"].alias("name"), hit["url"].alias("url"))


def add_records(changes: DataFrame, target_schema: T.StructType, opts: JobOptions, embed) -> DataFrame:
    """Chunk, embed and align the rows of every added / modified file of a
    change set in one job (the rows an append writes)."""
    ups = changes.where(F.col("markdown").isNotNull() & ~F.col("status").isin("deleted", "delete"))
    fresh = embed(chunk_docs(ups.select("filename", "markdown"), opts, key="filename", text="markdown"))
    return align_to(target_schema, fresh)


VERSIONS_SCHEMA = "filename string, seq long, deleted boolean, bucket int"


def file_versions(spark: SparkSession, path: str) -> DataFrame:
    """The version table of a chunk table: per file the ``seq`` of its last applied
    change; a deleted file keeps its row as a tombstone."""
    found = stored(spark, path)
    return spark.createDataFrame([], VERSIONS_SCHEMA) if found is None else spark.read.schema(VERSIONS_SCHEMA).parquet(path)


def newer_changes(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """Changes that are not older than what has been applied to their file. An
    equal ``seq`` is a repeat of that change and passes, as does a change without one."""
    have = versions.select("filename", F.col("seq").alias("_have"))
    fresh = F.col("seq").isNull() | F.col("_have").isNull() | (F.col("seq") >= F.col("_have"))
    return changes.join(have, "filename", "left").where(fresh).drop("_have")


def merge_versions(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """The version rows after ``changes`` (a file once): their files' rows replaced.
    A change without a ``seq`` keeps the stored one."""
    gone = F.col("status").isin("deleted", "delete")
    new = changes.select("filename", "seq", gone.alias("_gone"), F.lit(True).alias("_new"))
    both = versions.select("filename", F.col("seq").alias("_have"), "deleted").join(new, "filename", "full_outer")
    return both.select("filename", F.coalesce("seq", "_have").alias("seq"), F.when(F.col("_new"), F.col("_gone")).otherwise(F.col("deleted")).alias("deleted"))


def _overwrite_buckets(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def apply_changes_in_place(spark: SparkSession, path: str, changes: DataFrame, opts: JobOptions, embed=None, versions_path: str | None = None) -> list[int]:
    """O4 on a stored chunk table, rewriting only the buckets the change set
    touches: the touched buckets (at most ``chunk_buckets`` ids) are read with
    partition pruning, the new rows are staged with a reliable checkpoint
    (never read and overwrite one path in a job), then written back with
    dynamic partition overwrite. A bucket left without rows is removed.

    ``versions_path`` names the table of applied versions (bucketed as the chunk table):
    a change that is older than its file's version is left out, also after a
    delete, whose tombstone stays. It is written after the chunks, so
    a run that breaks off in between is repeated and gives the same table.
    Returns the rewritten bucket ids."""
    changes = last_changes(changes)
    bucket = bucket_of(F.col("filename"), opts.chunk_buckets)
    ordered = versions_path is not None and "seq" in changes.columns
    changes = changes.withColumn("bucket", bucket).checkpoint(eager=True)
    if ordered:
        touched = [r[0] for r in changes.select("bucket").distinct().collect()]
        known = file_versions(spark, versions_path).where(F.col("bucket").isin(touched))
        changes = newer_changes(changes, known.drop("bucket")).checkpoint(eager=True)
    buckets = sorted(r[0] for r in changes.select("bucket").distinct().collect())
    if not buckets:
        return []
    changes = changes.drop("bucket")
    old = spark.read.parquet(path).where(F.col("bucket").isin(buckets)).drop("bucket")
    staged = _with_last(old, changes, opts, embed).withColumn("bucket", bucket).checkpoint(eager=True)
    _overwrite_buckets(staged, path)
    kept = {r[0] for r in staged.select("bucket").distinct().collect()}
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for b in set(buckets) - kept:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/bucket={b}")
        p.getFileSystem(conf).delete(p, True)
    if ordered:
        merged = merge_versions(known.where(F.col("bucket").isin(buckets)), changes).withColumn("bucket", bucket)
        _overwrite_buckets(merged.checkpoint(eager=True), versions_path)
    return buckets
