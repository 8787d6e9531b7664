"""Snapshot scans, repository listings, content decoding, release data,
search responses and collection reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.text import content_hash
from docweave.options import JobOptions


def scan_html_snapshot(spark: SparkSession, root: str, snapshot_id: str | None = None) -> DataFrame:
    """Every *.html file below ``root`` as (snapshot_id, rel_path, html, sha256).

    The hash is taken over the file bytes, as the reference hashes whole files.
    """
    base = root.rstrip("/").split(":", 1)[-1] if root.startswith("file:") else root.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.html")
        .load(root)
    )
    bare = F.regexp_replace(F.col("path"), F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*:(//)?"), F.lit(""))
    bare = F.regexp_replace(bare, F.lit("^/+"), F.lit("/"))
    rel = F.substring(bare, F.lit(len("/" + base.lstrip("/")) + 2), F.lit(1 << 30))
    return files.select(
        F.lit(snapshot_id or root).alias("snapshot_id"),
        rel.alias("rel_path"),
        F.decode("content", "UTF-8").alias("html"),
        content_hash(F.col("content")).alias("sha256"),
    )


def snapshot_from_table(df: DataFrame, snapshot_id: str = "") -> DataFrame:
    """S1 over a table already shaped (rel_path, html): adds the content hash."""
    return df.select(
        F.lit(snapshot_id).alias("snapshot_id"), "rel_path", "html", content_hash(F.col("html")).alias("sha256")
    )


def ignore_paths_predicate(path: Column, opts: JobOptions) -> Column:
    """S2 / P2 shared predicate: ends with '.md', contains MAIN_DIR, and contains
    none of the ignore substrings."""
    ok = F.endswith(path, F.lit(".md")) & F.contains(path, F.lit(opts.main_dir))
    if opts.ignore_files:
        ig = F.array(*[F.lit(x) for x in opts.ignore_files])
        ok = ok & ~F.exists(ig, lambda x: F.contains(path, x))
    return ok


LISTING_SCHEMA = T.StructType([T.StructField("tree", T.ArrayType(T.StructType([T.StructField("path", T.StringType())])))])
FILES_SCHEMA = T.StructType(
    [
        T.StructField(
            "files",
            T.ArrayType(T.StructType([T.StructField("filename", T.StringType()), T.StructField("status", T.StringType())])),
        )
    ]
)


def list_markdown_files(listing: DataFrame, opts: JobOptions, body: str = "body") -> DataFrame:
    """JSON tree listing(s) -> (path) of the Markdown files to load."""
    items = listing.select(F.explode(F.from_json(F.col(body), LISTING_SCHEMA)["tree"]).alias("item"))
    return items.select(F.col("item.path").alias("path")).where(ignore_paths_predicate(F.col("path"), opts))


def decode_content(encoding: Column, content: Column) -> Column:
    """S3: base64 bodies decoded to UTF-8, invalid UTF-8 -> ''; others as they are."""
    decoded = F.coalesce(F.try_validate_utf8(F.unbase64(content).cast("string")), F.lit(""))
    return F.when(F.contains(F.coalesce(encoding, F.lit("")), F.lit("base64")), decoded).otherwise(content)


def latest_ref(versions: DataFrame) -> DataFrame:
    """Newest ref per product (latest ts, ties by ref) -> (product, ref, ts)."""
    newest = F.max_by(F.struct("ref", "ts"), F.struct("ts", "ref"))
    return versions.groupBy("product").agg(newest.alias("_n")).select("product", "_n.ref", "_n.ts")


def release_assets(releases: DataFrame, tag: str | None = None) -> DataFrame:
    """Assets of a tag (all tags when None) -> (tag, pos, name, url); a
    release without assets gives one row of NULLs (empty list)."""
    r = releases if tag is None else releases.where(F.col("tag") == tag)
    return r.select("tag", F.posexplode_outer("assets").alias("pos", "a")).select(
        "tag", F.col("pos").cast("bigint").alias("pos"), F.col("a.name").alias("name"), F.col("a.url").alias("url")
    )


def changed_files(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Compare payload(s) -> (filename, status)."""
    f = payloads.select(F.explode(F.from_json(F.col(body), FILES_SCHEMA)["files"]).alias("f"))
    return f.select("f.filename", "f.status")


#: bytes of members handed on at a time
UNZIP_BYTES = 16 << 20


def _explode_zip(batches):
    import io
    import zipfile

    import pyarrow as pa

    names = ["archive", "member", "content"]
    types = [pa.string(), pa.string(), pa.binary()]

    def handed(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        rows, held = [], 0
        for path, blob in zip(batch.column("path"), batch.column("content")):
            # the archive is read where it lies in the batch, none is copied
            with zipfile.ZipFile(pa.BufferReader(blob.as_buffer()) if blob.is_valid else io.BytesIO(None)) as z:
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    if rows and held + info.file_size > UNZIP_BYTES:
                        yield handed(rows)
                        rows, held = [], 0
                    rows.append((path.as_py(), info.filename, z.read(info)))
                    held += info.file_size
        if rows:
            yield handed(rows)


def unpack_archive_rows(archives: DataFrame) -> DataFrame:
    """S7 over rows (path, content binary): one output row per archive member."""
    return archives.select("path", "content").mapInArrow(_explode_zip, "archive string, member string, content binary")


def unpack_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Zip archives below ``root`` -> (archive, member, content); a task
    hands members on by a byte budget, not a batch of archives at once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    return unpack_archive_rows(files)


HIT_SCHEMA = T.ArrayType(
    T.ArrayType(
        T.StructType(
            [
                T.StructField("entity", T.MapType(T.StringType(), T.StringType())),
                T.StructField("distance", T.DoubleType()),
            ]
        )
    )
)


def flatten_hits(responses: DataFrame, fields=("pk", "text", "filename"), body: str = "body") -> DataFrame:
    """Search responses [[{entity, distance}]] -> one row per hit of the first
    inner list, order kept, chosen entity fields (missing -> NULL)."""
    first = F.get(F.from_json(F.col(body), HIT_SCHEMA), 0)
    rows = responses.select("request_id", F.posexplode(first).alias("rank", "hit"))
    return rows.select(
        "request_id",
        (F.col("rank") + 1).cast("bigint").alias("rank"),
        *[F.col("hit.entity").getItem(f).alias(f) for f in fields],
        F.col("hit.distance").alias("distance"),
    )


def read_collection(spark: SparkSession, name: str, fmt: str | None = None, path: str | None = None, default: str | None = None) -> DataFrame:
    """Open a chunk collection by catalog name, or by format + path; an
    unknown name falls back to ``default``."""
    if path:
        return spark.read.format(fmt or "parquet").load(path)
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if default and spark.catalog.tableExists(default):
        return spark.table(default)
    raise ValueError(f"unknown collection {name!r}")
