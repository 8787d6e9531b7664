"""Content-addressed WARC archive.

An archive is two tables below one folder:

* ``headers``: a row per record with its exact header bytes (WARC fields, and the
  HTTP header of the block), its place in the order of records, and the SHA-256
  of its payload;
* ``payloads``: every distinct payload once, keyed by its SHA-256.

Equal payloads of at least ``least_bytes`` are stored once: the record of the
smallest page_id is the ``response``, the others are ``revisit`` records without
a payload of their own. Records are told equal by SHA-256 and length, not by the
SHA-1 that WARC names in its headers. Reading verifies every stored payload against its
key, its length and its SHA-1 and raises on a mismatch; ``records`` joins headers and payloads
back to the original bytes, ``export`` writes them as plain WARC files.

Plan: one scan hashes the payloads, and only (page_id, key, length) rows are
grouped and shuffled, with partial minima, so a payload that a third of
all pages share is one row per task. Payload bytes are not shuffled while the
list of payloads with copies is small enough to broadcast: the second scan
keeps the rows whose page_id is the first of its key. Beyond that size Spark joins by shuffling.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "page_id long, row long, record_type string, payload_key string, payload_bytes long, header binary"
PAYLOADS = "payload_key string, payload binary"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits (5 hex digits) give 4 letters."""

    def four(bits: Column) -> Column:
        return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    def letters(hexed: Column) -> Column:
        bits = F.array(*[F.conv(F.substring(hexed, i, 5), 16, 10).cast("int") for i in range(1, 40, 5)])
        return F.array_join(F.transform(bits, four), "")

    # the array binds the digest, which is so taken once
    return F.get(F.transform(F.array(F.sha1(data)), letters), F.lit(0))


def _pages(pages: DataFrame, payload: str) -> DataFrame:
    """``(page_id, url, key, payload)`` of every row, the payload in bytes."""
    data = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), data.alias("payload"))
    return named.withColumn("key", F.sha2("payload", 256))


def record_name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def header_bytes(date: str) -> Column:
    """Exact header of a record, from its columns: WARC fields, a blank line, the HTTP header and its blank line."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    revisit = F.col("record_type") == "revisit"
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    # an address may hold anything; a control character or blank would end or split the line
    url = F.col("url")
    for c in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", record_name(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Refers-To", F.when(revisit, record_name(F.col("first_id")))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    )
    return head.cast("binary")


def write(pages: DataFrame, path: str, least_bytes: int = 0, payload: str = "html", date: str = "1970-01-01T00:00:00Z") -> str:
    """Archive every row of ``pages(page_id, url, html)`` below ``path``.

    Null payloads are empty ones. Rows with a null page_id come last in the
    order of records; of rows that share the smallest page_id of a payload one is
    the response. A null or missing url gives a record without an address.
    Payloads below ``least_bytes`` are never revisited, but stored once all the
    same. An empty table gives an archive without records. Extra columns are ignored.
    """
    spark = pages.sparkSession
    rows = _pages(pages, payload)
    # numbered and written once: the number tells repeated rows apart, in every use below
    index = rows.select("page_id", "url", "key", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("digest"), F.monotonically_increasing_id().alias("row"))
    index.write.parquet(f"{path}/index")
    index = spark.read.schema(index.schema).parquet(f"{path}/index")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    shared = index.groupBy("key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = shared.select("key", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row")).checkpoint()
    n = shared.count()
    firsts = small(shared, 96 * n)

    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("first_row").isNotNull() & (F.col("row") != F.col("first_row"))
    typed = index.join(firsts, "key", "left").withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    headers = typed.select("page_id", "row", "record_type", F.col("key").alias("payload_key"), "payload_bytes", header_bytes(date).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")

    # bytes are kept from the rows that carry the first page_id of their payload
    stored = rows.join(firsts, "key", "left") if n else rows.withColumn("first_row", F.lit(None)).withColumn("first_id", F.lit(None))
    once = stored.where("first_row is null or page_id <=> first_id")
    out = once.where("first_row is null").select(F.col("key").alias("payload_key"), "payload")
    if n:
        # the rows of one page_id may repeat a payload
        repeated = once.where("first_row is not null").groupBy(F.col("key").alias("payload_key")).agg(F.first("payload").alias("payload"))
        out = out.unionByName(repeated)
    out.write.option("compression", "zstd").parquet(f"{path}/payloads")
    return path


def headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEADERS).parquet(f"{path}/headers")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(payload_key, payload)`` of an archive; a payload that is not what its key says raises."""
    stored = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("payload_key")
    return stored.withColumn("payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload damaged: "), F.col("payload_key")))))


def _named(header: Column, name: str) -> Column:
    """Value of a WARC field, null where it is missing."""
    fields = F.concat(F.lit("\n"), F.split(header.cast("string"), CRLF * 2, 2)[0], F.lit("\r"))
    return F.nullif(F.regexp_extract(fields, rf"\n{name}: ([^\r]*)\r", 1), F.lit(""))


def parsed(headers: DataFrame) -> DataFrame:
    """The fields of the records, read from their header bytes alone."""
    h = F.col("header")
    page = lambda name: F.regexp_extract(_named(h, name), "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(c != "", c.cast("long"))
    return headers.select(
        number(page("WARC-Record-ID")).alias("page_id"),
        _named(h, "WARC-Type").alias("record_type"),
        _named(h, "WARC-Target-URI").alias("url"),
        F.substring_index(_named(h, "WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        number(page("WARC-Refers-To")).alias("refers_to"),
        _named(h, "Content-Length").cast("long").alias("block_bytes"),
        "payload_key",
        F.octet_length(h).alias("header_bytes"),
        "row",
    )


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url)`` of every
    record, read back from the archive: length and digest are taken from the stored
    payload and must agree with the record's header, or this raises. Only lengths and digests of payloads
    are shuffled."""
    facts = payloads(spark, path).select("payload_key", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("found"))
    both = parsed(headers(spark, path)).join(facts, "payload_key", "left")
    agrees = F.coalesce(F.col("found") == F.col("payload_digest"), F.lit(False))
    digest = F.when(agrees, F.col("found")).otherwise(F.raise_error(F.concat(F.lit("payload missing or of another digest: "), F.col("payload_key"))))
    return both.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", "url")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, row, record_type, record, payload)`` of every record: ``record`` holds its original
    bytes (header and block, without the closing blank lines), ``payload`` the
    bytes it stands for, those of a revisit included."""
    both = headers(spark, path).join(payloads(spark, path), "payload_key", "left")
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return both.select("page_id", "row", "record_type", F.concat("header", block).alias("record"), "payload")


def export(spark: SparkSession, path: str, to: str, compression: str = "gzip") -> None:
    """Write an archive as plain WARC files: a record is one value of Spark's text
    writer, and the two line ends that close it are the separator."""
    value = records(spark, path).select(F.col("record").cast("string").alias("value"))
    value.write.option("lineSep", CRLF * 2).option("compression", compression).text(to)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, offset, header, block)`` of every record of plain or gzipped WARC files
    (a file is one task's work; ``export`` writes files of a partition each).
    ``offset`` counts bytes after decompression. A record that ends before its Content-Length raises."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                for part in _chunks(_split_records(name, data)):
                    yield pa.RecordBatch.from_pylist(part, _RECORD)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(kernel, "file string, offset long, header binary, block binary")


_RECORD = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("header", pa.binary()), ("block", pa.binary())])
_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]+)\r\n", re.IGNORECASE)


def _split_records(name: str, data: bytes) -> Iterator[dict]:
    at = 0
    while at < len(data):
        blank = data.find(b"\r\n\r\n", at)
        length = _LENGTH.search(data, at, blank + 4) if blank >= 0 else None
        stop = blank + 4 + int(length[1]) if length else len(data) + 1
        if stop > len(data):
            raise ValueError(f"{name}: no whole record at {at}")
        yield {"file": name, "offset": at, "header": data[at : blank + 4], "block": data[blank + 4 : stop]}
        at = stop + 4


def _chunks(records: Iterator[dict], size: int = 1000) -> Iterator[list[dict]]:
    while part := list(islice(records, size)):
        yield part
