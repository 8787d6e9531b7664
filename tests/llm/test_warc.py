"""The archive against plain digests, and exact round trips."""

from __future__ import annotations

import base64
import hashlib

import pytest

from docweave.llm import warc

SCHEMA = "page_id long, url string, html string, header string, row int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def plain(rows):
    """Sorted catalogue rows; which of several rows of one page_id is the response is not told apart."""
    data = [(p, (h or "").encode()) for p, _, h in rows]
    least = {}
    for p, b in data:
        if b not in least or (p is not None and (least[b] is None or p < least[b])):
            least[b] = p
    done, out = set(), []
    for p, b in data:
        first = p == least[b] and b not in done
        if first:
            done.add(b)
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((p, len(b), digest, "response" if first else "revisit", None if first else least[b]))
    return sorted(out, key=repr)


def catalogue(spark, path):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in warc.catalogue(spark, path).select(cols).collect()), key=repr)


ROWS = [
    (5, "http://a/5", "<p>one</p>"),
    (3, "http://a/3", "<p>one</p>"),
    (3, "http://a/3", "<p>one</p>"),
    (9, "http://a/9", "Ünï 漢字 😀 \r\n\r\n WARC/1.1\r\n"),
    (8, None, None),
    (7, "", ""),
    (None, "http://a/x", "<p>one</p>"),
    (None, "http://a/y", "only without id"),
    (None, "http://a/z", "only without id"),
    (-4, "http://a/ b\r\nWARC-Type: forged", "long " * 40_000),
    (11, "http://a/5", "x"),
] + [(100 + i, f"http://hot/{i}", "hot payload") for i in range(120)]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_catalogue(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr("docweave.llm.common.BROADCAST_BYTES", limit)
    path = warc.write(table(spark, ROWS).repartition(5), str(tmp_path / "a"))
    assert catalogue(spark, path) == plain(ROWS)
    # every distinct payload once
    keys = [r.payload_key for r in warc.payloads(spark, path).collect()]
    assert len(keys) == len(set(keys)) == len({h or "" for _, _, h in ROWS})


def test_records_are_exact_and_survive_plain_files(spark, tmp_path):
    path = warc.write(table(spark, ROWS), str(tmp_path / "a"))
    recs = warc.records(spark, path).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in recs if r.page_id is not None) == sorted((p, (h or "").encode()) for p, _, h in ROWS if p is not None)
    forged = next(bytes(r.record) for r in recs if r.page_id == -4)
    assert b"WARC-Target-URI: http://a/%20b%0D%0AWARC-Type:%20forged\r\n" in forged and b"WARC-Type: response\r\n" in forged
    for compression in ("gzip", "none"):
        to = str(tmp_path / f"files-{compression}")
        warc.export(spark, path, to, compression)
        back = warc.read_files(spark, to).collect()
        assert sorted(bytes(r.header) + bytes(r.block) for r in back) == sorted(bytes(r.record) for r in recs)


def test_header_of_a_revisit(spark, tmp_path):
    path = warc.write(table(spark, ROWS[:2]), str(tmp_path / "a"))
    got = {r.page_id: bytes(r.record).decode() for r in warc.records(spark, path).collect()}
    digest = base64.b32encode(hashlib.sha1(b"<p>one</p>").digest()).decode()
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 10\r\n\r\n"
    assert got[5] == (
        "WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:page:5>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
        f"WARC-Target-URI: http://a/5\r\nWARC-Payload-Digest: sha1:{digest}\r\nWARC-Refers-To: <urn:page:3>\r\n"
        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n{http}"
    )
    assert got[3].endswith(f"Content-Length: {len(http) + 10}\r\n\r\n{http}<p>one</p>")


def test_small_payloads_are_responses(spark, tmp_path):
    path = warc.write(table(spark, ROWS), str(tmp_path / "a"), least_bytes=11)
    kinds = {(r.payload_bytes, r.record_type) for r in warc.catalogue(spark, path).collect()}
    assert (10, "revisit") not in kinds and (11, "revisit") in kinds
    assert warc.payloads(spark, path).count() == len({h or "" for _, _, h in ROWS})


def test_damage_raises(spark, tmp_path):
    path = warc.write(table(spark, ROWS[:3]), str(tmp_path / "a"))
    good = spark.read.schema(warc.PAYLOADS).parquet(f"{path}/payloads")
    from pyspark.sql import functions as F

    bad = good.withColumn("payload", F.concat("payload", F.lit(b"!"))).collect()
    spark.createDataFrame(bad, warc.PAYLOADS).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload damaged"):
        warc.catalogue(spark, path).collect()
    with pytest.raises(ValueError, match="no whole record at 0"):
        list(warc._split_records("f", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"))


def test_empty_table(spark, tmp_path):
    path = warc.write(table(spark, []), str(tmp_path / "a"))
    assert catalogue(spark, path) == [] and warc.records(spark, path).count() == 0
