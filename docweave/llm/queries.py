"""Registered queries of the operators: thin wrappers that apply each to its
whole table and derive the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontaminate, filter_audit, language, licenses, lines, neighbours, packing, pii, quality, sharding, simhash, warc
from docweave.session import scratch_path

from .common import read

SHARDS = 40


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of each vector whose vec_id is divisible by 50."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line, by document."""
    r = lines.report(read(spark, sf_dir, "documents"))
    return r.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal size."""
    placed = sharding.shard(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.find(read(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan(read(spark, sf_dir, "documents")).drop("spans")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )  # fmt: skip


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    model = language.train(docs.where(~held_out))
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of all documents, with their sites' evidence."""
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after 10 rounds."""
    found = centroids.cluster(read(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, and the catalogue read back from the archive."""
    path = warc.write(read(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.catalogue(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents."""
    return filter_audit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest, op2_line_dedup, op3_sharding, op4_best_fit, op5_pii,
        op6_licenses, op7_simhash, op8_decontamination, op9_language, op10_quality,
        op11_centroids, op12_warc, op13_filter_audit,
    )
}  # fmt: skip

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: lines as sets, classes of equal sets, prefixes by document frequency, verified pairs
_LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT doc_id, no, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '\s+'), lambda x: x <> ''))) AS ws FROM l),
c AS (SELECT ws, len(ws) AS n, min(doc_id * 1000000 + no) AS pos FROM s WHERE len(ws) > 0 GROUP BY ws),
w AS (SELECT pos, n, unnest(ws) AS w FROM c),
f AS (SELECT w, count(*) AS df FROM w GROUP BY w),
p AS (
  SELECT pos, n, w FROM (
    SELECT w.pos, w.n, w.w, row_number() OVER (PARTITION BY w.pos ORDER BY f.df, w.w) AS r FROM w JOIN f ON w.w = f.w)
  WHERE r <= n - ceil(0.8 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.pos AS first_pos, b.pos FROM p a JOIN p b ON a.w = b.w AND a.pos < b.pos AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
gone AS (
  SELECT DISTINCT k.pos FROM cand k JOIN c a ON a.pos = k.first_pos JOIN c b ON b.pos = k.pos
  WHERE len(list_intersect(a.ws, b.ws)) >= 0.8 * (a.n + b.n - len(list_intersect(a.ws, b.ws))) - 1e-9),
r AS (
  SELECT s.doc_id, s.no FROM s JOIN c ON s.ws = c.ws
  WHERE s.doc_id * 1000000 + s.no <> c.pos OR c.pos IN (SELECT pos FROM gone)),
g AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS removed FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  coalesce(g.n_removed, 0) AS n_removed, coalesce(g.removed, '') AS removed
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""

#: every window of every item against every window of every document
_WINDOWS_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS m FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark)),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(ws[k + 1 : k + m], ' ') AS s
  FROM (SELECT item_id, ws, m, unnest(range(len(ws) - m + 1)) AS k FROM b WHERE m > 0)),
dwin AS (
  SELECT doc_id, m, k, array_to_string(ws[k + 1 : k + m], ' ') AS s
  FROM (SELECT doc_id, ws, m, unnest(range(len(ws) - m + 1)) AS k FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
hit AS (SELECT DISTINCT dwin.doc_id, dwin.k, dwin.m, win.item_id FROM dwin JOIN win ON dwin.m = win.m AND dwin.s = win.s),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""

#: the same rounds one after the other, each as two tables of its own
_CLUSTERS_SQL = (
    r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS c, x FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v)
  ORDER BY c LIMIT 8),
"""
    + "".join(
        f"""a{k} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT v.r, v.vec_id, c{k}.c, CAST(list_sum(list_transform(list_zip(v.x, c{k}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{k})
  GROUP BY r),
"""
        + (
            f"""c{k + 1} AS MATERIALIZED (
  SELECT c{k}.c, coalesce(m.x, c{k}.x) AS x FROM c{k} LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT c, i, sum(y) AS s, count(*) AS n FROM (SELECT a{k}.best.c AS c, unnest(v.x) AS y, unnest(range(64)) AS i FROM v JOIN a{k} ON v.r = a{k}.r) GROUP BY c, i)
    GROUP BY c) m ON m.c = c{k}.c),
"""
            if k < 10
            else ""
        )
        for k in range(11)
    )
    + r"""
t AS (SELECT best.c AS c, CAST(sum(best.d) AS BIGINT) AS inertia FROM a10 GROUP BY 1)
SELECT a10.vec_id, CAST(a10.best.c AS INTEGER) AS cluster, a10.best.d AS distance, t.inertia AS cluster_inertia,
  (SELECT CAST(sum(inertia) AS BIGINT) FROM t) AS inertia, sha256(array_to_string(c10.x, ',')) AS centroid_sha256
FROM a10 JOIN t ON t.c = a10.best.c JOIN c10 ON c10.c = a10.best.c
"""
)

#: digest of the whole payload, 20 bits (5 hex digits) at a time
_WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, html, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(sha1(html), CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER) >> s) & 31), 1)), '')), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

_UPPERCASE = "[^A-Z]"
#: every document against every step of every order, one by one
_AUDIT_SQL = rf"""
WITH f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier FROM o, (SELECT unnest(range(1, 6)) AS step)),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS ws FROM documents),
m AS (
  SELECT doc_id, part, (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '{_UPPERCASE}', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails FROM t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
g AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, fails),
e AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS is_own,
    len(list_filter(string_split(fails, ''), lambda x: x <> '' AND contains(earlier, x))) > 0 AS is_gone FROM g, s),
r AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (WHERE NOT is_own AND NOT is_gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE is_own AND NOT is_gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE is_own AND is_gone), 0) AS redundant, coalesce(sum(n) FILTER (WHERE fails = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE is_own AND NOT is_gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE is_own AND NOT is_gone), 0) AS toxic_lost
  FROM e GROUP BY ALL),
h AS (SELECT part, own, sum(removed) AS shapley FROM r GROUP BY part, own)
SELECT r.part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM r JOIN h ON h.part = r.part AND h.own = r.own
"""

#: SQL twins for DuckDB; what the other operators compute (greedy packing,
#: learned models, hash forests, XXH64) is tested against brute-force versions
SQL: dict[str, str] = {
    "op2_line_dedup": _LINES_SQL,
    "op8_decontamination": _WINDOWS_SQL,
    "op11_centroids": _CLUSTERS_SQL,
    "op12_warc": _WARC_SQL,
    "op13_filter_audit": _AUDIT_SQL,
}
