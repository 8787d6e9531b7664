"""Properties of the composed jobs on sf0.001."""

from pyspark.sql import functions as F

from docweave.operators import diff as DF
from docweave.operators import knn as KN
from docweave.operators import retrieve as RT
from docweave.operators import tables as TB
from docweave.operators.embed import embed_questions
from docweave.options import JobOptions
from docweave.plans import catalog
from docweave.plans import fixtures as fx
from docweave.plans.pipelines import build_release_chunks

OPTS = JobOptions()
COLS = ["filename", "chunk_no", "doc_link", "text"]


def rows(df, cols=COLS):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_diff_partitions_paths(spark, sf):
    old, new = fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf)
    d = DF.snapshot_diff(old, new, OPTS)
    assert d.count() == d.select("rel_path").distinct().count()
    paths = old.select("rel_path").union(new.select("rel_path")).distinct()
    n_ign = paths.where(F.col("rel_path").isin(list(OPTS.ignore_rel_paths))).count()
    assert d.count() == paths.count() - n_ign
    assert set(r[0] for r in d.select("status").distinct().collect()) <= {"added", "modified", "deleted", "unchanged"}


def test_apply_equals_full_load_without_d8(spark, sf):
    old, new = fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf)
    # Modified pages that lost their article keep their old chunks; drop them on both sides
    lost = new.where(~F.col("html").contains("<article>")).select(F.concat(F.lit("en/docs/p"), F.col("page_id").cast("string"), F.lit(".md")).alias("filename"))
    applied = TB.apply_changes(build_release_chunks(old, OPTS), DF.release_changes(old, new, OPTS), OPTS)
    full = build_release_chunks(new, OPTS)
    a = applied.join(lost, "filename", "left_anti")
    b = full.join(lost, "filename", "left_anti")
    assert rows(a) == rows(b)


def test_repo_replay_idempotent(spark, sf):
    chunks = catalog._repo_chunks(spark, sf)
    ch = catalog._repo_changes(spark, sf)
    once = TB.apply_changes(chunks, ch, OPTS)
    twice = TB.apply_changes(once, ch, OPTS)
    assert rows(once) == rows(twice)


def test_upsert_keeps_key_unique(spark, sf):
    t, s, _ = catalog._kv(spark, sf)
    u = TB.upsert_pk(t, s.union(s), "pk")
    assert TB.primary_key_violations(u, "pk").count() == 0
    assert u.where(F.col("pk") == 0).first()["source"] is None


def test_budget_is_prefix_and_bounded(spark, sf):
    blocks = catalog._blocks_spark(spark, sf)
    for b in (1000, 12000):
        kept = RT.prompt_budget(blocks, b)
        assert kept.agg(F.max("cum_tokens")).first()[0] <= b
        # prefix: per request, kept positions are 1..n in (q_no, rank) order
        from pyspark.sql.window import Window

        w = Window.partitionBy("request_id").orderBy("q_no", "rank")
        allp = blocks.withColumn("p", F.row_number().over(w)).join(kept.select("request_id", "q_no", "rank"), ["request_id", "q_no", "rank"])
        chk = allp.groupBy("request_id").agg(F.max("p").alias("m"), F.count(F.lit(1)).alias("n"))
        assert chk.where(F.col("m") != F.col("n")).count() == 0


def test_first_hit_over_budget_gives_empty_docs(spark):
    qs = spark.createDataFrame([(1, 1, "alpha", "")], "request_id long, q_no long, question string, context string")
    ch = spark.createDataFrame([("en/a.md", 1, None, None, None, "https://x/a/", "alpha " * 50)], "filename string, chunk_no long, header1 string, header2 string, header3 string, doc_link string, text string")
    from docweave.operators.embed import embed_chunks

    p = RT.build_prompts(qs, embed_chunks(ch, OPTS), OPTS, budget=5).first()
    assert p["n_docs"] == 0 and p["user_prompt"].endswith("Documentation:")
    p2 = RT.build_prompts(qs, embed_chunks(ch, OPTS).limit(0), OPTS).first()
    assert p2["user_prompt"].endswith("No docs found for the question")


def test_ann_recall(spark, sf):
    """At default options: IVF trained by KMeans, LSH with bits from the table's size."""
    sf = sf.replace("0.001", "0.01")
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS)
    ch = catalog.fx_chunks(spark, sf)
    key = ["request_id", "q_no", "filename", "chunk_no"]
    exact = KN.knn_exact(qv, ch, 20, OPTS).select(*key)
    n = exact.count()
    for approx in (KN.knn_ivf(qv, ch, 20, OPTS), KN.knn_lsh(qv, ch, 20, OPTS)):
        hits = approx.checkpoint()
        assert hits.join(exact, key).count() / n >= 0.8
        assert hits.where("n_found > 20 OR n_found < 1").count() == 0


def test_blocks_of_any_size_agree(spark, sf):
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS)
    ch = catalog.fx_chunks(spark, sf)
    cols = ["request_id", "q_no", "filename", "chunk_no", "rank"]
    a = KN.knn_exact(qv, ch, 5, OPTS)
    b = KN.knn_exact(qv, ch, 5, OPTS.with_(knn_block_bytes=13 * 8 * OPTS.embed_dim))
    assert rows(a, cols) == rows(b, cols)


def _plain_topk(Q, C, ks, metric="L2"):
    import numpy as np

    out = []
    for i, q in enumerate(Q):
        d = [float(x) for x in KN._exact(np.broadcast_to(q, C.shape), C, metric)]
        out += [(i, j) for j in sorted(range(len(C)), key=lambda j: (round(d[j], 9), j))[: ks[i]]]
    return out


def test_kernel_ties_norms_and_k_per_question(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    # equal chunks: exactly k rows per question leave the kernel
    C = np.ones((10_000, 8))
    qi, ci, _ = KN.topk_block(rng.standard_normal((5, 8)), C, 20, "L2")
    assert len(qi) == 100 and ci.max() == 19
    # large norms: close neighbours far from the origin
    for scale in (1.0, 1e3, 1e4, 1e6):
        base = scale * rng.standard_normal(16)
        C = (base + 0.01 * rng.standard_normal((400, 16))).astype(np.float32).astype(float)
        Q = (base + 0.01 * rng.standard_normal((20, 16))).astype(np.float32).astype(float)
        for metric in ("L2", "IP", "COSINE"):
            qi, ci, _ = KN.topk_block(Q, C, 20, metric)
            assert sorted(zip(qi, ci)) == sorted(_plain_topk(Q, C, [20] * 20, metric)), (scale, metric)
    # a number per question, small tiles
    monkeypatch.setattr(KN, "TILE", 200)
    monkeypatch.setattr(KN, "CHUNK_TILE", 16)
    C, Q = rng.integers(0, 3, (90, 3)).astype(float), rng.integers(0, 3, (12, 3)).astype(float)
    ks = np.array([0, 1, 4, 35, 1_000_000, 2, 0, 90, 89, 7, 5, 3])
    qi, ci, _ = KN.topk_block(Q, C, ks, "L2")
    assert sorted(zip(qi, ci)) == sorted(_plain_topk(Q, C, ks))


def test_stream_refresh_equals_batch(spark, sf):
    got = catalog.QUERIES["stream_refresh"](spark, sf)
    old, new = fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf)
    want = TB.apply_changes(build_release_chunks(old, OPTS), DF.release_changes(old, new, OPTS), OPTS)
    assert rows(got) == rows(want)


def test_batch_slices(spark, sf):
    df = catalog._t2_spark(spark, sf).select("filename", "chunk_no")
    b = TB.batch_slices(df, ["filename", "chunk_no"], 7)
    r = b.orderBy("row_index").collect()
    assert [x["row_index"] for x in r] == list(range(len(r)))
    keys = [(x["filename"], x["chunk_no"]) for x in r]
    assert keys == sorted(keys) and all(x["batch_no"] == x["row_index"] // 7 for x in r)


def test_refresh_decisions(spark):
    from docweave.plans import refresh as RF

    latest = spark.createDataFrame([("a", "r2"), ("b", "r2"), ("c", "r2"), ("d", "r2"), ("e", "r2")], "product string, ref string")
    tr = spark.createDataFrame(
        [("a", "r2", "1.0"), ("b", "r1", "1.0"), ("c", "r1", "0.9"), ("d", "r2", "0.9")], "product string, last_updated_ref string, last_updater_version string"
    )
    p = {r["product"]: (r["release_action"], r["repo_action"]) for r in RF.plan_refresh(latest, tr, OPTS).collect()}
    assert p == {
        "a": ("SKIP", "SKIP"),
        "b": ("INCREMENTAL", "INCREMENTAL"),
        "c": ("REBUILD", "REBUILD"),
        "d": ("SKIP", "SKIP"),
        "e": ("REBUILD", "FULL_LOAD"),
    }
    legacy = RF.plan_refresh(latest, tr.drop("last_updater_version"), OPTS)
    assert {r["product"]: r["release_action"] for r in legacy.collect()}["b"] == "REBUILD"
    none = RF.plan_refresh(latest, tr, OPTS, collection_exists=False)
    assert {r["action"] for r in none.collect()} == {"FULL_LOAD"}
    nothing = RF.plan_refresh(latest, tr, OPTS, collection_exists=False, has_asset=False)
    assert {(r["release_action"], r["repo_action"]) for r in nothing.collect()} == {("SKIP", "FULL_LOAD")}


def test_run_refresh(spark, sf, tmp_path):
    """All four actions in both modes; a failed write leaves the cursor."""
    import pytest

    from docweave.options import REPOSITORY_MODE
    from docweave.plans import refresh as RF

    old, new = fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf)
    for mode in ("release", REPOSITORY_MODE):
        opts = OPTS.with_(processing_mode=mode, chunk_buckets=4)
        table, log = str(tmp_path / mode / "chunks"), str(tmp_path / mode / "tracking")

        def run(ref, snapshot, opts=opts, table=table, log=log, changes=None, **kw):
            return RF.run_refresh(
                spark, "docs", ref, log, table, lambda: build_release_chunks(snapshot, opts),
                changes or (lambda last: DF.release_changes(old, snapshot, opts)), opts, **kw,
            )

        cursor = lambda log=log: [tuple(r)[1:3] for r in RF.read_tracking_log(spark, log).collect()]
        if mode == "release":
            assert run("v1", old, has_asset=False) == "SKIP" and cursor() == []
        assert run("v1", old) == "FULL_LOAD" and cursor() == [("v1", "1.0")]
        assert run("v1", old) == "SKIP"

        def broken(last):
            raise OSError("no change set")

        with pytest.raises(OSError):
            run("v2", new, changes=broken)
        assert cursor() == [("v1", "1.0")]
        assert run("v2", new) == "INCREMENTAL" and cursor() == [("v2", "1.0")]
        want = TB.apply_changes(build_release_chunks(old, opts), DF.release_changes(old, new, opts), opts)
        assert rows(spark.read.parquet(table)) == rows(want)
        assert run("v3", new, opts=opts.with_(updater_version="1.1")) == "REBUILD" and cursor() == [("v3", "1.1")]
        assert rows(spark.read.parquet(table)) == rows(build_release_chunks(new, opts))


def test_last_change_of_a_file_wins(spark):
    old = spark.createDataFrame([("en/c.md", 1, None, None, None, "l", "old")], "filename string, chunk_no long, header1 string, header2 string, header3 string, doc_link string, text string")
    ch = spark.createDataFrame(
        [
            ("en/a.md", "modified", "# T\nnew one\n\nnew two", 2), ("en/a.md", "modified", "# T\nold one\nold two", 1),
            ("en/b.md", "added", "# B\nb", 1), ("en/b.md", "deleted", None, 2),
            ("en/c.md", "deleted", None, 1), ("en/c.md", "added", "# C\nc", 2),
        ],
        "filename string, status string, markdown string, seq long",
    )
    for part in (ch, ch.orderBy("seq"), ch.orderBy(F.desc("seq"))):
        got = {(r["filename"], r["text"]) for r in TB.apply_changes(old, part, OPTS).collect()}
        assert got == {("en/a.md", "#T\nnew one  \nnew two"), ("en/c.md", "#C\nc")}


def test_cursor_never_moves_back(spark):
    from docweave.plans import refresh as RF

    t = spark.createDataFrame([("p", "v8", "1.0")], "product string, last_updated_ref string, last_updater_version string")
    u = spark.createDataFrame([("p", "v9", "1.0", 1), ("p", "v11", "1.0", 2)], "product string, last_updated_ref string, last_updater_version string, seq int")
    assert [r["last_updated_ref"] for r in RF.write_tracking(t, u).collect()] == ["v11"]


def test_release_jobs_shuffle_no_page_body(spark, sf):
    plan = build_release_chunks(fx.fx_pages(spark, sf), OPTS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    ch = DF.release_changes(fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf), OPTS)
    ch.collect()
    final = ch._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "BuildRight" in final and "SortMergeJoin" not in final


def test_rows_that_share_a_key_stay_apart(spark):
    df = spark.createDataFrame([("a", "# T\none\ntwo"), ("a", "# U\nthree")], "doc string, text string")
    from docweave.operators.chunk import split_by_heading

    assert sorted((r["header1"], r["content"]) for r in split_by_heading(df, "doc").collect()) == [("T", "one\ntwo"), ("U", "three")]


def test_catalog_tables(spark, tmp_path):
    """Create if absent, describe, exists, drop."""
    from docweave.plans import refresh as RF

    name = "docweave_tracking_probe"
    RF.create_tracking(spark, name, str(tmp_path / "t"))
    RF.create_tracking(spark, name)
    got = [tuple(r) for r in TB.describe_table(spark, name).collect()]
    assert got == [(c, "string", 100) for c in RF.TRACKING_COLS]
    assert TB.table_exists(spark, name)
    t = spark.table(name)
    assert RF.has_version_column(t) and not RF.has_version_column(t.drop("last_updater_version"))
    TB.drop_table(spark, name)
    TB.drop_table(spark, name)
    assert not TB.table_exists(spark, name) and TB.describe_table(spark, name).count() == 0
    assert TB.ddl_of([("a", "VARCHAR", 5, True), ("v", "FLOAT_VECTOR", None, False), ("n", "INT64", None, False), ("b", "BOOL", None, False)]) == (
        "`a` VARCHAR(100), `v` ARRAY<FLOAT>, `n` STRING, `b` STRING"
    )
    d = TB.describe_table(spark, spark.createDataFrame([("x", 1)], "s string, n long")).collect()
    assert [tuple(r) for r in d] == [("s", "string", None), ("n", "bigint", None)]


def test_collections_by_path_name_and_default(spark, sf, tmp_path):
    import pytest

    from docweave.sources.scan import read_collection

    ch = catalog._t2_spark(spark, sf)
    ch.write.parquet(str(tmp_path / "c"))
    ch.limit(3).createOrReplaceTempView("docweave_probe")
    assert read_collection(spark, "x", path=str(tmp_path / "c")).count() == ch.count()
    assert read_collection(spark, "docweave_probe").count() == 3
    assert read_collection(spark, "docweave_none", default="docweave_probe").count() == 3
    with pytest.raises(ValueError):
        read_collection(spark, "docweave_none", default="docweave_none_either")


def test_chunk_files_are_written(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "one\nline"), ("a", 2, "two"), ("b", 1, "three")], "filename string, chunk_no long, text string")
    TB.write_chunk_files(df, str(tmp_path / "out"))
    got = {str(p.parent.relative_to(tmp_path / "out")): p.read_text().removesuffix("\n") for p in (tmp_path / "out").rglob("part-*")}
    assert got == {
        "filename=a/chunk_file=chunk_1.md": "one\nline", "filename=a/chunk_file=chunk_2.md": "two", "filename=b/chunk_file=chunk_1.md": "three",
    }


def test_stream_chunks_retry_overwrites(spark, sf, tmp_path):
    """A batch that runs again after its checkpoint is lost writes the same rows once."""
    from docweave.streaming.refresh_stream import stream_chunks

    md = fx.fx_markdown(spark, sf)
    md.coalesce(1).write.parquet(str(tmp_path / "in"))
    n = catalog._t2_spark(spark, sf).count()
    for k in range(2):
        out = stream_chunks(spark, str(tmp_path / "in"), str(tmp_path / "out"), OPTS, md.schema, key="doc", text="text", checkpoint=str(tmp_path / f"ck{k}"))
        assert out.count() == n


def test_rerank_scorer_hook(spark, sf):
    fq, ch = fx.fx_questions(spark, sf, OPTS), catalog.fx_chunks(spark, sf)
    hits = KN.knn_exact(embed_questions(fq, OPTS), ch, 10, OPTS)
    far = RT.rerank(hits, fq, ch, 3, scorer=lambda h, q, c: h.withColumn("score", F.col("distance")))
    got = far.join(hits.select("request_id", "q_no", F.col("distance").alias("d"), F.col("rank").alias("r")), ["request_id", "q_no"])
    assert got.where("r = 10 AND rank = 1 AND round(d, 9) <> round(distance, 9)").count() == 0


def test_cluster_needs_a_shared_folder():
    import pytest

    from docweave import session as S

    class Fake:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Fake.conf)

    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(Fake)


def test_scan_files(spark, tmp_path):
    from docweave.sources.scan import scan_html_snapshot

    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "index.html").write_text("<article><h1>x</h1></article>")
    (tmp_path / "a" / "skip.txt").write_text("no")
    r = scan_html_snapshot(spark, str(tmp_path)).collect()
    assert [x["rel_path"] for x in r] == ["a/b/index.html"]
    import hashlib

    assert r[0]["sha256"] == hashlib.sha256(b"<article><h1>x</h1></article>").hexdigest()


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "doc_link" in df.columns


def test_salted_groups_equal_unsalted(spark, sf):
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS)
    ch = catalog.fx_chunks(spark, sf)
    cols = ["request_id", "q_no", "filename", "chunk_no", "rank"]
    small = OPTS.with_(ivf_lists=4, ivf_nprobe=2)
    cents = KN.sample_centroids(ch, small.ivf_lists)
    a = KN.knn_ivf(qv, ch, 5, small, centroids=cents)
    b = KN.knn_ivf(qv, ch, 5, small.with_(knn_block_bytes=7 * 8 * OPTS.embed_dim), centroids=cents)  # every list split over many salts, on both sides
    assert rows(a, cols) == rows(b, cols)
    c = KN.knn_lsh(qv, ch, 5, OPTS)
    d = KN.knn_lsh(qv, ch, 5, OPTS.with_(knn_block_bytes=3 * 8 * OPTS.embed_dim))
    assert rows(c, cols) == rows(d, cols)


def test_unpack_archive_files(spark, tmp_path):
    import zipfile

    from docweave.sources.scan import unpack_archives

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("docs/x/index.html", "<article>x</article>")
        z.writestr("docs/y.md", "# y")
    got = sorted((r["member"], bytes(r["content"])) for r in unpack_archives(spark, str(tmp_path)).collect())
    assert got == [("docs/x/index.html", b"<article>x</article>"), ("docs/y.md", b"# y")]


def test_in_place_bucket_rewrite(spark, sf, tmp_path):
    import os

    opts = OPTS.with_(chunk_buckets=4)
    old, new = fx.fx_snapshot_old(spark, sf), fx.fx_snapshot_new(spark, sf)
    base = build_release_chunks(old, opts)
    path = str(tmp_path / "chunks")
    TB.full_load(base, path, opts)
    changes = DF.release_changes(old, new, opts)
    TB.apply_changes_in_place(spark, path, changes, opts)
    want = TB.apply_changes(base, changes, opts)
    assert rows(spark.read.parquet(path)) == rows(want)
    # delete every file of bucket 0: its partition folder goes away
    b0 = spark.read.parquet(path).where("bucket = 0").select("filename").distinct()
    dels = b0.select("filename", F.lit("deleted").alias("status"), F.lit(None).cast("string").alias("markdown"))
    TB.apply_changes_in_place(spark, path, dels, opts)
    assert spark.read.parquet(path).where("bucket = 0").count() == 0
    assert not os.path.exists(os.path.join(path, "bucket=0"))


def test_ivf_with_stored_index(spark, sf, tmp_path):
    qv = embed_questions(fx.fx_questions(spark, sf, OPTS), OPTS)
    ch = catalog.fx_chunks(spark, sf)
    small = OPTS.with_(ivf_lists=6, ivf_nprobe=3)
    cents = KN.sample_centroids(ch, small.ivf_lists)
    path = str(tmp_path / "ivf")
    KN.build_ivf_index(ch, cents, small).write.parquet(path)
    cols = ["request_id", "q_no", "filename", "chunk_no", "rank"]
    a = KN.knn_ivf(qv, ch, 5, small, centroids=cents)
    b = KN.knn_ivf(qv, ch, 5, small, index=(spark.read.parquet(path), cents))
    assert rows(a, cols) == rows(b, cols)


def test_bm25_with_stored_index(spark, sf):
    fq = fx.fx_questions(spark, sf, OPTS)
    ch = catalog.fx_chunks(spark, sf)
    hits = KN.knn_exact(embed_questions(fq, OPTS), ch, 10, OPTS)
    cols = ["request_id", "q_no", "filename", "chunk_no", "rank"]
    a = RT.rerank(hits, fq, ch, 5)
    b = RT.rerank(hits, fq, ch, 5, index=RT.term_index(ch))
    assert rows(a, cols) == rows(b, cols)


def test_normalise_requests(spark):
    qs = spark.createDataFrame(
        [(1, 1, "first?", ""), (1, 2, "second?", ""), (2, 1, "q", "ctx"), (3, 1, "", None)],
        "request_id long, q_no long, question string, context string",
    )
    acc, rej = RT.normalise_requests(qs)
    got = {(r["request_id"], r["q_no"]): r["context"] for r in acc.collect()}
    assert got == {(1, 1): "first?", (1, 2): "first?", (2, 1): "ctx"}
    assert [r["request_id"] for r in rej.collect()] == [3]


def test_docs_lookup_counts(spark, sf):
    ch = catalog.fx_chunks(spark, sf)
    lk = spark.createDataFrame([(1, "alpha beta", 0), (2, "alpha beta", 3), (3, "alpha beta", -1), (4, "alpha beta", 35), (5, "alpha beta", 10_000_000)], "request_id long, question string, count long")
    n = {r["request_id"]: r["n"] for r in RT.docs_lookup(lk, ch, OPTS).groupBy("request_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n == {1: 20, 2: 3, 4: 35, 5: ch.count()}


def test_chunk_metadata_only_present_keys(spark):
    df = spark.createDataFrame([("f.md", "https://x/f/", "H", None, None)], "filename string, doc_link string, header1 string, header2 string, header3 string")
    m = df.select(TB.chunk_metadata(df).alias("m")).first()["m"]
    assert m == {"filename": "f.md", "doc_link": "https://x/f/", "Header1": "H"}
