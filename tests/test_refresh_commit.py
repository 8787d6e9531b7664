"""Two refresh runs at a time."""

from __future__ import annotations

import glob
import json

import pytest

from docweave.options import DEFAULT
from docweave.plans import refresh as RF

OPTS = DEFAULT.with_(chunk_buckets=2)
CHUNKS = "filename string, chunk_no long, header1 string, header2 string, header3 string, doc_link string, text string"
CHANGES = "filename string, status string, markdown string"


class Site:
    """A product's table and log; ``during`` runs once while a change set is being made."""

    def __init__(self, spark, tmp_path):
        self.spark, self.log, self.table = spark, str(tmp_path / "log"), str(tmp_path / "chunks")
        self.calls = 0

    def run(self, ref, during=None, product="docs"):
        def changes(last):
            self.calls += 1
            if during is not None and self.calls == 1:
                during()
            return self.spark.createDataFrame([("en/a.md", "modified", f"# A\n{ref}")], CHANGES)

        full = lambda: self.spark.createDataFrame([("en/a.md", 1, "A", None, None, "l", ref)], CHUNKS)
        return RF.run_refresh(self.spark, product, ref, self.log, self.table, full, changes, OPTS)

    def entries(self):
        out = [json.loads(open(f).read()) for f in glob.glob(self.log + "/*.json")]
        return sorted((e["product"], e["seq"], e["last_updated_ref"]) for e in out)

    def texts(self):
        return [r["text"] for r in self.spark.read.parquet(self.table).collect()]


def test_the_second_of_two_runs_finds_nothing_to_do(spark, tmp_path):
    site = Site(spark, tmp_path)
    assert site.run("v1") == "FULL_LOAD"
    inner = []
    assert site.run("v2", during=lambda: inner.append(site.run("v2"))) == "SKIP"
    assert inner == ["INCREMENTAL"]
    assert site.entries() == [("docs", 1, "v1"), ("docs", 2, "v2")]
    assert site.texts() == ["#A\nv2"]


def test_the_second_run_goes_on_from_what_the_first_has_committed(spark, tmp_path):
    site = Site(spark, tmp_path)
    site.run("v1")
    assert site.run("v3", during=lambda: site.run("v2")) == "INCREMENTAL"
    assert site.entries() == [("docs", 1, "v1"), ("docs", 2, "v2"), ("docs", 3, "v3")]
    assert site.texts() == ["#A\nv3"]
    assert [tuple(r) for r in RF.read_tracking_log(spark, site.log).collect()] == [("docs", "v3", "1.0", 3)]


def test_an_entry_is_created_once_and_products_do_not_meet(spark, tmp_path):
    log = str(tmp_path / "log")
    entry = {"product": "a", "last_updated_ref": "r", "last_updater_version": "1.0", "seq": 1}
    assert RF.commit_entry(spark, log, entry) and not RF.commit_entry(spark, log, entry | {"last_updated_ref": "s"})
    assert RF.commit_entry(spark, log, entry | {"product": "b"})
    assert {r["product"]: r["last_updated_ref"] for r in RF.read_tracking_log(spark, log).collect()} == {"a": "r", "b": "r"}


@pytest.mark.parametrize("left", ["", '{"product": "do'])
def test_a_writer_that_died_in_its_entry_takes_only_its_number(spark, tmp_path, left):
    site = Site(spark, tmp_path)
    site.run("v1")
    broken = glob.glob(site.log + "/*.json")[0].replace("0000000001", "0000000002")
    with open(broken, "w") as f:
        f.write(left)
    assert site.run("v2") == "INCREMENTAL"
    assert [r["seq"] for r in RF.read_tracking_log(spark, site.log).collect()] == [3]
    assert site.run("v2") == "SKIP"
