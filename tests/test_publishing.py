"""Versioned tables and publishing from a stream, batches replayed at each point where a run can be lost."""

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from docwright.operators import publish as P
from docwright.plans import QUERIES
from docwright.sources import json_files as J
from docwright.sources.snapshots import Snapshots
from docwright.streaming import publishing as S


def test_a_table_is_read_and_replaced_in_one_job(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), "k long, v string")
    assert table.head() is None and table.read().collect() == []
    assert table.replace(spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")) == 1
    assert table.replace(table.read().withColumn("v", F.concat("v", F.lit("!"))).unionByName(spark.createDataFrame([(3, "c")], "k long, v string"))) == 2
    assert sorted(map(tuple, table.read().collect())) == [(1, "a!"), (2, None), (3, "c")]
    assert sorted(map(tuple, table.read(1).collect())) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        table.read(9)


def test_a_lost_write_leaves_the_version_before(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), "k long")
    table.replace(spark.range(3).select(F.col("id").alias("k")))
    with pytest.raises(Exception, match="lost"):
        table.replace(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("k")))
    assert table.head()["version"] == 1 and table.read().count() == 3
    assert table.replace(spark.range(1).select(F.col("id").alias("k")), "w", 4) == 2 == table.replace(spark.range(5).select(F.col("id").alias("k")), "w", 4)
    assert table.read().count() == 1


class Remote:
    """Counts what is sent; courses named `no` are rejected, `stop` ends the run."""

    def __init__(self):
        self.sent = []

    def __call__(self, queue):
        rows = queue.select("course_id", "checksum", "course_name").collect()
        self.sent += [(r["course_id"], r["checksum"]) for r in rows]
        status = F.when(F.col("course_name") == "no", 422).when(F.col("course_name") == "stop", 401).otherwise(201)
        return queue.select(
            "course_id", "course_name", "checksum", F.substring("course_id", 2, 9).cast("long").alias("ord"), status.alias("http_status"), P.outcome_class(status).alias("outcome"), F.lit("r").alias("remote_id"))


def rows(spark, *given):
    return spark.createDataFrame([(c, n, json.dumps(b), t) for c, n, b, t in given], "course_id string, course_name string, body string, arrived int")


def test_batches_replayed_at_each_point(spark, tmp_path, monkeypatch):
    folder, remote = str(tmp_path / "p"), Remote()
    first = rows(spark, ("c1", "x", {"a": 1}, 1), ("c1", "x", {"a": 2.0}, 2), ("c2", "no", {"a": 1}, 1))
    S.publish_batch(first, folder, remote, "w", 0)
    S.publish_batch(first, folder, remote, "w", 0)  # replayed as a whole
    ledger = lambda: {r["course_id"]: r["checksum"] for r in S.ledger_in(spark, folder).read().collect()}
    assert len(remote.sent) == 2 and set(ledger()) == {"c1"}
    store, calls = Snapshots.replace, []

    def lost(self, *args):  # after the answers are stored, before the ledger is
        if self.folder.endswith("ledger") and not calls:
            calls.append(1)
            raise RuntimeError("lost")
        return store(self, *args)

    monkeypatch.setattr(Snapshots, "replace", lost)
    second = rows(spark, ("c1", "x", {"a": 2.00}, 3), ("c3", "x", {"a": 3}, 3), ("c4", "stop", {}, 3), ("c5", "x", {}, 3))
    with pytest.raises(RuntimeError):
        S.publish_batch(second, folder, remote, "w", 1)
    assert set(ledger()) == {"c1"}
    S.publish_batch(second, folder, remote, "w", 1)
    assert len(remote.sent) == len(set(remote.sent)) == 5 and set(ledger()) == {"c1", "c3"}  # c1 unchanged; c5 stands behind the stop
    S.publish_batch(rows(spark, ("c5", "x", {}, 4)), folder, remote, "other", 1)  # another writer's batch of the same number
    assert set(ledger()) == {"c1", "c3", "c5"}


def test_a_stream_started_again_publishes_nothing_twice(spark, tmp_path):
    folder, source, remote = str(tmp_path / "p"), str(tmp_path / "in"), Remote()
    rows(spark, ("c1", "x", {"a": 1}, 1), ("c2", "x", {"a": 1}, 1)).write.parquet(source)
    stream = lambda state: S.publish_stream(
        spark.readStream.schema("course_id string, course_name string, body string, arrived int").parquet(source), folder, remote, state, str(tmp_path / state)).awaitTermination()
    stream("a")
    rows(spark, ("c2", "x", {"a": 1.0}, 2), ("c3", "x", {"a": 1}, 2)).write.mode("append").parquet(source)
    stream("a")
    assert sorted(c for c, _ in remote.sent) == ["c1", "c2", "c2", "c3"]
    stream("b")  # all rows once more, from a new checkpoint: the last of c2 and the others stand in the ledger
    assert len(remote.sent) == 4 and S.ledger_in(spark, folder).read().count() == 3


def test_files_are_parsed_once_whatever_reads_them(spark):
    rows = [("/s/a/run.json", '{"course_id":"a","course_name":"A","status":"validated"}'), ("/s/b/run.json", '{"course_id":"","status":"validated"}'),
            ("/s/c/run.json", "[1]"), ("/s/d/run.json", "{"), ("/s/e/run.json", None)]
    files = spark.createDataFrame(rows, "path string, value string")
    found = J.runs(files).where((F.col("status") == "validated") & (F.length("course_id") > 0))
    assert [r["course_id"] for r in found.collect()] == ["a"] and J.runs(files).count() == 2
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        found.explain()
    assert plan.getvalue().lower().count("parse_json") + plan.getvalue().count("parseJson") <= 1
    pairs = J.run_documents(files, files.where("path like '%/a/%' or path like '%/b/%'"))
    assert P.publishable_pairs(pairs).collect() == [("a", "A", rows[0][1])]


def test_cut_results_are_made_once(spark):
    for name in ("abort_cut", "ledger_upsert"):
        assert any("/results/" in path for path in QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles())


def test_review_files_are_packed(spark):
    assert 0 < len(QUERIES["review_scan"](spark, "/root/testdata/sf0.001").inputFiles()) <= 8
