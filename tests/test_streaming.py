"""Streaming forms against their batch twins."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plumbline.session import fresh_path
from plumbline.streaming.autoscale import st_autoscale_target
from plumbline.streaming.landing import st_landing_ingest
from plumbline.streaming.run_status import run_updates, st_run_status
from plumbline.streaming.sink import latest_updates, write_updates

START = datetime(2024, 1, 1)


def file_stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture
def samples(spark):
    # First window complete with mean 10, second too few samples, third above the cap.
    data = [(START + timedelta(seconds=30 * i), 10.0) for i in range(6)]
    data += [(START + timedelta(seconds=180 + 30 * i), 10.0) for i in range(4)]
    data += [(START + timedelta(seconds=360 + 30 * i), 99.0) for i in range(6)]
    return spark.createDataFrame(data, "ts TIMESTAMP, pending DOUBLE")


def test_autoscale_rule(samples):
    out = st_autoscale_target(samples, 30).orderBy("window_start").collect()
    assert [(r.samples, r.target) for r in out] == [(6, 10.0), (4, 1.0), (6, 25.0)]


def test_autoscale_boundary_is_not_below(spark):
    # 7 of 10 expected samples are 70 percent, which is enough.
    data = [(START + timedelta(seconds=18 * i), 4.0) for i in range(7)]
    out = st_autoscale_target(spark.createDataFrame(data, "ts TIMESTAMP, pending DOUBLE"), 18)
    assert [r.target for r in out.collect()] == [4.0]


def test_autoscale_stream_equals_batch(spark, samples):
    source = fresh_path(spark, "samples")
    samples.repartitionByRange(4, "ts").write.parquet(source)
    path = fresh_path(spark, "out")
    stream = st_autoscale_target(file_stream(spark, source, samples.schema), 30)
    write_updates(stream, f"{path}/out", f"{path}/cp").awaitTermination()
    streamed = latest_updates(spark.read.parquet(f"{path}/out"), ["window_start"])
    batch = st_autoscale_target(samples, 30)
    assert rows(streamed.select(*batch.columns)) == rows(batch)


def test_status_follows_every_change(spark):
    minute = lambda n: START + timedelta(minutes=n)
    steps = [
        [("r1", "Succeeded", None, minute(5)), ("r1", "InProgress", None, minute(0)), ("r2", "Queued", None, minute(0))],
        # A late failure ends r2; an old status does not reopen r1.
        [("r2", "Failed", "second", minute(1)), ("r1", "Queued", None, minute(-1)), ("r2", "Failed", "first", minute(0))],
        # r1 goes on after it had ended.
        [("r1", "InProgress", None, minute(10))],
    ]
    want = [
        [("r1", "Succeeded", None)],
        [("r1", "Succeeded", None), ("r2", "Failed", "first")],
        [("r2", "Failed", "first")],
    ]
    schema = "run_id STRING, status STRING, error STRING, ts TIMESTAMP"
    source, path, seen = fresh_path(spark, "status"), fresh_path(spark, "out"), []
    for rows_, ended in zip(steps, want, strict=True):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(source)
        stream = file_stream(spark, source, spark.createDataFrame([], schema).schema)
        write_updates(stream, f"{path}/out", f"{path}/cp", fold=run_updates).awaitTermination()
        columns = ("run_id", "status", "ErrorDetails")
        assert rows(st_run_status(spark.read.parquet(f"{path}/out")).select(*columns)) == ended
        seen += rows_
        assert rows(st_run_status(run_updates(spark.createDataFrame(seen, schema))).select(*columns)) == ended


def test_landing_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "My People.csv").write_text("id,name\n1,a\n2,b\n")
    (source / "more.txt").write_text("id,name\n3,c\n")
    (source / "blob.bin").write_bytes(b"\x01\x02")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        st_landing_ingest(spark, str(source), out, checkpoint, "id INT, name STRING", max_files=2).awaitTermination()
        return rows(spark.read.parquet(f"{out}/Consume/*/*").select("id", "name"))

    assert run() == [(1, "a"), (2, "b"), (3, "c")]
    assert run() == [(1, "a"), (2, "b"), (3, "c")]
    (source / "next.csv").write_text("id,name\n4,d\n")
    assert run() == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert spark.read.parquet(f"{out}/Consume/MyPeople").count() == 2
    assert rows(spark.read.parquet(f"{out}/Landing").select(F.length("content"))) == [(2,)]


def test_landing_publishes_tables(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run(text, name):
        (source / name).write_text(text)
        st_landing_ingest(spark, str(source), out, checkpoint, publish=True).awaitTermination()
        return rows(spark.table("landedpeople").select("id", "name"))

    assert run("id,name\n1,a\n", "landed people.csv") == [(1, "a")]
    # A second file of the same name extends the data set.
    (source / "more").mkdir()
    assert run("id,name\n2,b\n", "more/landed people.txt") == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE landedpeople")
