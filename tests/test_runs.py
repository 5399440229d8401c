"""Run-log operators on hand-made logs."""

from datetime import datetime, timedelta

import pytest
from conftest import rows

from plumbline.operators import notebooks as N
from plumbline.operators import runs as R

NOW = datetime(2024, 1, 10, 12)


def ago(**kw):
    return NOW - timedelta(**kw)


@pytest.fixture
def runs(spark):
    data = [
        ("r1", "a", "Succeeded", ago(days=3)),
        ("r2", "a", "InProgress", ago(days=1)),
        ("r3", "a", "Queued", ago(days=2)),
        ("r4", "b", "Failed", ago(days=30)),
        ("r5", "c", "Failed", ago(hours=1)),
        ("r6", "c", "Cancelled", ago(hours=1)),
    ]
    return spark.createDataFrame(data, "run_id STRING, pipeline_name STRING, status STRING, last_updated TIMESTAMP")


@pytest.fixture
def activity_runs(spark):
    def error(code, message="m"):
        return f'{{"errorCode": "{code}", "failureType": "UserError", "message": "{message}"}}'

    data = [
        ("r5", "first", "Copy", None, ago(hours=5)),
        ("r5", "second", "Copy", error("7", 'say \\"no\\"'), ago(hours=4)),
        ("r5", "third", "Lookup", error("8"), ago(hours=3)),
        ("r5", "blank", "Lookup", error(""), ago(hours=2)),
        ("r5", "odd", "Lookup", "not json", ago(hours=2)),
        ("r5", "old", "Copy", error("9"), ago(days=8)),
        ("r1", "fine", "Copy", "", ago(days=3)),
    ]
    schema = "run_id STRING, activity_name STRING, activity_type STRING, error STRING, ts TIMESTAMP"
    return spark.createDataFrame(data, schema)


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "pipeline_name STRING")


def test_latest_run_in_range(spark, runs):
    out = R.r_latest_run(runs, names(spark, "a", "b", "c", "d"), NOW, 7)
    assert rows(out) == [("a", "r2", "InProgress"), ("b", "", ""), ("c", "r6", "Cancelled"), ("d", "", "")]


def test_time_range_reaches_the_scan(spark, runs, tmp_path):
    runs.write.parquet(str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = R.in_last_days(stored, "last_updated", NOW, 7)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(last_updated" in plan and "LessThanOrEqual(last_updated" in plan


def test_status_echoes_the_requested_name(spark, runs):
    requests = spark.createDataFrame([("other", "r1"), ("x", "none")], "pipeline_name STRING, run_id STRING")
    assert rows(R.r_status_by_run_id(runs, requests)) == [("other", "r1", "Succeeded"), ("x", "none", None)]


def test_terminal_runs_carry_their_first_error(runs, activity_runs):
    out = {r.RunIdUsed: r for r in R.r_terminal_runs(runs, activity_runs).collect()}
    assert set(out) == {"r1", "r4", "r5", "r6"}
    assert out["r1"].ErrorDetails is None and out["r6"].ErrorDetails is None
    assert '"errorCode": "9"' in out["r5"].ErrorDetails


def test_activity_errors(runs, activity_runs):
    wanted = runs.filter("run_id IN ('r1', 'r5', 'r6')")
    out = R.r_activity_errors(wanted, activity_runs, NOW).collect()
    assert sorted((r.RunId, *r[3:]) for r in out if r.ErrorCode) == [
        ("r5", "second", "Copy", "7", "UserError", 'say "no"'),
        ("r5", "third", "Lookup", "8", "UserError", "m"),
    ]
    assert sorted(r.RunId for r in out if not r.ErrorCode) == ["r1", "r6"]
    counts = {r.RunId: (r.ResponseCount, r.ResponseErrorCount) for r in R.r_activity_error_counts(wanted, activity_runs, NOW).collect()}
    assert counts == {"r1": (1, 0), "r5": (5, 2), "r6": (0, 0)}
    assert R.r_activity_error_rows(activity_runs, NOW).count() == 2


@pytest.mark.parametrize("second", [0, 1])
def test_activity_errors_of_a_run_with_many(spark, runs, second):
    from pyspark.sql import functions as F

    many = spark.range(5000).select(
        F.lit("r5").alias("run_id"),
        F.concat(F.lit("act"), F.col("id").cast("string")).alias("activity_name"),
        F.lit("Copy").alias("activity_type"),
        F.lit('{"errorCode": "1"}').alias("error"),
        (F.lit(ago(days=1)) + F.make_dt_interval(secs=F.col("id") * second)).alias("ts"),
    )
    out = R.r_activity_errors(runs.filter("run_id = 'r5'"), many, NOW)
    assert sorted(r.ActivityName for r in out.collect()) == sorted(f"act{i}" for i in range(5000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    counts = R.r_activity_error_counts(runs.filter("run_id = 'r5'"), many, NOW).first()
    assert (counts.ResponseCount, counts.ResponseErrorCount) == (5000, 5000)


def test_running_gate(spark, runs):
    requests = spark.createDataFrame(
        [("a", "r2"), ("a", "new"), ("c", "r5"), ("unknown", "x")], "pipeline_name STRING, this_run_id STRING"
    )
    known = runs.select("pipeline_name").distinct()
    out = R.r_running_gate(runs, requests, NOW, 7, known=known).collect()
    assert {(r.pipeline_name, r.this_run_id): r.RunningCount for r in out} == {
        ("a", "r2"): 1, ("a", "new"): 2, ("c", "r5"): 0, ("unknown", "x"): 0
    }
    assert [(r.known, r.blocked, r.message) for r in out if r.pipeline_name == "unknown"] == [
        (False, True, "Provided pipeline name (unknown) is not known.")
    ]
    message = next(r.message for r in out if r.this_run_id == "new")
    assert message.startswith("Provided pipeline name (a) still has a run in progress or queued")
    assert [r.message for r in out if not r.blocked] == [None]


def test_strict_gate_fails_the_job(spark, runs):
    blocked = spark.createDataFrame([("a", "new")], "pipeline_name STRING, this_run_id STRING")
    free = spark.createDataFrame([("c", "new")], "pipeline_name STRING, this_run_id STRING")
    with pytest.raises(Exception, match="still has a run in progress"):
        R.r_running_gate(runs, blocked, NOW, 7, strict=True).collect()
    assert R.r_running_gate(runs, free, NOW, 7, strict=True).first().blocked is False
    assert rows(R.r_running_gate(runs, ("a", "r2"), NOW, 7).select("RunningCount", "blocked")) == [(1, True)]


def test_strict_gate_fails_for_an_unknown_name(spark, runs):
    known = runs.select("pipeline_name")
    with pytest.raises(Exception, match="is not known"):
        R.r_running_gate(runs, ("unknown", "x"), NOW, 7, known=known, strict=True).collect()


def test_last_execution(spark):
    data = [(1, 1, 1, 5), (2, 2, 2, 1), (3, 2, 1, 9), (4, 2, 1, 3)]
    log = spark.createDataFrame(data, "LogId INT, LocalExecutionId INT, StageId INT, PipelineId INT").selectExpr(
        "*", "'p' AS PipelineName", "current_timestamp() AS StartDateTime", "'Success' AS PipelineStatus",
        "current_timestamp() AS EndDateTime",
    )
    assert [r.LogId for r in R.r_last_execution(log).collect()] == [4, 3, 2]


def test_property_lookup(spark):
    properties = spark.createDataFrame([("a", "1"), ("b", "3"), ("b", "2")], "PropertyName STRING, PropertyValue STRING")
    assert rows(R.r_property_lookup(properties, "b")) == [("b", "2")]
    wanted = spark.createDataFrame([("a",), ("c",)], "PropertyName STRING")
    assert rows(R.r_property_lookup(properties, wanted)) == [("a", "1"), ("c", None)]


def test_order_lines_of_an_empty_date(spark):
    header = spark.createDataFrame(
        [(1, "SO1", datetime(2020, 1, 1)), (2, "SO2", datetime(2020, 1, 1)), (3, "SO3", datetime(2020, 1, 2))],
        "SalesOrderID INT, SalesOrderNumber STRING, OrderDate TIMESTAMP",
    )
    detail = spark.createDataFrame([(1, 1), (1, 2), (3, 1)], "SalesOrderID INT, SalesOrderDetailID INT")
    for count in (N.n_order_line_count, N.n_order_line_count_sql):
        assert rows(count(header, detail, "2020-01-01")) == [("SO1", 2)]
        assert rows(count(header, detail, "")) == []


def test_word_count_keeps_empty_words(spark):
    lines = spark.createDataFrame([("a  b a",), ("",)], "value STRING")
    counts = N.n_word_count(lines)
    assert [tuple(r) for r in counts.collect()] == [("", 2), ("a", 2), ("b", 1)]
    assert rows(N.n_word_count_repeated(counts)) == [("", 2), ("a", 2)]
