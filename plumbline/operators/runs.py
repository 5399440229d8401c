"""Run-log analytics.

``runs(run_id, pipeline_name, status, last_updated)``,
``activity_runs(run_id, activity_name, activity_type, error, ts)``; ``error`` is JSON text. ``now`` is always a
parameter, so results can be repeated. Time ranges compare the bare column with a literal of its own type, which
reaches the Parquet or JDBC scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.constants import RUNNING, STILL_RUNNING, SUCCEEDED, UNKNOWN_PIPELINE
from plumbline.functions.text import is_blank, parse_error


def in_last_days(df: DataFrame, column: str, now: datetime, days: int) -> DataFrame:
    type_name = df.schema[column].dataType.simpleString()

    def literal(value: datetime) -> Column:
        return F.lit(value.isoformat(sep=" ")).cast(type_name)

    return df.filter(F.col(column).between(literal(now - timedelta(days=days)), literal(now)))


def r_latest_run(runs: DataFrame, names: DataFrame, now: datetime, days: int) -> DataFrame:
    """Latest run and its status for each requested name; empty texts when there was none.

    "Latest" is by ``last_updated``, then ``run_id``. ``max_by`` combines before the shuffle: one row per name
    and task, however many runs a name has.
    """
    latest = (
        in_last_days(runs, "last_updated", now, days)
        .groupBy("pipeline_name")
        .agg(F.max_by(F.struct("run_id", "status"), F.struct("last_updated", "run_id")).alias("r"))
    )
    return names.join(latest, "pipeline_name", "left").select(
        F.col("pipeline_name").alias("PipelineName"),
        F.coalesce("r.run_id", F.lit("")).alias("RunIdUsed"),
        F.coalesce("r.status", F.lit("")).alias("Status"),
    )


def r_status_by_run_id(runs: DataFrame, requests: DataFrame) -> DataFrame:
    """Status of the requested ``(pipeline_name, run_id)``; only the id is looked up, the name is echoed."""
    return requests.join(runs.select("run_id", "status"), "run_id", "left").select(
        F.col("pipeline_name").alias("PipelineName"),
        F.col("run_id").alias("RunIdUsed"),
        F.col("status").alias("Status"),
    )


def first_errors(activity_runs: DataFrame) -> DataFrame:
    """First error text of each run, by time."""
    return (
        activity_runs.filter(~is_blank("error"))
        .groupBy("run_id")
        .agg(F.min_by("error", F.struct("ts", "activity_name")).alias("ErrorDetails"))
    )


def r_terminal_runs(runs: DataFrame, activity_runs: DataFrame) -> DataFrame:
    """Runs that have ended; those that did not succeed carry their first error."""
    ended = runs.filter(~F.col("status").isin(*RUNNING))
    return ended.join(first_errors(activity_runs), "run_id", "left").select(
        F.col("pipeline_name").alias("PipelineName"),
        F.col("run_id").alias("RunIdUsed"),
        F.col("status").alias("Status"),
        F.when(F.col("status") != SUCCEEDED, F.col("ErrorDetails")).alias("ErrorDetails"),
    )


def _with_error(activity_runs: DataFrame, now: datetime, days: int) -> DataFrame:
    parsed = in_last_days(activity_runs, "ts", now, days).withColumn("e", parse_error("error"))
    return parsed.withColumn("has_error", ~is_blank("e.errorCode"))


_ERROR = {
    "ActivityName": "activity_name",
    "ActivityType": "activity_type",
    "ErrorCode": "e.errorCode",
    "ErrorType": "e.failureType",
    "ErrorMessage": "e.message",
}


def r_activity_error_rows(activity_runs: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """One row per activity error with an error code."""
    rows = _with_error(activity_runs, now, days).filter("has_error")
    return rows.select(F.col("run_id").alias("RunId"), *[F.col(c).alias(a) for a, c in _ERROR.items()])


def r_activity_errors(runs: DataFrame, activity_runs: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """Header of each run with its activity errors, one row per error; null error fields for a run without any.

    Nothing is gathered per run, so a run may have any number of errors. The counts are ``r_activity_error_counts``.
    """
    errors = r_activity_error_rows(activity_runs, now, days).withColumnRenamed("RunId", "run_id")
    return runs.join(errors, "run_id", "left").select(
        F.col("pipeline_name").alias("PipelineName"),
        F.col("status").alias("PipelineStatus"),
        F.col("run_id").alias("RunId"),
        *_ERROR,
    )


def r_activity_error_counts(runs: DataFrame, activity_runs: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """Per run: activities seen, and activities with an error code."""
    counts = _with_error(activity_runs, now, days).groupBy("run_id").agg(
        F.count("*").alias("ResponseCount"), F.count_if("has_error").alias("ResponseErrorCount")
    )
    return runs.join(counts, "run_id", "left").select(
        F.col("pipeline_name").alias("PipelineName"),
        F.col("status").alias("PipelineStatus"),
        F.col("run_id").alias("RunId"),
        F.coalesce("ResponseCount", F.lit(0)).alias("ResponseCount"),
        F.coalesce("ResponseErrorCount", F.lit(0)).alias("ResponseErrorCount"),
    )


def r_running_gate(
    runs: DataFrame,
    requests: DataFrame | tuple[str, str],
    now: datetime,
    days: int,
    known: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Whether another run of the pipeline is in progress or queued, for each ``(pipeline_name, this_run_id)``.

    The running rows are counted per run and per name, and the run's own rows subtracted, so requests never pair
    up with the runs. A single request may be given as a pair. ``known`` holds the valid names; a request for another
    name is blocked and says so (``known`` is false). ``strict`` fails the job for a blocked request.
    """
    if isinstance(requests, tuple):
        requests = runs.sparkSession.createDataFrame([requests], "pipeline_name STRING, this_run_id STRING")
    if known is None:
        requests = requests.withColumn("known", F.lit(True))
    else:
        valid = known.select("pipeline_name", F.lit(True).alias("known")).distinct()
        requests = requests.join(valid, "pipeline_name", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    running = in_last_days(runs, "last_updated", now, days).filter(F.col("status").isin(*RUNNING))
    per_run = running.groupBy("pipeline_name", "run_id").agg(F.count("*").alias("own"))
    per_name = per_run.groupBy("pipeline_name").agg(F.sum("own").alias("total"))
    others = F.coalesce("total", F.lit(0)) - F.coalesce("own", F.lit(0))
    gate = (
        requests.join(per_name, "pipeline_name", "left")
        .join(per_run.withColumnRenamed("run_id", "this_run_id"), ["pipeline_name", "this_run_id"], "left")
        .select("pipeline_name", "this_run_id", "known", others.alias("RunningCount"))
    )
    blocked = (F.col("RunningCount") >= 1) | ~F.col("known")
    template = F.when(F.col("known"), F.lit(STILL_RUNNING)).otherwise(F.lit(UNKNOWN_PIPELINE))
    message = F.replace(template, F.lit("#"), F.col("pipeline_name"))
    text = F.when(blocked, F.raise_error(message) if strict else message)
    return gate.withColumns({"blocked": blocked, "message": text})


def r_last_execution(log: DataFrame) -> DataFrame:
    """All log rows of the execution that owns the highest log id, by stage and pipeline."""
    # One row, found by a partial-then-final aggregate.
    last = log.agg(F.max_by("LocalExecutionId", "LogId").alias("LocalExecutionId"))
    columns = ("LogId", "StageId", "PipelineId", "PipelineName", "StartDateTime", "PipelineStatus", "EndDateTime")
    return log.join(F.broadcast(last), "LocalExecutionId").select(*columns).orderBy("StageId", "PipelineId")


def r_property_lookup(properties: DataFrame, names: DataFrame | str) -> DataFrame:
    """Least value of each requested property; null when it is not set, no row when a single name is not."""
    first = properties.groupBy("PropertyName").agg(F.min("PropertyValue").alias("PropertyValue"))
    if isinstance(names, str):
        return first.filter(F.col("PropertyName") == names)
    return names.join(first, "PropertyName", "left")


def r_current_execution_counts(current: DataFrame) -> DataFrame:
    return current.groupBy("StageId", "PipelineStatus").agg(F.count("*").alias("RecordCount"))
