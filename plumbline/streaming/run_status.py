"""Terminal status of runs from a stream of status changes.

The stream keeps no state: each micro-batch is folded to one row per run and written, and a query folds what was
written. A run that goes on after an ended status is corrected by its later row, and late rows by their event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.constants import RUNNING, SUCCEEDED
from plumbline.functions.text import is_blank


def run_updates(status_changes: DataFrame) -> DataFrame:
    """One row per run of ``(run_id, status, error, ts)``: its latest status and its first error, with their times."""
    failed = ~is_blank("error")
    return status_changes.groupBy("run_id").agg(
        F.max_by("status", "ts").alias("status"),
        F.max("ts").alias("last_updated"),
        F.min_by(F.when(failed, F.col("error")), F.when(failed, F.col("ts"))).alias("error"),
        F.min(F.when(failed, F.col("ts"))).alias("error_at"),
    )


def st_run_status(updates: DataFrame) -> DataFrame:
    """Runs that have ended, by all rows of ``run_updates`` so far; those that did not succeed with their first error."""
    latest = updates.groupBy("run_id").agg(
        F.max_by("status", "last_updated").alias("status"),
        F.max("last_updated").alias("last_updated"),
        F.min_by("error", "error_at").alias("error"),
    )
    return latest.filter(~F.col("status").isin(*RUNNING)).select(
        "run_id", "status", "last_updated", F.when(F.col("status") != SUCCEEDED, F.col("error")).alias("ErrorDetails")
    )
