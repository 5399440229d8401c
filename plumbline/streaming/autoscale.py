"""Autoscale target from pending-task samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.constants import SCALE_CAP, SCALE_MIN_PERCENT, SCALE_START, SCALE_WINDOW


def st_autoscale_target(
    samples: DataFrame,
    sample_period_s: int,
    window: str = SCALE_WINDOW,
    start: int = SCALE_START,
    cap: int = SCALE_CAP,
    min_pct: int = SCALE_MIN_PERCENT,
    slide: str | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """Nodes wanted per window of ``samples(ts, pending)``: the mean number of pending tasks, at most ``cap``.

    A window with fewer than ``min_pct`` percent of its expected samples asks for ``start`` nodes. ``slide`` gives
    overlapping windows, as a formula that always looks back from now. Works on batch and streaming input.
    """
    timed = samples.withColumn("ts", F.col("ts").cast("timestamp"))
    if samples.isStreaming:
        timed = timed.withWatermark("ts", watermark)
    grouped = timed.groupBy(F.window("ts", window, slide)).agg(
        F.count("pending").alias("samples"), F.avg("pending").alias("mean")
    )
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    percent = F.col("samples") * sample_period_s * 100 / seconds
    wanted = F.when(percent < min_pct, F.lit(float(start))).otherwise(F.col("mean"))
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "samples",
        F.least(F.lit(float(cap)), wanted).alias("target"),
    )
