"""A file sink for aggregates in update mode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_updates(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fold: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write each batch's changed rows to its own ``batch=`` folder; repeating a batch replaces it.

    ``fold`` is applied to each batch before, as a batch of its own: it keeps no state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = fold(batch) if fold else batch
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_updates(df: DataFrame, keys: list[str]) -> DataFrame:
    """The last written row per key of a folder filled by ``write_updates``."""
    values = [c for c in df.columns if c not in (*keys, "batch")]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return last.select(*keys, "v.*")
