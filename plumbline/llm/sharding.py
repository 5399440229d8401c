"""Sharding by jump consistent hashing: a stable key and the number of shards decide, without a ring table.

Adding one shard moves only the share of keys that the new shard takes. Slots number the rows of a shard without gaps:
tasks number their own rows, the counts per (task, shard) are summed up to offsets, and the offsets are joined back.
No shard is ever gathered in one task, so a shard, a key or repeated rows of any number do no harm.

A null key is a key of its own, as is the empty text. Repeated rows share the shard and have slots of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import stored

_NULL_KEY = "\x00null"


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key: the last jump of its pseudo-random sequence that lies below ``shards``."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[active] >> np.uint64(33)).astype(np.float64) + 1)
        following = np.floor((shard[active] + 1) * step).astype(np.int64)
        inside = following < shards
        shard[active[inside]] = following[inside]
        active = active[inside]
    return shard


def stable_key(column: Column | str) -> Column:
    """64-bit hash of the value's text form; equal on every cluster and in every run."""
    value = F.col(column) if isinstance(column, str) else column
    return F.xxhash64(F.coalesce(value.cast("string"), F.lit(_NULL_KEY)))


def shard_of(key: Column | str, shards: int) -> Column:
    """Shard of a row, from the key alone."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def compute(values):
        import pandas as pd

        return pd.Series(jump(values.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return compute(stable_key(key))


def with_slots(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard, in the order of tasks and of rows inside them.

    The numbered rows are stored once, so that a repeated task can't give other numbers than those counted; hand in
    narrow rows.
    """
    names = rows.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            values = batch.column(shard).to_numpy(zero_copy_only=False)
            order = np.argsort(values, kind="stable")
            found, first, size = np.unique(values[order], return_index=True, return_counts=True)
            within = np.empty(len(values), np.int64)
            within[order] = np.arange(len(values)) - np.repeat(first, size)
            base = np.array([seen.get(int(v), 0) for v in found], np.int64)
            within += base[np.searchsorted(found, values)]
            seen.update((int(v), int(b + s)) for v, b, s in zip(found, base, size, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(values), task, np.int32)), pa.array(within)], [*names, "_task", "_within"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    numbered = stored(rows.mapInArrow(number, f"{fields}, _task int, _within bigint"), "shard-rows")
    before = Window.partitionBy(shard).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(shard, "_task")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(shard, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    slotted = numbered.join(offsets, [shard, "_task"])
    return slotted.select(*[f"`{c}`" for c in names], (F.col("_before") + F.col("_within")).alias("slot"))


def write_shards(docs: DataFrame, path: str, key: str, shards: int) -> None:
    """Write every row to the folder of its shard; all rows of a shard lie below ``shard=<number>``.

    Rows are first dealt by (shard, hash of the row), so that a large shard is written by many tasks.
    """
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)))
    dealt = docs.withColumn("shard", shard_of(key, shards)).repartition(F.col("shard"), spread)
    dealt.write.partitionBy("shard").parquet(path)
