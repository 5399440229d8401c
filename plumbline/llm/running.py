"""Running sums over rows in a global order, group by group, without a task that sees a whole group.

Rows are dealt by ranges of the order, each task sums its own rows, the sums of (group, task) become offsets, and the
offsets are joined back. There are at most as many offsets as groups and tasks together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import stored


def running(rows: DataFrame, group: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` (bigint) over the rows of the same ``group`` that come before this one.

    ``group`` is a string column without nulls. Rows that are equal in ``order`` follow each other in any order, and a
    run of them may be spread over tasks. Sums are integers, so the way rows are dealt does not change them.
    """
    names = rows.columns
    spread = [F.col(f"`{group}`"), *order, F.col("_deal")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(group), batch.column(value).to_numpy(zero_copy_only=False)
            total = np.concatenate([[0], np.cumsum(values)])
            starts = np.concatenate([[0], np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1])
            base = -total[starts]
            if keys[0].as_py() == last:
                base[0] += carried
            within = total[:-1] + np.repeat(base, np.diff(np.append(starts, len(values))))
            last, carried = keys[-1].as_py(), int(within[-1] + values[-1])
            cells = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cells, pa.array(np.full(len(values), task, np.int32)), pa.array(within)], [*names, "_task", "_within"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.withColumn("_deal", F.monotonically_increasing_id()).repartitionByRange(*spread).sortWithinPartitions(*spread)
    summed = stored(dealt.mapInArrow(add, f"{fields}, _task int, _within bigint"), "running")
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        summed.groupBy(group, "_task")
        .agg(F.sum(value).alias("_sum"))
        .select(group, "_task", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    return summed.join(offsets, [group, "_task"]).select(*[f"`{c}`" for c in names], (F.col("_before") + F.col("_within")).alias(name))
