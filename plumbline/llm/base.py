"""Helpers shared by the operators: stored intermediate tables, bounded slices of Arrow batches, text buffers."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import plumbline
from plumbline.session import fresh_path

#: Bytes of text handled at once inside a task; working arrays are a small multiple of it. A longer text is a slice of its own.
SLICE_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers need no installation."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(plumbline.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="plumbline-"), "plumbline_code.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later stages read files, not the lineage of lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: Column | str, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; a null counts as the empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def utf8(column: Column | str) -> Column:
    """The text as bytes; a null becomes empty."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.cast("string"), F.lit("")).cast("binary")


def release() -> None:
    """Give memory that a worker no longer uses back to the machine; workers are used again by other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed pages otherwise
    if trim:
        trim(0)


def as_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the n + 1 offsets of its values, without a copy where Arrow allows it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``column`` holds about ``limit`` bytes; one row at least, so that a long text stays whole."""
    if not batch.num_rows:
        return
    _, at = as_arrays(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def whole_rows(docs: DataFrame) -> Column:
    """All columns as one struct ``_doc``, so that no column of the input clashes with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")


def by_slices(df: DataFrame, column: str, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``each`` to bounded slices of the rows, in Arrow batches and without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield each(part)
        release()  # workers are used again by other stages

    return df.mapInArrow(run, schema)


def volume(df: DataFrame, column: str) -> tuple[int, int]:
    """Number of rows and bytes of ``column``, over the whole table."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(column).cast("string"))).alias("b")).first()
    return row["n"], row["b"] or 0


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
