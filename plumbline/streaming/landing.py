"""Continuous ingestion of arriving files."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.text import first_dot_extension
from plumbline.operators.ingest import dataset_of
from plumbline.sources.catalog import publish_folder
from plumbline.sources.files import read_csv_inferred

BINARY_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _arrival(path: Column) -> Column:
    """The arriving item a file belongs to: the file, or its folder when that is named like a delimited file.

    Spark writes a CSV as a folder of parts; the parts are one data set.
    """
    return F.when(path.rlike("[.](csv|txt)/[^/]*$"), F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(path)


def st_landing_ingest(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    schema: str | None = None,
    max_files: int = 1000,
    trigger: dict | None = None,
    publish: bool = False,
) -> StreamingQuery:
    """Take each arriving file once: delimited files to ``Consume/<name>``, any other unchanged to ``Landing``.

    The stream carries file names only; at most ``max_files`` of them come to the driver per batch, which sorts
    them by route and starts distributed reads. Every write replaces its own ``batch=`` folder, so a repeated
    batch leaves no duplicates. ``schema`` saves the inference pass when all delimited files share one. ``publish``
    makes each data set a table of its name.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        delimited = defaultdict(list)
        others = []
        for row in batch.select("path", "arrival", "extension").collect():
            if row.extension in ("csv", "txt"):
                delimited[dataset_of(row.arrival)].append(row.path)
            else:
                others.append(row.path)
        for name, paths in delimited.items():
            rows = read_csv_inferred(session, paths, schema)
            rows.write.mode("overwrite").parquet(f"{dst}/Consume/{name}/batch={batch_id}")
            if publish:
                publish_folder(session, name, f"{dst}/Consume/{name}")
        if others:
            copied = session.read.format("binaryFile").load(others)
            copied.write.mode("overwrite").parquet(f"{dst}/Landing/batch={batch_id}")

    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(src)
        .select("path", _arrival(F.col("path")).alias("arrival"))
        .withColumn("extension", first_dot_extension(F.substring_index("arrival", "/", -1)))
    )
    return (
        files.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
