"""File readers and writers."""

from __future__ import annotations

import os
import re
import shutil
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.text import landing_parts, log_line
from plumbline.session import SMALL_TASKS, fresh_path, mounted_folder, settings, written

LANDING_COLUMNS = ("Year", "Month", "Day", "Hour")
# Whole documents handed to a Python worker at once.
DOCUMENT_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``template_id`` is its path, ``template`` its whole text."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("template_id"), F.col("value").alias("template"))


def write_documents(df: DataFrame, path: str, key: str, text: str) -> int:
    """Each row as a compressed file of its own: ``text`` and a line break, at a path that holds ``<key>=<number>``.

    Returns the number of tasks that wrote them.

    On a mounted file system Hadoop starts two ``chmod`` processes for each file it creates, and the driver renames the
    files one after another. There Python workers write the files, each attempt of a task to a hidden folder, and the
    driver renames the folders of the attempts that ended well. In other stores Spark's writer makes a folder for each key.
    """
    rows, folder = df.select(key, text), mounted_folder(df.sparkSession, path)
    if folder is None:
        with settings(df.sparkSession, SMALL_TASKS):  # the rows of a task are sorted by their folders
            one = rows.write.option("maxRecordsPerFile", 1)
            one.partitionBy(key).option("compression", "lz4").text(path)
            return rows.rdd.getNumPartitions()
    attempts = f"{folder}/_temporary"

    def write(batches):
        import os
        import uuid

        import pyarrow as pa

        own, n, block = uuid.uuid4().hex, 0, 1 << 16
        os.mkdir(f"{attempts}/{own}")
        for batch in batches:
            for k, value in zip(*batch.columns, strict=True):
                name = k.as_py() if k.is_valid else "__HIVE_DEFAULT_PARTITION__"
                plain = (value.as_buffer().to_pybytes() if value.is_valid else b"") + b"\n"
                with open(f"{attempts}/{own}/part-{n:05d}-{key}={name}.txt.lz4", "xb") as f:
                    # Blocks of Hadoop's codec: plain length, compressed length, bytes.
                    for at in range(0, len(plain), block):
                        some = plain[at : at + block]
                        packed = pa.compress(some, codec="lz4_raw", asbytes=True)
                        f.write(len(some).to_bytes(4, "big") + len(packed).to_bytes(4, "big") + packed)
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"folder": [own]})

    os.makedirs(folder)  # an error if it is there
    os.mkdir(attempts)
    try:
        with settings(df.sparkSession, {**SMALL_TASKS, **DOCUMENT_BATCH}):
            ended = rows.mapInArrow(write, "folder string").collect()
        for n, attempt in enumerate(ended):
            os.rename(f"{attempts}/{attempt.folder}", f"{folder}/task-{n:05d}")
        return len(ended)
    finally:
        shutil.rmtree(attempts, ignore_errors=True)


def read_template_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line ``{"template_id": ..., "template": "<document>"}``: many documents to a file, splittable."""
    return spark.read.schema("template_id STRING, template STRING").option("mode", "FAILFAST").json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def append_log_entries(df: DataFrame, path: str, ts_col: str, msg_col: str) -> None:
    """Append ``dd/MM/yyyy HH:mm:ss|message`` lines to a log folder, such as the start and end of a run."""
    df.select(log_line(ts_col, msg_col).alias("value")).write.mode("append").text(path)


def read_csv_inferred(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, **options: object
) -> DataFrame:
    """CSV with a header line. Inference reads the data twice; pass ``schema`` when it is known.

    Quotes inside a field are escaped by a backslash unless ``options`` say otherwise (``escape='"'``).
    """
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_multiline(
    spark: SparkSession, path: str, schema: StructType | str | None = None, **options: object
) -> DataFrame:
    """Quoted CSV with a header line, whose fields may hold line breaks.

    With ``schema``, a file is read by as many tasks as it has splits, see ``split_records``; a field that holds a quote
    or a line break must be quoted. Without one, Spark infers it, and each file is a single task.
    """
    if schema is None:
        return read_csv_inferred(spark, path, schema, multiLine=True, **options)
    quote, escape, header = (str(options.get(k, v)) for k, v in (("quote", '"'), ("escape", "\\"), ("header", "true")))
    records = split_records(spark, path, quote, escape, header=header.lower() == "true")
    if isinstance(schema, StructType):
        schema = schema.toDDL()
    rest = {k: str(v) for k, v in options.items() if k != "header"}
    return records.select(F.from_csv("record", schema, rest).alias("r")).select("r.*")


_LINES = "file string, block bigint, n bigint, value string, quotes int, before int, even bigint, odd bigint"


def split_records(spark: SparkSession, path: str, quote: str = '"', escape: str = "\\", header: bool = True) -> DataFrame:
    """``(file, record)``: the records of quoted text files whose fields may hold line breaks, blank lines left out.

    Files are read by splits. Each task counts the quotes of its lines; whether a line begins inside a field follows
    from the number of quotes before it in its split, and from the parity of the splits before it, which is one row for
    each split. A line that begins and ends outside of a field is a record as it is. Only the lines of longer records
    are shuffled, by the place where the record begins.
    """

    def read(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        own, count, total, last = None, 0, 0, [-1, -1]
        pattern = "" if escape == quote else re.escape(escape) + "[" + re.escape(escape) + re.escape(quote) + "]"
        for batch in batches:
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            value = batch.column("value")
            plain = pc.replace_substring_regex(value, pattern, "") if pattern else value
            quotes = pc.count_substring(plain, quote).to_numpy(zero_copy_only=False)
            cuts = [0, *[k for k in range(1, len(files)) if (files[k], blocks[k]) != (files[k - 1], blocks[k - 1])], len(files)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if (files[a], blocks[a]) != own:  # a split begins
                    own, count, total, last = (files[a], blocks[a]), 0, 0, [-1, -1]
                n = np.arange(count, count + b - a)
                before = (total + np.cumsum(quotes[a:b]) - quotes[a:b]) % 2
                # Where the record of a line begins, if the split begins outside of a field or inside one.
                starts = [np.maximum(np.maximum.accumulate(np.where(before == p, n, -1)), last[p]) for p in (0, 1)]
                count, total, last = count + b - a, (total + int(quotes[a:b].sum())) % 2, [int(s[-1]) for s in starts]
                cells = [
                    batch.column("file").slice(a, b - a), batch.column("block").slice(a, b - a), pa.array(n), value.slice(a, b - a),
                    pa.array((quotes[a:b] % 2).astype(np.int32)), pa.array(before.astype(np.int32)), pa.array(starts[0]), pa.array(starts[1]),
                ]
                yield pa.RecordBatch.from_arrays(cells, [f.split()[0] for f in _names])

    _names = _LINES.split(", ")
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = written(lines.mapInArrow(read, _LINES), "lines")
    # One row for each split: does it begin inside a field, and where does the record begin that comes into it?
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    begin = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    begin = F.when(begin >= 0, F.struct(F.col("block").alias("block"), begin.alias("n")))
    splits = splits.withColumn("begin", begin).withColumn("came", F.last("begin", ignorenulls=True).over(earlier))
    first = Window.partitionBy("file").orderBy("block")
    splits = splits.select("file", "block", "inside", "came", (F.row_number().over(first) == 1).alias("first"))
    rows = lines.join(splits, ["file", "block"])
    opens = (F.col("before") + F.col("inside")) % 2 == 0
    own = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    start = F.when(own >= 0, F.struct(F.col("block").alias("block"), own.alias("n"))).otherwise(F.col("came"))
    rows = rows.select("file", "block", "n", "value", start.alias("start"), (opens & (F.col("quotes") == 0)).alias("whole"))
    top = splits.filter("first").select("file", F.col("block").alias("top"))
    whole = rows.filter("whole").select("file", "start", F.col("value").alias("record"))
    parts = rows.filter("NOT whole").groupBy("file", "start")
    joined = parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "value"))), lambda x: x["value"]), "\n").alias("record"))
    found = whole.unionByName(joined)
    if header:
        found = found.join(top, "file").filter((F.col("start.block") != F.col("top")) | (F.col("start.n") != 0))
    record = F.regexp_replace("record", "\r$", "")
    return found.select("file", record.alias("record")).filter(F.trim("record") != "")


def write_csv_quoted(df: DataFrame, path: str, **options: object) -> None:
    """CSV with a header line and every field quoted; blanks at the ends of a field are kept."""
    writer = df.write.mode("overwrite").option("header", True).option("quoteAll", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.options(**options).csv(path)


def write_parquet_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet folder and read it back; ``df`` must not read that folder."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_partitions(spark: SparkSession, path: str, touched: Column, change: Callable[[DataFrame], DataFrame], *partition_by: str) -> None:
    """Rewrite the partitions of a Parquet folder that ``touched`` selects by its partition columns; no other file changes.

    ``change`` gets the rows of these partitions and gives their new rows, in the same partitions. They are staged in the
    scratch folder first, so the path that is read is never the path being written, and a failure before the swap leaves
    the folder as it was. A partition that has no rows left keeps its old ones; delete its folder instead.
    """
    schema = spark.read.parquet(path).schema
    staged = fresh_path(spark, "staged")
    changed = change(spark.read.schema(schema).parquet(path).filter(touched))
    changed.write.partitionBy(*partition_by).parquet(staged)
    rows = spark.read.schema(schema).parquet(staged)
    if not rows.isEmpty():
        dealt = rows.hint("rebalance", *partition_by)
        dealt.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*partition_by).parquet(path)


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Files of a folder: ``path, name, length, modificationTime``. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path", F.substring_index("path", "/", -1).alias("name"), "length", "modificationTime"
    )


def list_tables(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """``TableName`` of each table of a folder, whether it is one file or a folder of files."""
    folder = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"
    path = F.col("path")
    below = path.substr(F.instr(path, folder) + len(folder), F.length(path))
    first = F.split_part(below, F.lit("/"), F.lit(1))
    names = list_files(spark, root, f"*{suffix}").select(first.alias("name")).filter(F.endswith("name", F.lit(suffix)))
    return names.select(F.col("name").substr(F.lit(1), F.length("name") - len(suffix)).alias("TableName")).distinct()


def with_landing_columns(df: DataFrame, now: datetime, hour24: bool = False) -> DataFrame:
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumns(landing_parts(moment, hour24))


def land_partitioned(df: DataFrame, path: str, now: datetime, hour24: bool = False) -> None:
    """Append under ``Year=/Month=/Day=/Hour=``, so that readers of a period prune the rest."""
    with_landing_columns(df, now, hour24).write.mode("append").partitionBy(*LANDING_COLUMNS).parquet(path)


def land_by_column(df: DataFrame, path: str, ts_col: str, hour24: bool = False) -> None:
    """The same for rows that carry their own arrival time.

    Rebalancing gives each folder few files; adaptive execution merges quiet hours and splits a busy one over
    several tasks.
    """
    rows = df.withColumns(landing_parts(ts_col, hour24)).hint("rebalance", *LANDING_COLUMNS)
    rows.write.mode("append").partitionBy(*LANDING_COLUMNS).parquet(path)


def binary_ingest(
    spark: SparkSession, src: str, dst: str, now: datetime, glob: str | None = None, hour24: bool = False
) -> DataFrame:
    """Copy files unchanged into a landing table of their bytes; returns the table."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    land_partitioned(reader.load(src).select("path", "modificationTime", "length", "content"), dst, now, hour24)
    return spark.read.parquet(dst)


class ParquetTables:
    """A folder of Parquet tables, usable as source or target of a copy."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self.spark, self.root, self.suffix = spark, root.rstrip("/"), suffix

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}{self.suffix}")

    def overwrite(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}{self.suffix}")
