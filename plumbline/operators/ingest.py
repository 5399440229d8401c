"""Metadata-driven ingestion: routing, conversion, cleaning, copying and rendering."""

from __future__ import annotations

import posixpath
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from plumbline.functions.text import (
    cut_name,
    fill_parameters,
    first_dot_extension,
    landing_folder,
    log_line,
    log_line_message,
    log_line_time,
    redact,
)
from plumbline.operators.templates import with_properties
from plumbline.sources.catalog import publish_table
from plumbline.sources.files import read_csv_inferred, write_csv_quoted, write_parquet_roundtrip


def i_landing_path(df: DataFrame, ts_col: str, hour24: bool = False) -> DataFrame:
    return df.withColumn("ProcessDateFolder", landing_folder(ts_col, hour24))


def i_route_files(files: DataFrame, now: datetime | Column) -> DataFrame:
    """Route of each file by its extension (text after the *first* dot, case as written).

    ``xlsx`` and ``txt`` become ``csv`` in the target name, in *every* place they occur; any other file keeps its
    name and is copied unchanged. One timestamp serves all files, so a run across midnight has one folder.
    """
    moment = now if isinstance(now, Column) else F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    extension = first_dot_extension("name")
    route = F.when(F.col("extension").isin("xlsx", "txt"), F.col("extension")).otherwise("default")
    target = F.when(
        F.col("route") != "default", F.replace("name", F.col("route"), F.lit("csv"))
    ).otherwise(F.col("name"))
    return (
        files.withColumn("extension", extension)
        .withColumn("route", route)
        .withColumn("target_name", target)
        .withColumn("target_folder", F.concat(F.lit("Landing/"), landing_folder(moment)))
    )


def i_txt_to_csv(spark: SparkSession, src: str, dst: str, schema: StructType | str | None = None) -> None:
    """Delimited text to CSV with every field quoted."""
    write_csv_quoted(read_csv_inferred(spark, src, schema), dst)


def dataset_of(path: str) -> str:
    """File name without its last extension and without blanks."""
    return posixpath.splitext(posixpath.basename(path.rstrip("/")))[0].replace(" ", "")


def i_csv_to_table(
    spark: SparkSession,
    path: str,
    out_root: str,
    schema: StructType | str | None = None,
    table_path: str | None = None,
) -> DataFrame:
    """CSV to ``<out_root>/Consume/<name>.parquet`` and a table of that name; returns the table."""
    name = dataset_of(path)
    rows = read_csv_inferred(spark, path, schema)
    consumed = write_parquet_roundtrip(rows, f"{out_root}/Consume/{name}.parquet")
    return publish_table(consumed, name, table_path)


def i_clean_csv(df: DataFrame) -> DataFrame:
    """Remove line breaks inside text fields, so that each record is one line."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}

    def cleaned(name: str) -> Column:
        column = F.col(f"`{name}`")
        return F.regexp_replace(column, "[\\r\\n]+", "").alias(name) if name in texts else column

    return df.select(*[cleaned(name) for name in df.columns])


def i_copy_table(source, target, table: str) -> int:
    """Copy one table between two stores (see ``plumbline.sources``); returns the rows written.

    The count is observed while writing, so the data is read once.
    """
    seen = Observation()
    target.overwrite(source.read(table).observe(seen, F.count(F.lit(1)).alias("rows")), table)
    return seen.get["rows"]


def i_copy_all_tables(
    spark: SparkSession, source, target, tables: DataFrame, threads: int = 8, strict: bool = False
) -> DataFrame:
    """Truncate and load every table named in ``tables(TableName)``; one row per table with its outcome.

    Only the names come to the driver, and a name may be listed once. Each copy is an independent distributed job; a
    few run side by side. A failed copy does not stop the others; with ``strict`` it fails the call once all have
    ended.
    """

    def copy(table: str) -> tuple[str, int | None, str]:
        try:
            return table, i_copy_table(source, target, table), "Succeeded"
        except Exception as error:  # reported per table, like a failed item of a loop
            return table, None, f"Failed: {type(error).__name__}"

    names = [row.TableName for row in tables.select("TableName").collect()]
    if len(set(names)) < len(names):
        raise ValueError("a table is listed more than once")
    with ThreadPoolExecutor(max_workers=threads) as pool:
        results = list(pool.map(copy, names))
    failed = [f"{table}: {status}" for table, _, status in results if status != "Succeeded"]
    if strict and failed:
        raise RuntimeError("; ".join(failed))
    return spark.createDataFrame(results, "TableName STRING, Rows BIGINT, Status STRING")


def i_render_connection(df: DataFrame, template_col: str, params_col: str) -> DataFrame:
    """Fill the parameters of a template; secret values are hidden."""
    return df.withColumn("rendered", fill_parameters(template_col, params_col))


# Members of a data lake linked service that a custom activity reads.
LAKE_MEMBERS = ("dataLakeStoreUri", "servicePrincipalId", "servicePrincipalKey", "tenant")


def i_pick_linked_service(
    resources: DataFrame, service_type: str, members: tuple[str, ...] = LAKE_MEMBERS
) -> DataFrame:
    """The last linked service of a type in each template, with some members; secret ones are hidden."""
    services = resources.filter(F.col("kind") == "linkedservices")
    rows = with_properties(services, "type STRING, typeProperties MAP<STRING, STRING>")
    values = [redact(F.lit(m), F.col("p.typeProperties")[m]).alias(m) for m in members]
    picked = (
        rows.filter(F.col("p.type") == service_type)
        .select("template_id", "part", "ordinal", cut_name("name").alias("LinkedServiceName"), *values)
        .groupBy("template_id")
        .agg(F.max_by(F.struct("LinkedServiceName", *members), F.struct("part", "ordinal")).alias("s"))
    )
    return picked.select("template_id", "s.*")


def i_log_lines(df: DataFrame, ts_col: str, msg_col: str) -> DataFrame:
    return df.withColumn("line", log_line(ts_col, msg_col))


def i_parse_log_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    return df.withColumns({"logged_at": log_line_time(line_col), "message": log_line_message(line_col)})
