"""Tables and views of the session catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A table name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def publish_table(
    df: DataFrame, name: str, path: str | None = None, schema: str | None = None, bucket_by: str | None = None, buckets: int = 200
) -> DataFrame:
    """Drop and recreate a table; returns it. ``path`` keeps its files in a folder of the caller's choice.

    The table stands in the current schema, or in ``schema``, which is made if it is missing. With ``bucket_by`` its rows
    are dealt to buckets by that column and sorted in them: tables with equal buckets join on it without an exchange, and
    grouping by it needs none. Rows are dealt by the same hash before they are written, so a bucket is one file.
    """
    spark, full = df.sparkSession, quoted(name)
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")
        full = f"{quoted(schema)}.{full}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    writer = df.write.mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(full)
    return spark.table(full)


def publish_folder(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Drop and recreate a table over a partitioned Parquet folder, in place; returns it."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.catalog.createTable(quoted(name), path, "parquet")
    spark.catalog.recoverPartitions(quoted(name))
    return spark.table(quoted(name))


def temp_view_sql(df: DataFrame, view: str, sql: str, **args: object) -> DataFrame:
    """Register a view and query it; ``args`` fill named parameters of the statement."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql, args=args)


def table_list(objects: DataFrame, schemas: DataFrame, schema: str | Column) -> DataFrame:
    """User tables as ``schema.table``; ``schema`` is a name or a condition on the schema's columns."""
    wanted = F.lower("schema_name") == schema.lower() if isinstance(schema, str) else schema
    s = schemas.select("schema_id", F.col("name").alias("schema_name")).filter(wanted)
    tables = objects.filter(F.upper(F.trim("type")) == "U")
    return tables.join(s, "schema_id").select(F.concat_ws(".", "schema_name", "name").alias("TableName"))


def select_star(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
