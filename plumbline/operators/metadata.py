"""Metadata tables: changes, worker generation and generated statements.

Files are immutable here, so a change is a new DataFrame to be written elsewhere, never over the path it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import fk_table
from plumbline.session import fresh_path


def rename_factory(factories: DataFrame, name: str) -> DataFrame:
    return factories.withColumn("DataFactoryName", F.lit(name))


def disable_stages(stages: DataFrame, above: int = 3) -> DataFrame:
    enabled = F.when(F.col("StageId") > above, F.lit(False)).otherwise(F.col("Enabled"))
    return stages.withColumn("Enabled", enabled)


def _stage(number: Column) -> Column:
    return F.when(number <= 100, 1).when(number <= 200, 2).when(number <= 300, 3)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Add ``n``, from 1 in the order of some columns: ranges of rows are numbered side by side.

    The rows are written once, so that a repeated task can't number them otherwise. Only one count per task meets in
    the window.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    path = fresh_path(spark, "numbered")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    n = F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part").cast("bigint"), 33) + 1
    return dealt.join(starts, "_part").select(*df.columns, n.alias("n"))


def generate_workers(rows: DataFrame, key: str, factories: DataFrame, factory_name: str) -> DataFrame:
    """An enabled worker of one factory per row, numbered by ``key``, in stages of 100; from 301 on the stage is null.

    More than one factory of the name fails, as a scalar subquery does.
    """
    factory = factories.filter(F.col("DataFactoryName") == factory_name).select("DataFactoryId").scalar()
    number = F.col("n")
    return numbered(rows.select(key), key).select(
        number.alias("PipelineId"),
        factory.alias("DataFactoryId"),
        _stage(number).alias("StageId"),
        F.concat(F.lit("Wait "), number.cast("string")).alias("PipelineName"),
        F.lit(None).cast("int").alias("LogicalPredecessorId"),
        F.lit(True).alias("Enabled"),
    )


def drop_fk_statements(objects: DataFrame, schema: str = "SalesLT") -> DataFrame:
    """Statement text per foreign key of a schema; it is returned, never executed."""
    name = F.col("name")
    statement = F.concat(F.lit(f"ALTER TABLE {schema}."), fk_table(name), F.lit(" DROP CONSTRAINT "), name)
    return objects.filter(F.lower(F.trim("type")) == "f").select(statement.alias("Statement"))
