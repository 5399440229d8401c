"""Run logs, catalogs and other operator inputs derived from the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.corpus import table

# The query range covers every event.
NOW = datetime(2025, 1, 1)
DAYS = 3660


def status_of(event_type: str | Column = "event_type") -> Column:
    e = F.col(event_type) if isinstance(event_type, str) else event_type
    return (
        F.when(e == "click", "InProgress")
        .when(e == "view", "Queued")
        .when(e.isin("purchase", "signup"), "Succeeded")
        .when(e == "error", "Failed")
    )


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        _text("pl_", "user_id").alias("pipeline_name"),
        status_of().alias("status"),
        F.col("ts").alias("last_updated"),
    )


def status_changes(events: DataFrame) -> DataFrame:
    """One run per user with many status changes; also for a streaming input."""
    return events.select(
        F.col("user_id").cast("string").alias("run_id"), status_of().alias("status"), _error_of().alias("error"), "ts"
    )


def user_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user with its latest status."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.max_by(status_of(), "ts").alias("status"), F.max("ts").alias("last_updated"))
        .select(
            F.col("user_id").cast("string").alias("run_id"),
            _text("pl_", "user_id").alias("pipeline_name"),
            "status",
            "last_updated",
        )
    )


def _error_of() -> Column:
    code = F.get_json_object("props", "$.k").cast("int")
    error = F.to_json(
        F.struct(
            F.when(code > 0, code.cast("string")).otherwise("").alias("errorCode"),
            F.lit("UserError").alias("failureType"),
            _text("event ", "event_id").alias("message"),
        )
    )
    return F.when(F.col("event_type") == "error", error)


def activity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        _text("act_", "event_id").alias("activity_name"),
        F.col("event_type").alias("activity_type"),
        _error_of().alias("error"),
        "ts",
    )


def execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = status_of()
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("LogId"),
        F.expr("event_id div 100").alias("LocalExecutionId"),
        (F.col("user_id") % 3 + 1).cast("int").alias("StageId"),
        F.col("user_id").alias("PipelineId"),
        _text("pl_", "user_id").alias("PipelineName"),
        F.col("ts").alias("StartDateTime"),
        status.alias("PipelineStatus"),
        F.when(~status.isin("InProgress", "Queued"), F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("EndDateTime"),
    )


def requested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(_text("pl_", "c_custkey").alias("pipeline_name"))


def order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SalesOrderID"),
        _text("SO", "o_orderkey").alias("SalesOrderNumber"),
        F.col("o_orderdate").alias("OrderDate"),
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"), F.col("l_linenumber").alias("SalesOrderDetailID")
    )


def factories(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.expr("c_custkey div 10")
    rows = table(spark, sf_dir, "customer").select(f.alias("DataFactoryId")).distinct()
    return rows.withColumn("DataFactoryName", _text("factory_", "DataFactoryId"))


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = (F.col("o_orderkey") % 7 + 1).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", stage.alias("StageId"), F.lit(True).alias("Enabled"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as database objects: user tables and foreign keys."""
    key = F.col("c_custkey")
    is_table = key % 2 == 0
    return table(spark, sf_dir, "customer").select(
        key.alias("object_id"),
        F.when(is_table, F.col("c_name")).otherwise(F.concat(F.lit("FK_"), "c_name", F.lit("_x"))).alias("name"),
        F.when(is_table, "U").otherwise("f").alias("type"),
        F.col("c_nationkey").alias("schema_id"),
    )


def schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("schema_id"), F.col("n_name").alias("name"))


def workspace_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and nations are directories, customers notebooks or libraries."""
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    none = F.lit(None).cast("string")
    region_path = F.concat(F.lit("/"), "r_name")
    nation_path = F.concat(F.lit("/"), "r_name", F.lit("/"), "n_name")
    located = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    library = F.col("c_custkey") % 10 == 0
    language = F.element_at(
        F.array(*[F.lit(x) for x in ("SCALA", "PYTHON", "SQL", "R")]), (F.col("c_custkey") % 4 + 1).cast("int")
    )
    leaves = customer.join(located, F.col("c_nationkey") == F.col("n_nationkey"))
    directory = F.lit("DIRECTORY")
    parts = (
        region.select(region_path, F.lit("/"), directory, none),
        located.select(nation_path, region_path, directory, none),
        leaves.select(
            F.concat(nation_path, F.lit("/"), "c_name"),
            nation_path,
            F.when(library, "LIBRARY").otherwise("NOTEBOOK"),
            F.when(~library, language),
        ),
    )
    first, *rest = (p.toDF("path", "parent", "object_type", "language") for p in parts)
    for part in rest:
        first = first.union(part)
    return first


def files_to_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.element_at(
        F.array(*[F.lit(x) for x in (".xlsx", ".txt", ".csv", ".a.b")]), (F.col("page_id") % 4 + 1).cast("int")
    )
    return table(spark, sf_dir, "pages").select(F.concat(_text("f_", "page_id"), ending).alias("name"))


# A text with placeholders of both forms, an unknown one, and one whose head is a known key.
CONNECTION = (
    "host=@{linkedService().ServerInstance} db=@{linkedService().DatabaseName} key=@{linkedService().SQLPassword}"
    " table=@dataset().DSTableName more=@dataset().DSTableNames note=@{linkedService().Note}"
    " other=@{linkedService().Unknown}"
)


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.create_map(
        F.lit("ServerInstance"), _text("srv", "c_nationkey"),
        F.lit("DatabaseName"), F.col("c_mktsegment"),
        F.lit("SQLPassword"), _text("p", "c_custkey"),
        F.lit("DSTable"), F.lit("wrong"),
        F.lit("Note"), F.concat(F.lit("@dataset().DSTable of "), F.col("c_mktsegment")),
        F.lit("DSTableName"), F.col("c_name"),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.lit(CONNECTION).alias("template"), params.alias("params"))


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _text("supplier_", "s_suppkey").alias("PropertyName"), F.col("s_name").alias("PropertyValue")
    )


def property_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_text("supplier_", "p_partkey").alias("PropertyName"))
