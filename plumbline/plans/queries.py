"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame. Each reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text as X
from plumbline.functions.registered import register_sql_functions
from plumbline.operators import checks as C
from plumbline.operators import graph as G
from plumbline.operators import ingest as I
from plumbline.operators import metadata as M
from plumbline.operators import notebooks as N
from plumbline.operators import runs as R
from plumbline.operators import templates as T
from plumbline.operators import workspace as W
from plumbline.plans import corpus
from plumbline.plans import fixtures as fx
from plumbline.plans.corpus import table
from plumbline.session import fresh_path
from plumbline.sources import catalog, files
from plumbline.streaming.autoscale import st_autoscale_target
from plumbline.streaming.landing import st_landing_ingest
from plumbline.streaming.run_status import run_updates, st_run_status
from plumbline.streaming.sink import latest_updates, write_updates

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "1995-06-19"
ARRIVAL = datetime(2020, 10, 20, 15, 30)
BUCKETS = 16
CUSTOMER_TEXT = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")

# A key of each table, summed to compare contents.
TABLE_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id",
    "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}

REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def register_as(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[name] = query
        return query

    return add


def _on_resources(operator: Callable[[DataFrame], DataFrame], name: str | None = None) -> None:
    REGISTRY[name or operator.__name__] = lambda spark, sf: operator(corpus.resources(spark, sf))


# Template documents, summaries, graph and checks ------------------------------------------------------------


def _named_documents(read: DataFrame) -> DataFrame:
    """Factory name and number of resources of each template."""
    name = F.get_json_object("template", "$.parameters.factoryName.defaultValue")
    resources = F.from_json("template", T.RESOURCES_DDL)["resources"]
    rows = read.select(F.col("template_id").cast("bigint").alias("template_id"), name.alias("name"), F.size(resources).cast("bigint").alias("n"))
    return rows.groupBy("template_id").agg(F.max("name").alias("factory_name"), F.sum("n").alias("resources"))


@register
def read_templates(spark, sf):
    """Documents written as files of their own and read back whole."""
    path = fresh_path(spark, "documents")
    tasks = files.write_documents(corpus.templates(spark, sf), path, "template_id", "template")
    # Spark counts a small file as 4 MB, so small splits would make a task for every few documents.
    read = files.read_templates(spark, path).coalesce(max(tasks, 4 * spark.sparkContext.defaultParallelism))
    number = F.regexp_extract("template_id", "template_id=(-?[0-9]+)", 1)
    return _named_documents(read.withColumn("template_id", F.nullif(number, F.lit(""))))  # no number: no key


@register
def read_template_lines(spark, sf):
    """Documents written as lines, many to a file, and read back."""
    path = fresh_path(spark, "documents")
    corpus.templates(spark, sf).select("template_id", "template").write.option("compression", "lz4").json(path)
    return _named_documents(files.read_template_lines(spark, path))


@register
def shred_resources(spark, sf):
    rows = T.shred_resources(corpus.templates(spark, sf))
    return rows.select(
        "template_id",
        "name",
        "type",
        F.col("apiVersion").cast("string").alias("apiVersion"),
        F.array_join(F.array_sort("dependsOn"), ";").alias("dependsOn"),
    )


@register
def shred_activities(spark, sf):
    depends_on = F.transform(
        "dependsOn", lambda d: F.concat(d["activity"], F.lit(":"), F.array_join(d["dependencyConditions"], "+"))
    )
    return T.shred_activities(T.shred_resources(corpus.templates(spark, sf))).select(
        "template_id",
        "PipelineName",
        "position",
        "name",
        "type",
        "description",
        F.array_join(F.array_sort(depends_on), ";").alias("dependsOn"),
        F.col("policy.timeout").alias("timeout"),
        F.col("typeProperties.isSequential").alias("isSequential"),
        F.col("typeProperties.batchCount").alias("batchCount"),
    )


@register
def resources_of_type(spark, sf):
    rows = T.resources_of_type(corpus.resources(spark, sf), "Triggers", "DATAFLOWS")
    return rows.select("template_id", "type", X.clean_name("name").alias("name"))


@register
def t_factory_name(spark, sf):
    return T.t_factory_name(corpus.templates(spark, sf))


@register
def t_component_summary(spark, sf):
    return T.t_component_summary(corpus.resources(spark, sf), corpus.templates(spark, sf))


for _operator in (
    T.t_pipeline_info,
    T.t_activity_info,
    T.t_linked_service_info,
    T.t_dataset_info,
    T.t_integration_runtime_info,
    T.t_dataflow_info,
    T.t_trigger_info,
    G.g_resources,
    G.g_dependants,
    G.redundant_resources,
    C.c_details,
    C.c_summary,
    *(getattr(C, f"c{_number:02d}") for _number in C.ALL),
):
    _on_resources(_operator)
_on_resources(lambda r: C.c_summary(r, as_written=True), "c_summary_as_written")
_on_resources(lambda r: C.c_totals(C.c_summary(r)), "c_totals")


_on_resources(lambda r: C.c_details(r, {1}, indirect=True), "c01_indirect")


@register
def c_summary_from_documents(spark, sf):
    """The whole checker from JSON documents, without the shredded table in between."""
    return C.c_summary(T.shred_resources(corpus.templates(spark, sf)))


@register
def c_severity_totals(spark, sf):
    """Issues by severity over all templates, in rising order of severity."""
    summary = C.c_summary(corpus.resources(spark, sf))
    totals = summary.groupBy("Severity").agg(F.sum("IssueCount").alias("IssueCount"))
    return totals.withColumn("Rank", X.severity_rank("Severity")).orderBy("Rank")


@register
def workspace_tree(spark, sf):
    return W.workspace_tree(fx.workspace_items(spark, sf))


@register
def export_manifest(spark, sf):
    return W.export_manifest(W.workspace_tree(fx.workspace_items(spark, sf)), "/export")


# Run log ----------------------------------------------------------------------------------------------------


@register
def r_latest_run(spark, sf):
    return R.r_latest_run(fx.pipeline_runs(spark, sf), fx.requested_names(spark, sf), fx.NOW, fx.DAYS)


@register
def r_status_by_run_id(spark, sf):
    key = F.col("o_orderkey").cast("string")
    requests = table(spark, sf, "orders").select(
        F.concat(F.lit("order_"), key).alias("pipeline_name"), key.alias("run_id")
    )
    return R.r_status_by_run_id(fx.pipeline_runs(spark, sf), requests)


@register
def r_terminal_runs(spark, sf):
    return R.r_terminal_runs(fx.user_runs(spark, sf), fx.activity_runs(spark, sf))


@register
def r_activity_errors(spark, sf):
    return R.r_activity_errors(fx.user_runs(spark, sf), fx.activity_runs(spark, sf), fx.NOW, fx.DAYS)


@register
def r_activity_error_counts(spark, sf):
    return R.r_activity_error_counts(fx.user_runs(spark, sf), fx.activity_runs(spark, sf), fx.NOW, fx.DAYS)


@register
def r_activity_error_rows(spark, sf):
    return R.r_activity_error_rows(fx.activity_runs(spark, sf), fx.NOW, fx.DAYS)


@register
def r_running_gate(spark, sf):
    runs, names = fx.pipeline_runs(spark, sf), fx.requested_names(spark, sf)
    latest = R.r_latest_run(runs, names, fx.NOW, fx.DAYS)
    requests = latest.select(F.col("PipelineName").alias("pipeline_name"), F.col("RunIdUsed").alias("this_run_id"))
    known = runs.select("pipeline_name").distinct()
    return R.r_running_gate(runs, requests, fx.NOW, fx.DAYS, known=known)


@register
def r_last_execution(spark, sf):
    return R.r_last_execution(fx.execution_log(spark, sf))


@register
def r_property_lookup(spark, sf):
    return R.r_property_lookup(fx.properties(spark, sf), fx.property_requests(spark, sf))


@register
def r_current_execution_counts(spark, sf):
    return R.r_current_execution_counts(fx.execution_log(spark, sf))


# Notebook queries -------------------------------------------------------------------------------------------


@register
def n_order_line_count(spark, sf):
    return N.n_order_line_count(fx.order_header(spark, sf), fx.order_detail(spark, sf), RUN_DATE)


@register
def n_order_line_count_sql(spark, sf):
    return N.n_order_line_count_sql(fx.order_header(spark, sf), fx.order_detail(spark, sf), RUN_DATE)


@register
def n_order_line_count_bucketed(spark, sf):
    """The same over tables that are bucketed by order, so that the join needs no exchange."""
    header, detail = (
        catalog.publish_table(df, f"{name}_{uuid.uuid4().hex}", fresh_path(spark, name), bucket_by="SalesOrderID", buckets=BUCKETS)
        for name, df in (("header", fx.order_header(spark, sf)), ("detail", fx.order_detail(spark, sf)))
    )
    return N.n_order_line_count(header, detail, RUN_DATE)


@register
def n_word_count(spark, sf):
    return N.n_word_count(table(spark, sf, "documents"), "text")


@register
def n_word_count_repeated(spark, sf):
    return N.n_word_count_repeated(N.n_word_count(table(spark, sf, "documents"), "text"))


# Sources and sinks ------------------------------------------------------------------------------------------


def _written_csv(spark, sf, folder: str, *columns: str) -> str:
    """Customers as CSV with a header line, in a fresh folder."""
    path = f"{fresh_path(spark, 'csv')}/{folder}"
    table(spark, sf, "customer").select(*columns).write.option("header", True).csv(path)
    return path


def _written_pages(spark, sf) -> str:
    """Pages as text files in four folders."""
    path = fresh_path(spark, "pages")
    pages = table(spark, sf, "pages").select((F.col("page_id") % 4).alias("folder"), "html")
    pages.write.partitionBy("folder").text(path)
    return path


@register
def read_text_lines(spark, sf):
    path = fresh_path(spark, "lines")
    table(spark, sf, "documents").select("text").write.text(path)
    return files.read_text_lines(spark, path)


@register
def read_csv_inferred(spark, sf):
    read = files.read_csv_inferred(spark, _written_csv(spark, sf, "customer.csv", *CUSTOMER_TEXT, "c_acctbal"))
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def _written_documents(spark, sf) -> str:
    path = fresh_path(spark, "documents-csv")
    files.write_csv_quoted(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return path


@register
def read_csv_multiline(spark, sf):
    return files.read_csv_multiline(spark, _written_documents(spark, sf), "doc_id BIGINT, text STRING, lang STRING")


@register
def i_clean_csv(spark, sf):
    schema = "doc_id BIGINT, text STRING, lang STRING"
    return I.i_clean_csv(files.read_csv_multiline(spark, _written_documents(spark, sf), schema))


@register
def write_parquet_roundtrip(spark, sf):
    counts = N.n_word_count(table(spark, sf, "documents"), "text")
    return files.write_parquet_roundtrip(counts, fresh_path(spark, "words"))


@register
def publish_table(spark, sf):
    name = f"orders_{uuid.uuid4().hex}"
    return catalog.publish_table(table(spark, sf, "orders"), name, fresh_path(spark, "table"))


@register
def write_csv_quoted(spark, sf):
    path = fresh_path(spark, "quoted")
    files.write_csv_quoted(table(spark, sf, "customer").select(*CUSTOMER_TEXT), path)
    lines = files.read_text_lines(spark, path)
    return lines.filter(~F.startswith("value", F.lit('"c_custkey"')))


@register
def binary_ingest(spark, sf):
    """Bytes of each source folder after the copy."""
    landed = files.binary_ingest(spark, _written_pages(spark, sf), fresh_path(spark, "binary"), ARRIVAL, "*.txt")
    return landed.groupBy(
        F.regexp_extract("path", "folder=([0-9]+)", 1).cast("bigint").alias("folder"), "Year", "Month", "Day", "Hour"
    ).agg(F.sum(F.length("content")).cast("bigint").alias("bytes"))


@register
def list_files(spark, sf):
    """Bytes listed for each folder."""
    listed = files.list_files(spark, _written_pages(spark, sf), "*.txt")
    folder = F.regexp_extract("path", "folder=([0-9]+)", 1).cast("bigint")
    return listed.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"))


@register
def land_partitioned(spark, sf):
    path = fresh_path(spark, "landing")
    files.land_by_column(table(spark, sf, "events"), path, "ts")
    return spark.read.parquet(path).select("event_id", "ts", "Year", "Month", "Day", "Hour")


@register
def temp_view_sql(spark, sf):
    view = f"documents_{uuid.uuid4().hex}"
    sql = f"SELECT lang, count(*) AS documents, sum(n_chars) AS chars FROM {view} WHERE n_chars >= :low GROUP BY lang"
    return catalog.temp_view_sql(table(spark, sf, "documents"), view, sql, low=500)


@register
def append_log_entries(spark, sf):
    """Events as formatted log lines, appended to a log folder twice and read back."""
    path = fresh_path(spark, "log")
    events = table(spark, sf, "events")
    for kind, wanted in (("start", F.col("event_type") == "error"), ("end", F.col("event_type") != "error")):
        message = F.concat(F.lit(f"{kind} "), F.col("event_id").cast("string"))
        files.append_log_entries(events.filter(wanted).select("ts", message.alias("message")), path, "ts", "message")
    return files.read_text_lines(spark, path)


@register
def table_list(spark, sf):
    return catalog.table_list(fx.objects(spark, sf), fx.schemas(spark, sf), "nation_2")


# Ingestion --------------------------------------------------------------------------------------------------


@register
def i_landing_path(spark, sf):
    return I.i_landing_path(table(spark, sf, "events").select("event_id", "ts"), "ts")


@register
def i_route_files(spark, sf):
    return I.i_route_files(fx.files_to_route(spark, sf), ARRIVAL)


@register
def i_txt_to_csv(spark, sf):
    source = _written_csv(spark, sf, "customer.txt", *CUSTOMER_TEXT)
    target = fresh_path(spark, "converted")
    I.i_txt_to_csv(spark, source, target)
    lines = files.read_text_lines(spark, target)
    return lines.filter(~F.startswith("value", F.lit('"c_custkey"')))


@register
def i_csv_to_table(spark, sf):
    source = _written_csv(spark, sf, f"customer {uuid.uuid4().hex}.csv", *CUSTOMER_TEXT)
    root = fresh_path(spark, "consume")
    rows = I.i_csv_to_table(spark, source, root, table_path=f"{root}/table")
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@register
def i_copy_table(spark, sf):
    target = files.ParquetTables(spark, fresh_path(spark, "copy"))
    I.i_copy_table(files.ParquetTables(spark, sf, ".parquet"), target, "lineitem")
    return target.read("lineitem")


@register
def i_copy_all_tables(spark, sf):
    """Outcome of each copy, with the sum of a key of what arrived."""
    names = files.list_tables(spark, sf, ".parquet")
    source, target = files.ParquetTables(spark, sf, ".parquet"), files.ParquetTables(spark, fresh_path(spark, "copies"))
    outcomes = I.i_copy_all_tables(spark, source, target, names, strict=True)
    sums = [
        target.read(name).agg(F.lit(name).alias("TableName"), F.sum(key).cast("bigint").alias("KeySum"))
        for name, key in TABLE_KEYS.items()
    ]
    return outcomes.join(reduce(DataFrame.unionByName, sums), "TableName")


@register
def i_render_connection(spark, sf):
    rendered = I.i_render_connection(fx.connections(spark, sf), "template", "params")
    return rendered.select("c_custkey", "rendered")


@register
def i_pick_linked_service(spark, sf):
    """From documents, since members that are objects come out as they were written."""
    return I.i_pick_linked_service(T.shred_resources(corpus.templates(spark, sf)), "AzureBlobFS", ("url", "connectionString"))


@register
def i_log_lines(spark, sf):
    lines = I.i_log_lines(table(spark, sf, "events").select("event_id", "ts", "props"), "ts", "props")
    parsed = I.i_parse_log_lines(lines)
    return parsed.select("event_id", "line", F.col("logged_at").cast("timestamp_ntz").alias("logged_at"), "message")


# Metadata tables --------------------------------------------------------------------------------------------


@register
def rename_factory(spark, sf):
    return M.rename_factory(fx.factories(spark, sf), "factory_renamed")


@register
def disable_stages(spark, sf):
    return M.disable_stages(fx.stages(spark, sf), 3)


@register
def replace_stages(spark, sf):
    """Stages disabled in place: only the partitions of the later stages are written again."""
    path = fresh_path(spark, "stages")
    fx.stages(spark, sf).write.partitionBy("StageId").parquet(path)
    files.replace_partitions(spark, path, F.col("StageId") > 3, lambda rows: M.disable_stages(rows, 3), "StageId")
    return spark.read.parquet(path).select("o_orderkey", "StageId", "Enabled")


@register
def generate_workers(spark, sf):
    return M.generate_workers(table(spark, sf, "orders"), "o_orderkey", fx.factories(spark, sf), "factory_7")


@register
def drop_fk_statements(spark, sf):
    return M.drop_fk_statements(fx.objects(spark, sf))


@register
def select_star(spark, sf):
    view = f"execution_log_{uuid.uuid4().hex}"
    fx.execution_log(spark, sf).createOrReplaceTempView(view)
    return catalog.select_star(spark, view)


# Streaming --------------------------------------------------------------------------------------------------


def _event_stream(spark, sf, batches: int = 3, files_: int = 8) -> DataFrame:
    """Events that arrive in the order of time, in ranges of ``files_`` files, a range per micro-batch."""
    path, events = fresh_path(spark, "arrivals"), table(spark, sf, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    bounds = [low + (high - low) * k / batches for k in range(1, batches)]
    for k in range(batches):
        part = events if k == 0 else events.filter(F.col("ts") >= F.lit(bounds[k - 1]))
        part = part if k == batches - 1 else part.filter(F.col("ts") < F.lit(bounds[k]))
        part.repartition(files_).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_).parquet(path)


def _streamed(spark, stream: DataFrame, fold=None) -> DataFrame:
    path = fresh_path(spark, "stream")
    write_updates(stream, f"{path}/out", f"{path}/checkpoint", fold=fold).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _plain_times(df: DataFrame) -> DataFrame:
    times = {f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in times else c for c in df.columns])


def _samples(events: DataFrame) -> DataFrame:
    return events.select("ts", F.col("value").alias("pending"))


@register_as("st_autoscale_target")
def autoscale_stream(spark, sf):
    stream = st_autoscale_target(_samples(_event_stream(spark, sf)), 300, "1 hour")
    out = _plain_times(latest_updates(_streamed(spark, stream), ["window_start"]))
    return out.withColumn("target", F.round("target", 6))


@register_as("st_autoscale_target_batch")
def autoscale_batch(spark, sf):
    out = st_autoscale_target(_samples(table(spark, sf, "events")), 300, "1 hour", slide="30 minutes")
    return _plain_times(out).withColumn("target", F.round("target", 6))


@register_as("st_run_status_batch")
def run_status_batch(spark, sf):
    return _plain_times(st_run_status(run_updates(fx.status_changes(table(spark, sf, "events")))))


@register_as("st_run_status")
def run_status_stream(spark, sf):
    return _plain_times(st_run_status(_streamed(spark, fx.status_changes(_event_stream(spark, sf)), run_updates)))


@register_as("st_landing_ingest")
def landing_stream(spark, sf):
    """Customers arriving as a CSV, landed and published as a table."""
    name = f"customer_{uuid.uuid4().hex}"
    source = _written_csv(spark, sf, f"arrivals/{name}.csv", *CUSTOMER_TEXT).rsplit("/", 1)[0]
    path = fresh_path(spark, "ingest")
    schema = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING"
    st_landing_ingest(spark, source, path, f"{path}/checkpoint", schema, publish=True).awaitTermination()
    return spark.table(name).select(*CUSTOMER_TEXT)


# Scalar functions -------------------------------------------------------------------------------------------


@register
def scalar_functions(spark, sf):
    orders = table(spark, sf, "orders")
    key, status, priority, date = (F.col(c) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"))
    text = key.cast("string")
    raw = F.concat(F.lit("[concat(parameters('factoryName'), '/"), F.repeat(text, F.lit(11)), F.lit("')]"))
    path = F.concat(F.lit("/Landing/a b/"), priority, F.lit(" x.y."), status)
    params = F.create_map(F.lit("Key"), text, F.lit("Name"), priority)
    error = X.parse_error(
        F.when(key % 2 == 0, F.concat(F.lit('{"errorCode":"'), text, F.lit('","message":"m"}'))).otherwise("not json")
    )
    return orders.select(
        key,
        X.first_upper(F.lower(priority)).alias("f01_first_upper"),
        X.replace_ci(priority, "lo", "$1").alias("f02_replace"),
        X.cut_name(raw).alias("f03_cut_name"),
        X.clean_name(raw).alias("f04_clean_name"),
        X.clean_type(path).alias("f05_clean_type"),
        X.key_name(F.concat(status, F.lit("|"), text, F.lit("|z"))).alias("f06_key_name"),
        F.size(X.words(F.concat(priority, F.lit("  x ")))).alias("f07_words"),
        X.first_dot_extension(F.concat(text, F.lit(".a."), status)).alias("f08_extension"),
        X.dataset_name(path).alias("f09_dataset_name"),
        F.format_string("%s@{%s}", status, text).alias("f10_interpolate"),
        (F.length(F.lower(priority)) + 1).alias("f11_length"),
        X.landing_folder(date + F.make_dt_interval(F.lit(0), (key % 24).cast("int"))).alias("f12_landing"),
        X.landing_folder(date + F.make_dt_interval(F.lit(0), (key % 24).cast("int")), True).alias("f12_landing_24"),
        X.add_days(date, -7).alias("f13_add_days"),
        X.run_date(F.when(key % 3 == 0, "").otherwise(F.date_format(date, "yyyy-MM-dd")), "timestamp_ntz").alias("f14_run_date"),
        F.to_date(F.date_format(date, "yyyy-MM-dd")).cast("string").alias("f15_cast"),
        F.coalesce(F.when(key % 2 == 0, status), priority).alias("f16_fallback"),
        X.log_line(date, status).alias("f17_log_line"),
        F.length(X.two_digits(key, 1)).alias("f18_digits"),
        F.to_json(F.struct(text.alias("PipelineName"), F.concat(priority, F.lit('"')).alias("Status"))).alias("f19_json"),
        X.fk_table(F.when(key % 2 == 0, F.concat(F.lit("FK_"), text, F.lit("_b_c"))).otherwise("FK_none")).alias("f20_fk_table"),
        X.fill_parameters(F.lit("@{linkedService().Key}/@dataset().Name/@{linkedService().No}"), params).alias("f21_fill"),
        X.language_extension(F.when(status == "F", "python").when(status == "O", "SQL").otherwise("perl")).alias("f22_extension"),
        error["errorCode"].alias("f23_error_code"),
        error["message"].alias("f23_message"),
        X.severity_rank(F.when(status == "F", "High").when(status == "O", "low").otherwise("none")).alias("f24_rank"),
    )


@register
def sql_functions(spark, sf):
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT o_orderkey,
               clean_name(concat("[concat(variables('factoryId'), '/pipelines/pl_", o_orderkey, "')]")) AS name,
               clean_type(concat('a/b/', o_orderpriority)) AS type,
               CAST(run_date(nullif(date_format(o_orderdate, 'yyyy-MM-dd'), :run_date)) AS TIMESTAMP_NTZ) AS run_date
        FROM {orders}
        """,
        args={"run_date": RUN_DATE},
        orders=table(spark, sf, "orders"),
    )
