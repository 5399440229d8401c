"""Template corpus derived from the star-schema tables.

Each customer bucket ``o_custkey // 10`` is one template. Orders become pipelines, their line items the nested
activities, customers linked services, parts datasets, sign-up events triggers, suppliers data flows and nations
integration runtimes. The rows are written to JSON documents and the operators shred them again, while the SQL
oracle computes from the base tables.

A pipeline holds a range of line numbers of its order, and a document a range of keys of its template, with parts that
rise with the key. Both follow from the row alone, so no size is measured and a group holds no more than the distinct
keys of its range. Rows are dealt to a number of tasks that rises with theirs, so what a task sorts and gathers stays in
memory and nothing is spilled. Documents and shredded resources are written once per application and input folder, each
when it is first read, to the shared scratch folder and read from there, so an executor lost later costs no rebuild.
"""

from __future__ import annotations

import math
import threading
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.constants import TYPE_PREFIX
from plumbline.operators.templates import shred_resources, store_resources
from plumbline.session import SMALL_TASKS, fresh_path, settings

# Line numbers per pipeline, and keys per document.
LINES = 1000
KEYS = 1 << 20
# Least number of consecutive order keys per block when the previous order of a template is looked up.
KEY_BLOCK = 4096
# Rows a task gathers on average: orders, orders with line items, and resources.
ORDER_ROWS = 1 << 17
LINE_ROWS = 1 << 16
RESOURCE_ROWS = 1 << 15
# A task that deals written rows to others holds what it reads, which is about thirty times as much as in the file.
ROW_TASKS = {"spark.sql.files.maxPartitionBytes": "2m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Absent members are null and left out by to_json; this one is present and empty.
_EMPTY = "CAST(array() AS ARRAY<STRING>)"


def _resource(kind: str, name: str, depends_on: str, properties: str) -> str:
    """JSON text of a resource; the arguments are SQL expressions."""
    return f"""to_json(named_struct(
        'name', concat("[concat(parameters('factoryName'), '/", {name}, "')]"),
        'type', '{TYPE_PREFIX}{kind}',
        'apiVersion', '2018-06-01',
        'dependsOn', transform({depends_on}, d -> concat("[concat(variables('factoryId'), '/", d, "')]")),
        'properties', {properties}), map('ignoreNullFields', 'true'))"""


def _rows(df: DataFrame, template_id: str, seq: int, key: str, resource: str) -> DataFrame:
    return df.selectExpr(
        f"CAST({template_id} AS BIGINT) AS template_id",
        f"{seq} AS seq",
        f"CAST({key} AS BIGINT) AS key",
        f"{resource} AS resource",
    )


def _dealt(rows: DataFrame, n: int, per_task: int, *keys: str) -> DataFrame:
    """``n`` rows dealt by ``keys`` to tasks of ``per_task`` on average, however many the session asks for."""
    return rows.repartition(-(-n // per_task) or 1, *keys)


def _previous_key(rows: DataFrame, group: str, key: str) -> DataFrame:
    """``previous``: the next lower ``key`` of the same group.

    A plain ``lag`` over the group would sort a hot group in one task. Keys are cut into blocks: inside a block a
    window finds the neighbour, and the first key of a block takes the largest key of the block before it. Blocks are
    about as wide as there are blocks, so neither window sees more than the square root of the largest key.
    """
    largest, n = rows.agg(F.max(key), F.count("*")).first()
    width = max(KEY_BLOCK, math.isqrt(largest or 0))
    blocks = _dealt(rows.withColumn("block", F.expr(f"{key} div {width}")), n, ORDER_ROWS, group, "block")
    last = blocks.groupBy(group, "block").agg(F.max(key).alias("last"))
    before = last.select(
        group, "block", F.lag("last").over(Window.partitionBy(group).orderBy("block")).alias("before")
    )
    inside = blocks.withColumn("inside", F.lag(key).over(Window.partitionBy(group, "block").orderBy(key)))
    return (
        inside.join(before, [group, "block"], "left")
        .withColumn("previous", F.coalesce("inside", "before"))
        .drop("block", "inside", "before")
    )


# The activity of a line item numbered ``rn`` inside its order and block.
_ACTIVITY = """named_struct(
    'name', concat('a', rn),
    'type', CASE WHEN l_linestatus = 'O' AND l_quantity <= 25 THEN 'ForEach' WHEN l_linestatus = 'O' THEN 'Copy'
                 ELSE 'Lookup' END,
    'description', CASE WHEN l_discount <> 0 THEN concat('part ', l_partkey) END,
    'dependsOn', array_compact(array(
        CASE WHEN rn > 1 THEN named_struct('activity', concat('a', rn - 1), 'dependencyConditions',
            array(CASE WHEN l_returnflag = 'R' THEN 'Failed' ELSE 'Succeeded' END)) END,
        CASE WHEN rn > 2 AND l_linestatus = 'O' THEN named_struct('activity', concat('a', rn - 2),
            'dependencyConditions', array('Failed')) END)),
    'policy', CASE l_returnflag WHEN 'R' THEN named_struct('timeout', '7.00:00:00')
                                WHEN 'A' THEN named_struct('timeout', '0.12:00:00') END,
    'typeProperties', named_struct(
        'isSequential', CASE WHEN l_tax = 0 THEN true END,
        'batchCount', CASE WHEN l_quantity % 2 = 0 THEN CAST(l_quantity * 4 AS INT) END))"""

_PIPELINE = """named_struct(
    'description', CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN ''
                        ELSE concat('Order ', o_orderkey) END,
    'folder', CASE WHEN o_orderpriority <> '5-LOW' THEN named_struct('name', o_orderpriority) END,
    'annotations', CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN array() ELSE array(o_orderstatus) END,
    'activities', transform(items, i -> i.activity))"""


def _gathered(lines: DataFrame) -> DataFrame:
    """Activities and data sets of each (order, block); rows without ``is_line`` are the orders themselves."""
    numbered = lines.selectExpr(
        "*",
        """row_number() OVER (PARTITION BY o_orderkey, block ORDER BY l_linenumber NULLS LAST, l_partkey NULLS LAST,
                                                                  l_suppkey NULLS LAST, l_extendedprice NULLS LAST) AS rn""",
    )
    return numbered.groupBy("o_orderkey", "block").agg(
        F.expr(f"sort_array(collect_list(CASE WHEN is_line THEN struct(rn, {_ACTIVITY} AS activity) END)) AS items"),
        F.expr("sort_array(collect_set(CASE WHEN l_quantity = 50 THEN l_partkey % 14 END)) AS datasets"),
        F.expr("first(o, true) AS o"),
    )


def pipeline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline for each order, and one more for every further block of ``LINES`` line numbers it has.

    Orders and the line items of block 0 are put under each other before the numbering, so that a single shuffle on
    (order, block) serves the numbering, the gathering of the activities and the meeting with the order. Further
    blocks, a filter on the scan, meet the order in a join.
    """
    lines = table(spark, sf_dir, "lineitem").drop("l_shipdate").withColumnRenamed("l_orderkey", "o_orderkey")
    lines = lines.selectExpr("*", f"greatest(0L, coalesce(l_linenumber, 0) div {LINES}) AS block", "true AS is_line")
    later = F.coalesce(F.col("l_linenumber") >= LINES, F.lit(False))

    orders = table(spark, sf_dir, "orders").drop("o_orderdate").withColumn("f", F.expr("o_custkey div 10"))
    n = lines.count() + orders.count()
    orders = _previous_key(orders, "f", "o_orderkey")
    orders = orders.selectExpr(
        "o_orderkey", "0L AS block", "struct(f, previous, o_orderstatus, o_totalprice, o_orderpriority) AS o"
    )
    together = lines.filter(~later).unionByName(orders, allowMissingColumns=True)
    first = _gathered(_dealt(together, n, LINE_ROWS, "o_orderkey", "block"))
    # The row number is of the line item alone: the order's own row comes last in its block.
    missing = F.lit(None).cast(orders.schema["o"].dataType).alias("o")
    more = _gathered(lines.filter(later).select("*", missing)).drop("o").join(orders.drop("block"), "o_orderkey")
    pipelines = first.unionByName(more).select("o_orderkey", "block", "items", "datasets", "o.*").filter("f IS NOT NULL")
    name = "concat('pl_', o_orderkey, CASE WHEN block = 0 THEN '' ELSE concat('_', block) END)"
    depends_on = f"""concat(
        transform(datasets, d -> concat('datasets/ds_', f * 14 + d)),
        CASE WHEN o_totalprice > 400000 AND previous IS NOT NULL THEN array(concat('pipelines/pl_', previous)) ELSE {_EMPTY} END)"""
    return _rows(pipelines, "f", 0, "o_orderkey", _resource("pipelines", name, depends_on, _PIPELINE))


def linked_service_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def resource(connection: str) -> str:
        properties = f"""named_struct(
            'type', CASE c_mktsegment WHEN 'BUILDING' THEN 'AzureKeyVault' WHEN 'AUTOMOBILE' THEN 'AzureSqlDatabase'
                                      ELSE 'AzureBlobFS' END,
            'description', CASE WHEN c_acctbal >= 0 THEN 'ok' END,
            'annotations', CASE WHEN c_custkey % 4 = 0 THEN array() ELSE array(c_mktsegment) END,
            'typeProperties', named_struct('connectionString', {connection},
                                           'url', CASE WHEN c_custkey % 2 = 0 THEN 'u' END))"""
        return _resource("linkedServices", "concat('ls_', c_custkey)", _EMPTY, properties)

    # The member is an object or a text, so the two shapes are serialised apart.
    secret = "named_struct('type', 'AzureKeyVaultSecret', 'secretName', 's')"
    either = f"""CASE WHEN c_custkey % 3 = 0 THEN {resource(secret)} ELSE {resource("'x'")} END"""
    return _rows(table(spark, sf_dir, "customer"), "c_custkey div 10", 1, "c_custkey", either)


def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = "concat('ls_', p_partkey div 14 * 10 + p_partkey % 10) AS service"
    parts = table(spark, sf_dir, "part").selectExpr("*", service)
    properties = """named_struct(
        'type', p_type,
        'description', CASE WHEN p_size % 2 <> 0 THEN p_name END,
        'annotations', CASE WHEN p_size % 3 = 0 THEN array() ELSE array(p_brand) END,
        'folder', CASE WHEN p_size >= 10 THEN named_struct('name', p_brand) END,
        'linkedServiceName', named_struct('referenceName', service))"""
    depends_on = "array(concat('linkedServices/', service))"
    resource = _resource("datasets", "concat('ds_', p_partkey)", depends_on, properties)
    return _rows(parts, "p_partkey div 14", 2, "p_partkey", resource)


def trigger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter("event_type = 'signup'")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS event_id", "o_custkey")
    orders = _dealt(orders, orders.count(), ORDER_ROWS, "event_id")
    properties = """named_struct(
        'type', CASE WHEN value < 50 THEN 'ScheduleTrigger' ELSE 'TumblingWindowTrigger' END,
        'runtimeState', CASE WHEN user_id % 2 = 0 THEN 'Started' ELSE 'Stopped' END,
        'description', CASE WHEN user_id % 3 <> 0 THEN event_type END,
        'annotations', CASE WHEN user_id % 5 = 0 THEN array() ELSE array(event_type) END)"""
    depends_on = f"CASE WHEN value <= 100 THEN array(concat('pipelines/pl_', event_id)) ELSE {_EMPTY} END"
    resource = _resource("triggers", "concat('tr_', event_id)", depends_on, properties)
    return _rows(events.join(orders, "event_id"), "o_custkey div 10", 3, "event_id", resource)


def dataflow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    properties = """named_struct(
        'type', 'MappingDataFlow',
        'description', CASE WHEN s_nationkey % 2 <> 0 THEN s_name END)"""
    resource = _resource("dataflows", "concat('df_', s_suppkey)", _EMPTY, properties)
    return _rows(table(spark, sf_dir, "supplier"), "s_suppkey", 4, "s_suppkey", resource)


def integration_runtime_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    properties = "named_struct('type', CASE WHEN n_regionkey < 2 THEN 'Managed' ELSE 'SelfHosted' END)"
    resource = _resource("integrationRuntimes", "concat('ir_', n_nationkey)", _EMPTY, properties)
    return _rows(table(spark, sf_dir, "nation"), "n_nationkey % 15", 5, "n_nationkey", resource)


def resource_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    builders = (
        pipeline_rows,
        linked_service_rows,
        dataset_rows,
        trigger_rows,
        dataflow_rows,
        integration_runtime_rows,
    )
    return reduce(DataFrame.unionByName, [build(spark, sf_dir) for build in builders])


def documents(rows: DataFrame) -> DataFrame:
    """Gather resource rows into template documents ``(template_id, part, template)``.

    A part is a range of ``KEYS`` keys, so parts rise with the key. The first part of a template holds its name.
    """
    rows = rows.withColumn("part", F.expr(f"coalesce(key, 0L) div {KEYS}"))
    gathered = _dealt(rows, rows.count(), RESOURCE_ROWS, "template_id", "part").groupBy("template_id", "part").agg(
        F.expr("sort_array(collect_list(struct(seq, key, resource))) AS items")
    )
    first = rows.groupBy("template_id").agg(F.min("part").alias("part")).withColumn("named", F.lit(True))
    name = (
        """concat('{"parameters":{"factoryName":{"type":"string","metadata":"name",',"""
        """ '"defaultValue":"factory_', template_id, '"}},')"""
    )
    body = "array_join(transform(items, i -> i.resource), ',')"
    template = f"""concat(CASE WHEN named THEN {name} ELSE '{{' END, '"resources":[', {body}, ']}}')"""
    return gathered.join(first, ["template_id", "part"], "left").selectExpr("template_id", "part", f"{template} AS template")


_built: dict[tuple[str, str], str] = {}
_shredded: set[str] = set()
_lock = threading.Lock()


def _corpus_path(spark: SparkSession, sf_dir: str, shredded: bool = True) -> str:
    """Folder of the written corpus; built on first use in an application, without ``shredded`` the documents alone."""
    with _lock:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _built:
            path = fresh_path(spark, "corpus")
            # Written between the steps, so that naming and gathering read the rows instead of deriving them twice.
            # Row groups are small, so that a large file of rows is read by many tasks.
            # Tasks that deal rows to more than 200 others keep them until their end, so every one of them reads little.
            with settings(spark, SMALL_TASKS):
                rows = resource_rows(spark, sf_dir).write.option("compression", "zstd").option("parquet.block.size", 1 << 20)
                rows.parquet(f"{path}/rows")
            with settings(spark, ROW_TASKS):
                gathered = documents(spark.read.parquet(f"{path}/rows"))
                gathered.write.option("compression", "zstd").parquet(f"{path}/templates")
            _built[key] = path
        path = _built[key]
        if shredded and path not in _shredded:
            store_resources(shred_resources(spark.read.parquet(f"{path}/templates")), f"{path}/resources")
            _shredded.add(path)
        return path


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shredded = name == "resources"
    try:
        return spark.read.parquet(f"{_corpus_path(spark, sf_dir, shredded)}/{name}")
    except AnalysisException:  # the scratch folder was cleared meanwhile
        _built.pop((spark.sparkContext.applicationId, sf_dir), None)
        return spark.read.parquet(f"{_corpus_path(spark, sf_dir, shredded)}/{name}")


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as documents."""
    return _stored(spark, sf_dir, "templates")


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as shredded resources, each file sorted by kind."""
    return _stored(spark, sf_dir, "resources")
