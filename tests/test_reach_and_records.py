"""Reach over any number of hops, records across splits, partition-wise changes, bucketed tables, VARIANT storage."""

import csv
import os
import random

import pytest
from conftest import SF, resource, rows
from pyspark.sql import functions as F

from plumbline.operators import checks as C
from plumbline.operators import graph as G
from plumbline.operators import metadata as M
from plumbline.operators import notebooks as N
from plumbline.operators import workspace as W
from plumbline.plans import corpus
from plumbline.plans import fixtures as fx
from plumbline.plans.queries import REGISTRY
from plumbline.sources import catalog, files


def reach_by_hand(edges, start):
    found, todo = set(start), list(start)
    while todo:
        node = todo.pop()
        new = {b for a, b in edges if a == node} - found
        found |= new
        todo += new
    return found


@pytest.mark.parametrize("seed", range(4))
def test_reach(spark, seed):
    """Chains, trees, meetings and cycles, some of them entered, some not; one node has a third of all edges."""
    rng = random.Random(seed)
    edges = [(f"c{k}", f"c{k + 1}") for k in range(300)] + [("c300", "m"), ("x", "m"), ("m", "n"), ("y1", "y2"), ("y2", "y1"), ("z1", "z2"), ("z2", "z1"), ("m", "z1")]
    edges += [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(60)] + [(f"h{k}", "hot") for k in range(200)] + [("hot", "after")]
    start = ["c0", "r0", f"h{rng.randrange(200)}", "lonely"]
    df = spark.createDataFrame([("t", *e) for e in edges] + [("other", "c0", "c5")], "template_id STRING, src STRING, dst STRING")
    sources = spark.createDataFrame([("t", s) for s in start], "template_id STRING, k STRING")
    assert {r["k"] for r in G.reached(df, sources).collect()} == reach_by_hand(edges, start)


def test_pipelines_that_no_trigger_starts(corpus_of):
    """A chain of ten from a trigger, a pair in a cycle, and one that only an untriggered pipeline calls."""
    chain = [resource("pipelines", f"P{k}", depends_on=[f"pipelines/p{k + 1}"] if k < 9 else []) for k in range(10)]
    others = [resource("pipelines", a, depends_on=[f"pipelines/{b}"]) for a, b in (("a", "b"), ("b", "a"), ("top", "below"))]
    found = corpus_of({"x": [*chain, *others, resource("pipelines", "below"), resource("triggers", "t", depends_on=["pipelines/p0"])]})
    assert rows(C.c_details(found, {1}, indirect=True).select("Name")) == [("a",), ("b",), ("below",), ("top",)]
    assert rows(C.c_details(found, {1}).select("Name")) == [("top",)]
    every = C.c_details(found, indirect=True).groupBy("CheckNo").count().collect()
    assert {r["CheckNo"]: r["count"] for r in every}[1] == 4


def test_deep_workspace(spark):
    """Ten thousand levels, in rounds that grow with their logarithm."""
    folders = spark.range(10_000).selectExpr("concat('/', id) AS path", "IF(id = 0, '/', concat('/', id - 1)) AS parent", "'DIRECTORY' AS object_type", "CAST(NULL AS STRING) AS language")
    leaf = spark.createDataFrame([("/9999/n", "/9999", "NOTEBOOK", "R"), ("/x/n", "/x", "NOTEBOOK", "R")], folders.schema)
    seen = []
    before = W.written
    W.written = lambda df, label: seen.append(label) or before(df, label)
    try:
        assert rows(W.workspace_tree(folders.union(leaf)).select("path")) == [("/9999/n",)]
    finally:
        W.written = before
    assert len(seen) <= 16


def test_cycles_below_the_root_and_elsewhere(spark):
    kinds = "path STRING, parent STRING, object_type STRING, language STRING"
    apart = [("/a", "/b", "DIRECTORY", None), ("/b", "/a", "DIRECTORY", None), ("/n", "/", "NOTEBOOK", "R"), ("/a/n", "/a", "NOTEBOOK", "R")]
    assert rows(W.workspace_tree(spark.createDataFrame(apart, kinds)).select("path")) == [("/n",)]
    with pytest.raises(ValueError, match="/ lies in a cycle"):
        W.workspace_tree(spark.createDataFrame([("/a", "/", "DIRECTORY", None), ("/", "/a", "DIRECTORY", None)], kinds))


# Records across splits

TEXTS = ["plain", "", "two\nlines", "a\n\nb\n", 'he said "x"', '"', "a,b", "crlf\r\nin", "back\\slash", " blank ", "ünï\n東京", "\n", 'q"\n"q', "end\\"]


def write_files(folder, rng, quoting, **more):
    want = []
    for name in ("one.csv", "two.csv"):
        with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, quoting=quoting, **more)
            writer.writerow(["id", "head\nline"])
            for k in range(60):
                want.append((k, "".join(rng.choice(TEXTS) for _ in range(rng.randrange(1, 4))) or "z"))
                writer.writerow(want[-1])
    return sorted(want)


@pytest.mark.parametrize("size", [64, 1000, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_cut_anywhere(spark, tmp_path, size, end):
    """Splits of 64 bytes cut most records inside a field; what comes out does not depend on them."""
    want = write_files(tmp_path, random.Random(size), csv.QUOTE_ALL, lineterminator=end)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        got = files.read_csv_multiline(spark, str(tmp_path), "id INT, text STRING", escape='"', emptyValue="")
        assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_records_agree_with_the_unsplit_reader(spark, tmp_path):
    """Escaped quotes of Spark's own writer, many splits against one task per file."""
    data = [(k, "".join(random.Random(k).choice(TEXTS[:-1]) for _ in range(3))) for k in range(60)]
    files.write_csv_quoted(spark.createDataFrame(data, "id INT, text STRING"), str(tmp_path / "out"))
    plain = spark.read.csv(str(tmp_path / "out"), "id INT, text STRING", header=True, multiLine=True, lineSep="\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        got = files.read_csv_multiline(spark, str(tmp_path / "out"), "id INT, text STRING")
        assert rows(got) == rows(plain)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# Partition-wise changes


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "stages")
    fx.stages(spark, SF).write.partitionBy("StageId").parquet(path)

    def listed():
        return {(d, f) for d in os.listdir(path) if "=" in d for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")}

    before = listed()
    files.replace_partitions(spark, path, F.col("StageId") > 3, lambda r: M.disable_stages(r, 3), "StageId")
    kept = {f for f in before if int(f[0].split("=")[1]) <= 3}
    assert kept <= listed() and not (before - kept) & listed()
    got = spark.read.parquet(path).select("o_orderkey", "StageId", "Enabled")
    assert rows(got) == rows(M.disable_stages(fx.stages(spark, SF), 3))


def test_failed_change_leaves_the_folder(spark, tmp_path):
    path = str(tmp_path / "stages")
    fx.stages(spark, SF).write.partitionBy("StageId").parquet(path)
    with pytest.raises(Exception, match="broken"):
        files.replace_partitions(spark, path, F.col("StageId") > 3, lambda r: r.withColumn("Enabled", F.raise_error(F.lit("broken")).cast("boolean")), "StageId")
    assert rows(spark.read.parquet(path).select("o_orderkey", "StageId", "Enabled")) == rows(fx.stages(spark, SF))


# Bucketed tables


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    header, detail = (
        catalog.publish_table(df, f"bucketed_{name}", str(tmp_path / name), bucket_by="SalesOrderID", buckets=4)
        for name, df in (("header", fx.order_header(spark, SF)), ("detail", fx.order_detail(spark, SF)))
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = header.join(detail, "SalesOrderID")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in joined.groupBy("SalesOrderID").count()._jdf.queryExecution().executedPlan().toString()
        date = "1995-06-19"
        assert rows(N.n_order_line_count(header, detail, date)) == rows(N.n_order_line_count(fx.order_header(spark, SF), fx.order_detail(spark, SF), date))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# VARIANT storage

STORED = ["c_summary", "c_details", "c_totals", "t_component_summary", "t_pipeline_info", "t_activity_info", "t_dataset_info", "t_trigger_info"]
STORED += [f"c{n:02d}" for n in range(1, 22)]


@pytest.mark.parametrize("name", STORED)
def test_stored_resources_are_not_parsed_again(spark, name):
    plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan


def test_members_are_columns_of_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = REGISTRY["t_dataset_info"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "properties:struct<0:" in plan and "variant_get" not in plan and "activities" not in plan
    stored = corpus.resources(spark, SF)
    assert stored.schema["properties"].dataType.typeName() == "variant"
