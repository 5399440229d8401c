"""The same oracles on tables where one key holds a third of the rows and documents span few keys."""

import shutil

import pytest
from compare import TABLES, compare, duck
from conftest import SF, rows

import __spark_entry__ as driver
from plumbline.plans import corpus

HOT = {
    # One order with a third of the line items, one template with a third of the orders.
    "lineitem": """SELECT CASE WHEN row_number() OVER () % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, l_partkey, l_suppkey,
        CASE WHEN row_number() OVER () % 3 = 0 THEN row_number() OVER () ELSE l_linenumber END AS l_linenumber, l_quantity, CAST(row_number() OVER () AS DOUBLE) AS l_extendedprice, l_discount, l_tax, l_returnflag,
        l_linestatus, l_shipdate FROM lineitem""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 4 ELSE user_id END AS user_id) FROM events",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE c_nationkey END AS c_nationkey) FROM customer",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duck(SF)
    for name in TABLES:
        if name in HOT:
            con.execute(f"COPY ({HOT[name]}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        else:
            shutil.copy(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
    return str(folder)


NAMES = [
    n
    for n in sorted(driver.queries())
    if n.startswith(("t_", "c_", "g_", "r_", "i_pick", "i_render", "shred", "redundant", "st_", "workspace", "read_templates", "c0", "c1", "c2", "land"))
]


@pytest.fixture(scope="module")
def small_limits(spark):
    patch = pytest.MonkeyPatch()
    patch.setattr(corpus, "KEYS", 100)
    yield
    patch.undo()


@pytest.mark.parametrize("name", NAMES)
def test_skewed_query(spark, skewed, small_limits, name):
    df = driver.queries()[name](spark, skewed)
    assert compare(df, duck(skewed), driver.oracle_sql()[name]) == []


def test_hot_groups_were_split(spark, skewed, small_limits):
    sizes = corpus.templates(spark, skewed).selectExpr("template_id", "part", "length(template) AS n").collect()
    assert max(r.part for r in sizes) >= 5
    pipelines = corpus.resources(spark, skewed).filter("kind = 'pipelines' AND name LIKE '%/pl\\_5\\__%'")
    assert pipelines.count() == 6  # line numbers up to 6,000
    activities = spark.read.parquet(corpus._corpus_path(spark, skewed) + "/resources").selectExpr(
        "array_size(activities) AS n"
    )
    assert 0 < activities.agg({"n": "max"}).first()[0] <= corpus.LINES


def test_previous_key_across_blocks(spark, monkeypatch):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    monkeypatch.setattr(corpus, "KEY_BLOCK", 7)
    df = spark.range(300).select((F.xxhash64("id") % 4).alias("g"), "id").filter(F.xxhash64("id", F.lit(1)) % 3 != 0)
    plain = df.withColumn("previous", F.lag("id").over(Window.partitionBy("g").orderBy("id")))
    assert rows(corpus._previous_key(df, "g", "id").select("g", "id", "previous")) == rows(plain)


def test_tasks_that_look_up_previous_keys_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(corpus, "KEY_BLOCK", 7)
    monkeypatch.setattr(corpus, "ORDER_ROWS", 50)
    df = spark.range(2000).selectExpr("id % 5 AS g", "id")
    found = corpus._previous_key(df, "g", "id")
    counts = [len(part) for part in found.rdd.glom().collect()]
    assert sum(counts) == 2000 and max(counts) <= 200
    assert rows(found.filter("id < 10").select("id", "previous")) == [(k, None if k < 5 else k - 5) for k in range(10)]


def test_corpus_is_built_from_small_splits(spark, monkeypatch, tmp_path):
    """Tasks that deal rows to many others keep what they read: files are read in small splits of small row groups."""
    import pyarrow.parquet as pq

    seen = []
    plain = corpus.settings
    monkeypatch.setattr(corpus, "settings", lambda session, values: (seen.append(values), plain(session, values))[1])
    monkeypatch.setattr(corpus, "_built", {})
    monkeypatch.setattr(corpus, "fresh_path", lambda session, label: str(tmp_path / label))
    wide = "array_join(transform(sequence(1, 20), k -> sha2(concat(id, '-', k), 512)), '')"
    many = spark.range(0, 6000, 1, 1).selectExpr("id % 9 AS template_id", "0 AS seq", "id AS key", f"concat('{{\"name\":\"', {wide}, '\"}}') AS resource")
    monkeypatch.setattr(corpus, "resource_rows", lambda session, sf_dir: many)
    path = corpus._corpus_path(spark, "made-up")
    assert [int(v["spark.sql.files.maxPartitionBytes"].rstrip("m")) <= 4 for v in seen] == [True, True]
    [rows_file] = (tmp_path / "corpus" / "rows").glob("part-*")
    meta = pq.ParquetFile(rows_file).metadata
    assert meta.num_rows == 6000 and meta.num_row_groups > 1 and spark.read.parquet(f"{path}/resources").count() == 6000
