"""Readers, writers, ingestion, metadata tables and the workspace tree."""

import json
import re
from datetime import datetime

import pytest
from conftest import SF, resource, rows
from pyspark.sql import functions as F

from plumbline.operators import ingest as I
from plumbline.operators import metadata as M
from plumbline.operators import workspace as W
from plumbline.plans import queries
from plumbline.session import fresh_path, scratch_root, settings
from plumbline.sources import catalog, files, jdbc

DIRTY = 'Field1,Fiel2,Field3,Field4\n"abc","abc","abc","abc"\n"abc","ab\nc","a\nbc","abc"\n"abc","abc","abc","abc"\n'
NOW = datetime(2020, 10, 20, 15, 30)


@pytest.fixture
def dirty(tmp_path):
    (tmp_path / "dirty.csv").write_text(DIRTY)
    return str(tmp_path / "dirty.csv")


def test_read_templates(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "resources": []\n}')
    (tmp_path / "b.json").write_text("{}")
    read = files.read_templates(spark, str(tmp_path)).collect()
    assert sorted(r.template_id.rsplit("/", 1)[-1] for r in read) == ["a.json", "b.json"]
    assert {r.template for r in read} == {'{\n "resources": []\n}', "{}"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_templates(spark, str(tmp_path / "missing"))


def test_multiline_csv_is_cleaned_to_one_line_per_record(spark, dirty):
    assert files.read_csv_inferred(spark, dirty).count() == 5
    clean = I.i_clean_csv(files.read_csv_multiline(spark, dirty))
    assert clean.columns == ["Field1", "Fiel2", "Field3", "Field4"]
    assert rows(clean) == [("abc", "abc", "abc", "abc")] * 3


@pytest.mark.parametrize("options, escaped", [({}, '\\"b\\"'), ({"escape": '"'}, '""b""')])
def test_quoted_csv_round_trip(spark, tmp_path, options, escaped):
    df = spark.createDataFrame([(1, ' a "b", c\nd '), (2, "x\\"), (3, '\\"')], "i INT, t STRING")
    files.write_csv_quoted(df, str(tmp_path / "q"), **options)
    text = "".join(p.read_text() for p in (tmp_path / "q").glob("*.csv"))
    assert f'"1"," a {escaped}, c' in text and '"i","t"' in text
    assert rows(files.read_csv_multiline(spark, str(tmp_path / "q"), "i INT, t STRING", **options)) == rows(df)


def test_landing_is_partitioned_and_pruned(spark, tmp_path):
    path = str(tmp_path / "landing")
    files.land_partitioned(spark.range(3), path, NOW)
    files.land_partitioned(spark.range(2), path, datetime(2020, 10, 20, 3), hour24=True)
    landed = spark.read.parquet(path)
    assert {(r.Year, r.Month, r.Day, r.Hour) for r in landed.collect()} == {(2020, 10, 20, 3)}
    plan = landed.filter("Hour = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Hour" in plan


def test_list_and_binary_ingest(spark, tmp_path):
    source = tmp_path / "in"
    (source / "sub").mkdir(parents=True)
    (source / "a.bin").write_bytes(b"\x00\x01")
    (source / "sub" / "b.dat").write_bytes(b"xyz")
    listed = files.list_files(spark, str(source))
    assert rows(listed.select("name", "length")) == [("a.bin", 2), ("b.dat", 3)]
    assert rows(files.list_files(spark, str(source), "*.dat").select("name")) == [("b.dat",)]
    landed = files.binary_ingest(spark, str(source), str(tmp_path / "out"), NOW)
    assert {(bytes(r.content), r.Hour) for r in landed.collect()} == {(b"\x00\x01", 3), (b"xyz", 3)}


def test_routes(spark):
    names = ["xlsx.xlsx", "my.txt", "a.b.csv", "x.XLSX", "noext", "t.csv", "old.txt.txt"]
    out = I.i_route_files(spark.createDataFrame([(n,) for n in names], "name STRING"), NOW)
    found = {r.name: (r.extension, r.route, r.target_name) for r in out.collect()}
    assert found == {
        "xlsx.xlsx": ("xlsx", "xlsx", "csv.csv"),
        "my.txt": ("txt", "txt", "my.csv"),
        "a.b.csv": ("b.csv", "default", "a.b.csv"),
        "x.XLSX": ("XLSX", "default", "x.XLSX"),
        "noext": ("noext", "default", "noext"),
        "t.csv": ("csv", "default", "t.csv"),
        "old.txt.txt": ("txt.txt", "default", "old.txt.txt"),
    }
    assert out.select("target_folder").distinct().first()[0] == "Landing/Year=2020/Month=10/Day=20/Hour=03"


def test_csv_to_table(spark, tmp_path):
    (tmp_path / "My Gender.csv").write_text("id,label\n1,a\n2,b\n")
    table = I.i_csv_to_table(spark, str(tmp_path / "My Gender.csv"), str(tmp_path), table_path=str(tmp_path / "t"))
    assert dict(table.dtypes) == {"id": "int", "label": "string"}
    assert rows(spark.table("MyGender")) == [(1, "a"), (2, "b")]
    assert spark.read.parquet(str(tmp_path / "Consume" / "MyGender.parquet")).count() == 2
    # A second run replaces the table.
    assert I.i_csv_to_table(spark, str(tmp_path / "My Gender.csv"), str(tmp_path), table_path=str(tmp_path / "t2")).count() == 2
    spark.sql("DROP TABLE MyGender")


def test_table_names_are_quoted(spark):
    with pytest.raises(Exception):
        catalog.publish_table(spark.range(1), "x; DROP TABLE y")


class FakeTables(files.ParquetTables):
    def read(self, table):
        if table == "broken":
            raise RuntimeError("no such table")
        return super().read(table)


def test_copy_all_tables_reports_each_outcome(spark, tmp_path):
    source = FakeTables(spark, str(tmp_path / "src"))
    target = files.ParquetTables(spark, str(tmp_path / "dst"))
    source.overwrite(spark.range(5), "five")
    source.overwrite(spark.range(7), "seven")
    target.overwrite(spark.range(100), "five")
    names = spark.createDataFrame([("five",), ("broken",), ("seven",)], "TableName STRING")
    out = I.i_copy_all_tables(spark, source, target, names)
    assert rows(out) == [("broken", None, "Failed: RuntimeError"), ("five", 5, "Succeeded"), ("seven", 7, "Succeeded")]
    assert target.read("five").count() == 5


class Recorder:
    """Stands in for the reader and the writer of a session, since no database is started here."""

    def __init__(self, bounds):
        self.bounds, self.calls = bounds, []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self

    def first(self):
        return self.bounds

    @property
    def read(self):
        return self

    def option(self, key, value):
        self.calls.append((key, value))
        return self

    def mode(self, value):
        self.calls.append(("mode", value))
        return self

    @property
    def write(self):
        return self


def test_jdbc_reads_in_parallel_ranges(spark):
    recorder = Recorder((10, 90))
    jdbc.read_jdbc_table(recorder, "jdbc:x", "T", column="id", partitions=8)
    assert recorder.calls[-1][2] == {
        "column": "id", "lowerBound": 10, "upperBound": 91, "numPartitions": 8, "properties": {},
    }
    assert recorder.calls[0][1] == "(SELECT MIN(id) AS low, MAX(id) AS high FROM T) bounds"
    single = Recorder((None, None))
    jdbc.read_jdbc_table(single, "jdbc:x", "T", column="id", partitions=8)
    assert single.calls[-1][2] == {"properties": {}}


def test_jdbc_overwrite_truncates_in_batches():
    recorder = Recorder((0, 0))
    jdbc.JdbcTables(recorder, "jdbc:x", {"user": "u"}).overwrite(recorder, "T")
    assert recorder.calls == [
        ("mode", "overwrite"), ("truncate", True), ("batchsize", 10000), ("jdbc:x", "T", {"properties": {"user": "u"}}),
    ]


def test_table_list(spark):
    objects = spark.createDataFrame(
        [(1, "Orders", "U ", 1), (2, "FK_a_b", "F", 1), (3, "Other", "U", 2)], "object_id INT, name STRING, type STRING, schema_id INT"
    )
    schemas = spark.createDataFrame([(1, "SalesLT"), (2, "dbo")], "schema_id INT, name STRING")
    assert rows(catalog.table_list(objects, schemas, "saleslt")) == [("SalesLT.Orders",)]
    assert rows(M.drop_fk_statements(objects)) == [("ALTER TABLE SalesLT.a DROP CONSTRAINT FK_a_b",)]


def test_pick_linked_service_takes_the_last_and_hides_keys(corpus_of):
    def service(n, kind="AzureDataLakeStore"):
        members = {"dataLakeStoreUri": f"u{n}", "servicePrincipalId": "i", "servicePrincipalKey": "k", "tenant": "t"}
        return resource("linkedServices", f"l{n}", {"type": kind, "typeProperties": members})

    r = corpus_of({"a": [service(1), service(3), service(2), service(4, "Other")]})
    assert rows(I.i_pick_linked_service(r, "AzureDataLakeStore")) == [("a", "l2", "u2", "i", "<redacted>", "t")]


def test_workers(spark):
    factories = spark.createDataFrame([(4, "other"), (9, "mine")], "DataFactoryId INT, DataFactoryName STRING")
    keys = spark.range(301).select((F.col("id") * 7 + 5).alias("key")).repartition(5)
    workers = M.generate_workers(keys, "key", factories, "mine")
    per_stage = rows(workers.groupBy("StageId", "DataFactoryId", "Enabled").count())
    assert per_stage == [(1, 9, True, 100), (2, 9, True, 100), (3, 9, True, 100), (None, 9, True, 1)]
    assert workers.filter("PipelineId = 301").first().PipelineName == "Wait 301"
    assert sorted(tuple(r) for r in M.numbered(keys, "key").collect()) == [(7 * i + 5, i + 1) for i in range(301)]


def test_table_changes(spark):
    stages = spark.createDataFrame([(3, True), (4, True), (5, False)], "StageId INT, Enabled BOOLEAN")
    assert rows(M.disable_stages(stages)) == [(3, True), (4, False), (5, False)]


def test_workspace_tree_needs_listed_directories(spark):
    data = [
        ("/a", "/", "DIRECTORY", None),
        ("/a/b", "/a", "DIRECTORY", None),
        ("/n", "/", "NOTEBOOK", "SQL"),
        ("/a/n", "/a", "NOTEBOOK", "python"),
        ("/a/b/l", "/a/b", "LIBRARY", None),
        ("/a/b/j", "/a/b", "NOTEBOOK", "JAVA"),
        ("/lost/n", "/lost", "NOTEBOOK", "SQL"),
    ]
    items = spark.createDataFrame(data, "path STRING, parent STRING, object_type STRING, language STRING")
    tree = W.workspace_tree(items)
    assert rows(tree.select("path")) == [("/a/b/j",), ("/a/b/l",), ("/a/n",), ("/n",)]
    assert rows(W.workspace_tree(items, "/a/b").select("path")) == [("/a/b/j",), ("/a/b/l",)]
    assert rows(W.export_manifest(tree, "/out")) == [
        ("/a/b/l", None, None, "skipped"),
        ("/a/n", "/out/a/n.ipynb", "JUPYTER", "export"),
        ("/n", "/out/n.sql", "SOURCE", "export"),
    ]


def test_deep_tree_is_walked_whole(spark):
    data = [(f"/{'/'.join(['d'] * (i + 1))}", "/" + "/".join(["d"] * i), "DIRECTORY", None) for i in range(30)]
    data.append((data[-1][0] + "/n", data[-1][0], "NOTEBOOK", "R"))
    items = spark.createDataFrame(data, "path STRING, parent STRING, object_type STRING, language STRING")
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert W.workspace_tree(items).count() == 1
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_cycle_is_an_error(spark):
    data = [("/a", "/", "DIRECTORY", None), ("/b", "/a", "DIRECTORY", None), ("/a", "/b", "DIRECTORY", None)]
    items = spark.createDataFrame(data, "path STRING, parent STRING, object_type STRING, language STRING")
    with pytest.raises(ValueError, match="/a lies in a cycle"):
        W.workspace_tree(items)


def test_copies_can_be_strict(spark, tmp_path):
    source, target = files.ParquetTables(spark, SF, ".parquet"), files.ParquetTables(spark, str(tmp_path / "copies"))
    names = spark.createDataFrame([("region",), ("missing",)], "TableName STRING")
    with pytest.raises(RuntimeError, match="missing: Failed"):
        I.i_copy_all_tables(spark, source, target, names, strict=True)
    assert target.read("region").count() == 5
    with pytest.raises(ValueError, match="more than once"):
        I.i_copy_all_tables(spark, source, target, names.union(names))


def test_table_in_a_schema(spark, tmp_path):
    published = catalog.publish_table(spark.range(3), "t", str(tmp_path / "t"), schema="made_here")
    assert published.count() == 3 and spark.table("made_here.t").count() == 3
    spark.sql("DROP SCHEMA made_here CASCADE")


def test_scratch_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or scratch_root(spark).startswith(shared)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_tables_that_are_folders_are_copied(spark, tmp_path):
    import __spark_entry__ as driver

    root = tmp_path / "tables.parquet"
    for name in queries.TABLE_KEYS:
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(2).write.parquet(str(root / f"{name}.parquet"))
    names = files.list_tables(spark, f"file:{root}/", ".parquet")
    assert sorted(r.TableName for r in names.collect()) == sorted(queries.TABLE_KEYS)
    copied = rows(driver.queries()["i_copy_all_tables"](spark, str(root)))
    assert len(copied) == 14 and copied == rows(driver.queries()["i_copy_all_tables"](spark, SF))


def test_each_document_is_a_file_of_its_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(queries.corpus, "templates", lambda spark, sf: spark.createDataFrame(
        [(t, p, json.dumps({"resources": [{"name": "n"}] * (p + 1)})) for t in (1, 2) for p in (0, 1, 2)],
        "template_id BIGINT, part BIGINT, template STRING"))
    read = queries.read_templates(spark, SF)
    assert rows(read.select("template_id", "resources")) == [(1, 6), (2, 6)]
    assert len(list((tmp_path / "documents").rglob("part-*.lz4"))) == 6
    assert not list((tmp_path / "documents").rglob("part=*"))  # one folder for each template, none for each document


def test_lines_are_written_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: str(tmp_path / label))
    assert queries.read_template_lines(spark, SF).count() == 15
    written = list((tmp_path / "documents").glob("part-*"))
    lengths = queries.corpus.templates(spark, SF).selectExpr("sum(octet_length(template))").first()[0]
    assert written and sum(f.stat().st_size for f in written) < lengths / 4


def test_documents_of_a_task_share_a_folder(spark, tmp_path, monkeypatch):
    """Hadoop starts a process for each file and folder it makes here; the documents come without either."""
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: str(tmp_path / label))
    made = spark.range(0, 300, 1, 3).selectExpr("id AS template_id", "'{\"resources\": [{\"name\": \"n\"}]}' AS template")
    monkeypatch.setattr(queries.corpus, "templates", lambda spark, sf: made)
    assert rows(queries.read_templates(spark, SF)) == sorted(((k, None, 1) for k in range(300)), key=repr)
    written = [f for f in (tmp_path / "documents").rglob("*") if f.is_file()]
    assert len(written) == 300 and len({f.parent for f in written}) == 3
    assert {f.suffix for f in written} == {".lz4"}  # no check sums beside them


@pytest.mark.parametrize("mounted", [True, False])
def test_small_splits_make_no_task_for_each_document(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(files, "mounted_folder", lambda spark, path: None)
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: str(tmp_path / label))
    made = spark.range(0, 100, 1, 3).selectExpr("id AS template_id", "'{\"resources\": []}' AS template")
    monkeypatch.setattr(queries.corpus, "templates", lambda spark, sf: made)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1m"}):
        read = queries.read_templates(spark, SF)
        assert read.count() == 100
        plan = read._jdf.queryExecution().executedPlan().toString()
    assert [int(n) <= 4 * 4 for n in re.findall(r"Coalesce (\d+)", plan)] == [True]


@pytest.mark.parametrize("mounted", [True, False])
def test_documents_without_a_key_are_read(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(files, "mounted_folder", lambda spark, path: None)
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(queries.corpus, "templates", lambda spark, sf: spark.createDataFrame(
        [(t, json.dumps({"resources": [{}]})) for t in (None, None, -3, 0, 7)], "template_id BIGINT, template STRING"))
    assert rows(queries.read_templates(spark, SF)) == sorted([(None, None, 2), (-3, None, 1), (0, None, 1), (7, None, 1)], key=repr)


@pytest.mark.parametrize("mounted", [True, False])
def test_documents_come_back_whole(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(files, "mounted_folder", lambda spark, path: None)
    texts = ["é" * 100_000, "".join(map(chr, range(1, 0xD800))) * 5, "{}", "a\n b\r\n", "", None]
    made = spark.createDataFrame([(k % 4, t) for k, t in enumerate(texts)], "template_id BIGINT, template STRING")
    files.write_documents(made, str(tmp_path / "d"), "template_id", "template")
    read = files.read_templates(spark, str(tmp_path / "d")).selectExpr("regexp_extract(template_id, 'template_id=([0-9]+)', 1)", "template")
    assert rows(read) == sorted(((str(k % 4), (t or "") + "\n") for k, t in enumerate(texts)), key=repr)
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_documents(made, str(tmp_path / "d"), "template_id", "template")
    files.write_documents(made.limit(0), str(tmp_path / "none"), "template_id", "template")
    assert files.read_templates(spark, str(tmp_path / "none")).count() == 0


def test_documents_of_a_failed_job_are_not_read(spark, tmp_path):
    broken = "if(id = 150, raise_error('broken'), 'x')"
    made = spark.range(0, 200, 1, 2).selectExpr("id AS template_id", f"{broken} AS template")
    with pytest.raises(Exception, match="broken"):
        files.write_documents(made, str(tmp_path / "d"), "template_id", "template")
    assert files.read_templates(spark, str(tmp_path / "d")).count() == 0


def test_documents_are_not_shredded_before_resources_are_read(spark, tmp_path, monkeypatch):
    corpus = queries.corpus
    monkeypatch.setattr(corpus, "_built", {})
    monkeypatch.setattr(corpus, "fresh_path", lambda spark, label: str(tmp_path / label))
    assert corpus.templates(spark, SF).count() == 15
    assert (tmp_path / "corpus" / "templates").exists() and not (tmp_path / "corpus" / "resources").exists()
    resources = corpus.resources(spark, SF)
    documents = corpus.templates(spark, SF).selectExpr("sum(json_array_length(get_json_object(template, '$.resources')))")
    assert resources.count() == documents.first()[0] > 0
