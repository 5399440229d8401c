"""Template summaries on hand-made documents."""

import json

import pytest
from conftest import activity, resource, rows

from plumbline.operators import graph as G
from plumbline.operators import templates as T


def test_shred_keeps_order_text_and_kind(corpus_of):
    r = corpus_of(
        {
            "a": [
                resource("Pipelines", "p", {"x": {"y": [1, 2]}}),
                resource("x", "other", type_name="Other.Provider/factories/pipelines"),
            ],
            "empty": [],
        }
    )
    first, second = r.orderBy("ordinal").collect()
    assert (first.ordinal, first.kind, first.dependsOn) == (0, "pipelines", [])
    assert json.loads(r.select(T.properties_text(r)).first()[0]) == {"x": {"y": [1, 2]}}
    assert str(first.apiVersion) == "2018-06-01"
    assert second.kind is None


def test_malformed_documents_fail_or_are_named(spark):
    df = spark.createDataFrame([("a", "not json"), ("b", "{}"), ("c", None)], "template_id STRING, template STRING")
    assert T.shred_resources(df, strict=False).count() == 0
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        T.shred_resources(df).collect()
    assert rows(T.unparsable_documents(df)) == [("a",), ("c",)]
    assert T.t_factory_name(df).count() == 0


def test_factory_name(spark):
    text = json.dumps({"parameters": {"factoryName": {"type": "string", "defaultValue": "f1"}}})
    df = spark.createDataFrame([("a", text), ("b", '{"parameters":{}}')], "template_id STRING, template STRING")
    assert rows(T.t_factory_name(df)) == [("a", "f1")]


def test_component_summary_folds_case_and_keeps_zero_activities(corpus_of):
    documents = {
        "a": [
            resource("pipelines", "p1", {"activities": [activity("x"), activity("y"), {"type": "Copy"}]}),
            resource("pipelines", "p2", type_name="microsoft.datafactory/factories/PIPELINES"),
            resource("managedThings", "m"),
        ],
        "b": [resource("datasets", "d", {"activities": [activity("not counted")]})],
        "c": [],
    }
    summary = T.t_component_summary(corpus_of(documents), corpus_of(documents, shred=False))
    assert rows(summary) == [
        ("a", "Activities", 2),
        ("a", "ManagedThings", 1),
        ("a", "PIPELINES", 2),
        ("b", "Activities", 0),
        ("b", "Datasets", 1),
        ("c", "Activities", 0),
    ]


def test_component_summary_is_a_distinct_union(corpus_of):
    documents = {"a": [resource("activities", "odd"), resource("pipelines", "p", {"activities": [activity("x")]})]}
    # One resource of a type named like the activity row, and one activity: the same row twice.
    assert rows(T.t_component_summary(corpus_of(documents))) == [("a", "Activities", 1), ("a", "Pipelines", 1)]


def test_pipeline_info_is_inner_on_folder_and_activities(corpus_of):
    one = {"activities": [activity("x")]}
    documents = {
        "a": [
            resource("pipelines", "kept", {**one, "folder": {"name": "f"}, "description": "d"}),
            resource("pipelines", "noname", {"activities": [{"type": "Copy"}], "folder": {}}),
            resource("pipelines", "nofolder", one),
            resource("pipelines", "empty", {"activities": [], "folder": {"name": "f"}}),
            resource("pipelines", "missing", {"folder": {"name": "f"}}),
            resource("pipelines", "twice", {**one, "folder": {"name": "f"}}),
            resource("pipelines", "TWICE", {**one, "folder": {"name": "F"}}),
        ]
    }
    assert rows(T.t_pipeline_info(corpus_of(documents))) == [
        ("a", "TWICE", None, "F", 2),
        ("a", "kept", "d", "f", 1),
        ("a", "noname", None, None, 0),
    ]


def test_nested_activities_are_not_visited(corpus_of):
    inner = {"typeProperties": {"activities": [activity("inner")], "batchCount": 20, "isSequential": False}}
    documents = {"a": [resource("pipelines", "p", {"activities": [activity("loop", **inner)]})]}
    r = corpus_of(documents)
    assert rows(T.t_activity_info(r)) == [("a", "loop", "Copy", None, "p")]
    shredded = T.shred_activities(r).first()
    assert (shredded.typeProperties.batchCount, shredded.typeProperties.isSequential) == (20, False)


def test_linked_service_key_vault_flag_ignores_case_and_place(corpus_of):
    documents = {
        "a": [
            resource("linkedServices", "l1", {"type": "T", "typeProperties": {"a": {"b": {"type": "azurekeyvaultSECRET"}}}}),
            resource("linkedServices", "l2", {"type": "T", "description": "no AzureKeyVault Secret"}),
        ]
    }
    assert rows(T.t_linked_service_info(corpus_of(documents))) == [("a", "l1", "T", "Yes"), ("a", "l2", "T", "No")]


def test_dataset_info_is_inner_on_folder_and_service(corpus_of):
    full = {"type": "T", "folder": {"name": "f"}, "linkedServiceName": {"referenceName": "l"}}
    documents = {
        "a": [
            resource("datasets", "kept", full),
            resource("datasets", "nofolder", {k: v for k, v in full.items() if k != "folder"}),
            resource("datasets", "noservice", {k: v for k, v in full.items() if k != "linkedServiceName"}),
        ]
    }
    assert rows(T.t_dataset_info(corpus_of(documents))) == [("a", "kept", "T", "f", "l")]


def test_graph_ignores_case_and_counts_used_triggers(corpus_of):
    documents = {
        "a": [
            resource("pipelines", "P1"),
            resource("pipelines", "p1"),
            resource("pipelines", "p2"),
            resource("datasets", "d", depends_on=["linkedServices/L"]),
            resource("linkedServices", "l"),
            resource("triggers", "used", depends_on=["PIPELINES/p2"]),
            resource("triggers", "idle"),
        ],
        "b": [resource("linkedServices", "l")],
    }
    r = corpus_of(documents)
    assert rows(G.g_dependants(r)) == [("a", "PIPELINES|p2"), ("a", "linkedServices|L"), ("a", "triggers|used")]
    assert rows(G.redundant_resources(r)) == [
        ("a", "datasets|d"),
        ("a", "pipelines|P1"),
        ("a", "triggers|idle"),
        ("b", "linkedServices|l"),
    ]
    assert rows(G.redundant_resources(r, ("pipelines",))) == [("a", "pipelines|P1")]
    assert G.g_resources(r).count() == 7


def test_tasks_of_the_corpus_follow_its_rows(spark, monkeypatch):
    """What a task sorts and gathers is bounded by rows, however few partitions the session asks for."""
    from plumbline.plans import corpus

    monkeypatch.setattr(corpus, "RESOURCE_ROWS", 50)
    df = spark.range(1000).selectExpr("id % 97 AS template_id", "0 AS seq", "id AS key", "'{}' AS resource")
    gathered = corpus.documents(df)
    counts = [len(part) for part in gathered.rdd.glom().collect()]
    assert len(counts) == 20 and sum(counts) == 97 and sum(n > 0 for n in counts) > 15


def test_storing_reads_little_in_a_task(spark, tmp_path):
    """Rows are sorted whole, so a large folder is read in small tasks, and settings are put back."""
    df = spark.createDataFrame([(f"t{k}", json.dumps({"resources": [resource("datasets", f"d{k}")]})) for k in range(40)], "template_id STRING, template STRING")
    df.repartition(40).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes", None)
    stored = T.store_resources(T.shred_resources(spark.read.parquet(str(tmp_path / "in"))), str(tmp_path / "out"))
    assert stored.count() == 40 and spark.conf.get("spark.sql.files.maxPartitionBytes", None) == before
    # A file counts as 4 MB at least, so 16 MB are four files a task at most.
    assert len(list((tmp_path / "out").glob("part-*"))) >= len(list((tmp_path / "in").glob("part-*"))) / 4
