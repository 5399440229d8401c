"""Shapes of the physical plans: shuffles, joins, pushed filters and columns read."""

import re

import pytest
from conftest import SF

import __spark_entry__ as driver
from plumbline.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def plan_of(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "2000"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield lambda name: driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for key, value in before.items():
        spark.conf.set(key, value)


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hash|range)partitioning|Exchange SinglePartition", plan))


ROW_LOCAL = ["shred_resources", "shred_activities", "t_activity_info", "t_dataset_info", "i_route_files", "i_landing_path"]
ROW_LOCAL += [f"c{n:02d}" for n in range(1, 22) if n not in (1, 12, 15, 19)]


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_rules_do_not_shuffle(plan_of, name):
    assert shuffles(plan_of(name)) == 0


@pytest.mark.parametrize(
    "name, count",
    [
        ("redundant_resources", 1),
        ("c12", 1),
        ("c_details", 1),
        ("c_summary", 2),
        ("c_summary_from_documents", 2),
        ("t_pipeline_info", 1),
        ("t_component_summary", 3),
        ("r_latest_run", 2),
        ("r_current_execution_counts", 1),
        ("n_word_count", 2),
    ],
)
def test_shuffle_count(plan_of, name, count):
    assert shuffles(plan_of(name)) == count


@pytest.mark.parametrize("name", ["redundant_resources", "c_details", "c_summary", "c02", "c11"])
def test_checks_need_no_join(plan_of, name):
    assert "Join" not in plan_of(name)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_pair_joins_and_no_whole_table_windows(plan_of, name):
    plan = plan_of(name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # A single partition is only for an aggregate of one row, or for one count per task.
    for line in re.findall(r".*Exchange SinglePartition.*\n.*", plan):
        assert "partial_" in line or "keys=[_part" in line


def test_documents_are_parsed_once_for_the_summary(plan_of):
    assert plan_of("c_summary_from_documents").count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_every_query_reads_a_table(plan_of, name):
    # i_copy_all_tables reads the tables while it is called.
    assert "FileScan" in plan_of(name)


def test_graph_reads_narrow_columns(plan_of):
    schema = re.search(r"ReadSchema: struct<(.*)>", plan_of("redundant_resources")).group(1)
    assert schema.split(",") == ["template_id:bigint", "name:string", "type:string", "kind:string", "dependsOn:array<string>"]


def test_kind_is_pushed_into_the_scan(plan_of):
    assert "EqualTo(kind,pipelines)" in plan_of("c03")
    assert "In(kind, [dataflows,triggers])" in plan_of("resources_of_type")


def test_run_date_and_time_range_are_pushed(plan_of):
    assert "EqualTo(o_orderdate,1995-06-19T00:00)" in plan_of("n_order_line_count")
    assert "GreaterThanOrEqual(ts,2014-12-25T00:00)" in plan_of("r_latest_run")
