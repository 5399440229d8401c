"""Each check on hand-made documents, and invariants over the derived corpus."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import SF, activity, resource, rows

from plumbline.functions.constants import CHECKS
from plumbline.operators import checks as C
from plumbline.plans import corpus


def found(resources, number):
    return sorted(r.Name for r in getattr(C, f"c{number:02d}")(resources).collect())


PLAIN = [
    # check, kind, flagged properties, clean properties
    (3, "pipelines", [{}, {"description": ""}], [{"description": "d"}]),
    (4, "pipelines", [{}, {"folder": {}}, {"folder": {"name": ""}}], [{"folder": {"name": "f"}}]),
    (5, "pipelines", [{}, {"annotations": []}], [{"annotations": ["x"]}]),
    (6, "dataflows", [{}, {"description": ""}], [{"description": "d"}]),
    (13, "linkedServices", [{}, {"description": ""}], [{"description": "d"}]),
    (14, "linkedServices", [{}, {"annotations": []}], [{"annotations": ["x"]}]),
    (16, "datasets", [{}, {"description": ""}], [{"description": "d"}]),
    (17, "datasets", [{}, {"folder": {"name": ""}}], [{"folder": {"name": "f"}}]),
    (18, "datasets", [{}, {"annotations": []}], [{"annotations": [{"k": 1}]}]),
    (20, "triggers", [{}, {"description": ""}], [{"description": "d"}]),
    (21, "triggers", [{}, {"annotations": []}], [{"annotations": ["x"]}]),
]


@pytest.mark.parametrize("number, kind, flagged, clean", PLAIN)
def test_missing_is_null_or_empty(corpus_of, number, kind, flagged, clean):
    documents = [resource(kind, f"bad{i}", p) for i, p in enumerate(flagged)]
    documents += [resource(kind, f"good{i}", p) for i, p in enumerate(clean)]
    assert found(corpus_of({"a": documents}), number) == [f"bad{i}" for i in range(len(flagged))]


def pipeline_of(*activities, name="p"):
    return {"a": [resource("pipelines", name, {"activities": list(activities)})]}


ACTIVITIES = [
    (7, [{"policy": {"timeout": "7.00:00:00"}}], [{}, {"policy": {"timeout": "0.12:00:00"}}]),
    (8, [{}, {"description": ""}], [{"description": "d"}]),
    (
        9,
        [{"type": "ForEach"}, {"type": "foreach", "typeProperties": {"isSequential": False}}],
        [
            {"type": "ForEach", "typeProperties": {"isSequential": True}},
            {"type": "ForEach", "typeProperties": {"batchCount": 0}},
            {"type": "Copy"},
        ],
    ),
    (
        10,
        [{"type": "ForEach"}, {"type": "ForEach", "typeProperties": {"batchCount": 49}}],
        [
            {"type": "ForEach", "typeProperties": {"batchCount": 50}},
            {"type": "ForEach", "typeProperties": {"isSequential": True, "batchCount": 1}},
        ],
    ),
]


@pytest.mark.parametrize("number, flagged, clean", ACTIVITIES)
def test_activity_checks(corpus_of, number, flagged, clean):
    activities = [activity(f"bad{i}", **m) for i, m in enumerate(flagged)]
    activities += [activity(f"good{i}", **m) for i, m in enumerate(clean)]
    r = corpus_of(pipeline_of(*activities))
    details = getattr(C, f"c{number:02d}")(r).collect()
    assert sorted(d.Name for d in details) == [f"bad{i}" for i in range(len(flagged))]
    assert {d.BelongsToPipeline for d in details} == {"p"}


CHAIN = [
    # C waits for A to succeed and B to fail, B itself waits for A; A is in both lists only if C waits for its failure.
    (True, [activity("A"), activity("B", ("A", "Succeeded")), activity("C", ("A", "Failed"), ("B", "Failed"))]),
    (False, [activity("A"), activity("B", ("A", "Succeeded")), activity("C", ("A", "Succeeded"), ("B", "Failed"))]),
    # A single dependency never starts the check.
    (False, [activity("A"), activity("B", ("A", "Succeeded")), activity("C", ("B", "Failed"))]),
    # Names ignore case, conditions do not.
    (True, [activity("a"), activity("b", ("A", "Succeeded")), activity("C", ("A", "Failed"), ("B", "Failed"))]),
    (False, [activity("A"), activity("B", ("A", "Succeeded")), activity("C", ("A", "failed"), ("B", "Failed"))]),
    # The lists span the pipeline: two different activities supply them.
    (
        True,
        [
            activity("A"),
            activity("B", ("A", "Succeeded")),
            activity("C", ("A", "Failed"), ("X", "Succeeded")),
            activity("D", ("B", "Failed"), ("X", "Succeeded")),
        ],
    ),
    (False, []),
]


@pytest.mark.parametrize("expected, activities", CHAIN)
def test_impossible_chain(corpus_of, expected, activities):
    assert found(corpus_of(pipeline_of(*activities)), 2) == (["p"] if expected else [])


def brute_force(activities):
    failed = {
        d["activity"].lower()
        for a in activities
        if len(a["dependsOn"]) > 1
        for d in a["dependsOn"]
        if "Failed" in d["dependencyConditions"]
    }
    succeeded = {
        d["activity"].lower()
        for a in activities
        if a["name"].lower() in failed
        for d in a["dependsOn"]
        if "Succeeded" in d["dependencyConditions"]
    }
    return bool(failed & succeeded)


NAMES = st.sampled_from(["A", "a", "B", "b", "C", "D", "E", "F", "G"])
EDGES = st.lists(st.tuples(NAMES, st.sampled_from(["Failed", "Succeeded", "Completed", "failed"])), max_size=3)
PIPELINES = st.lists(st.lists(st.tuples(NAMES, EDGES), max_size=6), min_size=30, max_size=60)


@settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(pipelines=PIPELINES)
def test_impossible_chain_against_brute_force(corpus_of, pipelines):
    built = [[activity(name, *edges) for name, edges in p] for p in pipelines]
    r = corpus_of({"a": [resource("pipelines", f"p{i}", {"activities": p}) for i, p in enumerate(built)]})
    assert found(r, 2) == sorted(f"p{i}" for i, p in enumerate(built) if brute_force(p))


def test_large_pipeline(corpus_of):
    # A chain of 3,000 activities, each waiting for the failure of one and the success of another.
    chain = [activity("a0"), activity("a1")]
    chain += [activity(f"a{i}", (f"a{i - 1}", "Failed"), (f"a{i - 2}", "Succeeded")) for i in range(2, 3000)]
    assert brute_force(chain)
    assert found(corpus_of(pipeline_of(*chain)), 2) == ["p"]


def test_large_pipeline_of_equal_names(corpus_of):
    # 10,000 activities of two names, each with two dependencies.
    same = [activity("A", ("B", "Succeeded"), (f"x{i}", "Failed")) for i in range(5000)]
    same += [activity("C", ("A", "Failed"), (f"y{i}", "Failed")) for i in range(5000)]
    assert not brute_force(same)
    assert found(corpus_of(pipeline_of(*same)), 2) == []
    both = [*same, activity("D", ("B", "Failed"), ("A", "Failed"))]
    assert brute_force(both)
    assert found(corpus_of(pipeline_of(*both)), 2) == ["p"]


def test_impossible_chain_stays_inside_its_pipeline(corpus_of):
    documents = {
        "a": [
            resource("pipelines", "p", {"activities": [activity("C", ("A", "Failed"), ("B", "Failed"))]}),
            resource("pipelines", "q", {"activities": [activity("B", ("A", "Succeeded"))]}),
        ]
    }
    assert found(corpus_of(documents), 2) == []


SECRET = {"type": "AzureKeyVaultSecret", "secretName": "s"}
SERVICES = [
    (False, {"type": "T", "typeProperties": {"connectionString": SECRET}}),
    (True, {"type": "T", "typeProperties": {"connectionString": "text"}}),
    (True, {"type": "T", "typeProperties": {"connectionString": {"secretName": ""}}}),
    # The alphabetically last member decides, ignoring case.
    (True, {"type": "T", "typeProperties": {"connectionString": SECRET, "url": "u"}}),
    (False, {"type": "T", "typeProperties": {"url": SECRET, "connectionString": "text"}}),
    (False, {"type": "T", "typeProperties": {"b": SECRET, "A": "text"}}),
    (True, {"type": "T", "typeProperties": {"B": "text", "a": SECRET}}),
    (False, {"type": "T", "typeProperties": {}}),
    (False, {"type": "T"}),
    (False, {"type": "azurekeyvault", "typeProperties": {"baseUrl": "u"}}),
    (True, {"typeProperties": {"x": 1}}),
]


@pytest.mark.parametrize("expected, properties", SERVICES)
def test_key_vault_rule(corpus_of, expected, properties):
    assert found(corpus_of({"a": [resource("linkedServices", "l", properties)]}), 11) == (["l"] if expected else [])


def test_unused_resources(corpus_of):
    documents = {
        "a": [
            resource("pipelines", "started"),
            resource("pipelines", "called"),
            resource("pipelines", "idle", depends_on=["pipelines/called", "datasets/read"]),
            resource("datasets", "read", depends_on=["linkedServices/l1"]),
            resource("datasets", "unread"),
            resource("linkedServices", "l1"),
            resource("linkedServices", "l2"),
            resource("triggers", "t1", depends_on=["pipelines/started"]),
            resource("triggers", "t2"),
            resource("integrationRuntimes", "never flagged"),
        ]
    }
    r = corpus_of(documents)
    assert [found(r, n) for n in (1, 12, 15, 19)] == [["idle"], ["l2"], ["unread"], ["t2"]]


def test_summary_keeps_all_checks_and_templates(corpus_of):
    documents = {"a": [resource("integrationRuntimes", "ir")], "b": [resource("pipelines", "p")], "c": []}
    r = corpus_of(documents)
    summary = C.c_summary(r, templates=corpus_of(documents, shred=False))
    assert rows(summary.groupBy("template_id").count()) == [("a", 21), ("b", 21), ("c", 21)]
    counts = {(s.template_id, s.CheckNo): s.IssueCount for s in summary.collect()}
    assert [n for n in C.ALL if counts["b", n]] == [1, 3, 4, 5]
    assert not any(v for (t, _), v in counts.items() if t != "b")
    assert rows(C.c_totals(summary)) == [("a", 21, 0, 0), ("b", 21, 4, 4), ("c", 21, 0, 0)]


def test_as_written_gives_check_14_the_count_of_check_5(corpus_of):
    documents = {
        "a": [
            resource("pipelines", "p1"),
            resource("pipelines", "p2"),
            resource("linkedServices", "l", {"annotations": []}),
        ]
    }
    r = corpus_of(documents)

    def count(as_written):
        return C.c_summary(r, as_written=as_written).filter("CheckNo = 14").first().IssueCount

    assert (count(False), count(True)) == (1, 2)


def test_texts_and_severities(corpus_of):
    detail = C.c03(corpus_of({"a": [resource("pipelines", "p")]})).first()
    number, component, severity, _, text = CHECKS[2]
    assert (detail.CheckNo, detail.Component, detail.Severity, detail.CheckDetail) == (number, component, severity, text)


EXPECTED_SMALL = {
    1: 1069, 2: 409, 3: 740, 4: 294, 5: 600, 6: 5, 7: 1968, 8: 290, 9: 720, 10: 1077, 11: 100, 12: 6, 13: 11, 14: 38,
    15: 101, 16: 100, 17: 49, 18: 61, 19: 31, 20: 58, 21: 43,
}


@pytest.fixture(scope="module")
def derived(spark):
    return corpus.resources(spark, SF)


def test_summary_counts_of_the_derived_corpus(derived):
    summary = C.c_summary(derived).groupBy("CheckNo").sum("IssueCount").collect()
    assert {r.CheckNo: r["sum(IssueCount)"] for r in summary} == EXPECTED_SMALL


def test_details_and_summary_agree(derived):
    details = C.c_details(derived).groupBy("template_id", "CheckNo").count()
    summary = C.c_summary(derived).filter("IssueCount > 0").select("template_id", "CheckNo", "IssueCount")
    assert rows(details) == rows(summary)


def test_unset_batch_count_fails_both_foreach_checks(derived):
    keys = ["template_id", "Name", "BelongsToPipeline"]
    assert C.c09(derived).select(*keys).exceptAll(C.c10(derived).select(*keys)).isEmpty()
