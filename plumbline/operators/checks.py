"""The 21 template checks: details, per-template summary and totals.

Checks on a single resource are evaluated inside its row, so one scan serves all of them and nothing is shuffled before
the final count. Checks on activities have a branch that reads nothing else, one row per activity. Only checks 1, 12, 15
and 19 need the dependency graph: details read it in a branch of the narrow columns ``name, type, dependsOn``, the
summary in the pass over resources. No check needs a join.

Names are compared ignoring case, dependency conditions are not. "Missing" is null or empty, a missing array has
length 0, and an unset batch count fails both check 9 and check 10.

Two checks of the original look at the wrong object: 14 counts *pipelines* without annotations, and 20 names its
findings after the last pipeline. Here both do what their text says; ``c_summary(as_written=True)`` gives check 14
the original's count, which is that of check 5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.constants import CHECKS, DEFAULT_TIMEOUT, FOREACH_BATCH_MAXIMUM
from plumbline.functions.text import clean_name, key_name
from plumbline.operators.graph import mentions, redundant_resources, untriggered_pipelines
from plumbline.operators.templates import ACTIVITY_DDL, is_stored, resources_of_type, with_properties

ALL = tuple(number for number, *_ in CHECKS)

# Rules are SQL conditions over the parsed properties ``p`` or the activity ``a``.
_NO_DESCRIPTION = "coalesce(p.description, '') = ''"
_NO_FOLDER = "coalesce(p.folder.name, '') = ''"
_NO_ANNOTATIONS = "coalesce(array_size(p.annotations), 0) <= 0"
_PARALLEL_FOREACH = "lower(a.type) = 'foreach' AND lower(coalesce(a.typeProperties.isSequential, '')) <> 'true'"

ACTIVITY_RULES = {
    7: f"a.policy.timeout = '{DEFAULT_TIMEOUT}'",
    8: "coalesce(a.description, '') = ''",
    9: f"{_PARALLEL_FOREACH} AND coalesce(a.typeProperties.batchCount, '') = ''",
    10: f"""{_PARALLEL_FOREACH}
            AND coalesce(try_cast(a.typeProperties.batchCount AS INT), 0) < {FOREACH_BATCH_MAXIMUM}""",
}

# Check 2 inside one pipeline row. An activity with several dependencies waits for the failure of some upstream U; if
# U itself waits for the success of another upstream in that same failure list, the chain can never run. Both lists
# span the pipeline.
_UPSTREAM = "transform(filter(a.dependsOn, d -> array_contains(d.dependencyConditions, '{}')), d -> lower(d.activity))"
_FAILED = f"""array_compact(array_distinct(flatten(transform(
    filter(p.activities, a -> array_size(a.dependsOn) > 1), a -> {_UPSTREAM.format("Failed")}))))"""


def _impossible(rows: DataFrame) -> DataFrame:
    """Add the flag ``impossible`` of check 2 to rows with activities, near linear in their number.

    Activities are sorted by name and those of one name put together. They are sorted again with the failure list: a
    name is in the list if the entry before it is the same name from there. A pipeline without a failure list, the usual
    case, is done before any of this.
    """
    waits_for = _UPSTREAM.format("Succeeded")
    rows = rows.selectExpr("*", f"IF(exists(p.activities, a -> array_size(a.dependsOn) > 1), {_FAILED}, NULL) AS failed")
    rows = rows.selectExpr(
        "*",
        f"""IF(coalesce(array_size(failed), 0) > 0, sort_array(transform(p.activities,
            a -> struct(lower(a.name) AS name, {waits_for} AS upstream))), NULL) AS sorted""",
    )
    rows = rows.selectExpr(
        "*",
        """IF(sorted IS NULL, NULL, filter(sequence(0, array_size(sorted) - 1),
            i -> i = 0 OR NOT get(sorted, i).name <=> get(sorted, i - 1).name)) AS starts""",
    )
    named = """transform(starts, (s, k) -> struct(get(sorted, s).name AS name, true AS waits, flatten(transform(
        slice(sorted, s + 1, coalesce(get(starts, k + 1), array_size(sorted)) - s), x -> x.upstream)) AS upstream))"""
    listed = "transform(failed, n -> struct(n AS name, false AS waits, CAST(array() AS ARRAY<STRING>) AS upstream))"
    rows = rows.selectExpr("*", f"IF(sorted IS NULL, NULL, sort_array(concat({listed}, {named}))) AS together")
    succeeded = """transform(filter(together, (x, i) -> x.waits AND NOT get(together, i - 1).waits
                                             AND get(together, i - 1).name = x.name), x -> x.upstream)"""
    overlap = f"IF(sorted IS NULL, false, coalesce(arrays_overlap(failed, array_compact(flatten({succeeded}))), false)) AS impossible"
    return rows.selectExpr("*", overlap).drop("failed", "sorted", "starts", "together")


# Check 11: the alphabetically last member has no secretName. Only the flag leaves the row, never the secret; a
# service without members is not flagged.
_LAST_MEMBER_LACKS_SECRET = """lower(coalesce(p.type, '')) <> 'azurekeyvault' AND coalesce(array_max(transform(
    map_entries(p.typeProperties),
    e -> struct(lower(e.key) AS k,
                coalesce(get_json_object(e.value, '$.secretName'), '') = '' AS lacks))).lacks, false)"""

# One rule per check on a resource, by kind.
RESOURCE_RULES = {
    "pipelines": {2: "impossible", 3: _NO_DESCRIPTION, 4: _NO_FOLDER, 5: _NO_ANNOTATIONS},
    "dataflows": {6: _NO_DESCRIPTION},
    "linkedservices": {11: _LAST_MEMBER_LACKS_SECRET, 13: _NO_DESCRIPTION, 14: _NO_ANNOTATIONS},
    "datasets": {16: _NO_DESCRIPTION, 17: _NO_FOLDER, 18: _NO_ANNOTATIONS},
    "triggers": {20: _NO_DESCRIPTION, 21: _NO_ANNOTATIONS},
}

# Checks that read the dependency graph: check number by kind.
GRAPH_RULES = {"pipelines": 1, "linkedservices": 12, "datasets": 15, "triggers": 19}

# Members each check reads; only those are parsed.
_MEMBERS = {
    "description STRING": {3, 6, 13, 16, 20},
    "folder STRUCT<name STRING>": {4, 17},
    "annotations ARRAY<STRING>": {5, 14, 18, 21},
    f"activities ARRAY<{ACTIVITY_DDL}>": {2},
    "type STRING": {11},
    "typeProperties MAP<STRING, STRING>": {11},
}


def _kinds_of(checks: set[int]) -> list[str]:
    return sorted(kind for kind, rules in RESOURCE_RULES.items() if checks & rules.keys())


def _parsed(resources: DataFrame, checks: set[int]) -> DataFrame:
    """Resources with just the members that ``checks`` read."""
    ddl = ", ".join(member for member, users in _MEMBERS.items() if users & checks)
    stored = [c for c in ("activities",) if c in resources.columns]
    rows = resources.select("template_id", "kind", "name", "type", "dependsOn", "properties", *stored)
    rows = with_properties(rows, ddl)
    if 2 in checks:
        rows = _impossible(rows)
    return rows


def _graph_check(checks: set[int]) -> tuple[tuple[str, ...], Column]:
    """Kinds the wanted graph checks look at, and the check number of a lower-case key ``k``."""
    wanted = {kind: check for kind, check in GRAPH_RULES.items() if check in checks}
    cases = " ".join(f"WHEN startswith(k, '{kind}') THEN {check}" for kind, check in wanted.items())
    return tuple(wanted), F.expr(f"CASE {cases} END")


def _graph_findings(resources: DataFrame, checks: set[int], indirect: bool) -> DataFrame:
    kinds, number = _graph_check(checks - {1} if indirect else checks)
    found = [redundant_resources(resources, kinds)] if kinds else []
    if indirect and 1 in checks:
        found.append(untriggered_pipelines(resources))
        _, number = _graph_check(checks)
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("k", F.lower("key"))
        .select(
            "template_id",
            number.alias("CheckNo"),
            key_name("key").alias("Name"),
            F.lit(None).cast("string").alias("BelongsToPipeline"),
        )
    )


def _finding(check: int, condition: str, name: str, pipeline: str) -> str:
    return f"CASE WHEN {condition} THEN struct({check} AS CheckNo, {name} AS Name, {pipeline} AS BelongsToPipeline) END"


def _row_findings(resources: DataFrame, checks: set[int]) -> DataFrame:
    """Findings on resources themselves."""
    rows = _parsed(resources_of_type(resources, *_kinds_of(checks)), checks).withColumn("own_name", clean_name("name"))
    found = [
        _finding(check, f"kind = '{kind}' AND {rule}", "own_name", "CAST(NULL AS STRING)")
        for kind, rules in RESOURCE_RULES.items()
        for check, rule in rules.items()
        if check in checks
    ]
    return rows.selectExpr("template_id", f"inline(array_compact(array({', '.join(found)})))")


def _activities(resources: DataFrame) -> DataFrame:
    """One row ``a`` per activity, so that rules on activities run in generated code and not inside a lambda."""
    rows = with_properties(resources_of_type(resources, "pipelines"), f"activities ARRAY<{ACTIVITY_DDL}>")
    return rows.select("template_id", "name", F.explode("p.activities").alias("a"))


def _activity_findings(resources: DataFrame, checks: set[int]) -> DataFrame:
    found = [_finding(n, rule, "a.name", "own_name") for n, rule in ACTIVITY_RULES.items() if n in checks]
    rows = _activities(resources).withColumn("own_name", clean_name("name"))
    return rows.selectExpr("template_id", f"inline(array_compact(array({', '.join(found)})))")


def c_details(resources: DataFrame, checks: Iterable[int] = ALL, indirect: bool = False) -> DataFrame:
    """One row per finding, with the pipeline of an activity.

    Check 1 names the pipelines that nothing depends on. With ``indirect`` it names those that no trigger starts, neither
    directly nor through other pipelines, however long the way.
    """
    wanted, graph, inside = set(checks), set(GRAPH_RULES.values()), set(ACTIVITY_RULES)
    branches = []
    if wanted - graph - inside:
        branches.append(_row_findings(resources, wanted - graph - inside))
    if wanted & inside:
        branches.append(_activity_findings(resources, wanted & inside))
    if wanted & graph:
        branches.append(_graph_findings(resources, wanted, indirect))
    findings = reduce(DataFrame.unionByName, branches)
    return findings.selectExpr(
        "template_id",
        "CheckNo",
        f"{_text_of(1)} AS Component",
        "Name",
        f"{_text_of(4)} AS CheckDetail",
        f"{_text_of(2)} AS Severity",
        "BelongsToPipeline",
    )


def _text_of(position: int) -> str:
    """Fixed text of a check, picked from a literal array by its number."""
    return f"element_at(array({', '.join(repr(check[position]) for check in CHECKS)}), CheckNo)"


def _tallies(inside: bool) -> str:
    """Findings of one parsed resource as (check, n), by the rules of its kind; with those on its activities if ``inside``."""
    cases = []
    for kind, rules in RESOURCE_RULES.items():
        counts = [f"struct({check} AS c, CAST({rule} AS BIGINT) AS n)" for check, rule in rules.items()]
        if inside and kind == "pipelines":
            counts += [
                f"struct({check} AS c, CAST(array_size(filter(p.activities, a -> {rule})) AS BIGINT) AS n)"
                for check, rule in ACTIVITY_RULES.items()
            ]
        cases.append(f"WHEN '{kind}' THEN array({', '.join(counts)})")
    return f"CASE kind {' '.join(cases)} END"


def _counts(resources: DataFrame) -> DataFrame:
    """Findings per template as one column per check, from a pass over the resources.

    Activities of stored resources have a pass of their own, over their column alone; JSON text is parsed just once.

    A resource gives a narrow entry for each check with a finding, whose key is null, one for every key it mentions,
    and one for being there, so that a template without findings keeps its row of zeros. Entries are summed by
    (template, key, check), which tells the keys that nothing depends on, and then by template.
    """
    kinds, stored = tuple(GRAPH_RULES), is_stored(resources)
    graph = " OR ".join(f"startswith(m.k, '{kind}')" for kind in kinds)
    rows = _parsed(resources, set(ALL) - set(GRAPH_RULES.values()) - set(ACTIVITY_RULES))
    rows = rows.withColumn("mentioned", mentions()).withColumn("tallies", F.expr(_tallies(inside=not stored)))
    nothing = "CAST(NULL AS STRING) AS k, CAST(NULL AS BOOLEAN) AS own"
    rows = rows.selectExpr(
        "template_id",
        f"""inline(concat(
            array(struct({nothing}, 0 AS c, 0L AS n)),
            transform(filter(transform(mentioned, m -> struct(lower(m.key) AS k, m.own AS own)), m -> {graph}),
                      m -> struct(m.k AS k, m.own AS own, 0 AS c, 0L AS n)),
            transform(filter(coalesce(tallies, array()), t -> t.n > 0), t -> struct({nothing}, t.c AS c, t.n AS n))))""",
    )
    by_key = rows.groupBy("template_id", "k", "c").agg(F.bool_and("own").alias("unused"), F.sum("n").alias("n"))
    _, number = _graph_check(set(ALL))
    found = by_key.select(
        "template_id",
        F.when(F.col("k").isNull(), F.col("c")).when(F.col("unused"), number).otherwise(0).alias("c"),
        F.when(F.col("k").isNull(), F.col("n")).otherwise(1).alias("n"),
    )
    if stored:
        one = [f"CASE WHEN {rule} THEN struct({check} AS c, 1L AS n) END" for check, rule in ACTIVITY_RULES.items()]
        found = found.unionByName(_activities(resources).selectExpr("template_id", f"inline(array_compact(array({', '.join(one)})))"))
    sums = [F.sum(F.when(F.col("c") == check, F.col("n"))).alias(f"c{check}") for check in ALL]
    return found.groupBy("template_id").agg(*sums)


def c_summary(resources: DataFrame, as_written: bool = False, templates: DataFrame | None = None) -> DataFrame:
    """All 21 checks of every template, zero counts included.

    ``templates`` adds templates that hold no resources at all.
    """
    totals = _counts(resources)
    if templates is not None:
        totals = totals.unionByName(templates.select("template_id"), allowMissingColumns=True)
        totals = totals.groupBy("template_id").agg(*[F.sum(f"c{check}").alias(f"c{check}") for check in ALL])
    totals = totals.fillna(0)
    rows = ", ".join(
        f"struct({number} AS CheckNo, c{5 if as_written and number == 14 else number} AS IssueCount,"
        f" {summary!r} AS CheckDetail, {severity!r} AS Severity)"
        for number, _, severity, summary, _ in CHECKS
    )
    return totals.selectExpr("template_id", f"inline(array({rows}))")


def c_totals(summary: DataFrame) -> DataFrame:
    """Checks run, checks with issues and issues found, per template."""
    return summary.groupBy("template_id").agg(
        F.count("*").alias("checks_run"),
        F.count_if(F.col("IssueCount") != 0).alias("checks_with_issues"),
        F.sum("IssueCount").alias("total_issues"),
    )


def check(number: int) -> Callable[[DataFrame], DataFrame]:
    """The operator for one check: its detail rows."""

    def run(resources: DataFrame) -> DataFrame:
        return c_details(resources, {number})

    run.__name__ = f"c{number:02d}"
    run.__doc__ = CHECKS[number - 1][3]
    return run


(
    c01, c02, c03, c04, c05, c06, c07, c08, c09, c10, c11,
    c12, c13, c14, c15, c16, c17, c18, c19, c20, c21,
) = (check(number) for number in ALL)
