"""Chat formatting: whole conversations with tool calls and results linked, ordered, validated and serialised; DataFrame operations only.

Every turn is an event with its whole text, and so is every call. Calls and results are joined by (conversation,
identifier). The first call and the first result of an identifier, by turn and place in the message, are the ones
linked; others are duplicates. A call may name any number of calls that must come before it. Its depth is the longest
path to it over a stored table of edges: along calls with one predecessor pointers are doubled, so long chains take few
rounds; calls where paths meet are solved when all of their predecessors are, a round for each on the longest path.

The order of a conversation is topological and as close to its turns as that allows: an event stands at the latest
turn of itself and all that must come before it, there by depth, and a message before calls, calls before results.
Positions are numbered by one range partitioning of narrow rows, so a conversation of any length is spread over many
tasks; texts are joined by row afterwards.

Arguments are parsed as JSON and checked against the parameters of their tool. Canonical JSON has sorted keys and no
blanks; absent members are left out.

Statuses: linked, unanswered (call), orphan (result without a call), duplicate, unidentified (null identifier), plain
(message). A call in or behind a cycle has no depth, status cyclic, and stands last. Predecessors
that are null or no call of the conversation are passed over, repeated ones count once, and a call behind itself is a
cycle. Null arguments are malformed; a null
tool is unknown. Null conversations are one conversation. A null role or text is left out of the JSON. Repeated rows are
duplicates of each other, or messages of their own. No messages, no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import shuffle_width, stored

_KEY = ["conv", "call_id"]


def events(messages: DataFrame) -> DataFrame:
    """One row per call, per result, and per other message of ``messages``.

    ``messages``: conv_id, turn, role, text, calls (array of id, name, arguments and after, an array of identifiers) and
    call_id, the identifier that a message of the role ``tool`` answers.
    """
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null")).alias("conv")
    none = lambda kind: F.lit(None).cast(kind)
    result = F.coalesce(F.col("role") == "tool", F.lit(False))
    said = F.struct(
        F.lit(0).alias("idx"), F.when(result, "result").otherwise("message").alias("kind"), F.when(result, F.col("call_id")).alias("call_id"),
        none("string").alias("tool"), F.when(~result, F.col("role")).alias("role"), F.col("text").alias("body"), none("array<string>").alias("after"),
    )
    called = F.transform(
        F.coalesce("calls", F.array().cast(messages.schema["calls"].dataType)),
        lambda c, k: F.struct(
            k.alias("idx"), F.lit("call").alias("kind"), c["id"].alias("call_id"), c["name"].alias("tool"), none("string").alias("role"),
            c["arguments"].alias("body"), c["after"].cast("array<string>").alias("after"),
        ),
    )
    rows = messages.select("conv_id", conv, "turn", F.explode(F.concat(F.array(said), called)).alias("event"))
    return stored(rows.select("conv_id", "conv", "turn", "event.*").withColumn("row", F.monotonically_increasing_id()), "events")


def _linked(found: DataFrame) -> DataFrame:
    """Calls and results with their status and the tool of the call that a result answers."""
    place = F.struct("turn", "idx", "row", "tool")
    first = found.filter("call_id IS NOT NULL").groupBy(*_KEY).agg(
        *[F.min(F.when(F.col("kind") == k, place)).alias(f"first_{k}") for k in ("call", "result")]
    )
    own = F.when(F.col("kind") == "call", F.col("first_call.row")).otherwise(F.col("first_result.row"))
    status = (
        F.when(F.col("kind") == "message", "plain")
        .when(F.col("call_id").isNull(), "unidentified")
        .when(F.col("first_call").isNull(), "orphan")
        .when(own != F.col("row"), "duplicate")
        .when(F.col("first_result").isNull(), "unanswered")
        .otherwise("linked")
    )
    joined = found.join(first, _KEY, "left")
    return joined.select(*found.columns, status.alias("status"), F.coalesce("tool", "first_call.tool").alias("tool_of_call"))


def _depths(linked: DataFrame) -> DataFrame:
    """(conv, call_id, depth, latest) of every identifier with a call: longest path and latest turn; null in and behind cycles."""
    calls = stored(linked.filter("kind = 'call' AND status IN ('linked', 'unanswered')").select(*_KEY, "turn", "after"), "calls")
    named = calls.select(*_KEY, F.explode(F.array_distinct("after")).alias("up"))
    edges = stored(named.join(calls.select("conv", F.col("call_id").alias("up")), ["conv", "up"]).select(*_KEY, "up"), "edges")
    count = edges.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min("up").alias("up"))
    # Pointers end at heads, calls without or with several predecessors. ``latest`` is that of the way, the head excluded.
    at = calls.select(*_KEY, "turn").join(count, _KEY, "left")
    single = F.coalesce(F.col("n") == 1, F.lit(False))
    at = at.select(
        *_KEY, "turn", F.when(single, F.col("up")).otherwise(F.col("call_id")).alias("head"), (~single).alias("ended"),
        F.when(single, 1).otherwise(0).cast("bigint").alias("steps"), F.col("turn").alias("latest"), F.coalesce("n", F.lit(0)).alias("n"),
    )
    heads = stored(at.filter("ended"), "heads")
    at, reach = stored(at.drop("turn", "n"), "pointers"), 1
    most = calls.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    while True:
        up = at.select("conv", F.col("call_id").alias("head"), F.col("head").alias("_head"), F.col("ended").alias("_ended"), F.col("steps").alias("_steps"), F.col("latest").alias("_latest"))
        moved = at.filter("NOT ended").join(up, ["conv", "head"]).select(
            *_KEY, F.col("_head").alias("head"), F.col("_ended").alias("ended"),
            (F.col("steps") + F.col("_steps")).alias("steps"), F.greatest("latest", "_latest").alias("latest"),
        )
        at, reach = stored(at.filter("ended").unionByName(moved), "pointers"), reach * 2
        if reach > most or at.filter("NOT ended").isEmpty():
            break
    # Heads with several predecessors wait until the heads of all of these are solved.
    ways = at.filter("ended").select("conv", F.col("call_id").alias("up"), "head", F.col("steps").alias("_steps"), F.col("latest").alias("_latest"))
    ways = stored(edges.join(heads.filter("n > 1").select(*_KEY, "turn", "n"), _KEY).join(ways, ["conv", "up"]), "ways")
    solved = stored(heads.filter("n = 0").select(*_KEY, F.lit(0).cast("bigint").alias("depth"), F.col("turn").alias("latest")), "solved")
    fresh = solved
    while not ways.isEmpty():
        above = fresh.select("conv", F.col("call_id").alias("head"), F.col("depth").alias("_depth"), F.col("latest").alias("_above"))
        tried = ways.join(above, ["conv", "head"], "left")
        # A way whose head is solved now holds its length and turn, and has no head any more.
        known = F.col("_depth").isNotNull()
        ways = stored(
            tried.select(
                *_KEY, "up", "turn", "n", F.when(~known, F.col("head")).alias("head"),
                (F.col("_steps") + F.coalesce("_depth", F.lit(0))).alias("_steps"),
                F.when(known, F.greatest("_latest", "_above")).otherwise(F.col("_latest")).alias("_latest"),
            ), "ways",
        )
        state = ways.groupBy(*_KEY, "n").agg(
            F.count("head").alias("waiting"), F.count(F.lit(1)).alias("found"), F.max("_steps").alias("_steps"), F.greatest(F.max("turn"), F.max("_latest")).alias("latest")
        )
        done = state.filter("waiting = 0 AND found = n").select(*_KEY, (F.col("_steps") + 1).alias("depth"), "latest")
        fresh = stored(done, "fresh")
        if fresh.isEmpty():
            break
        solved = solved.unionByName(fresh)
        ways = ways.join(fresh.select(*_KEY), _KEY, "left_anti")
    solved = stored(solved, "solved")
    above = solved.select("conv", F.col("call_id").alias("head"), F.col("depth").alias("_depth"), F.col("latest").alias("_above"))
    found = at.filter("ended").join(above, ["conv", "head"]).select(*_KEY, (F.col("steps") + F.col("_depth")).alias("depth"), F.greatest("latest", "_above").alias("latest"))
    return calls.select(*_KEY).join(found, _KEY, "left")


def _positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``position``, from 0 within each conversation, by ``order``."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(shuffle_width(spark), "conv", *order).sortWithinPartitions("conv", *order)
    dealt = stored(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    within = F.col("_at") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per task
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = dealt.join(before, "_part").withColumn("_rank", F.col("_before") + within)
    first = ranked.groupBy("conv").agg(F.min("_rank").alias("_first"))
    return ranked.join(first, "conv").select(*rows.columns, (F.col("_rank") - F.col("_first")).alias("position"))


def validate(arguments: Column, parameters: Column) -> Column:
    """Faults of JSON ``arguments`` by ``parameters``: array of (param, type, required, minimum, maximum, choices).

    Types are string, integer, number, boolean, array and object. A null array of parameters is an unknown tool.
    """
    parsed = F.try_parse_json(arguments)
    members = F.try_variant_get(parsed, "$", "map<string,variant>")
    value = lambda p: F.try_element_at(members, p["param"])
    kind = lambda p: F.schema_of_variant(value(p))
    fits = {
        "string": lambda k: k == "STRING",
        "integer": lambda k: k == "BIGINT",
        "number": lambda k: (k == "BIGINT") | (k == "DOUBLE") | k.startswith("DECIMAL"),
        "boolean": lambda k: k == "BOOLEAN",
        "array": lambda k: k.startswith("ARRAY"),
        "object": lambda k: k.startswith("OBJECT"),
    }

    def faults(p: Column) -> Column:
        present = F.array_contains(F.map_keys(members), p["param"])
        right = reduce(lambda a, t: a | ((p["type"] == t) & fits[t](kind(p))), fits, F.lit(False))
        number = F.try_variant_get(value(p), "$", "double")
        name = lambda fault: F.concat(F.lit(f"{fault}:"), p["param"])
        return (
            F.when(~present, F.when(p["required"], name("missing")))
            .when(~F.coalesce(right, F.lit(False)), name("type"))
            .when((number < p["minimum"]) | (number > p["maximum"]), name("range"))
            .when(~F.array_contains(p["choices"], F.try_variant_get(value(p), "$", "string")), name("choice"))
        )

    listed = F.transform(parameters, lambda p: p["param"])
    stray = F.transform(F.filter(F.map_keys(members), lambda k: ~F.array_contains(listed, k)), lambda k: F.concat(F.lit("unknown:"), k))
    found = F.concat(F.filter(F.transform(parameters, faults), lambda x: x.isNotNull()), stray)
    return (
        F.when(parsed.isNull(), F.array(F.lit("malformed")))
        .when(parameters.isNull(), F.array(F.lit("unknown tool")))
        .when(members.isNull(), F.array(F.lit("no object")))
        .otherwise(F.array_sort(found))
    )


def format_tool_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Ordered events of all conversations: conv_id, position, kind, call_id, tool, depth, status, faults, json.

    ``schemas`` has a row per parameter: tool, param, type, required, minimum, maximum, choices.
    """
    found = events(messages)
    linked = stored(_linked(found.drop("body", "role")), "linked")
    depths = _depths(linked).withColumn("placed", F.lit(True))
    rows = linked.join(depths, _KEY, "left")
    cyclic = F.coalesce(F.col("placed") & F.col("depth").isNull(), F.lit(False))
    rows = rows.withColumn("status", F.when(cyclic, "cyclic").otherwise(F.col("status")))
    rows = rows.select(
        "conv_id", "conv", "turn", "idx", "kind", "call_id", "tool_of_call", "depth", "status", "row",
        cyclic.alias("_last"), F.when(~cyclic, F.greatest("turn", "latest")).alias("_turn"), F.coalesce("depth", F.lit(0)).alias("_depth"),
        F.expr("CASE kind WHEN 'message' THEN 0 WHEN 'call' THEN 1 ELSE 2 END").alias("_kind"),
    )
    ordered = _positions(rows, ["_last", "_turn", "_depth", "_kind", "turn", "idx", "row"])
    ordered = ordered.join(found.select("row", "role", "body"), "row")
    shape = F.struct("param", "type", "required", "minimum", "maximum", "choices")
    tools = schemas.groupBy(F.col("tool").alias("tool_of_call")).agg(F.sort_array(F.collect_list(shape)).alias("parameters"))  # of a schema
    checked = ordered.join(tools, "tool_of_call", "left")
    call = F.col("kind") == "call"
    checked = checked.withColumn("faults", F.when(call, validate(F.col("body"), F.col("parameters"))).otherwise(F.array().cast("array<string>")))
    parsed = F.try_parse_json("body")
    # Members in the order of their names; what is no JSON stays text.
    text = F.struct(
        F.when(call, parsed).alias("arguments"),
        F.when(~call | parsed.isNull(), F.col("body")).alias("content"),
        F.col("call_id").alias("id"),
        F.col("tool_of_call").alias("name"),
        "role",
        F.col("kind").alias("type"),
    )
    return checked.select(
        "conv_id", "position", "kind", "call_id", F.col("tool_of_call").alias("tool"), "depth", "status", "faults", F.to_json(text).alias("json")
    )
