"""Dependency graph of the resources: string keys ``type|name``, compared ignoring case; one hop, and reach over any number."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import array_length, clean_name, clean_type
from plumbline.session import written


def mentions() -> Column:
    """Every key a resource mentions, as an array of ``(key, own)``.

    ``own`` marks a resource's own key; the others are targets of ``dependsOn``, and a trigger that depends on
    something mentions itself as used.
    """
    own_key = F.concat(clean_type("type"), F.lit("|"), clean_name("name"))

    def mention(key: Column, own: bool) -> Column:
        return F.struct(key.alias("key"), F.lit(own).alias("own"))

    none = F.array().cast("array<struct<key:string,own:boolean>>")
    targets = F.transform("dependsOn", lambda d: mention(F.replace(clean_name(d), F.lit("/"), F.lit("|")), False))
    used_trigger = (F.col("kind") == "triggers") & (array_length("dependsOn") >= 1)
    return F.concat(
        F.array(mention(own_key, True)),
        F.coalesce(targets, none),
        F.when(used_trigger, F.array(mention(own_key, False))).otherwise(none),
    )


def of_kinds(k: Column | str, kinds: tuple[str, ...]) -> Column:
    """Whether a lower-case key starts with one of ``kinds``."""
    return reduce(or_, [F.startswith(k, F.lit(kind)) for kind in kinds])


def _entries(resources: DataFrame, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Every mention in one pass: ``(template_id, k, key, own)``, ``k`` being the lower-case key, of some kinds or all."""
    rows = resources.select("template_id", F.inline(mentions())).withColumn("k", F.lower("key"))
    rows = rows.filter(F.col("k").isNotNull())
    return rows.filter(of_kinds("k", kinds)) if kinds else rows


def _once(entries: DataFrame) -> DataFrame:
    """One row per key and template, ignoring case."""
    return entries.groupBy("template_id", "k").agg(F.min("key").alias("key")).select("template_id", "key")


def g_resources(resources: DataFrame) -> DataFrame:
    return _once(_entries(resources).filter("own"))


def g_dependants(resources: DataFrame) -> DataFrame:
    return _once(_entries(resources).filter("NOT own"))


def redundant_resources(resources: DataFrame, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Resources that nothing depends on, each key once.

    An anti join of resources and targets would read the resources twice and shuffle both sides. Here the mentions
    are grouped once by (template, key): a target named by very many resources is one row per task before the
    shuffle, and a large template spreads over all tasks.
    """
    grouped = _entries(resources, kinds).groupBy("template_id", "k")
    unused = grouped.agg(F.bool_and("own").alias("unused"), F.min("key").alias("key")).filter("unused")
    return unused.select("template_id", "key")


def dependency_edges(resources: DataFrame) -> DataFrame:
    """Distinct ``(template_id, src, dst)``: a resource and what it depends on, as lower-case keys."""
    own = F.lower(F.concat(clean_type("type"), F.lit("|"), clean_name("name")))
    rows = resources.select("template_id", own.alias("src"), F.explode("dependsOn").alias("d"))
    dst = F.lower(F.replace(clean_name("d"), F.lit("/"), F.lit("|")))
    return rows.select("template_id", "src", dst.alias("dst")).dropna(subset=["src", "dst"]).distinct()


def reached(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """``(template_id, k)`` of all nodes that a path of ``edges`` leads to from any of ``sources``, these included.

    A node with a single incoming edge is reached exactly when the node before it is. Such nodes point to that node, and
    each round doubles the stretch they point over, so chains and trees of any depth are one hop after a logarithmic
    number of rounds. What is left are nodes where paths meet; a frontier walks over these, and each round joins only the
    nodes found in the round before. Edges may form cycles: a cycle that nothing enters is never reached.
    """
    spark, key = edges.sparkSession, ["template_id", "k"]
    start = written(sources.select(*key).distinct(), "reach-sources")
    into = edges.filter("src <> dst").withColumnRenamed("dst", "k").join(start, key, "left_anti")
    edges = written(into.withColumnRenamed("k", "dst").distinct(), "reach-edges")
    single = edges.groupBy("template_id", "dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("up")).filter("n = 1")
    hops = written(single.select("template_id", F.col("dst").alias("k"), "up"), "reach-hops")
    for _ in range(hops.count().bit_length() + 1):
        above = hops.select("template_id", F.col("k").alias("up"), F.col("up").alias("further"))
        moved = hops.join(above, ["template_id", "up"], "left")
        moved = written(moved.select(*key, F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("open")), "reach-hops")
        hops, unsettled = moved.select(*key, "up"), moved.filter("open")
        if unsettled.isEmpty():
            break
    # Edges between the nodes that chains begin at. A node inside a chain has no edge of its own any more.
    begin = hops.select("template_id", F.col("k").alias("src"), F.col("up").alias("begin"))
    inner = edges.join(hops.select("template_id", F.col("k").alias("dst")), ["template_id", "dst"], "left_anti")
    inner = inner.join(begin, ["template_id", "src"], "left")
    inner = written(inner.select("template_id", F.coalesce("begin", "src").alias("k"), "dst").distinct(), "reach-meetings")
    found, frontier = start, start
    while True:
        new = inner.join(frontier, key).select("template_id", F.col("dst").alias("k")).distinct().join(found, key, "left_anti")
        frontier = written(new, "reach-frontier")
        if frontier.isEmpty():
            break
        found = written(found.unionByName(frontier), "reach-found")
    below = hops.join(found.select("template_id", F.col("k").alias("up")), ["template_id", "up"]).select(*key)
    return found.unionByName(below)


def untriggered_pipelines(resources: DataFrame) -> DataFrame:
    """Pipelines that no trigger starts, directly or through other pipelines, each key once."""
    edges = written(dependency_edges(resources.select("template_id", "type", "name", "dependsOn")), "dependencies")
    pipeline, trigger = F.startswith("dst", F.lit("pipelines|")), F.startswith("src", F.lit("triggers|"))
    started = edges.filter(pipeline & trigger).select("template_id", F.col("dst").alias("k"))
    way = edges.filter(pipeline & F.startswith("src", F.lit("pipelines|")))
    own = _entries(resources, ("pipelines",)).filter("own").groupBy("template_id", "k").agg(F.min("key").alias("key"))
    return own.join(reached(way, started), ["template_id", "k"], "left_anti").select("template_id", "key")
