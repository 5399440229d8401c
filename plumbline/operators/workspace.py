"""Workspace tree and its export list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import language_extension, language_format
from plumbline.session import written


def workspace_tree(items: DataFrame, root: str = "/") -> DataFrame:
    """Notebooks and libraries reachable from ``root`` through listed directories, each once.

    ``items(path, parent, object_type, language)``. Every directory points to its parent, and each round points it to
    where its target pointed, so the stretch doubles and a tree of depth n takes about log2(n) rounds of one written
    table. Directories whose way ends outside the list drop out. A way that never ends and begins below ``root``
    lies in a cycle, which is named in an error.
    """
    directories = items.filter(F.col("object_type") == "DIRECTORY").select("path", "parent").distinct()
    ways = written(directories.filter(F.col("path") != root).select("path", F.col("parent").alias("up")), "tree-ways")
    ended = F.col("up") == root
    for _ in range(ways.count().bit_length() + 1):
        further = ways.select(F.col("path").alias("up"), F.col("up").alias("further"))
        longer = ways.filter(~ended).join(further, "up").select("path", F.col("further").alias("up"))
        ways = written(ways.filter(ended).unionByName(longer).distinct(), "tree-ways")
        if ways.filter(~ended).isEmpty():
            break
    below = ways.filter(ended).select("path")
    reached = below.union(items.sparkSession.range(1).select(F.lit(root).alias("path")))
    endless = ways.filter(~ended).select("path").join(below, "path", "left_semi")
    again = directories.filter(F.col("path") == root).join(reached.withColumnRenamed("path", "parent"), "parent", "left_semi")
    cycle = endless.union(again.select("path")).agg(F.min("path")).first()[0]
    if cycle is not None:
        raise ValueError(f"directory {cycle} lies in a cycle")
    leaves = items.filter(F.col("object_type").isin("NOTEBOOK", "LIBRARY"))
    found = leaves.join(reached.withColumnRenamed("path", "parent"), "parent")
    return found.select("path", "language", F.col("object_type").alias("type"))


def export_manifest(tree: DataFrame, out_root: str) -> DataFrame:
    """Target path and format of each notebook; libraries are listed as skipped, unknown languages have no row."""
    library = F.col("type") == "LIBRARY"
    extension = language_extension("language")
    return tree.filter(library | extension.isNotNull()).select(
        "path",
        F.when(~library, F.concat(F.lit(out_root), "path", extension)).alias("target"),
        F.when(~library, language_format("language")).alias("format"),
        F.when(library, "skipped").otherwise("export").alias("action"),
    )
