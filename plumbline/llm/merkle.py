"""Merkle manifest in van Emde Boas layout: blocks of aligned subtrees, recursing over the roots of blocks.

A tree over n leaves is cut into aligned blocks of up to ``2 ** HEIGHT`` leaves. The roots of its blocks are the leaves
of the next layer, which is cut in the same way, until one block is left. Inside a block, nodes lie in the van Emde Boas
order: the upper half of the levels first, then each lower subtree, all split again at half height. ``address`` gives
the place of a node from its depth and number alone; building and sibling retrieval both go by it.

The manifest is a stored table of blocks. Building takes one group of bounded size per block, and so does folding, where
the rows of a block meet the block's nodes and the path above it. A group of any size is many blocks.

The tree of a ``lang`` has its documents as leaves by doc_id. The roots of all languages, null first and then by their
UTF-8 bytes, are the leaves of the top tree. While a layer has several nodes, each two become their parent, and a node
left over becomes a parent alone. Digests are lower-case hex SHA-256; a parent hashes the text of its children.

Null values have a mark of their own (`-`), so they differ from empty texts. A null doc_id comes first, rows of equal
doc_id follow each other by their digest, repeated rows are leaves of their own. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.base import stored
from plumbline.llm.running import running

#: Levels below the root of a full block: 4096 leaves, 8191 nodes of 32 bytes.
HEIGHT = 12

BLOCKS = "tree string, layer int, block bigint, leaves int, nodes binary, root string"
NODES = "tree string, position bigint, digest string"
_TOP = "top"
#: A level of a path without a sibling.
_ALONE = "-" + 64 * " "


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(column: Column | str) -> Column:
    """A value with its length in bytes, or the mark of a null."""
    value = (F.col(f"`{column}`") if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*columns: Column | str) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


# Addresses inside a block


def address(depth: int, number: np.ndarray, levels: int) -> np.ndarray:
    """Place of nodes in the van Emde Boas order of a complete tree of ``levels``; the root has depth 0."""
    number = np.asarray(number, np.int64)
    place = np.zeros(len(number), np.int64)
    while levels > 1:
        upper = levels // 2
        lower = levels - upper
        if depth < upper:
            levels = upper
            continue
        depth -= upper
        place += (1 << upper) - 1 + (number >> depth) * ((1 << lower) - 1)
        number = number & ((1 << depth) - 1)
        levels = lower
    return place


@lru_cache(maxsize=64)
def _addresses(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(1 << depth), levels)


def levels_of(leaves: int) -> int:
    """Levels of the smallest complete tree with so many leaves."""
    return max(0, leaves - 1).bit_length() + 1


def build(leaves: list[str]) -> bytes:
    """Nodes of one block in van Emde Boas order, 32 bytes each; absent ones are zero."""
    levels = levels_of(len(leaves))
    nodes = bytearray(32 * ((1 << levels) - 1))

    def fill(base: int, levels: int, leaves: list[str]) -> str:
        """Fill a subtree whose first node lies at ``base``, and give its root."""
        if levels == 1:
            nodes[32 * base : 32 * base + 32] = bytes.fromhex(leaves[0])
            return leaves[0]
        upper = levels // 2
        lower = levels - upper
        width, size = 1 << (lower - 1), (1 << lower) - 1
        roots = [fill(base + (1 << upper) - 1 + k // width * size, lower, leaves[k : k + width]) for k in range(0, len(leaves), width)]
        return fill(base, upper, [digest("".join(roots[k : k + 2])) for k in range(0, len(roots), 2)])

    fill(0, levels, leaves)
    return bytes(nodes)


def siblings(nodes: bytes, leaves: int) -> list[list[str]]:
    """For each level from the leaves up, the sibling of each leaf's ancestor; empty where there is none."""
    levels = levels_of(leaves)
    text = nodes.hex()
    found, own = [], np.arange(leaves)
    for level in range(levels - 1):
        other = (own >> level) ^ 1
        there = other <= (leaves - 1) >> level
        at = _addresses(levels - 1 - level, levels)[np.where(there, other, 0)]
        found.append([text[64 * a : 64 * a + 64] if t else "" for a, t in zip(at, there, strict=True)])
    return found


def path_of(position: int, level_siblings: list[str]) -> str:
    """A path as text, 65 characters a level: R or L for the side of the sibling and its digest, ``-`` where there is none."""
    return "".join(("L" if position >> k & 1 else "R") + s if s else _ALONE for k, s in enumerate(level_siblings))


def fold(leaf: str, path: str) -> str:
    """The root that follows from a leaf and its path."""
    for k in range(0, len(path), 65):
        side, other = path[k], path[k + 1 : k + 65]
        leaf = digest(leaf if side == "-" else other + leaf if side == "L" else leaf + other)
    return leaf


def siblings_of(path: str) -> str:
    """The digests of a path one after the other."""
    return "".join(path[k + 1 : k + 65] for k in range(0, len(path), 65) if path[k] != "-")


# Building layer by layer


def _blocks(nodes: DataFrame, layer: int, height: int) -> DataFrame:
    """Blocks of one layer from its ``NODES``."""

    def run(rows: pa.Table) -> pa.Table:
        position = rows.column("position").to_numpy()
        order = np.argsort(position, kind="stable")
        leaves = rows.column("digest").take(pa.array(order)).to_pylist()
        data = build(leaves)
        cells = [
            pa.array([rows.column("tree")[0].as_py()]),
            pa.array([layer], pa.int32()),
            pa.array([int(position[0]) >> height]),
            pa.array([len(leaves)], pa.int32()),
            pa.array([data]),
            pa.array([data[:32].hex()]),
        ]
        return pa.Table.from_arrays(cells, ["tree", "layer", "block", "leaves", "nodes", "root"])

    dealt = nodes.withColumn("_block", F.shiftright("position", height))
    return dealt.groupBy("tree", "_block").applyInArrow(run, BLOCKS)


def _lone_levels(leaves: Column, blocks: Column, height: int) -> Column:
    """Levels by which the root of a last, smaller block is hashed alone until it is level with its neighbours."""
    own = F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)
    return F.when(blocks > 1, F.lit(height) - own).otherwise(F.lit(0))


def build_manifest(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """All layers of the trees of ``nodes`` (``NODES``, positions without gaps), each a stored table of ``BLOCKS``.

    Each layer also has ``lone``, the number of levels above its root that have no sibling inside the layer, ``up``, the
    root after them, and ``blocks``, the number of blocks of the tree. The last layer has one block for each tree.
    """
    layers: list[DataFrame] = []
    while True:
        found = stored(_blocks(nodes, len(layers), height), "merkle-blocks")
        count = found.groupBy("tree").agg(F.count(F.lit(1)).alias("blocks"))
        narrow = found.select("tree", "block", "leaves", "root").join(count, "tree")
        lone = _lone_levels(F.col("leaves"), F.col("blocks"), height)
        lifted = F.aggregate(F.sequence(F.lit(0), F.col("lone")), F.col("root"), lambda h, k: F.when(k == 0, h).otherwise(F.sha2(h, 256)))
        heads = stored(narrow.withColumn("lone", lone).withColumn("up", lifted).drop("leaves", "root"), "merkle-heads")
        layers.append(found.join(heads, ["tree", "block"]))
        above = heads.filter("blocks > 1")
        if above.isEmpty():
            return layers
        # Trees that are done stay out of the layers above.
        nodes = above.select("tree", F.col("block").alias("position"), F.col("up").alias("digest"))


def tree_roots(layers: list[DataFrame]) -> DataFrame:
    """(tree, root): the root of every tree."""
    found = [layer.filter("blocks = 1").select("tree", "root") for layer in layers]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# Paths and folding


def _visit(rows: DataFrame, blocks: DataFrame, height: int, each, schema: str) -> DataFrame:
    """Call ``each(rows of a block, their paths inside it, the block)``; the block has ``path``, from its root upwards."""
    kinds = pa.schema([(f.name, pa.int64() if f.dataType.typeName() == "long" else pa.string()) for f in StructType.fromDDL(schema)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return kinds.empty_table()
        block = right.to_pylist()[0]
        found = siblings(block["nodes"], block["leaves"])
        within = left.column("position").to_numpy() & ((1 << height) - 1)
        own = [path_of(int(k), [level[k] for level in found]) for k in within]
        return pa.Table.from_pylist(each(left.to_pylist(), own, block), kinds)

    dealt = rows.withColumn("block", F.shiftright("position", height))
    return dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, schema)


_PATHS = "tree string, position bigint, path string"


def _paths_of_rows(rows: list[dict], own: list[str], block: dict) -> list[dict]:
    return [{"tree": r["tree"], "position": r["position"], "path": p + block["path"]} for r, p in zip(rows, own, strict=True)]


def _above(layer: DataFrame, upper: DataFrame | None) -> DataFrame:
    """Blocks of a layer with ``path``: levels without sibling, then what ``upper`` (``_PATHS``) says of the layers above."""
    start = F.repeat(F.lit(_ALONE), F.col("lone"))
    if upper is None:
        return layer.withColumn("path", start)
    known = upper.select("tree", F.col("position").alias("block"), F.col("path").alias("_upper"))
    joined = layer.join(known, ["tree", "block"], "left")
    return joined.withColumn("path", F.concat(start, F.coalesce("_upper", F.lit("")))).drop("_upper")


def blocks_with_paths(layers: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """Blocks of the lowest layer with ``path``, from the block's root up to the root of its tree; from the top down."""

    upper = None
    for below, layer in zip(layers[-2::-1], layers[:0:-1], strict=True):
        places = below.filter("blocks > 1").select("tree", F.col("block").alias("position"))
        upper = stored(_visit(places, _above(layer, upper), height, _paths_of_rows, _PATHS), "merkle-paths")
    return _above(layers[0], upper)


def paths(nodes: DataFrame, layers: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """The path (``_PATHS``) of each of ``nodes`` (tree, position) up to the root of its tree."""

    return _visit(nodes.select("tree", "position"), blocks_with_paths(layers, height), height, _paths_of_rows, _PATHS)


# Manifests of documents


@dataclass
class Manifest:
    leaves: DataFrame  # tree, position and the columns handed in
    layers: list[DataFrame]  # of the trees of languages
    top: list[DataFrame]  # layers of the tree over their roots
    subroots: DataFrame  # tree, subroot, path from the subroot to the root
    root: str | None
    height: int

    def save(self, path: str) -> None:
        """Write all blocks as one table, by part and layer."""
        for part, layers in (("trees", self.layers), ("top", self.top)):
            for layer in layers:
                layer.withColumn("part", F.lit(part)).write.mode("append").partitionBy("part", "layer").parquet(path)


def tree_of(lang: Column | str) -> Column:
    """Name of the tree of a language: sorts as the language does, null first."""
    value = F.col(lang) if isinstance(lang, str) else lang
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def manifest(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """Manifest over ``leaves`` (tree, doc_id, leaf, and further narrow columns), by doc_id in each tree."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    narrow = stored(leaves.withColumn("_one", F.lit(1).cast("bigint")), "merkle-digests")  # texts are read once
    placed = stored(running(narrow, "tree", order, "_one", "position").drop("_one"), "merkle-leaves")
    layers = build_manifest(placed.select("tree", "position", F.col("leaf").alias("digest")), height)
    roots = tree_roots(layers).select(F.lit(_TOP).alias("all"), "tree", F.col("root").alias("subroot"), F.lit(1).cast("bigint").alias("_one"))
    ranked = stored(running(roots, "all", [F.col("tree").asc()], "_one", "position"), "merkle-subroots")
    nodes = ranked.select(F.lit(_TOP).alias("tree"), "position", F.col("subroot").alias("digest"))
    top = build_manifest(nodes, height)
    found = tree_roots(top).first()
    way = paths(nodes, top, height).select("position", "path")
    subroots = stored(ranked.select("tree", "position", "subroot").join(way, "position").drop("position"), "merkle-tops")
    return Manifest(placed, layers, top, subroots, found["root"] if found else None, height)


def proofs(kept: Manifest, claimed: str) -> DataFrame:
    """Fold the digest in column ``claimed`` of every leaf with its siblings up to the root.

    Gives doc_id, leaf, subroot, root, proof_sha256 (digest of the siblings' text), folded_root and verified.
    """

    def each(rows: list[dict], own: list[str], block: dict) -> list[dict]:
        above, heads, out = siblings_of(block["path"]), {}, []
        for row, path in zip(rows, own, strict=True):
            head = fold(row[claimed], path)
            if head not in heads:  # rows that are as they were share the way from the block's root up
                heads[head] = fold(head, block["path"])
            values = row["doc_id"], row["leaf"], block["subroot"], digest(siblings_of(path) + above), heads[head]
            out.append(dict(zip(("doc_id", "leaf", "subroot", "proof_sha256", "folded_root"), values, strict=True)))
        return out

    tops = kept.subroots.select("tree", "subroot", F.col("path").alias("_top"))
    blocks = blocks_with_paths(kept.layers, kept.height).join(tops, "tree").withColumn("path", F.concat("path", "_top"))
    schema = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"
    found = _visit(kept.leaves, blocks, kept.height, each, schema).withColumn("root", F.lit(kept.root))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
