"""N-gram Jaccard join by chosen paths.

Texts are sets of word shingles, embedded as ``WIDTH`` minhash values: each value is a token sampled from the set so
that two sets share it with a probability equal to their similarity. A run splits all sets recursively: a node of the
recursion tree chooses values by a hash of its path, 1 / threshold of them on average, and sends each set to one
bucket per chosen value. Small buckets are joined by brute force, large ones are split again. Pairs at the threshold
keep a constant chance per level, others lose theirs, and the runs are as many as the target recall needs at the
greatest depth.

Texts with equal sets are one representative from the start. A bucket is joined by brute force when it is small, when
splitting no longer makes it smaller (its members are alike), or at ``DEPTH``. A group of alike sets lies in a large
bucket of every run: its sets form one cluster, named by the least set of their large buckets, and pairs within a
cluster are taken once, not once per bucket. They are compared by what sets A, B differ in from the cluster's first L:
with differences dA, dB, |A n B| = |L| - |L - A| - |L - B| + |dA n dB|, which is exact for any L and short for
near copies. Clusters are cut into tiles of about ``TILE`` sets, and each pair of tiles is a cell of its own.

Buckets are left with pairs of different clusters: those of one cluster only are gone, and in others the sets of the
most frequent cluster meet just the rest, in chunks of about ``SMALL``. Members without a partner there by the sampled
values (at ``DOUBT`` standard errors below the threshold) leave; the others are compared exactly, on sets of 64-bit
hashes. A pair counts in the first bucket it shares only, so links are counted without being written out: a cell
returns the number of links per set and, to connect classes, at most one or two edges per set.

Classes are the connected components of links, by alternating star contraction on stored edges. Sets are known by a
64-bit hash; about 10^9 different sets share one by chance with a probability of 0.03.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. A text of fewer words than ``n``, but
not none, is a set of one shingle. Null texts are empty; texts without words have no links, and equal ones are one
class. A null ``doc_id`` keeps its row. Repeated rows are copies of each other. An empty table has no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import as_arrays, by_slices, release, slices, stored, utf8, whole_rows
from plumbline.llm.words import mix, windows, words_of

WIDTH = 64
DEPTH = 4
#: Members of a bucket that are compared with each other at once.
SMALL = 256
#: Sets of a cluster that are compared with each other at once.
TILE = 1024
RECALL = 0.999
#: A part that holds this share of its bucket shows that the members are alike.
ALIKE = 0.8
DOUBT = 4.0
#: Bits of the filter that tells which texts are read again; its size is fixed, false hits only cost their way.
FILTER_BITS = 1 << 24


def _mixed_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(mix(values), first)


def _sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingles of all texts, the bounds of each text's, and the hash of each set, or of a text without words."""
    data, at = as_arrays(batch.column("text"))
    value, _, text = windows(words_of(data, at), n)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[fresh], text[fresh]
    size = np.bincount(text, minlength=batch.num_rows)
    bounds = np.concatenate([[0], np.cumsum(size)])
    rep = np.zeros(batch.num_rows, np.uint64)
    some = size > 0
    if some.any():
        rep[some] = _mixed_sums(value, bounds[:-1][some])
    for k in np.flatnonzero(~some):  # a rare case: bytes as one number each
        rep[k] = mix(np.array([zlib.crc32(data[at[k] : at[k + 1]].tobytes()) + ((at[k + 1] - at[k]) << 32)], np.uint64))[0]
    return value, bounds, mix(rep ^ size.astype(np.uint64))


def _sampled(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minhash values of each set, texts by WIDTH, 32 bits each."""
    out = np.zeros((len(bounds) - 1, WIDTH), np.uint32)
    some = np.diff(bounds) > 0
    if some.any():
        for k in range(WIDTH):
            keyed = (value ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
            keyed ^= keyed >> np.uint64(32)
            out[some, k] = mix(np.minimum.reduceat(keyed, bounds[:-1][some])) >> np.uint64(32)
    return out


def representatives(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, rep, size, sampled) of each row: the hash of its set of shingles, their number, the sampled values."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, bounds, rep = _sets(batch, n)
        sampled = [row.tobytes() for row in _sampled(value, bounds)]
        columns = [batch.column("doc_id"), pa.array(rep.view(np.int64)), pa.array(np.diff(bounds).astype(np.int32)), pa.array(sampled, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "rep", "size", "sampled"])

    rows = docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("text"))
    return by_slices(rows, "text", each, "doc_id bigint, rep bigint, size int, sampled binary")


def set_hashes(batch: pa.RecordBatch, n: int) -> np.ndarray:
    """The hash of each text's set of shingles, as ``representatives`` gives it."""
    return _sets(batch, n)[2].view(np.int64)


def shingles_of(docs: DataFrame, n: int, reps: DataFrame) -> DataFrame:
    """(rep, shingles) of the sets in ``reps``, once each. A bitmap keeps most other texts out of the shuffle."""
    bit = F.pmod(F.col("rep"), F.lit(FILTER_BITS))
    words = reps.groupBy(F.floor(bit / 32).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(rep, {FILTER_BITS}) % 32 AS INT))")).alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in words.collect():  # at most FILTER_BITS / 32 rows
        bitmap[row["at"]] = row["bits"]
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, bounds, rep = _sets(batch, n)
        at = (rep.view(np.int64) % FILTER_BITS).astype(np.int64)
        _, first = np.unique(rep, return_index=True)  # copies in a slice are read once
        hit = first[(sent.value[at[first] >> 5] >> (at[first] & 31).astype(np.uint32)) & np.uint32(1) == 1]
        sets = [value[bounds[k] : bounds[k + 1]].tobytes() for k in hit]
        return pa.RecordBatch.from_arrays([pa.array(rep.view(np.int64)[hit]), pa.array(sets, pa.binary())], ["rep", "shingles"])

    found = by_slices(docs.select(utf8("text").alias("text")), "text", each, "rep bigint, shingles binary")
    return found.join(reps, "rep", "left_semi").groupBy("rep").agg(F.first("shingles").alias("shingles"))


def runs_needed(threshold: float, depth: int, recall: float) -> int:
    """Runs until a pair at the threshold is found with probability ``recall``, if all buckets are ``depth`` deep."""
    found = 1.0
    for _ in range(depth):
        # Values chosen are about Poisson with mean 1 / threshold, each shared with probability ``threshold``.
        found = 1 - math.exp(-found)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def _split(rows: DataFrame, threshold: float) -> DataFrame:
    """(bucket, path, rep) for (rep, sampled, paths): a row per value that a path chooses.

    Buckets are known by a 63-bit hash of the path, the number of the value, and the value.
    """
    chosen = 2.0**53 / (threshold * WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = as_arrays(batch.column("sampled"))[0].view(np.uint32).reshape(-1, WIDTH).astype(np.uint64)
            listed = batch.column("paths")
            paths = listed.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(listed).to_numpy())
            rep = batch.column("rep").to_numpy()
            for k in range(WIDTH):
                node = mix(paths + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64))
                take = np.flatnonzero((node >> np.uint64(11)).astype(np.float64) < chosen)
                if len(take):
                    bucket = mix(mix(node[take]) ^ values[owner[take], k]) >> np.uint64(1)
                    columns = [bucket.view(np.int64), paths[take].view(np.int64), rep[owner[take]]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "path", "rep"])

    return rows.mapInArrow(run, "bucket bigint, path bigint, rep bigint")


def buckets(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(bucket, size, rep) of all buckets to be joined by brute force, over all runs, for (rep, sampled)."""
    runs = runs_needed(threshold, DEPTH, recall)
    roots = F.array(*[F.lit(int(v)) for v in mix(np.arange(1, runs + 1, dtype=np.uint64)).view(np.int64)])
    at, parents, done = sets.select("rep", "sampled", roots.alias("paths")), None, []
    for level in range(1, DEPTH + 1):
        members = stored(_split(at, threshold), f"split-{level}")
        sizes = members.groupBy("bucket", "path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        members = members.join(sizes, ["bucket", "path"])
        large = F.col("size") > SMALL
        if parents is not None:
            above = parents.select(F.col("bucket").alias("path"), F.col("size").alias("above")).distinct()
            members = members.join(above, "path")
            large &= F.col("size") < ALIKE * F.col("above")
        members = stored(members.withColumn("large", large & F.lit(level < DEPTH)).select("bucket", "size", "rep", "large"), f"members-{level}")
        done.append(members.filter("NOT large").drop("large"))
        parents = members.filter("large").drop("large")
        if level == DEPTH or parents.isEmpty():
            break
        again = parents.groupBy("rep").agg(F.collect_list("bucket").alias("paths"))  # a few per run at most
        at = again.join(sets.select("rep", "sampled"), "rep").select("rep", "sampled", "paths")
    return reduce(DataFrame.unionByName, done)


def _cells(members: DataFrame) -> DataFrame:
    """(bucket, i, j, chunk, rep): every pair of chunks of a bucket, with the members of both."""
    chunks = F.ceil(F.col("size") / SMALL).cast("int")
    rows = members.select("bucket", "rep", chunks.alias("chunks"), F.pmod(F.xxhash64("rep", F.lit(7)), chunks).cast("int").alias("chunk"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")))
    return rows.select("bucket", "rep", "chunk", F.explode(pairs).alias("cell")).select("bucket", "cell.i", "cell.j", "chunk", "rep")


def _cross_cells(members: DataFrame) -> DataFrame:
    """(bucket, i, j, chunk, rep, cluster): pairs of chunks of a bucket, but for two of its most frequent cluster.

    Chunks of that cluster have the lower numbers; their members meet the chunks of the rest only.
    """
    of_core, of_rest = (F.ceil(F.col(c) / SMALL).cast("int") for c in ("n_core", "n_rest"))
    dealt = F.xxhash64("rep", F.lit(7))
    rows = members.select("bucket", "rep", "cluster", "core", of_core.alias("cores"), (of_core + of_rest).alias("chunks"))
    rows = rows.withColumn("chunk", F.when(F.col("core"), F.pmod(dealt, "cores")).otherwise(F.col("cores") + F.pmod(dealt, F.col("chunks") - F.col("cores"))).cast("int"))
    first = F.when(F.col("core"), F.col("cores")).otherwise(F.lit(0))
    pairs = F.transform(F.sequence(first, F.col("chunks") - 1), lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")))
    return rows.select("bucket", "rep", "cluster", "chunk", F.explode(pairs).alias("cell")).select("bucket", "cell.i", "cell.j", "chunk", "rep", "cluster")


def _by_cell(rows: DataFrame, each: Callable[[dict[str, np.ndarray]], list[np.ndarray]], schema: str) -> DataFrame:
    """Apply ``each`` to the columns of one cell after another; a cell has about two chunks of rows."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            bounds = _bounds(held)
            for a, b in zip(bounds[:-2], bounds[1:-1], strict=True):
                out.append(each(_columns(held.slice(a, b - a))))
            held = held.slice(bounds[-2]).combine_chunks()  # the last cell may go on
            if sum(len(o[0]) for o in out) > 10_000:
                yield flush(out)
                out = []
        if held is not None and held.num_rows:
            out.append(each(_columns(held)))
        if out:
            yield flush(out)

    def flush(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)

    key = ["bucket", "i", "j"]
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def _bounds(table: pa.Table) -> np.ndarray:
    """Where cells begin, and the number of rows."""
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for c in ("bucket", "i", "j"):
        v = table[c].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def _columns(table: pa.Table) -> dict:
    return {c: table[c].to_pylist() if pa.types.is_binary(table[c].type) else table[c].to_numpy() for c in table.column_names}


def _sides(chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the lower and of the higher chunk of a cell, and whether both are the same."""
    return np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk == chunk.max()), chunk.min() == chunk.max()


def _overlap(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets without repeats, left by right."""
    sets = left + right
    keys, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    in_left = owner < len(left)
    # Only tokens on both sides can count.
    on = (np.bincount(inverse[in_left], minlength=len(keys)) > 0) & (np.bincount(inverse[~in_left], minlength=len(keys)) > 0)
    column, total, out = np.cumsum(on) - 1, int(on.sum()), np.zeros((len(left), len(right)), np.float32)
    keep = on[inverse]
    rows, columns = owner[keep], column[inverse[keep]]
    for start in range(0, total, 4096):
        part = (columns >= start) & (columns < start + 4096)
        dense = np.zeros((len(sets), min(4096, total - start)), np.float32)
        dense[rows[part], columns[part] - start] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out


def _of_two(cluster: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether sets of a cell are of two clusters; a set outside of clusters is one of its own."""
    return cluster[low][:, None] != cluster[high][None, :]


def _likely(threshold: float) -> Callable[[dict], list[np.ndarray]]:
    """Members of a cell with a partner that the sampled values do not rule out."""
    least = threshold * WIDTH - DOUBT * math.sqrt(threshold * (1 - threshold) * WIDTH)

    def each(cell: dict) -> list[np.ndarray]:
        values = np.frombuffer(b"".join(cell["sampled"]), np.uint32).reshape(-1, WIDTH)
        low, high, _ = _sides(cell["chunk"])
        equal = np.zeros((len(low), len(high)), np.int16)
        for k in range(WIDTH):
            equal += values[low, k][:, None] == values[high, k][None, :]
        alike = (equal >= least) & _of_two(cell["cluster"], low, high)
        rows = np.union1d(low[alike.any(axis=1)], high[alike.any(axis=0)])
        return [cell["bucket"][rows], cell["rep"][rows]]

    return each


def _estimated(threshold: float) -> Callable[[dict], list[np.ndarray]]:
    """Edges that connect the members of a cell whose sampled values agree as those of sets at the threshold do."""
    least = threshold * WIDTH - math.sqrt(threshold * (1 - threshold) * WIDTH)

    def each(cell: dict) -> list[np.ndarray]:
        rep = cell["rep"]
        values = np.frombuffer(b"".join(cell["sampled"]), np.uint32).reshape(-1, WIDTH)
        low, high, _ = _sides(cell["chunk"])
        equal = np.zeros((len(low), len(high)), np.int16)
        for k in range(WIDTH):
            equal += values[low, k][:, None] == values[high, k][None, :]
        a, b = np.nonzero(equal >= least)
        x, y = _forest(low[a], high[b], len(rep))
        return [rep[x], rep[y]]

    return each


def sampled_edges(sets: DataFrame, threshold: float, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) that connect the sets (rep, sampled) that are alike by their sampled values, whose texts are not read."""
    members = _sized(stored(buckets(sets, threshold, recall), "members").select("bucket", "rep"))
    return _by_cell(_cells(members).join(sets, "rep"), _estimated(threshold), "a bigint, b bigint")


def _linked(threshold: float) -> Callable[[dict], list[np.ndarray]]:
    """Links per set of a cell, and edges that connect what is linked in it; an edge has 0 links, a count no edge (rep twice)."""

    def each(cell: dict) -> list[np.ndarray]:
        rep, bucket = cell["rep"], cell["bucket"][0]
        sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
        shared = [np.frombuffer(s, ">i8").astype(np.int64) for s in cell["buckets"]]
        low, high, same = _sides(cell["chunk"])
        common = _overlap([sets[k] for k in low], [sets[k] for k in high])
        size = np.array([len(s) for s in sets], np.float64)
        alike = common >= threshold * (size[low][:, None] + size[high][None, :] - common) - 1e-9
        alike &= _of_two(cell["cluster"], low, high)
        if same:
            alike = np.triu(alike, 1)
        if alike.any():  # where both ends share an earlier bucket, the pair counts there
            earlier = [s[s < bucket] for s in shared]
            alike &= _overlap([earlier[k] for k in low], [earlier[k] for k in high]) == 0
        a, b = np.nonzero(alike)
        a, b = low[a], high[b]
        n = np.bincount(np.concatenate([a, b]), minlength=len(rep))
        at, (x, y) = np.flatnonzero(n), _forest(a, b, len(rep))
        return [np.append(rep[at], rep[x]), np.append(rep[at], rep[y]), np.append(n[at], np.zeros(len(x), np.int64))]

    return each


def _differences(rows: DataFrame) -> DataFrame:
    """(bucket, chunk, chunks, rep, size, missing, first_size, differs) of sets to the first of their cluster, for rows with both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "shingles"):
                sizes, missing, firsts, differs = [], [], [], []
                for own, first in zip(part.column("shingles"), part.column("first"), strict=True):
                    a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (own, first))
                    d = np.setxor1d(a, b, assume_unique=True)
                    sizes.append(len(a))
                    firsts.append(len(b))
                    missing.append((len(d) + len(b) - len(a)) // 2)
                    differs.append(d.tobytes())
                counts = [pa.array(c, pa.int32()) for c in (sizes, missing, firsts)]
                columns = [part.column(c) for c in ("bucket", "chunk", "chunks", "rep")] + counts + [pa.array(differs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "chunks", "rep", "size", "missing", "first_size", "differs"])

    schema = "bucket bigint, chunk int, chunks int, rep bigint, size int, missing int, first_size int, differs binary"
    return rows.select("bucket", "chunk", "chunks", "rep", "shingles", "first").mapInArrow(run, schema)


def _alike_sets(threshold: float) -> Callable[[dict], list[np.ndarray]]:
    """Links per set of two tiles of a cluster, and edges that connect what is linked in them, as ``_linked`` gives them."""

    def each(cell: dict) -> list[np.ndarray]:
        rep, first = cell["rep"], int(cell["first_size"][0])
        differs = [np.frombuffer(s, np.uint64) for s in cell["differs"]]
        size, missing = cell["size"].astype(np.float64), cell["missing"].astype(np.float64)
        low, high, same = _sides(cell["chunk"])
        common = _overlap([differs[k] for k in low], [differs[k] for k in high])
        common = common + (first - missing[low][:, None] - missing[high][None, :])
        alike = common >= threshold * (size[low][:, None] + size[high][None, :] - common) - 1e-9
        if same:
            np.fill_diagonal(alike, False)
        n = np.zeros(len(rep), np.int64)
        n[low] = alike.sum(axis=1)
        if not same:
            n[high] = alike.sum(axis=0)
        at, (x, y) = np.flatnonzero(n), _spanning(alike)
        x, y = low[x], high[y]
        return [np.append(rep[at], rep[x]), np.append(rep[at], rep[y]), np.append(n[at], np.zeros(len(x), np.int64))]

    return each


def _spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, column) among those of the matrix that connect the same rows and columns without a cycle."""
    rows, columns, x, y = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool), [], []
    for start in np.flatnonzero(linked.any(axis=1)).tolist():
        if not rows[start]:
            continue
        rows[start], queue = False, [(start, True)]
        while queue:
            k, is_row = queue.pop()
            found = np.flatnonzero(linked[k] & columns if is_row else linked[:, k] & rows)
            (columns if is_row else rows)[found] = False
            mine = np.full(len(found), k)
            x.append(mine if is_row else found)
            y.append(found if is_row else mine)
            queue += [(other, not is_row) for other in found.tolist()]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *x]), np.concatenate([none, *y])


def _within(clusters: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Links and edges between all sets of each cluster (rep, cluster)."""
    tiles = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("chunks"))
    dealt = clusters.join(tiles, "cluster").select("cluster", "rep", "chunks", F.pmod(F.xxhash64("rep", F.lit(11)), F.col("chunks")).cast("int").alias("chunk"))
    sets = known.select("rep", "shingles")
    # The first set of a cluster goes to each tile, so that no cluster is one key of the join.
    firsts = tiles.join(sets.select(F.col("rep").alias("cluster"), F.col("shingles").alias("first")), "cluster")
    firsts = firsts.select("cluster", "first", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    both = dealt.join(sets, "rep").join(firsts, ["cluster", "chunk"]).withColumnRenamed("cluster", "bucket")
    rows = stored(_differences(both), "differences")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")))
    cells = rows.withColumn("cell", F.explode(pairs)).select("bucket", "cell.i", "cell.j", "chunk", "rep", "size", "missing", "first_size", "differs")
    return _by_cell(cells, _alike_sets(threshold), "a bigint, b bigint, links bigint")


def _cored(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members (bucket, rep, cluster, core, n_core, n_rest) of buckets of more than one cluster.

    ``core`` are those of a bucket's most frequent cluster, if they are more than ``SMALL``.
    """
    rows = members.select("bucket", "size", "rep").join(clusters, "rep", "left")
    counts = rows.filter("cluster IS NOT NULL").groupBy("bucket", "cluster").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("bucket").agg(F.max(F.struct("n", "cluster")).alias("top"))
    rows = rows.join(top, "bucket", "left").filter("top IS NULL OR top.n < size")
    large = F.coalesce(F.col("top.n") > SMALL, F.lit(False))
    n_core = F.when(large, F.col("top.n")).otherwise(0)
    core = large & F.coalesce(F.col("cluster") == F.col("top.cluster"), F.lit(False))
    return rows.select("bucket", "rep", F.coalesce("cluster", "rep").alias("cluster"), core.alias("core"), n_core.alias("n_core"), (F.col("size") - n_core).alias("n_rest"))


def _forest(a: np.ndarray, b: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges among the given ones that connect the same nodes without a cycle."""
    root, kept = list(range(nodes)), []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(k)
    return a[kept], b[kept]


def links(docs: DataFrame, sets: DataFrame, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """For the sets (rep, sampled) of ``docs``: links per rep that has any, and edges (a, b) that connect them."""
    members = stored(buckets(sets, threshold, recall), "members")
    # Equal buckets come up in many runs: the first of them is enough, before and after members leave.
    members = _sized(members.select("bucket", "rep"))
    clusters = stored(members.filter(F.col("size") > SMALL).groupBy("rep").agg(F.min("least").alias("cluster")), "clusters")
    cells = _cross_cells(_cored(members, clusters)).join(sets.select("rep", "sampled"), "rep")
    likely = _by_cell(cells, _likely(threshold), "bucket bigint, rep bigint")
    members = stored(_cored(_sized(stored(likely.distinct(), "likely")), clusters), "crossing")
    # Lists of bucket numbers as bytes: a few per run and rep.
    number = F.expr("unhex(array_join(transform(sort_array(collect_list(bucket)), b -> lpad(hex(b), 16, '0')), ''))")
    lists = members.groupBy("rep").agg(number.alias("buckets"))
    wanted = members.select("rep").union(clusters.select("rep")).union(clusters.select("cluster")).distinct()
    known = stored(shingles_of(docs, n, wanted).join(lists, "rep", "left"), "known")
    crossing = _by_cell(_cross_cells(members).join(known, "rep"), _linked(threshold), "a bigint, b bigint, links bigint")
    found = stored(crossing.unionByName(_within(clusters, known, threshold)), "links")
    return found.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links")), found.filter("a <> b").select("a", "b")


def _sized(members: DataFrame) -> DataFrame:
    """Members (bucket, size, least, rep) of buckets that differ, with their least rep; those of one member are gone."""
    content = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("rep").alias("least"),
        F.bit_xor(F.xxhash64("rep")).alias("_x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("_y"),
    )
    first = content.filter("size > 1").groupBy("size", "_x", "_y").agg(F.min("bucket").alias("bucket"), F.first("least").alias("least"))
    return stored(members.join(first, "bucket").select("bucket", "size", "least", "rep"), "buckets")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b); root is the least node of its component."""
    edges, before = stored(edges.select("a", "b").filter("a <> b"), "edges"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        # Large star: every larger neighbour of a node goes to the least of the node and its neighbours.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large-star")
        # Small star: a node and its smaller neighbours go to the least of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select("root", "root")).distinct()


def _classes(docs: DataFrame, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, rep), and per rep its class: root, least doc_id of the rep and of the class, copies and links."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    rows = stored(representatives(docs, n), "representatives")
    groups = rows.groupBy("rep").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("size").alias("size"), F.first("sampled").alias("sampled")
    )
    groups = stored(groups, "sets")
    counts, edges = links(docs, groups.filter("size > 0").select("rep", "sampled"), n, threshold, recall)
    roots = components(edges).withColumnRenamed("node", "rep")
    named = groups.drop("sampled", "size").join(roots, "rep", "left").join(counts, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    classes = named.groupBy("root").agg(F.min("least").alias("class_id"))
    named = named.join(classes, "root").select("rep", "root", "least", "class_id", "n_copies", F.coalesce("links", F.lit(0)).alias("n_links"))
    return rows.select("doc_id", "rep"), stored(named, "classes")


def jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): class_id, n_copies, n_links.

    ``class_id`` is the least doc_id of the class, ``n_copies`` the number of rows with an equal set of shingles, the
    row included, and ``n_links`` the number of other sets that its set is linked to.
    """
    rows, named = _classes(docs, n, threshold, recall)
    return rows.join(named, "rep").select("doc_id", "class_id", "n_copies", "n_links")


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """One row of each class of ``docs``, one with the least doc_id (null only if all are), with all its columns."""
    _, named = _classes(docs, n, threshold, recall)
    chosen = named.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "rep")).alias("_kept"))
    chosen = stored(chosen.select(F.col("_kept.rep").alias("_rep"), F.col("_kept.least").alias("_least")), "kept")

    @F.arrow_udf("bigint")
    def rep_of(texts: pa.Array) -> pa.Array:
        release()  # what earlier stages and batches left in this worker
        found = [set_hashes(part, n) for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text")]
        return pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))

    # The join asks for values that are not null: that must not become a filter below with an evaluation of its own.
    rep_of = rep_of.asNondeterministic()
    rows = docs.select(whole_rows(docs), rep_of(utf8("text")).alias("_rep")).join(chosen, "_rep")
    return rows.filter(F.col("_doc.doc_id").cast("bigint").eqNullSafe(F.col("_least"))).dropDuplicates(["_rep"]).select("_doc.*")
