"""Ranked lexical search by NRA: impact-sorted lists are read in sequence, with score intervals for every document.

The index is a stored table of blocks. A block covers a range of the documents and holds, for each term, its postings
in falling order of impact. A search reads the lists of an item's terms side by side from the top. What is read so far
gives each document a lower score, and the last impact read of each list bounds what a document can still gain there.
Reading goes on until every document whose upper score reaches the k-th lower one is known exactly, so membership,
ties and scores are settled; documents not met yet count with the sum of the bounds. No posting is looked up by document.

Scores depend on the whole corpus only by its counts, so blocks are searched where they lie, and a task hands on its k
best documents of each item. The k-th score of the blocks read before is where the next block starts from: a block
whose lists can't reach it is left after its first reads.

Items are the stated query set. They are taken in chunks of about ``CHUNK_BYTES`` text, so what is broadcast is bounded
however many items there are. With one chunk the index holds just the items' terms, with several it holds all terms.

Terms are runs of letters, digits and non-ASCII characters, A-Z in lower case, as 64-bit hashes. Null and empty texts
have no terms: such documents are never found and are not counted, such items find nothing. Repeated rows of documents
have ranks of their own; a null doc_id comes last among equal scores. Rows of items with equal id and text count once,
those with equal ids and other texts are ranked each for itself. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import as_arrays, slices, stored, utf8, volume
from plumbline.llm.words import words_of

CHUNK_BYTES = 4 << 20
#: A block is closed when it has so many postings.
BLOCK_POSTINGS = 1 << 20
#: Postings read of each list before the first look at the intervals; each further round reads up to twice the depth.
FIRST_READ = 64
#: Tasks whose best documents are merged together before all are.
MERGED_TASKS = 1024

_SLICES = "doc_ids array<bigint>, sizes array<bigint>, terms array<bigint>, bounds array<int>, docs array<int>, counts array<bigint>"
_BLOCKS = "doc_ids array<bigint>, terms array<bigint>, bounds array<int>, docs array<int>, impacts array<bigint>"
_NULL_ID = np.iinfo(np.int64).max


def _row(columns: list[tuple[str, np.ndarray | pa.Array, pa.DataType]]) -> pa.RecordBatch:
    """One row whose cells are whole arrays."""
    cells = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v, t)) for _, v, t in columns]
    return pa.RecordBatch.from_arrays(cells, [name for name, _, _ in columns])


def term_slices(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """Counts of terms per document of (doc_id, text), a row for about a megabyte of text.

    ``vocabulary``, sorted hashes, limits the terms that are kept; sizes always count all terms.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        if wanted is not None:
            low = np.zeros(1 << 16, bool)
            low[wanted & 0xFFFF] = True
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(*as_arrays(part.column("text")))
                hashes, doc = words.hash.view(np.int64), words.text_of()
                if wanted is not None:
                    at = np.flatnonzero(low[hashes & 0xFFFF])
                    near = np.minimum(np.searchsorted(wanted, hashes[at]), max(0, len(wanted) - 1))
                    at = at[wanted[near] == hashes[at]] if len(wanted) else at[:0]
                    hashes, doc = hashes[at], doc[at]
                terms, term = np.unique(hashes, return_inverse=True)
                pairs, counts = np.unique(term * part.num_rows + doc, return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(len(terms) + 1) * part.num_rows)
                yield _row(
                    [
                        ("doc_ids", part.column("doc_id"), pa.int64()),
                        ("sizes", words.counts(), pa.int64()),
                        ("terms", terms, pa.int64()),
                        ("bounds", bounds, pa.int32()),
                        ("docs", pairs % part.num_rows, pa.int32()),
                        ("counts", counts, pa.int64()),
                    ]
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("text"))
    return stored(rows.mapInArrow(run, _SLICES), "term-slices")


def corpus_size(parts: DataFrame) -> tuple[int, int]:
    """Number of documents that have a term, and of all their terms with repeats."""
    row = parts.agg(
        F.sum(F.size(F.filter("sizes", lambda n: n > 0)).cast("bigint")).alias("n"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("l"),
    ).first()
    return row["n"] or 0, row["l"] or 0


def _numbers(batch: pa.RecordBatch, k: int, *names: str) -> list[np.ndarray]:
    return [batch.column(name)[k].values.to_numpy(zero_copy_only=False) for name in names]


def impact_blocks(parts: DataFrame, documents: int, total: int) -> DataFrame:
    """The index: postings of several slices together, those of a term in falling order of impact.

    The impact is what one unit of the term's weight gives. Since the weight is the same for a whole list, lists need no
    other order when weights change.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("doc_ids")[k].values
                sizes, terms, bounds, docs, counts = _numbers(batch, k, "sizes", "terms", "bounds", "docs", "counts")
                length = 100 - 90 + (90 * sizes * documents) // max(1, total)
                impact = (1_000_000_000 * counts) // (1000 * counts + 8 * length[docs])
                held.append((ids, np.repeat(terms, np.diff(bounds)), docs, impact))
                if sum(len(h[2]) for h in held) >= BLOCK_POSTINGS:
                    yield block(held)
                    held = []
        if held:
            yield block(held)

    def block(held: list[tuple]) -> pa.RecordBatch:
        shift = np.cumsum([0, *[len(ids) for ids, *_ in held]])
        term, impact = (np.concatenate([h[k] for h in held]) for k in (1, 3))
        doc = np.concatenate([docs.astype(np.int64) + s for (_, _, docs, _), s in zip(held, shift, strict=False)])
        order = np.lexsort((-impact, term))
        terms, bounds = np.unique(term[order], return_index=True)
        ids = pa.concat_arrays([ids for ids, *_ in held])
        return _row(
            [
                ("doc_ids", ids, pa.int64()),
                ("terms", terms, pa.int64()),
                ("bounds", np.append(bounds, len(order)), pa.int32()),
                ("docs", doc[order], pa.int32()),
                ("impacts", impact[order], pa.int64()),
            ]
        )

    return stored(parts.mapInArrow(run, _BLOCKS), "impact-blocks")


def document_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Number of documents that hold each of ``terms`` (sorted hashes), over the whole index."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                found, bounds = _numbers(batch, k, "terms", "bounds")
                _, here, there = np.intersect1d(found, sent.value, assume_unique=True, return_indices=True)
                total[there] += np.diff(bounds)[here]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(len(terms), np.int64)
    rows = index.select("terms", "bounds").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # at most one row per term of a chunk
        out[row["at"]] = row["n"]
    return out


@dataclass
class Items:
    """Items of one chunk: ``terms`` are sorted hashes, ``of`` the places in it of each item's terms."""

    ids: list[int | None]
    of: list[np.ndarray]
    terms: np.ndarray
    weight: np.ndarray


def read_items(rows: list) -> Items:
    texts = [bytes(r["text"]) for r in rows]
    data = np.frombuffer(b"".join(texts), np.uint8)
    words = words_of(data, np.cumsum([0, *[len(t) for t in texts]]))
    terms, at = np.unique(words.hash.view(np.int64), return_inverse=True)
    of = [np.unique(at[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return Items([r["item_id"] for r in rows], of, terms, np.zeros(len(terms), np.int64))


def weights(counts: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each term from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in counts], np.int64)


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the k best, with their scores; ``known`` are the best scores found elsewhere.

    ``lists`` are (document, impact) with falling impacts, each document once. Every document that is left out has a
    score below the k-th best.
    """
    lower = np.zeros(documents, np.int64)
    read, depth = 0, FIRST_READ
    while True:
        bound, pending = np.zeros(documents, np.int64), 0
        for doc, impact in lists:
            lower[doc[read:depth]] += impact[read:depth]
            if len(doc) > depth:
                pending += int(impact[depth - 1])
                bound[doc[:depth]] -= impact[depth - 1]
        upper = lower + bound + pending
        scores = np.concatenate([known, lower])
        least = int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0
        if not ((upper >= least) & (upper > lower)).any():
            found = np.flatnonzero(lower >= max(1, least))
            return found, lower[found]
        read, depth = depth, depth * 2


def best_of_tasks(index: DataFrame, items: Items, k: int) -> DataFrame:
    """The k best documents of each item in each task: (item, item_id, doc_id, score, task)."""
    sent = index.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        ids = [np.zeros(0, np.int64)] * len(wanted.ids)
        scores = list(ids)
        for batch in batches:
            for row in range(batch.num_rows):
                terms, bounds, docs, impacts = _numbers(batch, row, "terms", "bounds", "docs", "impacts")
                own = batch.column("doc_ids")[row].values.fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
                if not len(terms):
                    continue
                at = np.minimum(np.searchsorted(terms, wanted.terms), len(terms) - 1)
                here = terms[at] == wanted.terms
                for item, chosen in enumerate(wanted.of):
                    lists = [
                        (docs[bounds[a] : bounds[a + 1]], impacts[bounds[a] : bounds[a + 1]] * w)
                        for a, w in zip(at[chosen[here[chosen]]], wanted.weight[chosen[here[chosen]]], strict=True)
                    ]
                    if not lists:
                        continue
                    found, score = resolve(lists, len(own), k, scores[item])
                    all_ids, all_scores = np.concatenate([ids[item], own[found]]), np.concatenate([scores[item], score])
                    first = np.lexsort((all_ids, -all_scores))[:k]
                    ids[item], scores[item] = all_ids[first], all_scores[first]
        n = [len(i) for i in ids]
        doc = np.concatenate([*ids, np.zeros(0, np.int64)])
        cells = [
            pa.array(np.repeat(np.arange(len(ids)), n)),
            pa.array([i for i, m in zip(wanted.ids, n, strict=True) for _ in range(m)], pa.int64()),
            pa.array(doc, mask=doc == _NULL_ID),
            pa.array(np.concatenate([*scores, np.zeros(0, np.int64)])),
            pa.array(np.full(len(doc), TaskContext.get().partitionId(), np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(cells, ["item", "item_id", "doc_id", "score", "task"])

    return index.mapInArrow(run, "item bigint, item_id bigint, doc_id bigint, score bigint, task int")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    asked = items.select(F.col("item_id").cast("bigint"), utf8("text").alias("text")).distinct()
    _, size = volume(asked, "text")
    chunks = -(-size // CHUNK_BYTES) or 1
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)))
    index, best = None, None
    for chunk in range(chunks):
        wanted = read_items(asked.filter(F.col("chunk") == chunk).collect())  # about CHUNK_BYTES
        if index is None:
            parts = term_slices(docs, wanted.terms if chunks == 1 else None)
            documents, total = corpus_size(parts)
            index = impact_blocks(parts, documents, total)
        wanted.weight = weights(document_counts(index, wanted.terms), documents)
        found = best_of_tasks(index, wanted, k).withColumn("chunk", F.lit(chunk))
        best = found if best is None else best.unionByName(found)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("chunk", "item", F.shiftright("task", int(math.log2(MERGED_TASKS)))).orderBy(*order)
    every = Window.partitionBy("chunk", "item").orderBy(*order)
    merged = best.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    ranked = merged.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
