"""Benchmark decontamination with a positional inverted index.

The index is a stored table of segments. A segment covers a slice of the texts, about a megabyte, and holds for each
term the sorted positions of its occurrences (postings), and for each document its range of positions. The index may
hold all terms or just those of the test items. Segments are searched where they are stored, without a shuffle: a
phrase starts from the postings of its rarest term, by the counts of the whole corpus, shifted by the term's offset
in the phrase, and is intersected with the shifted postings of the others, rarer terms first.

Test items are the stated query set. They are taken in chunks of about ``CHUNK_BYTES`` text, so what is broadcast is
bounded however many items there are; with several chunks the index holds all terms and is searched once per chunk.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Terms are 64-bit hashes of words. Null
and empty texts have no words and no hits; an item without words has no window and never occurs. Repeated rows of
``docs`` are rows of their own; repeated items, and items of equal ids, count once. Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import as_arrays, release, slices, stored, utf8, volume
from plumbline.llm.words import words_of

CHUNK_BYTES = 4 << 20
SEGMENTS = (
    "segment bigint, doc_ids array<bigint>, first array<int>, terms array<bigint>, bounds array<int>, positions array<int>"
)


@dataclass
class Phrases:
    """Phrases of one chunk: terms by phrase and offset, -1 in ``order`` past the end; ``item`` indexes ``items``."""

    terms: np.ndarray
    size: np.ndarray
    item: np.ndarray
    items: list[str]
    order: np.ndarray | None = None  # offsets of each phrase, rarest term first

    def vocabulary(self) -> np.ndarray:
        return np.unique(self.terms[np.arange(self.terms.shape[1]) < self.size[:, None]])


def phrases(items: list[str], texts: list[bytes], width: int) -> Phrases:
    """All windows of ``width`` words of the items; an item of fewer words is one window."""
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words = words_of(data, at)
    count = words.counts()
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    item = np.repeat(np.arange(len(items)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
    size = np.minimum(count, width)[item]
    take = np.minimum(start[:, None] + np.arange(width), max(0, len(words.hash) - 1))
    terms = words.hash.view(np.int64)[take] if len(words.hash) else np.zeros((0, width), np.int64)
    return Phrases(terms, size, item, items)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """Segments of (doc_id, text); ``vocabulary``, sorted hashes of terms, limits what has postings."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, number = sent.value, TaskContext.get().partitionId() << 32
        if wanted is not None:
            low = np.zeros(1 << 16, bool)
            low[wanted & 0xFFFF] = True
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(*as_arrays(part.column("text")))
                hashes = words.hash.view(np.int64)
                position = np.arange(len(hashes))
                if wanted is not None:
                    position = np.flatnonzero(low[hashes & 0xFFFF])
                    near = np.searchsorted(wanted, hashes[position])
                    position = position[wanted[np.minimum(near, len(wanted) - 1)] == hashes[position]] if len(wanted) else position[:0]
                order = position[np.argsort(hashes[position], kind="stable")]
                terms, bounds = np.unique(hashes[order], return_index=True)
                cells = [words.first, terms, np.append(bounds, len(order)), order]
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("doc_id")),
                        *[pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, k)) for c, k in zip(cells, kinds, strict=True)],
                    ],
                    ["segment", "doc_ids", "first", "terms", "bounds", "positions"],
                )
                number += 1
        release()  # workers are used again by other stages

    rows = docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("text"))
    return stored(rows.mapInArrow(run, SEGMENTS), "segments")


def term_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Occurrences of each of ``terms`` (sorted hashes) in the whole corpus."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for found, bounds in zip(batch.column("terms"), batch.column("bounds"), strict=True):
                found, sizes = found.values.to_numpy(), np.diff(bounds.values.to_numpy())
                common, here, there = np.intersect1d(found, sent.value, assume_unique=True, return_indices=True)
                total[there] += sizes[here]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = index.select("terms", "bounds").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(len(terms), np.int64)
    for row in rows.collect():  # at most one row per term of a chunk
        out[row["at"]] = row["n"]
    return out


def by_rarity(found: Phrases, vocabulary: np.ndarray, counts: np.ndarray) -> Phrases:
    """Fix the order of intersection: offsets of each phrase by the corpus count of their term."""
    if not len(found.terms):
        return Phrases(found.terms, found.size, found.item, found.items, np.zeros(found.terms.shape, np.int64))
    inside = np.arange(found.terms.shape[1]) < found.size[:, None]
    weight = counts[np.minimum(np.searchsorted(vocabulary, found.terms), len(vocabulary) - 1)]
    order = np.argsort(np.where(inside, weight, np.iinfo(np.int64).max), axis=1, kind="stable")
    return Phrases(found.terms, found.size, found.item, found.items, order)


def occurrences(found: Phrases, terms: np.ndarray, bounds: np.ndarray, positions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases occur in one segment: number of the phrase, position of its first word."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(found.terms) or not len(terms):
        return nothing
    place = np.searchsorted(terms, found.terms)
    here = terms[np.minimum(place, len(terms) - 1)] == found.terms
    here |= np.arange(found.terms.shape[1]) >= found.size[:, None]
    phrase = np.flatnonzero(here.all(axis=1))
    if not len(phrase):
        return nothing
    rare = found.order[phrase, 0]
    at = place[phrase, rare]
    n = bounds[at + 1] - bounds[at]
    where = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[at], n)
    start = positions[where].astype(np.int64) - np.repeat(rare, n)
    phrase = np.repeat(phrase, n)
    # Which term stands where: the postings turned round, so that shifted lists are intersected by look-up.
    term_at = np.full(int(first[-1]) + 1, -1, np.int64)
    term_at[positions] = np.repeat(np.arange(len(terms)), np.diff(bounds))
    fits = (start >= 0) & (start + found.size[phrase] <= first[-1])
    phrase, start = phrase[fits], start[fits]
    for k in range(1, found.terms.shape[1]):
        open_ = k < found.size[phrase]
        offset = found.order[phrase, k]
        same = term_at[np.where(open_, start + offset, first[-1])] == place[phrase, offset]
        phrase, start = phrase[same | ~open_], start[same | ~open_]
    doc = np.searchsorted(first, start, side="right") - 1
    whole = start + found.size[phrase] <= first[doc + 1]
    return phrase[whole], start[whole]


_HITS = "segment bigint, row int, doc_id bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def phrase_matches(index: DataFrame, found: Phrases) -> DataFrame:
    """Per document of the index: number of words, the spans of words that lie in any phrase, items that occur."""
    sent = index.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                first, terms, bounds, positions = (
                    batch.column(c)[k].values.to_numpy() for c in ("first", "terms", "bounds", "positions")
                )
                phrase, start = occurrences(wanted, terms, bounds, positions, first)
                docs = np.searchsorted(first, start, side="right") - 1
                spans: list[list] = [[] for _ in range(len(first) - 1)]
                items: list[list] = [[] for _ in range(len(first) - 1)]
                order = np.argsort(start, kind="stable")
                for doc, begin, end in zip(docs[order], start[order], (start + wanted.size[phrase])[order], strict=True):
                    own = spans[doc]
                    begin, end = int(begin - first[doc]), int(end - first[doc])
                    if own and begin <= own[-1]["end"]:
                        own[-1]["end"] = max(end, own[-1]["end"])
                    else:
                        own.append({"start": begin, "end": end})
                for doc, item in np.unique(np.stack([docs, wanted.item[phrase]]), axis=1).T:
                    items[doc].append(wanted.items[item])
                n = len(first) - 1
                span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("segment")[k].as_py())),
                        pa.array(np.arange(n, dtype=np.int32)),
                        batch.column("doc_ids")[k].values,
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(spans, pa.list_(span)),
                        pa.array([sorted(set(i)) for i in items], pa.list_(pa.string())),
                    ],
                    ["segment", "row", "doc_id", "n_words", "spans", "items"],
                )

    return index.mapInArrow(run, _HITS)


def proximity_matches(index: DataFrame, queries: dict[str, list[str]], span: int) -> DataFrame:
    """Smallest stretches of at most ``span`` words that hold all words of a query: (query, doc_id, start, end).

    ``queries`` is a stated set of names and words; a query without words matches nothing. The index must hold the words.
    """
    wanted = {}
    for name, words in queries.items():
        data = " ".join(words).encode()
        wanted[name] = np.unique(words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hash.view(np.int64))
    sent = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for k in range(batch.num_rows):
                first, terms, bounds, positions = (
                    batch.column(c)[k].values.to_numpy() for c in ("first", "terms", "bounds", "positions")
                )
                ids = batch.column("doc_ids")[k].as_py()
                for name, need in sent.value.items():
                    at = np.searchsorted(terms, need)
                    if not len(need) or not len(terms) or not (terms[np.minimum(at, len(terms) - 1)] == need).all():
                        continue
                    lists = [positions[bounds[a] : bounds[a + 1]] for a in at]
                    # Around each occurrence of the rarest term, the others must lie within reach.
                    rare = min(lists, key=len)
                    near = [x[_within(x, rare, span)] for x in lists]
                    place = np.concatenate(near)
                    which = np.repeat(np.arange(len(near)), [len(x) for x in near])
                    order = np.argsort(place, kind="stable")
                    last, doc_of = [-1] * len(near), np.searchsorted(first, place, side="right") - 1
                    best: list[tuple[int, int, int]] = []
                    for j in order:
                        last[which[j]] = int(place[j])
                        begin, end, doc = min(last), int(place[j]) + 1, int(doc_of[j])
                        if begin >= first[doc] and end - begin <= span and (not best or best[-1][1] < begin):
                            best.append((doc, begin, end))
                    rows += [(name, ids[d], b - int(first[d]), e - int(first[d])) for d, b, e in best]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "doc_id", "start", "end"])

    return index.mapInArrow(run, "query string, doc_id bigint, start int, end int")


def _within(values: np.ndarray, anchors: np.ndarray, reach: int) -> np.ndarray:
    at = np.searchsorted(anchors, values)
    after = np.abs(anchors[np.minimum(at, len(anchors) - 1)] - values)
    return np.minimum(after, np.abs(anchors[np.maximum(at - 1, 0)] - values)) < reach


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, spans and items of ``benchmark`` (item_id, text) found in it."""
    test = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), utf8("text").alias("text")).distinct()
    _, size = volume(test, "text")
    chunks = -(-size // CHUNK_BYTES) or 1
    test = test.withColumn("chunk", F.pmod(F.xxhash64("item", "text"), F.lit(chunks)))
    index, parts = None, []
    for chunk in range(chunks):
        rows = test.filter(F.col("chunk") == chunk).collect()  # about CHUNK_BYTES
        found = phrases([r["item"] for r in rows], [bytes(r["text"]) for r in rows], width)
        vocabulary = found.vocabulary()
        if index is None:
            index = build_index(docs, vocabulary if chunks == 1 else None)
        parts.append(phrase_matches(index, by_rarity(found, vocabulary, term_counts(index, vocabulary))))
    hits = parts[0]
    if chunks > 1:
        for more in parts[1:]:
            hits = hits.unionByName(more)
        hits = hits.groupBy("segment", "row", "doc_id", "n_words").agg(
            F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["end"]))).alias("n"), F.greatest(a["end"], s["end"]).alias("end")
        ),
        lambda a: a["n"],
    )
    return hits.select("doc_id", "n_words", covered.alias("n_hit"), "spans", "items")
