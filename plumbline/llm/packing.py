"""Packing of token sequences in windows of several lengths.

Every document is tokenized whole and gets an end id. Full windows of the longest tier are cut from its front; the
rest is routed to the smallest tier that holds it. Windows are then filled from the longest piece down: a piece opens
a window of its tier, the gap is filled with the longest pieces of shorter tiers that fit, and what still remains is
filled by cutting the shortest piece, whose rest goes back to the pool. So every window is full, but for the last of
each block of pieces, which is cut into smaller tiers and at most one padded sequence.

Pieces are packed where they are tokenized: blocks of ``BLOCK_TOKENS`` ids inside a task, no shuffle of ids, nothing
that grows with the input. Sequences are numbered without gaps by offsets per (task, tier), and dealt to steps so
that each step has its share of every tier, within one sequence.

Null and empty texts are documents of the end id alone. Repeated rows are packed as often as they occur. An empty
table has no pieces.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import release, slices, stored, utf8

TIERS = (2048, 1024, 512, 256)
BLOCK_TOKENS = 4_000_000
CACHED_WORDS = 200_000
#: The split of a text before byte pairs are merged, as the public vocabulary defines it: a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PROBE = "It's 12 o'clock,\n\n  naïve\tÜber-straße  東京 🙂!! x   end "


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as U+0100 and up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoder:
    """Ids of a byte-level vocabulary file, with the ids of recent words at hand.

    A text whose blanks all stand alone splits at them without any effect on its ids, so most words are looked up. A
    text that holds an added token goes to the tokenizer as it is. Ids are kept as bytes, 32 bits each.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        byte = _byte_of_character()
        with open(path, encoding="utf-8") as file:
            self._added = [t["content"] for t in json.load(file).get("added_tokens", [])]
        whole = Tokenizer.from_file(path)
        vocabulary = {t: k for t, k in whole.get_vocab().items() if t not in set(self._added)}
        ranks = {bytes(byte[c] for c in t): k for t, k in vocabulary.items()}
        fast = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self._whole = lambda text: whole.encode(text, add_special_tokens=False).ids
        self._plain = fast.encode_ordinary if fast.encode_ordinary(_PROBE) == self._whole(_PROBE) else self._whole
        self._words: dict[str, bytes | None] = {}

    def _learn(self, word: str) -> bytes | None:
        known = self._words
        if len(known) >= CACHED_WORDS:
            known.clear()
        known[word] = None if not word or word[0].isspace() or word[-1].isspace() else _packed(self._plain(" " + word))
        return known[word]

    def __call__(self, text: str) -> np.ndarray:
        if any(token in text for token in self._added):
            return np.array(self._whole(text), np.uint32)
        first, *rest = text.split(" ")
        if rest and (not first or first[-1].isspace()):
            return np.array(self._plain(text), np.uint32)
        known = self._words
        ids = [known[w] if w in known else self._learn(w) for w in rest]
        if None in ids:
            return np.array(self._plain(text), np.uint32)
        return np.frombuffer(b"".join([_packed(self._plain(first)), *ids]), np.uint32)


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class _Pool:
    """Pieces by length: (length, number of the piece, first and last position in its document)."""

    def __init__(self) -> None:
        self.sorted: list[tuple[int, int, int]] = []

    def add(self, doc: int, start: int, end: int) -> None:
        insort(self.sorted, (end - start, doc, start))

    def longest(self, most: int) -> tuple[int, int, int] | None:
        at = bisect_right(self.sorted, (most, 1 << 62, 0))
        return self.sorted.pop(at - 1) if at else None


def pack(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Windows of documents with so many ids: (tier, [(document, start, end), ...]); tier 0 is the padded rest."""
    longest, shortest = tiers[0], tiers[-1]
    pool = []
    for doc, size in enumerate(sizes):
        full = size - size % longest
        for start in range(0, full, longest):
            yield longest, [(doc, start, start + longest)]
        if size > full:
            pool.append((size - full, doc, full))
    pieces = _Pool()
    pieces.sorted = sorted(pool)
    while piece := pieces.longest(longest):
        length, doc, start = piece
        tier = min(t for t in tiers if t >= length)
        window, gap = [(doc, start, start + length)], tier - length
        while gap and pieces.sorted:
            if found := pieces.longest(gap):
                length, doc, start = found
            else:
                length, doc, start = pieces.sorted.pop(0)
                pieces.add(doc, start + gap, start + length)
                length = gap
            window.append((doc, start, start + length))
            gap -= length
        left = tier - gap
        while gap and left >= shortest:  # the last window of the block
            part, take = [], max(t for t in tiers if t <= left)
            left -= take
            size = take
            while take:
                doc, start, end = window.pop(0)
                part.append((doc, start, min(end, start + take)))
                if end - start > take:
                    window.insert(0, (doc, start + take, end))
                take -= part[-1][2] - start
            yield size, part
        if window:
            yield (0 if gap else tier), window


_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, offset bigint, tier int, _task int, _rank bigint"
)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, step_tokens: int = 1 << 19, with_ids: bool = False
) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text), with the place of each in its sequence and step.

    ``tier`` is the length of the window, 0 for a padded rest; ``step`` numbers the groups of about ``step_tokens``
    ids. ``with_ids`` adds the ids of each piece.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers are falling powers of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what earlier stages left in this worker
        encode, task, rank = encoder(vocabulary), TaskContext.get().partitionId(), dict.fromkeys((*tiers, 0), 0)

        def flush(keys: list, ids: list[np.ndarray]) -> pa.RecordBatch:
            rows = []
            for tier, window in pack([len(x) for x in ids], tiers):
                offset = 0
                for doc, start, end in window:
                    part = ids[doc][start:end]
                    row = [keys[doc], start, end - start, zlib.crc32(part.astype("<u4").tobytes()), len(ids[doc]), offset, tier, task, rank[tier]]
                    rows.append(row + [part] if with_ids else row)
                    offset += end - start
                rank[tier] += 1
            kinds = [*[pa.int64()] * 6, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)]
            return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

        keys, ids, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for key, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    found = encode(bytes(text.as_buffer()).decode("utf-8", "replace"))
                    keys.append(key)
                    ids.append(np.append(found, np.uint32(end_id)))
                    held += len(found) + 1
                if held >= BLOCK_TOKENS:
                    yield flush(keys, ids)
                    keys, ids, held = [], [], 0
        if keys:
            yield flush(keys, ids)
        keys, ids = [], []
        release()

    schema = _PIECES + ", ids array<int>" * with_ids
    rows = docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("text"))
    pieces = stored(rows.mapInArrow(run, schema), "pieces")
    # A window holds the counts of one tier, at most one number per task.
    in_tier = Window.partitionBy("tier").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("tier", "_task").agg(F.countDistinct("_rank").alias("_n"), F.sum("length").alias("_tokens"))
    bases = counts.withColumn("_before", F.coalesce(F.sum("_n").over(in_tier), F.lit(0))).select("tier", "_task", "_before")
    tiers_rows = counts.groupBy("tier").agg(F.sum("_n").alias("_of_tier"), F.sum("_tokens").alias("_tokens")).collect()  # one row per tier
    of_tier = {r["tier"]: r["_of_tier"] for r in tiers_rows}
    steps = max(1, -(-sum(r["_tokens"] for r in tiers_rows) // step_tokens))
    first, total = {}, 0
    for tier in (*tiers, 0):
        first[tier], total = total, total + of_tier.get(tier, 0)
    pick = lambda values: F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("tier"))
    rank = F.col("_before") + F.col("_rank")
    return pieces.join(bases, ["tier", "_task"]).select(
        *[c for c in pieces.columns if not c.startswith("_")],
        (pick({t: int(v) for t, v in first.items()}).cast("bigint") + rank).alias("sequence_id"),
        F.floor(rank * F.lit(steps) / pick({t: int(of_tier.get(t, 1)) for t in first})).cast("bigint").alias("step"),
    )
