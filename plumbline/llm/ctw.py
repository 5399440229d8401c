"""LM scoring by context-tree weighting.

A byte is eight binary decisions, each with a context tree of its own over the preceding bytes, oldest last. Every
node has a Krichevsky-Trofimov estimate; a node's weighted probability is half its own estimate and half the product
of its children's, so the prediction mixes the estimates of all depths from 0 to ``DEPTH``. Counts come from the
training texts and stay fixed while texts are scored. A text ends with an end symbol, so the probabilities of all
texts sum to one.

How it runs: texts are dealt to blocks of some megabytes by a hash of the row, and keys to buckets; the numbers of
both, and of tasks, grow with the volume of text. Each block asks for its distinct (DEPTH + 1)-byte strings and words,
found by sorting (words by 64-bit hashes, which tell the words of one block apart), along with their training counts, in one packed row per bucket of keys. A bucket
merges what all blocks counted, row by row, so that it never holds more than its distinct keys; the trees are
weighted inside the buckets, which share two-byte contexts; and each block gets its answers back and scores its
texts. Nothing that grows with the corpus is broadcast or collected; the driver sees the nodes of depth 0 and 1 only,
at most 257 * 255 of them. The count tables grow with the input.

Null and empty texts are the end symbol alone. Without any training text every bit has probability 1/2. Repeated rows
count and are scored as often as they occur.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import as_arrays, shuffle_width, slices, stored, utf8, volume
from plumbline.llm.words import mix, words_of

DEPTH = 5
#: Bytes of text per block; a block's counts are a small multiple of it.
BLOCK_BYTES = 8 << 20
#: Bytes of text per bucket of keys; the distinct keys of a bucket are a small part of it.
BUCKET_BYTES = 64 << 20
#: Neither byte occurs in UTF-8.
BEGIN, END = 0xFE, 0xFF
_GRAM, _WORD = 0, 1
_END_TOKEN = b" "  # never a word
#: A-Z in lower case, white space 0; byte 0 is part of a word and stands as one that does not occur in UTF-8.
_TOKEN_BYTES = np.array([0 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b or END for b in range(256)], np.uint8)


def _strings(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(DEPTH + 1)-byte strings of all texts as integers, the byte to predict lowest, and the first of each text."""
    n = np.diff(at)
    first = at[:-1] + (DEPTH + 1) * np.arange(len(n))
    padded = np.full(len(data) + (DEPTH + 1) * len(n), BEGIN, np.uint64)
    text = np.repeat(np.arange(len(n)), n)
    padded[np.arange(len(data)) + (DEPTH + 1) * text + DEPTH] = data
    padded[first + DEPTH + n] = END
    value = padded.copy()
    for k in range(1, DEPTH + 1):
        value[k:] |= padded[:-k] << np.uint64(8 * k)
    keep = np.ones(len(padded), bool)
    keep[(first[:, None] + np.arange(DEPTH)).ravel()] = False
    return value[keep].astype(np.int64), first - DEPTH * np.arange(len(n))


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte plane, compressed: high bytes of sorted or small numbers cost next to nothing."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(kind: int, keys: np.ndarray | list[bytes]) -> bytes:
    return _pack(np.diff(keys, prepend=0)) if kind == _GRAM else zstandard.ZstdCompressor(1).compress(b"\n".join(keys))


def _unpack_keys(kind: int, packed: bytes) -> np.ndarray | list[bytes]:
    return np.cumsum(_unpack(packed, np.int64)) if kind == _GRAM else zstandard.ZstdDecompressor().decompress(packed).split(b"\n")


def _by_bucket(kind: int, keys: np.ndarray | list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets of keys, and which keys each holds, in order. Strings with equal two-byte contexts share a bucket."""
    if kind == _GRAM:
        at = mix((keys >> 8).astype(np.uint64) & np.uint64(0xFFFF)) % np.uint64(buckets)
    else:
        at = np.fromiter((zlib.crc32(w) for w in keys), np.uint64, len(keys)) % np.uint64(buckets)
    order = np.argsort(at, kind="stable")
    found, first = np.unique(at[order], return_index=True)
    return zip(found.tolist(), np.split(order, first[1:]), strict=True)


@dataclass
class _Block:
    """What a block's texts hold, text after text."""

    strings: np.ndarray  # of all texts
    first: np.ndarray  # the first string of each text
    words: list[bytes]  # distinct, in order, the end token among them
    word: np.ndarray  # which of ``words`` each word is; end tokens have no entry
    text: np.ndarray  # the text of each word
    size: np.ndarray  # bytes of each text
    end: int  # which of ``words`` the end token is


def _read_block(rows: pa.Table) -> _Block:
    strings, first, word, text, size = [], [], [], [], []
    known: dict[int, int] = {}
    names, n_strings, n_texts = [_END_TOKEN], 0, 0
    for batch in rows.combine_chunks().to_batches():
        for part in slices(batch, "text"):
            data, at = as_arrays(part.column("text"))
            value, begin = _strings(data, at)
            found = words_of(data, at, _TOKEN_BYTES)
            hashes, sample, inverse = np.unique(found.hash, return_index=True, return_inverse=True)
            low = data.tobytes().lower()
            for h, start, stop in zip(hashes.tolist(), found.start[sample].tolist(), found.end[sample].tolist(), strict=True):
                if h not in known:
                    known[h] = len(names)
                    names.append(low[start:stop])
            strings.append(value)
            first.append(begin + n_strings)
            word.append(np.fromiter((known[h] for h in hashes.tolist()), np.int32, len(hashes))[inverse])
            text.append((found.text_of() + n_texts).astype(np.int32))
            size.append(np.diff(at))
            n_strings, n_texts = n_strings + len(value), n_texts + part.num_rows
    order = sorted(range(len(names)), key=names.__getitem__)
    place = np.empty(len(names), np.int32)
    place[order] = np.arange(len(names), dtype=np.int32)
    strings, first, word, text, size = (np.concatenate(x) for x in (strings, first, word, text, size))
    return _Block(strings, first, [names[k] for k in order], place[word], text, size, int(place[0]))


def _distinct(ordered: np.ndarray) -> np.ndarray:
    """Positions where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _look_up(keys: np.ndarray, values: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The values of strings that are all among ``keys``, which are in order.

    A string of six bytes and its place among 65,536 fit one number, so that plain sorts do for an order of places.
    """
    out = np.empty(len(strings), values.dtype)
    for start in range(0, len(strings), 1 << 16):
        part = strings[start : start + (1 << 16)].astype(np.uint64)
        placed = np.sort((part << np.uint64(16)) | np.arange(len(part), dtype=np.uint64))
        own = (placed >> np.uint64(16)).astype(np.int64)
        fresh = _distinct(own)
        found = values[np.searchsorted(keys, own[fresh])]
        out[start + (placed & np.uint64(0xFFFF)).astype(np.int64)] = np.repeat(found, np.diff(np.append(fresh, len(own))))
    return out


def _ask(rows: pa.Table, buckets: int) -> pa.Table:
    """Distinct strings and words of a block, both in order, with their counts in its training texts, by bucket."""
    block, learn = _read_block(rows), rows["learn"].to_numpy().astype(bool)
    marked = (block.strings << 1) | np.repeat(learn, np.diff(np.append(block.first, len(block.strings))))
    marked.sort()
    fresh = _distinct(marked >> 1)
    grams, gram_counts = marked[fresh] >> 1, np.add.reduceat(marked & 1, fresh)
    word_counts = np.bincount(block.word[learn[block.text]], minlength=len(block.words)).astype(np.int64)
    word_counts[block.end] = learn.sum()
    out = []
    for kind, keys, counts in ((_GRAM, grams, gram_counts), (_WORD, block.words, word_counts)):
        for bucket, at in _by_bucket(kind, keys, buckets):
            own = keys[at] if kind == _GRAM else [keys[k] for k in at]
            out.append((rows["block"][0].as_py(), kind, bucket, _pack_keys(kind, own), _pack(counts[at])))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KINDS, strict=True)], names=["block", "kind", "bucket", "keys", "n"])


_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
_PACKED = "block bigint, kind int, bucket int, keys binary, n binary"


def _merge_grams(sums: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if sums is None:
        return keys, n
    found, inverse = np.unique(np.concatenate([sums[0], keys]), return_inverse=True)
    return found, np.bincount(inverse, weights=np.concatenate([sums[1], n]), minlength=len(found)).astype(np.int64)


def _rows_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS, strict=True)], ["block", "kind", "bucket", "keys", "n"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corpus counts per bucket, from the rows of all blocks in the order of buckets."""
    for (kind, bucket), rows in groupby(_rows_in_order(batches), lambda r: (r["kind"], r["bucket"])):
        if kind == _WORD:
            total: Counter = Counter()
            for row in rows:
                for word, n in zip(_unpack_keys(kind, row["keys"]), _unpack(row["n"], np.int64).tolist(), strict=True):
                    total[word] += n
            keys, counts = list(total), np.array(list(total.values()), np.int64)
        else:
            sums, held, size = None, [], 0
            for row in rows:  # merge when as much has come as is held already
                held.append((_unpack_keys(kind, row["keys"]), _unpack(row["n"], np.int64)))
                size += len(held[-1][0])
                if size > max(1 << 20, 0 if sums is None else len(sums[0])):
                    sums, held, size = _merge_grams(sums, *map(np.concatenate, zip(*held, strict=True))), [], 0
            if held:
                sums = _merge_grams(sums, *map(np.concatenate, zip(*held, strict=True)))
            keys, counts = _merge_grams(sums, np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield _as_batch([(-1, kind, bucket, _pack_keys(kind, keys), _pack(counts))])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of the keys that blocks ask for; a bucket's own row, block -1, comes before the asking rows."""
    for row in _rows_in_order(batches):
        kind, keys = row["kind"], _unpack_keys(row["kind"], row["keys"])
        if row["block"] < 0:
            if kind == _GRAM:
                known, values = keys, _unpack(row["n"], np.float64)
            else:
                known = dict(zip(keys, _unpack(row["n"], np.int64).tolist(), strict=True))
        else:
            found = values[np.searchsorted(known, keys)] if kind == _GRAM else np.array([known[w] for w in keys], np.int64)
            yield _as_batch([(row["block"], kind, row["bucket"], b"", _pack(found))])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, led back to x > 0."""
    low = np.ones_like(x)
    for k in range(8):
        low = low * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(low)


def _log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov log probability of any sequence with so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1.0)


def _weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes and the share of their own estimate in it; ``below``: sum over the children."""
    own = _log_estimate(zeros, ones)
    if below is None:
        return own, np.ones_like(own)
    total = np.logaddexp(own, below) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


def _decisions(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node (1 to 255) and bit of the eight decisions of each symbol."""
    k = np.arange(8)
    return (1 << k) | (symbols[:, None] >> (8 - k)), (symbols[:, None] >> (7 - k)) & 1


def _tree(keys: np.ndarray, n: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Nodes of depths 2 to DEPTH for strings that share their two-byte contexts; weighted from the leaves up.

    ``at`` of a level: the node of each decision (string by bit).
    """
    decision, bit = _decisions(keys & 0xFF)
    levels: list[dict[str, np.ndarray]] = []
    for depth in range(2, DEPTH + 1):
        context = (keys >> 8) & ((1 << (8 * depth)) - 1)
        ids, at = np.unique((context[:, None] << 8) | decision, return_inverse=True)
        at = at.reshape(decision.shape)
        counts = [np.bincount(at.ravel(), weights=(np.where(bit == b, n[:, None], 0)).ravel(), minlength=len(ids)) for b in (0, 1)]
        levels.append({"ids": ids, "at": at, "zeros": counts[0], "ones": counts[1]})
    below = None
    for depth in range(DEPTH, 1, -1):
        level = levels[depth - 2]
        level["log"], level["share"] = _weigh(level["zeros"], level["ones"], below)
        if depth > 2:
            context, node = level["ids"] >> 8, level["ids"] & 0xFF
            parent = ((context & ((1 << (8 * (depth - 1))) - 1)) << 8) | node
            upper = levels[depth - 3]["ids"]
            below = np.bincount(np.searchsorted(upper, parent), weights=level["log"], minlength=len(upper))
    return levels


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of depth 2 of each bucket, summed up for depth 1: (last byte and decision, counts, sum of the logs)."""
    for row in _rows_in_order(batches):
        level = _tree(_unpack_keys(_GRAM, row["keys"]), _unpack(row["n"], np.int64))[0]
        upper, inverse = np.unique(level["ids"] & 0xFFFF, return_inverse=True)
        sums = [np.bincount(inverse, weights=level[k], minlength=len(upper)) for k in ("zeros", "ones", "log")]
        yield pa.RecordBatch.from_arrays([pa.array(upper), *map(pa.array, sums)], ["node", "zeros", "ones", "log"])


def _bit_probability(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)


def _string_logs(keys: np.ndarray, n: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each string of a bucket after the bytes before it.

    ``top`` and ``low``: zeros, ones and share of the nodes of depth 0 (by decision) and 1 (by byte and decision).
    """
    levels, (decision, bit) = _tree(keys, n), _decisions(keys & 0xFF)
    mixed = np.full(decision.shape, 0.5)
    for level in levels[::-1]:
        share, zeros, ones = (level[k][level["at"]] for k in ("share", "zeros", "ones"))
        mixed = np.where(zeros + ones > 0, share * _bit_probability(zeros, ones, bit) + (1 - share) * mixed, 0.5)
    last = ((keys >> 8) & 0xFF)[:, None]
    for zeros, ones, share in ([x[last, decision] for x in low], [x[decision] for x in top]):
        mixed = np.where(zeros + ones > 0, share * _bit_probability(zeros, ones, bit) + (1 - share) * mixed, 0.5)
    return np.log10(mixed).sum(axis=1)


def _score_block(rows: pa.Table, answers: pa.Table, buckets: int, tokens: int, vocabulary: int) -> pa.Table:
    """Scores of a block's texts from the answers to what it asked for."""
    block = _read_block(rows)
    ordered = np.sort(block.strings)
    keys = ordered[_distinct(ordered)]
    del ordered
    logs, counts = np.zeros(len(keys)), np.zeros(len(block.words), np.int64)
    packed = {(a["kind"], a["bucket"]): a["n"] for a in answers.to_pylist()}
    for kind, own, values in ((_GRAM, keys, logs), (_WORD, block.words, counts)):
        for bucket, at in _by_bucket(kind, own, buckets):
            values[at] = _unpack(packed[kind, bucket], values.dtype.type)
    cost = np.log10((counts + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
    texts = len(block.size)
    out = (
        np.add.reduceat(_look_up(keys, logs, block.strings), block.first),
        block.size,
        np.bincount(block.text, weights=cost[block.word], minlength=texts) + cost[block.end],
        np.bincount(block.text, minlength=texts) + 1,
        np.bincount(block.text, weights=counts[block.word] > 0, minlength=texts) + (counts[block.end] > 0),
    )
    kinds = (pa.float64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    columns = {c: pa.array(x.astype(t.to_pandas_dtype()), t) for c, x, t in zip(("score", "bytes", "base", "n", "known"), out, kinds, strict=True)}
    return pa.table({"doc_id": rows["doc_id"], "learn": pc.equal(rows["learn"], True), **columns})


def score_texts(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """Score every row of ``docs``, which has a ``doc_id``, by a model of the rows where ``learn`` holds.

    Columns: doc_id, learn, log10_probability, bits_per_byte (code length over bytes, the end symbol included), and the
    word baseline: n_tokens, n_known, train_tokens, base_log10.
    """
    spark = docs.sparkSession
    _, size = volume(docs, text)
    blocks = max(shuffle_width(spark), -(-size // BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), utf8(text).alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    rows = rows.repartition(blocks, "block")  # a task holds a few blocks, whatever the volume
    buckets = max(64, shuffle_width(spark), -(-size // BUCKET_BYTES))
    asked = stored(rows.groupBy("block").applyInArrow(lambda t: _ask(t, buckets), _PACKED), "asked", "kind")
    together = lambda df: df.repartition(buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket", "block")
    merged = stored(together(asked.select("block", "kind", "bucket", "keys", "n")).mapInArrow(_merge, _PACKED), "counted", "kind")
    merged = merged.select("block", "kind", "bucket", "keys", "n")
    grams, words = merged.filter(F.col("kind") == _GRAM), merged.filter(F.col("kind") == _WORD)

    roots = grams.mapInArrow(_roots, "node bigint, zeros double, ones double, log double")
    depth_1 = roots.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log")]).toPandas()  # at most 256 * 255
    low, top = np.zeros((3, 256, 256)), np.zeros((3, 256))
    last, decision = depth_1["node"].to_numpy() >> 8, depth_1["node"].to_numpy() & 0xFF
    log, share = _weigh(depth_1["zeros"].to_numpy(), depth_1["ones"].to_numpy(), depth_1["log"].to_numpy())
    low[:, last, decision] = depth_1["zeros"], depth_1["ones"], share
    zeros, ones, below = (np.bincount(decision, weights=x, minlength=256) for x in (depth_1["zeros"], depth_1["ones"], log))
    top[:] = zeros, ones, _weigh(zeros, ones, below)[1]
    sent = spark.sparkContext.broadcast((top, low))

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_in_order(batches):
            found = _string_logs(_unpack_keys(_GRAM, row["keys"]), _unpack(row["n"], np.int64), *sent.value)
            yield _as_batch([(-1, _GRAM, row["bucket"], row["keys"], _pack(found))])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_in_order(batches):
            n = _unpack(row["n"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([int((n > 0).sum())])], ["n", "v"])

    total = words.mapInArrow(sums, "n bigint, v bigint").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0
    values = grams.mapInArrow(logs, _PACKED).unionByName(words)
    questions = asked.select("block", "kind", "bucket", "keys", F.lit(b"").alias("n"))
    answers = together(values.unionByName(questions)).mapInArrow(_answer, _PACKED)
    scored = rows.groupBy("block").cogroup(answers.repartition(blocks, "block").groupBy("block")).applyInArrow(
        lambda own, found: _score_block(own, found, buckets, n, v),
        "doc_id bigint, learn boolean, score double, bytes bigint, base double, n bigint, known bigint",
    )
    return scored.select(
        "doc_id",
        "learn",
        F.col("score").alias("log10_probability"),
        (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("bytes") + 1)).alias("bits_per_byte"),
        F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_log10"),
    )
