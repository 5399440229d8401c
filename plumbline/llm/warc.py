"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing: a response record per page; of records with equal payloads of ``REVISIT_BYTES`` or more, the one with the
largest page id is the response and the others revisit it. Spark's text writer puts the records one after another.

Reading does not trust the magic line, which may stand in a payload. Archives are read in splits. Each split yields a
candidate record at every magic line, with the offset where its successor must begin by its own lengths. Chains are
followed by pointer jumping: inside each split in numpy, then between the entry points of splits by joins that double
the reach each round, from the start of every file. Only records on the chain of their file are kept. A group is never
larger than a split's candidates. Payloads that contain the magic are cut at it by the reader; those of chained
records, and only those, are put together again from their fragments.

Null and empty payloads are empty. A null page id takes part as itself and is never the one that others revisit.
Repeated rows (equal id and payload) are responses all. A file that does not begin with a record has none; a chain
that breaks off ends there. Line ends in URLs become blanks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import stored, utf8

REVISIT_BYTES = 1000
MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"
_DATE = "2020-01-01T00:00:00Z"


def _lines(*pairs: tuple[str, object]) -> list:
    out = []
    for name, value in pairs:
        out += [F.lit(f"{name}: "), value if not isinstance(value, str) else F.lit(value), F.lit("\r\n")]
    return out


def write_archives(pages: DataFrame, path: str, records_per_file: int = 5000, date: str = _DATE) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) to files of at most ``records_per_file`` below ``path``."""
    payload = utf8("html")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").alias("size"), F.sha1("payload").alias("digest"))
    copies = (
        rows.filter((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.min("page_id").alias("least"))
        .filter("response_id > least")
        .drop("least")
    )
    # Stored, so that its true size decides whether it is sent to all tasks or joined by a shuffle.
    copies = stored(copies, "copies")
    key = F.when(F.col("size") >= REVISIT_BYTES, F.col("digest"))
    rows = rows.withColumn("digest_key", key).join(copies.withColumnRenamed("digest", "digest_key"), "digest_key", "left")
    revisit = F.coalesce(F.col("response_id") != F.col("page_id"), F.lit(False))
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), *_lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("size").cast("string"))), F.lit("\r\n")
    )
    rows = rows.withColumn("http", http).withColumn("revisit", revisit)
    block_size = F.length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    header = F.concat(
        F.lit(MAGIC),
        *_lines(
            ("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", named(F.col("page_id"))),
            ("WARC-Date", date),
            ("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]+", " ")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), named(F.col("response_id")), F.lit("\r\n"))).otherwise(F.lit("")),
        *_lines(("Content-Type", "application/http; msgtype=response"), ("Content-Length", block_size.cast("string"))),
        F.lit("\r\n"),
        F.col("http"),
    )
    record = F.concat(header.cast("binary"), F.when(~F.col("revisit"), F.col("payload")).otherwise(F.lit(b"")))
    # The line separator is the end of a record.
    rows.select(record.cast("string").alias("value")).write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).text(path)


_CANDIDATES = (
    "file string, block bigint, at bigint, length bigint, end bigint, whole boolean, preamble boolean, "
    "record_type string, record_id string, refers_to string, uri string, payload_bytes bigint, payload_digest string, claimed_digest string, claimed_bytes bigint"
)


def _fields(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n"))
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isdecimal() and len(text) < 19 else None


def _parse(body: bytes) -> tuple[int | None, bool, dict, bytes]:
    """Length of the record by its headers, whether ``body``, what follows its magic, is just that; headers, block."""
    stop = body.find(b"\r\n\r\n")
    headers = _fields(body[:stop]) if stop >= 0 else {}
    size = _number(headers.get("content-length"))
    if size is None:
        return None, False, headers, b""
    end = stop + 4 + size
    return end + 4, len(body) == end + 4 and body.endswith(b"\r\n\r\n"), headers, body[stop + 4 : end]


def _described(headers: dict, block: bytes) -> tuple:
    """Payload and what the headers say: type, id, refers to, uri, payload size and digest, claimed digest and size."""
    http, _, payload = block.partition(b"\r\n\r\n")
    claimed = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return (
        headers.get("warc-type"),
        headers.get("warc-record-id"),
        headers.get("warc-refers-to"),
        headers.get("warc-target-uri"),
        len(payload),
        hashlib.sha1(payload).hexdigest(),
        claimed,
        _number(_fields(http).get("content-length")),
    )


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magic lines, in the order of each split."""
    rows = spark.read.option("lineSep", MAGIC).text(path)
    return rows.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """File, split, position of the fragment's first byte from the first of its split, and the fragment."""
    before, at = None, 0
    for batch in batches:
        for value, file, block in zip(*(batch.column(c) for c in ("value", "file", "block")), strict=True):
            key = (file.as_py(), block.as_py())
            if key != before:
                before, at = key, 0
            body = bytes(value.as_buffer())
            yield (*key, at, body)
            at += len(body) + len(MAGIC)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every fragment as a possible record: its offset, the offset its successor must have, what its headers say."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _CANDIDATES.split(", ")]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.bool_(), pa.bool_(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.int64()]
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for file, block, at, body in _places(batches):
            preamble = block == 0 and at == 0
            length, whole, headers, content = (None, False, {}, b"") if preamble else _parse(body)
            told = _described(headers, content) if whole else (None,) * 8
            rows.append((file, block, at, len(body), length if length is None else at + length, whole, preamble, *told))
            if len(rows) == 2000:
                yield flush()
                rows = []
        if rows:
            yield flush()

    found = stored(_fragments(spark, path).mapInArrow(scan, _CANDIDATES), "candidates")
    # Splits hold the fragments that begin in them, so their sizes add up to the offsets in the file.
    sizes = found.groupBy("file", "block").agg(F.sum(F.col("length") + len(MAGIC)).alias("_size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    shift = lambda c: (F.col(c) + F.col("_start")).alias(c)
    names = [c for c in found.columns if c not in ("at", "end")]
    # ``at`` is the place of the magic line, which ends where the fragment begins.
    placed = found.join(starts, ["file", "block"]).select(*names, (shift("at") - len(MAGIC)).alias("at"), shift("end"))
    return stored(placed, "placed")


def _following(at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of each candidate's successor in the split, or its own if there is none."""
    own = np.arange(len(at))
    place = np.minimum(np.searchsorted(at, end), len(at) - 1)
    return np.where((at[place] == end) & (end > at), place, own)


def _exits(table: pa.Table) -> pa.Table:
    """Where the chain from each candidate of a split leaves the split."""
    at, end = table["at"].to_numpy(), table["end"].to_numpy()
    order = np.argsort(at)
    at, end = at[order], end[order]
    jump = _following(at, end)
    while not np.array_equal(jump, jump[jump]):
        jump = jump[jump]
    return pa.table({"file": table["file"], "at": at, "exit": end[jump]})


def _chained(table: pa.Table) -> pa.Table:
    """Candidates of a split that lie on a chain from one of its entries."""
    order = np.argsort(table["at"].to_numpy())
    at, end, on = (table[c].to_numpy(zero_copy_only=False)[order] for c in ("at", "end", "entry"))
    on, jump = on.astype(bool), _following(at, end)
    while True:
        reached = on.copy()
        reached[jump[on]] = True
        following = jump[jump]
        if np.array_equal(following, jump) and np.array_equal(reached, on):
            break
        on, jump = reached, following
    return pa.table({"file": table["file"].take(pa.array(np.flatnonzero(on))), "at": at[on]})


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records on the chains of all files below ``path``: offset, type, ids, payload size and digest."""
    placed = candidates(spark, path)
    links = placed.filter("end IS NOT NULL AND NOT preamble")
    jumps = links.groupBy("file", "block").applyInArrow(_exits, "file string, at bigint, exit bigint")
    reached = links.filter("at = 0").select("file", "at")
    splits = placed.groupBy("file").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    rounds = math.ceil(math.log2(splits)) if splits > 1 else 0
    for last in range(rounds - 1, -1, -1):  # after each round the reach is twice as far
        jumps = stored(jumps, "jumps")
        reached = stored(reached.union(reached.join(jumps, ["file", "at"]).select("file", F.col("exit").alias("at"))).distinct(), "reached")
        if last:
            further = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("_far"))
            jumps = jumps.join(further, ["file", "exit"], "left").select("file", "at", F.coalesce("_far", "exit").alias("exit"))
    marked = links.select("file", "block", "at", "end").join(reached.withColumn("entry", F.lit(True)), ["file", "at"], "left")
    marked = marked.select("file", "block", "at", "end", F.coalesce("entry", F.lit(False)).alias("entry"))
    chain = stored(marked.groupBy("file", "block").applyInArrow(_chained, "file string, at bigint"), "chain")
    kept = links.join(chain, ["file", "at"]).drop("block", "length", "preamble")
    whole, cut = kept.filter("whole"), stored(kept.filter("NOT whole").select("file", "at", "end"), "cut")
    if cut.isEmpty():
        return whole.drop("whole")
    return whole.drop("whole").unionByName(_reassembled(spark, path, placed, cut).select(whole.drop("whole").columns))


def _reassembled(spark: SparkSession, path: str, placed: DataFrame, cut: DataFrame) -> DataFrame:
    """Chained records whose payload holds the magic, from the fragments between their ends."""
    marks = placed.join(cut.select("file").distinct(), "file", "left_semi").select("file", "block", "at", "length")
    owner = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = marks.join(cut.select("file", "at", "end", F.col("at").alias("_owner")), ["file", "at"], "left")
    owned = owned.select("file", "block", "at", F.last("_owner", True).over(owner).alias("owner"), F.last("end", True).over(owner).alias("end"))
    owned = stored(owned.filter("at < end"), "owned")
    first = placed.groupBy("file", "block").agg((F.min("at") + len(MAGIC)).alias("_start"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, at, body in _places(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([at]), pa.array([body], pa.binary())], ["file", "block", "at", "body"]
            )

    pieces = _fragments(spark, path).mapInArrow(place, "file string, block bigint, at bigint, body binary")
    pieces = pieces.join(first, ["file", "block"]).withColumn("at", F.col("at") + F.col("_start") - len(MAGIC)).drop("_start")
    pieces = pieces.join(owned.select("file", "at", "owner", "end"), ["file", "at"])

    def join(table: pa.Table) -> pa.Table:
        order = np.argsort(table["at"].to_numpy())
        body = MAGIC.encode().join(table["body"][int(k)].as_py() for k in order)
        _, whole, headers, content = _parse(body)
        file, owner, end = (table[c][0].as_py() for c in ("file", "owner", "end"))
        told = _described(headers, content) if whole else (None,) * 8
        return pa.Table.from_pylist([dict(zip(names, (file, owner, end, *told), strict=True))], schema=schema)

    names = ["file", "at", "end", "record_type", "record_id", "refers_to", "uri", "payload_bytes", "payload_digest", "claimed_digest", "claimed_bytes"]
    schema = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.int64()], strict=True)))
    kinds = "file string, at bigint, end bigint, record_type string, record_id string, refers_to string, uri string, payload_bytes bigint, payload_digest string, claimed_digest string, claimed_bytes bigint"
    return pieces.groupBy("file", "owner").applyInArrow(join, kinds)
