"""Language ID: multinomial naive Bayes over hashed character n-grams.

The counts of all training texts are summed per language and hash slot, in numpy inside the tasks and then by Spark.
The log-probability matrix, one row per slot and one column per language, is broadcast in parts of at most ``SIDE``
languages, so a part has a fixed bound and the number of languages has none. A text is scored as a sparse vector of slot
counts: rows of the matrix are gathered and summed per text. Each part gives its best language and the sum of its
probabilities, and the parts are put together in the row.

Null, empty or letterless text: ``und`` with score 0. Rows without a language or text teach nothing. Without any
training row every text is ``und``. Ties go to the alphabetically first language. Repeated rows count as often as
they occur, and each of them is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import release, slices, stored, utf8

SLOTS = 1 << 16
ORDERS = (1, 2, 3)
#: Languages of one part of the matrix: 128 MB.
SIDE = 256
SMOOTHING = 0.5
#: Bytes of text scored at once: the arrays for it are about fifty times as large.
SCORED_BYTES = 1 << 18
UNDETERMINED = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass
class Part:
    languages: list[str]
    prior: np.ndarray  # log share of training texts, by language
    weight: np.ndarray  # log probability, language by slot; the last slot is zero


@dataclass
class Model:
    parts: list[Part]  # languages in alphabetical order

    @property
    def languages(self) -> list[str]:
        return [name for part in self.parts for name in part.languages]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First position of each text, whether it has a letter, and the slot of the n-gram that ends at each position.

    Texts are lower-cased and every run of other characters is one blank, as is the begin of a text. Positions where
    an n-gram would begin before its text have the slot ``SLOTS``.
    """
    rows = [" " + bytes(t.as_buffer()).decode("utf-8", "replace").lower() for t in texts]
    points = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])[:-1]
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts] = True
    kept = np.where(letter, points, np.uint32(32))[keep]
    position = np.concatenate([[0], np.cumsum(keep)])
    first = position[starts]
    has_letter = np.add.reduceat(letter.astype(np.int64), starts) > 0
    since = np.arange(len(kept)) - np.repeat(first, np.diff(np.append(first, len(kept))))
    slots, value = [], np.zeros(len(kept), np.uint32)
    for k in range(max(ORDERS)):
        value[k:] += kept[: len(kept) - k] * _FACTORS[k]
        if k + 1 in ORDERS:
            spread = (value + np.uint32(k)) * np.uint32(0x27D4EB2F)
            spread ^= spread >> np.uint32(15)
            spread *= np.uint32(0x165667B1)
            slots.append(np.where(since >= k, spread >> np.uint32(16), SLOTS).astype(np.int64))
    return first, has_letter, slots


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, slot, n) of the rows' texts; slot -1 holds the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                languages = np.array(part.column("lang").to_pylist(), object)
                for language in sorted(set(languages)):
                    chosen = pa.array(languages == language)
                    texts = part.column("text").filter(chosen)
                    total = sums.setdefault(language, np.zeros(SLOTS + 2, np.int64))
                    total[-1] += len(texts)
                    for slot in _grams(texts)[2]:
                        total[:-1] += np.bincount(slot, minlength=SLOTS + 1)
        for language, total in sums.items():
            total[-2] = 0
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(at), pa.string()), pa.array(np.where(at > SLOTS, -1, at)), pa.array(total[at])],
                ["lang", "slot", "n"],
            )
        sums.clear()
        release()

    return docs.mapInArrow(run, "lang string, slot bigint, n bigint")


def train(docs: DataFrame) -> Model:
    """Fit on (text, lang); rows where either is null are left out."""
    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).dropna()
    sums = _counts(rows.select(utf8("text").alias("text"), "lang")).groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    counts = stored(sums, "language-counts")
    sizes = counts.filter("slot = -1").orderBy("lang").collect()  # a name and a number for each language
    texts, parts = sum(r["n"] for r in sizes), []
    for at in range(0, len(sizes), SIDE):
        some = sizes[at : at + SIDE]
        languages = [r["lang"] for r in some]
        inside = F.col("lang").between(languages[0], languages[-1])
        found = counts.filter(inside & (F.col("slot") >= 0)).toPandas()  # at most SIDE * SLOTS rows
        total = np.zeros((len(languages), SLOTS))
        total[found["lang"].map({v: k for k, v in enumerate(languages)}), found["slot"]] = found["n"]
        weight = np.log(total + SMOOTHING) - np.log(total.sum(axis=1, keepdims=True) + SMOOTHING * SLOTS)
        prior = np.log(np.array([r["n"] for r in some], float) / texts)
        parts.append(Part(languages, prior, np.hstack([weight, np.zeros((len(languages), 1))])))
    return Model(parts)


def score(texts: pa.Array, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of a part for each text (bytes), its log probability with the text, and that of all its languages.

    A text without letters has none.
    """
    if not len(texts):
        return np.zeros(0, object), np.zeros(0), np.zeros(0)
    first, has_letter, slots = _grams(texts)
    total = np.tile(part.prior, (len(texts), 1))
    for k, column in enumerate(part.weight):
        total[:, k] += np.add.reduceat(sum(column.take(slot) for slot in slots), first)
    best, most = total.argmax(axis=1), total.max(axis=1)
    every = most + np.log(np.exp(total - most[:, None]).sum(axis=1))
    return np.where(has_letter, np.array(part.languages, object)[best], None), most, every


def scores(texts: pa.Array, part: Part) -> pa.Array:
    """``score`` of all texts, as structs, in slices of bounded size."""
    out = [score(texts[:0], part)]
    for rows in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", SCORED_BYTES):
        out.append(score(rows.column("text"), part))
    columns = [pa.array(np.concatenate(c), t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.float64(), pa.float64()), strict=True)]
    return pa.StructArray.from_arrays(columns, ["lang", "most", "every"])


def identify(docs: DataFrame, model: Model, text: str | Column = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``lang_score``; columns of these names are replaced.

    The text itself is what the model sees; no other column is read.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "lang_score")]
    found = [_scored(docs.sparkSession, part)(utf8(text)) for part in model.parts]
    if not found:
        return docs.select(*rest, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("lang_score"))
    rows = docs.select(*rest, F.array(*found).alias("_found"))
    # Of equal parts the first has the alphabetically first language.
    best = F.reduce(
        "_found", F.get("_found", F.lit(0)), lambda a, x: F.when(x["most"] > a["most"], x).otherwise(a)
    )
    every = F.reduce("_found", F.lit(0.0), lambda a, x: a + F.exp(x["every"] - F.array_max(F.transform("_found", lambda y: y["every"]))))
    top = F.array_max(F.transform("_found", lambda y: y["every"]))
    share = F.exp(best["most"] - top) / every
    named = best["lang"].isNotNull()
    return rows.select(
        *rest, F.coalesce(best["lang"], F.lit(UNDETERMINED)).alias("lang_pred"), F.when(named, share).otherwise(0.0).alias("lang_score")
    )


def _scored(spark: SparkSession, part: Part):
    sent = spark.sparkContext.broadcast(part)

    @F.arrow_udf("lang string, most double, every double")
    def predict(values: pa.Array) -> pa.Array:
        release()  # what earlier stages and batches left in this worker
        return scores(values, sent.value)

    return predict
