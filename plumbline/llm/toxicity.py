"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

Disguise is written as a lattice. A span that mixes letters with look-alike characters, repeats a letter three times
or more, or spaces out single letters has several readings: each look-alike stands for its letters or for a break,
runs are kept or shortened to two or one, spaces are kept or dropped. Viterbi search finds the reading that is
likeliest under the channel's costs and a character trigram model of the whole corpus; spans of one shape in a slice
are decoded together in numpy. Text outside such spans has one reading only, itself.

The score knows words and word beginnings, by hash, of labelled texts. A feature counts when its share of toxic texts
is beyond chance, given how many features were looked at; it then has the shrunk share as its probability, and a text
has the probability that any of its words is toxic. Near copies among the labelled rows, classes by
their minhash values, are counted once for each label; every other labelled row teaches.

Bounds: the trigram table has 64^3 entries; labels are a sample of at most about ``LABELLED`` rows, chosen by hash. The
model keeps every feature with evidence. The evidence asked for is that of several toxic texts at least, so there are
fewer such features than different words in the sample's toxic texts, whatever the size of the corpus.

Null and empty texts have the base score, as has any text without known words. Rows with a null label teach nothing;
without labels of both kinds every text has score 0. Repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import jaccard_join
from plumbline.llm.base import by_slices, release, slices, stored, utf8
from plumbline.llm.words import Words, mix, words_and_prefixes

LABELLED = 50_000
#: Near copies share this part of their runs of so many words.
COPY_WORDS, COPY_SIMILARITY = 5, 0.8
PREFIXES = (4, 5, 6, 7)
#: Look-alikes and the letters they stand for: fixed values.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
    "*": "aeioubcdfghjklmnpqrstvwxyz",
}
#: Log costs of the channel: a look-alike for a letter, a star for a consonant, a look-alike kept as a break within a
#: run, standing alone, as usual punctuation or markup around a run, as another sign there, a shortened run, dropped spaces.
SUBSTITUTED, MASKED, BROKEN, ALONE, AROUND, OUTSIDE, SHORTENED, JOINED = -1.0, -2.5, -5.0, -2.0, -2.0, -6.0, -2.0, -2.0
CACHED_WORDS = 100_000
_SYMBOLS = 64
_MARKS = "".join(re.escape(c) for c in LOOK_ALIKES)
_SIGNS = "".join(re.escape(c) for c in LOOK_ALIKES if not c.isalnum())
#: Letters and look-alikes spaced out by any separators, one of them or a double one at a time, three at least.
_APART = rf"(?<![^\W_])([^\W_]|[{_SIGNS}])\1?(?:(?:_|[^\w{_SIGNS}]){{1,2}}([^\W_]|[{_SIGNS}])\2?){{2,}}(?![^\W_])"
#: The same with look-alikes as separators: one kind between letters, or stars among others.
_STARRED = r"(?<![^\W_])[^\W_](?:[ .\-_*]{1,2}[^\W_]){3,}(?![^\W_])"
_SIGNED = rf"(?<![^\W_])[^\W\d_]([{_SIGNS}])[^\W\d_](?:\3[^\W\d_])+(?![^\W_])"
_SPACED = re.compile(f"{_APART}|{_STARRED}|{_SIGNED}")
_RUN = re.compile(rf"[\w{_MARKS}]+")
_OUTER = re.compile(rf"([{_SIGNS}]*)(.*?)([{_SIGNS}]*)", re.DOTALL)
_THRICE = re.compile(r"([^\W\d_])\1\1")
#: What any disguised word holds.
_HINT = re.compile(rf"[{_MARKS}]|([^\W\d_])\1\1")
#: Pairs that look like one letter when they stand spaced out.
_PAIRS = {"nn": "m", "vv": "w"}


#: Classes of a code point: letter, mark or digit; look-alike; sign among these; break between spaced letters; the same
#: when starred; letter that counts when it stands three times; space.
_ALNUM, _MARK, _SIGN, _BREAK, _STAR_BREAK, _LETTER, _SPACE = (np.uint8(1 << k) for k in range(7))


@cache
def _class_of() -> np.ndarray:
    """Classes of each code point, as regular expressions and ``str.split`` see them."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(0x110000, _BREAK, np.uint8)
    for pattern, classes in ((r"[^\W_]+", _ALNUM), (r"[^\W\d_]+", _ALNUM | _LETTER), (r"\s+", _BREAK | _SPACE)):
        for m in re.finditer(pattern, every):
            out[m.start() : m.end()] = classes
    for c in LOOK_ALIKES:
        out[ord(c)] |= _MARK
        if not c.isalnum():
            out[ord(c)] = out[ord(c)] & ~_BREAK | _SIGN
    for c in " .-_*":
        out[ord(c)] |= _STAR_BREAK
    return out


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of texts that are put together with line ends around them, their classes, and where each text begins.

    Some line ends follow the last text, so that a look ahead stays inside.
    """
    joined = "\n" + "\n".join(texts) + "\n" * 8
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
    return points, _class_of()[points], begin


@cache
def _symbol_of() -> np.ndarray:
    """Symbol of each code point: 0 for all but letters, 1 to 26 for a to z, other letters shared out."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        if chr(i).isalpha():
            out[i] = i - 96 if 97 <= i <= 122 else 27 + i % 37
    return out


def _symbols(texts: list[str]) -> np.ndarray:
    points = np.frombuffer((" " + " ".join(t.lower() for t in texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _symbol_of()[points]
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    keep[0] = True
    return symbols[keep].astype(np.int64)


def train_characters(docs: DataFrame) -> np.ndarray:
    """Log probability of a symbol after two others, over all texts: an array of 64 x 64 x 64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                s = _symbols([_text(t) for t in part.column("text")])
                total += np.bincount((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=_SYMBOLS**3) if len(s) > 2 else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = docs.select(utf8("text").alias("text")).mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(_SYMBOLS**3)
    n[found["at"]] = found["n"]
    n = n.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    share = np.full(_SYMBOLS, 1 / _SYMBOLS)
    for counts in (n.sum(axis=(0, 1)), n.sum(axis=0), n):  # each order is smoothed by the one below
        share = (counts + 5 * share) / (counts.sum(axis=-1, keepdims=True) + 5)
    return np.log(share).astype(np.float32)


def _text(value: pa.Scalar) -> str:
    return bytes(value.as_buffer()).decode("utf-8", "replace")


Position = list[tuple[str, int, float]]  # readings of one character: text, symbol, cost


def _around(signs: str) -> float:
    """Cost of signs at the begin or end of a run as what they are: by run for !, * and three of a kind, by sign for others."""
    kinds = [m[0] for m in re.finditer(r"(.)\1*", signs)]
    return sum(AROUND if k[0] in "!*" or len(k) > 2 else OUTSIDE * len(k) for k in kinds)


@lru_cache(10_000)
def _position(c: str, kept: float = BROKEN) -> Position:
    """Readings of one character; the list is shared."""
    symbol_of = _symbol_of()
    letters = LOOK_ALIKES.get(c)
    if letters:
        return [(x, int(symbol_of[ord(x)]), MASKED if c == "*" and x not in "aeiou" else SUBSTITUTED) for x in letters] + [(c, 0, kept)]
    return [(c, int(symbol_of[ord(c)]), 0.0)]


def _readings(span: str) -> list[tuple[float, list[Position], bool]]:
    """Lattices of a span, one for each way to treat its spaces, runs and outer signs, and whether parts stand alone."""
    def forms(text: str, cost: float) -> dict[str, float]:
        found = {text: cost}
        for most in (2, 1):
            found.setdefault(re.sub(r"([^\W\d_])\1{2,}", lambda m, k=most: m[1] * k, text), cost + SHORTENED)
        return found

    def lattices(found: dict[str, float]) -> list[tuple[float, list[Position], bool]]:
        out = []
        for form, cost in found.items():
            out.append((cost, [_position(c) for c in form], False))
            lead, core, trail = _OUTER.fullmatch(form).groups()
            if core and (lead or trail):
                inner = [_position(c) for c in core]
                inner[0] = [(lead + x, *rest) for x, *rest in inner[0]]
                inner[-1] = [(x + trail, *rest) for x, *rest in inner[-1]]
                out.append((cost + _around(lead) + _around(trail), inner, False))
        return out

    if not _SPACED.fullmatch(span):
        return lattices(forms(span, 0.0))
    apart = re.fullmatch(_APART, span)
    between = re.compile(rf"(?:_|[^\w{_SIGNS}])+" if apart else r"[\W_]+")
    parts = between.split(span)
    joined = forms("".join(parts), JOINED)
    joined.setdefault("".join(p[:1] for p in parts), JOINED + SHORTENED)
    joined.setdefault("".join(_PAIRS.get(p, p) for p in parts), JOINED + SUBSTITUTED)
    out = [(0.0, [[(c, 0, 0.0)] if between.fullmatch(c) else _position(c, ALONE) for c in span], True)]
    return out + lattices(joined) + ([] if apart else lattices(forms(span, 0.0)))


def decode(spans: list[str], model: np.ndarray) -> list[str]:
    """The likeliest reading of each span."""
    alone = model.copy()
    alone[:, 0, 0] = 0.0  # breaks in a row are one break
    lattices = [(k, *reading) for k, span in enumerate(spans) for reading in _readings(span.lower())]
    best: list[tuple[float, int, str]] = [(-np.inf, 0, s) for s in spans]
    by_shape = defaultdict(list)
    for order, entry in enumerate(lattices):  # of equal readings the first one counts, whatever else is decoded
        wide = tuple(i for i, position in enumerate(entry[2]) if len(position) > 8)  # a star has 27 readings
        by_shape[len(entry[2]), wide, entry[3]].append((*entry, -order))
    for (length, wide, parted), group in by_shape.items():
        step = max(1, (100 if len(wide) > 1 else 2_000) if wide else 200_000 // length)
        for at in range(0, len(group), step):
            part = group[at : at + step]
            best_paths = _viterbi([g[2] for g in part], length, alone if parted else model)
            for (k, cost, lattice, _, order), (score, path) in zip(part, best_paths, strict=True):
                if (cost + score, order) > best[k][:2]:
                    best[k] = cost + score, order, "".join(lattice[i][r][0] for i, r in enumerate(path))
    return [text for *_, text in best]


def _viterbi(lattices: list[list[Position]], length: int, model: np.ndarray) -> Iterator[tuple[float, list[int]]]:
    """Best score and path of lattices of one length; the state is the pair of the last two readings."""
    b, symbols, costs = len(lattices), [], []
    for column in zip(*lattices, strict=True):  # as wide as its widest position
        width = max(map(len, column))
        symbol, cost = np.zeros((b, width), np.int64), np.full((b, width), -np.inf, np.float32)
        for x, position in enumerate(column):
            for z, (_, s, c) in enumerate(position):
                symbol[x, z], cost[x, z] = s, c
        symbols.append(symbol)
        costs.append(cost)
    # The begin and the end are positions of their own with one reading, the break.
    symbols.append(np.zeros((b, 1), np.int64))
    costs.append(np.zeros((b, 1), np.float32))
    before, here = symbols[-1], symbols[0]
    state = (model[0, 0, here] + costs[0])[:, None, :]
    back = []
    for i in range(1, length + 1):
        after = symbols[i]
        most, chosen = None, np.zeros((b, here.shape[1], after.shape[1]), np.uint8)
        for p in range(before.shape[1]):
            total = state[:, p, :, None] + model[before[:, p, None, None], here[:, :, None], after[:, None, :]]
            if most is None:
                most = total
            else:
                better = total > most
                most = np.where(better, total, most)
                chosen[better] = p
        back.append(chosen)
        state = most + costs[i][:, None, :]
        before, here = here, after
    rows = np.arange(b)
    last = state[:, :, 0].argmax(axis=1)
    score = state[rows, last, 0]
    path = [last]
    following = np.zeros(b, np.int64)
    for i in range(length - 1, 0, -1):
        here = back[i][rows, path[-1], following]
        following = path[-1]
        path.append(here)
    return zip(score.tolist(), np.stack(path[::-1], axis=1).tolist(), strict=True)


@dataclass
class Model:
    characters: np.ndarray
    base: float = 0.0
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))  # probability of each


_restored: dict[tuple[float, str], str] = {}


def _spaced(texts: list[str]) -> dict[int, list[tuple[int, int]]]:
    """Where ``_SPACED`` matches, by text.

    A match is looked for only where one can begin: at a single or double character between breaks that is followed by
    another one, or at a letter, a sign, a letter and the sign again.
    """
    points, classes, begin = _points(texts)
    n = len(points) - 8
    alnum, sign = classes & _ALNUM != 0, classes & _SIGN != 0

    def ahead(x: np.ndarray, k: int) -> np.ndarray:
        return x[1 + k : n + k]

    gap, twice = classes & _BREAK != 0, points[:-1] == points[1:]
    short = np.zeros(len(points), bool)
    short[:-2] = (alnum | sign)[:-2] & (gap[1:-1] | (twice[:-1] & gap[2:]))
    starred = np.zeros(len(points), bool)
    starred[:-1] = alnum[:-1] & (classes[1:] & _STAR_BREAK != 0)
    may = ahead(short, 0) & (ahead(short, 2) | ahead(short, 3) | ahead(short, 4))
    may |= ahead(starred, 0) & (ahead(starred, 2) | ahead(starred, 3))
    may |= ahead(alnum, 0) & ahead(sign, 1) & ahead(alnum, 2) & (ahead(points, 1) == ahead(points, 3))
    may &= ~alnum[: n - 1]
    at = np.flatnonzero(may) + 1
    owner = np.searchsorted(begin, at, "right") - 1
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for k, i in zip(owner.tolist(), (at - begin[owner]).tolist(), strict=True):
        if found[k] and i < found[k][-1][1]:
            continue
        if m := _SPACED.match(texts[k], i):
            found[k].append(m.span())
    return {k: spans for k, spans in found.items() if spans}


def _hinted(texts: list[str]) -> dict[int, list[tuple[int, int]]]:
    """Where words lie that hold what ``_HINT`` looks for, by text."""
    points, classes, begin = _points(texts)
    hint = classes & _MARK != 0
    hint[:-2] |= (classes[:-2] & _LETTER != 0) & (points[:-2] == points[1:-1]) & (points[1:-1] == points[2:])
    space = classes & _SPACE != 0
    start, end = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    word = np.unique(np.searchsorted(start, np.flatnonzero(hint), "right") - 1)
    start, end = start[word], end[word]
    owner = np.searchsorted(begin, start, "right") - 1
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for k, a, b in zip(owner.tolist(), (start - begin[owner]).tolist(), (end - begin[owner]).tolist(), strict=True):
        found[k].append((a, b))
    return found


def _replaced(text: str, spans: list[tuple[int, int]], reading: dict[str, str]) -> str:
    out, at = [], 0
    for a, b in spans:
        out += [text[at:a], reading[text[a:b]]]
        at = b
    return "".join([*out, text[at:]])


def _disguised(run: str) -> bool:
    """Whether a run holds a letter and a look-alike or a letter three times, or is made of several kinds of signs."""
    if any(c in LOOK_ALIKES for c in run):
        if any(c.isalpha() for c in run):
            return True
        return len(run) >= 3 and len(set(run)) >= 2 and not any(c.isalnum() or c == "_" for c in run)
    return _THRICE.search(run) is not None


def _spans(word: str) -> list[tuple[int, int]]:
    """Parts of a word that may be disguised: runs of letters and look-alikes."""
    return [m.span() for m in _RUN.finditer(word) if _disguised(m[0])]


def restore(texts: list[str], characters: np.ndarray) -> list[str]:
    """Texts in lower case with every disguised span in its likeliest reading. Words seen lately are looked up."""
    if not texts:
        return []
    if len(_restored) > CACHED_WORDS:
        _restored.clear()
    model = float(characters[0, 0, 1])  # readings depend on the model
    low = [t.lower() for t in texts]
    single = _spaced(low)
    spaced = list({low[k][a:b] for k, spans in single.items() for a, b in spans})
    if spaced:
        reading = dict(zip(spaced, decode(spaced, characters), strict=True))
        for k, spans in single.items():
            low[k] = _replaced(low[k], spans, reading)
    hinted = _hinted(low)
    marked = {low[k][a:b] for k, spans in hinted.items() for a, b in spans}
    new = [w for w in marked if (model, w) not in _restored]
    found = {w: _spans(w) for w in new}
    pieces = list({w[a:b] for w, spans in found.items() for a, b in spans})
    clear = dict(zip(pieces, decode(pieces, characters), strict=True))
    for word, spans in found.items():
        _restored[model, word] = _replaced(word, spans, clear)
    seen = {w: _restored[model, w] for w in marked}
    for k, spans in hinted.items():
        low[k] = _replaced(low[k], spans, seen)
    return low


def _features(texts: list[str]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of the texts, and the features: hash and word of each."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words, prefixes = words_and_prefixes(data, at, PREFIXES)
    hashes, owner = [words.hash], [np.arange(len(words.hash))]
    for k, (long, cut) in zip(PREFIXES, prefixes, strict=True):
        hashes.append(mix(cut + np.uint64(k)))
        owner.append(long)
    return words, np.concatenate(hashes), np.concatenate(owner)


def teaching_rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(toxic, text) of the rows of ``docs`` with a label, one of each class of near copies and label.

    Near copies are told by their sampled values alone, so texts are stored once, when it is known which of them teach.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("text"))
    # At most about LABELLED rows of two numbers: small enough to be sent to every executor.
    rows = texts.join(F.broadcast(known), "doc_id")
    sampled = stored(jaccard_join.representatives(rows, COPY_WORDS), "labelled")
    sets = stored(sampled.groupBy("rep").agg(F.first("sampled").alias("sampled"), F.first("size").alias("size")), "labelled-sets")
    roots = jaccard_join.components(jaccard_join.sampled_edges(sets.filter("size > 0").select("rep", "sampled"), COPY_SIMILARITY))
    named = sampled.select("doc_id", "rep").join(F.broadcast(known), "doc_id").join(roots, F.col("rep") == F.col("node"), "left")
    first = named.groupBy(F.coalesce("root", "rep"), F.col("toxic") > 0).agg(F.min(F.struct("doc_id", "rep")).alias("first"))
    # Rows that occur once, nearly all, are taken where they lie; only repeated rows have to meet.
    times = sampled.groupBy("doc_id", "rep").agg(F.count(F.lit(1)).alias("times"))
    first = stored(first.select("first.doc_id", "first.rep").distinct().join(times, ["doc_id", "rep"]), "teaching")
    own = _with_rep(rows).join(F.broadcast(first), ["doc_id", "rep"])
    once, often = own.filter("times = 1"), own.filter("times > 1").dropDuplicates(["doc_id", "rep"])
    return stored(once.unionByName(often).select("toxic", "text"), "taught")


def _with_rep(rows: DataFrame) -> DataFrame:
    """(doc_id, toxic, text) with ``rep``, the hash of the text's set of shingles."""

    def each(part: pa.RecordBatch) -> pa.RecordBatch:
        rep = jaccard_join.set_hashes(part, COPY_WORDS)
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(rep)], ["doc_id", "toxic", "text", "rep"])

    return by_slices(rows.select("doc_id", "toxic", "text"), "text", each, "doc_id bigint, toxic int, text binary, rep bigint")


def _feature_counts(rows: DataFrame, characters: np.ndarray) -> DataFrame:
    """(feature, toxic texts, other texts) over the rows; every text counts a feature once."""
    sent = rows.sparkSession.sparkContext.broadcast(characters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, hashes, owner = _features(restore([_text(t) for t in part.column("text")], sent.value))
                text = words.text_of()[owner]
                order = np.lexsort((text, hashes))
                hashes, text = hashes[order], text[order]
                fresh = np.ones(len(hashes), bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)
                found, inverse = np.unique(hashes[fresh], return_inverse=True)
                bad = toxic[text[fresh]] > 0
                n = [np.bincount(inverse[bad == b], minlength=len(found)).astype(np.int64) for b in (True, False)]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *map(pa.array, n)], ["feature", "bad", "good"])

    counts = rows.mapInArrow(run, "feature bigint, bad bigint, good bigint")
    return counts.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); hand in only labels that may be learned from."""
    model = Model(train_characters(docs))
    known = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "labels")
    rows = known.count()
    if rows > LABELLED:  # a share of all hashes
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(int((1 << 40) * LABELLED / rows)))
    sample = teaching_rows(docs, known)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return model
    model.base = bad / (bad + good)
    counts = stored(_feature_counts(sample, model.characters), "features")
    looked_at = counts.count()
    share = F.col("bad") / (F.col("bad") + F.col("good"))
    gain = F.col("bad") * F.log(share / model.base) + F.when(
        F.col("good") > 0, F.col("good") * F.log((1 - share) / (1 - model.base))
    ).otherwise(0.0)
    strong = counts.filter((F.col("bad") > 0) & (share > model.base)).withColumn("gain", gain).filter(F.col("gain") > float(np.log(10.0 * looked_at)))
    shrunk = (F.col("bad") + 2 * model.base) / (F.col("bad") + F.col("good") + 2)
    found = strong.withColumn("share", shrunk).filter("share >= 0.75").select("feature", "share").toPandas()
    hashes = found["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    model.features, model.share = hashes[order], found["share"].to_numpy(float)[order]
    return model


def score(texts: list[str], model: Model) -> np.ndarray:
    """Probability that a text is toxic."""
    out = np.full(len(texts), model.base / 2)
    if not len(model.features) or not texts:
        return out
    words, hashes, owner = _features(restore(texts, model.characters))
    at = np.searchsorted(model.features, hashes)
    known = model.features[np.minimum(at, len(model.features) - 1)] == hashes
    if not known.any():
        return out
    # The strongest feature of each word, and each word once per text.
    found = pd.DataFrame({"text": words.text_of()[owner[known]], "word": words.hash[owner[known]], "share": model.share[at[known]]})
    most = found.groupby(["text", "word"])["share"].max().clip(upper=0.9999)
    none = np.exp(np.log1p(-most).groupby("text").sum())
    out[none.index] = np.maximum(out[none.index], 1 - none.to_numpy())
    return out


def rate(docs: DataFrame, model: Model, text: str | Column = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``toxicity``, 0 to 1.

    Only the text is read. A column named ``toxicity`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def predict(values: pa.Array) -> pa.Array:
        release()  # what earlier stages and batches left in this worker
        out = []
        for part in slices(pa.RecordBatch.from_arrays([values], ["text"]), "text"):
            out.append(score([_text(t) for t in part.column("text")], sent.value))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "toxicity"]
    return docs.select(*rest, predict(utf8(text)).alias("toxicity"))
