"""Ranked search, mixing and the Merkle manifest against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF

from plumbline.llm import merkle, mixing, ranked_search
from plumbline.llm.base import table
from plumbline.llm.queries import REGISTRY

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# Ranked search


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked_by_hand(docs, items, k=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, math.inf if doc_id is None else doc_id))
        out += [(item_id, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [4 << 20, 900])
def test_best_documents(spark, odd_documents, odd_folder, monkeypatch, chunk):
    """Odd rows, ties of repeated rows, one chunk of items and many."""
    monkeypatch.setattr(ranked_search, "CHUNK_BYTES", chunk)
    docs = odd_documents.select("doc_id", "text").unionByName(table(spark, SF, "documents").select("doc_id", "text"))
    items = table(spark, f"{odd_folder}/full", "benchmark").unionByName(table(spark, SF, "benchmark")).select("item_id", "text")
    items = items.unionByName(items.limit(3))
    got = sorted((tuple(r) for r in ranked_search.search(docs, items).collect()), key=str)
    assert got == ranked_by_hand([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])


def random_lists(rng, documents, top):
    lists = []
    for _ in range(rng.integers(1, 6)):
        doc = rng.permutation(documents)[: rng.integers(1, documents + 1)]
        lists.append((doc, np.sort(rng.integers(0, top, len(doc)))[::-1].astype(np.int64)))
    return lists


@pytest.mark.parametrize("top", [3, 1000])
def test_intervals_settle_all_that_may_be_best(monkeypatch, top):
    """With few different impacts nearly all is tied, with many reading ends early; known scores only narrow the result."""
    monkeypatch.setattr(ranked_search, "FIRST_READ", 1)
    rng = np.random.default_rng(5)
    for _ in range(300):
        documents, k = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        lists, known = random_lists(rng, documents, top), rng.integers(1, 3 * top, rng.integers(0, k + 1))
        total = np.zeros(documents, np.int64)
        for doc, impact in lists:
            total[doc] += impact
        pool = np.sort(np.concatenate([known, total]))[::-1]
        least = max(1, int(pool[k - 1]) if len(pool) >= k else 0)
        found, score = ranked_search.resolve(lists, documents, k, known)
        assert found.tolist() == np.flatnonzero(total >= least).tolist() and score.tolist() == total[found].tolist()


def test_reading_stops_early():
    """A clear winner ends the reading long before the lists do."""

    class Watched(np.ndarray):
        deepest = 0

        def __getitem__(self, key):
            if isinstance(key, slice) and key.stop:
                Watched.deepest = max(Watched.deepest, key.stop)
            return super().__getitem__(key)

    n = 100_000
    doc = np.arange(n).view(Watched)
    impact = np.where(np.arange(n) < 20, 1000 - np.arange(n), 1).astype(np.int64)
    found, _ = ranked_search.resolve([(doc, impact), (doc, impact)], n, 10, np.zeros(0, np.int64))
    assert found.tolist() == list(range(10)) and Watched.deepest < 1000


# Mixing


def mix_by_hand(rows, weights=(5, 2, 1), most=3):
    """Bisection for every source, then copies one document at a time."""
    sources = defaultdict(list)
    for doc_id, source, text in rows:
        sources[source].append((len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), doc_id))
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    size = {s: sum(n for n, _ in sources[s]) for s in names}
    full = set()
    while True:
        left = [s for s in names if s not in full]
        share = (sum(size.values()) - sum(most * size[s] for s in full)) / sum(weight[s] for s in left) if left else 0
        more = {s for s in left if weight[s] * share >= most * size[s]}
        if not more:
            break
        full |= more
    out = {}
    for s in names:
        target = float(most * size[s]) if s in full else weight[s] * share
        low, high = -50.0, 50.0
        for _ in range(200):
            m = (low + high) / 2
            took = sum(n * min(most, math.exp(min(700, m * n))) for n, _ in sources[s])
            low, high = (low, m) if took > target else (m, high)
        m = math.inf if s in full else m
        out[s] = size[s], target, {n: most if s in full and n else min(most, math.exp(min(700, m * n))) if n else 1 for n, _ in sources[s]}
    return out


@pytest.mark.parametrize("folder", ["sf", "odd"])
def test_mix(spark, odd_documents, folder):
    docs = table(spark, SF, "documents") if folder == "sf" else odd_documents
    want = mix_by_hand([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()])
    got = defaultdict(list)
    for r in mixing.mix(docs).collect():
        got[r["source"]].append(r)
    assert got.keys() == want.keys()
    for source, (size, target, rates) in want.items():
        rows = sorted(got[source], key=lambda r: (-r["size"], r["doc_id"] is None, r["doc_id"] or 0))
        assert {r["source_size"] for r in rows} == {size} and all(math.isclose(r["target"], target) for r in rows)
        assert all(math.isclose(r["rate"], rates[r["size"]], rel_tol=1e-3, abs_tol=1e-6) for r in rows)
        assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in rows)
        assert abs(sum(r["taken"] for r in rows) - target) <= max((r["size"] for r in rows), default=0)
        total = 0
        for r in rows:
            before, total = total, total + round(r["rate"] * mixing.UNIT)
            assert r["copies"] == (total + mixing.UNIT // 2) // mixing.UNIT - (before + mixing.UNIT // 2) // mixing.UNIT


def test_full_sources_hand_on_their_excess(spark):
    """A small source stops at three times its size; a source of any weight does when nothing else is left."""
    docs = spark.createDataFrame([(k, "abc"[k % 3] if k < 9 else "d", "w " * (10 if k < 9 else 1000)) for k in range(12)], "doc_id int, source string, text string")
    rows = {r["source"]: r for r in mixing.mix(docs, weights=(8, 1, 1)).collect()}
    assert rows["a"]["target"] == 90.0 and rows["a"]["rate"] == 3.0
    assert math.isclose(sum(r["target"] for r in rows.values()), 3090)
    assert rows["b"]["target"] == rows["c"]["target"] == 90.0


def test_mix_does_not_depend_on_partitions(spark):
    docs = table(spark, SF, "documents")
    one, many = (sorted(mixing.mix(d).collect()) for d in (docs.coalesce(1), docs.repartition(13, "text")))
    assert one == many


# Manifest


def test_van_emde_boas_order():
    """Every node has its own place, the upper half of the levels comes first, subtrees lie together."""
    for levels in range(1, 12):
        places = np.concatenate([merkle.address(d, np.arange(1 << d), levels) for d in range(levels)])
        assert sorted(places) == list(range((1 << levels) - 1))
        upper = levels // 2
        assert sorted(places[: (1 << upper) - 1]) == list(range((1 << upper) - 1))
        if levels > 1:
            low = [merkle.address(d, np.arange(1 << (d - upper)), levels) for d in range(upper, levels)]
            size = (1 << (levels - upper)) - 1
            assert sorted(np.concatenate(low)) == list(range((1 << upper) - 1, (1 << upper) - 1 + size))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def layers_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def path_by_hand(layers, k):
    found = []
    for layer in layers[:-1]:
        found += layer[k ^ 1 : (k ^ 1) + 1]
        k >>= 1
    return found


@pytest.mark.parametrize("height", [1, 2, 12])
def test_manifest_of_many_layers(spark, height):
    """Trees of 1 to 21 leaves in blocks of 2, 4 and 4096 leaves have the same roots and proofs; a changed leaf is found."""
    rows = [(f"={n:02d}" if n else "", k, sha(f"{n}/{k}")) for n in (0, 1, 2, 3, 4, 5, 8, 9, 21) for k in range(max(1, n))]
    leaves = spark.createDataFrame(rows, "tree string, doc_id bigint, leaf string").selectExpr(
        "*", "CASE WHEN doc_id = 3 THEN sha2('other', 256) ELSE leaf END AS claimed"
    )
    trees = defaultdict(list)
    for tree, _, leaf in rows:
        trees[tree].append(leaf)
    known = {t: layers_of(v) for t, v in trees.items()}
    top = layers_of([known[t][-1][0] for t in sorted(known)])
    want = {
        trees[t][k]: (v[-1][0], top[-1][0], sha("".join(path_by_hand(v, k) + path_by_hand(top, sorted(known).index(t)))), k != 3)
        for t, v in known.items()
        for k in range(len(v[0]))
    }
    found = merkle.proofs(merkle.manifest(leaves.repartition(3), height), "claimed").collect()
    assert {r["leaf"]: (r["subroot"], r["root"], r["proof_sha256"], r["verified"]) for r in found} == want
    assert len(found) == len(rows)


def test_saved_manifest(spark, tmp_path):
    leaves = spark.range(10).selectExpr("'=x' AS tree", "id AS doc_id", "sha2(cast(id AS string), 256) AS leaf")
    merkle.manifest(leaves, height=2).save(str(tmp_path / "manifest"))
    back = spark.read.parquet(str(tmp_path / "manifest"))
    assert {(r["part"], r["layer"]): r["count"] for r in back.groupBy("part", "layer").count().collect()} == {("trees", 0): 3, ("trees", 1): 1, ("top", 0): 1}


def test_nulls_and_repeated_rows_in_leaves(spark, odd_folder, odd_documents):
    found = REGISTRY["op13_merkle"](spark, f"{odd_folder}/full").collect()
    assert len(found) == odd_documents.count() and all(r["verified"] for r in found if r["doc_id"] is None)
    assert len({r["root"] for r in found}) == 1
