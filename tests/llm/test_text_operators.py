"""Language ID, sharding, decontamination and packing against brute force."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF

from plumbline.llm import decontaminate, language_id, packing, sharding
from plumbline.llm.base import remainder, table
from plumbline.llm.queries import REGISTRY

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


# Language ID


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = REGISTRY["op3_language_id"](spark, sf).filter("held_out")
    rows = found.join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) > 0.98 * len(rows)


def slot_by_hand(gram):
    """The hash of an n-gram, of the last character first, in plain integers."""
    value = sum(ord(c) * f for c, f in zip(reversed(gram), (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False)) % 2**32
    value = (value + len(gram) - 1) * 0x27D4EB2F % 2**32
    value = (value ^ value >> 15) * 0x165667B1 % 2**32
    return value >> 16


def slots_by_hand(text):
    """Counts of the slots of all n-grams of a text, one by one."""
    plain = re.sub(r"\s+", " ", " " + "".join(c if c.isalpha() else " " for c in text.lower()))
    return Counter(slot_by_hand(plain[k : k + n]) for n in (1, 2, 3) for k in range(len(plain) - n + 1))


def posterior_by_hand(rows, texts):
    """(language, probability) of each text by multinomial naive Bayes, from training rows (text, language)."""
    langs = sorted({lang for _, lang in rows})
    counts = {lang: sum((slots_by_hand(t) for t, own in rows if own == lang), Counter()) for lang in langs}
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        total = np.array([
            np.log(sum(own == lang for _, own in rows) / len(rows))
            + sum(n * (np.log(counts[lang][s] + 0.5) - np.log(counts[lang].total() + 0.5 * 65536)) for s, n in slots_by_hand(text).items())
            for lang in langs
        ])
        share = np.exp(total - total.max())
        out.append((langs[int(share.argmax())], share.max() / share.sum()))
    return out


def test_scoring_holds_little_at_once():
    """A batch takes no more than its slices do, whatever its size, and no copy as Python values."""
    draw = np.random.default_rng(3)
    part = language_id.Part(["a", "b"], np.log([0.4, 0.6]), np.hstack([draw.normal(size=(2, language_id.SLOTS)), np.zeros((2, 1))]))
    texts = pa.array([b"" if k % 9 == 0 else f"text {k} some words ".encode() * (k % 97) for k in range(4000)], pa.binary())
    language_id.scores(texts[:10], part)
    tracemalloc.start()
    got = language_id.scores(texts, part)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 32 << 20
    whole = [x.tolist() for x in language_id.score(texts, part)]
    assert [list(r.values()) for r in got.to_pylist()] == [list(r) for r in zip(*whole, strict=True)]


@pytest.mark.parametrize("side", [256, 1, 2])
def test_scores_by_hand(spark, monkeypatch, side):
    """Counts and posterior from plain n-grams; the matrix in one part and in many, with more labels than a part holds."""
    monkeypatch.setattr(language_id, "SIDE", side)
    rows = [("der Hund und die Katze", "de"), ("the dog and the cat", "en"), ("", "en"), ("El perro, 12 y el gato!", "es"), ("le chien  et le chat", "fr"), ("the the", "en"), ("ça été", "fr")]
    docs = spark.createDataFrame([*rows, (None, "en"), ("x", None)], "text string, lang string")
    texts = ["the Katze!", "", None, "123 !!", "perro chat", "Der the", "ÇA", "e", "x" * 500 + " the", "el le"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = language_id.identify(asked, language_id.train(docs)).orderBy("doc_id").collect()
    for r, (lang, share) in zip(found, posterior_by_hand(rows, texts), strict=True):
        assert r["lang_pred"] == lang and np.isclose(r["lang_score"], share), r


def test_many_labels(spark):
    """More labels than one part of the matrix holds."""
    docs = spark.range(700).selectExpr("id AS doc_id", "lpad(id, 4, '0') AS lang", "repeat(concat(translate(lpad(id, 3, '0'), '0123456789', 'abcdefghij'), ' '), 20) AS text")
    found = language_id.identify(docs, language_id.train(docs))
    assert found.filter("lang_pred = lang").count() > 690


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id int, text string, lang string")
    found = language_id.identify(docs, language_id.train(docs)).first()
    assert (found["lang_pred"], found["lang_score"]) == ("und", 0.0)


# Sharding


def jump_by_hand(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for shards in (1, 2, 7, 40, 41):
        assert sharding.jump(keys, shards).tolist() == [jump_by_hand(int(k), shards) for k in keys]


def test_slots_are_gapless_and_growth_is_local(spark):
    rows = REGISTRY["op4_sharding"](spark, SF).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, SF, "documents").collect()}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 16, zlib.crc32(texts[r["doc_id"]])) for r in rows)


def test_write_shards(spark, odd_documents, tmp_path):
    sharding.write_shards(odd_documents, str(tmp_path / "out"), "doc_id", 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd_documents.count()
    assert back.groupBy("doc_id").agg({"shard": "approx_count_distinct"}).filter("`approx_count_distinct(shard)` > 1").isEmpty()


# Decontamination


def contamination_by_hand(docs, items, width=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            wanted.setdefault(tuple(w[k : k + width]), set()).add(str(item) if item is not None else "null")
    sizes, out = {len(k) for k in wanted}, []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if items_of := wanted.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= items_of
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [4 << 20, 3000])
def test_contamination(spark, monkeypatch, chunk):
    """Also with many chunks of items, and an index of all terms."""
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", chunk)
    sf = "/root/testdata/sf0.01" if chunk > 10_000 else SF
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    got = sorted((tuple(r) for r in REGISTRY["op5_decontamination"](spark, sf).collect()), key=str)
    assert got == contamination_by_hand(docs, items)
    assert any(r[-1] for r in got)


def test_contamination_of_odd_rows(spark, odd_folder):
    sf = f"{odd_folder}/full"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    got = sorted((tuple(r) for r in REGISTRY["op5_decontamination"](spark, sf).collect()), key=str)
    assert got == contamination_by_hand(docs, items)


def test_proximity(spark):
    texts = {1: "a b c d e f", 2: "a x x x x b", 3: "b a", 4: "a", 5: "c a a c b x a", 6: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    index = decontaminate.build_index(docs)
    got = decontaminate.proximity_matches(index, {"ab": ["a", "b"], "abc": ["a", "b", "c"], "none": []}, 3).collect()
    for query, need in (("ab", {"a", "b"}), ("abc", {"a", "b", "c"})):
        hits = {d for d, t in texts.items() if t and any(need <= set(t.split()[k : k + 3]) for k in range(len(t.split())))}
        assert {r["doc_id"] for r in got if r["query"] == query} == hits
    for r in got:
        assert r["end"] - r["start"] <= 3 and set(r["query"]) <= set(texts[r["doc_id"]].split()[r["start"] : r["end"]])


# Packing


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, encode = Tokenizer.from_file(path), packing.encoder(path)
    texts = ["", " ", "  a", "a  b", "a \n b", "it's  John's", "x\n\n y", " lead", "trail ", "<|endoftext|> a", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>", "<|endoftext", "ß É 東京 🙂 　 z", "a\t b", "1 22 333,4", "a   b    c"]
    for text in texts + ["Hello world " * 50]:
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("sizes", [[1], [0, 1, 2048, 4096, 5000, 300, 256, 255], list(range(1, 700, 7)), [3000] * 50, [1] * 5000, []])
def test_windows(sizes):
    seen, tails = Counter(), 0
    for tier, window in packing.pack(sizes):
        total = sum(end - start for _, start, end in window)
        assert total == tier if tier else 0 < total < 2048
        tails += not tier
        for doc, start, end in window:
            seen.update((doc, k) for k in range(start, end))
    assert seen == Counter((d, k) for d, n in enumerate(sizes) for k in range(n)) and tails <= 1


def test_packing_round_trip(spark, odd_documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    marked = spark.createDataFrame([(900, "a <|endoftext|> b"), (901, "<|endoftext|>")], "doc_id bigint, text string")
    docs = odd_documents.select("doc_id", "text").unionByName(marked)
    rows = packing.pack_documents(docs, path, with_ids=True).collect()
    sequences, tiers = {}, {}
    for r in rows:
        ids = np.array(r["ids"], "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) == (r["length"], r["ids_crc32"])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        tiers.setdefault(r["sequence_id"], set()).add((r["tier"], r["step"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences))) and all(len(t) == 1 for t in tiers.values())
    pieces = Counter()
    for r in docs.collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        pieces[r["doc_id"], len(ids)] += len(ids)
    got = Counter()
    for r in rows:
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert got == pieces


def test_steps_share_tiers(spark):
    rows = packing.pack_documents(table(spark, "/root/testdata/sf0.01", "documents"), public_tokenizers.path("byte_bpe_50k.json"), step_tokens=1 << 16)
    counts = rows.filter("offset = 0").groupBy("tier", "step").count().collect()
    for tier in (2048, 1024, 512, 256):
        n = [r["count"] for r in counts if r["tier"] == tier]
        assert max(n) - min(n) <= 1


def test_learning_rows(spark):
    rows = spark.range(200).select("id", remainder("id", 3).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)
