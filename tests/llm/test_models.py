"""Context-tree weighting, toxicity and outliers against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import ctw, outliers, toxicity, words
from plumbline.llm.base import table
from plumbline.llm.queries import REGISTRY

# Context-tree weighting


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


class Tree:
    """The trees as the definition has them: dictionaries of counts, probabilities by recursion."""

    def __init__(self, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)

    def steps(self, text):
        data = bytes([ctw.BEGIN] * self.depth) + text + bytes([ctw.END])
        for i in range(self.depth, len(data)):
            node = 1
            for k in range(7, -1, -1):
                bit = data[i] >> k & 1
                yield data[i - self.depth : i], node, bit
                node = node * 2 + bit

    def learn(self, text):
        for context, node, bit in self.steps(text):
            for d in range(self.depth + 1):
                own = context[self.depth - d :]
                self.n[node, own][bit] += 1
                if d:
                    self.children[node, own[1:]].add(own)

    def log_weighted(self, node, own):
        estimate = kt(*self.n[node, own])
        if len(own) == self.depth:
            return estimate
        below = sum(self.log_weighted(node, c) for c in self.children[node, own])
        return np.logaddexp(estimate, below) - math.log(2)

    def probability(self, context, node, bit, d=0):
        own = context[self.depth - d :]
        n = self.n.get((node, own), [0, 0])
        estimate = (n[bit] + 0.5) / (sum(n) + 1)
        if not sum(n):
            return 0.5
        if d == self.depth:
            return estimate
        share = math.exp(kt(*n) - math.log(2) - self.log_weighted(node, own))
        return share * estimate + (1 - share) * self.probability(context, node, bit, d + 1)

    def log10(self, text):
        return sum(math.log10(self.probability(*s)) for s in self.steps(text))


def test_scores_are_those_of_the_definition(spark):
    texts = ["abracadabra abracadabra", "abra cadabra", "", None, "barb", "éa"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    tree = Tree(ctw.DEPTH)
    for k, t in enumerate(texts):
        if k != 4:
            tree.learn((t or "").encode())
    from pyspark.sql import functions as F

    rows = ctw.score_texts(docs, learn=F.col("doc_id") != 4).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert r["log10_probability"] == pytest.approx(tree.log10(text), abs=1e-6)
        assert r["bits_per_byte"] == pytest.approx(-r["log10_probability"] / math.log10(2) / (len(text) + 1))


def test_probabilities_sum_to_one():
    keys = np.unique(np.random.default_rng(2).integers(97, 101, (300, ctw.DEPTH + 1)) @ (256 ** np.arange(ctw.DEPTH + 1)))
    context = int(keys[0]) >> 8
    asked = np.union1d(keys, (context << 8) + np.arange(256))
    n = np.isin(asked, keys).astype(np.int64) * 3
    bits = ctw._tree(asked, n)
    assert len(bits) == ctw.DEPTH - 1
    some = np.ones((3, 256)), np.ones((3, 256, 256)) * 0.5
    logs = ctw._string_logs(asked, n, *some)
    assert (10.0 ** logs[(asked >> 8) == context]).sum() == pytest.approx(1)


def test_strings_are_looked_up_in_any_number():
    strings = np.random.default_rng(3).integers(0, 1 << 20, 200_000) << 28 | 0xFF
    keys = np.unique(strings)
    values = np.random.default_rng(4).random(len(keys))
    assert np.array_equal(ctw._look_up(keys, values, strings), values[np.searchsorted(keys, strings)])
    assert ctw._look_up(keys, values, strings[:1]).tolist() == [values[keys.searchsorted(strings[0])]]


def test_words_of_a_block():
    texts = [b"One two\x00 ONE\x0b\xc3\x89", b"", b" \t\n", b"two\x00\xc3\xa9 two " * 3, b"x" * 3_000_000]
    rows = pa.table({"text": pa.array(texts, pa.binary())})
    block = ctw._read_block(rows)
    assert block.words == sorted(block.words) and block.words[block.end] == b" "
    for k, text in enumerate(texts):
        assert [block.words[w] for w in block.word[block.text == k]] == text.lower().split()
    assert block.size.tolist() == [len(t) for t in texts]
    assert np.diff([*block.first, len(block.strings)]).tolist() == [len(t) + 1 for t in texts]


def test_word_baseline(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, sf, "documents").collect()}
    low = {k: re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), t)) + [None] for k, t in docs.items()}
    held = {k for k in docs if zlib.crc32(str(k).encode()) % 10 == 0}
    count = Counter(w for k, t in low.items() if k not in held for w in t)
    n, v = sum(count.values()), len(count)
    for r in REGISTRY["op6_ctw"](spark, sf).collect():
        own = low[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (r["doc_id"] in held, len(own), sum(w in count for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))


# Toxicity


@pytest.fixture(scope="module")
def characters(spark):
    return toxicity.train_characters(table(spark, "/root/testdata/sf0.01", "documents"))


def test_viterbi_finds_the_best_path(characters):
    random = np.random.default_rng(3)
    for length in (1, 2, 3, 5):
        lattices = [[[("x", int(s), float(c)) for s, c in zip(random.integers(0, 64, w), -random.random(w), strict=True)] for w in random.integers(1, 4, length)] for _ in range(20)]
        for lattice, (score, path) in zip(lattices, toxicity._viterbi(lattices, length, characters), strict=True):

            def cost(choice, lattice=lattice):
                s = [0, 0, *(lattice[i][r][1] for i, r in enumerate(choice)), 0]
                return sum(lattice[i][r][2] for i, r in enumerate(choice)) + sum(float(characters[a, b, c]) for a, b, c in zip(s, s[1:], s[2:], strict=False))

            best = max(map(cost, itertools.product(*[range(len(p)) for p in lattice])))
            assert score == pytest.approx(best, abs=1e-3) and cost(path) == pytest.approx(best, abs=1e-3)


@pytest.mark.parametrize(
    "text, clear",
    [("1d10t", "idiot"), ("m0r0n!", "moron!"), ("s.c.u.m", "scum"), ("stuuuupid", "stupid"), ("tr@sh", "trash"), ("$tupid", "stupid"),
     ("l o s e r", "loser"), ("d1sgust1ng", "disgusting"), ("Plain text, 12 of it.", "plain text, 12 of it."), ("", "")],
)
def test_restored_words(characters, text, clear):
    assert toxicity.restore([text], characters) == [clear]


@pytest.mark.parametrize(
    "text, clear",
    [("a$$", "ass"), ("@$$", "ass"), ("idio+", "idiot"), ("scu*", "scum"), ("los€", "lose"), ("id107", "idiot"), ("sh1+", "shit"), ("a s s", "ass"),
     ("s h ! t", "shit"), ("i d ! o t", "idiot"), ("s/c/u/m", "scum"), ("s c u nn", "scum"), ("s*c*u*m", "scum"),
     ("idiot!!!", "idiot!!!"), ("**bold** text", "**bold** text"), ("1 2 3", "1 2 3"), ("a + b", "a + b"), ("$100 and 50%", "$100 and 50%")],
)
def test_look_alikes_in_any_place(characters, text, clear):
    """Signs at an end, short and mixed spacing and any separator reach the lattice; plain text stays."""
    assert toxicity.restore([text], characters) == [clear]


def test_places_of_disguise_are_those_of_the_patterns():
    """Places are looked up in arrays; the regular expressions say what they have to be."""
    chance = random.Random(5)
    pieces = [*"abii0123@$!|*_.-,; ", "\n", "\u00a0", "\u00e9", "\u0301", "\u00b2", "\u0663", "\U0001d552", "zzz", "a b c", "x.y.z", "p*q*r", "f$u$n"]
    texts = ["", " ", "aaa", "a b c", "s p  a.c_e d"] + ["".join(chance.choices(pieces, k=chance.randrange(40))).lower() for _ in range(3000)]
    spaced, hinted = toxicity._spaced(texts), toxicity._hinted(texts)
    assert len(spaced) > 500 and len(hinted) > 500
    for k, text in enumerate(texts):
        assert spaced.get(k, []) == [m.span() for m in toxicity._SPACED.finditer(text)]
        assert hinted.get(k, []) == [m.span() for m in re.finditer(r"\S+", text) if toxicity._HINT.search(m[0])]


def test_readings_do_not_depend_on_what_else_is_decoded(characters):
    """Of equally likely readings the first one counts, in whatever order and company spans are decoded."""
    spans = [f"{a}!! {b}{c}!!" for a in ("e", "o", "h", "n", "t") for b in "aeo" for c in (".", ",", "")]
    spans += ["p*q*r", "h.e.l.l.o", "f r e e", "$$ $ $", "a1 b1 c1"]
    alone = [toxicity.decode([s], characters)[0] for s in spans]
    assert toxicity.decode(spans, characters) == alone
    assert toxicity.decode(spans[::-1], characters) == alone[::-1]


def test_prefixes_hash_like_the_words_they_are():
    data = "abcdef abc, ABCDE \u00e9\u00e9\u00e9 x abcdef".encode()
    whole, [(long, found)] = words.words_and_prefixes(np.frombuffer(data, np.uint8), np.array([0, 15, len(data)]), (4,))
    assert (whole.end - whole.start).tolist() == [6, 3, 3, 2, 6, 1, 6] and long.tolist() == [0, 4, 6]
    assert [int(h) for h in found] == [words.hash_word(data[a : a + 4].lower()) for a in whole.start[long]]


def test_held_out_toxicity(spark):
    """On labels that follow from words, the words are found, plain or disguised."""
    bad = ["idiot", "moron", "scum", "loser", "trash"]
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("lang = 'en'").select("doc_id", "text").collect()
    rows, labels = [], []
    for k, r in enumerate(docs):
        clean = " ".join(w for w in (r["text"] or "").split() if not any(b in w.lower() for b in [*bad, "stupid", "clown", "worthless", "disgusting", "pathetic"]))
        rows.append((k, clean + (f" {bad[k // 4 % 5]} {bad[k // 4 % 4]}" if k % 4 == 0 else ""), int(k % 4 == 0)))
        labels.append((k, int(k % 4 == 0)))
    disguised = [(10_000 + k, f"{d} and so on", 1) for k, d in enumerate(["you 1d10t", "m0r0n", "s c u m", "looooser", "tr4sh"])]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows + disguised, "doc_id bigint, text string, want int")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int").filter(F.col("doc_id") % 3 != 1)
    model = toxicity.train(df, known)
    found = toxicity.rate(df, model).collect()
    assert all(0 <= r["toxicity"] <= 1 for r in found)
    wrong = [r["doc_id"] for r in found if (r["toxicity"] >= 0.7) != bool(r["want"])]
    assert len(wrong) <= 0.01 * len(found), wrong


def test_all_but_near_copies_teach(spark):
    """Texts that share words all teach; copies, also with one word changed, teach once for each label."""
    random = np.random.default_rng(6)
    texts = ["the of and " + " ".join(f"w{x}" for x in random.integers(0, 500, 40)) for _ in range(60)]
    copies = [texts[0], texts[0] + " end", texts[1], texts[1].upper()]
    rows = [(k, t, k % 2) for k, t in enumerate(texts)] + [(100 + k, t, k // 2) for k, t in enumerate(copies)] + [(200, texts[2], 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    found = toxicity.teaching_rows(docs, docs.select("doc_id", "toxic")).collect()
    got = Counter((bytes(r["text"]).decode().lower().removesuffix(" end"), r["toxic"]) for r in found)
    assert got == Counter({**{(t, k % 2): 1 for k, t in enumerate(texts)}, (texts[2], 1): 1})


def test_no_labels(spark, odd_documents):
    model = toxicity.train(odd_documents, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r["toxicity"] for r in toxicity.rate(odd_documents, model).collect()} == {0.0}


# Outliers


def counts_by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    n = Counter(threes)
    repeated = {k + d for k, t in enumerate(threes) if n[t] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


def test_counts(spark, odd_documents):
    docs = odd_documents.unionByName(table(spark, "/root/testdata/sf0.001", "documents"), allowMissingColumns=True)
    docs = docs.unionByName(spark.createDataFrame([(-1, "a b c\na b c\n\n a b c \nx a b c d # $\n" * 9)], "doc_id bigint, text string"), allowMissingColumns=True)
    got = Counter(tuple(r)[:1] + tuple(r)[3:] for r in outliers.statistics(docs).collect())
    assert got == Counter((r["doc_id"], *counts_by_hand(r["text"])) for r in docs.select("doc_id", "text").collect())


def test_planted_outliers(spark):
    """Rows far from their group go, rows of the bulk stay; a fifth of a group is planted."""
    random = np.random.default_rng(4)
    rows = []
    for k in range(1000):
        odd = k % 5 == 0
        n = int(random.lognormal(6, 0.5)) + 60
        length = 12 if odd else random.normal(5, 0.15)
        rows.append((k, "en", "s0" if k % 3 else None, n, int(n * length), n if odd else 0, 0, 0, False))
    kinds = "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
    found = outliers.judge(spark.createDataFrame(rows, kinds)).collect()
    assert all(r["kept"] != (r["doc_id"] % 5 == 0) for r in found)


STATISTICS = "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"


def test_outliers_of_one_statistic(spark):
    """A row that deviates by one statistic alone goes, also where that statistic has no variance."""
    random = np.random.default_rng(7)
    rows = []
    for k in range(500):
        n = int(random.lognormal(6, 0.1))
        rows.append((k, "en", "s", n, int(n * random.normal(5, 0.1)), 0, 0, 0, False))
    odd = {"words": (4000, 20000, 0, 0, 0), "length": (400, 3200, 0, 0, 0), "symbols": (400, 2000, 40, 0, 0), "lines": (400, 2000, 0, 5, 0), "repeats": (400, 2000, 0, 0, 120)}
    rows += [(1000 + k, "en", "s", *counts, False) for k, counts in enumerate(odd.values())]
    found = {r["doc_id"]: r["kept"] for r in outliers.judge(spark.createDataFrame(rows, STATISTICS)).collect()}
    assert [found[1000 + k] for k in range(len(odd))] == [False] * len(odd)
    assert sum(found[k] for k in range(500)) >= 495


def test_least_determinant_of_several_starts(spark):
    """Strongly correlated rows with outliers across: the estimate is a fixed point no worse than from the diagonal start."""
    random = np.random.default_rng(8)
    x = random.multivariate_normal([0, 0], [[4, 3.9], [3.9, 4]], 300)
    x[:70] = random.multivariate_normal([3, -3], [[0.1, 0], [0, 0.1]], 70)
    floor = {"a": 0.05, "b": 0.05}
    got = outliers.robust_scatter(spark.createDataFrame([("g", float(p), float(q)) for p, q in x], "grp string, a double, b double"), "grp", floor).first()
    factor = np.array([[got["l_0_0"], 0], [got["l_1_0"], got["l_1_1"]]])
    z = np.linalg.solve(factor, (x - [got["m_a"], got["m_b"]]).T)
    d = (z * z).sum(axis=0)
    core = x[d <= np.sort(d)[math.ceil(outliers.CORE * len(d)) - 1] + 1e-12]
    assert np.allclose(core.mean(axis=0), [got["m_a"], got["m_b"]], atol=1e-6)
    assert np.allclose(np.cov(core.T, bias=True) + 0.0025 * np.eye(2), factor @ factor.T, atol=1e-6)
    assert not (d[:70] <= np.sort(d)[224]).any()


def test_group_size_is_no_switch(spark):
    """Groups of 99 and 100 rows judge alike, and a rare language keeps its own rows and loses its outlier."""
    random = np.random.default_rng(9)
    n = np.exp(random.normal(6, 0.2, 700)).astype(int)
    row = lambda k, lang, source, length: (k, lang, source, int(n[k % 700]), int(n[k % 700] * length), 0, 0, 0, False)
    rows = [row(k, "en", "s", random.normal(5, 0.1)) for k in range(600)]
    lengths = random.normal(7, 0.1, 100)
    rows += [row(700 * c + k, "en", f"t{c}", lengths[k]) for c, size in ((1, 99), (2, 100)) for k in range(size)]
    rows += [row(5000 + k, "xx", "s", random.normal(9, 0.2)) for k in range(40)] + [row(5040, "xx", "s", 20.0)]
    found = {r["doc_id"]: r for r in outliers.judge(spark.createDataFrame(rows, STATISTICS)).collect()}
    for k in range(99):
        assert found[700 + k]["distance"] == pytest.approx(found[1400 + k]["distance"], rel=0.2, abs=0.3)
    assert sum(found[5000 + k]["kept"] for k in range(40)) == 40 and not found[5040]["kept"]


def test_distance_is_mahalanobis(spark):
    """With steps done by numpy on the same rows, centre, scatter and distances are the same."""
    random = np.random.default_rng(5)
    x = random.multivariate_normal([1, 2], [[2, 0.8], [0.8, 1]], 400)
    x[:60] += [8, -9]
    floor = {"a": 0.1, "b": 0.1}
    rows = spark.createDataFrame([("g", float(p), float(q)) for p, q in x], "grp string, a double, b double")
    got = outliers.robust_scatter(rows, "grp", floor).first()
    middle = lambda v, q: np.sort(v)[math.ceil(q * len(v)) - 1]
    centre = np.array([middle(x[:, k], 0.5) for k in (0, 1)])
    scatter = np.diag([(1.4826 * middle(abs(x[:, k] - centre[k]), 0.5)) ** 2 for k in (0, 1)])
    for _ in range(outliers.STEPS):
        inverse = np.linalg.inv(scatter + 0.01 * np.eye(2))
        d = np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre)
        core = x[d <= middle(d, outliers.CORE) + 1e-12]
        centre, scatter = core.mean(axis=0), np.cov(core.T, bias=True)
    factor = np.array([[got["l_0_0"], 0], [got["l_1_0"], got["l_1_1"]]])
    assert np.allclose([got["m_a"], got["m_b"]], centre, atol=1e-6) and np.allclose(factor @ factor.T, scatter + 0.01 * np.eye(2), atol=1e-6)


def test_native_plans(spark, odd_folder):
    for name in ("op10_outliers", "op2_chat_tools"):
        plan = REGISTRY[name](spark, f"{odd_folder}/full")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
