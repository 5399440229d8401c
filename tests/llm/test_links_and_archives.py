"""Jaccard join, chat tools and WARC against brute force."""

import hashlib
import json
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import chat_tools, jaccard_join, warc
from plumbline.llm.base import table
from plumbline.llm.queries import REGISTRY
from plumbline.session import fresh_path

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def join_by_hand(docs, n=5, threshold=0.8):
    groups = defaultdict(list)
    for doc_id, text in docs:
        w = WORD.findall((text or "").encode().lower())
        groups[frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else text or ""].append(doc_id)
    sets, root = list(groups), list(range(len(groups)))
    by_shingle, degree = defaultdict(list), [0] * len(sets)
    for k, s in enumerate(sets):
        for x in s if isinstance(s, frozenset) else ():
            by_shingle[x].append(k)

    def top(k):
        return k if root[k] == k else top(root[k])

    for a, b in {(a, b) for v in by_shingle.values() for a in v for b in v if a < b}:
        if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            degree[a] += 1
            degree[b] += 1
            root[max(top(a), top(b))] = min(top(a), top(b))
    classes = defaultdict(list)
    for k, s in enumerate(sets):
        classes[top(k)] += [i for i in groups[s] if i is not None]
    return sorted(
        ((i, min(classes[top(k)], default=None), len(groups[s]), degree[k]) for k, s in enumerate(sets) for i in groups[s]), key=str
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_join_of_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    assert found(REGISTRY["op1_jaccard_join"](spark, sf)) == join_by_hand(docs)


def near_copies(members, others, seed):
    """One group of near copies, texts that share a long passage, and texts of their own."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randrange(5000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = []
    for _ in range(members):
        own = list(base)
        for _ in range(pick.randrange(1, 4)):
            own[pick.randrange(len(own))] = word()
        rows.append(" ".join(own))
    for k in range(others):
        rows.append(" ".join([word() for _ in range(80)] + (passage if k % 2 else [])))
    return list(enumerate(rows))


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 16)
    monkeypatch.setattr(jaccard_join, "TILE", 20)
    docs = near_copies(150, 150, 6)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert found(jaccard_join.jaccard_join(df)) == join_by_hand(docs)


def test_pairs_that_span(spark):
    pick = np.random.default_rng(3)
    for rows, columns, share in ((30, 40, 0.03), (50, 50, 0.01), (1, 9, 0.5), (5, 5, 0.0)):
        linked = pick.random((rows, columns)) < share
        x, y = jaccard_join._spanning(linked)
        assert linked[x, y].all()

        def parts(pairs):
            root = list(range(rows + columns))

            def top(k):
                return k if root[k] == k else top(root[k])

            for a, b in pairs:
                root[max(top(a), top(b))] = min(top(a), top(b))
            return [top(k) for k in range(rows + columns)]

        whole = parts([(a, rows + b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(linked)))])
        assert parts([(a, rows + b) for a, b in zip(x.tolist(), y.tolist())]) == whole
        assert len(x) == rows + columns - len(set(whole))


def test_join_of_odd_rows(spark, odd_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = found(jaccard_join.jaccard_join(odd_documents))
    assert got == join_by_hand(docs)


def test_one_row_of_each_group_stays(spark, odd_documents):
    kept = jaccard_join.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _, _ in join_by_hand(docs)})


def test_texts_are_read_once_to_keep_one(spark, odd_documents):
    """A second evaluation needs a second Python worker for each task, and workers stay."""
    plan = jaccard_join.keep_one(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_components(spark):
    pick = random.Random(7)
    edges = [(k, k + 1) for k in range(300)] + [(pick.randrange(1000, 2000), pick.randrange(1000, 2000)) for _ in range(600)] + [(5000, 6000 + k) for k in range(50)] + [(9, 9)]
    got = {r["node"]: r["root"] for r in jaccard_join.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def top(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert got == {k: top(k) for k in root if any(k in e and e[0] != e[1] for e in edges)}


def test_runs():
    assert jaccard_join.runs_needed(0.8, 1, 0.999) == 7 and jaccard_join.runs_needed(0.8, 4, 0.999) == 19


# Chat tools

MESSAGES = "conv_id bigint, turn bigint, role string, text string, calls array<struct<id:string,name:string,arguments:string,after:array<string>>>, call_id string"
SCHEMAS = [
    ("weather", "city", "string", True, None, None, ["Oslo", "Rome"]),
    ("weather", "days", "integer", False, 1.0, 7.0, None),
    ("weather", "share", "number", False, None, None, None),
    ("weather", "tags", "array", False, None, None, None),
]


def formatted(spark, messages):
    schemas = spark.createDataFrame(SCHEMAS, "tool string, param string, type string, required boolean, minimum double, maximum double, choices array<string>")
    return chat_tools.format_tool_calls(spark.createDataFrame(messages, MESSAGES), schemas).orderBy("conv_id", "position").collect()


def call(name, arguments, after=None, tool="weather"):
    return (name, tool, arguments, [after] if isinstance(after, str) else after)


def first_call(rows):
    return next(r for r in rows if r["kind"] == "call")


def test_linking_and_order(spark):
    rows = formatted(
        spark,
        [
            (1, 0, "tool", "early answer", None, "b"),
            (1, 1, "assistant", None, [call("a", "{}", "b"), call("b", "{}"), call("a", "{}")], None),
            (1, 2, "tool", "answer", None, "a"),
            (1, 3, "tool", "again", None, "a"),
            (1, 4, "tool", "lost", None, "z"),
            (1, 5, "tool", "nobody", None, None),
            (2, 0, "assistant", None, [call("x", "{}", "y"), call("y", "{}", "x"), call("v", "{}", "x"), call("u", "{}", "gone")], None),
        ],
    )
    status = {(r["conv_id"], r["kind"], r["call_id"], r["status"]): r for r in rows}
    for key in [(1, "call", "a", "linked"), (1, "call", "b", "linked"), (1, "call", "a", "duplicate"), (1, "result", "a", "duplicate"),
                (1, "result", "z", "orphan"), (1, "result", None, "unidentified"), (2, "call", "x", "cyclic"), (2, "call", "v", "cyclic"), (2, "call", "u", "unanswered")]:
        assert key in status, key
    at = {k: r["position"] for k, r in status.items()}
    # b comes before a, though a stands first; results come after their calls, though one arrived before.
    assert at[1, "call", "b", "linked"] < at[1, "result", "b", "linked"] < at[1, "call", "a", "linked"] < at[1, "result", "a", "linked"]
    for conv in (1, 2):
        assert sorted(r["position"] for r in rows if r["conv_id"] == conv) == list(range(sum(r["conv_id"] == conv for r in rows)))


def test_long_chain(spark):
    names = [f"c{k}" for k in range(90)]
    order = random.Random(8).sample(range(90), 90)
    calls = [call(names[k], "{}", names[k - 1] if k else None) for k in order]
    rows = formatted(spark, [(1, t, "assistant", None, [c], None) for t, c in enumerate(calls)])
    rows = [r for r in rows if r["kind"] == "call"]
    assert [r["call_id"] for r in rows] == names and [r["depth"] for r in rows] == list(range(90))


def test_several_predecessors(spark):
    """Diamonds, chains between them, cycles and what hangs behind these, against the longest path by hand."""
    pick = random.Random(12)
    above, messages = {}, []
    for conv in range(4):
        for k in range(30):
            others = [j for j in range(30) if j < k or (conv == 3 and pick.random() < 0.3)]
            above[conv, k] = pick.sample(others, min(len(others), pick.choice([0, 1, 1, 1, 2, 3])))
        for t, k in enumerate(pick.sample(range(30), 30)):
            names = [f"c{j}" for j in above[conv, k]]
            messages.append((conv, t, "assistant", None, [call(f"c{k}", "{}", [*names, *names[:1], "gone", None])], None))
            if pick.random() < 0.5:
                messages.append((conv, 40 + t, "tool", "answer", None, f"c{k}"))
    depth, open_ = {}, set(above)
    while ready := {n for n in open_ if all((n[0], j) in depth for j in above[n])}:
        depth |= {n: max((depth[n[0], j] + 1 for j in above[n]), default=0) for n in ready}
        open_ -= ready
    assert open_ and max(depth.values()) > 5
    rows = formatted(spark, messages)
    calls = {(r["conv_id"], int(r["call_id"][1:])): r for r in rows if r["kind"] == "call"}
    assert {n: r["depth"] for n, r in calls.items()} == {n: depth.get(n) for n in above}
    assert {n for n, r in calls.items() if r["status"] == "cyclic"} == open_
    for n in depth:
        assert all(calls[n[0], j]["position"] < calls[n]["position"] for j in above[n])
    for r in rows:
        if r["kind"] == "result":
            assert r["position"] > calls[r["conv_id"], int(r["call_id"][1:])]["position"] or r["status"] == "cyclic"


def test_whole_conversations(spark):
    """Every turn is a row with its whole text, in the order of turns where nothing speaks against it."""
    long = "word " * 5000
    rows = formatted(
        spark,
        [
            (1, 0, "system", "be kind", None, None),
            (1, 1, "user", long, None, None),
            (1, 2, "assistant", "let me see", [call("a", '{"city": "Oslo"}')], None),
            (1, 3, "tool", "rain", None, "a"),
            (1, 4, "assistant", None, None, None),
            (1, 5, None, "", None, None),
        ],
    )
    assert [r["kind"] for r in rows] == ["message", "message", "message", "call", "result", "message", "message"]
    assert [json.loads(r["json"]).get("content") for r in rows] == ["be kind", long, "let me see", None, "rain", None, ""]
    assert [json.loads(r["json"]).get("role") for r in rows] == ["system", "user", "assistant", None, None, "assistant", None]


@pytest.mark.parametrize(
    "arguments, faults",
    [
        ('{"city": "Oslo"}', []),
        ('{"days": 3}', ["missing:city"]),
        ('{"city": "Paris", "days": 9}', ["choice:city", "range:days"]),
        ('{"city": 5, "days": "3", "share": "x", "tags": {}}', ["type:city", "type:days", "type:share", "type:tags"]),
        ('{"city": "Rome", "days": 1, "share": 0.5, "tags": ["a"]}', []),
        ('{"city": "Rome", "share": 2, "more": null}', ["unknown:more"]),
        ("[1]", ["no object"]),
        ('{"city": ', ["malformed"]),
        (None, ["malformed"]),
    ],
)
def test_validation(spark, arguments, faults):
    row = formatted(spark, [(1, 0, "assistant", None, [call("a", arguments)], None)])
    row = first_call(row)
    assert row["faults"] == faults


def test_canonical_json(spark):
    text = '{"tags" : ["b", "a"], "days": 2,\n "city":"Röme \\"x\\"", "nested": {"z": 1, "a": {"y": null, "b": true}}}'
    row = formatted(spark, [(1, 0, "assistant", None, [call("a", text)], None)])
    row = first_call(row)
    want = {"arguments": json.loads(text), "id": "a", "name": "weather", "type": "call"}
    assert row["json"] == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


# WARC


def records_by_hand(pages):
    groups = defaultdict(list)
    for page_id, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            groups[data].append(page_id)
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        first = max(groups[data]) if data in groups and page_id is not None else page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if first == page_id else "revisit", None if first == page_id else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["128m", "8k", "1k"])
def test_archives(spark, tmp_path, monkeypatch, split):
    """Payloads with the magic line and whole records inside, read in one split or in many."""
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n"
    pick = random.Random(9)
    pages = []
    for k in range(120):
        html = "".join(pick.choice([inner, "WARC/1.1\r\n", "text é " * 30, "\r\n\r\n"]) for _ in range(pick.randrange(0, 8)))
        pages.append((k, html if k % 10 else pages[k // 2][1] if k else "y" * 1500))
    df = spark.createDataFrame([(k, f"http://h/{k}", t) for k, t in pages], "page_id bigint, url string, html string").coalesce(2)
    df.write.parquet(str(tmp_path / "pages.parquet"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = sorted((tuple(r) for r in REGISTRY["op8_warc"](spark, str(tmp_path)).collect()), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == records_by_hand(pages)


def test_broken_archive(spark):
    """A chain ends where a record is cut off; a file that begins with something else has no records."""
    path = fresh_path(spark, "broken")
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: 8\r\n\r\nH\r\n\r\nabc\r\n\r\n"
    parts = [record.format(1) + record.format(2) + record.format(3)[:-9], "junk" + record.format(4)]
    spark.createDataFrame([(p,) for p in parts], "value string").repartition(2).write.option("lineSep", "\x00").text(path)
    rows = warc.records(spark, path).collect()
    assert sorted(r["record_id"] for r in rows if r["record_type"]) == ["<urn:page:1>", "<urn:page:2>"]
