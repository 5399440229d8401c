"""Registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import chat_tools, ctw, decontaminate, jaccard_join, language_id, merkle, mixing, outliers, packing, ranked_search, sharding, toxicity, warc
from plumbline.llm.base import remainder, table, utf8
from plumbline.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


@register
def op1_jaccard_join(spark, sf):
    """Class, copies and links of every document: sets of five words in a row, similarity 0.8 or more."""
    return jaccard_join.jaccard_join(table(spark, sf, "documents"), n=5, threshold=0.8)


#: Tools that the turns of ``conversations`` are taken to call.
TOOL_SCHEMAS = (
    ("search", "limit", "integer", True, 1.0, 40.0, None),
    ("search", "query", "string", True, None, None, None),
    ("lookup", "limit", "integer", False, 0.0, None, None),
    ("lookup", "mode", "string", True, None, None, ["exact", "near"]),
    ("lookup", "query", "string", True, None, None, None),
)


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Assistant turns with a tool call for their whole text, after the calls of two turns before; user turns but the first answer the turn before."""
    tool = "CASE length(text) % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'unlisted' END"
    mode = "CASE length(text) % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'near' ELSE 'far' END"
    arguments = f"""CASE WHEN length(text) % 17 = 0 THEN concat('{{"query": ', length(text))
        ELSE to_json(named_struct('query', text, 'mode', CASE WHEN {tool} = 'lookup' THEN {mode} END, 'limit', length(text) % 60)) END"""
    call = f"named_struct('id', concat('call_', turn), 'name', {tool}, 'arguments', {arguments}, 'after', array(concat('call_', turn - 2)))"
    return conversations.select(
        "conv_id",
        "turn",
        F.when((F.col("role") == "user") & (F.col("turn") > 0), "tool").otherwise(F.col("role")).alias("role"),
        "text",
        F.expr(f"CASE WHEN role = 'assistant' THEN array({call}) END").alias("calls"),
        F.expr("CASE WHEN role = 'user' THEN concat('call_', turn - 1) END").alias("call_id"),
    )


@register
def op2_chat_tools(spark, sf):
    """All turns, calls and results of all conversations: linked, in topological order, validated, as canonical JSON."""
    kinds = "tool string, param string, type string, required boolean, minimum double, maximum double, choices array<string>"
    found = chat_tools.format_tool_calls(tool_messages(table(spark, sf, "conversations")), spark.createDataFrame(TOOL_SCHEMAS, kinds))
    return found.withColumn("faults", F.array_join("faults", ","))


@register
def op3_language_id(spark, sf):
    """Language of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf, "documents")
    held_out = remainder("doc_id", 3) == 1
    model = language_id.train(docs.filter(~held_out))
    found = language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@register
def op4_sharding(spark, sf):
    """Shards 0 to 39 by jump hashing of doc_id, and the shard with one more."""
    digest = table(spark, sf, "documents").select(
        "doc_id",
        (F.octet_length(utf8("text")).cast("bigint") + 16).alias("size"),
        F.crc32(utf8("text")).alias("text_crc32"),
        F.lit("key").alias("law"),
        sharding.shard_of("doc_id", 40).alias("shard"),
        sharding.shard_of("doc_id", 41).alias("grown_shard"),
    )
    return sharding.with_slots(digest)


@register
def op5_decontamination(spark, sf):
    """Words of every document that lie in a window of 10 words of any benchmark item."""
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), width=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op9_packing(spark, sf):
    """Pieces of all documents in sequences of at most 2048 ids."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack_documents(table(spark, sf, "documents"), vocabulary)
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step"
    )


@register
def op6_ctw(spark, sf):
    """log10 probability of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf, "documents")
    scored = ctw.score_texts(docs, learn=remainder("doc_id", 10) != 0)
    return scored.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        F.col("base_log10").alias("base_score"),
        F.col("log10_probability").alias("score"),
        "bits_per_byte",
    )


@register
def op7_toxicity(spark, sf):
    """Toxicity of every whole text, learned from the labels of rows that are not held out."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels.filter(remainder("doc_id", 3) != 1))
    rated = toxicity.rate(docs.select("doc_id", "text"), model)
    return rated.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


@register
def op10_outliers(spark, sf):
    """Counts of every whole text, and whether it passes the base rule and the robust outlier test."""
    judged = outliers.judge(outliers.statistics(table(spark, sf, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@register
def op8_warc(spark, sf):
    """Pages written as WARC records and read back along the chain of records."""
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    found = warc.records(spark, path)
    page_id = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) AS bigint)")
    revisit = F.col("record_type") == "revisit"
    return found.select(
        page_id("record_id").alias("page_id"),
        F.when(revisit, F.col("claimed_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("claimed_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page_id("refers_to").alias("refers_to"),
    )


@register
def op11_nra(spark, sf):
    """The ten best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


@register
def op12_mixing(spark, sf):
    """Copies of all documents, so that sources meet their shares of the words."""
    return mixing.mix(table(spark, sf, "documents"), weights=(5, 2, 1), most=3)


@register
def op13_merkle(spark, sf):
    """Proofs of all documents against the root of the manifest; of some, the number of characters is tampered with."""
    docs = table(spark, sf, "documents")
    columns = ["doc_id", "source", "lang", F.col("n_chars"), "text"]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    other = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claimed = merkle.leaf_digest(*columns[:3], other, columns[4])
    leaves = docs.select(merkle.tree_of("lang").alias("tree"), "doc_id", merkle.leaf_digest(*columns).alias("leaf"), claimed.alias("claimed"))
    return merkle.proofs(merkle.manifest(leaves), "claimed").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


ORACLES["op2_chat_tools"] = """
WITH said AS (SELECT *, CAST(length(text) AS BIGINT) AS n, role = 'user' AND turn > 0 AS is_result FROM conversations),
calls AS (SELECT conv_id, turn, 'call_' || turn AS call_id, n, text, n % 17 = 0 AS broken,
                 CASE n % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'near' ELSE 'far' END AS mode,
                 CASE n % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'unlisted' END AS tool,
                 turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
          FROM said WHERE role = 'assistant'),
chained AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth FROM calls),
answers AS (SELECT conv_id, turn, 'call_' || (turn - 1) AS call_id, text FROM said WHERE is_result),
all_events AS (
    SELECT conv_id, turn, 'message' AS kind, 0 AS place, NULL AS call_id, NULL AS tool, NULL AS depth, 'plain' AS status, '' AS faults,
           '{' || coalesce('"content":' || to_json(text) || ',', '') || coalesce('"role":' || to_json(role) || ',', '') || '"type":"message"}' AS json
    FROM said WHERE NOT is_result
    UNION ALL
    SELECT c.conv_id, c.turn, 'call', 1, c.call_id, c.tool, c.depth, CASE WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'linked' END,
           CASE WHEN broken THEN 'malformed' WHEN c.tool = 'unlisted' THEN 'unknown tool'
                WHEN c.tool = 'search' AND (n % 60 < 1 OR n % 60 > 40) THEN 'range:limit'
                WHEN c.tool = 'lookup' AND mode = 'far' THEN 'choice:mode' ELSE '' END,
           CASE WHEN broken THEN '{"content":' || to_json('{"query": ' || n)
                ELSE '{"arguments":{"limit":' || (n % 60) || CASE WHEN c.tool = 'lookup' THEN ',"mode":"' || mode || '"' ELSE '' END
                     || ',"query":' || to_json(c.text) || '}' END
           || ',"id":"' || c.call_id || '","name":"' || c.tool || '","type":"call"}'
    FROM chained c LEFT JOIN answers a USING (conv_id, call_id)
    UNION ALL
    SELECT a.conv_id, a.turn, 'result', 2, a.call_id, c.tool, c.depth,
           CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END, '',
           '{"content":' || to_json(a.text) || ',"id":"' || a.call_id || '"' || coalesce(',"name":"' || c.tool || '"', '') || ',"type":"result"}'
    FROM answers a LEFT JOIN chained c USING (conv_id, call_id))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, place) - 1 AS position,
       kind, call_id, tool, depth, status, faults, json
FROM all_events"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _leads(n: int) -> str:
    """A word and the n - 1 words behind it in its text."""
    return ", ".join(f"lead(w, {k}) OVER o AS w{k}" for k in range(1, n))


ORACLES["op1_jaccard_join"] = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
tokens AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM docs),
runs AS (SELECT r, p, n, w, {_leads(5)} FROM tokens WINDOW o AS (PARTITION BY r ORDER BY p)),
windows AS (SELECT DISTINCT r, concat_ws(' ', w, w1, w2, w3, w4) AS x FROM runs WHERE p <= greatest(1, n - 4)),
sets AS (SELECT docs.r, doc_id, coalesce(md5(s), 'bare ' || text) AS s, coalesce(k, 0) AS k
         FROM docs LEFT JOIN (SELECT r, string_agg(x, chr(10) ORDER BY x) AS s, count(*) AS k FROM windows GROUP BY r) USING (r)),
reps AS (SELECT s, k, min(r) AS rep, min(doc_id) AS least, count(*) AS n_copies FROM sets GROUP BY s, k),
shingles AS (SELECT r AS rep, x FROM windows WHERE r IN (SELECT rep FROM reps)),
common AS (SELECT a.rep AS a, b.rep AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.rep <> b.rep GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN reps p ON p.rep = a JOIN reps q ON q.rep = b WHERE 10 * n >= 8 * (p.k + q.k - n)),
reach(rep, other) AS (SELECT rep, rep FROM reps UNION SELECT reach.rep, b FROM reach JOIN links ON a = other),
classes AS (SELECT reach.rep, min(o.least) AS class_id FROM reach JOIN reps o ON o.rep = other GROUP BY reach.rep)
SELECT doc_id, class_id, n_copies, coalesce(d.n, 0) AS n_links
FROM sets JOIN reps USING (s, k) JOIN classes USING (rep) LEFT JOIN (SELECT a AS rep, count(*) AS n FROM links GROUP BY a) d USING (rep)"""

_PHRASE = "concat_ws(' ', w, " + ", ".join(f"CASE WHEN size > {k} THEN w{k} END" for k in range(1, 10)) + ")"

ORACLES["op5_decontamination"] = f"""
WITH items AS (SELECT row_number() OVER () AS r, coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS.format("coalesce(text, '')")} AS ws FROM benchmark),
item_tokens AS (SELECT r, item, unnest(ws) AS w, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM items),
item_runs AS (SELECT r, item, p, n, least(n, 10) AS size, w, {_leads(10)} FROM item_tokens WINDOW o AS (PARTITION BY r ORDER BY p)),
wanted AS (SELECT DISTINCT item, size, {_PHRASE} AS phrase FROM item_runs WHERE p <= greatest(1, n - 9)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
tokens AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM docs),
runs AS (SELECT r, p, n, w, {_leads(10)} FROM tokens WINDOW o AS (PARTITION BY r ORDER BY p)),
starts AS (SELECT r, p, size, {_PHRASE} AS phrase FROM runs JOIN (SELECT DISTINCT size FROM wanted) ON p + size <= n + 1),
hits AS (SELECT r, p, size, item FROM starts JOIN wanted USING (size, phrase)),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(p, p + size)) AS place FROM (SELECT DISTINCT r, p, size FROM hits)) GROUP BY r),
found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
       sha256(coalesce(f.list, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)"""

ORACLES["op8_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
firsts AS (SELECT p, max(page_id) AS response FROM payloads WHERE strlen(p) >= 1000 GROUP BY p)
SELECT page_id, strlen(p) AS payload_bytes, sha1(p) AS payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM payloads LEFT JOIN firsts USING (p)"""

ORACLES["op11_nra"] = f"""
WITH items AS (SELECT row_number() OVER () AS i, item_id, {_WORDS.format("text")} AS ws FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
asked AS (SELECT DISTINCT i, item_id, unnest(ws) AS t FROM items),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
sizes AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n FROM docs WHERE len(ws) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
counts AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, corpus GROUP BY t, docs),
scores AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
           FROM asked JOIN counts USING (t) JOIN weights USING (t) JOIN sizes USING (r), corpus GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0) WHERE rank <= 10"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit: the bytes go in as 256 + value, the steps over bits as 0."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [256 + ord(c), 0, 0, 0, 0, 0, 0, 0, 0]))"
    shift = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, x: CASE WHEN x > 0 THEN xor(a, x - 256) ELSE {shift} END), 4294967295)"


ORACLES["op13_merkle"] = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
       CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM docs),
nodes(tree, level, pos, n, h) AS (
    SELECT tree, 0, pos, n, leaf FROM placed
    UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
heads AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, pos, n, h) AS (
    SELECT 0, pos, n, subroot FROM heads
    UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
spot AS (SELECT row_number() OVER () AS r, doc_id, leaf, claimed, p.tree, p.pos, p.n, subroot, heads.pos AS head, heads.n AS heads FROM placed p JOIN heads USING (tree)),
below(r, level, pos, n, proof, h) AS (
    SELECT r, 0, pos, n, '', claimed FROM spot
    UNION ALL
    SELECT b.r, b.level + 1, b.pos // 2, (b.n + 1) // 2, b.proof || coalesce(s.h, ''),
           sha256(CASE WHEN s.h IS NULL THEN b.h WHEN b.pos % 2 = 1 THEN s.h || b.h ELSE b.h || s.h END)
    FROM below b JOIN spot USING (r) LEFT JOIN nodes s ON s.tree = spot.tree AND s.level = b.level AND s.pos = xor(b.pos, 1) WHERE b.n > 1),
above(r, level, pos, n, proof, h) AS (
    SELECT r, 0, head, heads, b.proof, b.h FROM below b JOIN spot USING (r) WHERE b.n = 1
    UNION ALL
    SELECT a.r, a.level + 1, a.pos // 2, (a.n + 1) // 2, a.proof || coalesce(s.h, ''),
           sha256(CASE WHEN s.h IS NULL THEN a.h WHEN a.pos % 2 = 1 THEN s.h || a.h ELSE a.h || s.h END)
    FROM above a LEFT JOIN tops s ON s.level = a.level AND s.pos = xor(a.pos, 1) WHERE a.n > 1)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(a.proof) AS proof_sha256, a.h AS folded_root, a.h = t.h AS verified
FROM above a JOIN spot USING (r), (SELECT h FROM tops WHERE n = 1) t WHERE a.n = 1"""
