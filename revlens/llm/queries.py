"""The registered queries of the operators: thin wrappers that give the agreed columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import hardneg, pii, quality, repair, secrets, toxicity
from revlens.llm.bpe import round_trip
from revlens.llm.chat import exchange_events, format_events
from revlens.llm.common import read
from revlens.llm.embdedup import near_vectors
from revlens.llm.linededup import line_report
from revlens.llm.packing import pack
from revlens.llm.simhash import near_duplicates
from revlens.llm.topk import nearest
from revlens.plans.registry import Query


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: token count and digests of ids and bytes."""
    return round_trip(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that its source repeats on over 1 % of its documents, and what is left."""
    return line_report(read(spark, sf_dir, "documents"), "doc_id", "source", "text", ratio=0.01, min_pages=5)


OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
lines AS (
    SELECT r, source, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos FROM d
),
on_pages AS (
    SELECT source, trim(line, ' ') AS bare, count(DISTINCT r) AS n FROM lines
    WHERE trim(line, ' ') <> '' GROUP BY ALL
),
sites AS (SELECT source, count(*) AS total FROM documents GROUP BY ALL),
boilerplate AS (
    SELECT o.source, o.bare FROM on_pages o JOIN sites s ON o.source IS NOT DISTINCT FROM s.source
    WHERE o.n >= 5 AND CAST(o.n AS DOUBLE) / s.total > 0.01
),
marked AS (
    SELECT l.r, l.pos, l.line, b.bare IS NOT NULL AS dropped FROM lines l
    LEFT JOIN boilerplate b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.bare
),
kept AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_md5
    FROM marked GROUP BY r
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, kept_md5
FROM d LEFT JOIN kept USING (r)
"""


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, at most 4 differing bits."""
    return near_duplicates(read(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer products for every vector whose id is divisible by 50."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.w, d.w) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


REPLY = {"prompt": {"type": "string", "required": True, "min_length": 1}, "turn": {"type": "integer", "required": True, "min": 0}}


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation as a linked, ordered, checked event in canonical JSON."""
    events = exchange_events(read(spark, sf_dir, "conversations"))
    return format_events(events, {"reply": REPLY}).select(
        F.col("conv").try_cast("long").alias("conv_id"), "turn", "kind", "call_id", "linked", "valid", "place_turn", "rank", "json"
    )


OP6_SQL = """
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
e AS (
    SELECT t.*, u.turn IS NOT NULL AND t.role = 'assistant' AS result, a.turn IS NOT NULL AS answered
    FROM t LEFT JOIN t u ON u.conv_id = t.conv_id AND u.turn = t.turn - 1 AND u.role = 'user'
    LEFT JOIN t a ON a.conv_id = t.conv_id AND a.turn = t.turn + 1 AND a.role = 'assistant'
)
SELECT conv_id, turn,
       CASE WHEN role = 'user' THEN 'call' WHEN result THEN 'result' ELSE 'message' END AS kind,
       CASE WHEN role = 'user' THEN conv_id || ':' || turn WHEN result THEN conv_id || ':' || (turn - 1) END AS call_id,
       (role = 'user' AND answered) OR result AS linked,
       role <> 'user' OR length(text) > 0 AS valid,
       CASE WHEN result THEN turn - 1 ELSE turn END AS place_turn,
       CAST(CASE WHEN result THEN 1 ELSE 0 END AS INTEGER) AS rank,
       CASE WHEN role = 'user' THEN '{"arguments":{"prompt":' || to_json(text) || ',"turn":' || turn || '},"id":"' || conv_id || ':' || turn || '","name":"reply","type":"call"}'
            WHEN result THEN '{"content":{"content":' || to_json(text) || '},"id":"' || conv_id || ':' || (turn - 1) || '","type":"result"}'
            ELSE '{"content":{"content":' || to_json(text) || '},"role":' || to_json(role) || ',"type":"message"}' END AS json
FROM e
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, sources mixed by their share of all tokens."""
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=2048, end_id=1)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector at a cosine of 0.9 or more."""
    return near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.9)


OP8_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS w FROM embeddings
),
usable AS (
    SELECT vec_id, w, sqrt(list_inner_product(w, w)) AS size FROM v
    WHERE vec_id IS NOT NULL AND w IS NOT NULL AND len(list_filter(w, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(w, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND list_inner_product(a.w, b.w) / (a.size * b.size) >= 0.9
),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
components AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       coalesce(e.vec_id = component_id, false) AS kept
FROM embeddings e LEFT JOIN components USING (vec_id) LEFT JOIN counts USING (vec_id)
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in every document, with the forest's score and verdict."""
    docs = read(spark, sf_dir, "documents")
    model, dictionary = secrets.fit(docs)
    return secrets.scan(docs, model, dictionary, ["doc_id"], "text", "source").select(
        F.col("k_doc_id").alias("doc_id"),
        "start",
        F.length("run").cast("long").alias("length"),
        F.sha2("run", 256).alias("sha256"),
        "score",
        "is_secret",
    )


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the plain spans' numbers and digest, and all spans."""
    return pii.report(read(spark, sf_dir, "documents"))


def op12_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (id divisible by 100); every seventh row has another's label."""
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.r, a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
           CAST(list_inner_product(a.w, d.w) AS BIGINT) AS score
    FROM v a JOIN v d ON a.vec_id % 100 = 0 AND a.r <> d.r
),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM scored WHERE same
),
mined AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.r, p.n ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON p.r = s.r AND NOT s.same AND p.n <= 5
     AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 10
"""


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults, the cheapest repair's cost and audit, the result's digest."""
    conversations = read(spark, sf_dir, "conversations")
    return repair.repair_report(repair.damaged(conversations), conversations).withColumnRenamed("conv", "conv_id")


OP13_SQL = """
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                          lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
    FROM conversations
),
numbered AS (
    SELECT *, xor(list_reduce(bytes, lambda sum, byte: list_reduce(range(8),
               lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(sum, byte)), 4294967295), 4294967295) % 20 AS kind FROM given
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM numbered WHERE kind <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS n,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged
),
marked AS (
    SELECT conv_id, turn, role, text, n, lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before,
           CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
    FROM placed
),
inserted(s, t, k, more) AS (
    VALUES (0, 0, 0, []::VARCHAR[]), (0, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']), (1, 1, 0, []), (1, 2, 1, ['user:']),
           (1, 3, 2, ['user:', 'assistant:']), (2, 2, 0, []), (2, 3, 1, ['assistant:']), (3, 3, 0, []), (3, 2, 1, ['user:'])
),
edits(edit, role, s, t) AS (
    VALUES ('K', 's', 0, 1), ('K', 'u', 0, 2), ('K', 'u', 1, 2), ('K', 'u', 3, 2), ('K', 'a', 2, 3), ('R', 'user', 0, 2), ('R', 'user', 1, 2),
           ('R', 'user', 3, 2), ('R', 'assistant', 2, 3), ('D', '', 0, 0), ('D', '', 1, 1), ('D', '', 2, 2), ('D', '', 3, 3)
),
ways AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS n, 0 AS state, {'cost': 0, 'audit': '', 'rows': []::VARCHAR[]} AS way
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT w.conv_id, w.n + 1, e.t, min({
        'cost': w.way.cost + 3 * i.k + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN e.edit <> 'D' AND m.fault = 't' THEN 3 ELSE 0 END,
        'audit': w.way.audit || repeat('I', i.k) || e.edit,
        'rows': w.way.rows || i.more || CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [m.role || ':' || m.text] ELSE [e.role || ':' || m.text] END})
    FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.n + 1
    JOIN inserted i ON i.s = w.state
    JOIN edits e ON e.s = i.t AND (e.edit = 'D' OR (m.fault NOT IN ('b', 'd') AND (e.edit = 'R' OR e.role = left(m.role, 1))))
    GROUP BY w.conv_id, w.n, e.t
),
facts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
           count(*) FILTER (WHERE fault = 't') AS truncated,
           count(*) FILTER (WHERE before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
),
ended AS (
    SELECT w.conv_id, min({'cost': w.way.cost + 3 * i.k, 'audit': w.way.audit || repeat('I', i.k), 'rows': w.way.rows || i.more}) AS way
    FROM ways w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n
    JOIN inserted i ON i.s = w.state AND (i.t = 3 OR (i.t = 0 AND i.s = 0)) GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(way.cost, 0) AS BIGINT) AS cost,
       coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


QUERIES: dict[str, Query] = {
    "op1_bpe": Query(op1_bpe, None),
    "op2_toxicity": Query(op2_toxicity, None),
    "op3_line_dedup": Query(op3_line_dedup, OP3_SQL),
    "op4_simhash": Query(op4_simhash, None),
    "op5_topk": Query(op5_topk, OP5_SQL),
    "op6_chat": Query(op6_chat, OP6_SQL),
    "op7_packing": Query(op7_packing, None),
    "op8_embedding_dedup": Query(op8_embedding_dedup, OP8_SQL),
    "op9_quality": Query(op9_quality, None),
    "op10_secrets": Query(op10_secrets, None),
    "op11_pii": Query(op11_pii, None),
    "op12_hardneg": Query(op12_hardneg, OP12_SQL),
    "op13_repair": Query(op13_repair, OP13_SQL),
}
