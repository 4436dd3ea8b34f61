"""The registered queries of this package, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.llm import (
    bpe, chat, decontaminate, embedding_dedup, hard_negatives, language, mixing, prefix_trie, quality,
    simhash, substring_dedup, token_files, toxicity,
)
from rowmill.llm.base import table


def op1_chat_formatting(spark, d):
    return chat.digest(chat.render(table(spark, d, "conversations")))


def op2_decontamination(spark, d):
    return decontaminate.digest(
        decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    )


def op3_mixing(spark, d):
    return mixing.copies(table(spark, d, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken"
    )


def op4_embedding_dedup(spark, d):
    return embedding_dedup.near_duplicates(table(spark, d, "embeddings"))


def op5_quality(spark, d):
    return quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_substring_dedup(spark, d):
    return substring_dedup.digest(substring_dedup.deduplicate(table(spark, d, "documents")))


def op7_token_files(spark, d):
    return token_files.round_trip(table(spark, d, "documents"), token_files.default_tokenizer())


def op8_toxicity(spark, d):
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_language(spark, d):
    return language.identify(table(spark, d, "documents"))


def op10_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


def op11_bpe(spark, d):
    path = bpe.default_vocabulary()
    return bpe.digest(bpe.decode(bpe.encode(table(spark, d, "documents").select("doc_id", "text"), path), path))


def op12_hard_negatives(spark, d):
    label = F.col("label").cast("long")
    rows = table(spark, d, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    )
    return hard_negatives.mine(hard_negatives.quantised(rows), F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark, d):
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(table(spark, d, "conversations"))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_decontamination, op3_mixing, op4_embedding_dedup, op5_quality,
        op6_substring_dedup, op7_token_files, op8_toxicity, op9_language, op10_simhash,
        op11_bpe, op12_hard_negatives, op13_prefix_trie,
    )
}

SQL = {
    "op1_chat_formatting": """WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS ts FROM t GROUP BY conv_id),
g AS (SELECT min(conv_id) AS conv_id, ts, count(*) AS n_logged FROM c GROUP BY ts),
p AS (SELECT DISTINCT list_slice(ts, 1, k) AS pre FROM (SELECT ts, unnest(range(1, len(ts))) AS k FROM g)),
m AS (SELECT * FROM g ANTI JOIN p ON g.ts = p.pre),
s AS (SELECT conv_id, len(ts) AS n_turns, n_logged, list_aggregate(list_transform(ts,
    lambda x: concat('<|', x.r, '|>', chr(10), x.t, chr(10), '<|end|>', chr(10))), 'string_agg', '') AS text FROM m)
SELECT conv_id, n_turns, n_logged, length(text) AS n_chars, sha256(text) AS text_sha256 FROM s""",
    "op2_decontamination": """WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1),
    lambda k: list_aggregate(list_slice(w, k, k + least(13, len(w)) - 1), 'string_agg', ' '))) AS win FROM i WHERE len(w) > 0),
u AS (SELECT DISTINCT n, win FROM iw),
dw AS (SELECT doc_id, n, k, list_aggregate(list_slice(w, k, k + n - 1), 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM u) WHERE len(w) >= n)),
o AS (SELECT doc_id, k, dw.n, dw.win FROM dw JOIN u ON dw.n = u.n AND dw.win = u.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM o) GROUP BY doc_id),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT o.doc_id, CAST(iw.item_id AS VARCHAR) AS item_id FROM o JOIN iw ON o.n = iw.n AND o.win = iw.win) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN x ON d.doc_id = x.doc_id""",
    "op4_embedding_dedup": """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM e UNION SELECT l.b, r.c FROM r JOIN l ON r.vec_id = l.a),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT m.vec_id, coalesce(n_links, 0) AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN n ON m.vec_id = n.a""",
    "op6_substring_dedup": """WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, k, list_aggregate(list_slice(w, k, k + 49), 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)),
f AS (SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s),
r AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS p FROM win JOIN f ON win.s = f.s WHERE doc_id > first_doc),
t AS (SELECT d.doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
g AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.p) AS kept, count(*) AS n
  FROM t ANTI JOIN r ON t.doc_id = r.doc_id AND t.p = r.p GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g ON d.doc_id = g.doc_id""",
    "op12_hard_negatives": """WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.q AS anchor_q, a.label AS anchor_label, b.vec_id, b.label,
    CAST(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND len(a.q) = len(b.q)),
p AS (SELECT anchor_id, anchor_q, anchor_label, vec_id AS positive_id, score AS positive_score FROM s
  WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor_q, anchor_label ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.anchor_q, p.anchor_label, positive_id
    ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.anchor_q = s.anchor_q AND p.anchor_label = s.anchor_label
WHERE s.label <> s.anchor_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.anchor_q, p.anchor_label, positive_id ORDER BY score DESC, vec_id) <= 3""",
    "op13_prefix_trie": """WITH o AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, ts, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST(range(8) AS BIGINT[])),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 6 AS INT) AS h FROM o),
c AS (SELECT h.conv_id, list_concat(coalesce(list_slice(b.ts, 1, h), []), coalesce(list_slice(h.ts, h + 1, len(h.ts)), [])) AS ts
  FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS depth, ts FROM c),
n AS (SELECT list_slice(ts, 1, depth) AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth) AS ends FROM p GROUP BY 1, 2),
k AS (SELECT list_slice(node, 1, depth - 1) AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[n.depth].t) END AS own
  FROM n LEFT JOIN k ON n.node = k.node AND n.depth = k.depth),
u AS (SELECT list_slice(node, 1, up) AS node, up AS depth, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT node, own, n_children, unnest(range(0, depth + 1)) AS up FROM m) GROUP BY 1, 2)
SELECT m.conv_id, m.depth, f.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves,
  CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN u ON m.node = u.node AND m.depth = u.depth
LEFT JOIN n f ON m.depth = f.depth + 1 AND list_slice(m.node, 1, m.depth - 1) = f.node""",
}
