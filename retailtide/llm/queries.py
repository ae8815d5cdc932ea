"""The registered queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.llm import (
    chat_format,
    clustering,
    decontaminate,
    line_dedup,
    main_text,
    near_dedup,
    packing,
    pitman_yor,
    prefix_trie,
    quality_classifier,
    quality_rules,
    token_files,
    warc,
)
from retailtide.llm.tokens import vocabulary
from retailtide.llm.shipping import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


_OP1_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
members AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS m
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i
        FROM split WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM members GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.m = b.m AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM sizes s WHERE s.doc_id = a.doc_id)
                               + (SELECT n FROM sizes s WHERE s.doc_id = b.doc_id) - count(*))),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM split
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM split JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.read(token_files.write(docs, vocabulary("byte_bpe_50k.json")))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(spark, _table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(_table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP4_SQL = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                 ELSE page_id END AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts
"""


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.train(spark, docs, _table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model)
    return scored.select(
        "doc_id",
        quality_classifier.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= quality_classifier.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(_table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failures",
    )


_OP8_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l:
                     regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM split WHERE len(ws) >= 8)),
twice AS (
  SELECT doc_id, i FROM windows
  JOIN (SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1) USING (doc_id, w)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) AS r(j) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(ws) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
         len(list_filter(list_zip(ws, ws[2:]), lambda p: p[1] = p[2])) AS n_echo,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower
  FROM split LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN 10 * n_echo > 3 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 64 ELSE 0 END)
    + (CASE WHEN n_upper > n_lower THEN 128 ELSE 0 END) AS failures
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, CAST(failures AS BIGINT) AS failures
FROM judged
"""


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(extra)))


_OP9_SQL = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'),
              '<(\||/?s>|</?SYS>>)|\[(/?INST\])', '<\\\1\2', 'g')) AS chars,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role AS merged
  FROM all_rows)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN merged THEN length('<|next|>')
                             ELSE length(role) + length('<|start|><|text|><|end|>') END) AS BIGINT)
         AS formatted_chars
FROM sized GROUP BY conv_id
"""

def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_OP10_SQL = r"""
WITH lowered AS (
  SELECT doc_id AS id, 1 AS side, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT item_id, 2, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT id, side, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lowered),
items AS (SELECT id, ws, least(len(ws), 13) AS size FROM split WHERE side = 2 AND len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM items),
windows AS (
  SELECT DISTINCT id AS item, size, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM items)),
places AS (
  SELECT id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM split, sizes WHERE side = 1 AND len(ws) >= size)),
hits AS (SELECT id, size, i, item FROM places JOIN windows USING (size, w)),
covered AS (
  SELECT id, count(DISTINCT i + j) AS n_hit
  FROM hits, range(13) AS r(j) WHERE j < size GROUP BY id),
found AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY id)
SELECT id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM split LEFT JOIN covered USING (id) LEFT JOIN found USING (id) WHERE side = 1
"""


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(spark, _table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT row, doc_id, i, ls[i] AS line,
         translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
repeated AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT row, doc_id, key FROM lines WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5),
judged AS (
  SELECT lines.*, repeated.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS dropped
  FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY row, doc_id
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_lists(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(spark, prefix_trie.with_shared_openings(turns)).drop("node")


_OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
               lambda r, k: xor(r >> 1, (r & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
lists AS (
  SELECT convs.conv_id, base, h,
         list({'key': key, 'words': words} ORDER BY i) AS ts FROM convs JOIN turns USING (conv_id) GROUP BY ALL),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.ts, [])[1:a.h], a.ts[a.h + 1:]) AS ts
  FROM lists a LEFT JOIN lists b ON b.conv_id = a.base),
prefixes AS (
  SELECT conv_id, d, list_transform(ts[1:d], lambda t: t['key']) AS prefix,
         CASE WHEN d = 0 THEN 0 ELSE ts[d]['words'] END AS words, len(ts) = d AS last
  FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, d),
children AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children ON children.prefix = nodes.prefix),
sums AS (
  SELECT above, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(list_transform(range(0, d + 1), lambda k: prefix[1:k])) AS above FROM whole)
  GROUP BY above)
SELECT whole.conv_id, whole.d AS depth, parent.conv_id AS parent_conv_id, whole.n_convs, whole.n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, whole.ends_sha256
FROM whole JOIN sums ON sums.above = whole.prefix
LEFT JOIN nodes parent ON whole.d > 0 AND parent.prefix = whole.prefix[1:whole.d - 1]
"""


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(spark, _table(spark, sf_dir, "embeddings")).drop("centroid")


def _op13_sql() -> str:
    nearest = """
assigned_{r} AS MATERIALIZED (
  SELECT id, any_value(vec_id) AS vec_id, any_value(v) AS v, min((d, c))[1] AS distance, min((d, c))[2] AS cluster
  FROM (SELECT id, vec_id, v, c, list_sum(list_transform(list_zip(v, cv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM vectors, centroids_{r}) GROUP BY id)"""
    moved = """,
sums_{r} AS (
  SELECT cluster, k, CAST(floor_div AS BIGINT) AS x FROM (
    SELECT cluster, k, (sum(v[k]) - ((sum(v[k]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
    FROM (SELECT cluster, v, unnest(range(1, 65)) AS k FROM assigned_{p}) GROUP BY cluster, k)),
centroids_{r} AS MATERIALIZED (
  SELECT c, coalesce(moved, cv) AS cv FROM centroids_{p}
  LEFT JOIN (SELECT cluster, list(x ORDER BY k) AS moved FROM sums_{r} GROUP BY cluster) ON cluster = c)"""
    steps = []
    for r in range(clustering.ROUNDS + 1):
        if r:
            steps.append(moved.format(r=r, p=r - 1))
        steps.append("," + nearest.format(r=r))
    return (
        """
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY rank, v) - 1 AS c, v AS cv
  FROM (SELECT v, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS rank FROM vectors ORDER BY rank, v LIMIT 40))"""
        + "".join(steps)
        + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(cv, ',')) AS centroid_sha256
FROM assigned_{r} JOIN centroids_{r} ON c = cluster""".format(r=clustering.ROUNDS)
    )


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_token_files": op2_token_files,
    "op3_main_text": op3_main_text,
    "op4_warc": op4_warc,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_pack": op6_pack,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_quality_rules": op8_quality_rules,
    "op9_chat_format": op9_chat_format,
    "op10_decontaminate": op10_decontaminate,
    "op11_line_dedup": op11_line_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_centroid_clustering": op13_centroid_clustering,
}
ORACLE = {
    "op1_near_dedup": _OP1_SQL,
    "op4_warc": _OP4_SQL,
    "op8_quality_rules": _OP8_SQL,
    "op9_chat_format": _OP9_SQL,
    "op10_decontaminate": _OP10_SQL,
    "op11_line_dedup": _OP11_SQL,
    "op12_prefix_trie": _OP12_SQL,
    "op13_centroid_clustering": _op13_sql(),
}
