"""Queries of fill-in-middle, the conversation trie and packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm.base import query, table
from scorewright.llm.conversation_trie import conversation_trie
from scorewright.llm.fill_middle import fill_in_middle
from scorewright.llm.packing import encode_for_packing, pieces

FIM_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id::VARCHAR) AS s,
         regexp_extract_all(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]*[^ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+') AS u
  FROM documents
), h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
         ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4
  FROM d
), f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                 WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM h
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix
  FROM f
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", FIM_SQL)
def fill_in(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    names = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    made = fill_in_middle(docs, seed=42, with_output=False)
    return made.select("doc_id", *[F.col("fim")[n].alias(n) for n in names])


@query("op13_packing")
def packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    files = encode_for_packing(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, by_word=True)
    return pieces(spark, files, size=2048)


#: crc32 of the decimal id, bit by bit: each byte enters once and is shifted out eight times.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"""

TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, ({CRC_SQL}) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, i, k, size FROM c JOIN o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, i, k, size FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h
), w AS (
  SELECT conv_id, row_number() OVER q AS depth, md5(string_agg(k, '') OVER q) AS key, size FROM r
  WINDOW q AS (PARTITION BY conv_id ORDER BY own, i)
), p AS (
  SELECT conv_id, depth, key, size FROM w UNION ALL SELECT conv_id, 0, '', 0 FROM c
), n AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size FROM p GROUP BY key, depth
), u AS (
  SELECT n.*, up.key AS up FROM n LEFT JOIN p up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1
), k AS (
  SELECT u.*, n.conv_id AS parent_conv_id, coalesce(ch.n_children, 0) AS n_children
  FROM u LEFT JOIN n ON n.key = u.up LEFT JOIN (SELECT up AS key, count(*) AS n_children FROM u GROUP BY up) ch ON ch.key = u.key
), s AS (
  SELECT p.key, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves, sum((k.n_convs - 1) * k.size) AS saved
  FROM k JOIN p ON p.conv_id = k.conv_id AND p.depth <= k.depth GROUP BY p.key
), e AS (
  SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key
)
SELECT k.conv_id, k.depth::BIGINT AS depth, k.parent_conv_id, k.n_convs::BIGINT AS n_convs, k.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM k JOIN s USING (key) LEFT JOIN e USING (key)
"""


@query("op12_conversation_trie", TRIE_SQL)
def conversation_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_trie(table(spark, sf, "conversations"), group=5, heads=9)
