"""Queries of the operators built from DataFrame functions alone, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm.base import query, table
from scorewright.llm.line_dedup import dedup_lines
from scorewright.llm.mixing import in_order, plan_mix
from scorewright.llm.quality import RULES, STOP_WORDS, SYMBOLS, score_quality

BLANKS_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER_SQL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINES_SQL = f"""
WITH l AS (
  SELECT doc_id, i AS pos, ls[i] AS line, translate(trim(ls[i], {BLANKS_SQL}), {UPPER_SQL}) AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), f AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, f.k IS NOT NULL AS gone FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op5_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), b AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM d
), s AS (
  SELECT source, sum(size) AS ssize, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source
), w AS (
  SELECT *, ((rk - 1) % 3 + 1)::DOUBLE AS w, (3 * ssize)::DOUBLE AS cap, (sum(ssize) OVER ())::DOUBLE AS total FROM s
), o AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w
), t AS (
  SELECT *, max(CASE WHEN lv <= cap / w THEN lv END) OVER () AS fill FROM o
), g AS (SELECT source, ssize, least(cap, coalesce(w * fill, cap)) AS target FROM t)
SELECT doc_id, size, ssize::BIGINT AS source_size, target, (size * n)::BIGINT AS taken,
       CASE WHEN n > 0 THEN CASE WHEN target > 0 THEN least(1, c / target) ELSE 0 END END AS position
FROM (
  SELECT *, least(3, CASE WHEN ssize > 0 THEN floor(target / ssize) ELSE 0 END
         + CASE WHEN c + size * 0.5 <= target - CASE WHEN ssize > 0 THEN floor(target / ssize) ELSE 0 END * ssize
                THEN 1 ELSE 0 END) AS n
  FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source)
"""


@query("op6_mixing", MIX_SQL)
def mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Constant weights 1, 2, 3 over the sources, every document at most three times; in the order of the
    documents' first training positions, those that the mix leaves out behind them."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    planned = plan_mix(docs, max_repeat=3).withColumn("mix_position", F.get("mix_positions", F.lit(0)))
    return in_order(planned).select(
        F.col("mix_id").alias("doc_id"),
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").cast("long").alias("taken"),
        F.col("mix_position").alias("position"),
    )


def _rules_sql() -> str:
    parts = []
    for measure, low, high in RULES:
        parts += [f"{measure} >= {low!r}::DOUBLE"] * (low is not None) + [f"{measure} <= {high!r}::DOUBLE"] * (high is not None)
    return " AND ".join(parts)


QUALITY_SQL = f"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {BLANKS_SQL}) <> '') AS ls
  FROM documents
), p AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS rn,
         count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), r AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM p WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[{SYMBOLS}]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, len(regexp_extract_all(coalesce(text, ''), '[A-Z]')) AS n_upper,
         len(list_filter(ws, lambda x: translate(x, {UPPER_SQL}) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop
  FROM d LEFT JOIN r USING (doc_id)
), q AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbol_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_ratio,
         CASE WHEN word_chars > 0 THEN n_upper::DOUBLE / word_chars ELSE 0 END AS upper_ratio,
         CASE WHEN n_words > 0 THEN n_stop::DOUBLE / n_words ELSE 0 END AS stop_word_ratio
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_rules_sql()} AS kept
FROM q
"""


@query("op7_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return score_quality(docs).select("doc_id", *[F.col("quality")[n].alias(n) for n in names])
