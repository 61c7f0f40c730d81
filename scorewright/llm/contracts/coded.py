"""Queries of token files, BPE, exact search and language identification."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm.base import query, table
from scorewright.llm.bpe_jobs import round_trip
from scorewright.llm.langid import fit_profiles, held_out, predict_language
from scorewright.llm.token_files import read_token_files, write_token_files
from scorewright.llm.topk import exact_topk

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op2_exact_topk", TOPK_SQL)
def topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return exact_topk(vectors, F.col("vec_id") % 100 == 0, k=10)


@query("op3_token_files")
def token_files(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    files = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, by_word=True)
    return read_token_files(spark, files)


@query("op8_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    profiles = fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    return predict_language(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query("op10_bpe")
def bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "bpe.*")
