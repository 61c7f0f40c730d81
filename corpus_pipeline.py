"""The corpus pipeline: five stages over the documents, each on what the one before it kept."""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm.base import query, table, unboxed
from scorewright.llm.bpe_jobs import round_trip
from scorewright.llm.langid import UNKNOWN, fit_profiles, held_out, predict_language
from scorewright.llm.line_dedup import dedup_lines
from scorewright.llm.mixing import mix
from scorewright.llm.near_dup import keep_one
from scorewright.session import stage_root

#: SQL has neither the language profiles nor the merges; tests compare run() with brute force.
ORACLE_SQL = None


#: Least likeness to a learned language. On labelled documents held out at sf 0.1 (2,000) the least score
#: is above 0.4; a text of another script or of random marks shares next to nothing and lies near 0.
LEAST_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that a learned language is like (``LEAST_SCORE``); others go, and those without a letter.

    Profiles are learned from labelled documents outside the held-out fifth. Null, empty and blank texts
    go. Without any labelled document no language is known, and only texts without a letter go. Rows are
    judged one by one, so repeated rows and ids share their fate; an empty table stays empty.
    """
    profiles = fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    named = predict_language(docs.select(F.struct("*").alias("row"), "text"), profiles)
    if profiles.languages:
        kept = (F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)
    else:
        kept = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return unboxed(named.where(kept), docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from every document; n_chars follows the text.

    No document goes: one that loses all its lines has an empty text, as has one whose text is null. Rows
    sharing an id count as one document, null being one id.
    """
    out = dedup_lines(docs, min_docs=10, min_chars=1, counts=None)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, stays of each group linked by 5-word shingles at 0.8.

    Texts without a word are linked with nothing and stay, as do rows without an id; rows that repeat the
    kept id all stay.
    """
    return keep_one(docs, shingle_words=5, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by weights 1, 2, 3 repeating: a row for each copy, in order of training.

    Null sources are one source, the last; documents that get no copy go; texts without a word have size
    0. Equal rows are interchangeable.
    """
    return mix(docs, max_repeat=3)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every copy, as their number and digest, and the digest of the decoded text; a null text is
    empty and has no id."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "bpe.*")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_bpe),
]


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = os.path.join(stage_root(spark), f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


