"""Queries of secrets and personal data; the models' spans have no SQL, tests use brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm import pii, secret_scan
from scorewright.llm.base import query, table


@query("op1_secret_scan")
def secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    found = secret_scan.scan_secrets(docs, secret_scan.fit_field(docs))
    return found.select("doc_id", *[F.col("secrets")[n].alias(n) for n in names])


@query("op9_pii")
def personal_data(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    found = pii.find_personal_data(docs, pii.fit_tagger(docs))
    return found.select("doc_id", *[F.col("pii")[n].alias(n) for n in names])
