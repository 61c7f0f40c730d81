"""Query of near-duplicate documents; the links have no affordable SQL, tests use brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewright.llm.base import query, table
from scorewright.llm.near_dup import components

@query("op4_near_dup")
def near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return components(table(spark, sf, "documents").select("doc_id", "text"), shingle_words=4, threshold=80)
