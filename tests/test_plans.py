"""The physical plans are the ones we want."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from scorewright.operators import joins
from scorewright.sources import readers, writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(entry.queries()["filter_flag"](spark, sf))
    assert "PushedFilters: [IsNotNull(toxic), EqualTo(toxic,1)]" in text
    text = plan(entry.queries()["label_text"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in text


def test_one_day_reads_one_folder(spark, sf, tmp_path):
    path = str(tmp_path / "dated")
    writers.write_by_date(spark.read.parquet(f"{sf}/events.parquet"), path, "ts")
    text = plan(readers.yesterday(spark.read.parquet(path), "2024-01-15"))
    assert "PartitionFilters: [isnotnull(event_date" in text and "2024-01-14" in text


def test_row_local_work_does_not_shuffle(spark, sf):
    for name in ("score", "shap_local", "bin_fixed", "violations", "plain_split", "quarantine"):
        assert "Exchange" not in plan(entry.queries()[name](spark, sf)), name


def test_no_cross_joins(spark, sf):
    for name in ("monitoring_summary", "classification_metrics", "stats_cross_join", "min_coverage_gate", "dataset_drift"):
        text = plan(entry.queries()[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_big_lookups_are_not_broadcast(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    look = spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.lookup_join(big, look, ["k"]))
        far = plan(joins.lookup_join(big, look, ["k"], max_rows=10))
        assert "BroadcastHashJoin" not in far and "_salt" not in far
        split = plan(joins.skew_join(big, look, ["k"], task_bytes=1000))
        assert "BroadcastHashJoin" not in split and "_salt" in split
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
