"""A prediction log that late labels are written back to: merge on read, compaction by partition.

Below one folder lie ``log`` (predictions by run and hash bucket of the key that labels name), ``labels``
(one delta for each submitted batch, by the same buckets), ``compactions`` (the rows a compaction
merged) and ``folded`` (which batches it folded into the log). Submitting is cheap: only the batch is written.
Reading joins the deltas that are not yet folded. Compacting rewrites only the partitions whose rows got
a label. Every step can be run again: a batch replaces its own delta, and a compaction that broke off goes
on from the rows it had merged.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scorewright.operators.feedback import latest_labels, stamp
from scorewright.operators.joins import lookup_join

BUCKETS = 64


def bucket(key: str | Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a key by the hash of its text; a null key has none of its own and goes to bucket 0."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(text), F.lit(buckets))).cast("int")


def _overwrite(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def log_run(df: DataFrame, root: str, keys: Sequence[str], run_id: str, match: str, buckets: int = BUCKETS, logged_at: Column | None = None) -> None:
    """Logs one run of predictions; a run that is logged again replaces itself. ``match``: the column that
    labels name."""
    rows = stamp(df, keys, run_id, logged_at).withColumn("bucket", bucket(match, buckets))
    _overwrite(rows.repartition("bucket"), os.path.join(root, "log"), ["run_id", "bucket"])


def submit(
    labels: DataFrame, root: str, id_col: str, label: str, batch: str, arrived_at: Column, order: Sequence[str] = (), buckets: int = BUCKETS
) -> None:
    """Stores one batch of labels: the last of each key by ``order``. A batch that is submitted again
    replaces itself as long as it is not folded (a folded one stays as it was; send corrections as a batch
    of their own). Rows without a key or a label are no labels."""
    newest = latest_labels(labels, id_col, label, [*order, label])
    rows = newest.select(
        F.col("_key").alias("label_key"), "ground_truth", arrived_at.cast("timestamp").alias("arrived_at"),
        F.lit(batch).alias("batch"), bucket("_key", buckets).alias("bucket"),
    )
    _overwrite(rows, os.path.join(root, "labels"), ["batch", "bucket"])


def folded_batches(spark: SparkSession, root: str) -> list[str]:
    """Names of the batches that compactions have folded into the log."""
    path = os.path.join(root, "folded")
    return [r["batch"] for r in spark.read.schema("batch string").parquet(path).distinct().collect()] if _exists(spark, path) else []


def waiting_batches(spark: SparkSession, root: str) -> list[str]:
    """Names of the submitted batches that are not folded yet."""
    path = os.path.join(root, "labels")
    if not _exists(spark, path):
        return []
    there = spark.read.parquet(path).select(F.col("batch").cast("string")).distinct().collect()
    return sorted({r[0] for r in there} - set(folded_batches(spark, root)))


def pending_labels(spark: SparkSession, root: str, batches: Sequence[str] | None = None) -> DataFrame | None:
    """(bucket, label_key, ground_truth, arrived_at): the newest label of each key over the batches that are
    not folded yet (or over ``batches``), by arrival and then by batch; None if there is no such batch."""
    batches = waiting_batches(spark, root) if batches is None else list(batches)
    if not batches:
        return None
    deltas = spark.read.parquet(os.path.join(root, "labels")).withColumn("batch", F.col("batch").cast("string"))
    waiting = deltas.where(F.col("batch").isin(batches))
    last = F.max_by(F.struct("ground_truth", "arrived_at"), F.struct("arrived_at", "batch")).alias("last")
    return waiting.groupBy("bucket", "label_key").agg(last).select("bucket", "label_key", "last.*")


def stored_log(spark: SparkSession, root: str) -> DataFrame:
    """The log's files as they lie, without the batches that are not folded yet."""
    rows = spark.read.parquet(os.path.join(root, "log"))
    return rows.withColumn("run_id", F.col("run_id").cast("string"))


def _labelled(log: DataFrame, labels: DataFrame, match: str) -> DataFrame:
    """The log's columns with newer labels filled in; ``_changed`` tells which rows got one."""
    kind = labels.schema["ground_truth"].dataType
    keyed = log.withColumn("label_key", F.col(match).cast("string"))
    look = labels.withColumnsRenamed({"ground_truth": "_label", "arrived_at": "_at"})
    joined = lookup_join(keyed, look, ["bucket", "label_key"])
    newer = F.col("_at").isNotNull() & (F.col("feedback_received_at").isNull() | (F.col("_at") >= F.col("feedback_received_at")))
    return joined.withColumns(
        {
            "ground_truth": F.when(newer, F.col("_label")).otherwise(F.col("ground_truth").cast(kind)),
            "feedback_received": F.col("feedback_received") | newer,
            "feedback_received_at": F.when(newer, F.col("_at")).otherwise(F.col("feedback_received_at")),
            "_changed": newer,
        }
    ).select(*log.columns, "_changed")


def read_log(spark: SparkSession, root: str, match: str) -> DataFrame:
    """Every logged prediction with the newest of its labels, folded or not. A label of an earlier arrival
    than the stored one changes nothing; rows sharing a key get the same label."""
    log, labels = stored_log(spark, root), pending_labels(spark, root)
    return log if labels is None else _labelled(log, labels, match).drop("_changed")


def updated(spark: SparkSession, root: str, match: str) -> int:
    """How many logged predictions the batches not folded yet give a label."""
    labels = pending_labels(spark, root)
    return 0 if labels is None else _labelled(stored_log(spark, root), labels, match).agg(F.count_if("_changed")).first()[0]


def compact(spark: SparkSession, root: str, match: str, name: str) -> int:
    """Folds the waiting batches into the log and returns how many partitions it rewrote.

    First the touched partitions are merged into a copy of their own, then they are overwritten from it, then
    the batches are noted as folded. If it breaks off, the same ``name`` goes on with the copy that
    is there; labels that arrive meanwhile stay pending. The list of partitions comes to the driver.
    """
    copy = os.path.join(root, "compactions", name)
    if not _exists(spark, os.path.join(copy, "batches", "_SUCCESS")):
        taken = waiting_batches(spark, root)
        labels = pending_labels(spark, root, taken)
        if labels is None:
            return 0
        log = stored_log(spark, root)
        hit = lookup_join(log.withColumn("label_key", F.col(match).cast("string")), labels, ["bucket", "label_key"], "left_semi")
        touched = [tuple(r) for r in hit.select("run_id", "bucket").distinct().collect()]
        here = F.lit(False)
        for run in sorted({r for r, _ in touched}):
            here = here | ((F.col("run_id") == run) & F.col("bucket").isin([b for r, b in touched if r == run]))
        merged = _labelled(log.where(here), labels.where(F.col("bucket").isin([b for _, b in touched])), match).drop("_changed")
        merged.write.mode("overwrite").partitionBy("run_id", "bucket").parquet(os.path.join(copy, "rows"))
        spark.createDataFrame([(b,) for b in taken], "batch string").coalesce(1).write.mode("overwrite").parquet(os.path.join(copy, "batches"))
    log = spark.read.parquet(os.path.join(root, "log"))
    rows = spark.read.schema(log.schema).parquet(os.path.join(copy, "rows"))
    partitions = rows.select("run_id", "bucket").distinct().count()
    _overwrite(rows.repartition("run_id", "bucket"), os.path.join(root, "log"), ["run_id", "bucket"])
    folded = spark.read.schema("batch string").parquet(os.path.join(copy, "batches"))
    folded.write.mode("overwrite").parquet(os.path.join(root, "folded", f"compaction={name}"))
    return partitions
