"""Structured Streaming forms of ingest, scoring and daily counts, and the running of streams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorewright.operators.model import LogisticModel, score
from scorewright.sources.readers import flatten_requests, parse_json_lines


def ingest_requests(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    inputs: Sequence[str],
    header: str = "deployment",
    keep: Sequence[str] = (),
    pattern: str = "*.jsonl",
) -> tuple[DataFrame, DataFrame]:
    """(flattened rows, quarantined lines) as streams over new ``*.jsonl`` files."""
    lines = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root)
    )
    good, bad = parse_json_lines(lines, schema)
    return flatten_requests(good, inputs, header, keep), bad


def score_stream(rows: DataFrame, model: LogisticModel, **names) -> DataFrame:
    """Stateless: the same projection the batch scorer uses."""
    return score(rows, model, **names)


def daily_window(
    rows: DataFrame, ts: str, keys: Sequence[str], value: str, late: str = "1 hour"
) -> DataFrame:
    """Count, positives and mean per group and day of traffic."""
    return (
        rows.withWatermark(ts, late)
        .groupBy(F.window(ts, "1 day").alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
        .select(F.col("w.start").alias("day"), *keys, "n", "total", "mean")
    )


#: Rows (about) of a whole input for each partition of a stream's state, and bytes of files that one task reads.
STATE_ROWS = 200_000
SPLIT_BYTES = 16 << 20

#: State in files of RocksDB on the executor's disk: buffers and blocks of all stores of an executor share a bounded
#: memory. Rows aren't counted, for that would read each key before it is written; files are compacted with each commit,
#: because looking for a key among removed ones passes them one by one; both sides of a join are in one store.
STATE_MB = 300
_ROCKS = "spark.sql.streaming.stateStore.rocksdb"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKS}.boundedMemoryUsage": "true",
    f"{_ROCKS}.maxMemoryUsageMB": STATE_MB,
    f"{_ROCKS}.trackTotalNumberOfRows": "false",
    f"{_ROCKS}.compactOnCommit": "true",
    "spark.sql.streaming.join.stateFormatVersion": 3,
}


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of the state for an input of so many rows; every one is a file to commit in each micro-batch."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // STATE_ROWS))


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """The session with other settings, which are put back at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", partitions: int | None = None):
    """Process everything available into parquet; returns the progress record of every micro-batch.

    ``partitions`` of the state hold from the first run of a checkpoint on (``state_partitions``), and then a task
    reads ``SPLIT_BYTES`` of files; without it the session's settings hold. A query keeps its last hundred
    records only, so they are gathered while it runs.
    """
    sized = {"spark.sql.shuffle.partitions": partitions, "spark.sql.files.maxPartitionBytes": SPLIT_BYTES, **STATE_STORE} if partitions else {}
    with settings(stream.sparkSession, sized):
        return _run_to_table(stream, path, checkpoint, mode)


def _run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str):
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    seen: dict[int, dict] = {}
    done = False
    while not done:
        done = query.awaitTermination(0.5)
        seen.update((p["batchId"], p) for p in query.recentProgress)
    return [seen[k] for k in sorted(seen)]


def late_rows_dropped(progress) -> int:
    """Rows the watermark rejected, over the records that ``run_to_table`` returned."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
