"""Event-time state: drift of closed windows, copies with a defined survivor, the last late label, late rows kept."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorewright.operators import drift as D
from scorewright.session import stage

#: Everything of a row in one string and back, to the microsecond.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}

#: Rows of a file that a stream is to read: so the rows that one task of a micro-batch sorts are bounded.
FILE_ROWS = 100_000


def closed_window_counts(
    rows: DataFrame,
    ts: str,
    duration: str,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    keys: Sequence[str] = (),
    late: str = "1 hour",
) -> DataFrame:
    """Stream of (window_start, keys, feature, value, text, n), each window once, when the watermark closes it.

    The state holds counts of values, not rows, and they are summed in the tasks before they are shuffled.
    Counts of several windows add up to those of a longer one.
    """
    long = rows.withWatermark(ts, late).select(ts, *keys, F.inline(D.feature_entries(numeric, categorical)))
    counted = long.groupBy(F.window(ts, duration).alias("w"), *keys, "feature", "value", "text").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "feature", "value", "text", "n")


def monitor_closed_windows(
    counts: DataFrame,
    reference: DataFrame,
    numeric: Sequence[str],
    counts_path: str,
    report_path: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    alpha: float = D.ALPHA,
) -> None:
    """One report for each window that closes: its stored counts tested against the reference's.

    ``reference`` holds counts too (``drift.value_counts``), made once however many windows come. All of a
    window's counts leave the state in one micro-batch; they are stored under its number, and the
    report is computed from what was stored, so a replayed batch replaces both. Only the starts of
    the windows that close together come to the driver.
    """
    spark = counts.sparkSession

    def handle(batch: DataFrame, epoch: int) -> None:
        here = f"{counts_path}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(here)
        stored = spark.read.schema(batch.schema).parquet(here)
        starts = [r[0] for r in stored.select("window_start").distinct().collect()]
        if not starts:
            return
        each = F.explode(F.array(*[F.lit(s) for s in starts])).alias("window_start")
        sides = stored.withColumn("side", F.lit(1)).unionByName(reference.select(each, "*", F.lit(0).alias("side")))
        on = ["window_start", *keys]
        tests = D.flag_features(D.count_tests(D.pair_counts(sides, on), numeric, on), alpha)
        tests.write.mode("overwrite").parquet(f"{report_path}/epoch={epoch}")

    drain(counts.writeStream.foreachBatch(handle), checkpoint)


def drain(writer, checkpoint: str) -> None:
    """Processes everything available and ends."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def reference_counts(ref: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """The reference's value counts, written once to the shared folder."""
    return stage(D.value_counts(ref, numeric, categorical, keys))


def dedupe(rows: DataFrame, key: Sequence[str], ts: str, within: str = "1 hour", late: str = "1 hour", keep: str = "earliest") -> DataFrame:
    """One row of each session of copies: rows of a key of which each follows another within ``within``.

    ``keep``: the copy with the earliest or the newest event time; equal times go by the other columns.
    Sessions are merged in the tasks before the shuffle, so an id with a huge number of copies stays
    small, and a survivor leaves the state when the watermark has passed its session: the rows are the
    same for any batch size. Rows without an event time take no part (see ``part_late``).
    """
    if keep not in ("earliest", "newest"):
        raise ValueError("keep is 'earliest' or 'newest'")
    rows.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    whole = F.struct(*rows.columns)
    place = F.struct(F.col(ts), F.to_json(whole, JSON))
    pick = F.min_by(whole, place) if keep == "earliest" else F.max_by(whole, place)
    sessions = rows.withWatermark(ts, late).groupBy(F.session_window(ts, within).alias("_session"), *[F.col(k).alias(f"_{k}") for k in key])
    return sessions.agg(pick.alias("_row")).select("_row.*")


def late_labels(
    preds: DataFrame,
    labels: DataFrame,
    key: str,
    pred_ts: str,
    label_key: str,
    label_ts: str,
    wait: str = "30 days",
    late: str = "1 hour",
) -> DataFrame:
    """Every prediction once, with the newest of its labels that lies within ``wait`` after it.

    A stream-stream join meets predictions and labels in either order and gives up a prediction without a
    label when the watermark has passed the end of ``wait``; what it pairs is one row for each prediction: the
    earliest copy of a key with its newest label, copies being those of which each follows another within
    ``wait``. Equal times go by the columns, so the rows are the same for any batch size and order. A key
    names one prediction. Null keys match nothing and are left out, as are rows without an event time; put
    them aside before.
    """
    wait_us = pd.Timedelta(wait) // pd.Timedelta(1, "us")
    # The join's own range adds days by the calendar of the session's zone: a day more covers every clock change.
    reach = wait_us // 1_000_000 + 1 + (86_400 if wait_us >= 86_400_000_000 else 0)

    def side(df: DataFrame, name: str, id_col: str, ts: str) -> DataFrame:
        there = df.where(F.col(id_col).isNotNull() & F.col(ts).isNotNull())
        named = there.select(F.col(id_col).cast("string").alias(f"_{name}_key"), F.col(ts).alias(f"_{name}_at"), F.struct(*df.columns).alias(f"_{name}"))
        return named.withWatermark(f"_{name}_at", late)

    near = f"_pred_key = _label_key AND _label_at >= _pred_at AND _label_at <= _pred_at + INTERVAL '{reach}' SECOND"
    within = F.expr(near) & (F.unix_micros("_label_at") <= F.unix_micros("_pred_at") + wait_us)
    pairs = side(preds, "pred", key, pred_ts).join(side(labels, "label", label_key, label_ts), within, "left")
    pairs.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    age = -F.unix_micros("_pred_at")
    earliest = F.min_by("_pred", F.struct("_pred_at", F.to_json("_pred", JSON)))
    # Copies of one time have the same labels, so the earliest time decides.
    newest = F.max_by("_label", F.struct(age, "_label_at", F.to_json("_label", JSON)))
    copies = pairs.groupBy(F.session_window("_pred_at", wait).alias("_session"), "_pred_key")
    return copies.agg(earliest.alias("_pred"), newest.alias("_label")).select("_pred.*", "_label.*")


def part_late(rows: DataFrame, ts: str, late: str, path: str, checkpoint: str) -> None:
    """Parts the rows behind the watermark from the others before any stateful step sees them.

    The watermark of a micro-batch is the newest event time of all batches before it less ``late``, read
    from ``path``/marks, where each batch leaves its newest event time under its number. Rows behind it, and
    rows without an event time, go to ``path``/rows as late ones, the others as on time; nothing is lost.
    A batch is written once, under its number, so a replayed batch replaces its own rows. A stateful
    stream over the rows on time with the same ``late`` (or more) drops nothing.
    """
    spark: SparkSession = rows.sparkSession

    def handle(batch: DataFrame, epoch: int) -> None:
        border = F.lit(None).cast("timestamp")
        if epoch:
            marks = spark.read.schema("newest timestamp, epoch long").parquet(f"{path}/marks")
            newest = marks.where(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
            border = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {late}")
        behind = F.col(ts).isNull() | F.coalesce(F.col(ts) < border, F.lit(False))
        here = f"{path}/rows/epoch={epoch}"
        batch.withColumn("is_late", behind).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).partitionBy("is_late").parquet(here)
        written = spark.read.schema(batch.schema).parquet(here)
        written.agg(F.max(F.col(ts).cast("timestamp")).alias("newest")).write.mode("overwrite").parquet(f"{path}/marks/epoch={epoch}")

    drain(rows.writeStream.foreachBatch(handle), checkpoint)


def parted_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``part_late`` wrote, with ``is_late`` beside the rows' columns."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("is_late", T.BooleanType())])).parquet(f"{path}/rows")


def stream_on_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stream over the rows that ``part_late`` found on time."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/rows/epoch=*/is_late=false")
