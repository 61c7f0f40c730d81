"""Streaming queries: the driver's tables as file streams, compared with the batch answer.

A row far in the future closes the last window and lets the last timers run; it is part of this harness, not of the operators, and is filtered out of the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.catalog.base import CHAMPION, KEY_SQL, fresh_dir, key_column, probability_sql, query, table
from scorewright.catalog.monitoring import chi2_sql, ecdf_sql
from scorewright.session import stage
from scorewright.sources.readers import REQUEST_LOG
from scorewright.streaming import jobs as J, windows as W

CLOSING = "2999-01-01 00:00:00"


def table_stream(spark, sf, name):
    """The given table as a file stream."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def closing_row(spark, like):
    """One row with event id -1 and no other value but its event time.

    The id must not be null: stateful steps by key may drop null keys before the watermark sees their row.
    """
    values = {"ts": f"{CLOSING}Z", "event_id": -1}
    return spark.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def closing_rows(spark, like):
    """The closing row as a stream."""
    path = fresh_dir(spark, "closing")
    closing_row(spark, like).write.parquet(path)
    return spark.readStream.schema(like.schema).parquet(path)


def finish(spark, stream, name, mode="append"):
    root = fresh_dir(spark, name)
    J.run_to_table(stream, f"{root}/out", f"{root}/checkpoint", mode)
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def instant(ts="ts"):
    """The tables store UTC wall-clock times; event time needs instants in any session zone."""
    return F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp")


def utc_ntz(ts):
    """An instant as the tables store it: UTC wall-clock time without a zone."""
    micros = F.unix_micros(ts)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(20,6)"))


def events_stream(spark, sf):
    rows = table_stream(spark, sf, "events")
    return rows.select("event_id", instant().alias("ts"), "event_type", "value")


@query(
    "stream_ingest_logs",
    """SELECT event_id, event_type, (value > 10)::INT::VARCHAR AS prediction,
        CASE WHEN value > 50 THEN 'unknown' ELSE event_type END AS deployment FROM events""",
)
def stream_ingest_logs(spark, sf):
    root = fresh_dir(spark, "request-logs")
    events = table(spark, sf, "events")
    body = F.create_map(
        F.lit("event_id"), F.col("event_id").cast("string"), F.lit("event_type"), F.col("event_type")
    )
    host = F.create_map(F.lit("host"), F.lit("a"))
    headers = F.when(F.col("value") > 50, host).otherwise(F.create_map(F.lit("deployment"), F.col("event_type")))
    answer = F.struct(F.struct((F.col("value") > 10).cast("int").cast("string").alias("prediction")).alias("body"))
    line = F.to_json(
        F.struct(F.struct(body.alias("body"), headers.alias("headers")).alias("request"), answer.alias("response"))
    )
    cut = F.substring(line, 1, 20)  # a line broken off, and a blank one, after every whole line
    events.select(F.explode(F.array(line, cut, F.lit(""))).alias("value")).write.text(root)
    good, bad = J.ingest_requests(spark, root, REQUEST_LOG, ["event_id", "event_type"], pattern="*.txt")
    finish(spark, bad, "quarantined")
    return finish(spark, good.withColumn("event_id", F.col("event_id").cast("long")), "ingested")


@query(
    "stream_score",
    f"""SELECT {KEY_SQL} AS row_key, round({probability_sql(CHAMPION)}, 6) AS survival_probability,
        ({probability_sql(CHAMPION)} > 0.5)::INT AS prediction FROM lineitem""",
)
def stream_score(spark, sf):
    rows = table_stream(spark, sf, "lineitem").withColumn("row_key", key_column())
    scored = J.score_stream(rows, CHAMPION).select(
        "row_key", F.round("survival_probability", 6).alias("survival_probability"), "prediction"
    )
    return finish(spark, scored, "scored")


@query(
    "stream_daily_window",
    """SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 4) AS total,
        round(avg(value), 6) AS mean FROM events GROUP BY 1, 2""",
)
def stream_daily_window(spark, sf):
    rows = events_stream(spark, sf)
    windows = J.daily_window(rows.unionByName(closing_rows(spark, rows)), "ts", ["event_type"], "value")
    done = finish(spark, windows, "daily").where("event_type IS NOT NULL")
    day = F.date_from_unix_date((F.unix_seconds("day") / 86400).cast("int"))
    return done.withColumn("day", day).withColumns({"total": F.round("total", 4), "mean": F.round("mean", 6)})


def arrivals(rows, ts, cuts, path):
    """Appends the rows to ``path`` in slices of event time, first to last; yields after each."""
    marks = [None, *[F.lit(f"{c} 00:00:00Z").cast("timestamp") for c in cuts], None]
    for low, high in zip(marks[:-1], marks[1:]):
        here = (F.lit(True) if low is None else F.col(ts) >= low) & (F.lit(True) if high is None else F.col(ts) < high)
        rows.where(here).write.mode("append").option("maxRecordsPerFile", W.FILE_ROWS).parquet(path)
        yield


@query(
    "stream_label_join",
    """SELECT event_id, value, CASE WHEN event_type NOT IN ('click', 'purchase') THEN NULL
        WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS label FROM events""",
)
def stream_label_join(spark, sf):
    """Labels come after two hours; every third is overridden two days later, in another batch; one of
    every five is sent twice. Labels after the wait change nothing."""
    root = fresh_dir(spark, "labels")
    events = stage(table(spark, sf, "events").select("event_id", instant().alias("ts"), "event_type", "value"))
    preds = events.select("event_id", F.col("ts").alias("pred_ts"), "value")
    labelled = events.where(F.col("event_type").isin("click", "purchase"))

    def label(rows, after, text):
        return rows.select(F.col("event_id").alias("label_id"), (F.col("ts") + F.expr(f"INTERVAL {after}")).alias("label_ts"), text.alias("label"))

    labels = (
        label(labelled, "2 HOURS", F.col("event_type"))
        .unionByName(label(labelled.where("event_id % 5 = 0"), "2 HOURS", F.col("event_type")))
        .unionByName(label(labelled.where("event_id % 3 = 0"), "2 DAYS", F.upper("event_type")))
        .unionByName(label(labelled.where("event_id % 7 = 0"), "9 DAYS", F.lit("too late")))
    )
    far = F.lit(f"{CLOSING}Z").cast("timestamp")
    one = spark.range(1)
    preds = preds.unionByName(one.select(F.lit(-1).cast("long").alias("event_id"), far.alias("pred_ts"), F.lit(None).cast("double").alias("value")))
    labels = labels.unionByName(one.select(F.lit(-2).cast("long").alias("label_id"), far.alias("label_ts"), F.lit(None).cast("string").alias("label")))
    cuts, partitions = ["2024-01-08", "2024-01-16", "2024-01-24"], J.state_partitions(spark, events.count())
    for _ in zip(arrivals(preds, "pred_ts", cuts, f"{root}/preds"), arrivals(labels, "label_ts", cuts, f"{root}/labels")):
        joined = W.late_labels(
            spark.readStream.schema(preds.schema).parquet(f"{root}/preds"), spark.readStream.schema(labels.schema).parquet(f"{root}/labels"),
            "event_id", "pred_ts", "label_id", "label_ts", wait="7 days",
        )
        out = joined.select("event_id", "value", "label")
        J.run_to_table(out, f"{root}/out", f"{root}/checkpoint", partitions=partitions)
    return spark.read.schema(out.schema).parquet(f"{root}/out").where("event_id >= 0")


@query("stream_dedupe", "SELECT event_id, event_type, value, 'first' AS copy, ts FROM events")
def stream_dedupe(spark, sf):
    """Three copies of every event, minutes apart, the later ones in other batches too: the earliest stays."""
    root = fresh_dir(spark, "copies")
    events = table(spark, sf, "events").select("event_id", instant().alias("ts"), "event_type", "value")
    copies = F.explode(F.array(*[F.struct(F.lit(n).alias("copy"), F.lit(m).alias("after")) for n, m in (("first", 0), ("second", 20), ("third", 50))]))
    rows = events.withColumn("c", copies).select(
        "event_id", F.timestamp_micros(F.unix_micros("ts") + F.col("c.after").cast("long") * 60_000_000).alias("ts"),
        "event_type", "value", F.col("c.copy").alias("copy"),
    )
    rows, partitions = rows.unionByName(closing_row(spark, rows)), J.state_partitions(spark, 3 * events.count())
    for _ in arrivals(rows, "ts", ["2024-01-10", "2024-01-20"], f"{root}/in"):
        unique = W.dedupe(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), ["event_id"], "ts", within="1 hour")
        J.run_to_table(unique, f"{root}/out", f"{root}/checkpoint", partitions=partitions)
    done = spark.read.schema(rows.schema).parquet(f"{root}/out").where("event_id >= 0")
    return done.withColumn("ts", utc_ntz("ts"))


WINDOW_SQL = "(DATE '1970-01-01' + (floor(epoch(ts) / 1382400) * 16)::INT)"


@query(
    "stream_drift_monitor",
    f"""WITH win AS (SELECT *, {WINDOW_SQL} AS day FROM events WHERE ts >= TIMESTAMP '2024-01-15'),
        ref AS (SELECT events.*, day FROM events, (SELECT DISTINCT day FROM win) WHERE ts < TIMESTAMP '2024-01-15'),
        cur AS (SELECT day, value * 1.2::DOUBLE AS value, event_type FROM win), {ecdf_sql(['value'], 'day')}, {chi2_sql(['event_type'], 'day')}
        SELECT day, feature, round(statistic, 6) AS statistic, n::BIGINT AS n_reference, m::BIGINT AS n_current, round(p, 6) AS drift_score,
            p < 0.05 AS drift_detected FROM ks
        UNION ALL SELECT day, feature, round(statistic, 6), n, m, NULL, NULL FROM chi""",
)
def stream_drift_monitor(spark, sf):
    """Events arrive in four batches over two windows of 16 days; each window is reported once, when it closes."""
    root = fresh_dir(spark, "drift-monitor")
    events = table(spark, sf, "events").select("event_id", instant().alias("ts"), "event_type", "value")
    cut = F.lit("2024-01-15 00:00:00Z").cast("timestamp")
    reference = W.reference_counts(events.where(F.col("ts") < cut), ["value"], ["event_type"])
    rows = events.where(F.col("ts") >= cut).withColumn("value", F.col("value") * F.lit(1.2))
    rows = rows.unionByName(closing_row(spark, rows))
    for _ in arrivals(rows, "ts", ["2024-01-18", "2024-01-24", "2024-01-27"], f"{root}/in"):
        arriving = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        counts = W.closed_window_counts(arriving, "ts", "16 days", ["value"], ["event_type"])
        W.monitor_closed_windows(counts, reference, ["value"], f"{root}/counts", f"{root}/reports", f"{root}/checkpoint")
    number = F.col("stattest_name") == "ks"  # SQL has no chi-square tail to compare with
    return spark.read.parquet(f"{root}/reports").select(
        F.date_from_unix_date((F.unix_seconds("window_start") / 86400).cast("int")).alias("day"), "feature",
        F.round("statistic", 6).alias("statistic"), "n_reference", "n_current",
        F.when(number, F.round("drift_score", 6)).alias("drift_score"), F.when(number, F.col("drift_detected")).alias("drift_detected"),
    )


@query(
    "stream_late_data",
    """SELECT event_id, ts, ts < TIMESTAMP '2024-01-15' AS is_late FROM events
       UNION ALL SELECT event_id, NULL, true FROM events WHERE event_id % 10 = 0""",
)
def stream_late_data(spark, sf):
    """The older half arrives after the watermark has passed it, every tenth event once more without a time:
    the rows on time come out of the stateful step, all others out of the side table."""
    root, cut = fresh_dir(spark, "late"), F.lit("2024-01-15T00:00:00Z").cast("timestamp")
    events = table(spark, sf, "events").select("event_id", instant().alias("ts"))
    no_time = events.where("event_id % 10 = 0").withColumn("ts", F.lit(None).cast("timestamp"))
    for arriving in (events.where(F.col("ts") >= cut), events.where(F.col("ts") < cut).unionByName(no_time)):
        arriving.write.mode("append").option("maxRecordsPerFile", W.FILE_ROWS).parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        W.part_late(stream, "ts", "1 hour", f"{root}/parted", f"{root}/checkpoint")
    closing_row(spark, events).write.parquet(f"{root}/parted/rows/epoch=closing/is_late=false")
    kept = W.dedupe(W.stream_on_time(spark, f"{root}/parted", events.schema), ["event_id"], "ts")
    progress = J.run_to_table(kept, f"{root}/out", f"{root}/deduped", partitions=J.state_partitions(spark, events.count()))
    if J.late_rows_dropped(progress):
        raise RuntimeError("the stateful step dropped rows that were found on time")
    done = spark.read.schema(events.schema).parquet(f"{root}/out").where("event_id >= 0").withColumn("is_late", F.lit(False))
    late = W.parted_rows(spark, f"{root}/parted", events.schema).where("is_late").select(*done.columns)
    return done.unionByName(late).withColumn("ts", utc_ntz("ts"))
