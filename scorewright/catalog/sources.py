"""Queries over scans, sinks and versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from scorewright.catalog.base import (
    CHAMPION, KEY_SQL, fresh_dir, key_hash_sql, margin_sql, probability_sql, query, raw_lines, table,
)
from scorewright.functions.columns import sigmoid
from scorewright.operators import features as X
from scorewright.operators.feedback import append_logs
from scorewright.operators.joins import lookup_join
from scorewright.operators.profile import baseline_stats
from scorewright.sources import readers, writers

CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("scan_csv", CUSTOMER_SQL)
def scan_csv(spark, sf):
    path = fresh_dir(spark, "customer-csv")
    writers.write_csv(table(spark, sf, "customer"), path)
    good, _ = readers.read_csv(spark, path, CUSTOMER)
    return good.drop("source_file")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "scan_file_list",
    "SELECT c_mktsegment AS segment, count(*) AS n_rows, 1::BIGINT AS n_folders FROM customer GROUP BY 1",
)
def scan_file_list(spark, sf):
    root = fresh_dir(spark, "customer-files")
    rows = table(spark, sf, "customer").withColumn("segment", F.col("c_mktsegment"))
    rows.hint("rebalance", F.col("segment")).write.partitionBy("segment").option("header", True).csv(root)
    folders = [f"{root}/segment={s}" for s in SEGMENTS]
    good, _ = readers.read_csv(spark, folders, CUSTOMER)
    return good.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.regexp_extract("source_file", "segment=([^/]*)/", 1)).alias("n_folders"),
    )


EVENT_LINE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query(
    "scan_jsonl_recursive",
    """SELECT CASE WHEN event_type = 'error' THEN 'quarantined' ELSE 'good' END AS status, count(*) AS n
       FROM events GROUP BY 1""",
)
def scan_jsonl_recursive(spark, sf):
    root = fresh_dir(spark, "events-jsonl")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    cut = F.when(F.col("event_type") == "error", F.substring(line, 1, 12)).otherwise(line)
    # every line is followed by a blank one; error lines are cut short
    events = table(spark, sf, "events").select(
        F.explode(F.array(cut, F.lit(""))).alias("value"), F.col("event_type").alias("part")
    )
    events.write.partitionBy("part").text(root)
    good, bad = readers.read_jsonl(spark, root, EVENT_LINE, "*.txt")
    both = good.select(F.lit("good").alias("status")).unionByName(bad.select(F.lit("quarantined").alias("status")))
    return both.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "scan_date_partition",
    """SELECT event_id, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-15'""",
)
def scan_date_partition(spark, sf):
    path = fresh_dir(spark, "events-by-date")
    writers.write_by_date(table(spark, sf, "events"), path, "ts")
    dated = spark.read.parquet(path)
    return readers.yesterday(dated, "2024-01-15").select("event_id", "event_type", "value")


@query("scan_dir_latest", "SELECT doc_id, lang, n_chars FROM documents")
def scan_dir_latest(spark, sf):
    """Three deliveries in a folder; only the one written last is read."""
    path = fresh_dir(spark, "documents-dir")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    for name, rows in (("b", docs.where("lang = 'en'")), ("c", docs.withColumn("n_chars", F.col("n_chars") + 1)), ("a", docs)):
        rows.write.parquet(f"{path}/{name}")
    return spark.read.parquet(readers.newest_path(spark, path, "*.parquet", folder=True))


@query(
    "latest_version",
    """SELECT o_orderkey, o_totalprice, year(o_orderdate)::VARCHAR AS version FROM orders
       WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
)
def latest_version(spark, sf):
    """Versions are folders: the newest is told from their names, and only its files are read."""
    path = fresh_dir(spark, "orders-by-version")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("version"))
    orders.write.partitionBy("version").parquet(path)
    return readers.read_newest_version(spark, path).withColumn("version", F.col("version").cast("string"))


@query(
    "latest_version_grouped",
    """SELECT c.c_mktsegment, max(year(o_orderdate))::VARCHAR AS version, count(*) AS n_orders
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       WHERE year(o_orderdate) = (
           SELECT max(year(o2.o_orderdate)) FROM orders o2 JOIN customer c2 ON o2.o_custkey = c2.c_custkey
           WHERE c2.c_mktsegment = c.c_mktsegment)
       GROUP BY 1""",
)
def latest_version_grouped(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, sf, "orders").withColumn("version", F.year("o_orderdate").cast("string"))
    tagged = lookup_join(orders.select("o_custkey", "version"), customers, ["o_custkey"], "inner")
    newest = readers.latest(tagged, "version", ["c_mktsegment"])
    return newest.groupBy("c_mktsegment").agg(F.max("version").alias("version"), F.count(F.lit(1)).alias("n_orders"))


@query(
    "snapshot_write",
    """SELECT 1704067200::BIGINT AS version, count(*) AS n_rows, round(sum(c_acctbal), 2) AS balance FROM customer
       UNION ALL
       SELECT 1704153600::BIGINT, count(*), round(sum(c_acctbal), 2) FROM customer WHERE c_acctbal >= 0""",
)
def snapshot_write(spark, sf):
    path = fresh_dir(spark, "customer-versions")
    customers = table(spark, sf, "customer")
    writers.write_snapshot(customers, path, 1704067200)
    writers.write_snapshot(customers.where("c_acctbal >= 0"), path, 1704153600)
    writers.write_snapshot(customers.where("c_acctbal >= 0"), path, 1704153600)  # a re-run changes nothing
    return spark.read.parquet(path).groupBy("version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    ).withColumn("version", F.col("version").cast("long"))


@query("sink_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_csv(spark, sf):
    path = fresh_dir(spark, "supplier-csv")
    writers.write_csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return spark.read.schema("s_suppkey long, s_name string, s_acctbal double").option("header", True).csv(path)


@query("sink_append_rows", f"SELECT {KEY_SQL} AS row_key, round({probability_sql(CHAMPION)}, 6) AS p FROM lineitem")
def sink_append_rows(spark, sf):
    path = fresh_dir(spark, "scores")
    scored = raw_lines(spark, sf).select(
        "row_key", F.round(CHAMPION.probability(), 6).alias("p"), "l_linestatus"
    )
    for status in ("F", "O"):
        writers.append_rows(scored.where(F.col("l_linestatus") == status).drop("l_linestatus"), path)
    return spark.read.parquet(path)


APPEND_SQL = """SELECT doc_id, lang, NULL::VARCHAR AS source FROM documents WHERE n_chars < 500
    UNION ALL SELECT doc_id, lang, source FROM documents WHERE n_chars >= 500"""


def _appended(spark, sf):
    docs = table(spark, sf, "documents")
    old = docs.where("n_chars < 500").select("doc_id", "lang")
    new = docs.where("n_chars >= 500").select("lang", "source", "doc_id")
    return append_logs(old, new)


@query("append_log", APPEND_SQL)
def append_log(spark, sf):
    return _appended(spark, sf)


@query(
    "union_by_name",
    f"SELECT lang, count(*) AS n_rows, count(source) AS n_source FROM ({APPEND_SQL}) GROUP BY 1",
)
def union_by_name(spark, sf):
    return _appended(spark, sf).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("source").alias("n_source")
    )


@query(
    "json_report",
    """SELECT json_object('lang', lang, 'n_rows', count(*), 'longest', max(n_chars))::VARCHAR AS report
       FROM documents GROUP BY lang""",
)
def json_report(spark, sf):
    rows = table(spark, sf, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("n_chars").alias("longest")
    )
    return writers.json_report(rows, ["lang", "n_rows", "longest"])


@query(
    "json_report_read",
    "SELECT lang, count(*) AS n_rows, max(n_chars) AS longest FROM documents GROUP BY lang",
)
def json_report_read(spark, sf):
    return writers.read_report(json_report(spark, sf), "report", "lang string, n_rows long, longest long")


@query(
    "model_state_io",
    f"""SELECT {KEY_SQL} AS row_key,
        round((l_quantity - (SELECT avg(l_quantity) FROM lineitem))
            / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
        round(1::DOUBLE / (1::DOUBLE + exp(-({margin_sql(CHAMPION)}))), 6) AS p
        FROM lineitem""",
)
def model_state_io(spark, sf):
    root = fresh_dir(spark, "state")
    rows = raw_lines(spark, sf)
    state = X.fit(rows, X.FeatureSpec(encode=["l_returnflag"], select=["l_quantity", "l_returnflag"]))
    writers.save_state(state, spark, f"{root}/state")
    writers.save_model(CHAMPION, spark, f"{root}/model")
    back, model = writers.load_state(spark, f"{root}/state"), writers.load_model(spark, f"{root}/model")
    quantity = (F.col("l_quantity") - F.lit(back.means["l_quantity"])) / F.lit(back.stds["l_quantity"])
    return rows.select(
        "row_key", F.round(quantity, 6).alias("l_quantity"), F.round(sigmoid(model.margin()), 6).alias("p")
    )


def _draw_sql(name: str) -> str:
    """A standard normal draw of a row number, from two groups of its hash."""
    h = key_hash_sql(42, "id", f"'{name}'")
    u, v = (f"('0x' || substr({h}, {at}, 8))::BIGINT::DOUBLE" for at in (1, 9))
    return f"sqrt(-2 * ln(({u} + 0.5::DOUBLE) / 4294967296)) * cos(2 * pi() * ({v} / 4294967296))"


@query(
    "reconstruct_reference",
    f"""SELECT id, round({_draw_sql('l_quantity')} * (SELECT stddev_samp(l_quantity) FROM lineitem) + (SELECT avg(l_quantity) FROM lineitem), 4) AS l_quantity,
        round({_draw_sql('l_extendedprice')} * (SELECT stddev_samp(l_extendedprice) FROM lineitem) + (SELECT avg(l_extendedprice) FROM lineitem), 3) AS l_extendedprice,
        (('0x' || substr({key_hash_sql(42, "id", "'y'")}, 1, 8))::BIGINT / 4294967296::DOUBLE < 0.38::DOUBLE)::INT AS y FROM range(500) r(id)""",
)
def reconstruct_reference(spark, sf):
    rows = baseline_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    stats = {r["feature"]: {"mean": r["mean"], "std": r["std"]} for r in rows.collect()}
    made = readers.reconstruct_reference(spark, stats, n=500, seed=42, label="y", keep_id=True)
    return made.withColumns({"l_quantity": F.round("l_quantity", 4), "l_extendedprice": F.round("l_extendedprice", 3)})


@query(
    "merge_reports",
    """WITH old AS (SELECT lang AS k, count(*) AS v FROM documents WHERE n_chars < 1200 GROUP BY 1),
       new AS (SELECT lang AS k, count(*) AS v FROM documents WHERE n_chars >= 1200 GROUP BY 1)
       SELECT coalesce(new.k, old.k) AS feature, coalesce(new.v, old.v) AS n
       FROM old FULL OUTER JOIN new ON old.k = new.k""",
)
def merge_reports(spark, sf):
    docs = table(spark, sf, "documents")

    def doc(cond):
        return docs.where(cond).groupBy(F.col("lang").alias("feature")).agg(F.count(F.lit(1)).alias("n"))

    old, new = doc("n_chars < 1200"), doc("n_chars >= 1200").withColumnRenamed("n", "newer")
    return old.join(new, "feature", "full").select("feature", F.coalesce("newer", "n").alias("n"))
