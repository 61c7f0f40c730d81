"""Queries over the places where a user plugs in a function of their own."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import functions as F

from scorewright.catalog.base import ROW_KEY, SCORED, planted_label, query, raw_lines, scored_lines, table
from scorewright.catalog.evaluation import CONF
from scorewright.functions.columns import sigmoid
from scorewright.functions.plugins import elementwise
from scorewright.functions.stats import confusion_counts, metric_columns
from scorewright.operators import model as ML
from scorewright.operators import splits as S
from scorewright.operators import surrogate as SG


@query(
    "map_lambda",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'other' END AS priority
       FROM orders""",
)
def map_lambda(spark, sf):
    known = {"1-URGENT", "2-HIGH"}
    safe = elementwise(lambda v: v if v in known else "other", "string")
    return table(spark, sf, "orders").select("o_orderkey", safe("o_orderpriority").alias("priority"))


@query("objective")
def objective(spark, sf):
    rows = S.split(raw_lines(spark, sf).withColumn("y", planted_label()), ROW_KEY, 0.2, 43, exact=False, into="part")
    features = ["l_quantity", "l_discount"]

    lock, known = Lock(), {}

    def class_means(train):
        """The same for every trial, so the rows are read once for all of them."""
        with lock:
            if id(train) not in known:
                known[id(train)] = {r["y"]: r for r in train.groupBy("y").agg(*[F.avg(c).alias(c) for c in features]).collect()}
        return known[id(train)]

    def centroid_fit(train, trial):
        """A user's own fit: the direction between the class means, scaled by the trial's C."""
        means = class_means(train)
        weights = tuple(trial.C * (means[1][c] - means[0][c]) for c in features)
        middle = sum(w * (means[1][c] + means[0][c]) / 2 for w, c in zip(weights, features))
        return ML.LogisticModel(tuple(features), weights, -middle)

    train, valid = rows.where("part = 'train'"), rows.where("part = 'test'")
    return ML.search(train, valid, features, "y", fit_one=centroid_fit)


@query("predict_fn")
def predict_fn(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", (F.col("p_size") / 25.0).alias("size"), (F.col("p_retailprice") / 1000.0).alias("price")
    )

    def stump(z):
        return F.when(z["size"] > 1.0, sigmoid(z["price"] * 2.0)).otherwise(0.2)

    return SG.local_surrogate(rows, stump, ["size", "price"], ["p_partkey"], spread=spark.sparkContext.defaultParallelism)


@query(
    "metric_udaf",
    f"""WITH {SCORED}, c AS (SELECT l_returnflag, {CONF} FROM scored GROUP BY 1)
        SELECT l_returnflag, round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
            round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision FROM c""",
)
def metric_udaf(spark, sf):
    m = metric_columns(*[confusion_counts("y", "prediction")[k] for k in ("tn", "fp", "fn", "tp")])
    return scored_lines(spark, sf).groupBy("l_returnflag").agg(
        F.round(m["accuracy"], 6).alias("accuracy"), F.round(m["precision"], 6).alias("precision")
    )
