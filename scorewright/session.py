"""Session defaults and the shared folder used to stage intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = 8, app: str = "scorewright", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stage_root(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there every
    executor shares the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="scorewright-stage-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    The lineage is cut by a table on reliable storage, so a lost executor re-reads
    files and never re-samples or re-shuffles what produced them.
    """
    spark = df.sparkSession
    path = os.path.join(stage_root(spark), f"stage-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
