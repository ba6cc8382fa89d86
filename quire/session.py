"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on.  Sizes and parallelism are left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # What a Python worker takes at once: wide rows come in smaller batches.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # HotSpot never compiles methods above this size; let Spark split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "quire", **conf: str) -> SparkSession:
    """Get or create a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without that setting uses a folder in its warehouse, which driver
    and executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``options`` are the writer's.

    Several passes over the same derived table then read columnar files, and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
