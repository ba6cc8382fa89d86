"""Lineage of pipeline steps: an append-only event table and its summary."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quire import fixed_values as fixed

LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("namespace", T.StringType(), False),
        T.StructField("job", T.StringType(), False),
        T.StructField("producer", T.StringType(), False),
        T.StructField("row_count", T.LongType()),
    ]
)


@dataclass
class Step:
    """A running step; what it sets in ``rows`` is kept with its last event."""

    run_id: str
    rows: int | None = None


class LineageLog:
    """Appends one row per step state to the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, namespace: str = "quire", producer: str = "quire"):
        self.spark, self.path, self.namespace, self.producer = spark, path, namespace, producer

    def emit(self, event_type: str, run_id: str, job: str, rows: int | None = None) -> None:
        row = (event_type, datetime.now(timezone.utc), run_id, self.namespace, job, self.producer, rows)
        self.spark.createDataFrame([row], LINEAGE_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(LINEAGE_SCHEMA).parquet(self.path)

    @contextmanager
    def step(self, job: str) -> Iterator[Step]:
        """START, then COMPLETE, or FAIL with the error raised again."""
        step = Step(str(uuid.uuid4()))
        self.emit(fixed.LINEAGE_START, step.run_id, job)
        try:
            yield step
        except Exception:
            self.emit(fixed.LINEAGE_FAIL, step.run_id, job, step.rows)
            raise
        self.emit(fixed.LINEAGE_COMPLETE, step.run_id, job, step.rows)


def lineage_summary(
    events: DataFrame,
    run_keys: list[str] | None = None,
    state: str = "event_type",
    time: str = "event_time",
    start: str = fixed.LINEAGE_START,
    complete: str = fixed.LINEAGE_COMPLETE,
    fail: str = fixed.LINEAGE_FAIL,
) -> DataFrame:
    """State and duration per run: one aggregate, combined map-side."""
    at = lambda *states: F.when(F.col(state).isin(*states), F.col(time))
    summary = events.groupBy(*(run_keys or ["run_id", "job"])).agg(
        F.min(at(start)).alias("started_at"),
        F.max(at(complete, fail)).alias("ended_at"),
        F.count_if(F.col(state) == fail).alias("failures"),
        F.count_if(F.col(state) == complete).alias("completions"),
    )
    outcome = F.when(F.col("failures") > 0, fail).when(F.col("completions") > 0, complete).otherwise("RUNNING")
    micros = F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return summary.withColumns({"state": outcome, "duration_seconds": micros / 1000000})
