"""Streaming ingestion: validate, route, record, summarize.

Each micro-batch is written once to a staging folder named by its batch id, so
that generated ids and clocks are fixed before anything is read twice.  The
accepted and the rejected part are then written from there, again to folders
named by the batch id: a batch that is run again after a crash replaces its own
output, so the tables hold every event exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.operators import contract as ct
from quire.sources.tables import path_exists

STAGED = "staged"
ACCEPTED = "accepted"
REJECTED = "rejected"


def _batch_folder(root: str, part: str, batch_id: int) -> str:
    return f"{root}/{part}/batch_id={batch_id}"


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    contract: ct.Contract = ct.DOCUMENT_CONTRACT,
    inventory: DataFrame | None = None,
    now: Column | None = None,
    emit: Callable[[DataFrame, DataFrame, int], None] | None = None,
    check_files: bool = True,
) -> None:
    """Validate one batch and write its accepted and rejected events.

    ``emit`` may forward both parts, for example to Kafka topics.
    """
    spark = batch.sparkSession
    staged_path = _batch_folder(root, STAGED, batch_id)
    validated = ct.validate(batch.select("value"), contract, inventory, now=now, check_files=check_files)
    stamped = validated.withColumn("validated_at", F.current_timestamp() if now is None else now)
    stamped.write.mode("overwrite").parquet(staged_path)

    staged = spark.read.schema(stamped.schema).parquet(staged_path)
    good, bad = ct.route(staged, now=F.col("validated_at"))
    good.write.mode("overwrite").json(_batch_folder(root, ACCEPTED, batch_id))
    (
        bad.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("reason_code")
        .parquet(_batch_folder(root, REJECTED, batch_id))
    )
    if emit is not None:
        emit(good, bad, batch_id)


def run_ingestion(
    stream: DataFrame,
    root: str,
    checkpoint: str | None = None,
    contract: ct.Contract = ct.DOCUMENT_CONTRACT,
    inventory: DataFrame | None = None,
    now: Column | None = None,
    emit: Callable[[DataFrame, DataFrame, int], None] | None = None,
    check_files: bool = True,
) -> list[int]:
    """Drain what the source holds and stop; a later run goes on from there.

    The inventory is read and stored once, not for each micro-batch.  Returns the ids of the batches of this run.
    """
    batches: list[int] = []
    if inventory is not None:
        inventory = ct.file_paths(inventory)

    def handle(df: DataFrame, batch_id: int) -> None:
        ingest_batch(df, batch_id, root, contract, inventory, now, emit, check_files)
        batches.append(batch_id)

    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or f"{root}/checkpoint")
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
    return batches


def accepted_events(spark: SparkSession, root: str, contract: ct.Contract = ct.DOCUMENT_CONTRACT) -> DataFrame:
    """The manifest: all accepted events so far."""
    types = {"integer": "bigint"}
    schema = ", ".join(f"{f.name} {types.get(f.kind, 'string')}" for f in contract.fields)
    return spark.read.schema(f"{schema}, batch_id bigint").json(f"{root}/{ACCEPTED}")


def rejected_events(spark: SparkSession, root: str) -> DataFrame:
    """The quarantine: all rejected events so far, partitioned by reason code."""
    schema = "original_event string, rejection_reason string, rejected_at timestamp, batch_id bigint, reason_code string"
    return spark.read.schema(schema).parquet(f"{root}/{REJECTED}")


def staged_events(spark: SparkSession, root: str) -> DataFrame:
    schema = "value string, reason_code string, reason string, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{root}/{STAGED}")


def run_summary(spark: SparkSession, root: str, batches: list[int] | None = None) -> dict:
    """Totals, of some batches or of all so far, and a frame with every reason's count.

    A reason may name a file, so there can be as many as rejected events: they
    stay a frame (reason_key, n) and are not brought to the driver.
    """
    if batches == [] or not path_exists(spark, f"{root}/{STAGED}"):
        none = spark.createDataFrame([], "reason_key string, n bigint")
        return {"total": 0, "accepted": 0, "rejected": 0, "rejection_reasons": none}
    staged = staged_events(spark, root)
    if batches is not None:
        staged = staged.filter(F.col("batch_id").isin(batches))
    total, accepted, rejected = ct.ingestion_counts(staged).first()
    return {
        "total": total,
        "accepted": accepted,
        "rejected": rejected,
        "rejection_reasons": ct.rejection_breakdown(staged),
    }
