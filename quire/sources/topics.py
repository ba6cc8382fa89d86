"""Event topics and manifests.

A topic is Kafka where the connector is on the class path, or a folder of
JSON-lines files with the same content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quire.functions.text import iso_utc
from quire.sources.tables import path_exists

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("course_code", T.StringType()),
        T.StructField("uploaded_by", T.StringType()),
        T.StructField("upload_timestamp", T.StringType()),
    ]
)


def encode_events(events: DataFrame, key: str = "document_id") -> DataFrame:
    """Key and JSON value of each event; NULL fields are left out."""
    return events.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def dead_letters(rejected: DataFrame) -> DataFrame:
    """JSON messages of rejected events; the original stays JSON where it is."""
    event = F.col("original_event")
    original = F.coalesce(F.try_parse_json(event), event.cast("variant"))
    message = F.struct(
        original.alias("original_event"), F.col("rejection_reason"), iso_utc(F.col("rejected_at")).alias("rejected_at")
    )
    return rejected.select(F.to_json(message).alias("value"))


def kafka_emitter(servers: str, accepted_topic: str, dead_letter_topic: str):
    """For ``run_ingestion(emit=...)``: both parts of a batch to their topics.

    A batch that runs again is sent again; the stored tables hold it once.
    """

    def emit(good: DataFrame, bad: DataFrame, batch_id: int) -> None:
        write_topic_kafka(encode_events(good), servers, accepted_topic)
        write_topic_kafka(dead_letters(bad), servers, dead_letter_topic)

    return emit


def write_topic_files(encoded: DataFrame, folder: str, mode: str = "append") -> None:
    encoded.select("value").write.mode(mode).text(folder)


def write_topic_kafka(encoded: DataFrame, servers: str, topic: str) -> None:
    encoded.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_topic_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New files of the folder, each line a ``value``; blank lines are no events."""
    reader = spark.readStream.format("text").schema("value string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).filter(F.trim("value") != "")


def stream_topic_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The topic from its beginning; later runs go on from their checkpoint."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Accepted events from JSON lines; a missing manifest is an error."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no validated manifest at {path}: run the ingestion first")
    return spark.read.schema(MANIFEST_SCHEMA).json(path)
