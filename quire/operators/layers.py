"""Bronze, silver and gold as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quire.functions import text as tx

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("document_id", T.StringType(), False),
        T.StructField("file_name", T.StringType(), False),
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_type", T.StringType(), False),
        T.StructField("file_size_bytes", T.LongType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("course_code", T.StringType()),
        T.StructField("uploaded_by", T.StringType(), False),
        T.StructField("upload_timestamp", T.StringType(), False),
        T.StructField("raw_text", T.StringType()),
        T.StructField("bronze_ingested_at", T.TimestampType(), False),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType(), False),
        T.StructField("document_id", T.StringType(), False),
        T.StructField("file_type", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("course_code", T.StringType()),
        T.StructField("uploaded_by", T.StringType(), False),
        T.StructField("upload_timestamp", T.StringType(), False),
        T.StructField("clean_text", T.StringType()),
        T.StructField("word_count", T.IntegerType(), False),
        T.StructField("is_valid", T.BooleanType(), False),
        T.StructField("silver_updated_at", T.TimestampType(), False),
    ]
)

KEY = "file_name"


def refresh_text_columns(df: DataFrame) -> DataFrame:
    """Word count and validity, recomputed from ``clean_text``."""
    text = F.col("clean_text")
    return df.withColumns({"word_count": tx.word_count(text), "is_valid": F.coalesce(text != "", F.lit(False))})


def to_silver(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Clean text and its measures; one update time for the whole run."""
    now = F.current_timestamp() if now is None else now
    cleaned = tx.once(bronze, clean_text=tx.clean(F.col("raw_text"))).withColumn("silver_updated_at", now)
    return refresh_text_columns(cleaned).select(SILVER_SCHEMA.names)


def valid_rows(silver: DataFrame) -> DataFrame:
    return silver.filter("is_valid = true")


def retrievable_rows(silver: DataFrame) -> DataFrame:
    """Valid and with text; stricter than ``valid_rows``."""
    return silver.filter("is_valid AND clean_text <> ''")


def extraction_coverage(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count("raw_text").alias("with_text"), F.count("*").alias("documents"))


def rollup(
    df: DataFrame,
    group: str,
    measure: str,
    actor: str,
    updated_at: str,
    names: tuple[str, str, str, str, str],
) -> DataFrame:
    """Count, total, rounded mean, distinct actors and last update per group.

    Catalyst first reduces to (group, actor), so a group holding most of the
    rows is merged from partial results, not gathered.
    """
    count, total, mean, actors, last = names
    return df.groupBy(group).agg(
        F.count("*").alias(count),
        F.sum(measure).alias(total),
        F.round(F.avg(measure), 1).alias(mean),
        F.countDistinct(actor).alias(actors),
        F.max(updated_at).alias(last),
    )


def to_gold(silver: DataFrame) -> DataFrame:
    """Knowledge-base statistics per category, over valid rows."""
    return rollup(
        valid_rows(silver),
        "category",
        "word_count",
        "uploaded_by",
        "silver_updated_at",
        ("document_count", "total_word_count", "avg_word_count", "distinct_uploaders", "last_updated_at"),
    ).orderBy("category")


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Row count of each layer; parquet answers these from file footers."""
    counted = [
        df.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count")).select("layer", "row_count")
        for name, df in layers.items()
    ]
    out = counted[0]
    for df in counted[1:]:
        out = out.unionByName(df)
    return out
