"""Overlapping sentence-group chunks of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire import fixed_values as fixed
from quire.functions import text as tx


def chunk_documents(
    documents: DataFrame,
    sentences_per_chunk: int = fixed.SENTENCES_PER_CHUNK,
    overlap_sentences: int = fixed.OVERLAP_SENTENCES,
    key: str = "file_name",
    text_col: str = "clean_text",
    carried: tuple[str, ...] = ("file_name", "category", "document_id"),
) -> DataFrame:
    """``chunk_id``, ``text`` and the carried columns; no shuffle.

    Chunks start every ``stride`` sentences and stop with the one that reaches
    the end.  The id holds the number of the first sentence.
    """
    stride = max(1, sentences_per_chunk - overlap_sentences)
    keyed = documents.select(*carried, F.col(key).alias("_key"), F.col(text_col).alias("_text"))
    split = tx.once(keyed, _sentences=tx.sentences(F.col("_text")))
    n = F.size("_sentences")
    beyond = F.greatest(n - sentences_per_chunk, F.lit(0))
    last = (F.ceil(beyond / stride) * stride).cast("int")
    # Build a document's chunks before exploding, so that the rows do not each
    # carry all of its sentences.
    groups = F.transform(
        F.when(n > 0, F.sequence(F.lit(0), last, F.lit(stride))),
        lambda start: F.struct(
            start.alias("start"),
            F.array_join(F.slice("_sentences", start + 1, F.lit(sentences_per_chunk)), " ").alias("text"),
        ),
    )
    exploded = split.select(*carried, "_key", F.explode(groups).alias("_group"))
    return exploded.select(
        F.format_string("%s_chunk_%03d", F.col("_key"), F.col("_group.start")).alias("chunk_id"),
        F.col("_group.text").alias("text"),
        *carried,
    )
