"""Context, citations, prompts and answers, one row per query."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quire import fixed_values as fixed
from quire.functions import text as tx


def build_context(ranked: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per query: the numbered context block, its sources and the chunks used.

    Input rows are the few ranked chunks of each query (``rank``, ``file_name``,
    ``text``, ``chunk_id``), so a group is no larger than the rerank depth.
    """
    chunk = F.struct("rank", "chunk_id", "file_name", "text", *carried)
    grouped = ranked.groupBy("query_id").agg(F.array_sort(F.collect_list(chunk)).alias("context_used"))
    return grouped.select(
        "query_id",
        context_block(F.col("context_used")).alias("context"),
        citations(F.col("context_used")).alias("citations"),
        "context_used",
    )


def context_block(chunks: Column) -> Column:
    """Chunk texts under numbered source headers, an empty line between."""
    parts = F.transform(
        chunks,
        lambda c, i: F.format_string(fixed.SOURCE_HEADER, i + 1, c["file_name"], c["text"]),
    )
    return F.array_join(parts, "\n\n")


def citations(chunks: Column) -> Column:
    """Distinct file names in the order they first appear."""
    return F.array_distinct(F.transform(chunks, lambda c: c["file_name"]))


def build_messages(query: Column, context: Column) -> Column:
    """System and user message of a grounded prompt."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(
        message("system", F.lit(fixed.SYSTEM_PROMPT)),
        message("user", F.format_string(fixed.USER_PROMPT, context, query)),
    )


def is_refusal(answer: Column) -> Column:
    return tx.contains_ignoring_case(answer, fixed.REFUSAL_TEXT)


def extractive_answer(query: Column, context_used: Column) -> Column:
    """The sentence of the first source that holds most query words.

    The earliest of equally good sentences; the refusal if none shares a word.
    """
    asked = F.array_distinct(tx.tokens(query))
    scored = F.transform(
        tx.sentences(F.get(context_used, F.lit(0))["text"]),
        lambda s, i: F.struct(
            F.size(F.array_intersect(asked, tx.tokens(s))).alias("met"), (-i).alias("earlier"), s.alias("sentence")
        ),
    )
    best = F.array_max(scored)
    return F.when(best["met"] > 0, F.concat(best["sentence"], F.lit(" [Source 1]"))).otherwise(fixed.REFUSAL_TEXT)


Generator = Callable[[], Callable[[pd.Series], list[str]]]


def generate_answers(
    queries: DataFrame,
    contexts: DataFrame,
    generator: Generator | None = None,
) -> DataFrame:
    """``query_id, query, answer, citations, context_used`` for every query.

    ``generator`` is a factory, called once per task, of message lists ->
    answers.  It only sees queries that have a context; the others are refused
    without a call.  An answer that contains the refusal cites nothing.
    """
    asked = queries.select("query_id", F.col("text").alias("query"))
    joined = asked.join(contexts, "query_id", "left")
    refusal = F.lit(fixed.REFUSAL_TEXT)
    if generator is None:
        answered = joined.withColumn(
            "answer",
            F.when(F.col("context_used").isNull(), refusal).otherwise(
                extractive_answer(F.col("query"), F.col("context_used"))
            ),
        )
    else:
        prompted = joined.filter("context_used IS NOT NULL").withColumn(
            "messages", build_messages(F.col("query"), F.col("context"))
        )
        out_schema = T.StructType([*prompted.drop("messages").schema.fields, T.StructField("answer", T.StringType())])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            generate = None
            for batch in batches:
                generate = generate or generator()
                answers = [a.strip() for a in generate(batch["messages"])]
                yield batch.drop(columns="messages").assign(answer=answers)

        unanswered = joined.filter("context_used IS NULL").withColumn("answer", refusal)
        answered = prompted.mapInPandas(run, out_schema).unionByName(unanswered)
    grounded = F.col("context_used").isNotNull() & ~is_refusal(F.col("answer"))
    nothing = F.array().cast("array<string>")
    return answered.select(
        "query_id",
        "query",
        "answer",
        F.when(grounded, F.col("citations")).otherwise(nothing).alias("citations"),
        "context_used",
    )
