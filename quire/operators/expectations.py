"""Quality expectations over a table, one result row per expectation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    params: dict = field(default_factory=dict)

    def unexpected(self) -> Column:
        """True for a row that breaks the expectation; NULLs are passed over."""
        col = F.col(self.column)
        if self.kind == "expect_column_values_to_not_be_null":
            return col.isNull()
        if self.kind == "expect_column_values_to_match_regex":
            return ~col.rlike(self.params["regex"])
        if self.kind == "expect_column_values_to_be_between":
            low, high = self.params.get("min_value"), self.params.get("max_value")
            broken = F.lit(False)
            if low is not None:
                broken = broken | (col < low)
            if high is not None:
                broken = broken | (col > high)
            return broken
        if self.kind == "expect_column_values_to_be_in_set":
            return ~col.isin(*self.params["value_set"])
        raise ValueError(f"unknown expectation {self.kind}")


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", column)


def matches(column: str, regex: str) -> Expectation:
    return Expectation("expect_column_values_to_match_regex", column, {"regex": regex})


def between(column: str, min_value=None, max_value=None) -> Expectation:
    return Expectation("expect_column_values_to_be_between", column, {"min_value": min_value, "max_value": max_value})


def unique(column: str) -> Expectation:
    return Expectation(UNIQUE, column)


def in_set(column: str, value_set) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", column, {"value_set": list(value_set)})


UNIQUE = "expect_column_values_to_be_unique"

SILVER_SUITE = [
    not_null("document_id"),
    not_null("file_name"),
    matches("file_type", r"^(pdf|docx|txt)$"),
    between("word_count", min_value=1),
    unique("file_name"),
    in_set("is_valid", [True]),
]


def check_expectations(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """``expectation, column, success, unexpected_count, row_count`` per entry.

    All row-wise expectations share one aggregate over the columns they name;
    each uniqueness check counts its own column by key, combined map-side.
    Every row of a duplicated value counts as unexpected.
    """
    parts = []
    row_wise = [e for e in suite if e.kind != UNIQUE]
    if row_wise:
        one = df.agg(
            F.count("*").alias("row_count"),
            *[F.count_if(e.unexpected()).alias(f"n{i}") for i, e in enumerate(row_wise)],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(e.kind).alias("expectation"),
                    F.lit(e.column).alias("column"),
                    F.col(f"n{i}").alias("unexpected_count"),
                )
                for i, e in enumerate(row_wise)
            ]
        )
        parts.append(one.select("row_count", F.inline(entries)))
    for e in (e for e in suite if e.kind == UNIQUE):
        per_value = df.groupBy(e.column).agg(F.count("*").alias("n"))
        duplicated = F.col(e.column).isNotNull() & (F.col("n") > 1)
        parts.append(
            per_value.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(duplicated, F.col("n"))), F.lit(0)).alias("unexpected_count"),
            ).select(
                "row_count",
                F.lit(e.kind).alias("expectation"),
                F.lit(e.column).alias("column"),
                "unexpected_count",
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "expectation", "column", (F.col("unexpected_count") == 0).alias("success"), "unexpected_count", "row_count"
    )


def suite_verdict(results: DataFrame) -> DataFrame:
    """One row: did every expectation hold, over how many rows."""
    return results.agg(
        F.bool_and("success").alias("success"),
        F.max("row_count").alias("row_count"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
    )
