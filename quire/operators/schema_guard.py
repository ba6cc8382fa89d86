"""Schema enforcement: what a write must satisfy before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


class SchemaViolation(Exception):
    """The frame does not have the declared columns and types."""


def column_problems(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Undeclared, missing and differently typed columns."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in declared}
    return (
        [f"undeclared column {n} {t.simpleString()}" for n, t in have.items() if n not in want]
        + [f"missing column {n} {t.simpleString()}" for n, t in want.items() if n not in have]
        + [
            f"column {n} is {have[n].simpleString()}, declared {want[n].simpleString()}"
            for n in want
            if n in have and have[n] != want[n]
        ]
    )


def enforce_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``df`` in declared column order, or an error.

    Columns and types are compared at once.  NULLs in a non-null column fail
    the job that writes the result, before it commits: no extra pass.
    """
    problems = column_problems(df.schema, declared)
    if problems:
        raise SchemaViolation("; ".join(problems))
    guarded = []
    for f in declared:
        col = F.col(f.name)
        if not f.nullable and df.schema[f.name].nullable:
            stop = F.raise_error(F.lit(f"NULL in not-null column {f.name}")).cast(f.dataType)
            col = F.when(col.isNull(), stop).otherwise(col)
        guarded.append(col.alias(f.name))
    return df.select(*guarded)


def null_violations(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Number of NULLs per non-null column: ``column, null_count``."""
    names = [f.name for f in declared if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    entries = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("null_count")) for n in names])
    return counts.select(F.inline(entries))
