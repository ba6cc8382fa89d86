"""Run registered queries against their SQL: python tests/compare.py [folder] [name ...]"""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def sql_tables(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float):
            return repr(v)
        return f"{type(v).__name__}:{v}"

    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def differences(spark, con, folder, name):
    """None when equal, else a short description."""
    df = entry.queries()[name](spark, folder)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    columns, expected = canonical([d[0] for d in result.description], result.fetchall())
    if got_columns != columns:
        return f"columns {got_columns} / {columns}"
    if got != expected:
        only_got = sorted(set(got) - set(expected))[:3]
        only_sql = sorted(set(expected) - set(got))[:3]
        return f"rows {len(got)} / {len(expected)}; only here {only_got}; only SQL {only_sql}"
    return None


if __name__ == "__main__":
    from quire.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "compare",
        **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = sql_tables(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problem = differences(spark, con, folder, name)
            else:
                problem = None if entry.queries()[name](spark, folder).count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
