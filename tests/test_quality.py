from pyspark.sql import functions as F

from quire.operators import expectations as ex, layers
from quire.operators.lineage import LineageLog, lineage_summary
from quire.session import scratch_path

import pytest


def silver(spark, rows):
    data = [(n, f"id-{n}", t, "policy", None, "me", "2024-01-01T00:00:00Z", "x", w, v, None) for n, t, w, v in rows]
    return spark.createDataFrame(data, layers.T.StructType([layers.T.StructField(f.name, f.dataType) for f in layers.SILVER_SCHEMA]))


def outcome(df):
    return {(r["expectation"].replace("expect_column_values_to_", ""), r["column"]): (r["success"], r["unexpected_count"])
            for r in ex.check_expectations(df, ex.SILVER_SUITE).collect()}


def test_only_uniqueness_fails_for_a_duplicate(spark):
    df = silver(spark, [("a.txt", "txt", 3, True), ("b.pdf", "pdf", 1, True), ("a.txt", "txt", 2, True)])
    got = outcome(df)
    assert got.pop(("be_unique", "file_name")) == (False, 2)
    assert all(success for success, _ in got.values()) and len(got) == 5
    assert tuple(ex.suite_verdict(ex.check_expectations(df, ex.SILVER_SUITE)).first()) == (False, 3, 1)


def test_each_expectation_can_fail(spark):
    got = outcome(silver(spark, [(None, "exe", 0, False), ("b", None, None, None)]).withColumn("document_id", F.lit(None).cast("string")))
    assert got == {
        ("not_be_null", "document_id"): (False, 2),
        ("not_be_null", "file_name"): (False, 1),
        ("match_regex", "file_type"): (False, 1),
        ("be_between", "word_count"): (False, 1),
        ("be_unique", "file_name"): (True, 0),
        ("be_in_set", "is_valid"): (False, 1),
    }


def test_empty_table_passes(spark):
    results = ex.check_expectations(silver(spark, []), ex.SILVER_SUITE).collect()
    assert len(results) == 6 and all(r["success"] and r["row_count"] == 0 for r in results)


def test_lineage_of_steps(spark):
    log = LineageLog(spark, scratch_path(spark, "lineage"))
    with log.step("good"):
        pass
    with pytest.raises(ValueError):
        with log.step("bad"):
            raise ValueError("no")
    log.emit("START", "r3", "open")
    events = log.read()
    assert sorted((r["job"], r["event_type"]) for r in events.collect()) == [
        ("bad", "FAIL"), ("bad", "START"), ("good", "COMPLETE"), ("good", "START"), ("open", "START"),
    ]
    summary = {r["job"]: r for r in lineage_summary(events).collect()}
    assert {job: r["state"] for job, r in summary.items()} == {"good": "COMPLETE", "bad": "FAIL", "open": "RUNNING"}
    assert summary["good"]["duration_seconds"] >= 0 and summary["open"]["duration_seconds"] is None
