"""The pipeline end to end: stream, gates, layers, revision, failure path."""

import json

import pytest
from pyspark.sql import functions as F

from quire.operators import layers, lineage
from quire.plans import lakehouse as lh
from quire.session import scratch_path
from quire.sources import topics
from quire.streaming import ingest
from tests.test_contract import BASE, ten_events
from tests.test_landing import DOCX

TEXTS = {
    "course_withdrawal_policy.txt": "Courses may be dropped until week eight.  After that a form is needed.",
    "graduation_requirements.txt": "Students need credit hours.\n\n\n\nThe total is one hundred.",
    "scholarships_financial_aid.txt": "Aid is granted twice a year. Apply early!",
}


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, text in TEXTS.items():
        (folder / name).write_text(text)
    (folder / "attendance_policy.pdf").write_bytes(b"%PDF attendance")
    (folder / "cs_program_requirements.docx").write_bytes(DOCX)
    (folder / "corrupted_upload.exe").write_bytes(b"junk")
    (folder / "empty_handbook.txt").write_bytes(b"")
    return str(folder)


def bad_events(spark, landed):
    """The three events no real file stands behind."""
    events = [dict(e, file_path=e["file_path"].replace("/in/", landed + "/")) for e in ten_events()[7:]]
    return spark.createDataFrame([(json.dumps(e),) for e in events], "value string")


LOADERS = {"pdf": lambda content: content.decode().replace("%PDF", "Text of")}


def test_pipeline(spark, landed):
    house = lh.Lakehouse(spark, scratch_path(spark, "house"), buckets=4)
    out = lh.run_pipeline(house, [landed], bad_events(spark, landed), LOADERS)
    ingestion = out["ingestion"]
    assert (ingestion["total"], ingestion["accepted"], ingestion["rejected"]) == (10, 5, 5)
    assert [r["n"] for r in ingestion["rejection_reasons"].collect()] == [1] * 5
    assert out["bronze"] == {"row_count": 5, "extracted_text_count": 5}
    assert (out["silver"]["rows_before"], out["silver"]["rows_after"]) == (0, 5)
    assert out["quality"]["success"] and out["quality"]["row_count"] == 5
    assert out["gold"] == {"silver_row_count": 5, "gold_row_count": 3}
    gold = {r["category"]: r for r in house.gold.read().collect()}
    assert gold["policy"]["document_count"] == 3 and gold["policy"]["distinct_uploaders"] == 1
    states = lineage.lineage_summary(house.lineage.read()).groupBy("state").count().collect()
    assert [tuple(r) for r in states] == [("COMPLETE", 7)]
    codes = {r["reason_code"] for r in ingest.rejected_events(spark, house.ingestion).collect()}
    assert codes == {"literal_error", "empty_upload", "suffix_mismatch", "missing", "file_missing"}

    # A revision replaces its row once; repeating it or reloading changes nothing.
    revisions = spark.createDataFrame(
        [("graduation_requirements.txt", "ADDENDUM 1", "\n\nADDENDUM 1: now ninety.", "new-id")],
        "file_name string, marker string, addendum string, document_id string",
    )
    for updated in (1, 0):
        merged = lh.apply_revisions(house, revisions)
        assert (merged["rows_updated"], merged["rows_inserted"], merged["rows_after"]) == (updated, 0, 5)
        row = house.silver.read().filter("file_name = 'graduation_requirements.txt'").first()
        assert row["document_id"] == "new-id"
        assert row["clean_text"] == "Students need credit hours.\n\nThe total is one hundred.\n\nADDENDUM 1: now ninety."
        assert row["word_count"] == len(row["clean_text"].split())
    assert lh.update_silver(house)["rows_after"] == 5
    assert house.silver.read().filter("document_id = 'new-id'").count() == 1

    # Two addenda of one file are both appended, in order, and each once.
    both = spark.createDataFrame(
        [("graduation_requirements.txt", f"ADDENDUM {n}", f"\n\nADDENDUM {n}: more.", f"id-{n}") for n in (3, 2, 3)],
        revisions.schema,
    )
    for updated in (1, 0):
        assert lh.apply_revisions(house, both)["rows_updated"] == updated
    row = house.silver.read().filter("file_name = 'graduation_requirements.txt'").first()
    assert row["clean_text"].endswith("ADDENDUM 1: now ninety.\n\nADDENDUM 2: more.\n\nADDENDUM 3: more.")
    assert row["document_id"] == "id-3"

    # A duplicate fails the gate, gold stays as it was, deleting it restores.
    copy = house.silver.read().filter("file_name = 'graduation_requirements.txt'").withColumn("document_id", F.lit("dup"))
    house.silver.append(copy)
    before = sorted(map(tuple, house.gold.read().collect()))
    with pytest.raises(lh.PipelineHalted, match=r"be_unique\(file_name\)"):
        with house.lineage.step("quality_checkpoint"):
            lh.require_quality(house.silver.read())
        lh.build_gold(house)
    assert sorted(map(tuple, house.gold.read().collect())) == before
    assert house.lineage.read().filter("event_type = 'FAIL'").count() == 1
    assert house.silver.delete_where(F.col("document_id") == "dup") == 1
    assert lh.require_quality(house.silver.read())["success"]


def test_ingestion_gate(spark):
    with pytest.raises(lh.PipelineHalted, match="0 accepted, 4 rejected"):
        lh.check_ingestion({"accepted": 0, "rejected": 4})
    lh.check_ingestion({"accepted": 1, "rejected": 4})


def test_missing_manifest(spark):
    with pytest.raises(FileNotFoundError):
        lh.load_bronze(lh.Lakehouse(spark, scratch_path(spark, "house")))


def events(spark, names):
    rows = [(json.dumps({k: v for k, v in dict(BASE, file_name=n).items() if k != "document_id"}),) for n in names]
    return spark.createDataFrame(rows, "value string")


def test_stream_goes_on_from_its_checkpoint(spark):
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "ingestion")
    run = lambda: ingest.run_ingestion(topics.stream_topic_files(spark, topic), root, check_files=False)
    this_run = lambda batches: ingest.run_summary(spark, root, batches)["total"]
    assert ingest.run_summary(spark, root)["total"] == 0
    topics.write_topic_files(events(spark, ["a.txt", "b.txt", "c.md"]), topic)
    assert this_run(run()) == 3
    first = sorted(map(tuple, ingest.accepted_events(spark, root).collect()))
    assert len(first) == 2 and ingest.run_summary(spark, root)["rejected"] == 1
    assert this_run(run()) == 0
    assert sorted(map(tuple, ingest.accepted_events(spark, root).collect())) == first
    topics.write_topic_files(events(spark, ["d.txt"]), topic)
    assert this_run(run()) == 1
    summary = ingest.run_summary(spark, root)
    assert (summary["total"], summary["accepted"], summary["rejected"]) == (4, 3, 1)
    # Generated ids are fixed when a batch is staged, not when it is read.
    staged = {r["event"]["document_id"] for r in spark.read.parquet(f"{root}/staged").filter("event IS NOT NULL").collect()}
    assert staged == {r["document_id"] for r in ingest.accepted_events(spark, root).collect()}


def test_dead_letters_keep_the_event(spark):
    rows = [('{"a": [1, {"b": null}]}', "why", "2024-01-02 03:04:05"), ("no json", "bad", "2024-01-02 03:04:05")]
    df = spark.createDataFrame(rows, "original_event string, rejection_reason string, rejected_at string")
    letters = topics.dead_letters(df.withColumn("rejected_at", F.col("rejected_at").cast("timestamp")))
    got = sorted((json.loads(r["value"]) for r in letters.collect()), key=str)
    assert got == [
        {"original_event": "no json", "rejection_reason": "bad", "rejected_at": "2024-01-02T03:04:05.000000+00:00"},
        {"original_event": {"a": [1, {"b": None}]}, "rejection_reason": "why", "rejected_at": "2024-01-02T03:04:05.000000+00:00"},
    ]


def test_a_repeated_batch_replaces_its_own_output(spark):
    root, sent = scratch_path(spark, "ingestion"), []
    batch = events(spark, ["a.txt", "b.md"])
    for _ in range(2):
        ingest.ingest_batch(batch, 7, root, check_files=False, emit=lambda good, bad, i: sent.append((good.count(), bad.count(), i)))
    assert ingest.run_summary(spark, root)["total"] == 2
    assert ingest.accepted_events(spark, root).count() == ingest.rejected_events(spark, root).count() == 1
    assert sent == [(1, 1, 7)] * 2
    bad = ingest.rejected_events(spark, root).first()
    assert json.loads(bad["original_event"])["file_name"] == "b.md" and bad["rejected_at"] is not None


def test_batch_without_accepted_or_rejected_events(spark):
    root = scratch_path(spark, "ingestion")
    ingest.ingest_batch(events(spark, ["a.md"]), 0, root, check_files=False)
    ingest.ingest_batch(events(spark, ["a.txt"]), 1, root, check_files=False)
    summary = ingest.run_summary(spark, root)
    assert (summary["accepted"], summary["rejected"]) == (1, 1)
    assert layers.layer_counts(bronze=events(spark, ["a"]), gold=events(spark, [])).count() == 2
