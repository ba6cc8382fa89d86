import io
import os
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.session import scratch_path
from quire.sources import landing, topics

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def par(*runs):
    return "<w:p>" + "".join(f"<w:r><w:t>{t}</w:t></w:r>" for t in runs) + "</w:p>"


def table(*rows):
    cell = lambda c: f"<w:tc>{c}</w:tc>"
    return "<w:tbl>" + "".join("<w:tr>" + "".join(cell(c) for c in row) + "</w:tr>" for row in rows) + "</w:tbl>"


DOCX = docx(par("Head", "ing") + table([par("a"), par("b")], [par("c"), par("d1") + par("d2")]) + par(" ") + par("Last<w:tab/>".replace("<w:tab/>", "")))


@pytest.fixture
def folder(tmp_path):
    files = {
        "plain.txt": "Über\r\nline".encode(),
        "broken.txt": b"ok \xff\xfe end",
        "empty_handbook.txt": b"",
        "_hidden.txt": b"seen",
        "cs_program.docx": DOCX,
        "bad.docx": b"not a zip",
        "paper.pdf": b"%PDF",
        "tool.EXE": b"x",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deeper.txt").write_text("not listed")
    return str(tmp_path)


def test_inventory_lists_every_file_of_one_level(spark, folder):
    got = {r["file_name"]: r["file_size_bytes"] for r in landing.list_files(spark, [folder]).collect()}
    assert got == {n: os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n != "sub"}
    assert landing.list_files(spark, [folder, f"{folder}/sub"]).count() == 9
    for uri in (f"file://{folder}", f"file:{folder}/"):
        listed = landing.list_files(spark, [uri]).filter("file_name = 'plain.txt'").first()
        assert landing._read_file(listed["path"]).startswith("Über".encode())
        assert listed["path"] == uri.rstrip("/") + "/plain.txt"


def test_upload_events(spark, folder):
    events = {r["file_name"]: r for r in landing.upload_events(landing.list_files(spark, [folder])).collect()}
    assert events["tool.EXE"]["file_type"] == "exe"
    assert (events["cs_program.docx"]["category"], events["cs_program.docx"]["uploaded_by"]) == (
        "course_catalog", "cs_department_admin",
    )
    assert events["plain.txt"]["uploaded_by"] == "campus_portal_uploader"
    assert len({e["document_id"] for e in events.values()}) == len(events)


def test_extraction_keeps_rows_of_unreadable_files(spark, folder):
    events = landing.upload_events(landing.list_files(spark, [folder]))
    got = {r["file_name"]: r["raw_text"] for r in landing.read_and_extract(events).collect()}
    assert got == {
        "plain.txt": "Über\nline",
        "broken.txt": "ok �� end",
        "empty_handbook.txt": "",
        "_hidden.txt": "seen",
        "cs_program.docx": "Heading\nLast\na | b\nc | d1\nd2",
        "bad.docx": None,
        "paper.pdf": None,
        "tool.EXE": None,
    }
    plugged = landing.read_and_extract(events, {"pdf": lambda content: f"pdf of {len(content)}"})
    assert plugged.filter("file_name = 'paper.pdf'").first()["raw_text"] == "pdf of 4"


def test_extraction_says_why(spark, folder):
    events = landing.upload_events(landing.list_files(spark, [folder]))
    out = landing.read_and_extract(events, files_per_task=3, error_col="why")
    why = {r["file_name"]: r["why"] for r in out.collect()}
    assert why["plain.txt"] is None and why["paper.pdf"] == "no loader for pdf" and why["bad.docx"].startswith("BadZipFile")
    assert out.rdd.getNumPartitions() == 3


def test_merged_cells_repeat():
    cell = lambda text, props="": f"<w:tc><w:tcPr>{props}</w:tcPr>{par(text)}</w:tc>"
    rows = [
        cell("wide", '<w:gridSpan w:val="2"/>') + cell("x"),
        cell("tall", '<w:vMerge w:val="restart"/>') + cell("1") + cell("2"),
        cell("", "<w:vMerge/>") + cell("3") + cell("4"),
    ]
    body = "<w:tbl>" + "".join(f"<w:tr>{r}</w:tr>" for r in rows) + "</w:tbl>"
    assert landing.text_of_docx(docx(body)) == "wide | wide | x\ntall | 1 | 2\ntall | 3 | 4"


def test_large_batches_are_cut(spark, monkeypatch):
    monkeypatch.setattr(landing, "BATCH_CHARS", 25)
    df = spark.range(100).coalesce(1).select("id", F.lit("txt").alias("file_type"), F.lit(b"0123456789").alias("content"))
    out = landing.extract_text(df)
    assert out.columns == ["id", "file_type", "raw_text"]
    assert sorted(r["id"] for r in out.filter("raw_text = '0123456789'").collect()) == list(range(100))


def test_manifest(spark):
    path = scratch_path(spark, "manifest")
    with pytest.raises(FileNotFoundError):
        topics.read_manifest(spark, path)
    spark.createDataFrame([('{"document_id":"1","file_size_bytes":5}',), ("",), ("  ",)], "value string").write.text(path)
    assert [(r["document_id"], r["file_size_bytes"], r["category"]) for r in topics.read_manifest(spark, path).collect()] == [("1", 5, None)]


def test_kafka_options_reach_the_reader(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.stream_topic_kafka(spark, "nowhere:9092", "raw").isStreaming


def test_a_worker_takes_wide_rows_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    wide = spark.range(0, 2_000, 1, 1).select(F.repeat(F.lit("x"), F.lit(20_000)).alias("text"))
    found = [r[0] for r in wide.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 40_000_000 and max(found) <= 9_000_000
