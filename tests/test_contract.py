import json

import pytest
from pyspark.sql import functions as F

from quire import fixed_values as fixed
from quire.operators import contract as ct

ID = "12345678-1234-5678-1234-567812345678"
BASE = {
    "document_id": ID,
    "file_name": "a.txt",
    "file_path": "/in/a.txt",
    "file_type": "txt",
    "file_size_bytes": 10,
    "category": "policy",
    "uploaded_by": "me",
    "upload_timestamp": "2026-07-22T10:11:12Z",
}


def run(spark, events, inventory=None):
    values = [e if isinstance(e, str) else json.dumps(e) for e in events]
    df = spark.createDataFrame(list(enumerate(values)), "i int, value string")
    inv = None if inventory is None else spark.createDataFrame([(p,) for p in inventory], "path string")
    now = F.lit("2026-01-02 03:04:05").cast("timestamp")
    return ct.validate(df, ct.DOCUMENT_CONTRACT, inv, now=now, check_files=inventory is not None)


def outcomes(spark, events, inventory=None):
    out = run(spark, events, inventory).orderBy("i").collect()
    return [(r["reason_code"], r["reason"], r["event"]) for r in out]


def test_files_are_looked_up_unless_told_otherwise(spark):
    with pytest.raises(ValueError):
        ct.validate(spark.createDataFrame([("{}",)], "value string"), ct.DOCUMENT_CONTRACT)


def test_paths_are_compared_normalized(spark):
    paths = ["/in//a.txt", "/in/./a.txt", "s3://b//in/a.txt", "/in/a", "/in/b.txt/"]
    found = [code for code, _, _ in outcomes(spark, [dict(BASE, file_path=p) for p in paths], ["/in/a.txt", "s3://b/in/a.txt", "/in/b.txt"])]
    assert found == [None, None, "file_missing", "file_missing", None]


def ten_events():
    def event(name, kind, size, category, path=None, by="bot"):
        return dict(BASE, file_name=name, file_type=kind, file_size_bytes=size, category=category,
                    file_path=path or f"/in/{name}", uploaded_by=by)

    events = [
        event("attendance_policy.pdf", "pdf", 2354, "policy"),
        event("corrupted_upload.exe", "exe", 36, "general"),
        event("course_withdrawal_policy.txt", "txt", 1502, "policy"),
        event("cs_program_requirements.docx", "docx", 37357, "course_catalog"),
        event("empty_handbook.txt", "txt", 0, "general"),
        event("graduation_requirements.txt", "txt", 1956, "policy"),
        event("scholarships_financial_aid.txt", "txt", 1864, "scholarship"),
        event("mislabeled_policy.txt", "pdf", 1234, "policy", "/in/graduation_requirements.txt"),
        event("anonymous_upload.txt", "txt", 500, "general", "/in/scholarships_financial_aid.txt"),
        event("ghost_document.txt", "txt", 42, "general", "/in/does_not_exist_on_disk.txt"),
    ]
    del events[8]["uploaded_by"]
    return events


def test_ten_events(spark):
    events = ten_events()
    inventory = ["/in/" + e["file_name"] for e in events[:7]]
    got = [reason for _, reason, _ in outcomes(spark, events, inventory)]
    assert got == [
        None,
        "Input should be 'pdf', 'docx' or 'txt'",
        None,
        None,
        "Value error, file_size_bytes must be > 0 (got 0 — empty upload)",
        None,
        None,
        "Value error, declared file_type 'pdf' does not match the actual extension '.txt' (expected 'txt')",
        "Field required",
        "Value error, file_path '/in/does_not_exist_on_disk.txt' does not exist on disk",
    ]
    validated = run(spark, events, inventory)
    assert tuple(ct.ingestion_counts(validated).first()) == (10, 5, 5)
    assert [tuple(r) for r in ct.rejection_breakdown(validated).collect()] == [
        ("Field required", 1),
        ("Input should be 'pdf', 'docx' or 'txt'", 1),
        ("Value error, declared file_type 'pdf' does not match the actual extension '.txt'", 1),
        ("Value error, file_path '/in/does_not_exist_on_disk.txt' does not exist on disk", 1),
        ("Value error, file_size_bytes must be > 0", 1),
    ]
    good, bad = ct.route(validated)
    assert good.count() == 5 and bad.count() == 5
    assert good.columns == ct.DOCUMENT_CONTRACT.names


@pytest.mark.parametrize(
    "field,cases",
    [
        (
            "file_size_bytes",
            [
                (" 12 ", 12), ("+12", 12), ("1_000", 1000), ("12.0", 12), ("12.00", 12), ("00012", 12),
                (" 12　", 12), (12.0, 12), (1e3, 1000), (True, 1), ("1_000.0", 1000),
                (fixed.MAX_FILE_SIZE_BYTES, fixed.MAX_FILE_SIZE_BYTES),
                ("12.", fixed.MSG_INT_TEXT), ("12.5", fixed.MSG_INT_TEXT), ("", fixed.MSG_INT_TEXT),
                ("1__0", fixed.MSG_INT_TEXT), ("0x10", fixed.MSG_INT_TEXT), ("１２", fixed.MSG_INT_TEXT),
                ("+-3", fixed.MSG_INT_TEXT), ("12 .0", fixed.MSG_INT_TEXT), ("1e3", fixed.MSG_INT_TEXT),
                (12.5, fixed.MSG_INT_FRACTION), (1e40, fixed.MSG_INT_SIZE), (9.3e18, fixed.MSG_INT_SIZE),
                (None, fixed.MSG_INT), ([1], fixed.MSG_INT), ({"a": 1}, fixed.MSG_INT),
                (False, "Value error, file_size_bytes must be > 0 (got 0 — empty upload)"),
                ("-0", "Value error, file_size_bytes must be > 0 (got 0 — empty upload)"),
                (-5, "Value error, file_size_bytes must be > 0 (got -5 — empty upload)"),
                (-(2**70), f"Value error, file_size_bytes must be > 0 (got {-(2**70)} — empty upload)"),
                (52428801, "Value error, file_size_bytes 52428801 exceeds max allowed 52428800 (50 MB) — reject oversized upload"),
                (2**70, f"Value error, file_size_bytes {2**70} exceeds max allowed 52428800 (50 MB) — reject oversized upload"),
                ("9" * 50, f"Value error, file_size_bytes {'9' * 50} exceeds max allowed 52428800 (50 MB) — reject oversized upload"),
            ],
        ),
        (
            "upload_timestamp",
            [
                ("2026-07-22", "2026-07-22T00:00:00"), ("2026-07-22 10:11", "2026-07-22T10:11:00"),
                ("2026-07-22T10:11:12.5+03:00", "2026-07-22T10:11:12.500000+03:00"),
                ("2026-07-22T10:11:12.123456789Z", "2026-07-22T10:11:12.123456Z"),
                ("2026-07-22t10:11:12z", "2026-07-22T10:11:12Z"), ("1700000000", "2023-11-14T22:13:20Z"),
                ("1700000000.5", "2023-11-14T22:13:20.500000Z"), (1700000000000, "2023-11-14T22:13:20Z"),
                (1700000000.25, "2023-11-14T22:13:20.250000Z"), ("20260722", "1970-08-23T11:58:42Z"),
                ("2026-07-22T10:11:12.000000+00:00", "2026-07-22T10:11:12Z"),
                ("2026-07-22T00:00:00.000001-00:00", "2026-07-22T00:00:00.000001Z"),
                ("2026-02-30T10:11:12Z", fixed.MSG_DATETIME_DAY), ("0000-01-01T10:11:12Z", fixed.MSG_DATETIME_YEAR),
                ("2026-07-22T10:11:12+0300", "2026-07-22T10:11:12+03:00"), (-5, "1969-12-31T23:59:55Z"),
                ("2026-07-22T10:11:12-00:00", "2026-07-22T10:11:12Z"), ("2026-07-22T10:11:12,5Z", "2026-07-22T10:11:12.500000Z"),
                (2e10, "2603-10-11T11:33:20Z"), (20000000001, "1970-08-20T11:33:20.001000Z"),
                ("2026-07-22T10:11:12.000Z", "2026-07-22T10:11:12Z"), ("2026-07-22_10:11:12", "2026-07-22T10:11:12"),
                (True, fixed.MSG_DATETIME_TYPE), (None, fixed.MSG_DATETIME_TYPE), ([1], fixed.MSG_DATETIME_TYPE),
                ("", fixed.MSG_DATETIME_SHORT), ("2026-7-22", fixed.MSG_DATETIME_SHORT),
                ("2026-13-01T00:00:00Z", fixed.MSG_DATETIME_MONTH), ("2026-02-30", fixed.MSG_DATETIME_DAY),
                ("2026-07-22T25:00:00", fixed.MSG_DATETIME_EXTRA), ("2026-07-22T10:11:12+03", fixed.MSG_DATETIME_EXTRA),
                ("2026-07-22Z", fixed.MSG_DATETIME_EXTRA), ("2026-07-22T10", fixed.MSG_DATETIME_EXTRA),
                ("0000-01-01", fixed.MSG_DATETIME_YEAR), (1e20, fixed.MSG_DATETIME_RANGE),
            ],
        ),
        (
            "document_id",
            [
                (ID.replace("-", ""), ID), ("{%s}" % ID, ID), ("urn:uuid:" + ID, ID),
                ("ABCDEFab-1234-5678-1234-567812345678", "abcdefab-1234-5678-1234-567812345678"),
                (None, fixed.MSG_UUID_TYPE), (5, fixed.MSG_UUID_TYPE),
                ("x", "Input should be a valid UUID, invalid character: found `x` at 0"),
                ("1234567g-1234-5678-1234-567812345678", "Input should be a valid UUID, invalid character: found `g` at 7"),
                ("", "Input should be a valid UUID, invalid length: found 0"),
                ("1234567812345678123456781234567", "Input should be a valid UUID, invalid length: found 31"),
                ("12345678-1234-5678-1234567812345678", "Input should be a valid UUID, invalid group count: expected 5, found 4"),
                ("{%s}" % ID.replace("-", ""), "Input should be a valid UUID, invalid group count: expected 5, found 1"),
                ("123456781-234-5678-1234-567812345678", "Input should be a valid UUID, invalid group length in group 0: expected 8, found 9"),
            ],
        ),
        (
            "file_name",
            [
                ("  a.txt\t", "a.txt"), ("b.TXT", "b.TXT"), (None, fixed.MSG_STRING), (5, fixed.MSG_STRING),
                (" 　", "Value error, file_name is required — cannot be blank"),
                ("../x.txt", "Value error, file_name '../x.txt' must be a bare filename, not a path"),
                ("a/b.txt", "Value error, file_name 'a/b.txt' must be a bare filename, not a path"),
                ("a\\b.txt", "Value error, file_name 'a\\b.txt' must be a bare filename, not a path"),
                ("report.md", "Value error, file_name 'report.md' has unsupported extension '.md' — only ['.docx', '.pdf', '.txt'] are accepted"),
                (".txt", "Value error, file_name '.txt' has unsupported extension '' — only ['.docx', '.pdf', '.txt'] are accepted"),
            ],
        ),
        ("course_code", [(None, None), ("", ""), (5, fixed.MSG_STRING)]),
        (
            "category",
            [("handbook", "handbook"), (None, "Input should be 'policy', 'course_catalog', 'handbook', 'scholarship' or 'general'")],
        ),
        ("file_type", [("PDF", "Input should be 'pdf', 'docx' or 'txt'"), (3, "Input should be 'pdf', 'docx' or 'txt'")]),
    ],
)
def test_field_coercion(spark, field, cases):
    events = [dict(BASE, **{field: given}) for given, _ in cases]
    got = [
        reason if code else event[field] for code, reason, event in outcomes(spark, events)
    ]
    assert got == [expected for _, expected in cases]


def test_first_failure_wins(spark):
    events = [
        dict(BASE, file_name=" ", file_size_bytes=0),
        dict(BASE, file_size_bytes=0, extra=1),
        dict(BASE, extra=1, file_name="x.md"),
        "nope",
        "[1, 2]",
        "",
        '{"file_name": "x.md", ' + json.dumps(BASE)[1:],
    ]
    assert [code for code, _, _ in outcomes(spark, events)] == [
        "blank", "empty_upload", "extra_forbidden", "malformed_json", "not_an_object", "malformed_json", None,
    ]


def test_defaults_and_normalized_output(spark):
    event = {k: v for k, v in BASE.items() if k not in ("document_id", "category", "upload_timestamp")}
    event["uploaded_by"] = "  me "
    (code, _, out), = outcomes(spark, [event])
    assert code is None
    assert len(out["document_id"]) == 36
    assert (out["category"], out["course_code"], out["uploaded_by"]) == ("general", None, "me")
    assert out["upload_timestamp"] == "2026-01-02T03:04:05.000000Z"


def test_inventory_join_keeps_every_event(spark):
    events = [BASE] * 50 + [dict(BASE, file_path="/in/none.txt")] * 50 + ["nope"] * 50
    validated = run(spark, events, ["/in/a.txt", "/in/a.txt"])
    assert tuple(ct.ingestion_counts(validated).first()) == (150, 50, 100)
