import random
import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators.chunking import chunk_documents

SPACES = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def apply(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def python_clean(raw):
    if not raw:
        return ""
    text = unicodedata.normalize("NFKC", raw)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


def test_whitespace_is_pythons():
    assert sorted(tx.WHITESPACE) == SPACES


def test_splitting_and_stripping_agree_with_python(spark):
    texts = ["", " ", "a", "a b", "\x1c a\x1fb 　", "x y z", "​q​", "a\u0085b\xa0c"]
    texts += [f"{s}l{s}r{s}" for s in SPACES]
    assert apply(spark, tx.words, texts) == [t.split() for t in texts]
    assert apply(spark, tx.word_count, texts) == [len(t.split()) for t in texts]
    assert apply(spark, tx.strip, texts) == [t.strip() for t in texts]
    assert apply(spark, tx.tokens, ["Ab CD\tÉÈ", "İ ΑΣ"]) == [["ab", "cd", "éè"], ["İ".lower(), "ας"]]


def test_clean_agrees_with_python(spark):
    texts = [
        None, "", "   ", "\n\t \n", "a  b\t\tc", "\n\n\n\na\n\n\n\nb\n\n", "ﬁne Ｆｕｌｌ ｗｉｄｔｈ", "no\xa0break",
        "é combining", "½ x² ª", "a \n \n \n b", "tab\tonly", "a\r\n\r\n\r\nb", "ẛ̣", "한글 가",
    ]
    assert apply(spark, tx.clean, texts) == [python_clean(t) for t in texts]
    assert apply(spark, tx.word_count, [None]) == [0]


def test_every_character_reaches_its_nfkc_form(spark):
    """No character that NFKC changes is kept from the normalizer."""
    chars = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    assert apply(spark, tx.nfkc, ["x" + c for c in chars]) == [unicodedata.normalize("NFKC", "x" + c) for c in chars]


def test_file_names(spark):
    names = ["a.TXT", ".txt", "a.tar.gz", "a.", "plain", "a b.Pdf", ".a.b"]
    assert apply(spark, tx.file_suffix, names) == [".txt", "", ".gz", "", "", ".pdf", ".b"]
    assert apply(spark, tx.file_stem, names) == ["a", ".txt", "a.tar", "a.", "plain", "a b", ".a"]
    assert apply(spark, tx.infer_category, ["Graduation_withdrawal.txt", "CS_Program.docx", "x.graduation", "x"]) == [
        "policy", "course_catalog", "general", "general",
    ]
    assert apply(spark, tx.uploader_for, ["policy", "handbook", None]) == [
        "registrar_office_bot", "campus_portal_uploader", "campus_portal_uploader",
    ]


def test_reason_key_and_record_name(spark):
    assert apply(spark, tx.reason_key, ["a (b) — c", "a — b (c)", "plain"]) == ["a", "a", "plain"]
    df = spark.createDataFrame([("1", "my file.v1.txt"), (None, None)], "i string, n string")
    assert [r[0] for r in df.select(tx.record_name(F.col("i"), F.col("n"))).collect()] == [
        "1_my_file.v1.json", "no-id_unknown.json",
    ]


def python_chunks(name, text, size=4, overlap=1):
    found = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s.strip()]
    stride, out = max(1, size - overlap), []
    for start in range(0, len(found), stride):
        out.append((f"{name}_chunk_{start:03d}", " ".join(found[start : start + size])))
        if start + size >= len(found):
            break
    return out


def test_chunks_agree_with_python(spark, sf):
    texts = {f"n{n}": " ".join(f"Sentence {i}{'.!?'[i % 3]}" for i in range(n)) for n in (0, 1, 3, 4, 5, 7, 8, 30)}
    texts["blank"] = " \n "
    texts["odd"] = "No stop here\nand on. . Yes!No split?  End.\x1fx."
    df = spark.createDataFrame(list(texts.items()), "file_name string, clean_text string")
    df = df.withColumns({"category": F.lit("c"), "document_id": F.lit("d")})
    for size, overlap in ((4, 1), (4, 3), (2, 0), (1, 1), (3, 5)):
        got = sorted((r[0], r[1]) for r in chunk_documents(df, size, overlap).collect())
        expected = sorted(c for name, text in texts.items() for c in python_chunks(name, text, size, overlap))
        assert got == expected
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("file_name"), F.col("text").alias("clean_text"), "lang"
    )
    got = sorted((r[0], r[1]) for r in chunk_documents(docs, carried=("lang",)).select("chunk_id", "text").collect())
    assert got == sorted(c for r in docs.collect() for c in python_chunks(r[0], r[1]))


def test_words_in_a_task_are_the_words_of_a_column(spark):
    pieces = ["aB.", "Z9", "éΣ", "İß", "漢", "\U0001f600", "​", "‐", "\x00", *tx.WHITESPACE]
    rng = random.Random(1)
    texts = ["".join(rng.choices(pieces, k=rng.choice([0, 1, 3, 30]))) for _ in range(400)]
    found, counts = tx.words_in(pa.array(["x y", *texts, "z"]).slice(1, len(texts)))
    expected = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tx.words(F.col("t"))).collect()]
    assert counts.tolist() == [len(words) for words in expected]
    assert found.to_pylist() == [w for words in expected for w in words] == [w for t in texts for w in t.split()]
