import hashlib
import random
import tracemalloc
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import pair_bitmaps as pb
from quire.llm.queries import QUERIES


@cache
def token_bytes():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(pb.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=pb.PIECE_BPE)
    stands_for = pb._byte_level()

    def spell_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def both(text):
        """(id, begin, end) of the tokens of either side; nothing where the bytes differ."""
        out = []
        for ids, spell in (
            (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(stands_for[c] for c in a.id_to_token(i))),
            (b.encode(text), spell_b),
        ):
            spans, at = [], 0
            for i in ids:
                spans.append((i, at, at + len(spell(i))))
                at = spans[-1][2]
            out.append((spans, b"".join(spell(i) for i in ids)))
        raw = (" " + text).encode()
        return [s for s, _ in out] if out[0][1] == out[1][1] == raw else [[], []]

    return both


def brute(texts):
    """Rows of the contract by plain loops: all overlaps of all tokens."""
    both = token_bytes()
    linked, sides = [], []
    for text in texts:
        a, b = both(text) if text else ([], [])
        sides.append((a, b))
        links, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            at = first
            while at < len(b) and b[at][1] < e:
                links.append((i, b[at][0]))
                at += 1
        linked.append(links)
    count = Counter(p for links in linked for p in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (a, b), links in zip(sides, linked):
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts, i, j = [], 0, 0
        for end in common:
            own_a, own_b = [], []
            while i < len(a) and a[i][2] <= end:
                own_a.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= end:
                own_b.append(str(b[j][0]))
                j += 1
            parts.append(",".join(own_a) + "|" + ",".join(own_b))
        sha = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        out.append(
            (len(a), len(b), len(common), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha)
        )
    return out, count


ODD = [
    "a\n b", "a \n b", "end\n\n word", "tab\t x", "it's 'll don't x'", "a\u00a0b \u2003c", "12 345,67 $a_b",
    None, "", " ", "plain words here", "plain words here", "<|endoftext|> <s> </s> <unk>", "a▁b", "two  spaces\n\nand\ttabs ",
    "ﬁne café 你好 \U0001f600\U0001f600", " lead", "trail ", "<0x41>", "x" * 3000, "word " * 4000, "́̀", "\x00\x01",
]


def test_pairs_agree_with_plain_loops(spark, sf, monkeypatch):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    # Rows that share an id, ids that are NULL, and a column whose name the operator uses itself.
    rows = [(None if i == 3 else i // 2, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, planes string").repartition(3)
    expected, count = brute(texts)
    want = sorted((str(r[0]), *e) for r, e in zip(rows, expected))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted((str(r["doc_id"]), *[r[c] for c in columns]) for r in pb.align_tokenizers(docs).collect())
    assert got == want

    index = pb.pair_index(docs)
    pairs = {(r["a"], r["b"]): r for r in pb.pair_scores(index).collect()}
    assert {p: r["links"] for p, r in pairs.items()} == dict(count)
    in_docs = Counter(p for t in texts if t for p in brute([t])[1])
    assert {p: r["docs"] for p, r in pairs.items()} == dict(in_docs)
    # A block whose entries are written in several parts gives the same rows.
    monkeypatch.setattr(pb, "MAX_ENTRIES", 500)
    monkeypatch.setattr(pb, "SLICE_BYTES", 2000)
    again = sorted((str(r["doc_id"]), *[r[c] for c in columns]) for r in pb.align_tokenizers(docs).collect())
    assert again == want


def test_empty_table_and_query(spark, sf):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pb.align_tokenizers(none).collect() == []
    assert pb.pair_scores(pb.pair_index(none)).collect() == []
    out = QUERIES["op13_pair_bitmaps"](spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert dict(out.dtypes)["count_sum"] == "bigint"


@pytest.mark.parametrize("n", [0, 1, pb.DENSE_FROM - 1, pb.DENSE_FROM, 5000, pb.BLOCK])
def test_bitmaps_round_trip(n):
    numbers = np.sort(np.random.default_rng(n).choice(pb.BLOCK, n, replace=False))
    data = pb.pack(numbers)
    assert len(data) <= pb.BLOCK // 8 and pb.unpack(data).tolist() == numbers.tolist()


def test_fast_encoder_is_the_files_own():
    """Each code point of the planes in use, alone, doubled, and next to letters, digits and spaces."""
    with open(pb.BYTE_BPE, encoding="utf-8") as a, open(pb.PIECE_BPE, "rb") as b:
        tok = pb.Tokenizers(a.read(), b.read())
    assert tok.fast is not None
    points = [c for c in range(0x32000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 256):
        text = "".join(f" a{chr(c)}a1{chr(c)} {chr(c) * 2}" for c in points[at : at + 256])
        assert tok.ids_a(text) == tok.exact.encode(text, add_special_tokens=False).ids


def test_memory_of_a_task_is_bounded(monkeypatch):
    """4.6 MB of texts in one batch took 699 MB, with slices of 4 MB."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2400)), pa.array(range(2400)), pa.array(texts)], ["d", "doc_id", "text"])
    numbers = [(c, pa.int64()) for c in ("d", "doc_id", "n_a", "n_b", "n_groups", "n_links", "block")]
    names = [("part", pa.string()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32())]
    schema = pa.schema([*numbers, *names, ("planes", pa.list_(pa.binary()))])
    with open(pb.BYTE_BPE, encoding="utf-8") as file_a, open(pb.PIECE_BPE, "rb") as file_b:
        tok = pb.Tokenizers(file_a.read(), file_b.read())
    monkeypatch.setattr(pb, "Tokenizers", lambda *_: tok)
    tracemalloc.start()
    assert sum(out.num_rows for out in pb._index_task(lambda: (), schema)(iter([batch]))) > 2400
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 350 * 1024 * 1024
