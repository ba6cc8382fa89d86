import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import ranked_search as rs

WORD = re.compile(rs.WORD)


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, queries, k):
    """(item, rank, doc, score) by the formula, over all pairs; docs and queries are (id, text)."""
    split = [words_of(t) for _, t in docs]
    n_docs, n_words = sum(1 for w in split if w), sum(map(len, split))
    counts = [Counter(w) for w in split]
    df = Counter(w for c in counts for w in c)
    out = []
    for item, text in queries:
        scored = []
        for (doc, _), own, c in zip(docs, split, counts):
            m = 100 - 25 + (25 * len(own) * n_docs) // n_words if own else 0
            score = 0
            for w in words_of(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, queries, k):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, term string").repartition(3)
    q = spark.createDataFrame([(i, t, "y") for i, t in queries], "item_id long, text string, q string").repartition(2)
    out = rs.rank_documents(d, q, k)
    assert dict(out.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus(n_docs, seed):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, 400) ** 1.1
    vocabulary = np.array([f"w{i}" for i in range(1, 400)])
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=share / share.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(n_docs)]
    queries = [(q, text(int(rng.integers(1, 25)))) for q in range(12)]
    queries += [(100 + i, docs[i][1]) for i in range(3)]
    return docs, queries


@pytest.mark.parametrize("first_read", [10, 200, 10**6])
def test_ranks_agree_with_the_formula(spark, monkeypatch, first_read):
    """Many small rounds, a few, and one that reads everything."""
    monkeypatch.setattr(rs, "FIRST_READ", first_read)
    docs, queries = corpus(400, 1)
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # more ties than places
    assert ranked(spark, docs, queries, 5) == brute(docs, queries, 5)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(rs, "FIRST_READ", 2)
    docs = [
        (1, None), (2, ""), (3, " .,; "), (4, "The cat, the CAT_cat"), (4, "The cat, the CAT_cat"), (None, "cat é É straße"),
        (5, "Straße cat 9"), (6, "k K K cat"), (7, "long " * 30_000 + "cat"), (8, "dog"),
    ]
    queries = [
        (1, "cat"), (1, "cat"), (2, "the the unknown"), (3, None), (4, ""), (5, "nothing here"), (6, "é straße STRASSE"),
        (None, "long cat"), (8, "dog 9"),
    ]
    assert ranked(spark, docs, queries, 3) == brute(docs, queries, 3)


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "cat")], 3) == []
    assert ranked(spark, [(1, "cat")], [], 3) == []
    assert ranked(spark, [(1, None)], [(1, "cat")], 3) == []


def test_most_of_the_frequent_lists_stays_unread(spark, monkeypatch):
    """A query whose rare words decide: documents that only share a frequent word are never scored."""
    monkeypatch.setattr(rs, "FIRST_READ", 20)
    docs = [(i, "common filler text " + ("rare one" if i < 6 else f"x{i}")) for i in range(600)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame([(0, "rare one common filler")], "q long, text string")
    index = rs.impact_index(d)
    found = rs.top_documents(index, q, 5)
    assert found.count() == 6
    seen = spark.read.parquet(*{p for p in found.inputFiles()})
    assert seen.count() < 100


def test_words_are_counted_by_bytes_and_without_the_regex_engine():
    texts = ["a bc", None, "", " .", "d", "é1ü x-y", "z", "\x00q\x7f r", "aa" * 9] * 3
    want = [len(re.findall(rs.WORD, t or "")) for t in texts]
    for begin in (0, 2, 3, 26):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]).slice(begin)
        got = [(r["docs"], r["words"]) for out in rs._count_words(iter([batch])) for r in out.to_pylist()]
        assert got == [(sum(n > 0 for n in want[begin:]), sum(want[begin:]))]
    nothing = pa.RecordBatch.from_arrays([pa.array([None], pa.string())], ["text"])
    assert list(rs._count_words(iter([nothing]))) == []
