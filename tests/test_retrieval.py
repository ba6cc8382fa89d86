import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire import fixed_values as fixed
from quire.operators import answering, bm25, dense, ranking, tiles, topk
from quire.plans import retrieval
from quire.session import materialize, scratch_path


def chunk_frame(spark, texts, partitions=3):
    rows = [(f"c{i:03d}", t, f"f{i % 4}.txt", "cat", f"d{i}") for i, t in enumerate(texts)]
    schema = "chunk_id string, text string, file_name string, category string, document_id string"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def query_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def python_bm25(texts, queries, k, pad):
    docs = [t.lower().split() for t in texts]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    raw = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {w: v if v >= 0 else 0.25 * mean for w, v in raw.items()}
    out = []
    for q, query in enumerate(queries):
        scored = []
        for i, doc in enumerate(docs):
            tf = Counter(doc)
            score = sum(
                idf.get(w, 0) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(doc) / avgdl)) for w in query.lower().split()
            )
            if pad or any(w in tf for w in query.lower().split()):
                scored.append((-round(score, 9), f"c{i:03d}", score))
        out += [(q, c, round(s, 6), r + 1) for r, (_, c, s) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("pad,first_read,max_sent", [(False, 3, 500_000), (True, 3, 0), (False, 10**6, 0), (True, 10**6, 500_000)])
def test_bm25_agrees_with_python(spark, monkeypatch, pad, first_read, max_sent):
    """Reading on after few postings and after all; joins by shuffle and by sending tables."""
    monkeypatch.setattr(bm25, "FIRST_READ", first_read)
    monkeypatch.setattr(topk, "MAX_SENT", max_sent)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)] + ["The", "the"]
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 12))) for _ in range(80)] + ["same same text", "same same text"]
    queries = ["w1 w2", "the", "w3 w3 w3 unknown", "nothing here", "same TEXT", "", " ".join(words)]
    index = bm25.build_index(chunk_frame(spark, texts))
    if first_read == 3:
        index = bm25.store_postings(index, scratch_path(spark, "postings"), buckets=4)
    hits = bm25.bm25_topk(index, query_frame(spark, queries), 5, pad_to_k=pad)
    got = sorted((r[0], r[1], round(r[2], 6) + 0.0, r[3]) for r in hits.collect())
    assert got == sorted(python_bm25(texts, queries, 5, pad))


@pytest.mark.parametrize("pad", [False, True])
def test_bm25_with_words_that_lower_scores(spark, monkeypatch, pad):
    """In a corpus in which most words are in most chunks, matches score below 0."""
    monkeypatch.setattr(bm25, "FIRST_READ", 1)
    texts = ["a b c", "a b", "a c b d", "b a c", "c a b"]
    queries = ["a", "a b c d", "d", "d a", "zz"]
    index = bm25.build_index(chunk_frame(spark, texts))
    assert min(r["idf"] for r in index.dictionary().collect()) < 0
    hits = bm25.bm25_topk(index, query_frame(spark, queries), 3, pad_to_k=pad)
    got = sorted((r[0], r[1], round(r[2], 6) + 0.0, r[3]) for r in hits.collect())
    assert got == sorted(python_bm25(texts, queries, 3, pad))


def test_a_search_reads_the_postings_of_its_words(spark):
    texts = ["a b c d", "a b", "c d e", "f a a b"] * 3
    index = bm25.store_postings(bm25.build_index(chunk_frame(spark, texts)), scratch_path(spark, "postings"), buckets=2)
    words = spark.createDataFrame([("a",), ("f",)], "term string")
    plan = index.postings(words)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*term_bucket", plan) and "tokens" not in plan
    assert {r["term"] for r in index.postings(words).collect()} == {"a", "f"}


def test_blocks_that_cannot_matter_are_skipped(spark, monkeypatch):
    """Two rare words decide; of the word in every chunk only the chosen chunks' postings are read."""
    monkeypatch.setattr(bm25, "FIRST_READ", 10)
    texts = [f"common filler {'rare one' if i < 8 else f'x{i}'}" for i in range(400)] + ["filler"] * 600
    index, queries = bm25.build_index(chunk_frame(spark, texts)), query_frame(spark, ["rare one common"])
    numbers = spark.createDataFrame([(w, n) for n, w in enumerate(("rare", "one", "common"))], "term string, number long")
    weights = numbers.join(index.dictionary(), "term").select(F.lit(0).alias("q"), F.col("number").alias("term"), F.col("idf").alias("weight"))
    lists = bm25._lists(index, numbers)
    scored = bm25._scores(lists, bm25._reading_plan(lists, weights), 5, False)
    assert scored.count() == 8 and lists.count() == 416
    got = sorted((r[0], r[1], round(r[2], 6), r[3]) for r in bm25.bm25_topk(index, queries, 5).collect())
    assert got == sorted(python_bm25(texts, ["rare one common"], 5, False))


def test_bm25_negative_weight_floor(spark):
    texts = ["shared one", "shared two"]
    index = bm25.build_index(chunk_frame(spark, texts))
    weights = {r["term"]: r["idf"] for r in index.dictionary().collect()}
    assert weights["shared"] < 0 and weights["one"] == pytest.approx(0.0)
    assert weights["shared"] == pytest.approx(0.25 * (math.log(0.5) - math.log(2.5)) / 3)
    got = [(r[0], r[1], round(r[2], 6), r[3]) for r in bm25.bm25_topk(index, query_frame(spark, ["shared"]), 2).collect()]
    assert sorted(got) == python_bm25(texts, ["shared"], 2, False)


def test_bm25_empty_inputs(spark):
    index = bm25.build_index(chunk_frame(spark, []))
    assert bm25.bm25_topk(index, query_frame(spark, ["a"]), 3).count() == 0
    index = bm25.build_index(chunk_frame(spark, ["a b"]))
    assert bm25.bm25_topk(index, query_frame(spark, []), 3).count() == 0


def vector_frame(spark, matrix, name="chunk_id"):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>").repartition(3)


def python_nearest(vectors, queries, k):
    vectors, queries = np.float32(vectors).astype(float), np.float32(queries).astype(float)
    out = []
    for q, query in enumerate(queries):
        dist = ((vectors - query) ** 2).sum(axis=1)
        best = sorted(range(len(vectors)), key=lambda i: (round(dist[i], 9), i))[:k]
        out += [(q, i, round(dist[i], 6), r + 1) for r, i in enumerate(best)]
    return sorted(out)


def test_dense_agrees_with_python(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 8))
    vectors[50:60] = vectors[0]
    queries = np.vstack([vectors[0], rng.normal(size=(6, 8))])
    expected = python_nearest(vectors, queries, 5)
    v, q = vector_frame(spark, vectors), vector_frame(spark, queries, "query_id")
    for bounds in ({}, {"QUERY_BLOCK": 2, "BUNDLE": 7}, {"SENT_BYTES": 0, "HELD_HITS": 10, "QUERY_BLOCK": 3}):
        for name, bound in bounds.items():
            monkeypatch.setattr(dense, name, bound)
        hits = dense.dense_topk(v, q, 5)
        assert sorted((r[0], r[1], round(r[2], 6), r[3]) for r in hits.collect()) == expected
    few = dense.dense_topk(vector_frame(spark, vectors[:2]), q, 5)
    assert few.count() == 2 * len(queries)


def test_approximate_search_is_exact_when_all_cells_are_probed(spark):
    rng = np.random.default_rng(6)
    vectors, queries = rng.normal(size=(300, 8)), rng.normal(size=(5, 8))
    v, q = vector_frame(spark, vectors), vector_frame(spark, queries, "query_id")
    centres = dense.fit_cells(v, 6)
    celled = dense.assign_cells(v, centres)
    exact = dense.dense_topk(v, q, 5)
    full = dense.approx_dense_topk(celled, q, centres, n_probe=6, k=5)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, exact.collect()))
    part = dense.approx_dense_topk(celled, q, centres, n_probe=3, k=5)
    expected, found, share = dense.recall(exact, part).first()
    assert expected == 25 and 0.4 <= share <= 1.0 and found == round(25 * share)
    # A hit of a partial search is never farther than its true distance says.
    assert part.join(exact.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_anti").count() == 25 - found


def test_one_query_id_many_times(spark, monkeypatch):
    """Blocks are cut by row number: an id that all queries share makes no large block, and every row is ranked by itself."""
    monkeypatch.setattr(dense, "QUERY_BLOCK", 50)
    rng = np.random.default_rng(8)
    vectors, query = rng.normal(size=(100, 4)), rng.normal(size=(1, 4))
    q = vector_frame(spark, np.repeat(query, 600, axis=0), "query_id").withColumn("query_id", F.lit(7))
    blocks, _ = dense._query_blocks(dense._asked(q).select(F.lit(0).alias("part"), "q", "embedding"), "part", 1)
    assert blocks.agg(F.max(F.size("q"))).first()[0] <= 50 and blocks.agg(F.sum(F.size("q"))).first()[0] == 600
    hits = dense.dense_topk(vector_frame(spark, vectors), q, 3).groupBy("query_id", "chunk_id", "rank").count().collect()
    assert {r["count"] for r in hits} == {600} and len(hits) == 3


def test_unequal_vectors_are_an_error(spark):
    bad = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "chunk_id long, embedding array<float>").coalesce(1)
    q = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, embedding array<float>")
    with pytest.raises(Exception, match="not all of length"):
        dense.dense_topk(bad, q).collect()


def test_default_encoder(spark):
    df = query_frame(spark, ["a b a", "", None, "B A a"])
    got = {r["query_id"]: np.array(r["embedding"]) for r in dense.embed(df).collect()}
    assert np.allclose(got[0], got[3]) and np.isclose(np.linalg.norm(got[0]), 1)
    assert not got[1].any() and not got[2].any()


def hits(spark, rows):
    return spark.createDataFrame(rows, "query_id long, chunk_id string, rank int")


def test_fusion(spark):
    vector = hits(spark, [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "x", 1)])
    words = hits(spark, [(1, "b", 1), (1, "a", 2), (1, "d", 3), (3, "y", 1)])
    got = [tuple(r) for r in ranking.reciprocal_rank_fusion(vector, words).orderBy("query_id", "rank").select(
        "query_id", "chunk_id", "rrf_score", "rank").collect()]
    both = 1 / 61 + 1 / 62
    assert got == [
        (1, "a", both, 1), (1, "b", both, 2), (1, "c", 1 / 63, 3), (1, "d", 1 / 63, 4), (2, "x", 1 / 61, 1), (3, "y", 1 / 61, 1),
    ]
    assert ranking.reciprocal_rank_fusion(vector, words, top_k=1).count() == 3


def candidates(spark):
    rows = [(1, "alpha beta", "c1", "nothing", 1, "f1"), (1, "alpha beta", "c2", "Alpha beta!", 2, "f2"),
            (1, "alpha beta", "c3", "beta alpha", 3, "f1"), (1, "alpha beta", "c4", "x alpha", 4, "f3")]
    return spark.createDataFrame(rows, "query_id long, query_text string, chunk_id string, text string, rank int, file_name string")


def test_rerank_default_and_plugged_scorer(spark):
    got = [(r["chunk_id"], r["rerank_score"], r["rank"]) for r in ranking.rerank(candidates(spark)).orderBy("rank").collect()]
    assert got == [("c3", 1.0, 1), ("c2", 0.5, 2), ("c4", 0.5, 3)]

    def by_length():
        return lambda queries, texts: texts.str.len().to_numpy()

    got = [r["chunk_id"] for r in ranking.rerank(candidates(spark), 2, by_length).orderBy("rank").collect()]
    assert got == ["c2", "c3"]
    assert ranking.rerank(candidates(spark).limit(0), 2, by_length).count() == 0


def test_context_and_citations(spark):
    contexts = answering.build_context(ranking.rerank(candidates(spark), 4)).first()
    assert contexts["context"] == (
        "[Source 1: f1]\nbeta alpha\n\n[Source 2: f2]\nAlpha beta!\n\n[Source 3: f3]\nx alpha\n\n[Source 4: f1]\nnothing"
    )
    assert contexts["citations"] == ["f1", "f2", "f3"]


def test_answer_rules(spark):
    queries = query_frame(spark, ["unseen", "alpha beta", "gamma"])
    contexts = answering.build_context(ranking.rerank(candidates(spark)))

    def answers(generator=None):
        out = answering.generate_answers(queries, contexts, generator).collect()
        return {r["query_id"]: (r["answer"], r["citations"], r["context_used"] is None) for r in out}

    got = answers()
    assert got[1] == ("beta alpha [Source 1]", ["f1", "f2", "f3"], False)
    assert got[0] == got[2] == (fixed.REFUSAL_TEXT, [], True)

    def echo():
        def generate(messages: pd.Series):
            assert len(messages) == 1  # queries without context never get here
            return [m[1]["content"].split("QUESTION: ")[1] + " " for m in messages]

        return generate

    assert answers(echo)[1] == ("alpha beta", ["f1", "f2", "f3"], False)
    refuse = lambda: lambda messages: [f"Well, {fixed.REFUSAL_TEXT.upper()}"] * len(messages)
    assert answers(refuse)[1][1] == []


def test_hybrid_pipeline_counts(spark):
    texts = ["alpha beta gamma.", "delta epsilon.", "alpha only here.", "zeta eta theta."]
    index = retrieval.build_search_index(chunk_frame(spark, texts))
    out = {r["query_id"]: r for r in retrieval.answer_queries(index, query_frame(spark, ["alpha beta", "qqq"])).collect()}
    assert out[0]["answer"].startswith("alpha beta gamma.") and out[0]["citations"][0] == "f0.txt"
    assert out[0]["hybrid_candidate_count"] == 4
    assert out[1]["answer"] == fixed.REFUSAL_TEXT and out[1]["citations"] == []


def test_vector_table_replaces_stale_chunks(spark):
    embedded = dense.embed(chunk_frame(spark, ["a", "b", "c", "d", "e"]))
    table = retrieval.vector_table(spark, scratch_path(spark, "vec"), buckets=4)
    retrieval.upsert_vectors(table, embedded)
    assert retrieval.upsert_vectors(table, embedded) == {"rows_before": 5, "rows_after": 5}
    shorter = embedded.filter("chunk_id = 'c000'")  # f0.txt had c000 and c004
    assert retrieval.upsert_vectors(table, shorter, drop_stale=False)["rows_after"] == 5
    assert retrieval.upsert_vectors(table, shorter)["rows_after"] == 4
    assert sorted(r["chunk_id"] for r in table.read().collect()) == ["c000", "c001", "c002", "c003"]


@pytest.mark.parametrize("pad,sent_bytes", [(False, 0), (True, 64 << 20)])
def test_bm25_in_small_bundles_and_blocks(spark, monkeypatch, pad, sent_bytes):
    """Bundles of 4 chunks, blocks of a few words, hits handed on early; many equal scores."""
    for name, value in {"BUNDLE_BITS": 2, "HELD_POSTINGS": 5, "BLOCK_WORDS": 4, "HELD_HITS": 6, "SENT_BYTES": sent_bytes}.items():
        monkeypatch.setattr(bm25, name, value)
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(12)], size=rng.integers(1, 9))) for _ in range(60)] + ["w1 w2"] * 9 + [""]
    queries = ["w1 w2", "w3", "", "w4 w4 w5 w6", "none", "w1 w7 w8 w9 w10 w11 w0", "w2"]
    index = bm25.build_index(chunk_frame(spark, texts))
    for skip_blocks in (False, True):
        hits = bm25.bm25_topk(index, query_frame(spark, queries), 4, pad_to_k=pad, skip_blocks=skip_blocks)
        got = sorted((r[0], r[1], round(r[2], 6) + 0.0, r[3]) for r in hits.collect())
        assert got == sorted(python_bm25(texts, queries, 4, pad))


@pytest.mark.parametrize("held", [2_000_000, 10])
def test_compressed_search_with_all_rows_as_candidates_lists_none(spark, monkeypatch, held):
    monkeypatch.setattr(dense, "HELD_HITS", held)
    monkeypatch.setattr(dense, "BUNDLE", 8)
    stored = []
    monkeypatch.setattr(dense, "materialize", lambda df, label: stored.append(label) or materialize(df, label))
    rng = np.random.default_rng(8)
    matrix = np.concatenate([rng.normal(size=(120, 8)), rng.normal(size=(60, 8)) * 0.01 + 5, np.zeros((4, 8))])
    vectors, asked = vector_frame(spark, matrix), vector_frame(spark, matrix[::7], "query_id")
    centres, books = dense.fit_cells(vectors, 3), dense.fit_codebooks(vectors, 4)
    codes = dense.compress(dense.assign_cells(vectors, centres), books).select("chunk_id", "code", "cell")
    exact = sorted((r[0], r[1], round(r[2], 6), r[3]) for r in dense.dense_topk(vectors, asked, 5).collect())
    for candidates, listed in ((184, False), (183, True)):
        stored.clear()
        hits = dense.compressed_topk(vectors, codes, asked, centres, books, n_probe=3, k=5, candidates=candidates).collect()
        assert ("candidates" in stored) == listed
        assert sorted((r[0], r[1], round(r[2], 6), r[3]) for r in hits) == exact or listed


def test_entries_come_sorted_by_word(spark):
    texts = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(["b a b", "", "a c", "é B"])], "chunk_id string, text string").coalesce(1)
    found = [(r[0], r[1], r[2], r[3]) for r in bm25.entries_of(texts).collect()]
    assert [r[4] for r in bm25.entries_of(texts).filter("term IS NULL").collect()] == ["c0", "c1", "c2", "c3"]
    assert found[4:] == [("a", 0, 1, 3), ("a", 2, 1, 2), ("b", 0, 2, 3), ("b", 3, 1, 2), ("c", 2, 1, 2), ("é", 3, 1, 2)]
    assert "Sort" not in bm25.entries_of(texts)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pad,held", [(False, 8_000_000), (True, 0)])
def test_bm25_in_tiles(spark, monkeypatch, pad, held):
    """Small tiles of several bundles, words that are multiplied and added, equal scores, a bar that is lost between blocks."""
    for name, value in {"BUNDLE_BITS": 6, "BLOCK_WORDS": 40, "TILED_QUERIES": 2, "HELD_BARS": held}.items():
        monkeypatch.setattr(bm25, name, value)
    for name, value in {"HEIGHT": 3, "WIDTH": 16, "TILE_WORDS": 9, "DENSE_SHARE": 0.1, "MOST_DENSE": 5, "ADDED": 7, "SCORED": 11, "GROUPS": 3}.items():
        monkeypatch.setattr(tiles, name, value)
    rng = np.random.default_rng(9)
    words = [f"w{int(n)}" for n in rng.zipf(1.4, 4000) if n < 400]
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 30))) for _ in range(300)] + ["w3 w9 w2"] * 12 + [""]
    queries = [" ".join(rng.choice(words, size=rng.integers(1, 20))) for _ in range(40)] + ["w3 w9 w2", "w2", "", "none", "w1 " * 30]
    index = bm25.build_index(chunk_frame(spark, texts))
    hits = bm25.bm25_topk(index, query_frame(spark, queries), 4, pad_to_k=pad)
    got = sorted((r[0], r[1], round(r[2], 6) + 0.0, r[3]) for r in hits.collect())
    assert got == sorted(python_bm25(texts, queries, 4, pad))


def test_tiles_keep_the_best_rows_only():
    """Of 3,000 rows and 300 queries few are given back, and all that belong to the best; the second bundle gives fewer."""
    rng = np.random.default_rng(4)
    term = np.stack([rng.choice(500, 12, replace=False) for _ in range(300)])
    weight = rng.uniform(0.1, 9, term.shape)
    bars, before, seen = tiles.Bars(5, 300), None, np.zeros((300, 0))
    for _ in range(2):
        has = rng.random((500, 3000)) < 0.3 / np.arange(1, 501)[:, None] ** 0.5
        number, place = np.nonzero(has)
        impact = rng.uniform(0.2, 2.5, len(number))
        query, row, score = tiles.best_in(tiles.Bundle(number, place.astype(np.int32), impact), np.full(300, 12), term.ravel(), weight.ravel(), bars)
        table = np.zeros((500, 3000))
        table[number, place] = impact
        exact = np.einsum("qt,qtr->qr", weight, table[term])
        assert np.allclose(score, exact[query, row], rtol=1e-12, atol=0)
        seen = np.concatenate([seen, exact], 1)
        kth = np.sort(seen, axis=1)[:, -5]
        wanted = {(q, r) for q, r in zip(*np.nonzero(exact >= kth[:, None]))}
        assert wanted <= set(zip(query.tolist(), row.tolist())) and len(query) < 300 * 8
        assert before is None or len(query) < before
        before = len(query)
