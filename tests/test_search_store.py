import glob
import os

import pytest
from pyspark.sql import functions as F, types as T

from quire.operators import bm25, dense
from quire.plans import retrieval, search_store
from quire.plans.search_store import SearchStore
from quire.session import materialize, scratch_path
from tests.test_retrieval import query_frame

SCHEMA = "chunk_id string, text string, file_name string, category string, document_id string"
FIRST = {
    "a": ["the cat sat", "a dog ran far"], "b": ["the cat slept all day", "cats and dogs"],
    "c": ["nothing of note here"], "d": ["the the the", "one more line of words"],
}
QUERIES = ["the cat", "dog ran", "new words here", "nothing", "far line"]


def chunks_of(spark, files):
    rows = [(f"{f}_{i}", t, f, "cat", f"doc {f}") for f, texts in files.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


def names(spark, files):
    return spark.createDataFrame([(f,) for f in files], "file_name string")


def statistics_of(index):
    dictionary = sorted((r[0], r[1], round(r[2], 9)) for r in index.bm25.dictionary().collect())
    return dictionary, index.bm25.n_docs, index.bm25.total_length, round(index.bm25.mean_idf, 9)


def searched(spark, index):
    """Both lists, the dictionary and the totals."""
    asked = query_frame(spark, QUERIES)
    words = sorted((r[0], r[1], round(r[2], 9), r[3]) for r in bm25.bm25_topk(index.bm25, asked, 4).collect())
    near = dense.dense_topk(index.chunks, dense.embed(asked), 4)
    near = sorted((r[0], r[1], round(r[2], 6), r[3]) for r in near.collect())
    return words, near, statistics_of(index)


def files_of(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_a_refreshed_index_equals_one_built_anew(spark):
    path = scratch_path(spark, "store")
    store = SearchStore(spark, path, buckets=4)
    assert store.totals() is None
    with pytest.raises(FileNotFoundError):
        store.open()
    store.build(chunks_of(spark, FIRST))

    # a gets another text, b loses a chunk, c is emptied, e is new, d is named but unchanged.
    changed = {"a": ["a new cat sat", "new words here", "far away"], "b": FIRST["b"][:1], "d": FIRST["d"], "e": ["the new one"]}
    opened, before = store.open(), files_of(path)
    first = searched(spark, opened)
    said = store.refresh(chunks_of(spark, changed), names(spark, "abcde"))
    assert said == {"removed": 4, "added": 4, "kept": 3}
    anew = searched(spark, retrieval.build_search_index(chunks_of(spark, changed)))
    assert searched(spark, store.open()) == anew
    after = files_of(path)
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)  # nothing is written anew
    assert searched(spark, opened) == first  # who opened it before goes on with what was there

    # The same again changes nothing, not even the generation.
    assert store.refresh(chunks_of(spark, changed), names(spark, "abcde")) == {"removed": 0, "added": 0, "kept": 7}
    assert files_of(path) == after
    store.compact()
    assert searched(spark, store.open()) == anew and store.totals()["first_generation"] == 3
    # And on from there, to an index without chunks and back.
    store.refresh(chunks_of(spark, {}), names(spark, "abde"))
    assert store.open().chunks.count() == 0 and store.open().bm25.n_docs == 0
    store.refresh(chunks_of(spark, FIRST), names(spark, "abcd"))
    assert statistics_of(store.open()) == statistics_of(retrieval.build_search_index(chunks_of(spark, FIRST)))


def test_a_refresh_that_fails_changes_nothing(spark, monkeypatch):
    store = SearchStore(spark, scratch_path(spark, "store"), buckets=2)
    store.build(chunks_of(spark, FIRST))
    before = statistics_of(store.open())
    whole = SearchStore._write

    def broken(self, df, table, *rest):
        if table == "totals":
            raise OSError("lost")
        whole(self, df, table, *rest)

    monkeypatch.setattr(SearchStore, "_write", broken)
    with pytest.raises(OSError):
        store.refresh(chunks_of(spark, {"a": ["gone wrong"]}), names(spark, "a"))
    monkeypatch.undo()
    assert statistics_of(store.open()) == before and store.chunks().count() == 7
    store.refresh(chunks_of(spark, {"a": ["new words here"]}), names(spark, "a"))
    rest = {k: v for k, v in FIRST.items() if k != "a"}
    assert searched(spark, store.open()) == searched(spark, retrieval.build_search_index(chunks_of(spark, {"a": ["new words here"], **rest})))
    with pytest.raises(ValueError):
        store.refresh(chunks_of(spark, {"z": ["x"]}), names(spark, "a"))


def test_only_new_texts_meet_the_encoder(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        encode = dense.hashed_term_encoder()()

        def run(texts):
            calls.add(len(texts))
            return encode(texts)

        return run

    store = SearchStore(spark, scratch_path(spark, "store"), buckets=2, encoder=counting)
    store.build(chunks_of(spark, FIRST))
    assert calls.value == 7
    changed = dict(FIRST, a=["the cat sat", "another end"])
    store.refresh(chunks_of(spark, changed), names(spark, FIRST))
    assert calls.value == 8
    store.compact()
    assert calls.value == 8
    answers = retrieval.answer_queries(store.open(), query_frame(spark, ["another end"]), encoder=dense.hashed_term_encoder())
    assert answers.first()["citations"][0] == "a"
    assert store.chunks(names(spark, "a")).filter(F.col("file_name") != "a").count() == 0


def test_of_equal_chunks_as_many_stay_as_there_are(spark):
    store = SearchStore(spark, scratch_path(spark, "store"), buckets=2)
    twice = chunks_of(spark, {"a": ["the cat sat"], "b": ["a dog ran far"]})
    store.build(twice.unionByName(twice))
    assert store.refresh(twice, names(spark, "a").unionByName(names(spark, "b"))) == {"removed": 2, "added": 0, "kept": 2}
    assert statistics_of(store.open()) == statistics_of(retrieval.build_search_index(twice))
    assert sorted(r[0] for r in store.open().chunks.select("chunk_id").collect()) == ["a_0", "b_0"]


def test_postings_of_a_word_are_stored_together_and_chunks_where_they_are_made(spark):
    texts = {"a": ["the cat sat on the mat", ""], "b": ["the dog and the cat"] * 40, "c": ["\u00c9t\u00e9 the the"]}
    chunks = materialize(chunks_of(spark, texts).coalesce(1).withColumn("row", F.monotonically_increasing_id() + 5), "chunks")
    packed = bm25.packed_entries_of(chunks)
    lists = packed.filter("term IS NOT NULL")
    assert lists.count() == lists.select("term").distinct().count()
    got = sorted(map(tuple, bm25.unpacked(lists).select("term", "row", "tf", "length").collect()))
    plain = bm25.entries_of(chunks, row=F.col("row"))
    assert got == sorted(map(tuple, plain.filter("term IS NOT NULL").select("term", "row", "tf", "length").collect()))
    counts = packed.transform(bm25.packed_counts).groupBy("term").agg(F.sum("df"), F.sum("total_length"))
    assert sorted(map(str, counts.collect())) == sorted(str(r) for r in bm25.term_counts(plain).toDF(*counts.columns).collect())

    store = SearchStore(spark, scratch_path(spark, "store"), buckets=2)
    store.build(chunks_of(spark, texts))
    assert spark.read.parquet(f"{store.path}/postings").count() < plain.filter("term IS NOT NULL").count() // 3


def test_vectors_are_stored_as_bytes_and_given_as_numbers(spark):
    store = SearchStore(spark, scratch_path(spark, "store"), buckets=2)
    store.build(chunks_of(spark, FIRST))
    assert store.open().chunks.schema["embedding"].dataType == T.BinaryType()
    wanted = {r["chunk_id"]: r["embedding"] for r in dense.embed(chunks_of(spark, FIRST)).collect()}
    assert {r["chunk_id"]: r["embedding"] for r in store.chunks().collect()} == wanted
    uneven = spark.createDataFrame([(1, bytearray(8)), (2, bytearray(4))], "chunk_id long, embedding binary").coalesce(1)
    with pytest.raises(Exception, match="not all of"):
        dense.dense_topk(uneven, spark.createDataFrame([(1, [0.0, 1.0])], "query_id long, embedding array<float>")).collect()


def test_rows_are_picked_by_bitmaps(spark):
    """Rows at the edges of bytes, of numbers of 64 bits and of bitmaps; a bitmap is read once, not for each row."""
    numbers = [0, 1, 7, 8, 9, 63, 64, 65, 32767, 32768, 32769, 70000]
    rows = spark.createDataFrame([(n,) for n in [*numbers, 2, 62, 66, 32766, 69999, 200000]], "row long")
    bitmaps = materialize(search_store._bitmaps(spark.createDataFrame([(n,) for n in numbers], "row long")), "bitmaps")
    assert sorted(r[0] for r in search_store._picked(rows, bitmaps, True).collect()) == numbers
    rest = search_store._picked(rows, bitmaps, False)
    assert sorted(r[0] for r in rest.collect()) == [2, 62, 66, 32766, 69999, 200000]
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("conv(") > plan.index("Join")
