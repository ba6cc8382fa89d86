"""The pipeline, stage by stage, and the guard around the whole part."""

import corpus_pipeline
from quire.llm import quality_rules, simhash
from quire.session import materialize


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "stage")
        kept.append([r["doc_id"] for r in docs.select("doc_id").collect()])
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rules, exact, near, mixed, last = kept
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    report = quality_rules.quality_report(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    assert sorted(rules) == sorted(r["doc_id"] for r in report.filter("kept").collect())

    first = {}
    for i in sorted(rules):
        first.setdefault(" ".join(ids[i].split()), i)
    assert {" ".join(ids[i].split()) for i in exact} == set(first) and len(exact) == len(set(exact))

    # Of documents whose fingerprints are linked, the smallest id stays; all others stay as well.
    prints = {i: simhash.fingerprint(ids[i].encode(), 4) for i in exact}
    linked = {i: {j for j in exact if (prints[i] ^ prints[j]).bit_count() <= 4} for i in exact}
    stay = set()
    left = set(exact)
    while left:
        group, waiting = set(), [min(left)]
        stay.add(waiting[0])
        while waiting:
            i = waiting.pop()
            if i not in group:
                group.add(i)
                waiting += linked[i] - group
        left -= group
    assert sorted(near) == sorted(stay)
    assert set(mixed) <= set(near) and sorted(mixed) == sorted(last)
    assert docs.filter("not round_trip").count() == 0


def test_run_is_all_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() > 0
