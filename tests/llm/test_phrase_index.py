import re
from collections import Counter

import numpy as np
import pytest

from quire.llm import phrase_index as px

WORD = re.compile(px.LOWER_WORD)


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, tests, size, slack):
    """Per document (n_words, places hit, items, nearly) by trying every window at every place."""
    split = [words_of(t) for _, t in docs]
    count = Counter(w for own in split for w in own)
    out = []
    for own in split:
        hit, items, nearly = set(), set(), set()
        places = {}
        for p, w in enumerate(own):
            places.setdefault(w, set()).add(p)
        for item, text in tests:
            words, name = words_of(text), "" if item is None else str(item)
            width = min(size, len(words))
            for q0 in range(len(words) - width + 1) if words else ():
                window = words[q0 : q0 + width]
                anchor = min(range(width), key=lambda j: (count[window[j]], j))
                for at in places.get(window[anchor], ()):
                    start = at - anchor
                    off = [min((abs(p - start - j) for p in places.get(w, ())), default=99) for j, w in enumerate(window)]
                    if max(off) <= slack:
                        nearly.add(name)
                    if max(off) == 0:
                        items.add(name)
                        hit.update(range(start, start + width))
        out.append((len(own), len(hit), tuple(sorted(items)), len(nearly)))
    return out


def found(spark, docs, tests, size, slack):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, term string").repartition(3)
    q = spark.createDataFrame([(i, t, "y") for i, t in tests], "item_id long, text string, d string")
    out = px.contamination(d, q, size=size, slack=slack)
    return sorted(str((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["n_near"])) for r in out.collect())


def wanted(docs, tests, size, slack):
    return sorted(str((i, *row)) for (i, _), row in zip(docs, brute(docs, tests, size, slack)))


@pytest.mark.parametrize("size,slack,sent", [(4, 0, 500_000), (4, 2, 500_000), (10, 1, 500_000), (3, 2, 0)])
def test_every_window_at_every_place(spark, monkeypatch, size, slack, sent):
    """Few distinct words, so that windows nearly hold in many places; also without sending any keys to all tasks."""
    monkeypatch.setattr(px, "MAX_SENT", sent)
    rng = np.random.default_rng(size + slack)
    text = lambda n: " ".join(rng.choice(list("abcdefghijklmnop"), n))
    tests = [(i, text(int(rng.integers(1, 30)))) for i in range(12)]
    docs = [(i, text(int(rng.integers(0, 80)))) for i in range(40)]
    for i in range(12):  # whole tests, parts of them, and tests with a word more or less
        words = tests[i][1].split()
        cut = int(rng.integers(0, len(words)))
        docs.append((100 + i, " ".join([text(5), *words, text(5), *words[cut:], text(2), *words[:cut], "zz", *words[cut:]])))
    assert found(spark, docs, tests, size, slack) == wanted(docs, tests, size, slack)


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    tests = [
        (1, passage), (1, passage), (2, passage.upper()), (None, "Short One"), (3, None), (4, ""), (5, "..."), (6, "unseen words"),
        (7, "é Straße"), (10, "the the the the the the the the the the the"),
    ]
    docs = [
        (1, None), (2, ""), (3, "--"), (4, f"x {passage}, y"), (4, f"x {passage}, y"), (None, f"{passage} short-one"),
        (5, "the " * 5000 + "short one"), (6, "é straße É STRASSE"), (7, passage[:30]), (8, f"{passage} {passage}"),
    ]
    assert found(spark, docs, tests, 10, 2) == wanted(docs, tests, 10, 2)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")], 10, 2) == []
    assert found(spark, [(1, "a b")], [], 10, 2) == wanted([(1, "a b")], [], 10, 2)
    assert found(spark, [(1, None)], [(1, "a b")], 10, 2) == [str((1, 0, 0, (), 0))]


def test_matches_say_where(spark):
    docs = spark.createDataFrame([(1, "x y a b c d e z"), (2, "a b q c d"), (3, "d c b a")], "doc_id long, text string")
    tests = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    got = sorted(tuple(r) for r in px.phrase_matches(docs, tests, size=4, slack=1).collect())
    # Words c and d of the second text stand one place late; f occurs nowhere, so windows with it don't count.
    assert (1, "7", "phrase", 2, 0, 5) in got and all(r[0] != 3 for r in got)
    assert any(r[0] == 2 and r[2] == "near" for r in got)


def test_plan_has_no_python(spark, sf):
    docs, tests = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = px.contamination(docs, tests)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
