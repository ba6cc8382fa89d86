"""The corpus operators on small tables with nulls, ties, repeats and odd texts, against plain Python."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F, types as T

from quire.llm import components as cc, cotraining, exact_dedup, license_notices, line_dedup, log_bilinear, mixing
from quire.llm import quality_rules, sentencepiece, sharding, simhash
from quire.llm.common import free_name, ranked

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SHARED = "This Line is shared by quite a few documents, Ünlike the others."
LONG = " ".join(f"wort{i % 977}" for i in range(30_000))

# (doc_id, text, lang, source): a NULL in each column, empty and blank texts, repeated rows, equal texts, a long text.
ROWS = [
    (1, "Plain words here\n" + SHARED, "en", "a"),
    (2, "other words\n  " + SHARED.translate(LOWER) + "\t\n" + SHARED, "en", "a"),
    (3, SHARED, "de", "b"),
    (4, SHARED + "\nlast line", None, "b"),
    (5, "x\n" + SHARED + "\ny", "fr", None),
    (6, SHARED + " ", "fr", None),
    (7, None, "en", "c"),
    (8, "", "en", "c"),
    (9, " \t\n ", "en", "c"),
    (None, "no id at all, and some words", "en", "a"),
    (10, "same   text\nhere", "en", "a"),
    (11, "same text here", "en", "b"),
    (11, "same text here", "en", "b"),
    (12, LONG, "en", "b"),
    (13, LONG + " end", "en", "b"),
    (14, "Naïve İstanbul ▁ marks \U0001f600 and\r\nbreaks", "es", "é"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Names that operators use inside, as columns of the table.
EXTRA = ["piece", "position", "fp", "row", "kept", "ids", "near_row", "copy_row", "mix_row", "quality_stats"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("extra") for c in EXTRA}).withColumn("n_chars", F.length("text").cast("long")).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(text):
    return WORD.findall(text or "")


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_line_dedup(docs, empty):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text, *_ in ROWS:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    expected = []
    for i, text, *_ in ROWS:
        lines = (text or "").split("\n")
        out = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or i == max(h or -1 for h in holders[key(x)])]
        expected.append((i, len(lines), len(lines) - len(out), "\n".join(out)))
    got = collected(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "kept_text")
    assert got == sorted(expected, key=repr)
    assert sum(n for _, _, n, _ in got) == 6
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_runs(spark):
    texts = [(i, "\n".join((SHARED if c == "s" else f"own {i}") for c in shape)) for i, shape in enumerate(["sos", "ss", "oso", "s", "ssos", "ss"])]
    out = line_dedup.line_bitmaps(spark.createDataFrame(texts, "doc_id long, text string"))
    runs = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in out.collect()}
    assert runs == {0: [(0, 0), (2, 2)], 1: [(0, 1)], 2: [(1, 1)], 3: [(0, 0)], 4: [(0, 1), (3, 3)]}


def test_exact_dedup(docs, empty):
    form = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for i, text, *_ in ROWS:
        groups[form(text)].append(i)
    expected = []
    for text, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        kept = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            expected.append((i, first, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
            kept = False
    out = exact_dedup.exact_dedup(docs)
    assert collected(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=repr)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id") == sorted([(e[0],) for e in expected if e[3]], key=repr)
    assert exact_dedup.exact_dedup(empty).count() == exact_dedup.drop_exact_copies(empty).count() == 0


def test_bloom_filter_knows_repeats(spark):
    values = [(i,) for i in range(3000)] + [(i,) for i in range(0, 3000, 7)]
    df = spark.createDataFrame(values, "n long").repartition(5).select(F.xxhash64("n").alias("hash"), "n")
    test = exact_dedup.repeat_filter(df.select("hash"))
    flagged = {r["n"] for r in df.filter(test(F.col("hash"))).collect()}
    assert flagged >= set(range(0, 3000, 7)) and len(flagged) < 800


def test_golay_keys_meet():
    golay, rng = simhash.Golay(), np.random.default_rng(0)
    assert (golay.count[golay.syndrome(np.arange(2**12) << 11)] > 0).all()
    one = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    two = one.copy()
    for n in range(4):  # up to four bits, in any segments
        two ^= np.where(rng.random(len(one)) < 0.9, np.uint64(1) << rng.integers(0, 64, len(one), dtype=np.uint64), np.uint64(0))
    keys = [defaultdict(set), defaultdict(set)]
    for out, values in zip(keys, (one, two)):
        for row, key in zip(*simhash.fuzzy_keys(values, golay)):
            out[int(row)].add(int(key))
    assert all(keys[0][i] & keys[1][i] for i in range(len(one)))


def brute_fingerprint(text, n=4):
    found = words((text or "").translate(LOWER))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + n]).encode(), 42) for i in range(max(1, len(found) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    out = {}
    for start in range(len(prints)):
        if start in out:
            continue
        group, waiting = {start}, [start]
        while waiting:
            x = waiting.pop()
            for y in range(len(prints)):
                if y not in group and (prints[x] ^ prints[y]).bit_count() <= 4:
                    group.add(y)
                    waiting.append(y)
        out |= dict.fromkeys(group, group)
    return out


def test_near_dedup(docs, empty):
    prints = [brute_fingerprint(r[1]) for r in ROWS]
    groups = brute_components(prints)
    expected = [
        (r[0], f"{p:016x}", min((ROWS[x][0] for x in groups[i] if ROWS[x][0] is not None), default=None))
        for i, (r, p) in enumerate(zip(ROWS, prints))
    ]
    assert collected(simhash.near_dedup(docs), "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)
    assert simhash.near_dedup(empty).count() == 0


def test_crowded_keys(spark, monkeypatch):
    """Runs longer than a block, over several batches: the same components as all pairs."""
    monkeypatch.setattr(simhash, "CROWD", 40)
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 2**63))
    values = {centre}
    for _ in range(250):
        value = centre
        for bit in rng.integers(0, 64, 3):
            value ^= 1 << int(bit)
        values.add(value)
    values = sorted(values | {int(v) for v in rng.integers(0, 2**63, 50)})
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"))
    got = {r["node"] % 2**64: r["root"] for r in cc.components(links).collect()}
    expected = brute_components(values)
    for i, v in enumerate(values):
        if len(expected[i]) > 1:
            assert {x for x in values if x in got and got[x] == got[v]} == {values[x] for x in expected[i]}
        else:
            assert v not in got


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    out = {r["node"]: r["root"] for r in cc.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("sent", [0, 500_000])
def test_drop_near_copies(spark, docs, empty, monkeypatch, sent):
    """One row of each component of the fingerprints stays; equal rows, NULL ids and wordless texts among them."""
    monkeypatch.setattr(simhash, "MAX_SENT", sent)
    base = [f"w{i}" for i in range(300)]
    near = base.copy()
    near[150] = "other"
    far = base[:150] + [f"v{i}" for i in range(150)]
    rows = [
        (5, " ".join(base)), (3, " ".join(near)), (3, " ".join(near)), (4, " ".join(far)), (None, " ".join(base)), (8, None), (9, ""),
        (None, "lonely words"), (None, "lonely words"), (2, "some other words"),
    ]
    rows = [(*r, i) for i, r in enumerate(rows)]
    out = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, copy_id long"))
    prints = [brute_fingerprint(r[1]) for r in rows]
    groups = brute_components(prints)
    expected = {min((rows[x][0] is None, rows[x][0] or 0, rows[x][1] or "") for x in groups[i]) for i in range(len(rows))}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted(expected)
    assert out.columns == ["doc_id", "text", "copy_id"]
    if sent:
        assert simhash.drop_near_copies(docs).columns == docs.columns
        assert simhash.drop_near_copies(empty).count() == 0


def test_mixing(docs, empty):
    out = mixing.mix_report(docs)
    got = out.collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        assert r["copies"] in range(4) and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == sorted((r[0] or 0, len(words(r[1]))) for r in ROWS)
    # Shares by weight, limited to three times the size, the rest shared again.
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    expected, left, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not above:
            expected |= {s: left * weight[s] / total for s in open_}
            break
        expected |= {s: 3.0 * sizes[s] for s in above}
        left -= sum(3 * sizes[s] for s in above)
        open_ -= above
    assert targets == pytest.approx(expected)
    assert collected(out, *out.columns) == collected(mixing.mix_report(docs), *out.columns)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix_report(empty).count() == mixing.mix_documents(empty).count() == 0


def test_mixing_comes_near_its_targets(spark):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.repeat(F.lit("w "), (F.col("id") * 7919 % 100 + 1).cast("int")).alias("text")
    )
    for r in mixing.mix_report(df).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("target")).collect():
        assert r["n"] == pytest.approx(r["target"], rel=0.02)


def test_ranked(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.col("id") * 37 % 211).alias("v"))
    by_group = defaultdict(list)
    for r in ranked(df, ["v"], by=["g"]).collect():
        by_group[r["g"]].append((r["position"], r["v"]))
    for rows in by_group.values():
        assert [p for p, _ in sorted(rows)] == list(range(len(rows)))
        assert [v for _, v in sorted(rows)] == sorted(v for _, v in rows)


def test_hilbert_curve(spark):
    cells = spark.range(512).selectExpr("cast(id & 7 as int) x", "cast((id >> 3) & 7 as int) y", "cast(id >> 6 as int) z")
    points = sorted((r["h"], (r["x"], r["y"], r["z"])) for r in cells.withColumn("h", sharding.hilbert_index("x", "y", "z", 3)).collect())
    assert [h for h, _ in points] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for (_, p), (_, q) in zip(points, points[1:]))


def test_shards(docs, empty, tmp_path, spark):
    got = sharding.hilbert_shards(docs, shards=5).collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS
    )
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    assert sorted(by_shard) == list(range(5)) and {len(s) for s in by_shard.values()} <= {3, 4}
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sharding.hilbert_shards(empty).count() == 0
    sharding.write_curve_ordered(docs, str(tmp_path / "out"), files=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted(docs.columns) and back.count() == len(ROWS)


def test_language_model(docs, empty):
    token_rows = {i: [w.lower() if w.isascii() else w.translate(LOWER) for w in words(r[1])] + [None] for i, r in enumerate(ROWS)}
    training = [i for i, r in enumerate(ROWS) if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2]
    counts = Counter(t for i in training for t in token_rows[i])
    total = sum(counts.values())
    expected = [
        (r[0], i not in training, len(token_rows[i]), sum(counts[t] > 0 for t in token_rows[i]), total,
         round(sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in token_rows[i]), 5))
        for i, r in enumerate(ROWS)
    ]
    out = log_bilinear.lm_scores(docs).withColumn("base_score", F.round("base_score", 5))
    assert collected(out, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == sorted(expected, key=repr)
    assert all(r["score"] < 0 for r in out.collect())
    assert log_bilinear.lm_scores(empty).count() == 0


def test_rare_words_are_joined(docs, monkeypatch):
    whole = collected(log_bilinear.lm_scores(docs).selectExpr("doc_id", "n_known", "round(base_score, 5) b", "round(score, 3) s"), "doc_id", "n_known", "b")
    monkeypatch.setattr(log_bilinear, "DICTIONARY", 200)
    some = collected(log_bilinear.lm_scores(docs).selectExpr("doc_id", "n_known", "round(base_score, 5) b"), "doc_id", "n_known", "b")
    assert whole == some


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    model = log_bilinear.Model(np.ones(log_bilinear.CLASSES, np.int64))
    follows = rng.integers(0, log_bilinear.CLASSES, log_bilinear.CLASSES)
    rows = np.array([(follows[c], c, follows[c]) for c in range(log_bilinear.CLASSES)] * 8)[:, [1, 0, 2]]
    p = model.log_probabilities(rows[:, :2])
    assert np.allclose(np.exp(p).sum(1), 1)
    before = p[np.arange(len(rows)), rows[:, 2]].mean()
    for _ in range(60):
        model.train(rows, np.ones(len(rows)), rng)
    p = model.log_probabilities(rows[:, :2])
    assert np.allclose(np.exp(p).sum(1), 1) and p[np.arange(len(rows)), rows[:, 2]].mean() > before + 1


def test_sentencepiece_is_the_library(docs, empty, spark):
    from sentencepiece import SentencePieceProcessor

    library, pieces = SentencePieceProcessor(model_file=sentencepiece.MODEL), sentencepiece.load_pieces()
    out = sentencepiece.tokenized(docs, pieces)
    assert out.columns == [*docs.columns, "ids_", "decoded"]
    for r in out.collect():
        assert r["decoded"] == (r["text"] or "")
        if "▁" not in (r["text"] or ""):  # the library can't tell a literal mark from a space
            assert list(r["ids_"]) == library.encode(r["text"] or "")
    assert sentencepiece.tokenized(empty, pieces).count() == 0


def test_sentencepiece_steps_apart_are_the_steps_together(docs, spark):
    pieces = sentencepiece.load_pieces()
    together = sentencepiece.tokenized(docs.select("doc_id", "text"), pieces)
    apart = docs.select("doc_id", "text", sentencepiece.encode(F.col("text"), pieces, spark).alias("ids"))
    apart = apart.withColumn("decoded", sentencepiece.decode(F.col("ids"), pieces, spark))
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
    named = docs.select("doc_id", "text", F.lit(1).alias("Encoded"), F.lit(2).alias("IDS"), F.lit(3).alias("decoded"))
    assert sentencepiece.tokenized(named, pieces).columns == ["doc_id", "text", "Encoded", "IDS", "decoded", "ids_", "decoded_"]


def test_unigram_viterbi_finds_the_best_sum():
    rows = [("<unk>", 0.0, "unknown"), *[(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)]]
    scores = {"▁": -1.0, "a": -1.5, "b": -1.5, "▁a": -2.1, "ab": -1.9, "ba": -2.2, "▁ab": -3.5, "aba": -3.1, "bab": -3.3}
    pieces = sentencepiece.Pieces([*rows, *[(p, s, "normal") for p, s in scores.items()]], by_merges=False)

    def best(word):
        table = [(0.0, ())] + [(-math.inf, ())] * len(word)
        for end in range(1, len(word) + 1):
            for begin in range(end):
                s = scores.get(word[begin:end], pieces.penalty if end - begin == 1 else -math.inf)
                table[end] = max(table[end], (table[begin][0] + s, (*table[begin][1], word[begin:end])), key=lambda x: x[0])
        return table[-1][0]

    found = ["▁" + "".join("ab"[i >> k & 1] for k in range(7)) for i in range(128)] + ["▁abcab", "▁"]
    for word, ids in sentencepiece.encode_words(found, pieces):
        parts = [pieces.written[i].decode().replace(" ", "▁") for i in ids]
        assert "".join(parts) == word
        assert sum(scores.get(p, pieces.penalty) for p in parts) == pytest.approx(best(word))


def test_statistics(docs):
    def brute(text):
        text = text or ""
        found = words(text)
        windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        times, covered, seen, dup = Counter(windows), set(), set(), 0
        for i, w in enumerate(windows):
            covered |= {i, i + 1, i + 2} if times[w] > 1 else set()
        for line in text.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)

    names = quality_rules.COUNTS[:5]
    texts = [r[1] for r in ROWS] + ["a b c a b c", "a a a a", "# x\n# x\n\n\n", "a b c d b c d e"]
    assert [quality_rules.statistics_of(t.encode() if t is not None else None)[:5] for t in texts] == [brute(t) for t in texts]
    got = docs.select("text", quality_rules.text_statistics(F.col("text")).alias("s")).select("text", "s.*")
    assert collected(got, *names) == sorted((brute(r[1]) for r in ROWS), key=repr)


def test_decision_list(spark, docs, empty):
    good = [(i, " ".join(f"good{(i * k) % 89}" for k in range(1, 80)), 1) for i in range(1, 61)]
    bad = [(100 + i, " ".join(f"bad{(i * k) % 83}##$$" for k in range(1, 80)), 0) for i in range(1, 61)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    rules = quality_rules.fit_rules(df, df)
    assert len(rules) == 1 and len(quality_rules.describe_rules(rules)) == 1
    assert collected(quality_rules.keep_good(df, df), "doc_id") == sorted([(i,) for i, *_ in good], key=repr)
    none = spark.createDataFrame([], "doc_id long, quality int")
    report = quality_rules.quality_report(docs, none)
    assert all(r["kept"] == (not r["base_failed"]) and r["rule"] is None for r in report.collect())
    assert report.count() == len(ROWS) and quality_rules.keep_good(docs, none).columns == docs.columns
    odd = spark.createDataFrame([(None, 1), (12, None), (12, 7), (12, 0), (12, 1), (99, 0)], "doc_id long, quality int")
    assert quality_rules.quality_report(docs, odd).count() == len(ROWS)
    assert quality_rules.quality_report(empty, odd).count() == 0


def test_co_training_over_parts_equals_brute_force(spark):
    """All unlabelled rows take part: sums over tasks give the weights of one pass over all rows in one place."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["fine", "words", "here", "##", "9 9"], 30 if i % 2 else 6)), f"s{i % 3}", "en", i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, quality long").repartition(5)
    known = df.filter("doc_id < 120")
    got = cotraining.fit_quality(df, known, confidence=0.7)
    halves = [v.astype(np.float16).astype(float) for v in cotraining._views([(t.encode(), s, g, len(t)) for _, t, s, g, _ in rows])]
    order = np.random.default_rng(0).permutation(120)
    pool = tuple(v[120:] for v in halves)
    seen, rules = [], []

    def one_place(function, *given):
        seen.append(function.__name__)
        rules[:] = given[1] if len(given) > 1 else rules
        return function(pool, *given)

    good = np.array([float(r[4]) for r in rows])[order]
    want = cotraining.co_train(halves[0][order], halves[1][order], good, one_place, confidence=0.7)
    assert np.allclose(got.text, want.text, atol=1e-6) and np.allclose(got.meta, want.meta, atol=1e-6)
    assert "pool_sums" in seen and any((~np.isnan(t)).any() for t in cotraining.told(rules, pool))


def test_co_training_thresholds():
    counts = np.zeros(cotraining.BINS)
    counts[[100, 200, 5800, 5900]] = [50, 50, 40, 5]
    assert cotraining.thresholds(counts, 0.5, 0.1, 0.95) == (100, 5801)
    assert cotraining.thresholds(counts, 0.5, 1.0, 0.95) == (199, 3295)
    assert cotraining.thresholds(counts * 0, 0.5, 0.1, 0.95)[1] == cotraining.BINS


def test_co_training(spark, docs, empty):
    rows = [
        (i, " ".join((f"good{(i * k) % 89}" if i % 4 else f"BAD{(i * k) % 83}!!") for k in range(1, 40)), "en", "a" if i % 4 else "b", 1 if i % 4 else 0)
        for i in range(240)
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", quality int")
    model = cotraining.fit_quality(df, df.filter("doc_id < 160"))
    got = {r["doc_id"]: r for r in cotraining.score_quality(df, model).collect()}
    assert all(got[i]["kept"] == (i % 4 > 0) for i in range(160, 240))  # held out
    assert all(0 <= got[i][c] <= 1 for i in got for c in ("text_score", "meta_score", "score"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")):
        out = cotraining.score_quality(docs, cotraining.fit_quality(docs, labels))
        assert out.count() == len(ROWS) and out.filter("score is null").count() == 0
    assert cotraining.score_quality(empty, model).count() == 0


def test_license_base(spark):
    texts = {
        1: "Released under the MIT License. The MIT-license, mit  LICENSE!", 2: "summit license", 3: None, 4: "", 5: "GNU General\nPublic License and Apache License",
        6: "mit licenses é mit license",
    }
    out = license_notices.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out.collect()}
    assert got == {
        1: (10, 3, 3, 8, ["mit"]), 2: (2, 0, None, None, []), 3: (0, 0, None, None, []), 4: (0, 0, None, None, []),
        5: (7, 2, 1, 5, ["apache", "gpl"]), 6: (5, 1, 3, 3, ["mit"]),
    }


def test_license_notices_with_edits():
    """Seeds lose nothing: the notices found are those that the whole text matches."""
    rng = np.random.default_rng(3)
    search = license_notices.NoticeSearch()
    for phrase, label, most in license_notices.NOTICES:
        pattern = regex.compile(f"(?:{regex.escape(phrase, literal_spaces=True)}){{e<={most}}}")
        for edits in range(most + 3):
            letters = list(phrase)
            for at in sorted(rng.choice(np.arange(1, len(phrase) - 1), edits, replace=False).tolist(), reverse=True):
                kind = rng.integers(3)
                letters[at : at + 1] = [] if kind == 0 else ["q"] if kind == 1 else [letters[at], "z"]
            text = license_notices.normalized_words(("some words before " + "".join(letters) + " and after").encode()).decode()
            spans = search.search(text)
            found = any(search.notices[n][1] == label for n, *_ in spans)
            overlapping_better = any(e < edits for *_, e in spans)
            assert found == bool(pattern.search(text)) or overlapping_better, (text, spans)
            assert all(e <= search.notices[n][2] for n, *_, e in spans)


def test_license_notices_side_by_side():
    """None hides another of its kind, wherever the better one stands."""
    search = license_notices.NoticeSearch()
    bad, good = "relesed undr the mit license", "released under the mit license"
    for copies in ([bad, good], [good, bad], [bad, bad, good, bad], [bad] * 3):
        text = license_notices.normalized_words(" x ".join(copies).encode()).decode()
        assert [e for *_, e in search.search(text)] == [2 if c == bad else 0 for c in copies], text


def test_free_name(docs):
    assert free_name(docs, "Piece") == "Piece_" and free_name(docs, "new") == "new"


def test_log_bilinear_training_step_takes_no_table_of_classes_by_rows():
    lbl = log_bilinear
    rng = np.random.default_rng(3)
    at, rows = rng.integers(0, 9, 200), rng.normal(size=(200, 4))
    want = np.zeros((9, 4))
    np.add.at(want, at, rows)
    model, seen = lbl.Model(np.ones(lbl.CLASSES)), rng.integers(0, lbl.CLASSES, (2048, lbl.ORDER + 1))
    model.train(seen, np.ones(2048), rng)
    tracemalloc.start()
    model.train(seen, np.ones(2048), rng)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * lbl.CLASSES * 2048
    got = np.zeros((9, 4))
    lbl._add_rows(got, at, rows)
    assert np.allclose(got, want)


def test_log_bilinear_tasks_hold_little_of_short_texts_and_of_long_words(monkeypatch):
    lbl = log_bilinear
    monkeypatch.setattr(lbl, "TEXT_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(lbl, "HELD_BYTES", 1 << 20, raising=False)
    vocabulary = lbl.Vocabulary.__new__(lbl.Vocabulary)
    vocabulary.number, vocabulary.of_word = {}, np.zeros(0, np.int16)

    def peak(work, texts):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        tracemalloc.start()
        for _ in work(batch.slice(at, 100) for at in range(0, len(texts), 100)):
            pass
        out = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out

    scored = lambda batches: lbl._in_blocks(batches, vocabulary, lbl._Suffixes(), 0)
    trained = lambda batches: lbl._class_blocks(batches, {}, 0)
    long = [f"{i:06}" * 2000 for i in range(4000)]  # 48 MB
    assert peak(scored, [None, ""] * 50_000) < 10 << 20
    assert peak(trained, [None, ""] * 50_000) < 4 << 20
    assert peak(scored, long) < 8 << 20
    assert peak(lbl._count_words, long) < 8 << 20


def test_long_words_are_joined(spark, docs, monkeypatch):
    lbl = log_bilinear
    counts = spark.createDataFrame([(b"%03d" % i * 100, 400 - i) for i in range(400)] + [(b"short", 1)], "word binary, n long").cache()
    assert set(lbl.Vocabulary(counts, 1).number) == {b"%03d" % i * 100 for i in range(lbl.TOP - 1)} | {b"short"}
    scores = lambda: collected(lbl.lm_scores(docs).selectExpr("doc_id", "n_tokens", "n_known", "round(base_score, 5) b", "round(score, 5) s"), *"doc_id n_tokens n_known b s".split())
    whole = scores()
    monkeypatch.setattr(lbl, "TOP", 4)
    monkeypatch.setattr(lbl, "SUFFIXES", lbl.CLASSES - 4)
    few = scores()
    for name in ("LONG_WORD", "TEXT_BYTES", "HELD_BYTES", "ROWS"):
        monkeypatch.setattr(lbl, name, 1)
    assert scores() == few != whole
