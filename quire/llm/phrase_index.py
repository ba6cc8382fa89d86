"""Benchmark decontamination with a positional inverted index.

The index is stored once: a posting for each word of each document, in every file
sorted by word, document and place.  A test window is looked for from its rarest
word on: the word's list, moved back by the word's place in the test text, says
where the test text would begin; the list of the next rarest word, moved likewise,
must agree; what is left is compared word by word.  Built from DataFrame functions
only.

Words are known by 64-bit hashes.  A wrong match of a window needs a collision of
its rarest word with one other word of the corpus, and one more for each other word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quire.functions.text import once
from quire.llm.common import ascii_lower
from quire.session import materialize

# Lower-cased words: digits, a-z and all beyond ASCII.
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Keys of a semi join go to all tasks up to so many (16 bytes each); beyond it, both sides are shuffled.
MAX_SENT = 500_000


def lower_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; NULL has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(LOWER_WORD), F.lit(0))


def among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` occurs in ``keys``, a stored table."""
    right = keys.select(column).distinct()
    return rows.join(F.broadcast(right) if right.count() <= MAX_SENT else right, column, "left_semi")


def positional_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings (``term, d, pos``), and for each row of ``docs`` one without a term: ``d, doc_id, n_words``.

    ``d`` numbers the rows, so repeated rows and NULL ids stay apart; places are
    counted from 0.  NULL and empty texts have no postings, other columns are
    not read, an empty table gives an empty index.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("d"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = once(rows, words=lower_words(F.col("text"))).select("d", "doc_id", "words", F.size("words").alias("n"))
    head = F.array(F.lit(None).cast("string"))
    entries = split.select("d", "doc_id", "n", F.posexplode(F.concat(head, "words")).alias("place", "word"))
    is_word = F.col("place") > 0
    postings = entries.select(
        F.when(is_word, F.xxhash64("word")).alias("term"),
        "d",
        F.when(is_word, F.col("place") - 1).alias("pos"),
        F.when(~is_word, F.col("doc_id")).alias("doc_id"),
        F.when(~is_word, F.col("n").cast("long")).alias("n_words"),
    )
    return materialize(postings.sortWithinPartitions("term", "d", "pos"), "positional-index")


@dataclass(frozen=True)
class Windows:
    """Test texts prepared for the search; all frames are stored.

    ``texts``: t, n, terms, windows (q0 and the place q1 of the rarest word), each
    distinct text once.  ``members``: t, item.  ``seeds``: t, q1, term, q2, term2,
    the two rarest words of its windows (q2 NULL where there is one word only).
    """

    texts: DataFrame
    members: DataFrame
    seeds: DataFrame
    size: int


def search_windows(index: DataFrame, tests: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = 10) -> Windows:
    """The windows of ``size`` words of the tests whose words all occur in the index.

    A text of fewer words is one window, one without words has none.  Ids are
    taken as strings, NULL as ''.  Of words equally rare the first counts.
    """
    items = once(
        tests.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")),
        terms=F.transform(lower_words(F.col("text")), lambda w: F.xxhash64(w)),
    ).filter(F.size("terms") > 0)
    items = materialize(items.select("item", "terms"), "test-items")
    texts = materialize(
        items.select("terms").distinct().select(F.monotonically_increasing_id().alias("t"), "terms"), "test-texts"
    )
    members = materialize(items.join(texts, "terms").select("t", "item").distinct(), "test-members")

    places = texts.select("t", F.size("terms").alias("n"), F.posexplode("terms").alias("q", "term"))
    counts = index.filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("occurrences"))
    counted = places.join(counts, "term")
    last = F.greatest(F.col("n") - size, F.lit(0))
    windows = counted.select(
        "t", "n", "q", "term", "occurrences",
        F.explode(F.sequence(F.greatest(F.col("q") - size + 1, F.lit(0)), F.least(F.col("q"), last))).alias("q0"),
    )
    rarest = windows.groupBy("t", "n", "q0").agg(
        F.count(F.lit(1)).alias("present"), F.sort_array(F.collect_list(F.struct("occurrences", "q", "term"))).alias("words")
    )
    rarest = materialize(
        rarest.filter(F.col("present") == F.least(F.col("n"), F.lit(size))).select(
            "t", "q0", F.col("words")[0].alias("first"), F.get("words", F.lit(1)).alias("second")
        ),
        "test-windows",
    )
    seeds = rarest.select(
        "t", F.col("first.q").alias("q1"), F.col("first.term").alias("term"),
        F.col("second.q").alias("q2"), F.col("second.term").alias("term2"),
    ).distinct()
    by_text = rarest.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("q0", F.col("first.q").alias("q1")))).alias("windows"))
    prepared = texts.join(by_text, "t").select("t", F.size("terms").alias("n"), "terms", "windows")
    return Windows(materialize(prepared, "test-texts"), members, materialize(seeds, "test-seeds"), size)


def _places(slack: int) -> Column:
    """Where a word may stand, seen from where the phrase would have it."""
    return F.explode(F.array(*[F.lit(e) for e in range(-slack, slack + 1)]))


def _runs(places: str) -> Column:
    """First and last number of each run of consecutive ones in a sorted array."""
    first = F.filter(places, lambda p, i: (i == 0) | (F.get(F.col(places), i - 1) != p - 1))
    last = F.filter(places, lambda p, i: (i == F.size(places) - 1) | (F.get(F.col(places), i + 1) != p + 1))
    return F.arrays_zip(first.alias("first"), last.alias("last"))


def alignments(index: DataFrame, tests: Windows, slack: int = 0) -> DataFrame:
    """Stored ``t, d, start, runs, near``: test text t, laid on row d so that its first word is at place ``start``.

    ``runs`` are the longest stretches of test words (first, last) that hold a
    whole window and stand in the row word for word.  ``near`` are the first words
    of all windows that hold within ``slack``: the rarest word in its place, each other
    word at most ``slack`` places from its own.  Alignments without either are left out.
    """
    postings = index.filter("term IS NOT NULL").select("term", "d", "pos")
    both = tests.seeds.select("term").union(tests.seeds.filter("term2 IS NOT NULL").select("term2"))
    lists = materialize(among(postings, both, "term"), "rare-lists")

    # The rarest word's list, moved back to the test text's begin, then the next rarest word's list on top of it.
    began = lists.join(tests.seeds, "term").select("t", "d", (F.col("pos") - F.col("q1")).alias("start"), "q2", "term2")
    wanted = began.filter("q2 IS NOT NULL").select("t", "d", "start", "q2", F.col("term2").alias("term"), _places(slack).alias("off"))
    agreed = wanted.withColumn("pos", F.col("start") + F.col("q2") + F.col("off")).join(lists, ["term", "d", "pos"], "left_semi")
    alone = began.filter("q2 IS NULL").select("t", "d", "start")
    candidates = materialize(agreed.select("t", "d", "start").union(alone).distinct(), "phrase-candidates")

    words = tests.texts.select("t", F.posexplode("terms").alias("q", "term"))
    own = among(among(postings, words, "term"), candidates, "d")
    probes = candidates.join(words, "t").select("*", _places(slack).alias("off"))
    hits = probes.withColumn("pos", F.col("start") + F.col("q") + F.col("off")).join(own, ["d", "pos", "term"])
    # As many entries as the test text has words, 2 * slack + 1 times at most.
    found = hits.groupBy("t", "d", "start").agg(
        F.sort_array(F.collect_set(F.when(F.col("off") == 0, F.col("q")))).alias("exact"),
        F.sort_array(F.collect_set("q")).alias("close"),
    )
    laid = found.join(tests.texts.select("t", "n", "windows"), "t").withColumn("width", F.least(F.col("n"), F.lit(tests.size)))
    laid = once(laid, runs=_runs("exact"), close_runs=_runs("close"))
    runs = F.filter("runs", lambda r: r["last"] - r["first"] + 1 >= F.col("width"))
    inside = lambda w: F.exists(
        "close_runs", lambda r: (r["first"] <= w["q0"]) & (w["q0"] + F.col("width") - 1 <= r["last"])
    )
    near = F.transform(
        F.filter("windows", lambda w: inside(w) & F.array_contains(F.col("exact"), w["q1"])), lambda w: w["q0"]
    )
    kept = once(laid, whole=runs, near=near).filter((F.size("whole") > 0) | (F.size("near") > 0))
    return materialize(kept.select("t", "d", "start", "width", F.col("whole").alias("runs"), "near"), "alignments")


def phrase_matches(
    docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", size: int = 10, slack: int = 2,
) -> DataFrame:
    """``doc_id, item, kind, doc_word, item_word, n_words`` for all matches.

    Kind 'phrase': a longest run of words that stands word for word in both texts and
    holds a window.  Kind 'near': a window that holds within ``slack`` and is not part
    of such a run of the same alignment (see ``alignments``).
    """
    index = positional_index(docs, id_col, text_col)
    windows = search_windows(index, tests, item_col, item_text_col, size)
    laid = alignments(index, windows, slack)
    phrase = laid.select("t", "d", "start", F.lit("phrase").alias("kind"), F.inline("runs")).select(
        "t", "d", "start", "kind", F.col("first").alias("item_word"), (F.col("last") - F.col("first") + 1).alias("n_words")
    )
    whole = lambda q: F.exists("runs", lambda r: (r["first"] <= q) & (q + F.col("width") - 1 <= r["last"]))
    loose = F.explode(F.filter("near", lambda q: ~whole(q)))
    near = laid.select("t", "d", "start", F.lit("near").alias("kind"), loose.alias("item_word"), F.col("width").alias("n_words"))
    ids = index.filter("term IS NULL").select("d", "doc_id")
    return (
        phrase.unionByName(near).join(windows.members, "t").join(ids, "d")
        .select("doc_id", "item", "kind", (F.col("start") + F.col("item_word")).alias("doc_word"), "item_word", "n_words")
    )


def contamination(
    docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", size: int = 10, slack: int = 2,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, items, n_near.

    ``n_hit`` counts words inside any occurrence of a test window, ``items`` are the
    sorted ids of the tests whose windows occur, ``n_near`` counts the tests with a
    window that occurs or nearly does.  Repeated rows all come out, with equal values;
    NULL and empty texts have no words; tests with equal texts or ids are one text or
    id; empty tables on either side give no hits.  Other columns are not read.
    """
    index = positional_index(docs, id_col, text_col)
    windows = search_windows(index, tests, item_col, item_text_col, size)
    laid = alignments(index, windows, slack)

    # Words covered: stretches by their begin, each counted from where those before it end.
    spans = laid.select("d", "start", F.inline("runs")).select(
        "d", (F.col("start") + F.col("first")).alias("begin"), (F.col("start") + F.col("last") + 1).alias("end")
    )
    spans = spans.groupBy("d", "begin").agg(F.max("end").alias("end"))
    by_doc = spans.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    fresh = lambda acc, s: F.greatest(s["end"] - F.greatest(s["begin"], acc["upto"]), F.lit(0))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), (acc["n"] + fresh(acc, s)).alias("n")),
    )
    hit = by_doc.select("d", covered["n"].alias("n_hit"))

    per_text = laid.groupBy("d", "t").agg(F.max(F.size("runs") > 0).alias("occurs"))
    named = per_text.join(windows.members, "t").groupBy("d").agg(
        F.sort_array(F.collect_set(F.when(F.col("occurs"), F.col("item")))).alias("items"),
        F.size(F.collect_set("item")).cast("long").alias("n_near"),
    )
    found = materialize(named.join(hit, "d", "left"), "contaminated")
    none = F.array().cast("array<string>")
    return (
        index.filter("term IS NULL").select("d", "doc_id", "n_words").join(found, "d", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )
