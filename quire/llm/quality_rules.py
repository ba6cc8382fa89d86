"""Quality rules: decision lists learned from labelled statistics.

Sequential covering grows a conjunction of thresholds that picks out bad
documents, prunes it on rows set aside, keeps it if it is precise there, removes
the rows it covers and goes on.  What comes out is an ordered list of rules, and
from it one conditional expression that Spark evaluates over all documents.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.common import free_name

# At most so many labelled documents are used for learning; statistics and verdicts cover all documents.
MAX_LABELLED = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
SYMBOLS = b"#*$%&|<>"
_NOT_STARTS = bytes(range(0x80, 0xC0)) + b" \t\n\x0b\f\r"  # within a code point, or blank

Rule = list[tuple[str, str, float]]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more, each counted once."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = len(number)
    if size == n:
        return 0
    pairs = ids[:-1] * size + ids[1:]
    if size > 2**21:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    _, group, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[group] > 1
    covered = np.zeros(n, bool)
    for at in range(3):
        covered[at : n - 2 + at] |= again
    return int(covered.sum())


def statistics_of(text: bytes | None) -> tuple[int, ...]:
    """COUNTS of one text."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _NOT_STARTS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        text.count(b"!"),
    )


def text_statistics(text: Column) -> Column:
    """A struct of COUNTS; NULL is an empty text.

    n_words and word_chars (code points) of the words; n_symbols, characters of
    ``#*$%&|<>``; n_dup_lines, lines with a word that equal an earlier one;
    n_repeat_words; n_lines, lines with a word; n_upper, A to Z; n_marks, ``!``.
    """
    kind = pa.struct([(c, pa.int64()) for c in COUNTS])

    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(texts: pa.Array) -> pa.Array:
        found = [statistics_of(t.as_buffer().to_pybytes() if t.is_valid else None) for t in texts]
        columns = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * len(COUNTS)
        return pa.StructArray.from_arrays(columns, fields=list(kind))

    return counts(text)


def _features(count) -> dict:
    """What thresholds are set on, from counts as Columns or as numpy arrays."""
    words = count("n_words") * 1.0 + 1.0
    chars = count("word_chars") * 1.0 + 1.0
    return {
        "n_words": count("n_words") * 1.0,
        "chars_a_word": count("word_chars") / words,
        "symbols_a_word": count("n_symbols") / words,
        "dup_line_share": count("n_dup_lines") / (count("n_lines") * 1.0 + 1.0),
        "repeat_share": count("n_repeat_words") / words,
        "upper_share": count("n_upper") / chars,
        "marks_a_word": count("n_marks") / words,
    }


def base_failed(stats: Column) -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (stats["n_words"] < 50) | (stats["n_repeat_words"] * 100 > stats["n_words"] * 50)


# --- learning -------------------------------------------------------------------


def _holds(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for name, side, value in rule:
        out &= x[name] >= value if side == ">=" else x[name] < value
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    """Add the threshold with the most information gained (FOIL) until only bad rows are left."""
    rule: Rule = []
    inside = np.ones(len(bad), bool)
    while len(rule) < max_conditions and (inside & ~bad).any():
        p0 = (inside & bad).sum()
        purity = np.log2(p0 / inside.sum())
        best = (1e-9, None)
        for name, values in x.items():
            cuts = np.unique(np.quantile(values[inside], np.linspace(0, 1, 65)[1:-1]))
            # Between the bad and the good rows next to each cut, not on one of them.
            order = np.unique(values[inside])
            at = np.searchsorted(order, cuts)
            cuts = np.unique((order[np.maximum(at - 1, 0)] + order[np.minimum(at, len(order) - 1)]) / 2)
            above = values[:, None] >= cuts[None, :]
            for side, hit in ((">=", above), ("<", ~above)):
                hit = hit & inside[:, None]
                p, every = (hit & bad[:, None]).sum(0), hit.sum(0)
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(every, 1)) - purity), 0)
                top = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[top] > best[0]:
                    best = (gain[top], (name, side, float(cuts[top])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside = _holds(rule, x, len(bad))
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The start of the rule that does best on rows it was not grown on, its precision and what it covers there."""
    best: tuple[Rule, float, int] = ([], 0.0, 0)
    for n in range(len(rule), 0, -1):
        hit = _holds(rule[:n], x, len(bad))
        p, covered = int((hit & bad).sum()), int(hit.sum())
        precision = p / covered if covered else 0.0
        if covered and precision >= best[1]:
            best = (rule[:n], precision, covered)
    return best


def learn_decision_list(
    rows: pd.DataFrame,
    min_precision: float = 0.95,
    min_covered: int = 5,
    max_rules: int = 20,
    max_conditions: int = 4,
) -> list[Rule]:
    """Ordered rules for bad rows from COUNTS and ``bad`` (bool); none if a class is missing.

    Every third row is set aside for pruning.  A rule stays if it covers
    ``min_covered`` of these with ``min_precision`` or better; the first that
    doesn't ends the list.
    """
    bad = rows["bad"].to_numpy(bool)
    x = _features(lambda c: rows[c].to_numpy(np.float64)) if len(rows) else {}
    aside = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grow, prune = left & ~aside, left & aside
        if not (bad & grow).any() or not (~bad & grow).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], max_conditions)
        rule, precision, covered = _prune(rule, {k: v[prune] for k, v in x.items()}, bad[prune])
        if not rule or precision < min_precision or covered < min_covered:
            break
        rules.append(rule)
        left &= ~_holds(rule, x, len(bad))
    return rules


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_LABELLED
) -> DataFrame:
    """doc_id, COUNTS and bad for labelled documents, ``max_rows`` of them at most, taken in order of the id's hash.

    A document with conflicting labels is bad; labels that are neither 0 nor 1
    and labels without a document are left out.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # At most max_rows ids are broadcast; the texts stay where they lie.
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    stats = joined.select("doc_id", text_statistics(F.col("text")).alias("stats"), (F.col("quality") == 0).alias("bad"))
    once = stats.groupBy("doc_id").agg(F.min("stats").alias("stats"), F.max("bad").alias("bad"))
    return once.select("doc_id", "stats", "bad")


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> list[Rule]:
    """Learn from labelled documents that pass ``base_failed``.  The bounded sample is learned from on the driver."""
    sample = labelled_statistics(docs, labels, id_col, text_col)
    rows = sample.filter(~base_failed(F.col("stats"))).select("doc_id", "stats.*", "bad").toPandas()
    return learn_decision_list(rows.sort_values("doc_id", ignore_index=True), **how)


# --- verdicts -------------------------------------------------------------------


def rule_expression(rules: list[Rule], stats: Column) -> Column:
    """Number (from 1) of the first rule that holds, else NULL."""
    features = _features(lambda c: stats[c])
    chosen = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        terms = [features[name] >= value if side == ">=" else features[name] < value for name, side, value in rule]
        chosen = F.when(reduce(lambda a, b: a & b, terms), F.lit(number)).otherwise(chosen)
    return chosen


def describe_rules(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{name} {side} {value:.6g}" for name, side, value in rule) for rule in rules]


def judged(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of COUNTS, base_failed, rule and kept; and the column's name."""
    name, stats = free_name(docs, "quality_verdict"), free_name(docs, "quality_stats")
    with_stats = docs.withColumn(stats, text_statistics(F.col(text_col)))
    s = F.col(stats)
    rule = rule_expression(rules, s)
    verdict = F.struct(
        *[s[c].alias(c) for c in COUNTS],
        base_failed(s).alias("base_failed"),
        F.when(~base_failed(s), rule).alias("rule"),
        (~base_failed(s) & rule.isNull()).alias("kept"),
    )
    return with_stats.withColumn(name, verdict).drop(stats), name


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, COUNTS, base_failed, rule and kept for every row of ``docs``.

    NULL and empty texts have no words and fail.  Without labels of both kinds
    there are no rules, and what passes the base is kept.
    """
    out, name = judged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), fit_rules(docs, labels, id_col, text_col, **how))
    return out.select("doc_id", f"{name}.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` that are kept, with their columns."""
    out, name = judged(docs, fit_rules(docs, labels, id_col, text_col, **how), text_col)
    return out.filter(F.col(name)["kept"]).select(*docs.columns)
