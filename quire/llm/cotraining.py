"""Quality classifier by co-training.

Two classifiers see different views of a document: the text's own make-up, and
its metadata (source, language, length).  In each round either labels the
documents it is surest of for the other.  In the end both are calibrated on
labelled documents that neither was trained on, and combined.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.quality_rules import statistics_of
from quire.session import materialize

# Fitting uses at most so many labelled documents, and all that have no label.
MAX_LABELLED = 10_000
# Tasks' sums are added up in so many groups before they come to the driver.
GATHERED = 8

BIGRAMS = 256
SOURCES, LANGS, LENGTHS = 64, 16, 32
N_STATS = 9


def text_view(text: bytes | None) -> np.ndarray:
    """Shares of word and character kinds, and of hashed byte pairs."""
    text = text or b""
    n_words, chars, symbols, dup_lines, repeats, lines, upper, marks = statistics_of(text)
    words, size = n_words + 1.0, chars + 1.0
    stats = [
        np.log1p(n_words) / 5, chars / words / 10, min(symbols / words, 4), dup_lines / (lines + 1.0), repeats / words,
        upper / size, min(marks / words, 4), sum(map(text.count, b"0123456789")) / size, len(set(text.split())) / words,
    ]
    data = np.frombuffer(text, np.uint8)
    pairs = np.bincount((data[:-1].astype(np.uint16) * 167 + data[1:]) % BIGRAMS, minlength=BIGRAMS) if len(data) > 1 else np.zeros(BIGRAMS)
    return np.concatenate([[1.0], stats, np.sqrt(pairs / max(1, len(data)))]).astype(np.float32)


def _cell(value: str | None, cells: int) -> int:
    """A category's cell; NULL has the first for itself."""
    return 0 if value is None else 1 + zlib.crc32(value.encode()) % (cells - 1)


def meta_view(source: str | None, lang: str | None, length: int | None) -> np.ndarray:
    """Indicators of source, language and length (an eighth of a decade, NULL apart)."""
    out = np.zeros(1 + SOURCES + LANGS + LENGTHS, np.float32)
    span = 0 if length is None else 1 + min(LENGTHS - 2, int(4 * np.log10(max(1, length))))
    out[[0, 1 + _cell(source, SOURCES), 1 + SOURCES + _cell(lang, LANGS), 1 + SOURCES + LANGS + span]] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


class CoTrained:
    """Two views' weights, their calibration, and the weights that combine them."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, calibration: list[np.ndarray], mix: np.ndarray):
        self.text, self.meta, self.calibration, self.mix = text, meta, calibration, mix

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of being good: by text, by metadata, by both."""
        raw = [text @ self.text, meta @ self.meta]
        logits = [np.clip(c[0] + c[1] * z, -30, 30) for c, z in zip(self.calibration, raw)]
        both = self.mix[0] + self.mix[1] * logits[0] + self.mix[2] * logits[1]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(both)


# Bins of logits, from -EDGE to EDGE: thresholds are bins, so rows of one bin are taken together.
EDGE, BINS = 30.0, 6000


def _bins(z: np.ndarray) -> np.ndarray:
    return np.minimum(((np.clip(z, -EDGE, EDGE) + EDGE) * (BINS / (2 * EDGE))).astype(np.int64), BINS - 1)


def thresholds(counts: np.ndarray, rate: float, share: float, confidence: float) -> tuple[int, int]:
    """The last bin that counts as bad and the first that counts as good, of logits counted by bin.

    Each kind gets at most ``share`` of all rows, in proportion to ``rate``; the
    outermost bin that holds rows is taken whole.  None is less sure than ``confidence``.
    """
    logit = np.log(confidence / (1 - confidence))
    surest = np.flatnonzero(counts)
    wanted = share * counts.sum()
    high = int(np.argmax(np.append(np.cumsum(counts[::-1])[::-1], 0) <= wanted * rate))
    low = BINS - 1 - int(np.argmax(np.append(np.cumsum(counts)[::-1], 0) <= wanted * (1 - rate)))
    high, low = (min(high, surest[-1]), max(low, surest[0])) if len(surest) else (BINS, -1)
    sure_good, sure_bad = _bins(np.array([logit, -logit]))
    return int(min(low, sure_bad - 1)), int(max(high, sure_good + 1))


def told(rules: list, views: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """What each view was told of rows: 1, 0, or NaN for nothing.  The first round that says something counts.

    Follows from the weights and thresholds of past rounds alone: no state is kept for a row.
    """
    out = [np.full(len(views[0]), np.nan) for _ in views]
    for by_view in rules:
        for v, (w, low, high) in enumerate(by_view):
            b, other = _bins(views[v] @ w), out[1 - v]
            fresh = np.isnan(other)
            other[fresh & (b >= high)] = 1.0
            other[fresh & (b <= low)] = 0.0
    return out


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of the logistic loss over rows, in one array; those of parts add up."""
    p = _sigmoid(x @ w)
    return np.concatenate([x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])


def pool_counts(views: tuple[np.ndarray, np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """Rows by bin of either view's logit."""
    return np.concatenate([np.bincount(_bins(x @ w), minlength=BINS) for x, w in zip(views, weights)]).astype(np.float64)


def pool_sums(views: tuple[np.ndarray, np.ndarray], weights: list[np.ndarray], rules: list) -> np.ndarray:
    """Both views' sums over the rows that they were told of."""
    known = told(rules, views)
    return np.concatenate([newton_sums(x[~np.isnan(y)], y[~np.isnan(y)], w) for x, y, w in zip(views, known, weights)])


def co_train(
    text: np.ndarray, meta: np.ndarray, good: np.ndarray, pool: Callable[..., np.ndarray],
    rounds: int = 5, share: float = 0.05, confidence: float = 0.95, steps: int = 3,
) -> CoTrained:
    """Fit on labelled rows (every fourth only calibrates) and a pool without labels.

    In each round, each view hands the other the ``share`` of the pool that it is
    surest of (``thresholds``), and both are fitted again by ``steps`` steps of
    Newton's method.  ``pool(function, *arguments)`` gives the sum of
    ``function(views, *arguments)`` over all parts of the pool, wherever they lie.
    Labels of one kind only give that kind's share for all rows.
    """
    fit = np.arange(len(good)) % 4 != 3
    mixed = fit.any() and not fit.all() and 0 < good[fit].mean() < 1 and 0 < good[~fit].mean() < 1
    if not mixed:
        rate = float(np.clip(good.mean(), 1e-3, 1 - 1e-3)) if len(good) else 0.5
        flat = np.array([np.log(rate / (1 - rate)), 0.0])
        return CoTrained(np.zeros(text.shape[1]), np.zeros(meta.shape[1]), [flat, flat], np.array([flat[0], 0.0, 0.0]))
    rate, views = float(good[fit].mean()), (text, meta)
    weights = [logistic(x[fit], good[fit]) for x in views]
    rules: list = []
    for _ in range(rounds):
        counts = np.split(pool(pool_counts, weights), 2)
        if not counts[0].sum():
            break
        rules.append([(w, *thresholds(c, rate, share, confidence)) for w, c in zip(weights, counts)])
        for _ in range(steps):
            far = pool(pool_sums, weights, rules)
            parts = np.split(far, [len(weights[0]) * (1 + len(weights[0]))])
            for v, w in enumerate(weights):
                sums, size = newton_sums(views[v][fit], good[fit], w) + parts[v], len(w)
                slope, bend = sums[:size] + w, sums[size:].reshape(size, size) + np.eye(size)
                weights[v] = w - np.linalg.solve(bend, slope)
    held, calibration, logits = good[~fit], [], []
    for v in (0, 1):
        raw = views[v][~fit] @ weights[v]
        c = logistic(np.stack([np.ones(len(raw)), raw], 1), held, ridge=0.1)
        calibration.append(c)
        logits.append(np.clip(c[0] + c[1] * raw, -30, 30))
    mix = logistic(np.stack([np.ones(len(held)), *logits], 1), held, ridge=0.1)
    return CoTrained(weights[0], weights[1], calibration, mix)


# --- Spark ----------------------------------------------------------------------


def _views(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of (text, source, lang, length) rows."""
    if not rows:
        return np.zeros((0, TEXT_WIDTH)), np.zeros((0, META_WIDTH))
    return np.stack([text_view(t) for t, *_ in rows]), np.stack([meta_view(*m) for _, *m in rows])


def _tuples(text: pa.Array, *meta: pa.Array):
    texts = [t.as_buffer().to_pybytes() if t.is_valid else None for t in text]
    return list(zip(texts, *[m.to_pylist() for m in meta]))


TEXT_WIDTH, META_WIDTH = 1 + N_STATS + BIGRAMS, 1 + SOURCES + LANGS + LENGTHS


def _both_views(*columns: Column) -> Column:
    """Both views in one array of half-precision numbers, as bytes."""

    @F.arrow_udf("binary")
    def views(text: pa.Array, source: pa.Array, lang: pa.Array, length: pa.Array) -> pa.Array:
        both = np.concatenate(_views(_tuples(text, source, lang, length)), axis=1).astype(np.float16)
        return pa.array([row.tobytes() for row in both], pa.binary())

    return views(*columns)


def _unpacked(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(rows.to_pylist()), np.float16).reshape(-1, TEXT_WIDTH + META_WIDTH).astype(np.float64)
    return data[:, :TEXT_WIDTH], data[:, TEXT_WIDTH:]


def _summed(rows: DataFrame, function: Callable[..., np.ndarray], *arguments) -> np.ndarray:
    """The sum of ``function`` over all batches of ``views``: in tasks, then in a few groups, then here."""
    size = len(function(_unpacked(pa.array([], pa.binary())), *arguments))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += function(_unpacked(batch.column(0)), *arguments)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = rows.select("views").mapInArrow(of_task, "part binary").repartition(GATHERED).mapInArrow(added, "part binary")
    return sum((np.frombuffer(r["part"]) for r in parts.collect()), np.zeros(size))


def _columns(text_col: str, source_col: str, lang_col: str) -> list[Column]:
    length = F.length(F.col(text_col)).cast("long")
    return [F.col(text_col), F.col(source_col).cast("string"), F.col(lang_col).cast("string"), length]


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", max_labelled: int = MAX_LABELLED, **how,
) -> CoTrained:
    """Fit on a bounded sample of labelled documents and on all documents without a label.

    The sample is taken in order of a hash of the id, and its features come to
    the driver.  The features of all documents are worked out once and stored
    (758 bytes each); of documents without label only sums leave the tasks.  A
    document with conflicting labels counts as bad; labels other than 0 and 1
    are left out; of labelled rows that share an id one is used, of others each
    counts.  Rows without an id are not used.
    """
    docs = docs.filter(F.col(id_col).isNotNull())
    views = docs.select(F.col(id_col).alias("doc_id"), _both_views(*_columns(text_col, source_col, lang_col)).alias("views"))
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled).select("label_id", F.lit(True).alias("chosen"))
    known = materialize(known.join(F.broadcast(chosen), "label_id", "left"), "cotraining-labels")
    # Features, not texts, meet the labels.
    stored = materialize(views.join(known, F.col("doc_id") == F.col("label_id"), "left"), "cotraining-views")
    found = stored.filter("chosen").select("label_id", "quality", "views").toArrow()
    # One row of each id, and not in order of the id: the split into parts must not follow it.
    ids = found.select(["label_id", "views"]).append_column("row", pa.array(np.arange(found.num_rows)))
    first = ids.to_pandas().sort_values(["label_id", "views"]).drop_duplicates("label_id")["row"].to_numpy(dtype=np.int64)
    order = first[np.random.default_rng(0).permutation(len(first))]
    text, meta = _unpacked(found["views"])
    quality = found["quality"].to_numpy().astype(np.float64)
    pool = stored.filter("label_id IS NULL")
    return co_train(text[order], meta[order], quality[order], lambda function, *given: _summed(pool, function, *given), **how)


def score_quality(
    docs: DataFrame, model: CoTrained, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", threshold: float = 0.5,
) -> DataFrame:
    """doc_id, text_score, meta_score, score, kept for every row of ``docs``.

    Scores are probabilities of good quality; ``kept`` if the combined one
    reaches ``threshold``.  NULL texts count as empty, NULL metadata as a
    category of its own; an empty table gives no rows.
    """

    @F.arrow_udf("text_score double, meta_score double, score double")
    def scored(text: pa.Array, source: pa.Array, lang: pa.Array, length: pa.Array) -> pa.Array:
        columns = model.scores(*_views(_tuples(text, source, lang, length)))
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["text_score", "meta_score", "score"])

    out = docs.select(F.col(id_col).alias("doc_id"), scored(*_columns(text_col, source_col, lang_col)).alias("s"))
    return out.select("doc_id", "s.*", (F.col("s.score") >= threshold).alias("kept"))
