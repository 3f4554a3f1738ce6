"""Quality classifier: Naive Bayes support vectors.

A text's features are n-gram indicators: hashed words, and one to three
consecutive word shapes (case, digits, symbols, closing mark, equal to the
word before), with the binned shares of those shapes over the whole text.
Each indicator is scaled by its class log-count ratio; on the scaled
indicators a linear hinge-loss model is fitted by dual coordinate descent, its
weights are interpolated with their mean magnitude, and a logistic curve fitted
on margins of held-back rows turns a margin into a score.

The fit uses a bounded sample of labelled rows, ``MAX_ROWS`` by hash order of
doc_id; every document is scored over its whole text.

Defined cases: a NULL or empty text has only its length bin and still gets a
score; labelled rows with a NULL quality or id are not learned from; of
several labels of one document the highest counts; without both classes in
the sample every score is the share of class 1 (0.5 without labels); a NULL
doc_id is never held out; an empty table yields no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, text_slices
from .words import Words, mix, words

#: Labelled rows that the model is fitted on at most.
MAX_ROWS = 8000
FOLDS = 5
THRESHOLD = 0.3
WORD_BITS = 18
SHAPES = 32
_BINS = 16
_SHARES = 10

N_WORDS = 1 << WORD_BITS
N_SHAPES = SHAPES ** 3
N_FEATURES = N_WORDS + N_SHAPES + _SHARES * _BINS
#: Texts whose words are handled at once, in bytes.
SLICE_BYTES = 2_000_000

_LOWER, _UPPER, _DIGIT, _SYMBOL, _OTHER = range(5)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[97:123] = _LOWER
_CLASS[65:91] = _UPPER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _OTHER


def _word_shapes(w: Words, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A shape from 1 to ``SHAPES - 1`` for each word, and the marks it is made of."""
    kind = _CLASS[w.data]

    def n(which: int) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(kind == which, dtype=np.int32)))
        return total[w.ends] - total[w.starts]

    lower, upper, digit, symbol, other = (n(k) for k in range(5))
    length = w.ends - w.starts
    letters = lower + upper + other
    shouted = (upper >= 2) & (lower == 0)
    case = np.where(letters == 0, np.where(digit > 0, 3, 4), np.where(shouted, 2, (upper > 0).astype(int)))
    closing = np.isin(w.data[w.ends - 1], np.frombuffer(b".,;:!?", np.uint8))
    inside = symbol - closing > 0
    same = np.zeros(len(length), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first] = False
    shape = 1 + case + 5 * (np.where(symbol > 1, 2, closing.astype(int)))
    shape = np.where(same, 16 + case, shape)
    shape = np.where(inside & ~same & (letters > 0), 21 + 2 * case + (symbol * 3 > length), shape)
    marks = {"shouted": shouted, "same": same, "symbols": letters + digit == 0, "digits": digit > 0, "inside": inside,
             "closing": closing, "capital": case == 1, "short": length <= 2, "long": length >= 15}
    return shape, marks


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of all texts in a row, and how many each text has."""
    w = words(texts)
    n_texts = len(w.counts)
    text = np.repeat(np.arange(n_texts), w.counts)
    first = np.cumsum(w.counts) - w.counts
    keys = []
    shares = np.zeros((n_texts, _SHARES), np.int64)
    shares[:, 0] = np.minimum(np.log2(w.counts + 1), _BINS - 1).astype(np.int64)
    if len(text):
        hashes = w.hashes()
        at = first[w.counts > 0]
        shape, marks = _word_shapes(w, hashes, at)
        keys.append(text * N_FEATURES + (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))
        one = shape.astype(np.int64)
        two, three = np.zeros_like(one), np.zeros_like(one)
        two[1:] = one[:-1] * SHAPES
        two[at] = 0
        three[2:] = one[:-2] * SHAPES ** 2
        three[at] = 0
        second = at + 1
        three[second[second < len(three)]] = 0
        for gram in (one, one + two, one + two + three):
            keys.append(text * N_FEATURES + N_WORDS + gram)
        for k, mark in enumerate(marks.values(), 1):
            share = np.bincount(text[mark], minlength=n_texts) / np.maximum(w.counts, 1)
            # bins that double: none, up to 1/512, ..., up to all
            shares[:, k] = np.where(share > 0, np.ceil(np.log2(np.maximum(share, 1e-9) * 512)).clip(0, 9) + 1, 0)
    own = np.arange(n_texts)[:, None] * N_FEATURES + N_WORDS + N_SHAPES + np.arange(_SHARES) * _BINS + shares
    keys.append(own.ravel())
    found = np.unique(np.concatenate(keys))
    return found % N_FEATURES, np.bincount(found // N_FEATURES, minlength=n_texts)


@dataclass
class Rows:
    """Feature numbers of labelled rows: row i has ``features[ends[i] - counts[i]:ends[i]]``."""

    features: np.ndarray
    counts: np.ndarray
    labels: np.ndarray

    def take(self, at: np.ndarray) -> Rows:
        ends = np.cumsum(self.counts)
        runs = [self.features[ends[i] - self.counts[i]:ends[i]] for i in at]
        return Rows(np.concatenate(runs) if runs else self.features[:0], self.counts[at], self.labels[at])


@dataclass
class Model:
    """``margin``: bias plus weights of a text's features, over the length of its scaled indicators.

    ``score`` is logistic in the margin.
    """

    weights: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float = 0.0
    shift: float = 0.0

    def margins(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(counts)), counts)
        length = np.sqrt(1 + np.bincount(row, self.ratio[found] ** 2, len(counts)))
        return (self.bias + np.bincount(row, self.weights[found], len(counts))) / length

    def scores(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = self.slope * self.margins(found, counts) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_count_ratio(rows: Rows, alpha: float = 1.0) -> np.ndarray:
    """Log ratio of an indicator's share in class 1 to that in class 0; 0 if in neither."""
    label = np.repeat(rows.labels, rows.counts)
    p, q = (np.bincount(rows.features[label == k], minlength=N_FEATURES) / max((rows.labels == k).sum(), 1)
            for k in (1, 0))
    least = alpha / max(len(rows.labels), 1)
    return np.log((p + least) / (q + least))


def fit_linear(rows: Rows, cost: float = 1.0, passes: int = 12, mean_share: float = 0.25, seed: int = 0) -> Model:
    """Hinge loss by dual coordinate descent on indicators scaled by the log-count ratio.

    Rows are scaled to unit length and each class weighs the same in total.
    """
    ratio = log_count_ratio(rows)
    ends = np.cumsum(rows.counts)
    at = [rows.features[e - n:e] for e, n in zip(ends, rows.counts, strict=True)]
    x = [ratio[a] for a in at]
    norm = [float(np.sqrt((v * v).sum() + 1)) for v in x]
    x = [v / s for v, s in zip(x, norm, strict=True)]
    y = np.where(rows.labels == 1, 1.0, -1.0)
    most = cost * len(y) / 2 / np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    w, b, dual = np.zeros(N_FEATURES), 0.0, np.zeros(len(y))
    order = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (w[at[i]] @ x[i] + b / norm[i]) - 1
            new = min(max(dual[i] - gradient, 0.0), most[i])
            step = (new - dual[i]) * y[i]
            if step:
                w[at[i]] += step * x[i]
                b += step / norm[i]
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    w = (1 - mean_share) * np.abs(w).mean() + mean_share * w if mean_share < 1 else w
    return Model(w * ratio, ratio, b * mean_share)


def fit_logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with the targets drawn in as for few rows (Newton's method)."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = margins.std() or 1.0
    z = np.column_stack((margins / scale, np.ones(len(margins))))
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -40, 40)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), z.T @ (target - p))
        theta += step
        if np.abs(step).max() < 1e-6:
            break
    return max(theta[0] / scale, 1e-6), theta[1]


def fit(rows: Rows) -> Model:
    """The model of all rows; its logistic curve comes from margins of rows that a half did not see."""
    share = rows.labels.mean() if len(rows.labels) else 0.5
    if not 0 < rows.labels.sum() < len(rows.labels) or min(rows.labels.sum(), (1 - rows.labels).sum()) < 4:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.0, float(np.log(share / (1 - share))))
    margins = np.zeros(len(rows.labels))
    order = np.argsort(rows.labels, kind="stable")
    for half in (order[::2], order[1::2]):
        rest = np.setdiff1d(order, half)
        seen = rows.take(half)
        unseen = rows.take(rest)
        margins[rest] = fit_linear(seen).margins(unseen.features, unseen.counts)
    slope, shift = fit_logistic(margins, rows.labels)
    model = fit_linear(rows)
    return Model(model.weights, model.ratio, model.bias, slope, shift)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def sample_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Rows:
    """Features of a bounded sample of labelled rows outside the held-out part."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    own = own.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    some = own.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # ``some`` is bounded by max_rows
    picked = texts.join(F.broadcast(some), "doc_id").select("doc_id", "quality", "text")

    def found(batches):
        for batch in batches:
            for part in text_slices(batch, most=SLICE_BYTES):
                at, counts = features(part.column("text").fill_null(""))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), lists], names=["doc_id", "quality", "features"])

    rows = picked.mapInArrow(found, "doc_id bigint, quality int, features array<int>").toArrow().sort_by("doc_id")
    lists = rows.column("features").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    if not len(rows):
        return Rows(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    return Rows(lists.flatten().to_numpy().astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64),
                np.minimum(rows.column("quality").to_numpy(), 1).astype(np.int64))


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, and its columns named in ``keep``."""
    fitted = fit(sample_rows(docs, labels, max_rows))
    release()  # the fit runs in the driver, whose later stages need that memory
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    text = "text" if "text" in keep else "_text"
    own = [F.col("doc_id").cast("long").alias("_doc_id"), held_out(F.col("doc_id").cast("long")).alias("_held_out")]
    if text not in keep:
        own.append(F.col("text").cast("string").alias(text))
    rows = docs.select(*own, *keep)
    named = [] if "doc_id" in keep else ["doc_id bigint"]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keep]

    def scored(batches):
        for batch in batches:
            for part in text_slices(batch, text, SLICE_BYTES):
                s = model.value.scores(*features(part.column(text).fill_null("")))
                columns = {} if "doc_id" in keep else {"doc_id": part.column("_doc_id")}
                columns |= {"held_out": part.column("_held_out"), "score": pa.array(s),
                            "predicted": pa.array((s >= threshold).astype(np.int32))}
                columns |= {c: part.column(c) for c in keep}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(scored, ", ".join([*named, "held_out boolean, score double, predicted int", *kept]))
