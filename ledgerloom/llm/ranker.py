"""Quality classifier: Bradley-Terry scores learnt from pairs of a good and a poor document.

A document's worth is a weighted sum of measures of its text.  A pair says that the good one
is worth more; the loss is the logistic one of the difference.  The cut is the quantile of
worth that matches the share of poor documents among the labelled ones; scores between 0
and 1 come from a slope fitted around that cut, so a score of at least ``CUT`` means a worth
at or above the quantile.

Measures of the labelled rows are taken in Spark.  At most ``SAMPLE`` labelled rows, chosen
by a hash of their ids, reach the driver for the fit; every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import LOWER, Block, RollingHash, Words, code_points, per_text
from .measures import duplicate_lines, in_text, repeated_words, spaced_words
from .rows import per_text_columns

#: Most labelled rows used for the fit.
SAMPLE = 20_000
#: Pairs per fitted poor document.
PAIRS = 20
CUT = 0.3
_RIDGE = 1e-3
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True

MEASURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "punctuation", "exclaimed", "beyond_ascii",
    "distinct", "top_word", "same_as_last", "repeated", "repeated_lines", "log_line", "ends_marked",
    "only_marks", "upper_words", "empty",
)


def _distinct(words: Words, data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: distinct words (in lower case), count of the most frequent, words like the one before."""
    hashes = RollingHash(LOWER[data]).of(words.starts, words.ends)
    keys, index, counts = np.unique(in_text(hashes, words.text_of), return_index=True, return_counts=True)
    text_of = words.text_of[index]
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text_of, counts)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.text_of[1:] == words.text_of[:-1])
    return np.bincount(text_of, minlength=n), top, per_text(same, words.cuts)


def measures(block: Block) -> np.ndarray:
    """One row of numbers per text, in the order of ``MEASURES``; all between 0 and a few units."""
    words, data = spaced_words(block), block.data
    n = np.diff(words.cuts)
    some, size = np.maximum(n, 1), np.maximum(np.diff(block.bounds), 1)
    points = code_points(data)
    chars = points[words.ends] - points[words.starts]

    def share(table: np.ndarray, of: np.ndarray) -> np.ndarray:
        return per_text(table[data], block.bounds) / of

    distinct, top, same = _distinct(words, data, block.n)
    lines, repeats = duplicate_lines(block, words)
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_PUNCTUATION[data], out=marks[1:])
    in_word = marks[words.ends] - marks[words.starts]
    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data], out=upper[1:])
    caps = upper[words.ends] - upper[words.starts]
    last_marked = _PUNCTUATION[data[words.ends - 1]]
    columns = (
        np.log1p(n) / 5, per_text(chars, words.cuts) / some / 10, share(_UPPER, size), share(_DIGIT, size),
        np.minimum(share(_SYMBOL, some), 3), np.minimum(share(_PUNCTUATION, some), 5),
        np.minimum(per_text(data == 0x21, block.bounds) / some, 3),
        per_text(data >= 0x80, block.bounds) / size, np.log(np.maximum(distinct, 1)) / np.log(some + 1.0),
        top / some, same / some, per_text(repeated_words(words), words.cuts) / some,
        repeats / np.maximum(lines, 1), np.log1p(n / np.maximum(lines, 1)) / 5,
        per_text(last_marked, words.cuts) / some, per_text(in_word == words.ends - words.starts, words.cuts) / some,
        per_text((caps > 1) & (2 * caps > words.ends - words.starts), words.cuts) / some, (n == 0).astype(float),
    )
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


@dataclass
class Ranking:
    """Weights of worth (on centred, scaled measures), the quantile to pass, and the slope around it."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def worth(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.scale, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        at_cut = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.worth(rows) - self.cut) + at_cut, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights of least logistic loss by Newton's method, without an intercept."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_pairs(rows: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 8) -> Ranking:
    """Fit worth on preference pairs; with one class only, every document gets the same worth."""
    width = rows.shape[1] if rows.ndim == 2 else len(MEASURES)
    if not len(rows) or good.all() or not good.any():
        poor_only = len(rows) > 0 and not good.any()
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 1.0 if poor_only else -1.0, 1.0)
    centre, spread = rows.mean(axis=0), rows.std(axis=0)
    scale = np.where(spread > 1e-9, spread, 1.0)
    x = np.clip((rows - centre) / scale, -8, 8)
    random = np.random.default_rng(seed)
    worse = np.repeat(np.flatnonzero(~good), pairs)
    better = random.choice(np.flatnonzero(good), len(worse))
    differences = x[better] - x[worse]
    sign = np.where(np.arange(len(worse)) % 2 == 0, 1.0, -1.0)
    weights = _logistic(differences * sign[:, None], (sign > 0).astype(float), _RIDGE)
    worth = x @ weights
    cut = float(np.quantile(worth, (~good).mean()))
    slope = float(_logistic((worth - cut)[:, None], good.astype(float), _RIDGE)[0])
    return Ranking(centre, scale, weights, cut, max(slope, 1e-3))


def held_out(key: str, modulus: int = 5, remainder: int = 0) -> Column:
    """Whether the CRC-32 of the key as text leaves the remainder; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def score_quality(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """Columns of ``docs`` with ``quality_score``; null texts are empty texts, which have a score too."""
    return per_text_columns(
        docs.withColumn(text, F.col(text).cast("string")), text, "quality_score double",
        lambda block: [pa.array(ranking.scores(measures(block)))])


def classifier(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE,
) -> Ranking:
    """The ranking that ``labels.quality`` of the documents not held out teaches.

    Labels without a document, without a quality, and held-out ones are not used.  A document
    with contradicting labels counts once for each; of rows that share an id one text is used.
    """
    ids = labels.filter(~held_out(key) & F.col("quality").isin(0, 1)).select(
        F.col(key).alias("_key"), F.col("quality").cast("int").alias("_good")).distinct()
    # The choice is made on the narrow labels; at most `sample` pairs of numbers meet the texts.
    chosen = ids.orderBy(F.xxhash64("_key"), "_key", "_good").limit(sample)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    found = per_text_columns(
        texts.join(F.broadcast(chosen), "_key"), "_text", "measured array<double>",
        lambda block: [pa.array(list(measures(block)), pa.list_(pa.float64()))], ["_key", "_good"])
    rows = found.groupBy("_key", "_good").agg(F.min("measured").alias("measured")).collect()
    values = np.array([row["measured"] for row in rows]).reshape(-1, len(MEASURES))
    good = np.array([row["_good"] == 1 for row in rows], bool)
    order = np.lexsort(np.c_[values, good].T)  # the same fit whatever order rows come in
    return fit_pairs(values[order], good[order])
