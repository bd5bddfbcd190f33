"""Quality rules: base counts, and how much likelier a text is under trusted than under raw text.

Both sides are multinomials over hashed word n-grams (one and two words).  A text's score is
the mean log ratio of its n-grams, so long texts are not favoured; every text at or above
the threshold is kept.  Counts of the raw side cover every document, those of the trusted
side every trusted document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_code
from .blocks import LOWER, Block, RollingHash, Words, text_blocks, windows_hash
from .measures import base_measures, spaced_words
from .rows import per_text_columns

BUCKETS = 1 << 16
#: N-grams of the raw side added to the trusted one.
MASS = 8_192.0
#: In nats per n-gram; lower where the trusted texts themselves, seen from one another, score lower.
THRESHOLD = -0.12
#: Share of the trusted texts that may score below the threshold when only the other half is known.
LOST = 0.1
#: Up to so many keys, some twenty megabytes, are sent to all texts.
BROADCAST_KEYS = 500_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def ngram_buckets(block: Block, words: Words, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram and the text it belongs to; letters are compared in lower case."""
    hashes = RollingHash(LOWER[block.data]).of(words.starts, words.ends)
    text_of = words.text_of
    pairs = windows_hash(hashes, 2)
    inner = np.flatnonzero(text_of[1:] == text_of[:-1])
    all_hashes = np.concatenate([hashes, pairs[inner]])
    return (all_hashes % np.uint64(buckets)).astype(np.int64), np.concatenate([text_of, text_of[inner]])


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, part: Column | None = None, parts: int = 1) -> np.ndarray:
    """How often each bucket occurs in the texts of each part; a task adds up its own before anything is sent."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(parts * buckets, np.int64)
        for batch in batches:
            own = batch.column(1).to_numpy().astype(np.int64)
            for block in text_blocks(batch.column(0)):
                bucket, text_of = ngram_buckets(block, spaced_words(block), buckets)
                total += np.bincount(bucket + own[block.first : block.first + block.n][text_of] * buckets, minlength=parts * buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("string"), (F.lit(0) if part is None else part).cast("int"))
    out = np.zeros(parts * buckets, np.int64)
    for bucket, n in rows.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():  # a number a bucket
        out[bucket] = n
    return out.reshape(parts, buckets)


def log_ratios(trusted: np.ndarray, raw: np.ndarray, mass: float = MASS) -> np.ndarray:
    """Log of the trusted over the raw probability of every bucket.

    The trusted side is smoothed towards the raw one, by ``mass`` n-grams drawn from it: equal
    distributions give zero at any size of either, and a bucket the trusted texts lack is the
    less likely the more of them there are.  A bucket that no text has counts as zero.
    """
    share = raw / max(raw.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log((trusted / share + mass) / (trusted.sum() + mass))
    return np.where(share > 0, ratio, 0.0)


def _mean_ratios(block: Block, words: Words, ratios: np.ndarray) -> np.ndarray:
    """The mean ratio of each text's n-grams; zero without any."""
    bucket, text_of = ngram_buckets(block, words, len(ratios))
    return np.bincount(text_of, ratios[bucket], block.n) / np.maximum(np.bincount(text_of, minlength=block.n), 1)


def fitted_threshold(
    trusted: DataFrame, halves: np.ndarray, raw: np.ndarray, text: str = "text",
    least: float = THRESHOLD, lost: float = LOST, min_words: int = MIN_WORDS,
) -> float:
    """``least``, or the ``lost`` quantile of trusted texts scored by the other half's counts if that is lower.

    Few trusted texts know few words; how far good texts then fall is seen from one half to the
    other, over all of them.
    """
    ratios = trusted.sparkSession.sparkContext.broadcast([log_ratios(halves[1 - own], raw) for own in (0, 1)])

    def look(block: Block) -> list[pa.Array]:
        words = spaced_words(block)
        return [pa.array(np.diff(words.cuts).astype(np.int64)), *(pa.array(_mean_ratios(block, words, r)) for r in ratios.value)]

    rows = trusted.select(F.col(text).cast("string").alias("t"), _half(text).alias("half"))
    scored = per_text_columns(rows, "t", "words bigint, first double, second double", look, ["half"])
    own = F.when(F.col("half") == 0, F.col("first")).otherwise(F.col("second"))
    found = scored.filter(F.col("words") >= min_words).agg(F.percentile_approx(own, lost, 10_000)).first()[0]
    return least if found is None else min(least, float(found))


def _half(text: str) -> Column:
    return F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(2))


def apply_rules(
    docs: DataFrame, trusted: DataFrame, text: str = "text", threshold: float | None = None,
    min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, buckets: int = BUCKETS,
) -> DataFrame:
    """All columns of ``docs`` with the base counts, ``llr``, ``base_failed`` and ``kept``.

    ``trusted`` holds the texts to resemble, in a column of the same name.  Without a
    ``threshold`` it is ``fitted_threshold``.  A null text is an empty one: no words, ``llr``
    zero, ``base_failed``.  Without trusted texts every ratio is taken as zero, so the base
    rules decide alone.  Repeated rows give repeated results; no rows give none.  A column of
    ``docs`` with the name of a result is replaced by it.
    """
    halves = bucket_counts(trusted, text, buckets, _half(text), 2)
    ratios, limit = np.zeros(buckets), THRESHOLD if threshold is None else threshold
    if halves.any():
        raw = bucket_counts(docs, text, buckets)[0]
        ratios = log_ratios(halves[0] + halves[1], raw)
        if threshold is None:
            limit = fitted_threshold(trusted, halves, raw, text, min_words=min_words)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # `buckets` numbers
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def measure(block: Block) -> list[pa.Array]:
        words = spaced_words(block)
        base = base_measures(block, words)
        return [*(pa.array(base[name].astype(np.int64)) for name in counts), pa.array(_mean_ratios(block, words, shared.value))]

    own = [name for name in docs.columns if name not in (*counts, "llr", "base_failed", "kept")]
    found = per_text_columns(
        docs.withColumn(text, F.col(text).cast("string")), text,
        ", ".join(f"{name} bigint" for name in counts) + ", llr double", measure, carried=own)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(limit)))


def trusted_texts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of the documents labelled as good, repeated rows kept.

    Up to ``BROADCAST_KEYS`` keys go to the texts; beyond that the texts are dealt by key once
    and the trusted ones written, as they are read more than once.
    """
    good = materialize(labels.filter("quality = 1").select(key).dropna().distinct(), "good")
    texts = docs.select(key, text)
    if good.count() <= BROADCAST_KEYS:
        return texts.join(F.broadcast(good), key, "left_semi").select(text)
    return materialize(texts.join(good.hint("shuffle_hash"), key, "left_semi").select(text), "trusted")
