"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word of the same length.
Two words one edit apart have reduced words at most one edit apart.  Every reduced word
generates its full one-edit neighbourhood (itself, deletions, replacements, insertions over
the few symbols), which is joined with the reduced vocabulary; candidates are verified on
the words themselves.  The alphabet's size is a matter of work only: fewer symbols make
smaller neighbourhoods and more candidates.

Neighbours are kept as hashes of their symbols, each found from prefix sums in a few
operations, so a word of a million letters costs rows in proportion to its length and no
strings.  A hash collision costs one more verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, ship_code
from .blocks import mix

SYMBOLS = 8
LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A form is at least so many times as frequent as its variant.
MORE_FREQUENT = 5
_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of the words whose neighbourhoods are computed at once.
_LETTERS = 1 << 14
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def damaged(run: Column, key: Column, every: int = 199) -> Column:
    """``run`` without one of its letters, where the checksum of key and run is a multiple of ``every``.

    A null key counts as an empty one.
    """
    checksum = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(checksum, F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(checksum % F.lit(every) == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int | None = None) -> DataFrame:
    """``word`` and ``n`` over all texts; counts are combined before the shuffle.

    ``every`` adds the misspellings of ``damaged``.
    """
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.translate(F.col(f"`{text}`").cast("string"), _UPPER, _LOWER).alias("t"))
    runs = texts.select("k", F.explode(F.regexp_extract_all("t", F.lit(_RUN), F.lit(0))).alias("run"))
    word = damaged(F.col("run"), F.col("k"), every) if every else F.col("run")
    return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _symbols(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words one after the other, and the words' lengths."""
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (mix(letters + np.uint64(1)) % np.uint64(symbols)).astype(np.int64), np.array([len(w) for w in words], np.int64)


def _sums(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per letter: its word, its place, powers of the base by place, and the word's hash before it."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    start = np.cumsum(lengths) - lengths
    place = np.arange(len(values)) - start[word]
    powers = np.full(int(lengths.max(initial=0)) + 2, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[place], out=total[1:])
    before = total[:-1] - total[start][word]
    return word, place, powers, before


def _key(raw: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(raw + length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def reduced_keys(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """The hash of every word's reduced word."""
    reduced, lengths = _symbols(words, symbols)
    value = mix(np.arange(1, symbols + 1, dtype=np.uint64))[reduced]
    word, place, powers, _ = _sums(value, lengths)
    whole = np.zeros(len(words), np.uint64)
    np.add.at(whole, word, value * powers[place])
    return _key(whole, lengths)


def neighbour_keys(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word number and hash of every reduced word at most one edit away, each once, in several pieces.

    Of equal symbols in a row the last one is deleted, and a symbol is inserted after its
    equals, so no two edits of a word give the same.
    """
    reduced, lengths = _symbols(words, symbols)
    values = mix(np.arange(1, symbols + 1, dtype=np.uint64))
    value = values[reduced]
    word, place, powers, before = _sums(value, lengths)
    here = value * powers[place]
    whole = np.zeros(len(words), np.uint64)
    np.add.at(whole, word, here)
    after = whole[word] - before - here
    every, size = np.arange(len(words)), lengths[word]
    yield every, _key(whole, lengths)
    last = np.r_[(word[1:] != word[:-1]) | (reduced[1:] != reduced[:-1]), True] if len(word) else np.zeros(0, bool)
    yield word[last], _key(before + after * _INVERSE, size - 1)[last]
    for symbol, v in enumerate(values):
        other = reduced != symbol
        yield word[other], _key(before + v * powers[place] + after, size)[other]
        yield word[other], _key(before + v * powers[place] + (here + after) * _BASE, size + 1)[other]
        yield every, _key(whole + v * powers[lengths], lengths + 1)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words = batch.column("id").to_numpy(), batch.column("word").to_pylist()
        first, letters = 0, 0
        for last, word in enumerate(words, 1):
            letters += len(word)
            if letters >= _LETTERS or last == len(words):
                own = ids[first:last]
                for numbers, keys in neighbour_keys(words[first:last]):
                    yield pa.RecordBatch.from_arrays([pa.array(own[numbers]), pa.array(keys.view(np.int64))], ["id", "key"])
                first, letters = last, 0


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = reduced_keys(batch.column("word").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("id")], ["key", "other"])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``id``, ``n``, and ``near`` and ``near_n`` of every word one edit away; ids are whole numbers and distinct.

    Each pair comes in both directions.
    """
    ship_code(vocabulary.sparkSession)
    parts = max(int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")), vocabulary.sparkSession.sparkContext.defaultParallelism)
    words = vocabulary.select("id", "word").repartition(parts, "id")  # the few rows of the scan become many
    neighbours = words.mapInArrow(_neighbours, "id bigint, key bigint")
    reduced = words.mapInArrow(_reduced, "key bigint, other bigint")
    pairs = neighbours.join(reduced, "key").filter("id <> other").select("id", "other")
    pairs = pairs.join(vocabulary.select("id", "word", "n"), "id")
    others = vocabulary.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = pairs.join(others, "other")
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).select("id", "word", "n", "near", "near_n")


def with_roots(forms: DataFrame) -> DataFrame:
    """Columns of ``forms`` with ``root``, the last word that following ``form`` from ``word`` leads to.

    A form is more frequent than its word, so there are no circles and few steps; each round
    doubles them.
    """
    steps = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(steps.join(further, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "steps")
        moved = after.filter("moved").limit(1).count()
        discard(steps)
        steps = after.drop("moved")
        if not moved:
            return forms.join(steps, "word")


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int | None = None,
                   letters: int = LEAST_LETTERS, count: int = LEAST_COUNT, ratio: int = MORE_FREQUENT) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the texts.

    Words are runs of letters in lower case, at least ``letters`` long and found at least
    ``count`` times.  A word's form is its most frequent neighbour (ties: the first by code
    points) if that is at least ``ratio`` times as frequent.  Null and empty texts have no
    words; a repeated row counts again; a null key matters only for ``every`` (``damaged``).
    Other columns are ignored.  No words give no rows.
    """
    counts = word_counts(docs, key, text, every).filter((F.char_length("word") >= letters) & (F.col("n") >= count))
    vocabulary = materialize(counts.withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(vocabulary).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    accepted = -F.col("best.less") >= F.col("n") * F.lit(ratio)
    forms = vocabulary.join(near, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(accepted, F.col("best.form")).alias("form"), F.when(accepted, -F.col("best.less")).alias("form_n"))
    return with_roots(materialize(forms, "forms"))
