"""Mixing towards target token shares of softly assigned domains.

Domains are what the labels table says of a document: clean, toxic, or poor and not toxic.
A Bayes classifier over hashed words, fitted on labelled rows, gives every document a
probability of each domain.  A document's rate says how often it should be read; expected
tokens of a domain are the sum over documents of rate, tokens and probability.

Rates minimise the squared miss of the domain totals, by projected gradient from one: a
step takes the weights of its own domains off a document's rate and cuts it off at the
bounds.  A step is three numbers, a weight a domain, found from a dozen sums over all
documents, so an iteration is one aggregation, and no state is kept per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_code
from .blocks import SPACED, Block, find_words, text_blocks
from .measures import in_text
from .rows import per_text_columns

DOMAINS = ("clean", "toxic", "poor")
#: Wanted shares of tokens.
TARGETS = {"clean": 0.975, "toxic": 0.005, "poor": 0.02}
#: Most labelled rows that the classifier is fitted on.
SAMPLE = 20_000
BUCKETS = 1 << 18
#: A word counts if a domain other than the first has it at least so many times more often than
#: all documents do, and by so many standard deviations; all others are left out.
TELLING_RATIO, TELLING_DEVIATIONS = 2.0, 4.0
ITERATIONS = 40
#: No document is read more often.
MOST = 64.0
#: Relative miss of a domain's total that still counts as reached.
TOLERANCE = 0.05


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 2).when(F.col("quality") == 1, 0)


def _distinct_buckets(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every different word of a text, and the texts' numbers of words."""
    words = find_words(block, SPACED)
    text_of = words.text_of
    _, first = np.unique(in_text(words.hashes, text_of), return_index=True)
    return (words.hashes[first] % np.uint64(BUCKETS)).astype(np.int64), text_of[first], np.diff(words.cuts)


@dataclass
class Classifier:
    """Per domain the log odds of telling words, zero for others, and what a document without any scores."""

    words: np.ndarray
    prior: np.ndarray

    def posteriors(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        bucket, text_of, counts = _distinct_buckets(block)
        sums = np.stack([np.bincount(text_of, self.words[k][bucket], block.n) for k in range(len(DOMAINS))], axis=1)
        sums += self.prior
        p = np.exp(sums - sums.max(axis=1, keepdims=True))
        return counts, p / p.sum(axis=1, keepdims=True)


def fit_classifier(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Classifier:
    """Count in how many labelled documents of each domain a bucket occurs.

    At most ``sample`` labelled rows, chosen by a hash of the key, are used.  Without labels
    every domain is equally likely everywhere.
    """
    ship_code(docs.sparkSession)
    ids = labels.select(F.col(key).alias("_key"), _domain().alias("_domain")).dropna().distinct()
    chosen = ids.orderBy(F.xxhash64("_key"), "_key", "_domain").limit(sample)  # pairs of numbers
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_key").select("_domain", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(DOMAINS), BUCKETS + 1), np.int64)  # the last column counts documents
        for batch in batches:
            domain = batch.column("_domain").to_numpy()
            for block in text_blocks(batch.column("_text")):
                own = domain[block.first : block.first + block.n]
                bucket, text_of, _ = _distinct_buckets(block)
                np.add.at(counts, (own[text_of], bucket), 1)
                np.add.at(counts[:, BUCKETS], own, 1)
        at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0].astype(np.int32)), pa.array(at[1]), pa.array(counts[at])], ["domain", "bucket", "n"])

    sums = rows.mapInArrow(run, "domain int, bucket bigint, n bigint").groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(DOMAINS), BUCKETS + 1))
    found = sums.toArrow()  # at most three numbers a bucket
    counts[found["domain"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    documents, seen = counts[:, BUCKETS:], counts[:, :BUCKETS]
    expected = documents * seen.sum(axis=0) / max(documents.sum(), 1.0)
    telling = (
        ((seen + 2) / (expected + 2) > TELLING_RATIO) & (seen - expected > TELLING_DEVIATIONS * np.sqrt(expected + 1))
    )[1:].any(axis=0)
    chance = (seen + 0.5) / (documents + 1)  # of a document of the domain to have the word
    words = np.where(telling, np.log(chance) - np.log1p(-chance), 0.0)
    prior = np.log((documents[:, 0] + 1) / (documents.sum() + len(DOMAINS))) + (np.log1p(-chance) * telling).sum(axis=1)
    return Classifier(words.astype(np.float32), prior)


def with_posteriors(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """Columns of ``docs`` with ``n_tokens`` and ``p_clean``, ``p_toxic``, ``p_poor``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets

    def look(block: Block) -> list[pa.Array]:
        counts, p = shared.value.posteriors(block)
        return [pa.array(counts.astype(np.int64)), *(pa.array(np.ascontiguousarray(p[:, k])) for k in range(len(DOMAINS)))]

    fields = "n_tokens bigint, " + ", ".join(f"p_{name} double" for name in DOMAINS)
    return per_text_columns(docs.withColumn(text, F.col(text).cast("string")), text, fields, look)


def rate_of(steps: list[np.ndarray], most: float = MOST) -> Column:
    """The rate after the given steps: each takes the step's weights of a document's domains off, within bounds."""
    rate = F.lit(1.0)
    for weights in steps:
        push = sum((F.col(f"p_{name}") * F.lit(float(w)) for name, w in zip(DOMAINS, weights)), F.lit(0.0))
        rate = F.least(F.lit(most), F.greatest(F.lit(0.0), rate - push))
    return rate


@dataclass
class Mix:
    """A column of rates, the shares of tokens they give, and whether these are the wanted ones."""

    rate: Column
    shares: np.ndarray
    reached: bool


def fit_mix(known: DataFrame, targets: dict[str, float] | None = None, budget: float | None = None, most: float = MOST) -> Mix:
    """Rates between 0 and ``most`` by projected gradient; ``known`` has ``n_tokens`` and posteriors.

    Wanted are ``budget`` tokens in the target shares; without a budget as many as leave the
    first domain its tokens.  Least squares of the misses are weighted by the inverse of the
    domains' overlap (of the documents not at a bound), in which a step of one is the best.
    Every step is one aggregation over all documents; from rates of one, it moves a document
    only as its own domains ask.

    A domain can give and take only what its members have, the documents more likely of it
    than not.  Where its target lies beyond, as with labels too few to tell domains apart, the
    nearest total is taken and ``reached`` is false; rates of documents of other domains are
    not bent for it.
    """
    shares = np.array([(targets or TARGETS)[name] for name in DOMAINS])
    p, d, n = [F.col(f"p_{name}") for name in DOMAINS], len(DOMAINS), F.col("n_tokens")

    def sums(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The totals, and the overlap of the domains in documents not at a bound."""
        rate = F.col("_rate")  # stands a dozen times in the sums, its steps but once in the plan
        free = F.when((rate > 0) & (rate < most), n).otherwise(0)
        found = known.withColumn("_rate", rate_of(steps, most)).agg(*[F.sum(n * x * rate) for x in p], *[F.sum(free * x * y) for x in p for y in p]).first()
        values = np.array([float(x or 0.0) for x in found])
        return values[:d], values[d:].reshape(d, d)

    now, overlap = sums([])
    if now.sum() <= 0:
        return Mix(F.lit(1.0), shares, False)
    own = np.array([float(x or 0.0) for x in known.agg(*[F.sum(F.when(x > 0.5, n * x)) for x in p]).first()])
    wanted = shares * (budget or (now[0] / shares[0] if now[0] > 0 and shares[0] > 0 else now.sum()))
    goal = np.clip(wanted, now - own, now + (most - 1) * own)
    whole = overlap
    steps: list[np.ndarray] = []
    cost, have = np.inf, now
    for _ in range(ITERATIONS):
        miss = have - goal
        if np.abs(miss).max() < 1e-6 * goal.sum():
            break
        after = float(miss @ np.linalg.lstsq(whole, miss, rcond=1e-9)[0])
        if after > cost and steps:  # the bounds were too far off for this step: a shorter one, in the overlap of all
            steps[-1] = steps[-1] / 2
        else:
            cost = after
            steps.append(np.linalg.lstsq(overlap, miss, rcond=1e-9)[0])
        have, overlap = sums(steps)
    reached = bool(np.abs(have / np.maximum(wanted, 1e-9) - 1).max() < TOLERANCE)
    if have[0] < (1 - TOLERANCE) * goal[0]:  # nothing is gained by losing what is to be kept
        return Mix(F.lit(1.0), now / now.sum(), False)
    return Mix(rate_of(steps, most), have / have.sum(), reached)


def fit_to_targets(known: DataFrame, targets: dict[str, float] | None = None, budget: float | None = None) -> Column:
    """A column that gives each document its rate; see ``fit_mix``."""
    return fit_mix(known, targets, budget).rate


def with_rates(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
               targets: dict[str, float] | None = None, budget: float | None = None) -> DataFrame:
    """Columns of ``docs`` with ``n_tokens``, posteriors, ``rate``, ``copies`` and ``shares_reached``.

    ``copies`` is the rate as a whole number, rounded up with a chance of its fraction that a
    hash of the key decides.  ``shares_reached`` says on every row whether the expected totals
    are the wanted shares; with labels too few to tell domains apart they are not, and every
    rate is one.  A null or empty text has no tokens and the classifier's prior.  Rows without a
    key share one chance; repeated rows get the same result.
    """
    model = fit_classifier(docs, labels, key, text)
    marked = with_posteriors(docs, model, text)
    columns = ["n_tokens", *(f"p_{name}" for name in DOMAINS)]
    mix = fit_mix(materialize(marked.select(*columns), "posteriors"), targets, budget)
    chance = F.pmod(F.xxhash64(F.col(key), F.lit("copies")), F.lit(1 << 32)) / F.lit(float(1 << 32))
    return marked.withColumn("rate", mix.rate).withColumn("copies", F.floor(F.col("rate") + chance).cast("bigint")).withColumn(
        "shares_reached", F.lit(mix.reached))


def mix(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents to be read at least once, with their posteriors, rates and copies."""
    return with_rates(docs, labels, key, text).filter("copies > 0")
