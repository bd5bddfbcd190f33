"""Classification expressions: flows, flags, severities, health ladders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .values import strip


def flow_of(hint: Column, amount: Column) -> Column:
    """Revenue or expenditure: a word anywhere inside the hint decides, revenue words
    first; without a word the sign decides and zero counts as revenue."""
    text = F.lower(F.coalesce(hint, F.lit("")))

    def has(words: tuple[str, ...]) -> Column:
        # Plain substring tests: compiled, and several times faster than a regex.
        return reduce(lambda a, b: a | b, [text.contains(w) for w in words])

    return (
        F.when(has(K.REVENUE_WORDS), "revenue")
        .when(has(K.EXPENDITURE_WORDS), "expenditure")
        .when(amount >= 0, "revenue")
        .when(amount < 0, "expenditure")
    )


def truth_of(text: Column) -> Column:
    """Boolean from a word, NULL when the word says neither."""
    word = F.lower(strip(text))
    return F.when(word.isin(*K.TRUE_WORDS), True).when(word.isin(*K.FALSE_WORDS), False)


def severity_of(score: Column) -> Column:
    return F.when(score >= 0.75, "high").when(score >= 0.4, "medium").otherwise("low")


def rank_in(order: tuple[str, ...], status: Column) -> Column:
    """Position of a status in its scale; unknown text ranks lowest."""
    bare = F.lower(strip(F.coalesce(status, F.lit(""))))
    ladder = reduce(
        lambda chain, item: chain.when(bare == item[1], item[0]),
        list(enumerate(order))[1:],
        F.when(F.lit(False), 0),
    )
    return ladder.otherwise(0)


def name_in(order: tuple[str, ...], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in order]), rank.cast("int") + 1)


def worst_of(*statuses: Column) -> Column:
    """The most serious of several health statuses."""
    ranks = [rank_in(K.HEALTH_STATUSES, s) for s in statuses]
    return name_in(K.HEALTH_STATUSES, F.greatest(*ranks) if len(ranks) > 1 else ranks[0])


def ladder(value: Column, warning: float, degraded: float, down: float) -> Column:
    """Health from three rising limits; a missing value is down."""
    return (
        F.when(value.isNull() | (value >= down), "down")
        .when(value >= degraded, "degraded")
        .when(value >= warning, "warning")
        .otherwise("healthy")
    )


def freshness_of(lag: Column, target: Column) -> Column:
    """Health of a data lag: within the target, twice or four times of it."""
    return (
        F.when(lag.isNull(), "down")
        .when(lag <= target, "healthy")
        .when(lag <= target * 2, "warning")
        .when(lag <= target * 4, "degraded")
        .otherwise("down")
    )
