"""Exact quantiles of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .lookups import join_lookup


#: Most different values of a group that are ordered in one place.
BOUND = 10_000
#: A round leaves about a hundredth of a group's values, so few are ever needed.
ROUNDS = 12


def _grid(q: float | None) -> list[float]:
    """Cut points: close together around the wanted quantile, wide elsewhere; even without one."""
    if q is None:
        return [i / 64 for i in range(1, 64)]
    near = [q + (i - 8) * 0.00125 for i in range(17)]
    wide = [i / 15 for i in range(1, 15)]
    return sorted(g for g in {*near, *wide} if 0.0 < g < 1.0)


def _cuts_below(count: int) -> Column:
    """How many of the rising ``_cuts`` lie below ``_v``: a binary search written as
    nested conditions, which are compiled."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        cut = F.get("_cuts", F.lit(middle))
        return F.when(cut < F.col("_v"), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, count)


def _inside() -> Column:
    """Whether a value is in its span: above the lower end and up to the upper one; a missing end is open."""
    return F.coalesce(F.col("_v") > F.col("_above"), F.lit(True)) & F.coalesce(F.col("_v") <= F.col("_upto"), F.lit(True))


def _narrowed(rows: DataFrame, spans: DataFrame, keys: list[str], q: float, first: bool) -> DataFrame:
    """The parts of the spans that hold the wanted ranks, found from cuts of fixed size and their counts."""
    grid = _grid(q if first else None)
    span = [*keys, "n", "_start", "_above", "_upto"]
    held = join_lookup(rows, spans.select(*span), keys, "inner").filter(_inside())
    cuts = materialize(held.groupBy(*span).agg(F.percentile_approx("_v", grid, 10_000).alias("_cuts")), "cuts")
    sizes = (
        join_lookup(rows, cuts, keys, "inner").filter(_inside())
        .groupBy(*span, "_cuts", _cuts_below(len(grid)).alias("_b"))
        .agg(F.sum("_w").alias("_size"), F.approx_count_distinct("_v").alias("_values"))
    )
    before = W.partitionBy(*keys, "_start").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_start") + F.coalesce(F.sum("_size").over(before), F.lit(0))
    low, high = _ranks(q)
    return sizes.withColumn("_first", start).filter(
        (F.col("_first") <= high) & (F.col("_first") + F.col("_size") > low)
    ).select(
        *keys, "n", F.col("_first").alias("_start"),
        F.coalesce(F.get("_cuts", F.col("_b") - 1), "_above").alias("_above"),
        F.coalesce(F.get("_cuts", F.col("_b")), "_upto").alias("_upto"), "_size", "_values")


def _ranks(q: float) -> tuple[Column, Column]:
    rank = (F.col("n") - 1) * F.lit(q)
    return F.floor(rank), F.ceil(rank)


def quantile_spans(rows: DataFrame, keys: list[str], q: float, bound: int = BOUND) -> DataFrame:
    """For every group the spans of values that hold its wanted ranks, each of about ``bound`` different values at most.

    ``rows`` has ``_v`` and ``_w``.  A span is ``_above`` to ``_upto`` with ``_start`` values
    before it.  Groups that are small from the start are one open span.  Each round cuts what
    is still too large, by mergeable sketches and counts, however many rows a group has.
    """
    void = F.lit(None).cast(dict(rows.dtypes)["_v"])
    spans = materialize(rows.groupBy(*keys).agg(
        F.sum("_w").alias("n"), F.approx_count_distinct("_v").alias("_values")
    ).select(*keys, "n", F.lit(0).cast("bigint").alias("_start"), void.alias("_above"), void.alias("_upto"),
             F.col("n").alias("_size"), "_values"), "spans")
    for number in range(ROUNDS):
        large = F.col("_values") > bound
        if spans.filter(large).isEmpty():
            break
        narrowed = _narrowed(rows, spans.filter(large), keys, q, number == 0)
        spans = materialize(spans.filter(~large).unionByName(narrowed), "spans")
    return spans


def exact_quantile(
    df: DataFrame, keys: list[str], value: str, q: float, name: str, weight: str | None = None, bound: int = BOUND
) -> DataFrame:
    """``keys, name, n``: the linearly interpolated q-quantile of ``value`` per key.

    ``percentile`` would gather all values of a group in one state.  Here spans of values are
    narrowed until they hold about ``bound`` different values (``quantile_spans``), and only
    these are shuffled, copies combined, and ordered.  Poor cuts cost a further round, never
    the result.  ``df`` is read twice, and twice more for every round, so it should be a
    written table; ``weight`` is a whole number of copies a row stands for.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w")
    )
    spans = quantile_spans(rows, keys, q, bound).select(*keys, "n", "_start", "_above", "_upto")
    low, high = _ranks(q)
    inside = W.partitionBy(*keys, "_start").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        join_lookup(rows, spans, keys, "inner")
        .filter(_inside())
        .groupBy(*keys, "_start", "n", "_v")
        .agg(F.sum("_w").alias("_c"))
        .withColumn("_from", F.col("_start") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
        .withColumn("_to", F.col("_from") + F.col("_c") - 1)
    )
    holds = [
        F.max(F.when((F.col("_from") <= r) & (r <= F.col("_to")), F.col("_v"))).alias(a)
        for r, a in ((low, "_lo"), (high, "_hi"))
    ]
    rank = (F.col("n") - 1) * F.lit(q)
    return ranked.groupBy(*keys, "n").agg(*holds).select(
        *keys,
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (rank - low)).alias(name),
        "n",
    )
