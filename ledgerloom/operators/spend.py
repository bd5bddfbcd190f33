"""Spend analytics over normalised finance rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import exact, money_sum
from ..session import materialize
from .lookups import join_lookup
from .series import trailing_days

KEYS = ("company_id",)


def expenses(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("source_area") == "expenditure")


def top_labels(
    rows: DataFrame, label: str, k: int = 5, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The labels with the most spend, and their share of all spend; blanks skipped.

    The share is taken of every expense, labelled or not.  Labels are ranked under a
    limit and totals are an aggregate, so a company's labels never meet in one task.
    """
    totals = (
        expenses(rows)
        .groupBy(*keys, F.trim(label).alias("label"))
        .agg(money_sum(F.col("amount")).alias("value"))
    )
    everything = totals.groupBy(*keys).agg(
        F.sum(exact(F.col("value"))).cast("double").alias("_all")
    )
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("value"), "label"))
    best = totals.filter("label <> ''").withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.join(everything, list(keys)).withColumn(
        "share", F.col("value") / F.col("_all")
    ).drop("_all")


def recurring_spend(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Spend with vendors met more than once, and with all others.

    Vendors are totalled first, so no row is joined to its vendor's count.
    """
    vendors = (
        expenses(rows)
        .groupBy(*keys, "vendor")
        .agg(money_sum(F.col("amount")).alias("value"), F.count("*").alias("n"))
    )

    def part(condition: Column, name: str):
        return money_sum(F.when(condition, F.col("value"))).alias(name)

    return vendors.groupBy(*keys).agg(
        part(F.col("n") > 1, "recurring_spend"), part(F.col("n") == 1, "one_off_spend")
    )


def spread_of(value: Column) -> list[Column]:
    """Mean and population deviation as aggregates over exact sums."""
    n = F.count(value)
    mean = F.sum(exact(value)).cast("double") / n
    squares = F.sum((value * value).try_cast("decimal(38,6)")).cast("double") / n
    return [
        mean.alias("mean"),
        F.sqrt(F.greatest(squares - mean * mean, F.lit(0.0))).alias("deviation"),
    ]


def unusual_expenses(
    rows: DataFrame, k: int = 3, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The largest expenses far above a company's mean (1.8 deviations and 1.35 means)."""
    spent = expenses(rows).select(*keys, "record_id", "date", "vendor", "amount")
    limits = materialize(spent.groupBy(*keys).agg(*spread_of(F.col("amount"))), "limits")
    far = (F.col("amount") > F.col("mean") + F.col("deviation") * 1.8) & (
        F.col("amount") > F.col("mean") * 1.35
    )
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("amount"), "record_id"))
    return (
        join_lookup(spent, limits, list(keys), "inner")
        .filter(far)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .drop("mean", "deviation")
    )


def monthly_finance(
    daily: DataFrame, months: int = 6, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The last months present, with the change of spend from the month before.

    Negative days count as 0.  The change is NULL when the month before has no spend.
    """

    def side(name: str):
        return money_sum(F.greatest(F.col(name), F.lit(0.0))).alias(name)

    monthly = daily.groupBy(*keys, F.trunc("date", "month").alias("month")).agg(
        side("revenue"), side("expenditure")
    )
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("month")))
    before = F.lag("expenditure").over(W.partitionBy(*keys).orderBy("month"))
    return (
        monthly.withColumn("_n", newest)
        .filter(F.col("_n") <= months)
        .drop("_n")
        .withColumn("label", F.date_format("month", "MMM"))
        .withColumn("_before", before)
        .withColumn("spend_difference", F.col("expenditure") - F.coalesce("_before", F.lit(0.0)))
        .withColumn(
            "spend_change_percent",
            F.when(
                F.col("_before") > 0,
                (F.col("expenditure") - F.col("_before")) / F.col("_before") * 100,
            ),
        )
        .drop("_before")
    )


def weekly_activity(rows: DataFrame, days: int = 7, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Records on each of the last days that have any."""
    counts = rows.groupBy(*keys, "date").agg(F.count("*").alias("value"))
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("date")))
    return (
        counts.withColumn("_n", newest)
        .filter(F.col("_n") <= days)
        .drop("_n")
        .withColumn("label", F.date_format("date", "EEE"))
    )


def daily_spend(rows: DataFrame, keys: tuple[str, ...] = KEYS, undated: bool = False) -> DataFrame:
    """Spend and number of expenses per day; ``undated`` keeps those without a date in a row of their own."""
    spent = expenses(rows)
    return (
        (spent if undated else spent.filter("date IS NOT NULL"))
        .groupBy(*keys, "date")
        .agg(money_sum(F.col("amount")).alias("value"), F.count("*").alias("transactions"))
    )


def spend_series(
    spent: DataFrame, days: int = 90, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Dense spend of the last days, in cents."""
    dense = trailing_days(spent, "value", days, keys)
    return dense.withColumn("value", exact(F.col("value")).cast("decimal(28,2)").cast("double"))


def spend_window(
    spent: DataFrame, window_days: int, keys: tuple[str, ...] = KEYS, span: int = 90
) -> DataFrame:
    """Figures of the last ``window_days`` of spend: total, mean, peak, the window before,
    and the days far above the mean (1.6 deviations and 1.25 means).

    Expenses without a date count as transactions; a company that has only such has no other
    figures."""
    series = spend_series(spent.filter("date IS NOT NULL"), span, keys)
    order = W.partitionBy(*keys).orderBy(F.desc("date"))
    placed = series.withColumn("_n", F.row_number().over(order))
    here = F.col("_n") <= window_days
    value = F.when(here, F.col("value"))
    mean, deviation = spread_of(value)
    figures = placed.groupBy(*keys).agg(
        F.max("date").alias("latest_date"),
        money_sum(value).alias("current_total"),
        money_sum(
            F.when(~here & (F.col("_n") <= 2 * window_days), F.col("value"))
        ).alias("previous_total"),
        mean,
        deviation,
        F.max(value).alias("peak"),
    )
    spike = (F.col("value") > F.col("mean") + F.col("deviation") * 1.6) & (
        F.col("value") > F.col("mean") * 1.25
    )
    spikes = (
        placed.filter(here)
        .join(figures, list(keys))
        .groupBy(*keys)
        .agg(F.count_if(spike).alias("spike_days"))
    )
    counts = spent.groupBy(*keys).agg(F.sum("transactions").alias("transaction_count"))
    return (
        figures.join(spikes, list(keys))
        .join(counts, list(keys), "right")
        .withColumnRenamed("mean", "average")
        .drop("deviation")
        .withColumn("window_days", F.lit(window_days))
    )
