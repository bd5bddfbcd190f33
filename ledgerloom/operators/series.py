"""Daily series: dense calendars, lags and rolling features.

Everything here runs on rows already reduced to one per key and day, so a window
partition holds days, never transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import frame_mean

KEYS = ("company_id",)


def dense_daily(
    values: DataFrame,
    value_columns: list[str],
    keys: tuple[str, ...] = KEYS,
    carry: bool = False,
) -> DataFrame:
    """One row per day from a key's first to its last day.

    Each day is stretched up to the next one, so the input is read once and nothing is
    joined.  Missing days hold 0, or the last known value with ``carry``.
    """
    ahead = F.lead("date").over(W.partitionBy(*keys).orderBy("date"))
    last = F.coalesce(F.date_sub("_next", 1), F.col("date"))
    stretched = values.withColumn("_next", ahead).withColumn(
        "day", F.explode(F.sequence("date", last))
    )
    filled = [
        (F.col(c) if carry else F.when(F.col("day") == F.col("date"), F.col(c)).otherwise(0.0))
        .cast("double")
        .alias(c)
        for c in value_columns
    ]
    return stretched.select(*keys, F.col("day").alias("date"), *filled)


def trailing_days(
    values: DataFrame, value: str, days: int, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The last ``days`` calendar days up to each key's latest day, gaps as 0."""
    latest = values.groupBy(*keys).agg(F.max("date").alias("_last"))
    spine = latest.select(
        *keys,
        F.explode(F.sequence(F.date_sub("_last", days - 1), F.col("_last"))).alias("date"),
    )
    return spine.join(values.select(*keys, "date", value), [*keys, "date"], "left").withColumn(
        value, F.coalesce(value, F.lit(0.0))
    )


def lag_features(
    series: DataFrame, value: str = "value", keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Training frame of a dense series: lags, full-window means, calendar; incomplete
    rows are left out."""
    w = W.partitionBy(*keys).orderBy("date")
    target = F.col(value)
    frame = series.select(*keys, "date", target.alias("target"))
    target = F.col("target")
    for n in (1, 7, 14):
        frame = frame.withColumn(f"lag_{n}", F.lag("target", n).over(w))
    for n in (7, 14):
        before = w.rowsBetween(-n, -1)
        frame = frame.withColumn(
            f"rolling_mean_{n}",
            F.when(F.count("target").over(before) == n, frame_mean(target, before)),
        )
    return (
        frame.withColumn("day_of_week", F.weekday("date"))
        .withColumn("month", F.month("date"))
        .dropna(subset=["target", *K.FORECAST_FEATURES])
    )


def rolling_features(daily: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Mean of up to seven earlier rows of the same area (at least three), and the
    distance from it.  Rows count here, not calendar days: missing days are skipped."""
    w = W.partitionBy(*keys, "source_area").orderBy("date")
    before = w.rowsBetween(-7, -1)
    total = F.col("daily_total")
    mean = F.when(F.count("daily_total").over(before) >= 3, frame_mean(total, before))
    return (
        daily.withColumn("_mean", mean)
        .withColumn("rolling_mean_7", F.coalesce("_mean", "daily_total"))
        .withColumn("rolling_deviation_7", F.coalesce(F.abs(total - F.col("_mean")), F.lit(0.0)))
        .withColumn("day_of_week", F.weekday("date"))
        .drop("_mean")
    )


def last_points(series: DataFrame, k: int, order: list, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The newest ``k`` rows of each key under a descending order."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return series.withColumn("_n", n).filter(F.col("_n") <= k).drop("_n")
