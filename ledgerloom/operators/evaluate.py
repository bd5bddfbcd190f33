"""Forecast errors and detector quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import exact
from .forecast import forecast


def forecast_errors(
    actual: DataFrame, predicted: DataFrame, keys: tuple[str, ...] = ("company_id", "metric")
) -> DataFrame:
    """MAE, RMSE and MAPE of the days both sides have.

    A zero actual adds nothing to the percentage sum but counts in its divisor.
    """
    days = actual.join(predicted, [*keys, "date"])
    gap = F.abs(F.col("value") - F.col("predicted_value"))
    n = F.count("*")

    def total(x):
        return F.coalesce(F.sum(exact(x)).cast("double"), F.lit(0.0))

    return days.groupBy(*keys).agg(
        n.alias("days"),
        (total(gap) / n).alias("mae"),
        F.sqrt(total(gap * gap) / n).alias("rmse"),
        (total(F.when(F.col("value") != 0, gap / F.abs("value"))) / n * 100).alias("mape"),
    )


def classification_quality(
    labelled: DataFrame, predicted: DataFrame, on: str, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Precision, recall and F1 of predicted against labelled positive ids."""
    ids = [*keys, on]
    both = labelled.select(*ids).distinct().withColumn("_l", F.lit(1)).join(
        predicted.select(*ids).distinct().withColumn("_p", F.lit(1)), ids, "full_outer"
    )
    hit, extra, missed = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))

    def part(a, b):
        return F.when(a + b > 0, a / (a + b)).otherwise(0.0)

    p, r = F.col("precision"), F.col("recall")
    return (
        both.groupBy(*keys)
        .agg(
            F.count_if(F.col("_l").isNotNull() & F.col("_p").isNotNull()).alias("true_positives"),
            F.count_if(F.col("_l").isNull()).alias("false_positives"),
            F.count_if(F.col("_p").isNull()).alias("false_negatives"),
        )
        .withColumn("precision", part(hit, extra))
        .withColumn("recall", part(hit, missed))
        .withColumn("f1_score", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
    )


def split_by_days(
    series: DataFrame, train_days: int, keys: tuple[str, ...] = ("company_id", "metric")
) -> tuple[DataFrame, DataFrame]:
    """A series' first ``train_days`` days, and the days after them."""
    first = series.groupBy(*keys).agg(F.min("date").alias("_first"))
    placed = series.join(first, list(keys))
    early = F.datediff("date", "_first") < train_days
    return placed.filter(early).drop("_first"), placed.filter(~early).drop("_first")


def rolling_backtest(
    series: DataFrame, backs: tuple[int, ...] = (21, 14, 7), days: int = 7, trees: int = K.FOREST_TREES,
    keys: tuple[str, ...] = ("company_id",),
) -> DataFrame:
    """Errors of the forest on the ``days`` after each origin, beside the accepted ones.

    An origin is a series' last day less one of ``backs``; the forest sees the days up to it.
    The origin is one more key, so the forests of all series and origins grow in one job.
    """
    ids = [*keys, "metric"]
    last = series.groupBy(*ids).agg(F.max("date").alias("_last"))
    placed = series.join(last, ids).withColumn("_back", F.explode(F.array(*[F.lit(b) for b in backs]))).withColumn(
        "origin", F.date_sub("_last", F.col("_back")))
    own = (*keys, "origin")
    train = placed.filter(F.col("date") <= F.col("origin")).select(*own, "metric", "date", "value")
    held = placed.filter((F.col("date") > F.col("origin")) & (F.col("date") <= F.date_add("origin", days)))
    predicted = forecast(train, days, own, trees)
    errors = forecast_errors(held.select(*own, "metric", "date", "value"), predicted, (*own, "metric"))
    trained = train.groupBy(*own, "metric").agg(F.count(F.lit(1)).alias("train_days"))
    limits = F.create_map(*[x for m, three in K.FORECAST_LIMITS.items() for x in (F.lit(m), F.array(*[F.lit(v) for v in three]))])
    limit = F.try_element_at(limits, F.col("metric"))
    figures = ("mae", "rmse", "mape")
    out = errors.join(trained, [*own, "metric"]).withColumns({f"{f}_limit": limit[n] for n, f in enumerate(figures)})
    within = [F.col(f) <= F.col(f"{f}_limit") for f in figures]
    return out.withColumn("within_limits", within[0] & within[1] & within[2])
