"""Forecast views: month-end projection, confidence, risk and headline figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import exact
from .series import trailing_days

KEYS = ("company_id",)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(exact(value)).cast("double"), F.lit(0.0))


def _mean(value: Column) -> Column:
    return F.sum(exact(value)).cast("double") / F.count(value)


def spend_actuals(spent: DataFrame, horizon: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Dense actual spend shown next to a forecast of the given horizon."""
    return trailing_days(spent, "value", K.ACTUAL_DAYS_BY_HORIZON.get(horizon, 30), keys)


def month_end(
    spent: DataFrame,
    ahead: DataFrame,
    monthly: DataFrame | None = None,
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """Projected spend at the end of each company's current month.

    Month to date, plus the forecast days left in the month, plus the mean forecast for
    days the forecast does not reach.  ``monthly`` (``expenditure`` of the month before)
    replaces the previous month's sum where it is positive.
    """
    last = spent.groupBy(*keys).agg(F.max("date").alias("latest_actual_date"))
    month = F.trunc("date", "month")
    this = F.trunc("latest_actual_date", "month")
    value = F.col("value")
    actual = spent.join(last, list(keys)).groupBy(*keys, "latest_actual_date").agg(
        _total(F.when(month == this, value)).alias("current_month_actual"),
        _total(F.when(month == F.add_months(this, -1), value)).alias("previous_month_spend"),
    )
    here = (F.col("date") > F.col("latest_actual_date")) & (month == this)
    coming = F.col("predicted_value")
    projected = ahead.join(last, list(keys)).groupBy(*keys).agg(
        F.count_if(here).alias("coverage_days"),
        _total(F.when(here, coming)).alias("_sum"),
        _mean(F.when(here, coming)).alias("_mean_here"),
        _mean(coming).alias("_mean_all"),
    )
    out = (
        actual.join(projected, list(keys), "left")
        .fillna({"coverage_days": 0, "_sum": 0.0})
        .withColumn("_left", F.datediff(F.last_day("latest_actual_date"), "latest_actual_date"))
        .withColumn(
            "fallback_days", F.greatest(F.lit(0), F.col("_left") - F.col("coverage_days"))
        )
        .withColumn(
            "projected_month_end_spend",
            F.col("current_month_actual") + F.col("_sum")
            + F.coalesce("_mean_here", "_mean_all", F.lit(0.0)) * F.col("fallback_days"),
        )
    )
    if monthly is not None:
        out = out.join(monthly, list(keys), "left").withColumn(
            "previous_month_spend",
            F.when(F.col("dashboard_previous_spend") > 0, F.col("dashboard_previous_spend"))
            .otherwise(F.col("previous_month_spend")),
        ).drop("dashboard_previous_spend")
    before = F.col("previous_month_spend")
    return out.withColumn(
        "projected_vs_last_month",
        F.when(before > 0, (F.col("projected_month_end_spend") - before) / before * 100),
    ).drop("_sum", "_mean_here", "_mean_all", "_left")


def previous_month_baseline(monthly: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Spend of the last month but one in a monthly table."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("month")))
    return (
        monthly.withColumn("_n", n)
        .filter("_n = 2")
        .select(*keys, F.col("expenditure").alias("dashboard_previous_spend"))
    )


def interval_ratio(points: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Mean interval width over mean value of every (company, metric)."""
    whole = points.filter(
        "predicted_value IS NOT NULL AND lower_bound IS NOT NULL AND upper_bound IS NOT NULL"
    )
    width = F.greatest(F.lit(0.0), F.col("upper_bound") - F.col("lower_bound"))
    ratio = width / F.greatest(F.lit(1.0), F.col("predicted_value"))
    return whole.groupBy(*keys, "metric").agg(_mean(ratio).alias("ratio"))


def confidence_band(ratio: Column) -> Column:
    return (
        F.when(ratio.isNull(), 68)
        .when(ratio <= 0.15, 90)
        .when(ratio <= 0.3, 76)
        .when(ratio <= 0.45, 61)
        .otherwise(46)
    )


def forecast_confidence(
    points: DataFrame, health: DataFrame, keys: tuple[str, ...] = KEYS,
    metrics: tuple[str, ...] = ("expenditure", "employee_headcount"),
) -> DataFrame:
    """Confidence from data health (65 %) and interval width (35 %)."""
    ratios = interval_ratio(points, keys).filter(F.col("metric").isin(*metrics))
    per = ratios.groupBy(*keys).agg(F.avg("ratio").alias("interval_ratio"))
    band = confidence_band(F.col("interval_ratio"))
    score = F.floor(
        F.coalesce("data_health_percent", band) * F.lit(0.65) + band * F.lit(0.35) + 0.5
    )
    out = health.select(*keys, "data_health_percent").join(per, list(keys), "left")
    return out.withColumn("score", score.cast("bigint")).withColumn(
        "label",
        F.when(F.col("score") >= 78, "High").when(F.col("score") >= 58, "Medium").otherwise("Low"),
    )


def forecast_risk(facts: DataFrame) -> DataFrame:
    """Risk label and its first two reasons.

    ``facts`` has ``projected_vs_last_month``, ``unusual_expense_count``, ``score`` (the
    confidence) and ``headcount_change``; missing values add nothing.
    """
    over = F.col("projected_vs_last_month")
    rules = [
        (over >= 10, 2, "spend is tracking materially above last month"),
        ((over >= 4) & (over < 10), 1, "spend is trending above last month"),
        (F.col("unusual_expense_count") > 0, 1, "recent transactions are less predictable"),
        (F.col("score") < 58, 1, "forecast confidence is limited"),
        (F.col("headcount_change") >= 5, 1, "payroll demand is increasing"),
    ]
    points = reduce(
        lambda a, b: a + b, [F.when(rule, F.lit(n)).otherwise(0) for rule, n, _ in rules]
    )
    reasons = F.array_compact(F.array(*[F.when(rule, text) for rule, _, text in rules]))
    return facts.withColumn("risk_score", points).withColumn(
        "risk_reasons", F.array_join(F.slice(reasons, 1, 2), " and ")
    ).withColumn(
        "risk_label",
        F.when(F.col("risk_score") >= 3, "High")
        .when(F.col("risk_score") >= 1, "Medium")
        .otherwise("Low"),
    )


def forecast_headline(
    points: DataFrame, current: DataFrame, horizon: int = 30, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Projected headcount at the horizon, its change and its peak.

    ``current`` has ``total_employees`` per company; the last forecast value stands in
    where it is 0 or missing.
    """
    ahead = points.filter("metric = 'employee_headcount'")
    n = F.row_number().over(W.partitionBy(*keys).orderBy("date"))
    value = F.col("predicted_value")
    inside = F.col("_n") <= horizon
    per = (
        ahead.withColumn("_n", n)
        .groupBy(*keys)
        .agg(
            F.max_by(F.when(inside, value), F.when(inside, F.col("_n"))).alias("_projected"),
            F.max_by(value, "_n").alias("_last"),
            F.max(F.when(inside, value)).alias("_peak"),
        )
    )
    known = F.when(F.col("total_employees") != 0, F.col("total_employees"))
    return (
        current.select(*keys, "total_employees")
        .join(per, list(keys), "left")
        .withColumn("current_headcount", F.coalesce(known, "_last", F.lit(0.0)))
        .withColumn(
            "projected_headcount", F.coalesce("_projected", "_last", "current_headcount")
        )
        .withColumn(
            "headcount_change", F.col("projected_headcount") - F.col("current_headcount")
        )
        .withColumn(
            "peak_headcount",
            F.greatest("current_headcount", F.coalesce("_peak", "current_headcount")),
        )
        .drop("_projected", "_last", "_peak", "total_employees")
    )
