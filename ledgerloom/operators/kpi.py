"""Dashboard figures from history points, forecast points and run facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import exact, percent_change

KEYS = ("company_id",)


def _ranked(points: DataFrame, ids: list[str]) -> DataFrame:
    """Points with their distance from the newest and the oldest of the series."""
    w = W.partitionBy(*ids)
    return (
        points.withColumn("_back", F.row_number().over(w.orderBy(F.desc("date"))))
        .withColumn("_n", F.count("*").over(w))
    )


def _at(place: Column, value: str = "value") -> Column:
    return F.max(F.when(F.col("_back") == place, F.col(value)))


def employee_kpi(
    history: DataFrame, forecast: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Latest headcount and its change from 30 points before (or the first point).

    Companies without history fall back to their forecast.
    """
    whole = F.when(F.col("value") >= 0, F.floor("value"))
    past = history.filter("metric = 'employee_headcount'").select(*keys, "date", "value")
    ahead = forecast.filter("metric = 'employee_headcount'").select(
        *keys, "date", F.col("predicted_value").alias("value")
    )
    points = past.unionByName(
        ahead.join(past.select(*keys).distinct(), list(keys), "left_anti")
    ).withColumn("value", whole.cast("double")).filter("value IS NOT NULL")
    base = F.when(F.col("_base") > 0, F.col("_base"))
    return (
        _ranked(points, list(keys))
        .groupBy(*keys)
        .agg(
            _at(F.lit(1)).alias("total_employees"),
            _at(F.least(F.lit(31), F.col("_n"))).alias("_base"),
        )
        .withColumn(
            "employees_delta_percent",
            F.bround((F.col("total_employees") - base) / base * 100, 2),
        )
        .drop("_base")
    )


def revenue_kpi(history: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Latest revenue point and its change from the one before."""
    points = history.filter("metric = 'revenue' AND value >= 0")
    change = percent_change(F.col("_previous"), F.col("revenue"))
    return (
        _ranked(points, list(keys))
        .groupBy(*keys)
        .agg(_at(F.lit(1)).alias("revenue"), _at(F.lit(2)).alias("_previous"))
        .withColumn("revenue_delta_percent", F.bround(change, 2))
        .withColumn("revenue", F.bround("revenue", 2))
        .drop("_previous")
    )


def growth_kpi(forecast: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Headcount change over the forecast, first to last point; 0 without two points."""
    points = forecast.filter("metric = 'employee_headcount'").withColumn(
        "value", F.col("predicted_value")
    ).filter("value IS NOT NULL")
    start, end = F.col("_start"), F.col("_end")
    return (
        _ranked(points, list(keys))
        .groupBy(*keys)
        .agg(
            _at(F.lit(1)).alias("_end"), _at(F.col("_n")).alias("_start"),
            F.max("_n").alias("_points"),
        )
        .withColumn(
            "growth_percent",
            F.when((F.col("_points") < 2) | (start == 0), 0.0).otherwise(
                F.bround((end - start) / start * 100, 2)
            ),
        )
        .select(*keys, "growth_percent")
    )


def data_health(status: Column, rows: Column) -> tuple[Column, Column]:
    """(percent, reasons): 50 or 25 for the run status, 50 for any rows."""
    score = F.when(status == "ok", 50).when(status == "partial_data", 25).otherwise(0)
    words = (
        F.when(status == "ok", "prediction status ok")
        .when(status == "partial_data", "partial data")
        .otherwise("limited prediction quality")
    )
    counted = F.when(rows > 0, F.concat(rows.cast("string"), F.lit(" rows processed")))
    percent = F.least(F.lit(100), score + F.when(rows > 0, 50).otherwise(0))
    return percent, F.concat_ws(", ", words, counted)


def kpi_metrics(
    history: DataFrame, forecast: DataFrame, runs: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The metric cards of every company with a run.

    ``runs`` has one row per company: ``status`` and ``rows_processed``.
    """
    percent, reasons = data_health(
        F.coalesce("status", F.lit("no_prediction")), F.coalesce("rows_processed", F.lit(0))
    )
    cards = runs.select(
        *keys, percent.alias("data_health_percent"), reasons.alias("data_health_reasons")
    )
    for part in (
        employee_kpi(history, forecast, keys), revenue_kpi(history, keys), growth_kpi(forecast, keys),
    ):
        cards = cards.join(part, list(keys), "left")
    return cards.fillna({"total_employees": 0.0, "revenue": 0.0, "growth_percent": 0.0})


def headcount_chart(
    history: DataFrame, forecast: DataFrame, k: int = 16, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The last points of history and forecast together, history first on a shared day."""
    past = history.filter("metric = 'employee_headcount'").select(
        *keys, "date", F.col("value"), F.lit(False).alias("is_forecast")
    )
    ahead = forecast.filter("metric = 'employee_headcount'").select(
        *keys, "date", F.col("predicted_value").alias("value"), F.lit(True).alias("is_forecast")
    )
    newest = F.row_number().over(
        W.partitionBy(*keys).orderBy(F.desc("date"), F.desc("is_forecast"))
    )
    return (
        past.unionByName(ahead)
        .filter("date IS NOT NULL AND value IS NOT NULL")
        .withColumn("_n", newest)
        .filter(F.col("_n") <= k)
        .select(
            *keys,
            "date",
            F.date_format("date", "MMM dd").alias("label"),
            F.rint(F.greatest("value", F.lit(0.0))).cast("bigint").alias("value"),
            "is_forecast",
        )
    )


def recent_actuals(
    chart: DataFrame, current: DataFrame, horizon: int, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Actual points shown before a forecast: the last 8, 6 or 5 by horizon, or one point
    labelled ``Current`` for a company that has none."""
    limit = 8 if horizon >= 90 else 6 if horizon >= 30 else 5
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("date")))
    points = (
        chart.filter("NOT is_forecast")
        .withColumn("_n", newest)
        .filter(F.col("_n") <= limit)
        .select(*keys, "date", "label", "value")
    )
    single = (
        current.filter("total_employees > 0")
        .join(points.select(*keys).distinct(), list(keys), "left_anti")
        .select(
            *keys,
            F.lit(None).cast("date").alias("date"),
            F.lit("Current").alias("label"),
            F.rint("total_employees").cast("bigint").alias("value"),
        )
    )
    return points.unionByName(single)


def series_insight(
    series: DataFrame, last: int | None = 6, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Latest, mean, extremes (the earliest on ties) and last change of a series window."""
    ranked = _ranked(series, list(keys))
    if last:
        ranked = ranked.filter(F.col("_back") <= last)
    latest, previous = F.col("latest"), F.col("_previous")
    return (
        ranked.groupBy(*keys)
        .agg(
            F.count("*").alias("points"),
            _at(F.lit(1)).alias("latest"),
            F.max("date").alias("latest_date"),
            _at(F.lit(2)).alias("_previous"),
            (F.sum(exact(F.col("value"))).cast("double") / F.count("*")).alias("average"),
            F.max("value").alias("max_value"),
            F.max_by("date", F.struct("value", "_back")).alias("max_date"),
            F.min("value").alias("min_value"),
            F.min_by("date", F.struct("value", "date")).alias("min_date"),
        )
        .withColumn("delta", F.coalesce(latest - previous, F.lit(0.0)))
        .withColumn("delta_percent", percent_change(previous, latest))
        .drop("_previous")
    )
