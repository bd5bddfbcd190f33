"""Metric windows and alarm states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import exact


def metric_windows(
    metrics: DataFrame, keys: tuple[str, ...] = ("metric",), minutes: int = 5
) -> DataFrame:
    """Sum, mean, maximum and count of each metric per tumbling window."""
    total = F.sum(exact(F.col("value"))).cast("double")
    return (
        metrics.groupBy(*keys, F.window("ts", f"{minutes} minutes").alias("_w"))
        .agg(
            total.alias("sum_value"),
            (total / F.count("value")).alias("avg_value"),
            F.max("value").alias("max_value"),
            F.count("value").alias("n"),
        )
        .select(*keys, F.col("_w.start").alias("window_start"), "sum_value", "avg_value", "max_value", "n")
    )


def error_line_windows(
    logs: DataFrame, keys: tuple[str, ...] = ("service",), minutes: int = 5
) -> DataFrame:
    """Log lines naming an error per window, as a metric of their own."""
    return (
        logs.filter(F.col("message").rlike("|".join(K.ERROR_LINE_WORDS)))
        .groupBy(*keys, F.window("ts", f"{minutes} minutes").alias("_w"))
        .agg(F.count("*").alias("n"))
        .select(*keys, F.col("_w.start").alias("window_start"), "n")
    )


def rules(spark) -> DataFrame:
    """The alarm rules: statistic, threshold and periods of each."""
    return spark.createDataFrame(
        [r for r in K.ALARM_RULES],
        "alarm string, stat string, threshold double, periods int, in_composite boolean",
    )


def evaluate_alarms(
    windows: DataFrame, rules: DataFrame, bindings: DataFrame, minutes: int = 5
) -> DataFrame:
    """State of every rule at every window of its metric.

    ``bindings`` maps ``alarm`` to ``metric``.  A window breaches when its statistic
    exceeds the threshold; the alarm is on after the rule's number of breaching windows
    in a row.  A window without data does not breach and so breaks the row.
    """
    stat = (
        F.when(F.col("stat") == "sum", F.col("sum_value"))
        .when(F.col("stat") == "avg", F.col("avg_value"))
        .otherwise(F.col("max_value"))
    )
    # Breaching windows that adjoin share "number of the window minus rank among
    # breaches"; the rank inside such a run is its length so far.
    number = F.floor(F.unix_seconds("window_start") / (minutes * 60))
    rank = F.row_number().over(W.partitionBy("alarm", "breach").orderBy("window_start"))
    length = F.row_number().over(W.partitionBy("alarm", "breach", "_run").orderBy("window_start"))
    return (
        windows.join(bindings.join(rules, "alarm"), "metric")
        .withColumn("value", stat)
        .withColumn("breach", F.col("value") > F.col("threshold"))
        .withColumn("_run", number - rank)
        .withColumn("_length", length)
        .select(
            "alarm", "metric", "window_start", "value", "breach",
            F.when(F.col("breach") & (F.col("_length") >= F.col("periods")), "ALARM")
            .otherwise("OK").alias("state"),
            "in_composite",
        )
    )


def composite_state(states: DataFrame) -> DataFrame:
    """Whether any alarm of the composite is on in a window."""
    on = F.col("in_composite") & (F.col("state") == "ALARM")
    return states.groupBy("window_start").agg(
        F.when(F.max(on.cast("int")) == 1, "ALARM").otherwise("OK").alias("state"),
        F.count_if(on).alias("alarms_on"),
    )
