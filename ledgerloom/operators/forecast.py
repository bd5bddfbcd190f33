"""Forest forecasts of daily series, with data gates, intervals and run status."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import by_task, ship_code
from .finance import daily_flows
from .series import dense_daily, lag_features
from .trees import (
    FOREST_FIELDS, Forest, grow_regression, join_blocks, leaf_values, leaf_values_one, seeded,
)

KEYS = ("company_id",)
INTEGER_METRICS = ("employee_headcount",)
_BLOCKS = 8


def metric_series(
    rows: DataFrame | None, headcounts: DataFrame | None, keys: tuple[str, ...] = KEYS, flows: DataFrame | None = None
) -> DataFrame:
    """(keys, metric, date, value): dense daily revenue, expenditure and headcount.

    ``flows`` are the daily flows of ``rows``, where they are known already.
    """
    parts = []
    if rows is not None or flows is not None:
        flows = dense_daily(daily_flows(rows, keys) if flows is None else flows, ["revenue", "expenditure"], keys)
        parts.append(
            flows.select(
                *keys,
                "date",
                F.explode(
                    F.create_map(
                        F.lit("revenue"), F.col("revenue"),
                        F.lit("expenditure"), F.col("expenditure"),
                    )
                ).alias("metric", "value"),
            ).select(*keys, "metric", "date", "value")
        )
    if headcounts is not None:
        parts.append(
            headcounts.select(
                *keys,
                F.lit("employee_headcount").alias("metric"),
                "date",
                F.col("headcount").alias("value"),
            )
        )
    series = parts[0]
    for part in parts[1:]:
        series = series.unionByName(part)
    return series


def forecast_gate(series: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Whether each series is long enough to model, and if not, why."""
    n = F.col("history_points")
    return (
        series.groupBy(*keys, "metric")
        .agg(F.count("*").alias("history_points"), F.max("date").alias("last_date"))
        .withColumn("training_rows", F.greatest(n - K.MAX_LAG, F.lit(0)))
        .withColumn(
            "status", F.when(n >= K.MIN_HISTORY_POINTS, "ok").otherwise("insufficient_data")
        )
        .withColumn(
            "message",
            F.when(
                n < K.MIN_HISTORY_POINTS,
                F.format_string(
                    f"Need at least {K.MIN_HISTORY_POINTS} daily points; found %d.", n
                ),
            ),
        )
    )


def _ids(keys: tuple[str, ...]) -> list[str]:
    return [*keys, "metric"]


def train_forests(
    frame: DataFrame, keys: tuple[str, ...] = KEYS, trees: int = K.FOREST_TREES
) -> DataFrame:
    """One row per series and block of trees.

    A series' training frame has a row per day, so copying it to every block is cheap
    and spreads one series' trees over several tasks.
    """
    ids = _ids(keys)
    per_block = -(-trees // _BLOCKS)
    features = list(K.FORECAST_FEATURES)
    seed = K.MODEL_SEED

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        *name, block = key
        pdf = pdf.sort_values("date")
        x, y = pdf[features].to_numpy(float), pdf["target"].to_numpy(float)
        order = np.argsort(x, axis=0, kind="stable").T
        forest = Forest()
        for tree in range(block * per_block, min(trees, (block + 1) * per_block)):
            grow_regression(
                forest, x, y, order, seeded(seed, *name, tree), K.FOREST_DEPTH, K.FOREST_MIN_LEAF
            )
        return pd.DataFrame([{**dict(zip(ids, name)), "block": block, **forest.columns()}])

    ship_code(frame.sparkSession)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(_BLOCKS - 1)))
    types = dict(frame.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in ids)
    return (
        by_task(frame.withColumn("block", blocks), *ids, "block")
        .groupBy(*ids, "block")
        .applyInPandas(grow, f"{schema}, block int, {FOREST_FIELDS}")
    )


def forecast(
    series: DataFrame,
    days: int = K.FORECAST_DAYS,
    keys: tuple[str, ...] = KEYS,
    trees: int = K.FOREST_TREES,
    integer_metrics: tuple[str, ...] = INTEGER_METRICS,
) -> DataFrame:
    """Recursive daily forecast of every series that passes the gate.

    Each day is predicted from the lags of history and earlier predictions.  The
    interval is 1.96 residual deviations of the training fit, widening linearly to twice
    that at the horizon.
    """
    ids = _ids(keys)
    gate = forecast_gate(series, keys).filter("status = 'ok'").select(*ids)
    usable = series.join(gate, ids, "left_semi")
    forests = train_forests(
        lag_features(usable, "value", tuple(ids)), keys, trees
    )
    depth = K.FOREST_DEPTH
    types = dict(series.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in ids)

    def walk(key: tuple, history: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        columns = ["date", "step", "predicted", "residual_std", "rows_used"]
        if history.empty or blocks.empty:
            return pd.DataFrame(columns=[*ids, *columns])
        forest = join_blocks(blocks.sort_values("block").itertuples())
        history = history.sort_values("date")
        dates = pd.to_datetime(history["date"])
        values = list(history["value"].astype(float))

        def row(past: list[float], day: pd.Timestamp) -> list[float]:
            # In the order of FORECAST_FEATURES.
            return [
                past[-1], past[-7], past[-14], np.mean(past[-7:]), np.mean(past[-14:]),
                day.dayofweek, day.month,
            ]

        start = K.MAX_LAG
        x = np.array([row(values[:i], dates.iloc[i]) for i in range(start, len(values))])
        residuals = np.array(values[start:]) - leaf_values(forest, x, depth)
        spread = float(np.std(residuals, ddof=1)) if len(residuals) > 1 else 0.0
        out = []
        for step in range(1, days + 1):
            day = dates.iloc[-1] + pd.Timedelta(days=step)
            value = max(0.0, leaf_values_one(forest, np.array(row(values, day)), depth))
            values.append(value)
            out.append((*key, day.date(), step, value, spread, len(x)))
        return pd.DataFrame(out, columns=[*ids, *columns])

    walked = (
        by_task(usable.select(*ids, "date", "value"), *ids)
        .groupBy(*ids)
        .cogroup(by_task(forests, *ids).groupBy(*ids))
        .applyInPandas(
            walk,
            f"{schema}, date date, step int, predicted double, residual_std double, "
            "rows_used int",
        )
    )
    return with_interval(walked, days, integer_metrics)


def with_interval(
    walked: DataFrame, days: int, integer_metrics: tuple[str, ...] = INTEGER_METRICS
) -> DataFrame:
    """Forecast rows with rounded value and bounds."""
    whole = F.col("metric").isin(*integer_metrics)
    half = F.greatest(
        F.when(whole, 1.0).otherwise(0.01),
        F.col("residual_std") * 1.96 * (1.0 + F.col("step") / F.lit(max(1, days))),
    )
    low = F.greatest(F.lit(0.0), F.col("predicted") - half)
    high = F.greatest(low, F.col("predicted") + half)

    def shown(value):
        value = F.greatest(F.lit(0.0), value)
        return F.when(whole, F.rint(value)).otherwise(F.bround(value, 2))

    return walked.select(
        *[c for c in walked.columns if c not in ("predicted", "residual_std")],
        shown(F.col("predicted")).alias("predicted_value"),
        shown(low).alias("lower_bound"),
        shown(high).alias("upper_bound"),
        F.lit("ok").alias("status"),
    )


def finance_status(revenue, expenditure):
    """Status of the finance insight from its two metrics."""
    return (
        F.when((revenue == "ok") & (expenditure == "ok"), "ok")
        .when((revenue == "insufficient_data") & (expenditure == "insufficient_data"),
              "insufficient_data")
        .otherwise("partial_data")
    )


def run_status(
    gates: DataFrame, rows_read: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Overall status of a company's run.

    ``gates`` has a status per metric, ``rows_read`` the employee and finance rows read
    (columns ``employees`` and ``finance``).
    """

    def status(metric: str):
        found = F.max(F.when(F.col("metric") == metric, F.col("status")))
        return F.coalesce(found, F.lit("insufficient_data")).alias(metric)

    metrics = ("employee_headcount", "revenue", "expenditure")
    per = rows_read.join(
        gates.groupBy(*keys).agg(*[status(m) for m in metrics]), list(keys), "left"
    ).fillna("insufficient_data", list(metrics))
    finance = finance_status(F.col("revenue"), F.col("expenditure"))
    per = per.withColumn("finance_status", finance)
    four = F.array("employee_headcount", "finance_status", "revenue", "expenditure")
    ok = F.size(F.filter(four, lambda s: s == "ok"))
    short = F.size(F.filter(four, lambda s: s == "insufficient_data"))
    return per.withColumn(
        "status",
        F.when((F.col("employees") == 0) & (F.col("finance") == 0), "no_input_data")
        .when(ok >= 3, "ok")
        .when((ok > 0) | (short > 0), "partial_data")
        .otherwise("insufficient_data"),
    )


def rounded_history(
    series: DataFrame, integer_metrics: tuple[str, ...] = INTEGER_METRICS
) -> DataFrame:
    """History as a run stores it: never negative, whole headcounts, cents otherwise."""
    value = F.greatest(F.lit(0.0), F.col("value"))
    whole = F.col("metric").isin(*integer_metrics)
    return series.withColumn("value", F.when(whole, F.rint(value)).otherwise(F.bround(value, 2)))


def clean_forecast(
    points: DataFrame, integer_metrics: tuple[str, ...] = INTEGER_METRICS
) -> DataFrame:
    """Forecast points fit for display: dated, numeric, never negative, whole headcounts."""
    whole = F.col("metric").isin(*integer_metrics)

    def shown(c: str):
        positive = F.greatest(F.col(c), F.lit(0.0))
        # The display layer rounds halves up.
        return F.when(whole, F.floor(positive + 0.5).cast("double")).otherwise(positive).alias(c)

    kept = [c for c in points.columns if c not in ("predicted_value", "lower_bound", "upper_bound")]
    return points.filter("date IS NOT NULL AND predicted_value IS NOT NULL").select(
        *kept, shown("predicted_value"), shown("lower_bound"), shown("upper_bound")
    )
