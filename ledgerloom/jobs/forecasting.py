"""The forecast job: records to series, gate, forests, documents and one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import finance, forecast, workforce
from ..session import materialize
from .inputs import Inputs
from .store import RunStore

JOB = "forecast"
METRICS = tuple(K.SERIES_AREAS)
_IDS = ["company_id", "metric"]
_POINT = "array<struct<date:string,value:double>>"
_AHEAD = "array<struct<date:string,predicted_value:double,lower_bound:double,upper_bound:double>>"


def source_rows(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    """Typed finance rows and employee events, written once."""
    def of(domain: str) -> DataFrame:
        return inputs.records.filter(F.col("domain") == domain)

    rows = finance.normalize_finance(of("finance"), "job", raw="raw").select(
        "company_id", "record_id", "event_ts", "date", "amount", "source_area")
    return materialize(rows, "finance"), materialize(workforce.employee_events(of("employees"), raw="raw", seq="seq"), "events")


def metric_states(inputs: Inputs, rows: DataFrame, events: DataFrame, series: DataFrame) -> DataFrame:
    """For every company and metric: status, message and counts, whether it has a series or not."""
    usable = rows.groupBy("company_id").agg(F.count(F.lit(1)).alias("finance_used"))
    seen = events.groupBy("company_id").agg(F.count(F.lit(1)).alias("employees_used"))
    per = inputs.counts().join(usable, "company_id", "left").join(seen, "company_id", "left").fillna(0)
    per = per.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in METRICS])))
    gate = forecast.forecast_gate(series).drop("message")
    heads = F.col("metric") == "employee_headcount"
    read = F.when(heads, F.col("employees")).otherwise(F.col("finance"))
    used = F.when(heads, F.col("employees_used")).otherwise(F.col("finance_used"))

    def absent(texts: tuple[str, str], domain: str):
        found, none = texts
        before, after = none.split("%s")
        return F.when(read > 0, found).otherwise(F.concat(F.lit(before), "company_id", F.lit(f"/{domain}/{after}")))

    short = F.format_string(K.SHORT_SERIES, F.lit(K.MIN_HISTORY_POINTS), F.lit(K.FOREST_MODEL), F.col("history_points"))
    found = per.join(gate, _IDS, "left").withColumn(
        "message",
        F.when(F.col("status") == "ok", None)
        .when(F.col("status").isNotNull(), short)
        .otherwise(F.when(heads, absent(K.NO_EMPLOYEE_SERIES, "employees")).otherwise(absent(K.NO_FINANCE_SERIES, "finance"))),
    )
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    return found.select(
        *_IDS, F.coalesce("status", F.lit("insufficient_data")).alias("status"), "message",
        F.coalesce("history_points", F.lit(0)).cast("bigint").alias("history_points"), "last_date",
        F.when(ok, F.col("training_rows")).otherwise(0).cast("bigint").alias("rows_used"),
        used.cast("bigint").alias("source_rows"),
        F.element_at(F.create_map(*[F.lit(x) for pair in K.SERIES_AREAS.items() for x in pair]), F.col("metric")).alias("source_area"),
        F.lit(K.FOREST_MODEL).alias("model_name"),
        F.array(*[F.lit(f) for f in K.FORECAST_FEATURES]).alias("features_used"),
    )


def forecast_documents(metrics: DataFrame, history: DataFrame, ahead: DataFrame, runs: DataFrame, generated_at: str, days: int) -> DataFrame:
    """One JSON document per company: its counts, and each metric with its history and forecast."""
    def points(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
        entry = F.struct(F.col("date").cast("string").alias("date"), *columns)
        return rows.groupBy(*_IDS).agg(F.sort_array(F.collect_list(entry)).alias(name))  # a row per day

    past = points(history, ["value"], "history")
    coming = points(ahead, ["predicted_value", "lower_bound", "upper_bound"], "forecast")
    entry = F.struct(
        "metric", "status", "message", "model_name", "source_area", F.lit(days).alias("forecast_days"), "rows_used",
        "source_rows", "history_points", "features_used",
        F.coalesce("history", F.array().cast(_POINT)).alias("history"), F.coalesce("forecast", F.array().cast(_AHEAD)).alias("forecast"))
    per = metrics.join(past, _IDS, "left").join(coming, _IDS, "left").groupBy("company_id").agg(
        F.sort_array(F.collect_list(F.struct("metric", entry.alias("entry")))).getField("entry").alias("metrics"))
    body = F.struct(
        F.lit(K.DOCUMENT_VERSION).alias("schema_version"), F.lit(generated_at).alias("generated_at"), "status",
        F.struct("employees", "finance").alias("rows_processed"),
        F.struct(F.col("employees_files").alias("employees"), F.col("finance_files").alias("finance")).alias("input_files"),
        F.struct(F.col("employees_unreadable").alias("employees"), F.col("finance_unreadable").alias("finance")).alias("unreadable_files"),
        F.struct("finance_status", F.col("employee_headcount").alias("employee_status")).alias("insights"), "metrics")
    return runs.join(per, "company_id").select(
        "company_id", F.lit(generated_at).cast("timestamp").alias("generated_at"), "status",
        F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))


def forecast_job(
    store: RunStore, read, run_id: str, generated_at: str, days: int = K.FORECAST_DAYS, trees: int = K.FOREST_TREES,
    raise_errors: bool = True,
) -> Row:
    """Forecast every metric of every company of ``read()`` (``Inputs``) and commit the run.

    Tables of a run: ``documents`` (one per company), ``metrics`` (states), ``points`` (history
    and forecast) and ``files`` (what was read).  A company without records has a document that
    says so.
    """

    def build() -> dict[str, DataFrame]:
        inputs = read()
        rows, events = source_rows(inputs)
        series = materialize(forecast.metric_series(rows, workforce.headcount(events)), "series")
        metrics = materialize(metric_states(inputs, rows, events, series), "metrics")
        ahead = materialize(forecast.forecast(series, days, trees=trees), "ahead")
        history = forecast.rounded_history(series)
        runs = forecast.run_status(metrics.select(*_IDS, "status"), inputs.counts())
        named = ahead.withColumns({
            "model_name": F.lit(K.FOREST_MODEL), "features_used": F.array(*[F.lit(f) for f in K.FORECAST_FEATURES])})
        points = history.select(*_IDS, "date", F.lit(0).alias("step"), "value").unionByName(
            named.withColumnRenamed("predicted_value", "value"), allowMissingColumns=True)
        return {
            "files": inputs.files, "metrics": metrics, "points": points,
            "documents": forecast_documents(metrics, history, ahead, runs, generated_at, days),
        }

    return store.run(JOB, run_id, generated_at, build, raise_errors)
