"""Run documents: nested JSON of a run, its parts flattened again, and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ("company_id",)
_POINT = "struct<date:string,value:double>"
_AHEAD = "struct<date:string,predicted_value:double,lower_bound:double,upper_bound:double>"
DOCUMENT_SCHEMA = (
    "schema_version string, generated_at string, status string, "
    "rows_processed struct<employees:bigint,finance:bigint>, "
    f"metrics array<struct<metric:string,status:string,history:array<{_POINT}>,"
    f"forecast:array<{_AHEAD}>>>"
)


def run_files(
    records: DataFrame, keys: tuple[str, ...] = KEYS, dataset: str = "dataset", file: str = "source_file"
) -> DataFrame:
    """The files a run read, one row each with its number of records."""
    return records.groupBy(*keys, dataset, file).agg(F.count("*").alias("rows_read"))


def run_diagnostics(
    records: DataFrame, keys: tuple[str, ...] = KEYS, dataset: str = "dataset", file: str = "source_file"
) -> DataFrame:
    """Rows and files read per company and dataset.

    The files themselves stay rows (``run_files``): a list of them would grow without
    end in one row.
    """
    return run_files(records, keys, dataset, file).groupBy(*keys, dataset).agg(
        F.sum("rows_read").alias("rows_processed"), F.count("*").alias("input_files")
    )


def anomaly_run_summary(
    scored: DataFrame, read: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Per company: rows read and modelled, models used, anomalies and the run's status."""
    per = scored.groupBy(*keys).agg(
        F.sum("copies").alias("rows_modeled"),
        F.count_distinct("model_key").alias("scored_groups"),
        F.sum(F.when(F.col("anomaly_flag"), F.col("copies")).otherwise(0)).alias("flagged"),
        F.max("mode").alias("mode"),
    )
    rows = F.coalesce("rows_modeled", F.lit(0))
    return read.join(per, list(keys), "left").withColumn(
        "status",
        F.when(rows == 0, "insufficient_data")
        .when(F.col("flagged") > 0, "ok")
        .otherwise("no_anomalies_detected"),
    )


def run_documents(
    history: DataFrame, forecast: DataFrame, runs: DataFrame, generated_at: str,
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """One JSON document per company from flat history and forecast points.

    A list holds one entry per day of a series.
    """
    ids = [*keys, "metric"]

    def points(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
        entry = F.struct(F.col("date").cast("string").alias("date"), *columns)
        return rows.groupBy(*ids).agg(F.sort_array(F.collect_list(entry)).alias(name))

    past = points(history, ["value"], "history")
    ahead = points(forecast, ["predicted_value", "lower_bound", "upper_bound"], "forecast")
    per_metric = past.join(ahead, ids, "full_outer").select(
        *keys,
        F.struct(
            "metric",
            F.when(F.col("forecast").isNotNull(), "ok").otherwise("insufficient_data").alias("status"),
            F.coalesce("history", F.array().cast(f"array<{_POINT}>")).alias("history"),
            F.coalesce("forecast", F.array().cast(f"array<{_AHEAD}>")).alias("forecast"),
        ).alias("_m"),
    )
    metrics = per_metric.groupBy(*keys).agg(
        F.array_sort(F.collect_list("_m"), lambda a, b: F.when(a.metric < b.metric, -1).when(a.metric > b.metric, 1).otherwise(0)).alias("metrics")
    )
    body = F.struct(
        F.lit("2.0").alias("schema_version"),
        F.lit(generated_at).alias("generated_at"),
        "status",
        F.struct(
            F.col("employees").cast("bigint").alias("employees"),
            F.col("finance").cast("bigint").alias("finance"),
        ).alias("rows_processed"),
        "metrics",
    )
    return runs.join(metrics, list(keys), "left").select(
        *keys, F.lit(generated_at).cast("timestamp").alias("generated_at"),
        F.to_json(body).alias("document"),
    )


def latest_run(runs: DataFrame, companies: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Each company's newest document and its state: found, invalid or no prediction."""
    newest = F.row_number().over(
        W.partitionBy(*keys).orderBy(F.desc("generated_at"), F.desc("document"))
    )
    last = runs.withColumn("_n", newest).filter("_n = 1").drop("_n")
    parsed = F.from_json("document", DOCUMENT_SCHEMA + ", _corrupt_record string",
                         {"columnNameOfCorruptRecord": "_corrupt_record"})
    return (
        companies.select(*keys).join(last, list(keys), "left")
        .withColumn("_doc", parsed)
        .withColumn("_bad", F.col("_doc._corrupt_record").isNotNull() | F.col("_doc").isNull())
        .withColumn(
            "state",
            F.when(F.col("document").isNull(), "no_prediction")
            .when(F.col("_bad"), "invalid_prediction")
            .otherwise("found"),
        )
        .withColumn(
            "status",
            F.when(F.col("state") == "found", F.coalesce("_doc.status", F.lit("unknown")))
            .otherwise(F.col("state")),
        )
        .withColumn("prediction", F.when(F.col("state") == "found", F.col("_doc")))
        .drop("_doc", "_bad", "document")
    )


def flatten_history(runs: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """History points of parsed documents."""
    per = runs.select(*keys, F.explode("prediction.metrics").alias("_m"))
    return per.select(*keys, F.col("_m.metric").alias("metric"), F.explode("_m.history").alias("_p")).select(
        *keys, "metric", F.col("_p.date").try_cast("date").alias("date"), F.col("_p.value").alias("value")
    )


def flatten_forecast(runs: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Forecast points of parsed documents."""
    per = runs.select(*keys, F.explode("prediction.metrics").alias("_m"))
    return per.select(*keys, F.col("_m.metric").alias("metric"), F.explode("_m.forecast").alias("_p")).select(
        *keys, "metric", F.col("_p.date").try_cast("date").alias("date"),
        "_p.predicted_value", "_p.lower_bound", "_p.upper_bound",
    )


def with_fallback(preferred: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``preferred``, and of ``other`` for keys without any."""
    have = preferred.select(*keys).distinct()
    return preferred.unionByName(other.join(have, keys, "left_anti"))


def dashboard(
    kpis: DataFrame, monthly: DataFrame, chart: DataFrame, departments: DataFrame,
    weekly: DataFrame, sources: DataFrame, keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """One JSON bundle per company: metric cards, four charts of bounded length, sources."""

    def bundle(rows: DataFrame, order: list[str], columns: list[str], name: str) -> DataFrame:
        entries = F.sort_array(F.collect_list(F.struct(*order, *[c for c in columns if c not in order])))
        return rows.groupBy(*keys).agg(
            F.transform(entries, lambda e: F.struct(*[e[c].alias(c) for c in columns])).alias(name)
        )

    charts = [
        bundle(monthly, ["month"], ["label", "revenue", "expenditure"], "revenue_expenses"),
        bundle(chart, ["date", "is_forecast"], ["label", "value", "is_forecast"], "employee_growth"),
        bundle(departments, ["rank"], ["label", "value"], "department_distribution"),
        bundle(weekly, ["date"], ["label", "value"], "weekly_activity"),
    ]
    metrics = F.struct(*[c for c in kpis.columns if c not in keys])
    out = kpis.select(*keys, metrics.alias("metrics"))
    names = [c.columns[-1] for c in charts]
    for part in charts:
        out = out.join(part, list(keys), "left")
    facts = sources.select(*keys, F.struct(*[c for c in sources.columns if c not in keys]).alias("sources"))
    return out.join(facts, list(keys), "left").select(
        *keys,
        F.to_json(F.struct("metrics", F.struct(*names).alias("charts"), "sources")).alias("payload"),
    )
