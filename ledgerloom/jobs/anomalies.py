"""The anomaly job: finance records to features, forests, anomalies, documents and one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import anomaly, finance, series
from ..session import materialize
from .inputs import Inputs
from .store import RunStore

JOB = "anomaly"
_AUDIT = "array<struct<at:timestamp,seq:bigint,actor:string,action:string,status:string,message:string,note:string>>"


def _names(features: tuple[str, ...]):
    return F.array(*[F.lit(f) for f in features])


def with_record_fields(found: DataFrame, records: DataFrame) -> DataFrame:
    """Add ``audit_trail`` (empty), ``features_used`` and ``details`` to anomaly rows.

    ``details`` holds a snapshot of the transaction or the day's record, and the features;
    ``records`` (record_id, raw) are met by the flagged ids only.
    """
    by_transaction = F.col("entity_type") == "transaction"
    found = anomaly.attach_details(found, records)
    day = F.struct(
        F.col("date").cast("string").alias("date"), "source_area", F.col("features.daily_total").alias("daily_total"),
        F.col("features.transaction_count").alias("transaction_count"))
    details = F.struct(
        F.when(by_transaction, F.coalesce("record_snapshot", F.lit("{}"))).alias("transaction"),
        F.when(~by_transaction, day).alias("record"), "features")
    return found.withColumns({
        "audit_trail": F.array().cast(_AUDIT),
        "features_used": F.when(by_transaction, _names(K.TRANSACTION_FEATURES)).otherwise(_names(K.DAILY_FEATURES)),
        "details": details,
    }).drop("record_snapshot", "features")


def run_facts(inputs: Inputs, rows: DataFrame, gate: DataFrame, found: DataFrame) -> DataFrame:
    """Per company: status, mode, message and counts of the run."""
    usable = rows.groupBy("company_id").agg(F.count(F.lit(1)).alias("usable"))
    areas = gate.groupBy("company_id").agg(
        F.max("mode").alias("gate_mode"), F.sum("transactions").alias("transactions"), F.sum("days").alias("days"),
        F.sum(F.when(F.col("model_key").isNotNull(), F.col("area_rows"))).alias("modelled"),
        F.count_distinct("model_key").alias("scored_groups"))
    total = found.groupBy("company_id").agg(F.count(F.lit(1)).alias("total"))
    per = inputs.counts()
    for part in (usable, areas, total):
        per = per.join(part, "company_id", "left")
    modelled = F.coalesce("modelled", F.lit(0))
    daily = F.col("gate_mode") == "daily"
    return per.select(
        "company_id",
        F.when(modelled == 0, "insufficient_data").when(F.coalesce("total", F.lit(0)) > 0, "ok").otherwise("no_anomalies_detected").alias("status"),
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("gate_mode", F.when(F.col("usable") > 0, "daily").otherwise("none")).alias("mode"),
        F.when(modelled > 0, modelled).otherwise(F.greatest(F.coalesce("transactions", F.lit(0)), F.coalesce("days", F.lit(0)))).alias("rows_modeled"),
        F.when(modelled > 0, F.when(daily, F.col("days")).otherwise(F.col("transactions"))).otherwise(F.col("finance")).alias("records_read"),
        F.coalesce("scored_groups", F.lit(0)).alias("scored_groups"),
        F.when(F.col("usable").isNull(), K.NO_FINANCE_ROWS).when(modelled == 0, K.SHORT_FINANCE_HISTORY).alias("message"),
        F.col("finance").alias("rows_processed"), F.col("finance_files").alias("input_files"),
        F.col("finance_unreadable").alias("unreadable_files"),
    )


def anomaly_documents(facts: DataFrame, found: DataFrame, generated_at: str) -> DataFrame:
    """One JSON document per company: its counts, and its anomalies, of which there are at most ``MAX_ANOMALIES``."""
    counts = anomaly.anomaly_counts(found).groupBy("company_id", "field").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n")))).alias("by"))

    def by(field: str, name: str) -> DataFrame:
        return counts.filter(F.col("field") == field).select("company_id", F.col("by").alias(name))

    items = found.groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("anomaly_score")).alias("_order"), F.col("anomaly_id").alias("_id"),
        F.struct(*[c for c in found.columns if c != "company_id"]).alias("item")))).getField("item").alias("anomalies"))
    per = facts
    for part in (by("severity", "by_severity"), by("anomaly_type", "by_type"), items):
        per = per.join(part, "company_id", "left")
    none = F.create_map().cast("map<string,bigint>")
    features = F.when(F.col("mode") == "transaction", _names(K.TRANSACTION_FEATURES)).when(
        F.col("mode") == "daily", _names(K.DAILY_FEATURES)).otherwise(F.array().cast("array<string>"))
    body = F.struct(
        F.lit(K.DOCUMENT_VERSION).alias("schema_version"), F.lit(generated_at).alias("generated_at"), "status",
        F.struct("total", F.coalesce("by_severity", none).alias("by_severity"), F.coalesce("by_type", none).alias("by_type")).alias("summary"),
        F.struct("input_files", "unreadable_files", "rows_processed").alias("source"),
        F.struct(
            "mode", F.lit(K.ISOLATION_MODEL).alias("model_name"),
            F.struct(F.lit(K.ISOLATION_TREES).alias("n_estimators"), F.lit(K.CONTAMINATION).alias("contamination"),
                     F.lit(K.MODEL_SEED).alias("random_state")).alias("parameters"),
            features.alias("feature_columns"), "rows_modeled", "records_read", "scored_groups",
            F.lit(K.MODEL_SEED).alias("random_state"), "message").alias("metadata"),
        F.coalesce("anomalies", F.array().cast(dict(items.dtypes)["anomalies"])).alias("anomalies"))
    return per.select(
        "company_id", F.lit(generated_at).cast("timestamp").alias("generated_at"), "status", F.to_json(body).alias("document"))


def anomaly_job(
    store: RunStore, read, run_id: str, generated_at: str, trees: int = K.ISOLATION_TREES, raise_errors: bool = True
) -> Row:
    """Score the finance records of every company of ``read()`` (``Inputs``) and commit the run.

    Tables of a run: ``documents`` (one per company), ``runs`` (counts and status), ``anomalies``
    and ``files``.  Ids of anomalies depend on the run's ``generated_at``, company and record, so
    a repeated run gives the same ones.
    """

    def build() -> dict[str, DataFrame]:
        inputs = read()
        records = inputs.records.filter("domain = 'finance'")
        typed = finance.normalize_finance(records, "job", raw="raw", keep=("raw",))
        rows = materialize(typed.select("company_id", "record_id", "event_ts", "date", "amount", "source_area"), "finance")
        daily = materialize(series.rolling_features(finance.daily_totals(rows)), "daily")
        gate = materialize(anomaly.model_gate(daily), "gate")
        flagged = anomaly.anomaly_rows(anomaly.isolation_scores(rows, trees=trees), generated_at)
        found = materialize(with_record_fields(materialize(flagged, "flagged"), typed.select("company_id", "record_id", "raw")), "anomalies")
        facts = materialize(run_facts(inputs, rows, gate, found), "facts")
        return {
            "files": inputs.files.filter("domain = 'finance'"), "runs": facts, "anomalies": found,
            "documents": anomaly_documents(facts, found, generated_at),
        }

    return store.run(JOB, run_id, generated_at, build, raise_errors)
