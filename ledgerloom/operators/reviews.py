"""Anomaly review: fold reviewer actions, merge them into lists, filter and summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import parse_instant
from ..functions.values import non_blank, strip

KEYS = ("company_id",)
_LIST_FILTERS = ("anomaly_type", "severity", "status", "entity_type")


def normalize_actions(actions: DataFrame) -> DataFrame:
    """Canonical action, resulting status and message; ``invalid`` names what is wrong.

    A blank action means "reviewed"; a given status overrides the action's own.
    """
    word = F.lower(strip(F.coalesce(F.nullif("action", F.lit("")), F.lit("mark_reviewed"))))
    word = F.translate(word, "- ", "__")
    synonyms = F.create_map(*[F.lit(x) for pair in K.REVIEW_SYNONYMS.items() for x in pair])
    known = F.create_map(
        *[
            x
            for name, (status, message) in K.REVIEW_ACTIONS.items()
            for x in (
                F.lit(name),
                F.struct(F.lit(status).alias("status"), F.lit(message).alias("message")),
            )
        ]
    )
    given = F.lower(non_blank(F.col("status")))
    return (
        actions.withColumn("action", F.coalesce(F.try_element_at(synonyms, word), word))
        .withColumn("_def", F.try_element_at(known, F.col("action")))
        .withColumn(
            "invalid",
            F.when(F.col("_def").isNull(), "unsupported_action").when(
                ~given.isin(*K.REVIEW_STATUSES), "invalid_status"
            ),
        )
        .withColumn("status", F.coalesce(given, F.col("_def.status")))
        .withColumn("message", F.col("_def.message"))
        .withColumn("note", non_blank(F.col("note")))
        .drop("_def")
    )


def review_state(
    actions: DataFrame,
    keys: tuple[str, ...] = KEYS,
    audit_limit: int = K.AUDIT_LIMIT,
    notes_limit: int = K.NOTES_LIMIT,
) -> DataFrame:
    """Current review of every anomaly: last status, the newest audit entries and notes.

    The newest entries are picked by rank, which Spark limits before the shuffle, so an
    anomaly with endless actions brings at most the kept number from each task.
    """
    ids = [*keys, "anomaly_id"]
    valid = normalize_actions(actions).filter("invalid IS NULL")
    newest = F.row_number().over(W.partitionBy(*ids).orderBy(F.desc("at"), F.desc("seq")))

    def history(rows: DataFrame, limit: int, columns: list, name: str) -> DataFrame:
        entries = F.sort_array(F.collect_list(F.struct("at", "seq", *columns)))
        return (
            rows.withColumn("_n", newest)
            .filter(F.col("_n") <= limit)
            .groupBy(*ids)
            .agg(entries.alias(name))
        )

    audit = history(
        valid, audit_limit, ["actor", "action", "status", "message", "note"], "audit_trail"
    )
    notes = history(
        valid.filter("note IS NOT NULL"), notes_limit,
        [F.col("actor").alias("author"), "note", "action"], "notes",
    )
    last = F.element_at("audit_trail", -1)
    return (
        audit.join(notes, ids, "left")
        .withColumn("status", last.getField("status"))
        .withColumn("last_action", last.getField("action"))
        .withColumn("updated_at", last.getField("at"))
        .withColumn("updated_by", last.getField("actor"))
    )


def normalize_items(items: DataFrame) -> DataFrame:
    """Anomaly items with defaults: an id is required, blank list entries are dropped."""
    out = items.withColumn("anomaly_id", non_blank(F.col("anomaly_id"))).filter(
        "anomaly_id IS NOT NULL"
    )
    defaults = {
        "status": "new", "severity": "low", "anomaly_type": "unknown", "entity_type": "unknown",
    }
    for name, default in defaults.items():
        out = out.withColumn(name, F.coalesce(F.nullif(name, F.lit("")), F.lit(default)))
    for name in ("record_ids", "reasons"):
        if name in out.columns:
            out = out.withColumn(
                name,
                F.filter(
                    F.coalesce(name, F.array().cast("array<string>")), lambda x: F.trim(x) != ""
                ),
            )
    return out


def merge_reviews(
    items: DataFrame, state: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Items with their review: it decides status and audit trail; unreviewed items stay."""
    ids = [*keys, "anomaly_id"]
    review = state.select(
        *ids,
        F.col("status").alias("_status"),
        F.col("audit_trail").alias("_audit"),
        F.struct("last_action", "updated_at", "updated_by", "notes").alias("review"),
    )
    merged = items.join(review, ids, "left").withColumn(
        "status", F.coalesce(F.nullif("_status", F.lit("")), "status")
    )
    if "audit_trail" in items.columns:
        merged = merged.withColumn("audit_trail", F.coalesce("_audit", "audit_trail"))
    else:
        merged = merged.withColumnRenamed("_audit", "audit_trail")
    return merged.drop("_status", "_audit")


def filter_items(
    items: DataFrame, date_from: str | None = None, date_to: str | None = None, **lists: str
) -> DataFrame:
    """Items matching comma lists of types, severities, statuses or entities, and an
    inclusive date range.  Items without a date pass the range."""
    for name, text in lists.items():
        if name not in _LIST_FILTERS:
            raise ValueError(f"unknown filter: {name}")
        wanted = [part.strip().lower() for part in (text or "").split(",") if part.strip()]
        if wanted:
            items = items.filter(F.lower(name).isin(*wanted))
    seen = F.col("detected_at").cast("timestamp")
    for text, within in ((date_from, seen.__ge__), (date_to, seen.__le__)):
        if text is not None:
            edge = parse_instant(F.lit(text))
            items = items.filter(seen.isNull() | edge.isNull() | within(edge))
    return items


def newest_items(
    items: DataFrame, limit: int = K.LIST_LIMIT, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The newest items per company, undated ones last; the limit stays within 1..200."""
    bounded = max(1, min(int(limit), K.LIST_LIMIT))
    n = F.row_number().over(
        W.partitionBy(*keys).orderBy(F.desc_nulls_last("detected_at"), "anomaly_id")
    )
    return items.withColumn("position", n).filter(F.col("position") <= bounded)


def review_summary(items: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Counts by priority and review progress."""
    severity, status = F.lower("severity"), F.lower("status")
    return items.groupBy(*keys).agg(
        *[
            F.count_if(severity == level).alias(f"{level}_priority_count")
            for level in ("high", "medium", "low")
        ],
        F.count_if(status.isin(*K.REVIEWED_STATUSES)).alias("reviewed_count"),
        F.count_if(status == "confirmed").alias("confirmed_count"),
    )


def lookup_items(
    requested: DataFrame, items: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """One row per requested anomaly; a placeholder stands in for one not in the batch."""
    ids = [*keys, "anomaly_id"]
    columns = [c for c in items.columns if c not in ids]
    placeholder = {
        "severity": "low", "anomaly_type": "unknown", "entity_type": "unknown",
        "source_table": "unknown", "status": "new", "suggested_action": "review",
        "title": "Anomaly record not found in latest batch",
        "description": "Review action stored, but the anomaly is not present in the current source file.",
    }
    found = requested.select(*ids).join(items.withColumn("found", F.lit(True)), ids, "left")
    shown = [
        F.coalesce(c, F.lit(placeholder[c])).alias(c) if c in placeholder else F.col(c)
        for c in columns
    ]
    return found.select(*ids, F.coalesce("found", F.lit(False)).alias("found"), *shown)
