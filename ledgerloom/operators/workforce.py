"""Employee events, headcount and department mix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import path_date
from ..functions.records import Fields
from ..functions.values import strip
from ..session import computed_once
from .series import dense_daily

KEYS = ("company_id",)


def active_of(fields: Fields):
    """Whether a record says its employee is active; NULL when it does not say.

    A present flag decides alone, even when it cannot be read.  Then status words, then
    any filled termination field.
    """
    status = F.coalesce(
        *[F.nullif(fields.text(n), F.lit("")) for n in fields.usable(K.STATUS_FIELDS)],
        F.lit(None).cast("string"),
    )
    word = F.lower(strip(status))
    ended = reduce(
        lambda a, b: a | b,
        [F.coalesce(strip(fields.text(n)) != "", F.lit(False))
         for n in fields.usable(K.TERMINATION_FIELDS)],
        F.lit(False),
    )
    told = (
        F.when(word.isin(*K.ACTIVE_STATUS_WORDS), True)
        .when(word.isin(*K.INACTIVE_STATUS_WORDS), False)
        .when(ended, False)
    )
    for flag in reversed(fields.usable(["is_active", "active"])):
        told = F.when(fields.present(flag), fields.truth(flag)).otherwise(told)
    return told


def employee_events(
    df: DataFrame,
    raw: str | None = None,
    keys: tuple[str, ...] = KEYS,
    seq: str | None = None,
    path: str = "source_file",
    mtime: str = "source_modified",
) -> DataFrame:
    """(event_ts, employee_id, is_active, seq) of every record with an id and a date."""
    fields = Fields(df, raw)
    when = fields.first_instant(K.EMPLOYEE_DATE_FIELDS)
    if path in df.columns:
        when = F.coalesce(when, path_date(F.col(path)).cast("timestamp"))
    if mtime in df.columns:
        when = F.coalesce(when, F.col(mtime).cast("timestamp"))
    rows = df.select(
        *keys,
        fields.first_text(K.EMPLOYEE_ID_FIELDS).alias("employee_id"),
        when.alias("event_ts"),
        active_of(fields).alias("is_active"),
        (F.col(seq) if seq else F.lit(0)).cast("bigint").alias("seq"),
    )
    if fields.parses(K.EMPLOYEE_DATE_FIELDS):
        rows = computed_once(rows, ["employee_id", "event_ts", "is_active"])
    return rows.filter("employee_id IS NOT NULL AND event_ts IS NOT NULL")


def headcount_changes(events: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Net change of the active set on each day with an event.

    Only an employee's last state of a day matters, and that is an aggregate: it is
    combined before the shuffle, so one endlessly changing employee costs a row per day.
    The window behind it orders one employee's days.
    """
    active = F.coalesce("is_active", F.lit(True)).cast("int")
    states = (
        events.withColumn("date", F.to_date("event_ts"))
        .groupBy(*keys, "employee_id", "date")
        .agg(F.max_by(active, F.struct("event_ts", "seq")).alias("state"))
    )
    w = W.partitionBy(*keys, "employee_id").orderBy("date")
    change = F.col("state") - F.coalesce(F.lag("state").over(w), F.lit(0))
    return states.withColumn("change", change).groupBy(*keys, "date").agg(
        F.sum("change").alias("change")
    )


def headcount(events: DataFrame, keys: tuple[str, ...] = KEYS, dense: bool = True) -> DataFrame:
    """Active employees at the end of each day, carried over days without events."""
    w = W.partitionBy(*keys).orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    counts = headcount_changes(events, keys).select(
        *keys, "date", F.sum("change").over(w).cast("double").alias("headcount")
    )
    return dense_daily(counts, ["headcount"], keys, carry=True) if dense else counts


def headcount_fallback(events: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Distinct employees seen on each day, for companies without a run history."""
    return (
        events.select(*keys, "employee_id", F.to_date("event_ts").alias("date"))
        .distinct()
        .groupBy(*keys, "date")
        .agg(F.count("*").alias("headcount"))
    )


def department_top(
    df: DataFrame, k: int = 6, raw: str | None = None, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """The departments with the most records; records without one count as Unknown."""
    fields = Fields(df, raw)
    counts = (
        df.select(*keys, fields.first_text(K.DEPARTMENT_FIELDS, "Unknown").alias("label"))
        .groupBy(*keys, "label")
        .agg(F.count("*").alias("value"))
    )
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("value"), "label"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def headcount_movement(points: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Last actual headcount and its change from the point before."""
    w = W.partitionBy(*keys).orderBy("date")
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("date")))
    return (
        points.withColumn("growth_count", F.col("headcount") - F.lag("headcount").over(w))
        .withColumn("_n", newest)
        .filter("_n = 1")
        .select(*keys, "headcount", F.coalesce("growth_count", F.lit(0.0)).alias("growth_count"))
    )
