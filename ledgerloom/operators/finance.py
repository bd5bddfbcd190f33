"""Finance rows: normalisation and daily aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import path_date
from ..functions.records import Fields
from ..functions.rules import flow_of
from ..functions.values import exact, money_sum
from ..session import computed_once, materialize
from .lookups import join_lookup

KEYS = ("company_id",)


def signed_amount(fields: Fields):
    """First parsable amount field, else credit minus debit, else NULL."""
    sides = [F.lit(None).cast("double"), F.lit(None).cast("double")]
    for n, side in enumerate(("credit", "debit")):
        if fields.usable([side]):
            sides[n] = fields.number(side)
    credit, debit = sides
    balance = F.when(
        credit.isNotNull() | debit.isNotNull(),
        F.coalesce(credit, F.lit(0.0)) - F.coalesce(debit, F.lit(0.0)),
    )
    return F.coalesce(fields.first_number(K.AMOUNT_FIELDS), balance)


def flow_hint(fields: Fields):
    """The text the flow words are looked up in."""
    return F.concat_ws(" ", *[fields.text(n) for n in fields.usable(K.HINT_FIELDS)])


def normalize_finance(
    df: DataFrame,
    profile: str = "job",
    raw: str | None = None,
    keys: tuple[str, ...] = KEYS,
    keep: tuple[str, ...] = (),
    path: str = "source_file",
    mtime: str = "source_modified",
) -> DataFrame:
    """One typed row per usable finance record.

    A row needs an amount and, unless the profile keeps undated rows, a date.  Records
    without an id get one from their content, which is stable across runs and
    partitionings.
    """
    rules = K.FINANCE_PROFILES[profile]
    fields = Fields(df, raw)
    when = fields.first_instant(rules["dates"])
    if "path" in rules["fallback"] and path in df.columns:
        when = F.coalesce(when, path_date(F.col(path)).cast("timestamp"))
    if "mtime" in rules["fallback"] and mtime in df.columns:
        when = F.coalesce(when, F.col(mtime).cast("timestamp"))
    content = F.to_json(raw) if raw else F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))
    made_id = F.concat(F.lit("finance-"), F.md5(content))  # 128 bits: no collisions among 10^12 rows
    amount = F.col("signed_amount")
    rows = df.select(
        *keys,
        *keep,
        F.coalesce(fields.first_text(K.TRANSACTION_ID_FIELDS), made_id).alias("record_id"),
        when.alias("event_ts"),
        signed_amount(fields).alias("signed_amount"),
        flow_hint(fields).alias("_hint"),
        fields.first_text(K.CATEGORY_FIELDS, "Other").alias("category"),
        fields.first_text(K.VENDOR_FIELDS, "Unlabelled vendor").alias("vendor"),
        fields.first_text(K.DEPARTMENT_FIELDS, "").alias("department"),
    )
    if fields.parses([*K.AMOUNT_FIELDS, "credit", "debit", *rules["dates"]]):
        rows = computed_once(rows, ["signed_amount", "event_ts"])
    rows = rows.filter(amount.isNotNull())
    if not rules["undated"]:
        rows = rows.filter("event_ts IS NOT NULL")
    return (
        rows.withColumn("date", F.to_date("event_ts"))
        .withColumn("amount", F.abs(amount))
        .withColumn("source_area", flow_of(F.col("_hint"), amount))
        .drop("_hint")
    )


def daily_totals(
    rows: DataFrame, keys: tuple[str, ...] = KEYS, copies: str | None = None
) -> DataFrame:
    """Total and count per area and day; combined before the shuffle.

    ``copies`` names a column of how many equal records a row stands for.
    """
    amount = F.col("amount")
    if copies:
        total = F.sum(exact(amount) * F.col(copies)).cast("double") + F.coalesce(
            F.sum(F.when(exact(amount).isNull(), amount * F.col(copies))), F.lit(0.0)
        )
        count = F.sum(copies)
    else:
        total, count = money_sum(amount), F.count("record_id")
    return rows.groupBy(*keys, "source_area", "date").agg(
        total.alias("daily_total"), count.alias("transaction_count")
    )


def daily_flows(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Revenue and expenditure of each day that has either, in one pass."""

    def side(area: str):
        return money_sum(F.when(F.col("source_area") == area, F.col("amount"))).alias(area)

    return rows.groupBy(*keys, "date").agg(side("revenue"), side("expenditure"))


def source_fallback(
    preferred: DataFrame, broader: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Rows of the preferred input, and of the broader one for keys it lacks."""
    have = materialize(preferred.select(*keys).distinct(), "have")
    return preferred.unionByName(join_lookup(broader, have, list(keys), "left_anti"))


def recent_rows(
    df: DataFrame, limit: int = 1000, keys: tuple[str, ...] = KEYS, tie: str | None = None
) -> DataFrame:
    """The newest finance rows per company, on a projection discovered from the columns.

    Only the first existing column of each role is read; NULL dates come last.
    """
    names = set(df.columns)
    date = next((n for n in K.FINANCE_PROFILES["live"]["dates"] if n in names), None)
    if date is None:
        raise ValueError("no transaction date column found")
    roles = [K.CATEGORY_FIELDS, K.VENDOR_FIELDS, K.DEPARTMENT_FIELDS]
    wanted = [date, *[n for n in ("credit", "debit", *K.AMOUNT_FIELDS) if n in names]]
    wanted += [n for n in K.HINT_FIELDS if n in names]
    wanted += [next((n for n in role if n in names), None) for role in roles]
    wanted += [tie] if tie else []
    columns = list(dict.fromkeys([*keys, *[n for n in wanted if n]]))
    order = [F.desc_nulls_last(date), *([F.asc(tie)] if tie else [])]
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.select(*columns).withColumn("_n", newest).filter(F.col("_n") <= limit).drop("_n")


def totals_with_lateness(
    rows: DataFrame, value: str, loaded: str, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Totals per business date, with how many rows were loaded on a later day.

    The business date decides, so a back-dated row changes an old day and none is dropped.
    """
    return rows.groupBy(*keys, "date").agg(
        money_sum(F.col(value)).alias("total"),
        F.count("*").alias("n"),
        F.count_if(F.col(loaded) > F.col("date")).alias("late"),
    )
