"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = " \t\n\r\x0b\x0c"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(_SPACE))


def non_blank(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    bare = strip(text)
    return F.when(bare != "", bare)


def parse_number(text: Column) -> Column:
    """Number from text such as ``$1,200.50``; NULL when it is not a number.

    The pattern guard keeps out ``12d``, ``nan`` and ``inf``, which a cast accepts.
    """
    bare = strip(F.translate(text, ",$", ""))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def exact(amount: Column) -> Column:
    """Six-place decimal of an amount, for sums that do not depend on row order."""
    return amount.try_cast("decimal(28,6)")


def money_sum(amount: Column) -> Column:
    """Sum of amounts: exact in six places, with a float part for values beyond decimals."""
    fixed = exact(amount)
    return F.coalesce(F.sum(fixed).cast("double"), F.lit(0.0)) + F.coalesce(
        F.sum(F.when(fixed.isNull(), amount)), F.lit(0.0)
    )


def frame_mean(value: Column, window) -> Column:
    """Mean over a window frame, independent of the order the engine adds it in."""
    total = F.sum(exact(value)).over(window).cast("double")
    return total / F.count(value).over(window)


def percent_change(base: Column, value: Column) -> Column:
    """Percent deviation of ``value`` from ``base``; NULL when the base is 0."""
    return F.when(base != 0, (value - base) / F.abs(base) * 100.0)


def currency(amount: Column) -> Column:
    """``$1,234.50`` text; the sign follows the dollar mark."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def compact_message(message: Column) -> Column:
    """White space squeezed; at most 220 characters, the last three then being dots."""
    text = strip(F.regexp_replace(F.coalesce(message, F.lit("")), r"\s+", " "))
    return F.when(F.length(text) <= 220, text).otherwise(
        F.concat(F.substring(text, 1, 217), F.lit("..."))
    )


def log_level(message: Column) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(low.rlike("error|exception|fatal|fail"), "ERROR")
        .when(low.contains("warn"), "WARN")
        .otherwise("INFO")
    )


def tenant_id(text: Column) -> Column:
    """Lower-cased tenant identifier, NULL when malformed."""
    bare = F.lower(strip(text))
    return F.when(bare.rlike(r"^[a-z0-9][a-z0-9_-]{1,62}$"), bare)


def tenant_slug(name: Column) -> Column:
    """Slug of a company name: dashes for blanks, other signs dropped, 30 characters."""
    dashed = F.regexp_replace(F.lower(strip(name)), "[ _]+", "-")
    bare = F.regexp_replace(F.regexp_replace(dashed, "[^a-z0-9-]", ""), "-+", "-")
    return F.substring(F.btrim(bare, F.lit("-")), 1, 30)


def schedule_minutes(expression: Column, default: int) -> Column:
    """One and a half periods of ``rate(n minutes|hours)``, rounded up, else the default."""
    raw = F.lower(strip(F.coalesce(expression, F.lit(""))))
    pattern = r"^rate\(\s*(\d+)\s+(minute|hour)s?\s*\)$"
    count = F.regexp_extract(raw, pattern, 1).try_cast("bigint")
    scale = F.when(F.regexp_extract(raw, pattern, 2) == "hour", 60).otherwise(1)
    return F.coalesce(F.ceil(count * scale * 1.5).cast("int"), F.lit(default))


def safe_projection(name: str) -> str:
    """A user's column choice as a select expression: ``*``, a count, or a quoted name."""
    bare = (name or "").strip()
    if bare in ("", "*"):
        return "*"
    squeezed = bare.lower().replace(" ", "")
    if bare == "__count__" or squeezed.startswith("count(*)"):
        return "count(*) AS row_count"
    return "`" + bare.replace("`", "``") + "`"
