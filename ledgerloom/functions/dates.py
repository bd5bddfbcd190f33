"""Instants and dates from loosely typed input.  The session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import strip

_PLAIN = r"^\d{4}([-/])\d{1,2}\1\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"
_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([Zz]|[+-]\d{2}:?\d{2})?$"
_OFFSET = r"([Zz]|[+-]\d{2}:?\d{2})$"
_PATH = r"/(\d{4})/(\d{2})/(\d{2})(?:/|$)"
# Seconds of 0001-01-01 and 9999-12-31: outside them there is no calendar date.
_FIRST, _LAST = -62135596800.0, 253402300799.0


def from_epoch(seconds: Column) -> Column:
    """Instant of an epoch second, fractions kept; NULL outside the calendar."""
    return F.when(
        seconds.between(_FIRST, _LAST),
        F.timestamp_micros(F.rint(seconds * 1e6).cast("bigint")),
    )


def instant_of_number(number: Column) -> Column:
    """Epoch number: above 1e10 it counts milliseconds, else seconds."""
    return from_epoch(F.when(number > 1e10, number / 1000.0).otherwise(number))


def parse_instant(text: Column) -> Column:
    """Instant from text: epoch digits (13 or more are milliseconds), ISO 8601, or
    year-month-day with ``-`` or ``/`` and an optional time.  No zone means UTC."""
    raw = strip(text)
    number = raw.try_cast("double")
    epoch = from_epoch(F.when(F.length(raw) >= 13, number / 1000.0).otherwise(number))
    plain = F.translate(raw, "/", "-")
    plain = F.when(plain.contains(":"), F.concat(plain, F.lit("Z"))).otherwise(
        F.concat(plain, F.lit(" 00:00:00Z"))
    )
    iso = F.when(raw.rlike(_OFFSET), F.upper(raw)).otherwise(F.concat(raw, F.lit("Z")))
    # A cast wants seconds, and a colon inside the offset.
    iso = F.regexp_replace(iso, r"^(.{10}[T ]\d{2}:\d{2})([Z+-])", "$1:00$2")
    iso = F.regexp_replace(iso, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return (
        F.when(raw.rlike(r"^\d+$"), epoch)
        .when(raw.rlike(_PLAIN), plain.try_cast("timestamp"))
        .when(raw.rlike(_ISO), iso.try_cast("timestamp"))
    )


def path_date(path: Column) -> Column:
    """Date in a ``/yyyy/MM/dd/`` path part, NULL when it is not a real date."""
    parts = [F.regexp_extract(path, _PATH, n) for n in (1, 2, 3)]
    return F.concat_ws("-", *parts).try_cast("date")


def iso_seconds(seconds: Column) -> Column:
    """Epoch seconds as ISO text with ``Z``; microseconds only when there are any."""
    ts = from_epoch(seconds)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.when(micros == 0, F.concat(whole, F.lit("Z"))).otherwise(
        F.concat(whole, F.date_format(ts, ".SSSSSS"), F.lit("Z"))
    )
