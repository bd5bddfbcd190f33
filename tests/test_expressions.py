"""Reference vectors of the expressions."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import dates, rules, values
from ledgerloom.functions.records import Fields, snapshot
from ledgerloom.operators import finance, workforce
from ledgerloom.operators.tenant import guard


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def raw_of(spark, *documents):
    rows = spark.createDataFrame([(d,) for d in documents], "j string")
    return rows.select(
        F.try_variant_get(F.parse_json("j"), "$", "map<string,variant>").alias("raw")
    )


@pytest.mark.parametrize("text, expected", [
    ("2026-01-01T10:00:00Z", dt.datetime(2026, 1, 1, 10)),
    ("1704067200000", dt.datetime(2024, 1, 1)),
    ("2026-02-24", dt.datetime(2026, 2, 24)),
    ("2026/02/24", dt.datetime(2026, 2, 24)),
    (" 2026/2/4 01:02:03 ", dt.datetime(2026, 2, 4, 1, 2, 3)),
    ("2026-02-24 05:06", dt.datetime(2026, 2, 24, 5, 6)),
    ("2026-02-24T05:06:07.5+02:00", dt.datetime(2026, 2, 24, 3, 6, 7, 500000)),
    ("2026-02-24T05:06+0130", dt.datetime(2026, 2, 24, 3, 36)),
    ("0", dt.datetime(1970, 1, 1)),
    ("2026", dt.datetime(1970, 1, 1, 0, 33, 46)),
    ("2026-02", None), ("2026-13-01", None), ("x", None), ("", None), (None, None),
])
def test_parse_instant(spark, text, expected):
    assert one(spark, dates.parse_instant(F.lit(text)).cast("timestamp_ntz")) == expected


@pytest.mark.parametrize("number, expected", [
    (0.0, dt.datetime(1970, 1, 1)), (1704067200000.0, dt.datetime(2024, 1, 1)),
    (1704067200.0, dt.datetime(2024, 1, 1)), (1e30, None),
])
def test_number_instants(spark, number, expected):
    assert one(spark, dates.instant_of_number(F.lit(number)).cast("timestamp_ntz")) == expected


@pytest.mark.parametrize("text, expected", [
    ("$1,200.50", 1200.5), (" -3e2\t", -300.0), (".5", 0.5), ("$ 7", 7.0),
    ("abc", None), ("12d", None), ("nan", None), ("1_000", None), ("", None), (None, None),
])
def test_parse_number(spark, text, expected):
    assert one(spark, values.parse_number(F.lit(text))) == expected


@settings(max_examples=20, deadline=None)
@given(st.floats(allow_nan=False, allow_infinity=False, width=64))
def test_numbers_survive_text(number):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    assert one(spark, values.parse_number(F.lit(repr(number)))) == number


@pytest.mark.parametrize("hint, amount, expected", [
    ("sale", -1.0, "revenue"), ("Expense", 1.0, "expenditure"), ("payment received", 1.0, "revenue"),
    ("accredited", -1.0, "revenue"), ("", -20.0, "expenditure"), ("", 0.0, "revenue"), (None, 1.0, "revenue"),
])
def test_flow(spark, hint, amount, expected):
    assert one(spark, rules.flow_of(F.lit(hint), F.lit(amount))) == expected


@pytest.mark.parametrize("word, expected", [
    ("yes", True), ("1", True), ("Terminated ", False), ("0", False), ("maybe", None), (None, None),
])
def test_truth(spark, word, expected):
    assert one(spark, rules.truth_of(F.lit(word))) is expected


@pytest.mark.parametrize("score, expected", [(0.75, "high"), (0.7499, "medium"), (0.4, "medium"), (0.39, "low")])
def test_severity(spark, score, expected):
    assert one(spark, rules.severity_of(F.lit(score))) == expected


@pytest.mark.parametrize("base, value, expected", [(100.0, 150.0, 50.0), (0.0, 5.0, None), (-100.0, -50.0, 50.0)])
def test_percent(spark, base, value, expected):
    assert one(spark, values.percent_change(F.lit(base), F.lit(value))) == expected


@pytest.mark.parametrize("lag, expected", [
    (15.0, "healthy"), (30.0, "warning"), (60.0, "degraded"), (61.0, "down"), (None, "down"),
])
def test_freshness(spark, lag, expected):
    assert one(spark, rules.freshness_of(F.lit(lag), F.lit(15))) == expected


@pytest.mark.parametrize("text, expected", [
    ("rate(1 hour)", 90), ("rate(2 hours)", 180), ("rate(5 minutes)", 8), ("cron(0 1 * * ? *)", 42), (None, 42),
])
def test_schedule(spark, text, expected):
    assert one(spark, values.schedule_minutes(F.lit(text), 42)) == expected


def test_worst_status(spark):
    assert one(spark, rules.worst_of(F.lit("warning"), F.lit(None), F.lit("odd"))) == "warning"
    assert one(spark, rules.worst_of(F.lit("Down"), F.lit("degraded"))) == "down"


@pytest.mark.parametrize("name, expected", [
    ("  Acme & Sons__Ltd ", "acme-sons-ltd"), ("a" * 40, "a" * 30), ("--", ""),
])
def test_slug(spark, name, expected):
    assert one(spark, values.tenant_slug(F.lit(name))) == expected


def test_text_helpers(spark):
    assert one(spark, values.currency(F.lit(-1234.5))) == "$-1,234.50"
    assert one(spark, values.compact_message(F.lit(" a \n b "))) == "a b"
    assert len(one(spark, values.compact_message(F.lit("x" * 300)))) == 220
    assert one(spark, values.log_level(F.lit("It Failed"))) == "ERROR"
    assert one(spark, dates.iso_seconds(F.lit(0.0))) == "1970-01-01T00:00:00Z"
    assert one(spark, dates.iso_seconds(F.lit(1.25))) == "1970-01-01T00:00:01.250000Z"
    assert one(spark, dates.path_date(F.lit("raw/2026/02/30/x"))) is None
    assert one(spark, dates.path_date(F.lit("raw/2026/02/24"))) == dt.date(2026, 2, 24)
    assert values.safe_projection("COUNT( * ) as n") == "count(*) AS row_count"
    assert values.safe_projection("a b`c") == "`a b``c`"


@pytest.mark.parametrize("document, expected", [
    ('{"amount": "$1,200.50"}', 1200.5), ('{"amount": "abc", "total": 7}', 7.0),
    ('{"credit": 10, "debit": "4"}', 6.0), ('{"debit": 4}', -4.0), ('{"amount": true}', 1.0),
    ('{"note": "none"}', None),
])
def test_amounts(spark, document, expected):
    df = raw_of(spark, document)
    assert df.select(finance.signed_amount(Fields(df, "raw")).alias("x")).first().x == expected


@pytest.mark.parametrize("document, expected", [
    ('{"is_active": null, "status": "terminated"}', None), ('{"active": "no", "status": "active"}', False),
    ('{"is_active": 2}', True), ('{"employment_status": "", "state": "Left"}', False),
    ('{"termination_date": "2026-01-01"}', False), ('{"end_date": " "}', None), ('{"status": "on leave"}', None),
    ('{"status": "current", "end_date": "2026-01-01"}', True),
])
def test_active(spark, document, expected):
    df = raw_of(spark, document)
    assert df.select(workforce.active_of(Fields(df, "raw")).alias("x")).first().x is expected


def test_priority_date_is_the_first_that_parses(spark):
    df = raw_of(spark, '{"transaction_date": "soon", "date": 1704067200, "created_at": "2020-01-01"}')
    when = Fields(df, "raw").first_instant(("transaction_date", "date", "created_at"))
    assert df.select(when.cast("date").alias("x")).first().x == dt.date(2024, 1, 1)


def test_finance_rows_and_fallbacks(spark):
    df = raw_of(
        spark,
        '{"amount": 5, "date": "2026-01-02", "id": " a "}', '{"amount": 5}', '{"date": "2026-01-02"}',
    ).withColumn("company_id", F.lit("x")).withColumn("source_file", F.lit("trusted/2026/03/04/f.json"))
    rows = {r.record_id: r for r in finance.normalize_finance(df, raw="raw").collect()}
    assert len(rows) == 2 and rows["a"].date == dt.date(2026, 1, 2)
    other = next(r for k, r in rows.items() if k != "a")
    assert other.record_id.startswith("finance-") and other.date == dt.date(2026, 3, 4)
    undated = finance.normalize_finance(df, "ui", raw="raw")
    assert sorted(str(r.date) for r in undated.collect()) == ["2026-01-02", "None"]
    assert finance.normalize_finance(df, "api", raw="raw").count() == 1


def test_snapshot(spark):
    fields = ", ".join(f'"f{i:02d}": {i}' for i in range(20))
    df = raw_of(spark, '{"_private": 1, ' + fields + "}")
    names = df.select(F.map_keys(snapshot(F.col("raw"), 12)).alias("x")).first().x
    assert sorted(names) == [f"f{i:02d}" for i in range(12)]


@pytest.mark.parametrize("text", [
    "1=1; drop table x", "a -- b", "a /* b", "x IN (SELECT y FROM z)", "a UNION b", "delete FROM x", "a JOIN b",
])
def test_guard(text):
    with pytest.raises(ValueError):
        guard(text, "where", ["a", "b", "x", "y", "z"])
