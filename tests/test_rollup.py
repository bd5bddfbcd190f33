"""The daily roll-up: the same figures as from the rows, kept up to date by days, one scan of each fact table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import finance, rollup, spend
from ledgerloom.plans import bindings as B


SCHEMA = "company_id string, record_id string, date date, source_area string, amount double, vendor string, category string, department string"


def rows_of(spark, n=600, seed=1):
    source = random.Random(seed)
    rows = [(
        source.choice("abc"), str(i), source.choice([None, *[dt.date(2026, 1, 1) + dt.timedelta(days=k) for k in range(40)]]),
        source.choice(["revenue", "expenditure", "expenditure"]), source.choice([round(source.lognormvariate(4, 1), 2), 5000.0]),
        f"v{i % 7}", source.choice(["x", " y ", "", None]), source.choice(["d", None])) for i in range(n)]
    rows.append(("huge", "h", dt.date(2026, 1, 1), "expenditure", 1e30, "v", "x", "d"))
    return spark.createDataFrame(rows, SCHEMA)


def same(found, wanted):
    assert set(found.columns) == set(wanted.columns)
    columns = sorted(wanted.columns)

    def plain(df):
        return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in df.select(*columns).collect())

    assert plain(found) == plain(wanted)


def test_figures_are_those_of_the_rows(spark):
    rows = rows_of(spark).cache()
    facts = rollup.daily_facts(rows).cache()
    same(rollup.flows(facts), finance.daily_flows(rows.filter("date IS NOT NULL")))
    same(rollup.spent(facts), spend.daily_spend(rows))
    same(rollup.top_labels(facts, "category"), spend.top_labels(rows, "category"))
    same(rollup.weekly_activity(facts), spend.weekly_activity(rows))
    same(rollup.unusual_expenses(facts), spend.unusual_expenses(rows.select("company_id", "record_id", "date", "vendor", "amount", "source_area")))
    assert rollup.sources(facts).filter("company_id = 'huge'").first().finance_rows == 1
    assert rollup.daily_facts(rows.limit(0)).count() == 0


def test_a_refresh_touches_its_days_only(spark, tmp_path):
    rows, path = rows_of(spark).cache(), f"{tmp_path}/facts"
    days = rows.select("date").distinct()
    rollup.refresh_facts(spark, path, rows, days)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("facts/day=*/*.parquet")}
    day = dt.date(2026, 1, 5)
    more = rows.unionByName(rows_of(spark, 50, 2).withColumns({"date": F.lit(day), "record_id": F.concat(F.lit("n"), "record_id")}))
    gone = more.filter((F.col("date") != dt.date(2026, 1, 7)) | F.col("date").isNull())
    touched = spark.createDataFrame([(day,), (dt.date(2026, 1, 7),), (None,)], "date date")
    for _ in range(2):  # a repeated refresh changes nothing
        rollup.refresh_facts(spark, path, gone, touched)
        same(rollup.flows(rollup.read_facts(spark, path)), finance.daily_flows(gone.filter("date IS NOT NULL")))
        same(rollup.unusual_expenses(rollup.read_facts(spark, path)), spend.unusual_expenses(gone.select("company_id", "record_id", "date", "vendor", "amount", "source_area")))
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("facts/day=*/*.parquet")}
    moved = {p.parent.name for p in set(before.items()) ^ set(after.items()) for p in p[:1]}
    assert moved == {"day=2026-01-05", "day=2026-01-07", "day=none"}


def scans(spark, since=-1):
    """Number of the last execution, and for each fact table how often the executed plans after ``since`` scan it."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    found, last = {"orders": 0, "events": 0}, since
    for i in range(listed.size()):
        run = listed.apply(i)
        last = max(last, run.executionId())
        if run.executionId() > since:
            executed = run.physicalPlanDescription().partition("== Initial Plan ==")
            details = executed[0] + executed[2].partition("\n\n\n")[2]  # the tree that ran, and the nodes' details
            for table in found:
                ran = {line.split()[-1] for line in executed[0].splitlines() if "Scan parquet" in line and line.rstrip().endswith(")")}
                for block in details.split("\n\n"):
                    head = block.strip().splitlines()[0] if block.strip() else ""
                    number = head.split(" ")[0]
                    if "Scan parquet" in head and f"/{table}.parquet]" in block and any(number == n for n in ran):
                        found[table] += 1
    return last, found


@pytest.mark.parametrize("name", ["insight_rows", "dashboard", "forecast_risk", "headcount_chart", "kpi_metrics"])
def test_each_fact_table_is_scanned_once(spark, sf, name):
    spark.conf.set("spark.sql.maxPlanStringLength", str((1 << 31) - 16))  # the plans are read below
    since, _ = scans(spark)
    entry.queries()[name](spark, sf).collect()
    _, found = scans(spark, since)
    assert found == {"orders": 1, "events": 1}
