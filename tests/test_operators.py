"""Reference vectors and invariants of the operators."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import (
    alarms, cdc, documents, finance, forecast, health, kpi, lookups, outlook, quantiles, reviews, series, spend,
    tenant, workforce,
)
from ledgerloom.plans import bindings as B

DAY = dt.date(2026, 1, 1)


def days(spark, pairs, name="value", company="a"):
    rows = [(company, DAY + dt.timedelta(days=n), float(v)) for n, v in pairs]
    return spark.createDataFrame(rows, f"company_id string, date date, {name} double")


def finance_rows(spark, rows):
    return spark.createDataFrame(
        rows, "company_id string, record_id string, date date, amount double, source_area string, vendor string, category string"
    )


def envelope(schema, table, data):
    return json.dumps({"metadata": {"schema-name": schema, "table-name": table}, "data": data})


def test_cleaning(spark):
    employee = {"id": 1, "name": "", "left": None, "updated_at": "2026-02-24T10:00:00"}
    lines = [
        envelope("public", "employees", employee),
        envelope("PUBLIC", "Employees", dict(reversed(employee.items()))),
        envelope("finance", "transactions", {"id": 1, "timestamp": 0, "date": "2026-01-01T00:00:00-05:00"}),
        envelope("finance", "transactions", {"id": 1.0, "timestamp": 0, "date": "2026-01-01T00:00:00-05:00"}),
        envelope("finance", "audit", {"id": 1}), envelope("public", "awsdms_status", {"id": 1}),
        envelope("", "employees", {"a": None, "b": ""}), '{"metadata": {}}', "not json", "[1]", "",
        '{"id": 99, "data": {"x": ""}}',
    ]
    df = spark.createDataFrame([("c", "f", x) for x in lines], "company_id string, source_file string, line string")
    rows = [(r.table, r.record) for r in cdc.clean_lines(df).collect()]
    kept = set(rows)
    assert ("employees", '{"id":1,"updated_at":"2026-02-24T10:00:00Z"}') in kept
    assert ("employees", '{"data":{"x":""},"id":99}') in kept
    # 1 and 1.0 are different content, although JSON text shows both as 1.
    transactions = [r for t, r in rows if t == "transactions"]
    assert len(rows) == 4 and len(transactions) == 2
    assert all('"timestamp":"1970-01-01T00:00:00Z"' in r and "-05:00Z" in r for r in transactions)
    reasons = sorted(r.reject for r in cdc.rejected_lines(df).collect())
    assert reasons == sorted([
        "unrouted_table", "unrouted_table", "empty_record", "control_record", "malformed_json", "not_an_object", "blank_line",
    ])
    again = cdc.clean_lines(df.unionByName(df))
    assert again.count() == cdc.clean_lines(df).count()


def test_dense_series(spark):
    sparse = days(spark, [(0, 5), (2, 7)])
    zero = series.dense_daily(sparse, ["value"]).orderBy("date").collect()
    carried = series.dense_daily(sparse, ["value"], carry=True).orderBy("date").collect()
    assert [r.value for r in zero] == [5.0, 0.0, 7.0]
    assert [r.value for r in carried] == [5.0, 5.0, 7.0]
    tail = series.trailing_days(sparse, "value", 5).orderBy("date").collect()
    assert [r.value for r in tail] == [0.0, 0.0, 5.0, 0.0, 7.0]


def test_rolling_rule_counts_rows(spark):
    rows = [("a", "revenue", DAY + dt.timedelta(days=n * 3), float(t), 1) for n, t in enumerate((10, 20, 30, 40))]
    daily = spark.createDataFrame(rows, "company_id string, source_area string, date date, daily_total double, transaction_count bigint")
    out = series.rolling_features(daily).orderBy("date").collect()
    assert [r.rolling_mean_7 for r in out] == [10.0, 20.0, 30.0, 20.0]
    assert [r.rolling_deviation_7 for r in out] == [0.0, 0.0, 0.0, 20.0]


def test_lag_gate(spark):
    for n, status, training in ((20, "insufficient_data", 6), (21, "ok", 7)):
        points = days(spark, [(i, i) for i in range(n)]).withColumn("metric", F.lit("m"))
        row = forecast.forecast_gate(points).first()
        assert (row.status, row.training_rows) == (status, training)
        assert series.lag_features(points, "value").count() == training


def test_headcount_replay(spark):
    def event(n, who, active, seq=0):
        return ("a", who, dt.datetime(2026, 1, 1 + n, 12), active, seq)

    schema = "company_id string, employee_id string, event_ts timestamp, is_active boolean, seq bigint"
    small = spark.createDataFrame(
        [event(0, "a", True), event(0, "b", None), event(2, "a", False), event(3, "a", False)], schema
    )
    assert [r.headcount for r in workforce.headcount(small).orderBy("date").collect()] == [2, 2, 1, 1]
    rng = random.Random(1)
    log = [event(rng.randrange(20), f"e{rng.randrange(9)}", rng.choice([True, False, None]), n) for n in range(400)]
    active, expected = set(), {}
    for _, who, at, state, _ in sorted(log, key=lambda r: (r[2], r[4])):
        (active.discard if state is False else active.add)(who)
        expected[at.date()] = float(len(active))
    for partitions in (1, 7):
        got = workforce.headcount(spark.createDataFrame(log, schema).repartition(partitions), dense=False)
        assert {r.date: r.headcount for r in got.collect()} == expected


@pytest.mark.parametrize("q", [0.0, 0.08, 0.5, 0.92, 1.0])
def test_exact_quantile_equals_percentile(spark, q):
    rng = random.Random(7)
    # A third of the rows share one value, and one group holds most rows.
    rows = [("hot" if i % 5 else "cold", 42.0 if i % 3 == 0 else round(rng.lognormvariate(3, 2), 2), i % 4) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double, w int")
    got = {r.k: r.x for r in quantiles.exact_quantile(df, ["k"], "v", q, "x").collect()}
    want = {r.k: r.x for r in df.groupBy("k").agg(F.percentile("v", q).alias("x")).collect()}
    assert got == pytest.approx(want)
    weighted = {r.k: r.x for r in quantiles.exact_quantile(df.filter("w > 0"), ["k"], "v", q, "x", "w").collect()}
    full = {r.k: r.x for r in df.groupBy("k").agg(F.percentile("v", q, F.col("w")).alias("x")).collect()}
    assert weighted == pytest.approx(full)


def test_quantile_of_ten_million_rows_orders_few(spark):
    # v is a permutation of 0 to 10**7 - 1, so its quantiles are known; a twentieth of the rows is a second group.
    n = 10**7
    rows = spark.range(n).select(
        F.when(F.col("id") % 20 == 0, "cold").otherwise("hot").alias("k"), ((F.col("id") * 7_368_787) % n).cast("double").alias("v"))
    narrow = rows.select("k", F.col("v").alias("_v"), F.lit(1).cast("bigint").alias("_w"))
    spans = quantiles.quantile_spans(narrow, ["k"], 0.92, 10_000).collect()
    assert {s.k for s in spans} == {"hot", "cold"} and max(s._size for s in spans) <= 10_500
    values = np.arange(n, dtype=np.int64) * 7_368_787 % n
    cold = np.arange(n) % 20 == 0
    got = {r.k: r.x for r in quantiles.exact_quantile(rows, ["k"], "v", 0.92, "x").collect()}
    assert got == {"cold": pytest.approx(np.quantile(values[cold], 0.92)), "hot": pytest.approx(np.quantile(values[~cold], 0.92))}


@pytest.mark.parametrize("q", [0.0, 0.5, 0.92, 1.0])
def test_quantile_is_narrowed_in_rounds(spark, q):
    rng = random.Random(3)
    rows = [("hot" if i % 9 else f"k{i % 4}", 7.5 if i % 4 == 0 else rng.gauss(0, 1e6), 1 + i % 3) for i in range(6000)] + [("one", 1.0, 5)]
    df = spark.createDataFrame(rows, "k string, v double, w int")
    got = {r.k: (r.x, r.n) for r in quantiles.exact_quantile(df, ["k"], "v", q, "x", "w", bound=10).collect()}
    want = {r.k: (r.x, r.n) for r in df.groupBy("k").agg(F.percentile("v", q, F.col("w")).alias("x"), F.sum("w").alias("n")).collect()}
    assert {k: n for k, (_, n) in got.items()} == {k: n for k, (_, n) in want.items()}
    assert {k: x for k, (x, _) in got.items()} == pytest.approx({k: x for k, (x, _) in want.items()})


def test_lookup_join_is_the_same_salted(spark, monkeypatch):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    lookup = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    plain = sorted(map(tuple, lookups.join_lookup(rows, lookup, ["k"]).collect()), key=str)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 10)
    salted = lookups.join_lookup(rows, lookup, ["k"])
    assert sorted(map(tuple, salted.select("k", "r", "x").collect()), key=str) == plain


def test_spend_rules(spark):
    rows = finance_rows(spark, [
        ("a", "1", DAY, 1400.0, "expenditure", "v1", "c1"), ("a", "2", DAY, 240.0, "expenditure", "v1", "c2"),
        ("a", "3", DAY, 5200.0, "expenditure", "v2", ""), ("a", "4", DAY, 9e6, "revenue", "v1", "c1"),
        ("b", "5", DAY, 1.0, "expenditure", "v1", "c1"),
    ])
    assert spend.unusual_expenses(rows).count() == 0
    recurring = {r.company_id: r for r in spend.recurring_spend(rows).collect()}
    assert (recurring["a"].recurring_spend, recurring["a"].one_off_spend) == (1640.0, 5200.0)
    assert (recurring["b"].recurring_spend, recurring["b"].one_off_spend) == (0.0, 1.0)
    top = {r.label: r for r in spend.top_labels(rows, "category").filter("company_id = 'a'").collect()}
    assert set(top) == {"c1", "c2"} and top["c1"].share == pytest.approx(1400 / 6840)


def test_monthly_change(spark):
    daily = days(spark, [(0, 2000), (40, 2600)], "expenditure").withColumn("revenue", F.lit(-5.0))
    last = spend.monthly_finance(daily).orderBy(F.desc("month")).first()
    assert (last.expenditure, last.spend_change_percent, last.revenue, last.label) == (2600.0, 30.0, 0.0, "Feb")


def test_spend_window_pads_to_ninety_days(spark):
    spent = days(spark, [(0, 10), (1, 100)]).withColumn("transactions", F.lit(1))
    row = spend.spend_window(spent, 7).first()
    assert (row.current_total, row.peak, row.spike_days, row.transaction_count) == (110.0, 100.0, 1, 2)
    assert row.average == pytest.approx(110 / 7) and row.previous_total == 0.0


def test_kpis_of_the_dashboard_sample(spark):
    history = days(spark, [(0, 8)]).withColumn("metric", F.lit("employee_headcount")).unionByName(
        days(spark, [(0, 1200)]).withColumn("metric", F.lit("revenue"))
    )
    ahead = spark.createDataFrame([], "company_id string, metric string, date date, predicted_value double")
    runs = spark.createDataFrame([("a", "ok", 20), ("z", "odd", 0)], "company_id string, status string, rows_processed int")
    cards = {r.company_id: r for r in kpi.kpi_metrics(history, ahead, runs).collect()}
    a, z = cards["a"], cards["z"]
    assert (a.total_employees, a.revenue, a.data_health_percent, a.employees_delta_percent) == (8.0, 1200.0, 100, 0.0)
    assert a.data_health_reasons == "prediction status ok, 20 rows processed"
    assert (z.total_employees, z.data_health_percent, z.growth_percent) == (0.0, 0, 0.0)


def test_month_end_without_forecast(spark):
    spent = days(spark, [(-20, 100), (0, 40), (4, 60)])
    ahead = spark.createDataFrame([], "company_id string, date date, predicted_value double")
    row = outlook.month_end(spent, ahead).first()
    assert (row.current_month_actual, row.projected_month_end_spend, row.previous_month_spend) == (100.0, 100.0, 100.0)
    assert (row.fallback_days, row.coverage_days, row.projected_vs_last_month) == (26, 0, 0.0)


def test_reviews_keep_the_newest_hundred(spark):
    at = F.timestamp_seconds(F.col("id"))
    log = spark.range(130).select(
        F.lit("a").alias("company_id"), F.lit("x").alias("anomaly_id"), F.lit("drop").alias("action"),
        F.lit("").alias("status"), F.lit("me").alias("actor"), F.col("id").cast("string").alias("note"), at.alias("at"), F.col("id").alias("seq"),
    )
    bad = log.limit(1).withColumn("action", F.lit("explode")).unionByName(log.limit(1).withColumn("status", F.lit("odd")))
    assert reviews.review_state(bad).count() == 0
    row = reviews.review_state(log.repartition(5)).first()
    assert (row.status, row.last_action, len(row.audit_trail), len(row.notes)) == ("investigating", "soft_drop_record", 100, 50)
    assert row.audit_trail[0].seq == 30 and row.notes[-1].note == "129"


def test_review_filter_sample(spark):
    schema = "company_id string, anomaly_id string, anomaly_type string, entity_type string, severity string, status string, detected_at timestamp"
    items = spark.createDataFrame([
        ("a", "1", "t", "daily_finance", "medium", "new", dt.datetime(2026, 2, 27)), ("a", "2", "t", "transaction", "high", "new", dt.datetime(2026, 2, 25)),
        ("a", " ", "t", "x", "high", "new", None),
    ], schema)
    state = reviews.review_state(spark.createDataFrame(
        [("a", "1", "mark confirmed", "", "me", "", dt.datetime(2026, 3, 1), 1)],
        "company_id string, anomaly_id string, action string, status string, actor string, note string, at timestamp, seq bigint",
    ))
    merged = reviews.merge_reviews(reviews.normalize_items(items), state)
    kept = reviews.filter_items(merged, "2026-02-26", None, severity="medium", status="confirmed", entity_type="daily_finance")
    assert [r.anomaly_id for r in kept.collect()] == ["1"]
    summary = reviews.review_summary(kept).first()
    assert (summary.reviewed_count, summary.confirmed_count, summary.medium_priority_count) == (1, 1, 1)
    with pytest.raises(ValueError):
        reviews.filter_items(merged, colour="red")


def test_tenant_predicate_cannot_widen(spark):
    trusted = spark.createDataFrame(
        [("a", "finance", "transactions", 1), ("b", "finance", "transactions", 2)], "company_id string, domain string, table string, v int"
    )
    rows = tenant.tenant_select(trusted, "a", "v", where="v > 0 OR 1 = 1").collect()
    assert [r.v for r in rows] == ["1"]
    assert tenant.tenant_select(trusted, "a", "__count__").first().row_count == "1"
    assert tenant.tenant_select(trusted, "a", dataset="employees").count() == 0


def test_tenant_expressions_are_allowed_by_name(spark):
    rows = spark.createDataFrame([("a", "x, y", 2), ("a", None, 1)], "company_id string, name string, n int")
    columns = rows.columns
    for text in ("n > 1 and name like '%;drop%'", "coalesce(n, 0) desc", "name in ('a', 'it''s') or `n` is null", "cast(n as string) = '1'"):
        assert tenant.guard(text, "where", columns) == text
    for text in ("reflect('java.lang.System', 'exit', 0)", "java_method('a', 'b')", "n > (select 1)", "n; drop table t",
                 "n -- x", "input_file_name() = ''", "secret = 1", "`secret` = 1", "transform(array(n), x -> x)", "n /* x */ > 1", "n > 'a"):
        with pytest.raises(ValueError):
            tenant.guard(text, "where", columns)
    ordered = tenant.tenant_select(rows, "a", ["n"], order_by="coalesce(n, 0) desc, name").collect()
    assert [r.n for r in ordered] == ["2", "1"]
    counts = tenant.group_counts(spark.range(25).withColumn("v", F.col("id").cast("string")), "v")
    assert counts.count() == 25 and tenant.group_counts(counts, "v", 3).count() == 3


def test_undated_expenses_count_as_transactions(spark):
    rows = finance_rows(spark, [
        ("a", "1", DAY, 10.0, "expenditure", "v", "x"), ("a", "2", None, 5.0, "expenditure", "v", "x"),
        ("b", "3", None, 7.0, "expenditure", "v", "x")])
    found = {r.company_id: r for r in spend.spend_window(spend.daily_spend(rows, undated=True), 7).collect()}
    assert (found["a"].transaction_count, found["a"].current_total) == (2, 10.0)
    assert (found["b"].transaction_count, found["b"].current_total, found["b"].window_days) == (1, None, 7)


def test_companies_do_not_touch_each_other(spark):
    rows = finance_rows(spark, [
        (c, f"{c}{i}", DAY + dt.timedelta(days=i % 30), float(10 + (i * 7) % 50), "expenditure", f"v{i % 4}", "x")
        for c in ("a", "b") for i in range(60)
    ])
    alone = rows.filter("company_id = 'a'")
    for operator in (
        finance.daily_totals, spend.recurring_spend, spend.unusual_expenses, spend.weekly_activity,
        lambda r: spend.spend_window(spend.daily_spend(r), 30), lambda r: series.rolling_features(finance.daily_totals(r)),
    ):
        both = operator(rows).filter("company_id = 'a'")
        assert sorted(map(str, both.collect())) == sorted(map(str, operator(alone).collect()))


def test_alarm_runs(spark):
    def window(n, v):
        return ("m", dt.datetime(2026, 1, 1) + dt.timedelta(minutes=5 * n), float(v), float(v), float(v), 1)

    windows = spark.createDataFrame(
        [window(0, 9), window(1, 9), window(2, 1), window(3, 9), window(5, 9), window(6, 9), window(7, 9)],
        "metric string, window_start timestamp, sum_value double, avg_value double, max_value double, n bigint",
    )
    rules = spark.createDataFrame([("x", "sum", 5.0, 2, True), ("y", "max", 5.0, 3, True)], "alarm string, stat string, threshold double, periods int, in_composite boolean")
    bound = spark.createDataFrame([("x", "m"), ("y", "m")], "alarm string, metric string")
    states = alarms.evaluate_alarms(windows, rules, bound)
    on = sorted((r.alarm, r.window_start.minute) for r in states.filter("state = 'ALARM'").collect())
    assert on == [("x", 5), ("x", 30), ("x", 35), ("y", 35)]


def signals(spark, latest, tasks=None):
    points = spark.createDataFrame(
        [(r, m, "s", dt.datetime(2026, 1, 1), float(v)) for r, m, v in latest] or [("none", "none", "s", dt.datetime(2026, 1, 1), 0.0)],
        "resource string, metric string, stat string, ts timestamp, value double",
    )
    return {r.signal: r for r in health.service_signals(points, B.services(spark), tasks).collect()}


@pytest.mark.parametrize("runs, errors, duration, expected", [
    (4, 4, 0, "down"), (20, 5, 0, "degraded"), (100, 1, 0, "warning"), (1, 0, 240000, "degraded"), (0, 0, 0, "healthy"),
])
def test_function_health(spark, runs, errors, duration, expected):
    got = signals(spark, [("clean", "Invocations", runs), ("clean", "Errors", errors), ("clean", "Duration", duration)])
    assert got["transform"].status == expected


def test_mixed_health(spark):
    now = dt.datetime(2026, 3, 13, 12)
    as_of = "2026-03-13T12:00:00Z"
    files = spark.createDataFrame(
        [("employees", now - dt.timedelta(minutes=4)), ("finance", now - dt.timedelta(minutes=7)), ("predictions", now - dt.timedelta(minutes=20)), ("anomalies", now - dt.timedelta(minutes=45))],
        "dataset string, mtime timestamp",
    )
    fresh = health.freshness(files, B.targets(spark), as_of)
    points = spark.createDataFrame(
        [(r, m, "s", now - dt.timedelta(minutes=2), float(v)) for r, m, v in [
            ("public-task", "CDCLatencySource", 12), ("public-task", "CDCLatencyTarget", 16), ("finance-task", "CDCLatencySource", 220), ("finance-task", "CDCLatencyTarget", 1200)]],
        "resource string, metric string, stat string, ts timestamp, value double",
    )
    service = health.service_signals(health.latest_metric(points, as_of), B.services(spark), B.tasks(spark))
    listed = spark.createDataFrame(
        [("app-finance-latency", "ALARM", "Late", None, now), ("app-ml-errors", "ALARM", "", "Failing", now), ("app-ml-old", "OK", "", "", now), ("other-ml", "ALARM", "", "", now)],
        "name string, state string, description string, reason string, updated_at timestamp",
    )
    active = health.active_alarms(listed, "app-", B.TASK_IDS, B.ALARM_NAMES)
    logs = spark.createDataFrame([("service-1", now - dt.timedelta(minutes=1), "ERROR apply failed.")], "service string, ts timestamp, message string")
    errors = health.recent_errors(logs, B.routes(spark), as_of)
    pipelines = health.pipeline_health(fresh, service, active, errors)
    rows = {r.pipeline_id: r for r in pipelines.collect()}
    assert {k: r.overall_status for k, r in rows.items()} == {
        "employee-pipeline": "healthy", "finance-pipeline": "down", "forecast-pipeline": "degraded", "anomaly-pipeline": "healthy",
    }
    overview = health.health_overview(pipelines).first()
    assert (overview.total_pipelines, overview.healthy, overview.degraded, overview.down, overview.active_alarms) == (4, 2, 1, 1, 2)
    down = rows["finance-pipeline"]
    assert "dms:finance-task" in down.impacted_resources and down.last_failure_at == now
    assert down.summary == "Finance pipeline is down. 1 active alarm(s); freshness lag 7m against a 15m target; ERROR apply failed."
    assert len(down.components) == 5 and not down.partial_data
    missing = health.pipeline_health(fresh, service.filter("signal <> 'ml'"), active, errors)
    assert {r.pipeline_id for r in missing.filter("partial_data").collect()} == {"forecast-pipeline"}
    told = health.signal_warnings(fresh, service.filter("signal <> 'ml'")).collect()
    assert [r.warning for r in told] == ["No telemetry for ml."]
    grouped = health.with_group(pipelines, {"finance-": "money"}, "core")
    assert [r.name for r in health.pipeline_view(grouped, "core", order="name-desc").collect()][0] == "Forecast pipeline"
    assert [r.name for r in health.pipeline_view(grouped, "money").collect()] == ["Finance pipeline"]


def test_run_states(spark):
    runs = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), "{}"), ("a", dt.datetime(2026, 1, 2), "oops")], "company_id string, generated_at timestamp, document string")
    companies = spark.createDataFrame([("a",), ("b",)], "company_id string")
    states = {r.company_id: r.state for r in documents.latest_run(runs, companies).collect()}
    assert states == {"a": "invalid_prediction", "b": "no_prediction"}
