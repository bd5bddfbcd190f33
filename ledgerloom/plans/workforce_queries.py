"""Queries on employees, dashboard figures, forecasts and their views."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import (
    documents, evaluate, finance, forecast, insights, kpi, outlook, rollup, spend, workforce,
)
from ..session import materialize
from . import bindings as B
from .registry import query

_EMP = f"WITH {B.SQL_EMPLOYEES}"
_ALL = f"WITH {B.SQL_ALL_SERIES}"
_AHEAD = f"{_ALL}, {B.SQL_AHEAD}"


@query("employee_events", f"{_EMP} SELECT company_id, employee_id, ts AS event_ts, is_active, seq FROM emp")
def employee_events(spark, d):
    """Employee events with the state their record tells."""
    rows = B.employees(spark, d)
    return rows.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("headcount", f"{_EMP}, {B.SQL_HEADCOUNT} SELECT company_id, date, headcount FROM heads")
def headcount(spark, d):
    """Active employees at the end of each day."""
    return workforce.headcount(B.employees(spark, d))


@query("headcount_fallback", f"{_EMP} SELECT company_id, date, count(DISTINCT employee_id) AS headcount FROM emp GROUP BY ALL")
def headcount_fallback(spark, d):
    """Distinct employees seen each day."""
    return workforce.headcount_fallback(B.employees(spark, d))


@query("department_top", """
WITH c AS (SELECT replace(lower(r_name), ' ', '-') AS company_id, CASE WHEN c_custkey % 11 = 0 THEN 'Unknown' ELSE c_mktsegment END AS label, count(*) AS value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY value DESC, label) AS rank FROM c)
SELECT company_id, label, value, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 6
""")
def department_top(spark, d):
    """The six largest departments by records."""
    return workforce.department_top(_staff(spark, d))


def _staff(spark, d):
    customer = B.table(spark, d, "customer")
    return customer.join(B._regions(spark, d), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "company_id", F.when(F.col("c_custkey") % 11 == 0, " ").otherwise(F.col("c_mktsegment")).alias("department")
    )


@query("forecast_gate", f"""
{_ALL}, short AS (SELECT * FROM series UNION ALL SELECT company_id, 'new_metric', date, value FROM series WHERE metric = 'employee_headcount' AND date < DATE '2024-01-12')
SELECT company_id, metric, count(*) AS history_points, max(date) AS last_date, greatest(count(*) - 14, 0) AS training_rows,
  CASE WHEN count(*) >= 21 THEN 'ok' ELSE 'insufficient_data' END AS status,
  CASE WHEN count(*) < 21 THEN 'Need at least 21 daily points; found ' || count(*) || '.' END AS message
FROM short GROUP BY ALL
""")
def forecast_gate(spark, d):
    """Whether each series is long enough to model."""
    series = B.all_series(spark, d)
    short = series.filter("metric = 'employee_headcount' AND date < DATE '2024-01-12'")
    return forecast.forecast_gate(series.unionByName(short.withColumn("metric", F.lit("new_metric"))))


@query("forecast")
def forecasts(spark, d):
    """Sixty-day forecasts of headcount, revenue and expenditure."""
    return forecast.forecast(B.all_series(spark, d))


@query("forecast_span", f"""
{_ALL} SELECT company_id, metric, 60 AS days, CAST(max(date) + 1 AS DATE) AS first_day, CAST(max(date) + 60 AS DATE) AS last_day, CAST(count(*) - 14 AS INTEGER) AS rows_used, TRUE AS ordered
FROM series GROUP BY ALL HAVING count(*) >= 21
""")
def forecast_span(spark, d):
    """Days, training rows and order of bounds of every forecast."""
    low, value, high = (F.col(c) for c in ("lower_bound", "predicted_value", "upper_bound"))
    return forecasts(spark, d).groupBy("company_id", "metric").agg(
        F.count("*").cast("int").alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.max("rows_used").alias("rows_used"), F.every((low >= 0) & (low <= value) & (value <= high)).alias("ordered"),
    )


@query("run_status", f"""
{_ALL}, g AS (SELECT company_id, metric, CASE WHEN count(*) >= 21 THEN 'ok' ELSE 'insufficient_data' END AS status FROM series WHERE NOT (company_id = 'asia' AND metric = 'employee_headcount') GROUP BY ALL),
r AS (SELECT company_id, count(*) AS finance, 0 AS employees FROM fin GROUP BY ALL UNION ALL SELECT 'nobody', 0, 0)
SELECT company_id, CAST(employees AS BIGINT) AS employees, CAST(finance AS BIGINT) AS finance,
  CASE WHEN company_id = 'nobody' THEN 'insufficient_data' WHEN company_id = 'asia' THEN 'insufficient_data' ELSE 'ok' END AS employee_headcount,
  coalesce((SELECT status FROM g WHERE g.company_id = r.company_id AND metric = 'revenue'), 'insufficient_data') AS revenue,
  coalesce((SELECT status FROM g WHERE g.company_id = r.company_id AND metric = 'expenditure'), 'insufficient_data') AS expenditure,
  CASE WHEN company_id = 'nobody' THEN 'insufficient_data' ELSE 'ok' END AS finance_status,
  CASE WHEN company_id = 'nobody' THEN 'no_input_data' ELSE 'ok' END AS status
FROM r
""")
def run_status(spark, d):
    """Overall status of each company's run."""
    rows = B.orders_finance(spark, d)
    series = B.all_series(spark, d).filter("NOT (company_id = 'asia' AND metric = 'employee_headcount')")
    read = rows.groupBy("company_id").agg(F.count("*").alias("finance")).withColumn("employees", F.lit(0).cast("bigint"))
    none = spark.range(1).select(F.lit("nobody").alias("company_id"), F.lit(0).cast("bigint").alias("finance"), F.lit(0).cast("bigint").alias("employees"))
    return forecast.run_status(forecast.forecast_gate(series), read.unionByName(none))


def _rolled(spark, d, profile="job"):
    """The daily roll-up of the finance rows, and the series of all metrics read from it; each table is scanned once."""
    facts = materialize(rollup.daily_facts(B.orders_finance(spark, d, profile)), "rollup")
    heads = workforce.headcount(B.employees(spark, d))
    return facts, materialize(forecast.metric_series(None, heads, flows=rollup.flows(facts)), "series")


def _facts(spark, d):
    _, series = _rolled(spark, d)
    return series, B.repeat_ahead(series)


def _runs(spark):
    """Run facts of the five companies: three statuses, one of them without rows."""
    status = F.element_at(F.array(F.lit("ok"), F.lit("partial_data"), F.lit("insufficient_data")), F.col("n") % 3 + 1)
    return spark.range(5).select(
        B.company_of(F.col("id")).alias("company_id"), F.col("id").cast("int").alias("n")
    ).select("company_id", status.alias("status"), F.when(F.col("n") == 4, 0).otherwise(F.col("n") * 10 + 20).cast("bigint").alias("rows_processed"))


_SQL_RUNS = f"""
runs AS (SELECT {B.sql_company('n')} AS company_id, ['ok', 'partial_data', 'insufficient_data'][n % 3 + 1] AS status,
  CASE WHEN n = 4 THEN 0 ELSE n * 10 + 20 END AS rows_processed FROM (SELECT unnest([0, 1, 2, 3, 4]) AS n))"""
_SQL_KPI = f"""
{_SQL_RUNS},
hb AS (SELECT company_id, floor(value) AS v, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS b, count(*) OVER (PARTITION BY company_id) AS n FROM series WHERE metric = 'employee_headcount'),
hk AS (SELECT company_id, max(v) FILTER (b = 1) AS total_employees, max(v) FILTER (b = least(31, n)) AS base FROM hb GROUP BY ALL),
rb AS (SELECT company_id, value AS v, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS b FROM series WHERE metric = 'revenue'),
rk AS (SELECT company_id, max(v) FILTER (b = 1) AS revenue, max(v) FILTER (b = 2) AS previous FROM rb GROUP BY ALL),
gk AS (SELECT company_id, arg_min(predicted_value, step) AS s, arg_max(predicted_value, step) AS e FROM ahead WHERE metric = 'employee_headcount' GROUP BY ALL),
kpis AS (
SELECT company_id, CAST(CASE status WHEN 'ok' THEN 50 WHEN 'partial_data' THEN 25 ELSE 0 END + CASE WHEN rows_processed > 0 THEN 50 ELSE 0 END AS INTEGER) AS data_health_percent,
  CASE status WHEN 'ok' THEN 'prediction status ok' WHEN 'partial_data' THEN 'partial data' ELSE 'limited prediction quality' END
    || CASE WHEN rows_processed > 0 THEN ', ' || rows_processed || ' rows processed' ELSE '' END AS data_health_reasons,
  total_employees, CASE WHEN base > 0 THEN round((total_employees - base) / base * 100, 2) END AS employees_delta_percent,
  round(revenue, 2) AS revenue, CASE WHEN previous <> 0 THEN round((revenue - previous) / abs(previous) * 100, 2) END AS revenue_delta_percent,
  CASE WHEN s = 0 THEN 0.0 ELSE round((e - s) / s * 100, 2) END AS growth_percent
FROM runs LEFT JOIN hk USING (company_id) LEFT JOIN rk USING (company_id) LEFT JOIN gk USING (company_id))
"""


@query("kpi_metrics", f"{_AHEAD}, {_SQL_KPI} SELECT * FROM kpis")
def kpi_metrics(spark, d):
    """Metric cards: employees, revenue, growth, data health."""
    history, ahead = _facts(spark, d)
    return kpi.kpi_metrics(history, ahead, _runs(spark))


@query("headcount_movement", f"""
{_EMP}, {B.SQL_HEADCOUNT}, p AS (SELECT *, headcount - lag(headcount) OVER (PARTITION BY company_id ORDER BY date) AS g FROM heads)
SELECT company_id, headcount, coalesce(g, 0) AS growth_count FROM p QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) = 1
""")
def headcount_movement(spark, d):
    """Last headcount and its change from the day before."""
    return workforce.headcount_movement(headcount(spark, d))


_SQL_CHART = """
points AS (
  SELECT company_id, date, value, FALSE AS is_forecast FROM series WHERE metric = 'employee_headcount'
  UNION ALL SELECT company_id, date, predicted_value, TRUE FROM ahead WHERE metric = 'employee_headcount'),
chart AS (
  SELECT company_id, date, strftime(date, '%b %d') AS label, CAST(round_even(greatest(value, 0), 0) AS BIGINT) AS value, is_forecast FROM points
  QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC, is_forecast DESC) <= 70)
"""


@query("headcount_chart", f"""
{_AHEAD}, {_SQL_CHART}, a AS (SELECT * FROM chart WHERE NOT is_forecast QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) <= 6)
SELECT 'chart' AS part, company_id, date, label, value, is_forecast FROM chart
UNION ALL SELECT 'actual', company_id, date, label, value, FALSE FROM a
""")
def headcount_chart(spark, d):
    """Headcount history and forecast as one chart, and the actual points before it."""
    history, ahead = _facts(spark, d)
    chart = kpi.headcount_chart(history, ahead, 70)
    current = kpi.employee_kpi(history, ahead)
    recent = kpi.recent_actuals(chart, current, 30).withColumn("is_forecast", F.lit(False))
    return chart.withColumn("part", F.lit("chart")).unionByName(recent.withColumn("part", F.lit("actual")))


@query("series_insight", f"""
{_ALL}, t AS (SELECT *, row_number() OVER (PARTITION BY company_id, metric ORDER BY date DESC) AS b FROM series),
k AS (SELECT * FROM t WHERE b <= 12)
SELECT company_id, metric, count(*) AS points, max(value) FILTER (b = 1) AS latest, max(date) AS latest_date,
  CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS average, max(value) AS max_value, arg_max(date, (value, b)) AS max_date,
  min(value) AS min_value, arg_min(date, (value, date)) AS min_date, coalesce(max(value) FILTER (b = 1) - max(value) FILTER (b = 2), 0) AS delta,
  CASE WHEN max(value) FILTER (b = 2) <> 0 THEN (max(value) FILTER (b = 1) - max(value) FILTER (b = 2)) / abs(max(value) FILTER (b = 2)) * 100 END AS delta_percent
FROM k GROUP BY ALL
""")
def series_insight(spark, d):
    """Latest, mean, extremes and change of each metric's last twelve points."""
    return kpi.series_insight(B.all_series(spark, d), 12, ("company_id", "metric"))


_SQL_MONTH_END = """
spent AS (SELECT company_id, date, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS value FROM fin WHERE source_area = 'expenditure' GROUP BY ALL),
lastday AS (SELECT company_id, max(date) AS l FROM spent GROUP BY ALL),
act AS (SELECT company_id, l, CAST(coalesce(sum(CASE WHEN date_trunc('month', date) = date_trunc('month', l) THEN CAST(value AS DECIMAL(28,6)) END), 0) AS DOUBLE) AS cur,
  CAST(coalesce(sum(CASE WHEN date_trunc('month', date) = date_trunc('month', l) - INTERVAL 1 MONTH THEN CAST(value AS DECIMAL(28,6)) END), 0) AS DOUBLE) AS prev
  FROM spent JOIN lastday USING (company_id) GROUP BY ALL),
fc AS (SELECT company_id, predicted_value AS v, date > l AND date_trunc('month', date) = date_trunc('month', l) AS here FROM ahead JOIN lastday USING (company_id) WHERE metric = 'expenditure'),
fs AS (SELECT company_id, count(*) FILTER (here) AS coverage_days, CAST(coalesce(sum(CASE WHEN here THEN CAST(v AS DECIMAL(28,6)) END), 0) AS DOUBLE) AS s,
  CAST(sum(CASE WHEN here THEN CAST(v AS DECIMAL(28,6)) END) AS DOUBLE) / nullif(count(*) FILTER (here), 0) AS mh, CAST(sum(CAST(v AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS ma FROM fc GROUP BY ALL),
mons AS (SELECT company_id, date_trunc('month', date) AS month, CAST(coalesce(sum(CASE WHEN source_area = 'expenditure' THEN CAST(amount AS DECIMAL(28,6)) END), 0) AS DOUBLE) AS e FROM fin GROUP BY ALL),
mon AS (SELECT company_id, e FROM mons QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY month DESC) = 2),
me AS (SELECT company_id, l AS latest_actual_date, cur AS current_month_actual, coverage_days, CAST(greatest(0, (last_day(l) - l) - coverage_days) AS BIGINT) AS fallback_days,
  cur + s + coalesce(mh, ma, 0) * greatest(0, (last_day(l) - l) - coverage_days) AS projected_month_end_spend,
  CASE WHEN e > 0 THEN e ELSE prev END AS previous_month_spend
  FROM act LEFT JOIN fs USING (company_id) LEFT JOIN mon USING (company_id)),
month_end AS (SELECT *, CASE WHEN previous_month_spend > 0 THEN (projected_month_end_spend - previous_month_spend) / previous_month_spend * 100 END AS projected_vs_last_month FROM me)
"""


@query("month_end", f"{_AHEAD}, {_SQL_MONTH_END} SELECT * FROM month_end")
def month_end(spark, d):
    """Projected month-end spend against last month."""
    rows = B.orders_finance(spark, d)
    _, ahead = _facts(spark, d)
    monthly = spend.monthly_finance(finance.daily_flows(rows))
    return outlook.month_end(
        spend.daily_spend(rows), ahead.filter("metric = 'expenditure'"), outlook.previous_month_baseline(monthly)
    )


_SQL_CONFIDENCE = """
ratios AS (SELECT company_id, metric, CAST(sum(CAST(greatest(0, upper_bound - lower_bound) / greatest(1, predicted_value) AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS ratio FROM ahead WHERE metric <> 'revenue' GROUP BY ALL),
per AS (SELECT company_id, avg(ratio) AS interval_ratio FROM ratios GROUP BY ALL),
band AS (SELECT company_id, data_health_percent, interval_ratio, CASE WHEN interval_ratio IS NULL THEN 68 WHEN interval_ratio <= .15 THEN 90 WHEN interval_ratio <= .3 THEN 76 WHEN interval_ratio <= .45 THEN 61 ELSE 46 END AS b FROM kpis LEFT JOIN per USING (company_id)),
conf AS (SELECT company_id, data_health_percent, interval_ratio, CAST(floor(data_health_percent * 0.65::DOUBLE + b * 0.35::DOUBLE + 0.5) AS BIGINT) AS score FROM band),
confidence AS (SELECT *, CASE WHEN score >= 78 THEN 'High' WHEN score >= 58 THEN 'Medium' ELSE 'Low' END AS label FROM conf)
"""


@query("forecast_confidence", f"{_AHEAD}, {_SQL_KPI}, {_SQL_CONFIDENCE} SELECT * FROM confidence")
def forecast_confidence(spark, d):
    """Confidence from data health and interval width."""
    history, ahead = _facts(spark, d)
    return outlook.forecast_confidence(ahead, kpi.kpi_metrics(history, ahead, _runs(spark)))


_SQL_HEADLINE = """
hp AS (SELECT company_id, arg_max(predicted_value, step) FILTER (step <= 30) AS p, arg_max(predicted_value, step) AS l, max(predicted_value) FILTER (step <= 30) AS peak FROM ahead WHERE metric = 'employee_headcount' GROUP BY ALL),
hc AS (SELECT company_id, coalesce(nullif(total_employees, 0), l, 0.0) AS c, p, l, peak FROM kpis LEFT JOIN hp USING (company_id)),
headline AS (SELECT company_id, c AS current_headcount, coalesce(p, l, c) AS projected_headcount, coalesce(p, l, c) - c AS headcount_change, greatest(c, coalesce(peak, c)) AS peak_headcount FROM hc)
"""


@query("forecast_headline", f"{_AHEAD}, {_SQL_KPI}, {_SQL_HEADLINE} SELECT * FROM headline")
def forecast_headline(spark, d):
    """Projected headcount, its change and its peak in thirty days."""
    history, ahead = _facts(spark, d)
    return outlook.forecast_headline(ahead, kpi.kpi_metrics(history, ahead, _runs(spark)), 30)


def _risk_facts(spark, d):
    finance_facts, history = _rolled(spark, d)
    ahead = B.repeat_ahead(history)
    cards = kpi.kpi_metrics(history, ahead, _runs(spark))
    monthly = spend.monthly_finance(rollup.flows(finance_facts))
    ends = outlook.month_end(
        rollup.spent(finance_facts), ahead.filter("metric = 'expenditure'"), outlook.previous_month_baseline(monthly)
    ).select("company_id", "projected_vs_last_month")
    unusual = rollup.unusual_expenses(finance_facts).groupBy("company_id").agg(F.count("*").alias("unusual_expense_count"))
    confidence = outlook.forecast_confidence(ahead, cards).select("company_id", "score", F.col("label").alias("confidence_label"))
    head = outlook.forecast_headline(ahead, cards, 30)
    out = cards.select("company_id", "growth_percent")
    for part in (ends, unusual, confidence, head):
        out = out.join(part, "company_id", "left")
    return outlook.forecast_risk(out), finance_facts, monthly, history


@query("forecast_risk", f"""
{_AHEAD}, {_SQL_KPI}, {_SQL_CONFIDENCE}, {_SQL_HEADLINE}, {_SQL_MONTH_END},
g AS (SELECT company_id, avg(amount) AS m, stddev_pop(amount) AS s FROM fin WHERE source_area = 'expenditure' GROUP BY ALL),
u AS (SELECT company_id, least(count(*), 3) AS unusual_expense_count FROM fin JOIN g USING (company_id) WHERE source_area = 'expenditure' AND amount > m + 1.8 * s AND amount > 1.35 * m GROUP BY ALL),
x AS (SELECT company_id, projected_vs_last_month AS o, unusual_expense_count AS u, score, headcount_change AS h FROM kpis LEFT JOIN month_end USING (company_id) LEFT JOIN u USING (company_id) LEFT JOIN confidence USING (company_id) LEFT JOIN headline USING (company_id)),
y AS (SELECT *, CASE WHEN o >= 10 THEN 2 WHEN o >= 4 THEN 1 ELSE 0 END + CASE WHEN u > 0 THEN 1 ELSE 0 END + CASE WHEN score < 58 THEN 1 ELSE 0 END + CASE WHEN h >= 5 THEN 1 ELSE 0 END AS risk_score,
  list_filter([CASE WHEN o >= 10 THEN 'spend is tracking materially above last month' WHEN o >= 4 THEN 'spend is trending above last month' END,
   CASE WHEN u > 0 THEN 'recent transactions are less predictable' END, CASE WHEN score < 58 THEN 'forecast confidence is limited' END, CASE WHEN h >= 5 THEN 'payroll demand is increasing' END], lambda r: r IS NOT NULL) AS r FROM x)
SELECT company_id, CAST(risk_score AS INTEGER) AS risk_score, array_to_string(r[1:2], ' and ') AS risk_reasons, CASE WHEN risk_score >= 3 THEN 'High' WHEN risk_score >= 1 THEN 'Medium' ELSE 'Low' END AS risk_label FROM y
""")
def forecast_risk(spark, d):
    """Risk label with its first two reasons."""
    return _risk_facts(spark, d)[0].select("company_id", "risk_score", "risk_reasons", "risk_label")


def _sql_notes() -> str:
    """The note rules in SQL over ``z``, one row of facts per company."""
    percent = "CASE WHEN {0} > 0 THEN '+' WHEN {0} < 0 THEN '-' ELSE '' END || printf('%.1f%%', abs({0}))"
    many, staff = "CASE WHEN u = 1 THEN '' ELSE 's' END", "CASE WHEN sz = 1 THEN '' ELSE 's' END"
    tone = "CASE cl WHEN 'High' THEN 'positive' WHEN 'Medium' THEN 'muted' WHEN 'Low' THEN 'warning' END"
    trust = ("CASE cl WHEN 'High' THEN 'Spend and staffing have moved evenly, so the forecast bands are narrow.' WHEN 'Medium' THEN "
             "'The direction can be trusted; the bands open up towards the end of the horizon.' WHEN 'Low' THEN "
             "'Recent data jump about and the bands are wide, so take this as a rough guide.' END")
    risk_tone = "CASE rl WHEN 'High' THEN 'warning' WHEN 'Medium' THEN 'muted' WHEN 'Low' THEN 'positive' END"
    risk = ("CASE rl WHEN 'High' THEN 'The plan is likely to slip: ' || rr || '.' WHEN 'Medium' THEN 'Keep an eye on the plan: ' || rr || '.' "
            "ELSE 'Neither spend nor hiring leaves its usual course within the horizon.' END")
    whole = "format('{{:,}}', CAST(floor({0} + 0.5) AS BIGINT))"
    dollars = "'$' || format('{{:,}}', CAST(round_even({0}, 0) AS BIGINT))"
    calm = "NOT (coalesce(o > 4, FALSE) OR coalesce(h > 0, FALSE) OR cl <> 'High' OR u > 0 OR cat IS NOT NULL)"
    rules = [
        ("highlight", 1, "o IS NOT NULL", "spend", "Spend", "CASE WHEN o > 0 THEN 'warning' ELSE 'positive' END",
         "'This month should close ' || printf('%.1f%% ', abs(o)) || CASE WHEN o >= 0 THEN 'over' ELSE 'under' END || ' the month before.'",
         "'Measured as expected spend at month end against the last full month.'"),
        ("highlight", 2, "h IS NOT NULL AND ph > 0", "headcount", "Headcount", "CASE WHEN h > 0 THEN 'positive' ELSE 'muted' END",
         "CASE WHEN h > 0 THEN 'Expect ' || sz || ' more on the staff over the next 30 days.' WHEN h < 0 THEN 'Expect ' || sz || ' fewer on the staff over the next 30 days.' ELSE 'Staff numbers should hold over the next 30 days.' END",
         f"CASE WHEN ch <> 0 THEN 'From ' || {whole.format('ch')} || ' today to about ' || {whole.format('ph')} || '.' ELSE 'More staff records will make this figure firmer.' END"),
        ("highlight", 3, "cl IS NOT NULL", "all", "Confidence", tone, "'Trust in the forecast: ' || lower(cl) || '.'", trust),
        ("highlight", 4, "cat IS NOT NULL", "spend", "Cost driver", "'muted'", "'Most of the recent cost comes from ' || cat || '.'",
         f"'It accounts for ' || {dollars.format('cv')} || ' of what was booked lately.'"),
        ("highlight", 5, "TRUE", "all", "Risk", risk_tone,
         f"CASE WHEN u > 0 THEN u || ' odd payment' || {many} || ' may lift spend past the forecast.' ELSE 'The forecast holds no sudden cost.' END",
         "CASE WHEN u > 0 THEN 'Look into them now; they may be the start of a pattern.' ELSE 'Its bands stay level to the end of the horizon.' END"),
        ("risk", 1, "o > 4", "spend", "Spend pressure", "'warning'", "'Costs run ahead of the month before.'", f"'By month end the gap should be ' || {percent.format('o')} || '.'"),
        ("risk", 2, "h > 0", "headcount", "Payroll", "CASE WHEN h >= 5 THEN 'warning' ELSE 'muted' END", "'Payroll will probably grow.'",
         f"'The horizon brings ' || sz || ' new employee' || {staff} || '.'"),
        ("risk", 3, "cl <> 'High'", "all", "Confidence", tone, "'Far dates are less certain than near ones.'",
         "'Read them for their direction, and run the forecast again once new data are in.'"),
        ("risk", 4, "u > 0", "spend", "Variability", "'warning'", "'Payments have become hard to foresee.'", f"u || ' transaction' || {many} || ' fall out of the usual range.'"),
        ("risk", 5, "u = 0 AND cat IS NOT NULL", "spend", "Concentration", "'muted'", "'Spend leans on ' || cat || '.'",
         "'What happens there decides the month more than any other cost.'"),
        ("risk", 6, calm, "all", "Risk", risk_tone, "'Nothing here endangers the plan.'", risk),
        ("action", 1, "cat IS NOT NULL", "spend", "Budget action", "'warning'", "'Go through the regular costs, largest first.'", "'Begin with ' || cat || ' if the plan is overrun again.'"),
        ("action", 2, "h > 0", "headcount", "People planning", "'positive'", "'Set money aside for new staff.'",
         f"'The forecast adds ' || sz || ' employee' || {staff} || ' to today''s number.'"),
        ("action", 3, "dep IS NOT NULL", "headcount", "Department watch", "'muted'", "'Watch ' || dep || ', where most people work.'",
         "'A change of its size moves the total more than any other department.'"),
        ("action", 4, "TRUE", "all", "Refresh cadence", tone, "'Look again when new data have come in.'",
         "CASE WHEN cl = 'High' THEN 'The forecast can carry a plan; check it after large bookings or new hires.' ELSE 'Wait for the next load before you settle on figures.' END"),
        ("key", 1, "sc IS NOT NULL", "spend", "Key insight", "'muted'", "'Change of spend'", f"'Spend moved by ' || {percent.format('sc')} || ' from the month before.'"),
        ("key", 2, "sc IS NULL AND cs > 0", "spend", "Key insight", "'muted'", "'Booked so far'", f"'The month stands at ' || {dollars.format('cs')} || '.'"),
        ("key", 3, "dep IS NOT NULL", "headcount", "Key insight", "'muted'", "'Biggest department'", "'Most employees are in ' || dep || '.'"),
        ("key", 4, "u > 0", "spend", "Key insight", "'muted'", "'Payments to check'", f"u || ' payment' || {many} || ' do not fit what is usually paid.'"),
        ("key", 5, "u = 0 AND gc > 0", "headcount", "Key insight", "'muted'", "'New staff'", "'The last period brought ' || CAST(gc AS BIGINT) || ' more employees.'"),
        ("key", 6, "u = 0 AND NOT coalesce(gc > 0, FALSE) AND gp IS NOT NULL", "headcount", "Key insight", "'muted'", "'Staff ahead'",
         f"'Over the horizon the staff should change by ' || {percent.format('gp')} || '.'"),
    ]
    return " UNION ALL ".join(
        f"SELECT company_id, '{kind}' AS kind, {n} AS position, '{metric}' AS metric, '{tag}' AS tag, {t} AS tone, {title} AS title, {body} AS body FROM z WHERE {when}"
        for kind, n, when, metric, tag, t, title, body in rules)


_SQL_MONTHS = """
mo AS (SELECT company_id, date_trunc('month', date) AS month, CAST(sum(CAST(greatest(revenue, 0) AS DECIMAL(28,6))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(greatest(expenditure, 0) AS DECIMAL(28,6))) AS DOUBLE) AS expenditure FROM flows GROUP BY ALL),
ml AS (SELECT *, lag(expenditure) OVER (PARTITION BY company_id ORDER BY month) AS before, row_number() OVER (PARTITION BY company_id ORDER BY month DESC) AS back FROM mo),
months AS (SELECT *, CASE WHEN before > 0 AND back < 6 THEN (expenditure - before) / before * 100 END AS spend_change_percent FROM ml WHERE back <= 6)
"""
_SQL_STAFF = """
staff AS (SELECT replace(lower(r_name), ' ', '-') AS company_id, CASE WHEN c_custkey % 11 = 0 THEN 'Unknown' ELSE c_mktsegment END AS label, count(*) AS value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
departments AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY value DESC, label) AS rank FROM staff QUALIFY rank <= 6)
"""
_SQL_RISK_FACTS = """
g AS (SELECT company_id, avg(amount) AS m, stddev_pop(amount) AS s FROM fin WHERE source_area = 'expenditure' GROUP BY ALL),
u AS (SELECT company_id, least(count(*), 3) AS unusual_expense_count FROM fin JOIN g USING (company_id) WHERE source_area = 'expenditure' AND amount > m + 1.8 * s AND amount > 1.35 * m GROUP BY ALL),
x AS (SELECT company_id, growth_percent AS gp, projected_vs_last_month AS o, coalesce(unusual_expense_count, 0) AS u, score, label AS cl, current_headcount AS ch, projected_headcount AS ph, headcount_change AS h
  FROM kpis LEFT JOIN month_end USING (company_id) LEFT JOIN u USING (company_id) LEFT JOIN confidence USING (company_id) LEFT JOIN headline USING (company_id)),
rk2 AS (SELECT *, CASE WHEN o >= 10 THEN 2 WHEN o >= 4 THEN 1 ELSE 0 END + CASE WHEN u > 0 THEN 1 ELSE 0 END + CASE WHEN score < 58 THEN 1 ELSE 0 END + CASE WHEN h >= 5 THEN 1 ELSE 0 END AS rs,
  list_filter([CASE WHEN o >= 10 THEN 'spend is tracking materially above last month' WHEN o >= 4 THEN 'spend is trending above last month' END,
   CASE WHEN u > 0 THEN 'recent transactions are less predictable' END, CASE WHEN score < 58 THEN 'forecast confidence is limited' END, CASE WHEN h >= 5 THEN 'payroll demand is increasing' END], lambda r: r IS NOT NULL) AS r FROM x),
cats AS (SELECT company_id, trim(category) AS cat, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS cv FROM fin WHERE source_area = 'expenditure' GROUP BY ALL),
cat AS (SELECT * FROM cats WHERE cat <> '' QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY cv DESC, cat) = 1),
hm AS (SELECT company_id, coalesce(headcount - lag(headcount) OVER (PARTITION BY company_id ORDER BY date), 0) AS gc FROM heads QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) = 1),
z AS (SELECT rk2.*, CASE WHEN rs >= 3 THEN 'High' WHEN rs >= 1 THEN 'Medium' ELSE 'Low' END AS rl, array_to_string(r[1:2], ' and ') AS rr, CAST(trunc(abs(h)) AS BIGINT) AS sz,
  cat.cat, cv, departments.label AS dep, spend_change_percent AS sc, months.expenditure AS cs, gc
  FROM rk2 LEFT JOIN cat USING (company_id) LEFT JOIN departments ON departments.company_id = rk2.company_id AND rank = 1 LEFT JOIN months ON months.company_id = rk2.company_id AND back = 1 LEFT JOIN hm ON hm.company_id = rk2.company_id)
"""


@query("insight_rows", f"""
{_AHEAD}, {_SQL_KPI}, {_SQL_CONFIDENCE}, {_SQL_HEADLINE}, {_SQL_MONTH_END}, {_SQL_MONTHS}, {_SQL_STAFF}, {_SQL_RISK_FACTS},
notes AS ({_sql_notes()}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY company_id, kind ORDER BY CASE WHEN kind = 'key' THEN 0 WHEN metric = 'spend' THEN 0 WHEN metric = 'all' THEN 1 ELSE 2 END, position) AS rank FROM notes)
SELECT company_id, kind, metric, tag, tone, title, body, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= CASE WHEN kind = 'key' THEN 3 ELSE 4 END
""")
def insight_rows(spark, d):
    """Notes on spend, headcount, confidence and risk, spend first."""
    facts, finance_facts, monthly, history = _risk_facts(spark, d)
    category = rollup.top_labels(finance_facts, "category", 1).select(
        "company_id", F.col("label").alias("largest_category"), F.col("value").alias("largest_category_value")
    )
    department = workforce.department_top(_staff(spark, d), 1).select("company_id", F.col("label").alias("largest_department"))
    newest = F.row_number().over(W.partitionBy("company_id").orderBy(F.desc("month")))
    this = monthly.withColumn("_n", newest).filter("_n = 1").select(
        "company_id", "spend_change_percent", F.col("expenditure").alias("current_spend")
    )
    heads = history.filter("metric = 'employee_headcount'").withColumnRenamed("value", "headcount")
    moved = workforce.headcount_movement(heads).select("company_id", "growth_count")
    for part in (category, department, this, moved):
        facts = facts.join(part, "company_id", "left")
    return insights.insight_rows(facts, "spend")


@query("dashboard")
def dashboard(spark, d):
    """The dashboard bundle of each company."""
    # Companies without a stored run fall back to raw aggregates.
    finance_facts, history = _rolled(spark, d, "api")
    ahead = B.repeat_ahead(history)
    stored = history.filter("company_id <> 'asia' OR metric = 'employee_headcount'")
    raw = forecast.metric_series(None, None, flows=rollup.flows(finance_facts))
    history = documents.with_fallback(stored, raw, ["company_id", "metric"])
    flows = history.filter("metric <> 'employee_headcount'").groupBy("company_id", "date").agg(
        *[F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0)).alias(m) for m in ("revenue", "expenditure")]
    )
    return documents.dashboard(
        kpi.kpi_metrics(history, ahead, _runs(spark)), spend.monthly_finance(flows),
        kpi.headcount_chart(history, ahead), workforce.department_top(_staff(spark, d)),
        rollup.weekly_activity(finance_facts), rollup.sources(finance_facts),
    )


_SQL_PARTS = """
weekly AS (SELECT company_id, date, count(*) AS value FROM fin GROUP BY company_id, date QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) <= 7),
ch16 AS (SELECT * FROM chart QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC, is_forecast DESC) <= 16),
parts AS (
  SELECT company_id, 'metrics' AS part, 0 AS position, 'total_employees' AS label, total_employees AS value, employees_delta_percent AS second FROM kpis
  UNION ALL SELECT company_id, 'metrics', 1, 'revenue', revenue, revenue_delta_percent FROM kpis
  UNION ALL SELECT company_id, 'metrics', 2, 'growth', growth_percent, data_health_percent FROM kpis
  UNION ALL SELECT company_id, 'revenue_expenses', row_number() OVER (PARTITION BY company_id ORDER BY month) - 1, strftime(month, '%b'), revenue, expenditure FROM months
  UNION ALL SELECT company_id, 'employee_growth', row_number() OVER (PARTITION BY company_id ORDER BY date, is_forecast) - 1, label, value, CAST(is_forecast AS INTEGER) FROM ch16
  UNION ALL SELECT company_id, 'department_distribution', rank - 1, label, value, NULL FROM departments
  UNION ALL SELECT company_id, 'weekly_activity', row_number() OVER (PARTITION BY company_id ORDER BY date) - 1, strftime(date, '%a'), value, NULL FROM weekly
  UNION ALL SELECT company_id, 'sources', 0, CAST(max(date) AS VARCHAR), count(*), NULL FROM fin GROUP BY company_id)
"""


@query("dashboard_parts", f"""
{_AHEAD}, {_SQL_KPI}, {_SQL_CHART}, {_SQL_MONTHS}, {_SQL_STAFF}, {_SQL_PARTS}
SELECT company_id, part, CAST(position AS INTEGER) AS position, label, CAST(value AS DOUBLE) AS value, CAST(second AS DOUBLE) AS second FROM parts
""")
def dashboard_parts(spark, d):
    """The dashboard bundle taken apart again: cards, charts and sources."""
    point = "array<struct<label:string,value:double,revenue:double,expenditure:double,is_forecast:boolean>>"
    names = ("revenue_expenses", "employee_growth", "department_distribution", "weekly_activity")
    schema = (
        "metrics struct<total_employees:double,employees_delta_percent:double,revenue:double,revenue_delta_percent:double,growth_percent:double,data_health_percent:double>, "
        f"charts struct<{','.join(f'{n}:{point}' for n in names)}>, sources struct<finance_rows:bigint,latest_finance_date:string>")
    bundles = dashboard(spark, d).select("company_id", F.from_json("payload", schema).alias("p"))

    def row(part, position, label, value, second):
        fields = (F.lit(part), position, label, value.cast("double"), second.cast("double"))
        return F.struct(*[f.alias(n) for f, n in zip(fields, ("part", "position", "label", "value", "second"))])

    def chart(name):
        both = name == "revenue_expenses"
        return F.transform(f"p.charts.{name}", lambda e, i: row(
            name, i, e["label"], e["revenue"] if both else e["value"], e["expenditure"] if both else e["is_forecast"].cast("int")))

    m = F.col("p.metrics")
    cards = F.array(
        row("metrics", F.lit(0), F.lit("total_employees"), m["total_employees"], m["employees_delta_percent"]),
        row("metrics", F.lit(1), F.lit("revenue"), m["revenue"], m["revenue_delta_percent"]),
        row("metrics", F.lit(2), F.lit("growth"), m["growth_percent"], m["data_health_percent"]),
        row("sources", F.lit(0), F.col("p.sources.latest_finance_date"), F.col("p.sources.finance_rows"), F.lit(None)))
    return bundles.select("company_id", F.explode(F.concat(cards, *[chart(n) for n in names])).alias("e")).select("company_id", "e.*")


@query("run_document", f"""
{_AHEAD} SELECT company_id, 'history' AS kind, metric, date, round_even(greatest(value, 0), CASE WHEN metric = 'employee_headcount' THEN 0 ELSE 2 END) AS value, NULL::DOUBLE AS lower_bound, NULL::DOUBLE AS upper_bound FROM series
UNION ALL SELECT company_id, 'forecast', metric, date, predicted_value, lower_bound, upper_bound FROM ahead
""")
def run_document(spark, d):
    """Run documents written as JSON and flattened again."""
    history, ahead = _facts(spark, d)
    runs = _runs(spark).select("company_id", "status", F.col("rows_processed").alias("employees"), F.lit(0).alias("finance"))
    docs = documents.run_documents(forecast.rounded_history(history), ahead, runs, "2024-01-31T00:00:00+00:00")
    found = documents.latest_run(docs, runs)
    past = documents.flatten_history(found).select(
        "company_id", F.lit("history").alias("kind"), "metric", "date", "value",
        F.lit(None).cast("double").alias("lower_bound"), F.lit(None).cast("double").alias("upper_bound"),
    )
    coming = documents.flatten_forecast(found).select(
        "company_id", F.lit("forecast").alias("kind"), "metric", "date",
        F.col("predicted_value").alias("value"), "lower_bound", "upper_bound",
    )
    return past.unionByName(coming)


@query("backtest", f"""
{_ALL}, train AS (SELECT * FROM series WHERE date < (SELECT min(s.date) FROM series s WHERE s.company_id = series.company_id AND s.metric = series.metric) + 2300),
tails AS (SELECT *, row_number() OVER (PARTITION BY company_id, metric ORDER BY date DESC) AS b, max(date) OVER (PARTITION BY company_id, metric) AS last_date FROM train),
p AS (SELECT company_id, metric, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS date, value AS v FROM tails, unnest(generate_series(1, 60)) AS s(step) WHERE b <= 28 AND (step - 1) % 28 = 28 - b),
j AS (SELECT company_id, metric, value, abs(value - v) AS g FROM series JOIN p USING (company_id, metric, date))
SELECT company_id, metric, count(*) AS days, CAST(sum(CAST(g AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS mae, sqrt(CAST(sum(CAST(g * g AS DECIMAL(28,6))) AS DOUBLE) / count(*)) AS rmse,
  CAST(coalesce(sum(CASE WHEN value <> 0 THEN CAST(g / abs(value) AS DECIMAL(28,6)) END), 0) AS DOUBLE) / count(*) * 100 AS mape FROM j GROUP BY ALL
""")
def backtest(spark, d):
    """Errors of a repeated-month forecast on held-out days."""
    train, held = evaluate.split_by_days(B.all_series(spark, d), 2300)
    return evaluate.forecast_errors(held, B.repeat_ahead(train))


@query("rolling_backtest")
def rolling_backtest(spark, d):
    """Errors of the forest at two origins of every series, beside the accepted ones."""
    return evaluate.rolling_backtest(B.all_series(spark, d), (14, 7))


@query("backtest_span", f"""
{_ALL}, l AS (SELECT company_id, metric, min(date) AS first, max(date) AS last FROM series GROUP BY ALL),
o AS (SELECT *, CAST(last - CAST(back AS INTEGER) AS DATE) AS origin FROM l, unnest([14, 7]) AS b(back))
SELECT company_id, metric, origin, 7 AS days, CAST(origin - first + 1 AS BIGINT) AS train_days, CASE metric WHEN 'employee_headcount' THEN 3.0 WHEN 'revenue' THEN 80.0 ELSE 50.0 END::DOUBLE AS mae_limit FROM o
WHERE origin - first + 1 >= 21
""")
def backtest_span(spark, d):
    """Origins, training and held-out days of the back-test."""
    found = evaluate.rolling_backtest(B.all_series(spark, d), (14, 7), trees=8)
    return found.select("company_id", "metric", "origin", F.col("days").cast("int").alias("days"), "train_days", "mae_limit")


@query("prf_eval", """
WITH l AS (SELECT source, doc_id, toxic = 1 AS l, quality = 0 AS p FROM labels JOIN documents USING (doc_id)),
c AS (SELECT source, count(*) FILTER (l AND p) AS tp, count(*) FILTER (p AND NOT l) AS fp, count(*) FILTER (l AND NOT p) AS fn FROM l WHERE l OR p GROUP BY ALL),
q AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c)
SELECT source, tp AS true_positives, fp AS false_positives, fn AS false_negatives, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1_score FROM q
""")
def prf_eval(spark, d):
    """Precision, recall and F1 of one label against another, per source."""
    labels = B.table(spark, d, "labels").join(B.table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return evaluate.classification_quality(
        labels.filter("toxic = 1"), labels.filter("quality = 0"), "doc_id", ("source",)
    )


@query("forecast_display", f"""
{_AHEAD} SELECT company_id, metric, date, step, CASE WHEN metric = 'employee_headcount' THEN floor(predicted_value + 0.5) ELSE greatest(predicted_value, 0) END AS predicted_value,
  CASE WHEN metric = 'employee_headcount' THEN floor(lower_bound + 0.5) ELSE greatest(lower_bound, 0) END AS lower_bound,
  CASE WHEN metric = 'employee_headcount' THEN floor(upper_bound + 0.5) ELSE greatest(upper_bound, 0) END AS upper_bound FROM ahead
""")
def forecast_display(spark, d):
    """Forecast points fit for display."""
    return forecast.clean_forecast(_facts(spark, d)[1])


@query("spend_actuals", f"""
WITH {B.SQL_ORDERS}, s AS (SELECT company_id, date, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS value FROM fin WHERE source_area = 'expenditure' GROUP BY ALL),
g AS (SELECT company_id, max(date) - CAST(b AS INTEGER) AS date FROM s, unnest(generate_series(0, 59)) AS x(b) GROUP BY company_id, b)
SELECT company_id, CAST(date AS DATE) AS date, coalesce(value, 0.0) AS value FROM g LEFT JOIN s USING (company_id, date)
""")
def spend_actuals(spark, d):
    """Dense actual spend shown next to a ninety-day forecast."""
    return outlook.spend_actuals(spend.daily_spend(B.orders_finance(spark, d)), 90)
