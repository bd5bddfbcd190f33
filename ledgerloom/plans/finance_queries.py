"""Queries on finance rows, daily series and spend."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import parse_instant, path_date
from ..functions.records import Fields, snapshot
from ..functions.values import parse_number, tenant_id, tenant_slug
from ..operators import anomaly, documents, finance, series, spend
from ..functions.rules import flow_of
from . import bindings as B
from .registry import query

_MONEY = "CAST(coalesce(sum(CAST({} AS DECIMAL(28,6))), 0) AS DOUBLE)"


def _money(x: str) -> str:
    return _MONEY.format(x)


@query("daily_series", f"WITH {B.SQL_ORDERS}, {B.SQL_FLOWS} SELECT company_id, date, revenue, expenditure FROM dense_flows")
def daily_series(spark, d):
    """Dense daily revenue and expenditure per company."""
    return series.dense_daily(finance.daily_flows(B.orders_finance(spark, d)), ["revenue", "expenditure"])


@query("daily_totals", f"WITH {B.SQL_LINES}, {B.SQL_DAILY} SELECT * FROM daily")
def daily_totals(spark, d):
    """Daily total and count per area over line items."""
    return finance.daily_totals(B.lines_finance(spark, d))


@query("rolling_features", f"WITH {B.SQL_LINES}, {B.SQL_DAILY}, {B.SQL_ROLLING} SELECT * FROM rolled")
def rolling_features(spark, d):
    """Prior-seven-row mean and deviation per area."""
    return series.rolling_features(finance.daily_totals(B.lines_finance(spark, d)))


@query("txn_features", f"""
WITH {B.SQL_LINES}, {B.SQL_DAILY}, {B.SQL_ROLLING},
base AS (SELECT company_id, source_area, quantile_cont(amount, 0.5) AS amount_baseline FROM fin GROUP BY ALL)
SELECT fin.company_id, fin.source_area, fin.date, fin.record_id, fin.amount, daily_total, transaction_count,
       rolling_mean_7, rolling_deviation_7, day_of_week, amount_baseline
FROM fin JOIN rolled USING (company_id, source_area, date) JOIN base USING (company_id, source_area)
""")
def txn_features(spark, d):
    """Transactions with their day's features and their area's exact median amount."""
    return anomaly.transaction_frame(B.lines_finance(spark, d)).select(
        "company_id", "source_area", "date", "record_id", "amount", "daily_total", "transaction_count",
        "rolling_mean_7", "rolling_deviation_7", "day_of_week",
        "amount_baseline",
    )


@query("lag_features", f"""
WITH {B.SQL_ORDERS}, {B.SQL_FLOWS},
f AS (SELECT company_id, date, expenditure AS target,
  lag(expenditure, 1) OVER w AS lag_1, lag(expenditure, 7) OVER w AS lag_7, lag(expenditure, 14) OVER w AS lag_14,
  CAST(sum(CAST(expenditure AS DECIMAL(28,6))) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 7 AS rolling_mean_7,
  CAST(sum(CAST(expenditure AS DECIMAL(28,6))) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 14 AS rolling_mean_14,
  CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month
  FROM dense_flows WINDOW w AS (PARTITION BY company_id ORDER BY date))
SELECT * FROM f WHERE lag_14 IS NOT NULL
""")
def lag_features(spark, d):
    """Lags and full-window means of dense daily expenditure."""
    return series.lag_features(daily_series(spark, d), "expenditure")


def _messy(spark, d):
    """Orders as loosely typed text: six shapes of amounts and dates."""
    form = F.col("o_orderkey") % 6
    price, day = F.col("o_totalprice"), F.to_date("o_orderdate")
    epoch = F.unix_date(day).cast("bigint") * 86400
    text = price.cast("string")
    late = day >= F.lit("2001-09-10").cast("date")
    return B.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("entry_id"),
        F.when(form == 0, F.concat(F.lit("$"), F.format_number(price, 2)))
        .when(form == 1, F.concat(F.lit("-"), text))
        .when(form == 2, "").when(form == 4, F.concat(F.lit("  "), text, F.lit("\t")))
        .when(form == 5, "n/a").alias("amount"),
        F.when(form == 2, text).alias("total"),
        F.when(form == 3, (price + 10.0).cast("string")).alias("credit"),
        F.when(form == 3, "10").when(form == 5, F.lit("x")).alias("debit"),
        F.when(form == 0, day.cast("string"))
        .when(form == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(form == 2, epoch.cast("string"))
        .when((form == 3) & late, F.concat(epoch.cast("string"), F.lit("000")))
        .when(form == 3, F.concat(day.cast("string"), F.lit("T10:30:00+02:00")))
        .when(form == 4, F.concat(F.date_format(day, "yyyy/MM/dd"), F.lit(" 23:59:59")))
        .otherwise("soon").alias("transaction_date"),
        F.concat(day.cast("string"), F.lit("T08:00:00Z")).alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", "Accredited").when(F.col("o_orderstatus") == "O", "PURCHASE order").alias("type"),
        F.col("o_orderpriority").alias("entry_type"),
    )


_SQL_MESSY_AMOUNT = """CASE o_orderkey % 6 WHEN 1 THEN -o_totalprice WHEN 3 THEN (o_totalprice + 10.0) - 10.0
  WHEN 5 THEN NULL ELSE o_totalprice END"""
_SQL_MESSY_TS = """CASE o_orderkey % 6 WHEN 5 THEN NULL WHEN 4 THEN o_orderdate + INTERVAL 86399 SECOND
  WHEN 3 THEN CASE WHEN o_orderdate >= DATE '2001-09-10' THEN o_orderdate ELSE o_orderdate + INTERVAL 510 MINUTE END
  ELSE o_orderdate END"""


@query("parse_amounts", f"SELECT o_orderkey, {_SQL_MESSY_AMOUNT} AS amount FROM orders")
def parse_amounts(spark, d):
    """Signed amounts from text: marks, blanks, other fields, credit and debit."""
    messy = _messy(spark, d)
    return messy.select("o_orderkey", finance.signed_amount(Fields(messy)).alias("amount"))


@query("parse_dates", f"SELECT o_orderkey, CAST({_SQL_MESSY_TS} AS TIMESTAMP) AS instant FROM orders")
def parse_dates(spark, d):
    """Instants from dates, epochs and ISO text."""
    return _messy(spark, d).select(
        "o_orderkey", parse_instant(F.col("transaction_date")).cast("timestamp_ntz").alias("instant")
    )


@query("path_dates", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date FROM events
""")
def path_dates(spark, d):
    """Dates from file paths; an impossible month gives none."""
    good = F.date_format("ts", "'raw/'yyyy/MM/dd'/part.gz'")
    bad = F.date_format("ts", "'raw/'yyyy/'13'/dd'/part.gz'")
    path = F.when(F.col("event_id") % 3 == 0, bad).otherwise(good)
    return B.table(spark, d, "events").select("event_id", path_date(path).alias("date"))


@query("classify_flow", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'revenue' WHEN 'O' THEN 'expenditure'
  ELSE CASE WHEN o_orderkey % 2 = 1 THEN 'expenditure' ELSE 'revenue' END END AS flow FROM orders
""")
def classify_flow(spark, d):
    """Flow by hint words, else by sign."""
    hint = F.concat_ws(
        " ",
        F.when(F.col("o_orderstatus") == "F", "Credit memo, expense refund").when(F.col("o_orderstatus") == "O", "COST"),
        "o_orderpriority",
    )
    amount = F.when(F.col("o_orderkey") % 2 == 1, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return B.table(spark, d, "orders").select("o_orderkey", flow_of(hint, amount).alias("flow"))


@query("normalize_finance", f"""
SELECT CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS record_id,
  coalesce({_SQL_MESSY_TS}, o_orderdate + INTERVAL 8 HOUR) AS event_ts, CAST(o_orderdate AS DATE) AS date,
  abs(a) AS amount, a AS signed_amount,
  CASE o_orderstatus WHEN 'F' THEN 'revenue' WHEN 'O' THEN 'expenditure'
    ELSE CASE WHEN a >= 0 THEN 'revenue' ELSE 'expenditure' END END AS source_area,
  CASE o_orderstatus WHEN 'F' THEN 'Accredited' WHEN 'O' THEN 'PURCHASE order' ELSE o_orderpriority END AS category,
  'Unlabelled vendor' AS vendor, '' AS department
FROM (SELECT *, {_SQL_MESSY_AMOUNT} AS a FROM orders) WHERE a IS NOT NULL
""")
def normalize_finance(spark, d):
    """Typed finance rows from the loosely typed text."""
    rows = finance.normalize_finance(_messy(spark, d), keys=())
    return rows.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("tenant_slug", """
SELECT p_partkey,
  substr(trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(' ' || p_name || '__' || p_type || ' & Co. ' || p_brand || '- ')), '[ _]+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '-'), 1, 30) AS slug,
  CASE WHEN p_partkey % 2 = 0 THEN lower(replace(p_name, ' ', '_')) END AS tenant
FROM part
""")
def tenant_slugs(spark, d):
    """Slugs of company names, and validated tenant ids."""
    name = F.concat(F.lit(" "), "p_name", F.lit("__"), "p_type", F.lit(" & Co. "), "p_brand", F.lit("- "))
    given = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), F.upper(F.translate("p_name", " ", "_")))).otherwise(
        F.concat(F.lit("_"), "p_name")
    )
    return B.table(spark, d, "part").select("p_partkey", tenant_slug(name).alias("slug"), tenant_id(given).alias("tenant"))


@query("record_snapshot", """
SELECT o_orderkey, CASE WHEN c_custkey % 11 = 0
  THEN 'c_acctbal,c_custkey,c_name,c_nationkey,n_name,n_nationkey,n_regionkey,o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus'
  ELSE 'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey,n_name,n_nationkey,n_regionkey,o_custkey,o_orderdate,o_orderkey,o_orderpriority' END AS fields,
  CAST(o_custkey AS VARCHAR) AS customer
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def record_snapshot(spark, d):
    """The first twelve fields of a schemaless record."""
    joined = (
        B.table(spark, d, "orders")
        .join(B.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(B.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 > 0, F.col("c_mktsegment")))
        .withColumn("_source_key", F.lit("raw/part.gz"))
    )
    raw = F.try_variant_get(F.parse_json(F.to_json(F.struct(*joined.columns))), "$", "map<string,variant>")
    shot = joined.select("o_orderkey", snapshot(raw, 12).alias("s"))
    return shot.select(
        "o_orderkey", F.array_join(F.array_sort(F.map_keys("s")), ",").alias("fields"),
        F.try_variant_get(F.try_element_at("s", F.lit("o_custkey")), "$", "string").alias("customer"),
    )


@query("source_fallback", f"""
WITH {B.SQL_ORDERS}, pref AS (SELECT * FROM fin WHERE department = 'BUILDING' AND company_id NOT IN ('asia', 'europe'))
SELECT company_id, record_id, amount FROM pref
UNION ALL SELECT company_id, record_id, amount FROM fin WHERE company_id NOT IN (SELECT company_id FROM pref)
""")
def source_fallback(spark, d):
    """The dedicated input where a company has one, else the broader one."""
    rows = B.orders_finance(spark, d).select("company_id", "record_id", "amount", "department")
    own = rows.filter("department = 'BUILDING' AND company_id NOT IN ('asia', 'europe')")
    return finance.source_fallback(own, rows).drop("department")


@query("recent_finance", f"""
WITH r AS (SELECT replace(lower(r_name), ' ', '-') AS company_id, CAST(o_orderkey AS VARCHAR) AS transaction_id, o_orderdate AS transaction_date,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1 THEN -o_totalprice ELSE o_totalprice END AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'sale' WHEN 'O' THEN 'expense' END AS type, o_orderpriority AS category,
    CASE WHEN o_custkey % 3 > 0 THEN c_name END AS vendor, c_mktsegment AS department
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY transaction_date DESC NULLS LAST, transaction_id) <= 1000
""")
def recent_finance(spark, d):
    """The newest thousand rows per company on a discovered projection."""
    return finance.recent_rows(B.order_records(spark, d), tie="transaction_id")


@query("monthly_finance", f"""
WITH {B.SQL_ORDERS}, {B.SQL_FLOWS},
m AS (SELECT company_id, CAST(date_trunc('month', date) AS DATE) AS month, {_money('greatest(revenue, 0)')} AS revenue, {_money('greatest(expenditure, 0)')} AS expenditure
  FROM flows GROUP BY ALL),
k AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY month DESC) <= 6),
l AS (SELECT *, lag(expenditure) OVER (PARTITION BY company_id ORDER BY month) AS b FROM k)
SELECT company_id, month, revenue, expenditure, strftime(month, '%b') AS label, expenditure - coalesce(b, 0) AS spend_difference,
  CASE WHEN b > 0 THEN (expenditure - b) / b * 100 END AS spend_change_percent FROM l
""")
def monthly_finance(spark, d):
    """Last six months of revenue and spend with the change of spend."""
    return spend.monthly_finance(finance.daily_flows(B.orders_finance(spark, d)))


@query("weekly_activity", f"""
WITH {B.SQL_ORDERS}, c AS (SELECT company_id, date, count(*) AS value FROM fin GROUP BY ALL)
SELECT company_id, date, value, strftime(date, '%a') AS label FROM c
QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date DESC) <= 7
""")
def weekly_activity(spark, d):
    """Records on the last seven days with data."""
    return spend.weekly_activity(B.orders_finance(spark, d, "api"))


@query("spend_top", f"""
WITH {B.SQL_LINES}, t AS (SELECT company_id, vendor AS label, {_money('amount')} AS value FROM fin WHERE source_area = 'expenditure' GROUP BY ALL),
s AS (SELECT *, value / CAST(sum(CAST(value AS DECIMAL(28,6))) OVER (PARTITION BY company_id) AS DOUBLE) AS share,
  row_number() OVER (PARTITION BY company_id ORDER BY value DESC, label) AS rank FROM t)
SELECT company_id, label, value, share, CAST(rank AS INTEGER) AS rank FROM s WHERE rank <= 5
""")
def spend_top(spark, d):
    """Top five vendors by spend, with their share."""
    return spend.top_labels(B.lines_finance(spark, d), "vendor")


@query("recurring_spend", f"""
WITH {B.SQL_ORDERS}, v AS (SELECT company_id, vendor, {_money('amount')} AS value, count(*) AS n FROM fin WHERE source_area = 'expenditure' GROUP BY ALL)
SELECT company_id, {_money('CASE WHEN n > 1 THEN value END')} AS recurring_spend, {_money('CASE WHEN n = 1 THEN value END')} AS one_off_spend FROM v GROUP BY ALL
""")
def recurring_spend(spark, d):
    """Spend with repeated vendors against one-off spend."""
    return spend.recurring_spend(B.orders_finance(spark, d, "ui"))


@query("unusual_expenses", f"""
WITH {B.SQL_LINES}, e AS (SELECT * FROM fin WHERE source_area = 'expenditure'),
g AS (SELECT company_id, avg(amount) AS m, stddev_pop(amount) AS s FROM e GROUP BY ALL),
r AS (SELECT company_id, record_id, date, vendor, amount, row_number() OVER (PARTITION BY company_id ORDER BY amount DESC, record_id) AS rank
  FROM e JOIN g USING (company_id) WHERE amount > m + 1.8 * s AND amount > m * 1.35)
SELECT company_id, record_id, date, vendor, amount, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
""")
def unusual_expenses(spark, d):
    """The three largest unusual expenses per company."""
    return spend.unusual_expenses(B.lines_finance(spark, d))


@query("spend_window", f"""
WITH {B.SQL_ORDERS}, u AS (SELECT * REPLACE (CASE WHEN CAST(record_id AS BIGINT) % 50 > 0 THEN date END AS date) FROM fin),
s AS (SELECT company_id, date, {_money('amount')} AS value, count(*) AS n FROM u WHERE source_area = 'expenditure' GROUP BY ALL),
t AS (SELECT company_id, max(date) AS last, CAST(sum(n) AS BIGINT) AS transaction_count FROM s GROUP BY ALL),
p AS (SELECT company_id, transaction_count, last, back, CAST(CAST(coalesce(value, 0) AS DECIMAL(28,2)) AS DOUBLE) AS value
  FROM (SELECT *, last - CAST(back AS INTEGER) AS date FROM t, unnest(generate_series(0, 89)) AS g(back)) LEFT JOIN s USING (company_id, date)),
w AS (SELECT * FROM unnest([7, 30, 90]) AS x(window_days)),
f AS (SELECT company_id, window_days, last AS latest_date, transaction_count, {_money('CASE WHEN back < window_days THEN value END')} AS current_total,
  {_money('CASE WHEN back >= window_days AND back < 2 * window_days THEN value END')} AS previous_total,
  avg(CASE WHEN back < window_days THEN value END) AS m, stddev_pop(CASE WHEN back < window_days THEN value END) AS sd,
  max(CASE WHEN back < window_days THEN value END) AS peak FROM p, w GROUP BY ALL)
SELECT company_id, CAST(window_days AS INTEGER) AS window_days, latest_date, f.transaction_count, current_total, previous_total, current_total / window_days AS average, peak,
  (SELECT count(*) FROM p WHERE p.company_id = f.company_id AND back < window_days AND value > m + 1.6 * sd AND value > m * 1.25) AS spike_days FROM f
""")
def spend_window(spark, d):
    """Figures of the last 7, 30 and 90 days of spend; some expenses have no date."""
    rows = B.orders_finance(spark, d, "live").withColumn(
        "date", F.when(F.col("record_id").cast("bigint") % 50 > 0, F.col("date")))
    spent = spend.daily_spend(rows, undated=True)
    frames = [spend.spend_window(spent, n) for n in (7, 30, 90)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("late_data", f"""
WITH e AS (SELECT {B.sql_company('user_id')} AS company_id, CAST(ts AS DATE) AS date, value,
  CAST(ts + INTERVAL 1 HOUR * (user_id % 40) AS DATE) AS loaded FROM events)
SELECT company_id, date, {_money('value')} AS total, count(*) AS n, count(*) FILTER (loaded > date) AS late FROM e GROUP BY ALL
""")
def late_data(spark, d):
    """Daily totals by business date, whenever a row was loaded."""
    events = B.table(spark, d, "events").select(
        B.company_of(F.col("user_id")).alias("company_id"), F.to_date("ts").alias("date"), "value",
        F.to_date(B.at_utc("ts") + F.make_dt_interval(hours=(F.col("user_id") % 40).cast("int"))).alias("loaded"),
    )
    return finance.totals_with_lateness(events, "value", "loaded")


@query("iforest_gate", f"""
WITH {B.SQL_ORDERS}, {B.SQL_DAILY},
a AS (SELECT company_id, source_area, CAST(sum(transaction_count) AS BIGINT) AS transactions, count(*) AS days FROM daily GROUP BY ALL),
m AS (SELECT *, CASE WHEN sum(transactions) OVER c >= 20 THEN 'transaction' WHEN sum(days) OVER c >= 14 THEN 'daily' END AS mode FROM a WINDOW c AS (PARTITION BY company_id)),
r AS (SELECT *, CASE WHEN mode = 'transaction' THEN transactions ELSE days END AS area_rows, CASE WHEN mode = 'transaction' THEN 20 ELSE 14 END AS least FROM m),
k AS (SELECT *, CASE WHEN mode IS NULL THEN NULL WHEN area_rows >= least THEN source_area
  WHEN NOT bool_or(area_rows >= least) OVER (PARTITION BY company_id) THEN 'pooled' END AS model_key FROM r)
SELECT company_id, source_area, transactions, days, mode, area_rows, model_key,
  CAST(sum(area_rows) OVER (PARTITION BY company_id, model_key) AS BIGINT) AS model_rows,
  CASE WHEN mode IS NULL THEN 'insufficient_data' ELSE 'modelled' END AS status FROM k
""")
def iforest_gate(spark, d):
    """Which rows each company models, and with which model."""
    return anomaly.model_gate(finance.daily_totals(B.orders_finance(spark, d)))


@query("iforest")
def iforest(spark, d):
    """Isolation scores of every transaction."""
    return anomaly.isolation_scores(B.orders_finance(spark, d)).select(
        "company_id", "mode", "model_key", "source_area", "date", "record_id", "amount", "copies",
        "raw_score", "anomaly_score", "anomaly_flag",
    )


@query("anomaly_rows")
def anomaly_rows(spark, d):
    """Anomaly rows of the highest scores, with reasons and metrics."""
    scored = anomaly.isolation_scores(B.orders_finance(spark, d))
    return anomaly.anomaly_rows(scored, B.AS_OF)


@query("iforest_summary", f"""
WITH {B.SQL_ORDERS} SELECT company_id, source_area AS model_key, count(*) AS rows_modeled,
  count(*) - 1 - CAST(floor((count(*) - 1) * 0.92::DOUBLE) AS BIGINT) AS flagged, 0.0 AS lowest, 1.0 AS highest
FROM fin GROUP BY ALL HAVING count(*) >= 20
""")
def iforest_summary(spark, d):
    """Rows, flags and score range of every model: eight percent are flagged."""
    scored = anomaly.isolation_scores(B.orders_finance(spark, d))
    return scored.groupBy("company_id", "model_key").agg(
        F.sum("copies").alias("rows_modeled"),
        F.sum(F.when(F.col("anomaly_flag"), F.col("copies")).otherwise(0)).alias("flagged"),
        F.min("anomaly_score").alias("lowest"),
        F.max("anomaly_score").alias("highest"),
    )


@query("anomaly_run", f"""
WITH {B.SQL_ORDERS}, m AS (SELECT company_id, source_area, count(*) AS n FROM fin GROUP BY ALL),
k AS (SELECT * FROM m WHERE n >= 20)
SELECT company_id, (SELECT CAST(sum(n) AS BIGINT) FROM m WHERE m.company_id = k.company_id) AS rows_processed, CAST(sum(n) AS BIGINT) AS rows_modeled,
  count(*) AS scored_groups, CAST(sum(n - 1 - CAST(floor((n - 1) * 0.92::DOUBLE) AS BIGINT)) AS BIGINT) AS flagged, 'transaction' AS mode, 'ok' AS status
FROM k GROUP BY ALL
""")
def anomaly_run(spark, d):
    """Summary of a company's anomaly run."""
    rows = B.orders_finance(spark, d)
    read = rows.groupBy("company_id").agg(F.count("*").alias("rows_processed"))
    return documents.anomaly_run_summary(anomaly.isolation_scores(rows), read)
