"""The test tables in the shapes the operators take, and the same shapes in SQL.

Each shape is a Spark function and a SQL common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.finance import normalize_finance
from ..operators.forecast import metric_series
from ..operators.workforce import employee_events, headcount

COMPANIES = ["africa", "america", "asia", "europe", "middle-east"]
AS_OF = "2024-01-31T00:00:00Z"
SQL_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
_SQL_COMPANIES = "['africa', 'america', 'asia', 'europe', 'middle-east']"


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def company_of(number) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in COMPANIES]), (F.pmod(number, F.lit(5)) + 1).cast("int"))


def sql_company(number: str) -> str:
    return f"{_SQL_COMPANIES}[CAST(({number}) % 5 AS INTEGER) + 1]"


def at_utc(column: str) -> F.Column:
    """The tables hold times without a zone; they mean UTC."""
    return F.col(column).cast("timestamp")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.translate(F.lower("r_name"), " ", "-").alias("company_id")
    )


# --- orders as transactions -----------------------------------------------------
def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    price = F.col("o_totalprice")
    negative = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 1)
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "company_id",
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            F.col("o_orderdate").alias("transaction_date"),
            F.when(negative, -price).otherwise(price).alias("amount"),
            F.when(F.col("o_orderstatus") == "F", "sale")
            .when(F.col("o_orderstatus") == "O", "expense")
            .alias("type"),
            F.col("o_orderpriority").alias("category"),
            F.col("c_mktsegment").alias("department"),
            F.when(F.col("o_custkey") % 3 > 0, F.col("c_name")).alias("vendor"),
        )
    )


def orders_finance(spark: SparkSession, sf_dir: str, profile: str = "job") -> DataFrame:
    return normalize_finance(order_records(spark, sf_dir), profile)


SQL_ORDERS = """
fin AS (
  SELECT company_id, record_id, date, abs(signed_amount) AS amount, signed_amount, category,
         department, vendor,
         CASE WHEN status = 'F' THEN 'revenue' WHEN status = 'O' THEN 'expenditure'
              WHEN signed_amount >= 0 THEN 'revenue' ELSE 'expenditure' END AS source_area
  FROM (
    SELECT replace(lower(r_name), ' ', '-') AS company_id,
           CAST(o_orderkey AS VARCHAR) AS record_id, CAST(o_orderdate AS DATE) AS date,
           CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1
                THEN -o_totalprice ELSE o_totalprice END AS signed_amount,
           o_orderstatus AS status, o_orderpriority AS category, c_mktsegment AS department,
           CASE WHEN o_custkey % 3 > 0 THEN c_name ELSE 'Unlabelled vendor' END AS vendor
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey))
"""


# --- line items as transactions ---------------------------------------------------
def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    item, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        item.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(_regions(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "company_id",
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id"),
            F.col("l_shipdate").alias("transaction_date"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
            F.when(F.col("l_returnflag") == "R", "refund received")
            .when(F.col("l_returnflag") == "A", "payment")
            .alias("type"),
            F.col("p_type").alias("category"),
            F.col("s_name").alias("vendor"),
        )
    )


def lines_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_finance(line_records(spark, sf_dir))


SQL_LINES = """
fin AS (
  SELECT replace(lower(r_name), ' ', '-') AS company_id,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS record_id,
         CAST(l_shipdate AS DATE) AS date, l_extendedprice * (1 - l_discount) AS amount,
         p_type AS category, s_name AS vendor,
         CASE WHEN l_returnflag = 'A' THEN 'expenditure' ELSE 'revenue' END AS source_area
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""

SQL_DAILY = """
daily AS (
  SELECT company_id, source_area, date,
         CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS daily_total,
         count(*) AS transaction_count
  FROM fin GROUP BY ALL)
"""
SQL_ROLLING = """
framed AS (
  SELECT *, CASE WHEN count(*) OVER w >= 3
            THEN CAST(sum(CAST(daily_total AS DECIMAL(28,6))) OVER w AS DOUBLE) / count(*) OVER w END AS m
  FROM daily
  WINDOW w AS (PARTITION BY company_id, source_area ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
rolled AS (
  SELECT company_id, source_area, date, daily_total, transaction_count,
         coalesce(m, daily_total) AS rolling_mean_7,
         coalesce(abs(daily_total - m), 0.0) AS rolling_deviation_7,
         CAST(isodow(date) - 1 AS INTEGER) AS day_of_week
  FROM framed)
"""
SQL_FLOWS = """
flows AS (
  SELECT company_id, date,
         CAST(coalesce(sum(CASE WHEN source_area = 'revenue' THEN CAST(amount AS DECIMAL(28,6)) END), 0) AS DOUBLE) AS revenue,
         CAST(coalesce(sum(CASE WHEN source_area = 'expenditure' THEN CAST(amount AS DECIMAL(28,6)) END), 0) AS DOUBLE) AS expenditure
  FROM fin GROUP BY ALL),
flow_days AS (
  SELECT company_id, CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM flows GROUP BY company_id),
dense_flows AS (
  SELECT company_id, date, coalesce(revenue, 0.0) AS revenue, coalesce(expenditure, 0.0) AS expenditure
  FROM flow_days LEFT JOIN flows USING (company_id, date))
"""


# --- events as employees ----------------------------------------------------------
def employee_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        company_of(F.col("user_id")).alias("company_id"),
        F.col("user_id").cast("string").alias("employee_id"),
        at_utc("ts").alias("event_time"),
        F.when(kind == "signup", "active")
        .when(kind == "error", "terminated")
        .when(kind == "click", "inactive")
        .when(kind == "purchase", "employed")
        .alias("status"),
        F.col("event_id").alias("seq"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_events(employee_records(spark, sf_dir), seq="seq")


SQL_EMPLOYEES = f"""
emp AS (
  SELECT {sql_company('user_id')} AS company_id, CAST(user_id AS VARCHAR) AS employee_id, ts,
         CAST(ts AS DATE) AS date, event_id AS seq,
         CASE WHEN event_type IN ('signup', 'purchase') THEN TRUE
              WHEN event_type IN ('error', 'click') THEN FALSE END AS is_active
  FROM events)
"""
SQL_HEADCOUNT = """
emp_order AS (
  SELECT *, coalesce(is_active, TRUE) AS here,
         row_number() OVER (PARTITION BY company_id ORDER BY ts, seq) AS n
  FROM emp),
emp_steps AS (
  SELECT company_id, date, n,
         CAST(here AS INTEGER) - CAST(coalesce(lag(here) OVER (PARTITION BY company_id, employee_id ORDER BY n), FALSE) AS INTEGER) AS step
  FROM emp_order),
emp_counts AS (
  SELECT company_id, date, n, sum(step) OVER (PARTITION BY company_id ORDER BY n) AS c FROM emp_steps),
emp_days AS (SELECT company_id, date, CAST(arg_max(c, n) AS DOUBLE) AS headcount FROM emp_counts GROUP BY ALL),
emp_spine AS (
  SELECT company_id, CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM emp_days GROUP BY company_id),
heads AS (
  SELECT company_id, date,
         last_value(headcount IGNORE NULLS) OVER (PARTITION BY company_id ORDER BY date) AS headcount
  FROM emp_spine LEFT JOIN emp_days USING (company_id, date))
"""


# --- history and a plain forecast of all metrics -----------------------------------
def all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_series(orders_finance(spark, sf_dir), headcount(employees(spark, sf_dir)))


SQL_SERIES = """
series AS (
  SELECT company_id, 'revenue' AS metric, date, revenue AS value FROM dense_flows
  UNION ALL SELECT company_id, 'expenditure', date, expenditure FROM dense_flows
  UNION ALL SELECT company_id, 'employee_headcount', date, headcount FROM heads)
"""


def repeat_ahead(series: DataFrame, days: int = 60) -> DataFrame:
    """A forecast that repeats a series' last 28 days: a stand-in SQL can produce, used
    where an operator takes any forecast.  The band widens with the step."""
    ids = ["company_id", "metric"]
    back = F.row_number().over(W.partitionBy(*ids).orderBy(F.desc("date")))
    last = F.max("date").over(W.partitionBy(*ids))
    tail = series.withColumn("_b", back).withColumn("_last", last).filter("_b <= 28")
    step = F.explode(F.sequence(F.lit(1), F.lit(days)))
    value = F.col("value")
    return (
        tail.withColumn("step", step)
        .filter((F.col("step") - 1) % 28 == 28 - F.col("_b"))
        .select(
            *ids,
            F.date_add("_last", F.col("step")).alias("date"),
            "step",
            value.alias("predicted_value"),
            (value * 0.9).alias("lower_bound"),
            (value * 1.1 + F.col("step")).alias("upper_bound"),
        )
    )


SQL_AHEAD = """
tails AS (
  SELECT *, row_number() OVER (PARTITION BY company_id, metric ORDER BY date DESC) AS b,
         max(date) OVER (PARTITION BY company_id, metric) AS last_date
  FROM series),
ahead AS (
  SELECT company_id, metric, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS date, step,
         value AS predicted_value, value * 0.9::DOUBLE AS lower_bound,
         value * 1.1::DOUBLE + step AS upper_bound
  FROM tails, unnest(generate_series(1, 60)) AS s(step)
  WHERE b <= 28 AND (step - 1) % 28 = 28 - b)
"""
SQL_ALL_SERIES = ",".join([SQL_ORDERS, SQL_FLOWS, SQL_EMPLOYEES, SQL_HEADCOUNT, SQL_SERIES])


# --- events as anomaly items, conversations as reviews ------------------------------
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        company_of(F.col("event_id")).alias("company_id"),
        F.col("event_id").cast("string").alias("anomaly_id"),
        F.when(F.col("user_id") % 4 > 0, F.concat_ws("_", F.lit("type"), "event_type")).alias("anomaly_type"),
        F.when(F.col("event_type") == "view", "daily_finance")
        .when(F.col("event_type") == "click", "transaction")
        .otherwise("").alias("entity_type"),
        F.when(value >= 15, "high").when(value >= 5, "medium").when(value >= 2, "low").alias("severity"),
        F.when(F.col("user_id") % 3 == 0, "new").otherwise("").alias("status"),
        F.when(F.col("event_id") % 50 > 0, at_utc("ts")).alias("detected_at"),
    )


def review_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ["mark_reviewed", "Mark-as-confirmed", "quarantine", "drop", "mark as false positive"]
    turn = F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        company_of(F.col("conv_id")).alias("company_id"),
        F.col("conv_id").cast("string").alias("anomaly_id"),
        F.element_at(F.array(*[F.lit(w) for w in words]), (turn % 5 + 1).cast("int")).alias("action"),
        F.when(turn % 7 == 3, "Resolved").otherwise("").alias("status"),
        F.col("role").alias("actor"),
        F.when(turn % 2 == 0, F.col("text")).otherwise(" ").alias("note"),
        F.timestamp_seconds(F.lit(1704067200) + turn * 3600).alias("at"),
        turn.alias("seq"),
    )


SQL_ITEMS = f"""
items AS (
  SELECT {sql_company('event_id')} AS company_id, CAST(event_id AS VARCHAR) AS anomaly_id,
         CASE WHEN user_id % 4 > 0 THEN 'type_' || event_type ELSE 'unknown' END AS anomaly_type,
         CASE event_type WHEN 'view' THEN 'daily_finance' WHEN 'click' THEN 'transaction' ELSE 'unknown' END AS entity_type,
         CASE WHEN value >= 15 THEN 'high' WHEN value >= 5 THEN 'medium' ELSE 'low' END AS severity,
         'new' AS status, CASE WHEN event_id % 50 > 0 THEN ts END AS detected_at
  FROM events)
"""
SQL_REVIEWS = f"""
acts AS (
  SELECT {sql_company('conv_id')} AS company_id, CAST(conv_id AS VARCHAR) AS anomaly_id, turn, role AS actor,
         ['mark_reviewed', 'mark_confirmed', 'quarantine_record', 'soft_drop_record', 'mark_false_positive'][CAST(turn % 5 AS INTEGER) + 1] AS action,
         CASE WHEN turn % 7 = 3 THEN 'resolved'
              ELSE ['reviewed', 'confirmed', 'investigating', 'investigating', 'false_positive'][CAST(turn % 5 AS INTEGER) + 1] END AS status,
         CASE WHEN turn % 2 = 0 AND trim(text) <> '' THEN text END AS note
  FROM conversations),
reviews AS (
  SELECT company_id, anomaly_id, arg_max(status, turn) AS status, arg_max(action, turn) AS last_action,
         max(turn) AS last_turn, arg_max(actor, turn) AS updated_by, count(*) AS audit_count,
         count(note) AS notes_count, string_agg(action || ':' || status, '>' ORDER BY turn) AS trail
  FROM acts GROUP BY ALL)
"""

# --- events as telemetry ------------------------------------------------------------
SERVICES = (
    # signal, kind, name, label, timeout_ms, required
    ("cdc_public", "cdc", "public-task", "Public schema CDC task", 0, True),
    ("cdc_finance", "cdc", "finance-task", "Finance CDC task", 0, True),
    ("stream", "stream", "ingest", "Stream", 0, True),
    ("delivery", "delivery", "landing", "Delivery", 0, True),
    ("transform", "function", "clean", "Transform Lambda", 300000, True),
    ("ml", "function", "predict", "ML Lambda", 900000, True),
    ("anomaly", "function", "detect", "Anomaly Lambda", 900000, True),
    ("live_api", "function", "serve", "Live API Lambda", 30000, False),
)
_SERVICE_SCHEMA = (
    "signal string, kind string, name string, label string, timeout_ms int, required boolean"
)
METRICS = {
    "cdc": (("CDCLatencySource", 20.0), ("CDCLatencyTarget", 40.0)),
    "stream": (("GetRecords.IteratorAgeMilliseconds", 9000.0), ("WriteProvisionedThroughputExceeded", 0.5), ("IncomingRecords", 10.0)),
    "delivery": (("DeliveryToS3.DataFreshness", 60.0), ("DeliveryToS3.Success", 1.0)),
    "function": (("Invocations", 4.0), ("Errors", 0.3), ("Duration", 20000.0), ("Throttles", 0.1)),
}


def services(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SERVICES), _SERVICE_SCHEMA)


def _metric_map(spark: SparkSession) -> DataFrame:
    rows = [
        (n, slot, name, metric, scale)
        for n, (_, kind, name, *_rest) in enumerate(SERVICES)
        for slot, (metric, scale) in enumerate(METRICS[kind])
    ]
    return spark.createDataFrame(rows, "place int, slot int, resource string, metric string, scale double")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a datapoint of one service (by event) and metric (by user)."""
    events = table(spark, sf_dir, "events").select(
        (F.col("event_id") % 8).cast("int").alias("place"),
        (F.col("user_id") % 4).cast("int").alias("slot"),
        at_utc("ts").alias("ts"), "value",
    )
    return events.join(F.broadcast(_metric_map(spark)), ["place", "slot"]).select(
        "resource", "metric", F.lit("stat").alias("stat"), "ts",
        (F.col("value") * F.col("scale")).alias("value"),
    )


def _sql_values(rows) -> str:
    def literal(x):
        if isinstance(x, bool):
            return str(x).upper()
        return f"'{x}'" if isinstance(x, str) else f"{x!r}::DOUBLE" if isinstance(x, float) else str(x)

    return ", ".join("(" + ", ".join(literal(x) for x in row) + ")" for row in rows)


SQL_TELEMETRY = f"""
services(signal, kind, name, label, timeout_ms, required) AS (VALUES {_sql_values(SERVICES)}),
metric_map(place, slot, resource, metric, scale) AS (VALUES {_sql_values(
    (n, slot, name, metric, scale)
    for n, (_, kind, name, *_r) in enumerate(SERVICES)
    for slot, (metric, scale) in enumerate(METRICS[kind]))}),
telemetry AS (
  SELECT resource, metric, 'stat' AS stat, ts, value * scale AS value
  FROM events JOIN metric_map ON place = event_id % 8 AND slot = user_id % 4),
newest AS (
  SELECT resource, metric, stat, max(ts) AS ts, arg_max(value, (ts, value)) AS value
  FROM telemetry WHERE ts >= {SQL_AS_OF} - INTERVAL 180 MINUTE AND ts <= {SQL_AS_OF}
  GROUP BY resource, metric, stat)
"""


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.concat(F.lit("ERROR   failed:\n"), "props"))
        .when(kind == "view", F.concat(F.lit("Warning slow page "), "props"))
        .when(kind == "click", F.concat(F.lit("Exception in handler "), F.repeat("props", 30)))
        .otherwise(F.concat(F.upper(kind), F.lit(" "), "props"))
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("service-"), F.col("user_id") % 6).alias("service"), at_utc("ts").alias("ts"),
        text.alias("message"),
    )


SQL_LOGS = """
logs AS (
  SELECT 'service-' || (user_id % 6) AS service, ts,
         CASE event_type WHEN 'error' THEN 'ERROR failed: ' || props
              WHEN 'view' THEN 'Warning slow page ' || props
              WHEN 'click' THEN left('Exception in handler ' || repeat(props, 30), 217) || '...' END AS message
  FROM events WHERE event_type IN ('error', 'view', 'click'))
"""
# The click text is always longer than 220 characters once repeated thirty times.


def alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = [
        "kinesis-iterator", "firehose-freshness", "transform-errors", "ml-forecast", "anomaly-duration",
        "live-api-latency", "finance-task-failed", "pipeline-health", "disk",
    ]
    word = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("user_id") % 9 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.lit("app"), word, "event_id").alias("name"),
        F.when(F.col("event_type") == "error", "ALARM").otherwise("OK").alias("state"),
        F.when(F.col("event_id") % 2 == 0, "Something is off").otherwise("").alias("description"),
        F.lit(None).cast("string").alias("reason"),
        at_utc("ts").alias("updated_at"),
    )


ALARM_NAMES = {"stream": "ingest", "delivery": "landing", "transform": "clean", "ml": "predict", "anomaly": "detect", "live_api": "serve"}
TASK_IDS = {"public": "public-task", "finance": "finance-task"}
SQL_ALARMS = """
words(w, word, pipelines, severity, resource) AS (VALUES
  (0, 'kinesis-iterator', ['employee-pipeline', 'finance-pipeline'], 'medium', 'kinesis:ingest'),
  (1, 'firehose-freshness', ['employee-pipeline', 'finance-pipeline'], 'medium', 'firehose:landing'),
  (2, 'transform-errors', ['employee-pipeline', 'finance-pipeline'], 'high', 'lambda:clean'),
  (3, 'ml-forecast', ['forecast-pipeline'], 'medium', 'lambda:predict'),
  (4, 'anomaly-duration', ['anomaly-pipeline'], 'critical', 'lambda:detect'),
  (5, 'live-api-latency', ['forecast-pipeline', 'anomaly-pipeline'], 'high', 'lambda:serve'),
  (6, 'finance-task-failed', ['finance-pipeline'], 'high', 'dms:finance-task'),
  (7, 'pipeline-health', [NULL], 'critical', NULL), (8, 'disk', [NULL], 'medium', NULL)),
alarms AS (
  SELECT 'app-' || word || '-' || event_id AS name, unnest(pipelines) AS pipeline_id, severity,
         coalesce(resource, 'cloudwatch:app-' || word || '-' || event_id) AS resource, ts AS triggered_at,
         CASE WHEN event_id % 2 = 0 THEN 'Something is off'
              ELSE 'app-' || word || '-' || event_id || ' is in ALARM' END AS summary
  FROM events JOIN words ON w = user_id % 9 WHERE event_type = 'error')
"""


def tasks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("public-task", "Running", ""), ("finance-task", "failed", "Target apply is behind.")],
        "task_id string, status string, stop_reason string",
    )


DATASETS = {"signup": "employees", "purchase": "finance", "view": "predictions", "click": "anomalies"}


def dataset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [F.lit(x) for pair in DATASETS.items() for x in pair]
    return table(spark, sf_dir, "events").select(
        F.try_element_at(F.create_map(*pairs), F.col("event_type")).alias("dataset"),
        at_utc("ts").alias("mtime"),
    ).filter("dataset IS NOT NULL")


def targets(spark: SparkSession) -> DataFrame:
    from ..constants import FRESHNESS_TARGETS

    return spark.createDataFrame(list(FRESHNESS_TARGETS.items()), "dataset string, target_minutes int")


ROUTES = tuple(
    (f"service-{n}", pipeline)
    for n, pipelines in enumerate(
        (("employee-pipeline",), ("finance-pipeline",), ("employee-pipeline", "finance-pipeline"),
         ("forecast-pipeline",), ("anomaly-pipeline",), ("forecast-pipeline", "anomaly-pipeline"))
    )
    for pipeline in pipelines
)


def routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ROUTES), "service string, pipeline_id string")


SQL_ROUTES = f"routes(service, pipeline_id) AS (VALUES {_sql_values(ROUTES)})"
SQL_FRESHNESS = f"""
targets(dataset, target_minutes) AS (VALUES ('employees', 15), ('finance', 15), ('predictions', 90), ('anomalies', 180)),
fresh AS (
  SELECT dataset, target_minutes, last_success_at, lag,
         CASE WHEN lag IS NULL THEN 'down' WHEN lag <= target_minutes THEN 'healthy'
              WHEN lag <= 2 * target_minutes THEN 'warning' WHEN lag <= 4 * target_minutes THEN 'degraded'
              ELSE 'down' END AS status
  FROM (
    SELECT t.dataset, target_minutes, max(ts) AS last_success_at,
           (epoch_us({SQL_AS_OF}) - epoch_us(max(ts))) / 60e6 AS lag
    FROM targets t LEFT JOIN (
      SELECT ts, CASE event_type WHEN 'signup' THEN 'employees' WHEN 'purchase' THEN 'finance'
                      WHEN 'view' THEN 'predictions' WHEN 'click' THEN 'anomalies' END AS dataset
      FROM events) e ON e.dataset = t.dataset
    GROUP BY ALL))
"""
