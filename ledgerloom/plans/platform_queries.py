"""Queries on change records, files, reviews, tenants and pipeline health."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alarms, anomaly, cdc, documents, health, reviews, tenant
from ..sources import files, sinks
from . import bindings as B
from .registry import query


# --- change records ---------------------------------------------------------------
def change_lines(spark, d):
    """Events as raw lines: envelopes, plain rows, internal tables, copies, broken lines."""
    event = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    note = F.when(F.col("event_id") % 7 == 0, "").otherwise(F.concat(F.lit("n"), "event_id"))

    def envelope(schema: str, name: str, *fields):
        return F.concat(
            F.lit(f'{{"metadata":{{"schema-name":"{schema}","table-name":"{name}"}},"data":{{'), *fields, F.lit("}}")
        )

    def field(name: str, value, quoted: bool = False):
        mark = '"' if quoted else ""
        return F.concat(F.lit(f'"{name}":{mark}'), value, F.lit(mark))

    comma = F.lit(",")
    line = (
        F.when(event == "purchase", envelope(
            "Finance", "TRANSACTIONS", field("transaction_id", F.col("event_id")), comma,
            field("amount", F.col("value")), comma, field("note", note, True), comma,
            field("timestamp", F.unix_seconds(B.at_utc("ts"))), comma, field("gone", F.lit("null"))))
        .when(event == "signup", envelope(
            "public", "employees", field("id", F.col("event_id")), comma, field("updated_at", iso, True)))
        .when(event == "view", F.concat(
            F.lit("{"), field("id", F.col("event_id")), comma, field("date", F.lit("today"), True), F.lit("}")))
        .when(event == "click", envelope("finance", "audit", field("id", F.col("event_id"))))
        .otherwise(envelope("public", "awsdms_status", field("id", F.col("event_id"))))
    )
    path = F.concat(F.lit("/raw/"), F.date_format("ts", "yyyy/MM/dd"), F.lit("/part-"), F.date_format("ts", "HH"), F.lit(".gz"))
    lines = B.table(spark, d, "events").select(
        B.company_of(F.col("user_id")).alias("company_id"), path.alias("source_file"), "event_id", line.alias("line")
    )
    copies = lines.filter("event_id % 10 = 0")
    broken = lines.filter("event_id % 97 = 0").withColumn("line", F.expr("left(line, length(line) - 3)"))
    return lines.unionByName(copies).unionByName(broken).drop("event_id")


@query("cdc_clean", f"""
SELECT {B.sql_company('user_id')} AS company_id, '/raw/' || strftime(ts, '%Y/%m/%d/part-%H.gz') AS source_file,
  CASE event_type WHEN 'purchase' THEN 'finance' ELSE 'employees' END AS domain,
  CASE event_type WHEN 'purchase' THEN 'transactions' ELSE 'employees' END AS "table",
  CAST(event_id AS VARCHAR) AS record_id, CASE event_type WHEN 'purchase' THEN value END AS amount,
  CASE event_type WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE 'today' END AS stamp,
  CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 7 = 0 THEN 3 ELSE 4 END ELSE 2 END AS n_fields
FROM events WHERE event_type IN ('purchase', 'signup', 'view')
""")
def cdc_clean(spark, d):
    """Trusted records from raw change lines."""

    def text(name: str):
        return F.get_json_object("record", f"$.{name}")

    return cdc.clean_lines(change_lines(spark, d)).select(
        "company_id", "source_file", "domain", "table",
        F.coalesce(text("transaction_id"), text("id")).alias("record_id"),
        text("amount").cast("double").alias("amount"),
        F.coalesce(text("timestamp"), text("updated_at"), text("date")).alias("stamp"),
        F.size(F.json_object_keys("record")).alias("n_fields"),
    )


@query("cdc_rejects", f"""
WITH e AS (SELECT *, {B.sql_company('user_id')} AS company_id FROM events),
r AS (
  SELECT company_id, 'unrouted_table' AS reject FROM e WHERE event_type IN ('click', 'error')
  UNION ALL SELECT company_id, 'unrouted_table' FROM e WHERE event_type IN ('click', 'error') AND event_id % 10 = 0
  UNION ALL SELECT company_id, 'malformed_json' FROM e WHERE event_id % 97 = 0)
SELECT company_id, reject, count(*) AS n FROM r GROUP BY ALL
""")
def cdc_rejects(spark, d):
    """Rejected lines by reason."""
    return cdc.rejected_lines(change_lines(spark, d)).groupBy("company_id", "reject").agg(F.count("*").alias("n"))


@query("cdc_selection", """
SELECT event_id, s AS schema_name, t AS table_name FROM (
  SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'public' ELSE 'finance' END AS s,
    ['employees', 'awsdms_status', 'awsdms_history', 'transactions', 'accounts', 'awsdms_x'][CAST(event_id % 6 AS INTEGER) + 1] AS t FROM events)
WHERE (s = 'public' AND t NOT IN ('awsdms_status', 'awsdms_history')) OR (s = 'finance' AND t IN ('transactions', 'accounts'))
""")
def cdc_selection(spark, d):
    """Changes the capture rules let through."""
    names = ["employees", "awsdms_status", "awsdms_history", "transactions", "accounts", "awsdms_x"]
    changes = B.table(spark, d, "events").select(
        "event_id", F.when(F.col("user_id") % 2 == 0, "public").otherwise("finance").alias("schema_name"),
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 6 + 1).cast("int")).alias("table_name"),
    )
    return cdc.select_captured(changes)


@query("content_dedupe", "SELECT DISTINCT source, lang, md5(text) AS row_hash FROM documents")
def content_dedupe(spark, d):
    """Distinct contents of each source and language."""
    hashed = B.table(spark, d, "documents").select("source", "lang", F.md5("text").alias("row_hash"))
    return cdc.drop_copies(hashed, ["source", "lang"])


# --- files -------------------------------------------------------------------------
def _filed(spark, d):
    """Events with the file they would have landed in; a file's time is its last event's."""
    path = F.concat(F.lit("raw/"), F.date_format("ts", "yyyy/MM/dd"), F.lit("/part.gz"))
    return B.table(spark, d, "events").select(
        B.company_of(F.col("user_id")).alias("company_id"), "event_id", "event_type", "value",
        path.alias("source_file"), B.at_utc("ts").alias("source_modified"),
    )


_SQL_FILED = f"""
filed AS (SELECT {B.sql_company('user_id')} AS company_id, event_id, event_type, value, strftime(ts, 'raw/%Y/%m/%d/part.gz') AS source_file, ts FROM events),
listing AS (SELECT company_id, source_file, max(ts) AS m FROM filed GROUP BY ALL)"""


@query("bounded_files", f"""
WITH {_SQL_FILED}, c AS (SELECT company_id, source_file FROM listing QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY source_file) <= 5)
SELECT company_id, event_id, source_file FROM filed JOIN c USING (company_id, source_file)
""")
def bounded_files(spark, d):
    """Rows of each company's first five files by path."""
    return files.bounded_files(_filed(spark, d), 5, ["company_id"]).select("company_id", "event_id", "source_file")


@query("latest_batch", f"""
WITH {_SQL_FILED}, c AS (SELECT company_id, source_file FROM listing QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY m DESC, source_file) <= 1)
SELECT company_id, event_id, source_file FROM filed JOIN c USING (company_id, source_file)
QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY event_id DESC) <= 20
""")
def latest_batch(spark, d):
    """The last twenty rows of each company's newest file."""
    newest = files.latest_batch(_filed(spark, d), ["company_id"], 20, [F.desc("event_id")])
    return newest.select("company_id", "event_id", "source_file")


@query("run_diagnostics", f"""
WITH {_SQL_FILED} SELECT company_id, event_type AS dataset, count(*) AS rows_processed, count(DISTINCT source_file) AS input_files FROM filed GROUP BY ALL
""")
def run_diagnostics(spark, d):
    """Rows and files read per dataset."""
    return documents.run_diagnostics(_filed(spark, d).withColumnRenamed("event_type", "dataset"))


@query("run_files", f"""
WITH {_SQL_FILED} SELECT company_id, event_type AS dataset, source_file, count(*) AS rows_read FROM filed GROUP BY ALL
""")
def run_files(spark, d):
    """The files a run read."""
    return documents.run_files(_filed(spark, d).withColumnRenamed("event_type", "dataset"))


@query("latest_run", f"""
WITH r AS (SELECT {B._SQL_COMPANIES}[CAST(conv_id % 4 AS INTEGER) + 1] AS company_id, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * turn + INTERVAL 1 MINUTE * conv_id AS generated_at, conv_id, turn FROM conversations),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY generated_at DESC, conv_id DESC) = 1),
c AS (SELECT unnest({B._SQL_COMPANIES}) AS company_id)
SELECT company_id, generated_at, CASE WHEN conv_id IS NULL THEN 'no_prediction' WHEN conv_id % 4 = 1 THEN 'invalid_prediction' ELSE 'found' END AS state,
  CASE WHEN conv_id IS NULL THEN 'no_prediction' WHEN conv_id % 4 = 1 THEN 'invalid_prediction' WHEN conv_id % 4 = 2 THEN 'unknown' ELSE 'ok' END AS status
FROM c LEFT JOIN l USING (company_id)
""")
def latest_run(spark, d):
    """The newest run document of each company, found, invalid or missing."""
    conv = F.col("conv_id")
    document = (
        F.when(conv % 4 == 1, F.concat(F.lit("not a document "), "text"))
        .when(conv % 4 == 2, F.concat(F.lit('{"schema_version":"2.0","generated_at":"'), conv, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"schema_version":"2.0","status":"ok","generated_at":"'), conv, F.lit('"}')))
    )
    runs = B.table(spark, d, "conversations").select(
        F.element_at(F.array(*[F.lit(c) for c in B.COMPANIES]), (conv % 4 + 1).cast("int")).alias("company_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 3600 + conv * 60).alias("generated_at"),
        document.alias("document"),
    )
    companies = B._regions(spark, d).select("company_id").distinct()
    found = documents.latest_run(runs, companies)
    return found.select("company_id", F.col("generated_at").cast("timestamp_ntz").alias("generated_at"), "state", "status")


@query("catalog_union", """
SELECT 'orders' AS part, o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS status, NULL AS flag FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, l_extendedprice, NULL, l_returnflag FROM lineitem
""")
def catalog_union(spark, d):
    """Tables with different columns as one."""
    orders = B.table(spark, d, "orders").select(
        F.lit("orders").alias("part"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )
    item = B.table(spark, d, "lineitem").select(
        F.lit("lineitem").alias("part"), F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("flag"),
    )
    return files.merge_schemas([orders, item])


@query("trusted_keys", f"""
SELECT event_id, 'trusted/' || {B.sql_company('user_id')} || '/finance/transactions/' || strftime(ts, '%Y/%m/%d/part.json') AS trusted_key, CAST(ts AS DATE) AS dt FROM events
""")
def trusted_keys(spark, d):
    """Where the trusted copy of a raw file goes."""
    key = sinks.trusted_key(F.col("source_file"), F.lit("finance"), F.lit("transactions"), F.col("company_id"))
    rows = _filed(spark, d)
    dated = sinks.with_batch(rows.withColumn("source_file", F.concat(F.lit("/"), "source_file")))
    return dated.select("event_id", key.alias("trusted_key"), "dt")


# --- reviews -------------------------------------------------------------------------
@query("review_state", f"""
WITH {B.SQL_REVIEWS} SELECT company_id, anomaly_id, status, last_action, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * last_turn AS updated_at, updated_by,
  CAST(audit_count AS INTEGER) AS audit_count, CAST(notes_count AS INTEGER) AS notes_count, trail FROM reviews
""")
def review_state(spark, d):
    """Current review of each anomaly from the log of actions."""
    state = reviews.review_state(B.review_actions(spark, d))
    return state.select(
        "company_id", "anomaly_id", "status", "last_action", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), "updated_by",
        F.size("audit_trail").alias("audit_count"), F.coalesce(F.size("notes"), F.lit(0)).alias("notes_count"),
        F.array_join(F.transform("audit_trail", lambda a: F.concat_ws(":", a.action, a.status)), ">").alias("trail"),
    )


_SQL_MERGED = """merged AS (SELECT i.* EXCLUDE (status), coalesce(r.status, i.status) AS status, r.last_action FROM items i LEFT JOIN reviews r USING (company_id, anomaly_id))"""


def _merged(spark, d):
    return reviews.merge_reviews(
        reviews.normalize_items(B.items(spark, d)), reviews.review_state(B.review_actions(spark, d))
    )


@query("anomaly_list", f"""
WITH {B.SQL_ITEMS}, {B.SQL_REVIEWS}, {_SQL_MERGED},
f AS (SELECT * FROM merged WHERE severity IN ('high', 'medium') AND entity_type IN ('daily_finance', 'unknown') AND (detected_at IS NULL OR (detected_at >= TIMESTAMP '2024-01-01' AND detected_at <= TIMESTAMP '2024-01-20 12:00:00')))
SELECT company_id, anomaly_id, anomaly_type, entity_type, severity, status, detected_at, last_action, CAST(row_number() OVER (PARTITION BY company_id ORDER BY detected_at DESC NULLS LAST, anomaly_id) AS INTEGER) AS position FROM f
QUALIFY position <= 200
""")
def anomaly_list(spark, d):
    """Reviewed anomalies by filter, the newest two hundred per company."""
    kept = reviews.filter_items(
        _merged(spark, d), "2024-01-01", "2024-01-20T12:00:00Z", severity=" High,medium", entity_type="daily_finance,unknown"
    )
    listed = reviews.newest_items(kept, 500)
    return listed.select(
        "company_id", "anomaly_id", "anomaly_type", "entity_type", "severity", "status",
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"), F.col("review.last_action").alias("last_action"), "position",
    )


@query("review_summary", f"""
WITH {B.SQL_ITEMS}, {B.SQL_REVIEWS}, {_SQL_MERGED}
SELECT company_id, count(*) FILTER (severity = 'high') AS high_priority_count, count(*) FILTER (severity = 'medium') AS medium_priority_count, count(*) FILTER (severity = 'low') AS low_priority_count,
  count(*) FILTER (status IN ('reviewed', 'confirmed', 'false_positive', 'resolved')) AS reviewed_count, count(*) FILTER (status = 'confirmed') AS confirmed_count FROM merged GROUP BY ALL
""")
def review_summary(spark, d):
    """Counts by priority and review progress."""
    return reviews.review_summary(_merged(spark, d))


@query("anomaly_lookup", f"""
WITH {B.SQL_ITEMS}, q AS (SELECT DISTINCT {B.sql_company('doc_id')} AS company_id, CAST(doc_id * 7 AS VARCHAR) AS anomaly_id FROM documents)
SELECT company_id, anomaly_id, i.severity IS NOT NULL AS found, coalesce(anomaly_type, 'unknown') AS anomaly_type, coalesce(entity_type, 'unknown') AS entity_type,
  coalesce(severity, 'low') AS severity, coalesce(status, 'new') AS status, detected_at FROM q LEFT JOIN items i USING (company_id, anomaly_id)
""")
def anomaly_lookup(spark, d):
    """Requested anomalies, with a placeholder for unknown ones."""
    wanted = B.table(spark, d, "documents").select(
        B.company_of(F.col("doc_id")).alias("company_id"), (F.col("doc_id") * 7).cast("string").alias("anomaly_id")
    )
    found = reviews.lookup_items(wanted, reviews.normalize_items(B.items(spark, d)))
    return found.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz"))


@query("anomaly_counts", f"""
WITH {B.SQL_ITEMS}, p AS (SELECT company_id, 'severity' AS field, severity AS label FROM items UNION ALL SELECT company_id, 'anomaly_type', anomaly_type FROM items)
SELECT company_id, field, label, count(*) AS n FROM p GROUP BY ALL
""")
def anomaly_counts(spark, d):
    """Anomalies by severity and by type."""
    return anomaly.anomaly_counts(reviews.normalize_items(B.items(spark, d)))


# --- tenants -------------------------------------------------------------------------
def _companies(spark, d):
    key = F.col("n_nationkey")
    return B.table(spark, d, "nation").select(
        F.lower("n_name").alias("company_id"),
        F.when(key % 4 == 0, "Active").when(key % 4 == 1, "").when(key % 4 == 3, "suspended").alias("status"),
        F.when(key % 3 == 0, F.concat(F.lit("/trusted/custom-"), key)).when(key % 3 == 1, "trusted/").otherwise("elsewhere/x/").alias("trusted_prefix"),
        F.when(key % 3 == 1, F.concat(F.lit("trusted-analytics/a-"), key, F.lit("/"))).alias("analytics_prefix"),
    )


@query("tenant_scope", """
WITH c AS (SELECT lower(n_name) AS company_id, CASE WHEN n_nationkey % 3 = 0 THEN 'trusted/custom-' || n_nationkey || '/' ELSE 'trusted/' || lower(n_name) || '/' END AS t,
  CASE WHEN n_nationkey % 3 = 1 THEN 'trusted-analytics/a-' || n_nationkey || '/' ELSE 'trusted-analytics/' || lower(n_name) || '/' END AS a FROM nation WHERE n_nationkey % 4 <> 3)
SELECT company_id, t AS trusted_base, a AS analytics_base, t || 'employees/' AS employees_prefix, t || 'finance/transactions/' AS finance_prefix,
  a || 'predictions/' AS predictions_prefix, a || 'anomalies/' AS anomalies_prefix FROM c
""")
def tenant_scope(spark, d):
    """Active companies and their prefixes."""
    return tenant.tenant_scope(_companies(spark, d))


@query("tenant_rows", """
SELECT lower(n_name) AS company_id, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 4 <> 3 GROUP BY ALL
""")
def tenant_rows(spark, d):
    """Rows of active companies only."""
    rows = B.table(spark, d, "customer").join(B.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("company_id", F.lower("n_name"))
    return tenant.scoped_rows(rows, tenant_scope(spark, d)).groupBy("company_id").agg(F.count("*").alias("customers"))


def _trusted(spark, d):
    rows = B.orders_finance(spark, d)
    return rows.select(
        "company_id", F.lit("finance").alias("domain"),
        F.when(F.col("category") == "5-LOW", "accounts").otherwise("transactions").alias("table"), "record_id", "date", "amount", "source_area",
    )


@query("tenant_select", f"""
WITH {B.SQL_ORDERS} SELECT record_id, CAST(date AS VARCHAR) AS date, CAST(amount AS VARCHAR) AS amount, source_area FROM fin
WHERE company_id = 'asia' AND category <> '5-LOW' AND (amount > 400000 OR company_id = 'europe') ORDER BY amount DESC, record_id LIMIT 150
""")
def tenant_select(spark, d):
    """One company's rows by predicate, order and limit, as text."""
    return tenant.tenant_select(
        _trusted(spark, d), "asia", ["record_id", "date", "amount", "source_area"],
        where="amount > 400000 OR company_id = 'europe'", order_by="amount DESC, record_id", limit=150, dataset="transactions",
    )


@query("tenant_groups", f"""
WITH {B.SQL_ORDERS} SELECT vendor, count(*) AS row_count FROM fin WHERE company_id = 'europe' GROUP BY ALL
""")
def tenant_groups(spark, d):
    """Rows per vendor of one company, all of them."""
    rows = B.orders_finance(spark, d).filter("company_id = 'europe'")
    return tenant.group_counts(rows, "vendor")


# --- pipeline health -------------------------------------------------------------------
@query("freshness", f"""
WITH {B.SQL_FRESHNESS} SELECT dataset, target_minutes, last_success_at, status, round_even(lag, 2) AS lag_minutes FROM fresh
""")
def freshness(spark, d):
    """Health of each dataset by the age of its newest file."""
    return _fresh(spark, d).select(
        "dataset", "target_minutes", F.col("last_success_at").cast("timestamp_ntz").alias("last_success_at"), "status", "lag_minutes"
    )


def _fresh(spark, d):
    return health.freshness(B.dataset_files(spark, d), B.targets(spark), B.AS_OF)


@query("latest_metric", f"WITH {B.SQL_TELEMETRY} SELECT * FROM newest")
def latest_metric(spark, d):
    """The newest datapoint of each metric within three hours."""
    return _latest(spark, d).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _latest(spark, d):
    return health.latest_metric(B.telemetry(spark, d), B.AS_OF)


def _signals(spark, d):
    return health.service_signals(_latest(spark, d), B.services(spark), B.tasks(spark))


_RANKS = "['healthy', 'warning', 'degraded', 'down']"
_SQL_SIGNALS = f"""
wide AS (SELECT s.signal, kind, name, timeout_ms, {', '.join(
    f"max(value) FILTER (metric = '{m}') AS {a}, max(ts) FILTER (metric = '{m}') AS {a}_at" for a, m in (
        ('src', 'CDCLatencySource'), ('tgt', 'CDCLatencyTarget'), ('age', 'GetRecords.IteratorAgeMilliseconds'),
        ('wthr', 'WriteProvisionedThroughputExceeded'), ('inc', 'IncomingRecords'), ('fr', 'DeliveryToS3.DataFreshness'),
        ('ok', 'DeliveryToS3.Success'), ('runs', 'Invocations'), ('errors', 'Errors'), ('dur', 'Duration'), ('thr', 'Throttles')))}
  FROM services s LEFT JOIN newest ON resource = name GROUP BY ALL),
graded AS (SELECT *, CASE kind
  WHEN 'cdc' THEN greatest(CASE signal WHEN 'cdc_public' THEN 0 ELSE 3 END, CASE WHEN greatest(coalesce(src, 0), coalesce(tgt, 0)) >= 900 THEN 3 WHEN greatest(coalesce(src, 0), coalesce(tgt, 0)) >= 300 THEN 2 WHEN greatest(coalesce(src, 0), coalesce(tgt, 0)) >= 60 THEN 1 ELSE 0 END)
  WHEN 'stream' THEN greatest(CASE WHEN age >= 300000 THEN 3 WHEN age >= 120000 THEN 2 WHEN age >= 30000 THEN 1 ELSE 0 END, CASE WHEN wthr >= 50 THEN 3 WHEN wthr >= 10 THEN 2 WHEN wthr > 0 THEN 1 ELSE 0 END)
  WHEN 'delivery' THEN CASE WHEN fr >= 1800 THEN 3 WHEN fr >= 900 THEN 2 WHEN fr >= 300 THEN 1 ELSE 0 END
  ELSE greatest(
    CASE WHEN runs > 0 AND errors >= runs AND errors >= 1 THEN 3 WHEN errors >= 5 OR (runs > 0 AND errors / greatest(runs, 1) >= .25) THEN 2 WHEN errors >= 1 THEN 1 ELSE 0 END,
    CASE WHEN thr >= 3 THEN 3 WHEN thr >= 1 THEN 2 ELSE 0 END,
    CASE WHEN dur / timeout_ms >= .95 THEN 3 WHEN dur / timeout_ms >= .8 THEN 2 WHEN dur / timeout_ms >= .6 THEN 1 ELSE 0 END) END AS rank,
  CASE kind WHEN 'cdc' THEN greatest(src_at, tgt_at) WHEN 'stream' THEN greatest(age_at, inc_at) WHEN 'delivery' THEN greatest(fr_at, ok_at) ELSE greatest(runs_at, dur_at) END AS last_success_at,
  CASE kind WHEN 'cdc' THEN 'dms:' WHEN 'stream' THEN 'kinesis:' WHEN 'delivery' THEN 'firehose:' ELSE 'lambda:' END || name AS resource,
  CASE kind WHEN 'cdc' THEN (src IS NULL)::INT + (tgt IS NULL)::INT WHEN 'stream' THEN (age IS NULL)::INT + (wthr IS NULL)::INT + (inc IS NULL)::INT
    WHEN 'delivery' THEN (fr IS NULL)::INT + (ok IS NULL)::INT ELSE (runs IS NULL)::INT + (errors IS NULL)::INT + (dur IS NULL)::INT + (thr IS NULL)::INT END AS missing
  FROM wide)
"""


@query("service_signals", f"""
WITH {B.SQL_TELEMETRY}, {_SQL_SIGNALS} SELECT signal, {_RANKS}[rank + 1] AS status, resource, last_success_at, missing FROM graded
""")
def service_signals(spark, d):
    """Health of each service from its newest metrics."""
    return _signals(spark, d).select(
        "signal", "status", "resource", F.col("last_success_at").cast("timestamp_ntz").alias("last_success_at"), "missing"
    )


def _active(spark, d):
    return health.active_alarms(B.alarms(spark, d), "app-", B.TASK_IDS, B.ALARM_NAMES)


@query("alarm_routing", f"""
WITH {B.SQL_ALARMS} SELECT name || ':' || coalesce(pipeline_id, 'shared') AS alarm_id, pipeline_id,
  CASE pipeline_id WHEN 'employee-pipeline' THEN 'Employee pipeline' WHEN 'finance-pipeline' THEN 'Finance pipeline' WHEN 'forecast-pipeline' THEN 'Forecast pipeline'
    WHEN 'anomaly-pipeline' THEN 'Anomaly pipeline' ELSE 'Shared platform' END AS pipeline_name, name, severity, summary, resource, triggered_at FROM alarms
""")
def alarm_routing(spark, d):
    """Active alarms with the pipelines they concern."""
    return health.order_alarms(_active(spark, d)).withColumn("triggered_at", F.col("triggered_at").cast("timestamp_ntz"))


@query("log_summary", f"""
WITH {B.SQL_LOGS}, n AS (SELECT service, count(*) FILTER (ts >= {B.SQL_AS_OF} - INTERVAL 15 MINUTE) AS c, arg_max(message, ts) AS m, max(ts) AS t
  FROM logs WHERE ts >= {B.SQL_AS_OF} - INTERVAL 240 MINUTE AND ts <= {B.SQL_AS_OF} GROUP BY ALL),
s AS (SELECT DISTINCT service FROM (SELECT 'service-' || (user_id % 6) AS service FROM events))
SELECT service, CASE WHEN m LIKE 'ERROR%' OR m LIKE 'Exc%' THEN 'ERROR' WHEN m LIKE 'Warn%' THEN 'WARN' ELSE 'INFO' END AS level, least(coalesce(c, 0), 50) AS count_15m,
  coalesce(m, 'No recent elevated logs.') AS latest_message, t AS updated_at FROM s LEFT JOIN n USING (service)
""")
def log_summary(spark, d):
    """Recent elevated log lines of each service."""
    logs = B.logs(spark, d)
    out = health.log_summary(logs, logs.select("service").distinct(), B.AS_OF)
    return out.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


_SQL_ERRORS = f"""
recent AS (SELECT * FROM logs WHERE ts >= {B.SQL_AS_OF} - INTERVAL 240 MINUTE AND ts <= {B.SQL_AS_OF} QUALIFY row_number() OVER (PARTITION BY service ORDER BY ts DESC, message DESC) <= 5),
errors AS (SELECT pipeline_id, CAST(row_number() OVER (PARTITION BY pipeline_id ORDER BY ts DESC, message DESC, service) AS INTEGER) AS position, service, ts AS timestamp, message AS summary
  FROM recent JOIN routes USING (service) QUALIFY position <= 5)
"""


@query("recent_errors", f"WITH {B.SQL_LOGS}, {B.SQL_ROUTES}, {_SQL_ERRORS} SELECT * FROM errors")
def recent_errors(spark, d):
    """The newest elevated lines of each pipeline."""
    return _errors(spark, d).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _errors(spark, d):
    return health.recent_errors(B.logs(spark, d), B.routes(spark), B.AS_OF)


@query("error_lines", """
SELECT 'service-2' AS service, ts, 'ERROR   failed:' || chr(10) || props AS message FROM events WHERE user_id % 6 = 2 AND event_type = 'error' ORDER BY ts DESC LIMIT 20
""")
def error_lines(spark, d):
    """The newest twenty error lines of one service."""
    return health.error_lines(B.logs(spark, d), "service-2").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _health(spark, d):
    return health.pipeline_health(_fresh(spark, d), _signals(spark, d), _active(spark, d), _errors(spark, d))


_PARTS = [
    ("employee", ["cdc_public", "stream", "delivery"], "transform", "employees", ["cdc_public"]),
    ("finance", ["cdc_finance", "stream", "delivery"], "transform", "finance", ["cdc_finance"]),
    ("forecast", ["employees", "finance"], "ml", "predictions", []),
    ("anomaly", ["predictions"], "anomaly", "anomalies", []),
]


def _sql_roles() -> str:
    rows = []
    for name, source, processing, delivery, _ in _PARTS:
        rows += [(f"{name}-pipeline", s, "source") for s in source]
        rows += [(f"{name}-pipeline", processing, "processing"), (f"{name}-pipeline", delivery, "delivery")]
    return B._sql_values(rows)


_SQL_HEALTH = f"""
parts(pipeline_id, signal, role) AS (VALUES {_sql_roles()}),
states AS (SELECT signal, rank, last_success_at, missing, TRUE AS service, NULL::DOUBLE AS lag, NULL::INT AS target FROM graded
  UNION ALL SELECT dataset, list_position({_RANKS}, status) - 1, last_success_at, 0, FALSE, round_even(lag, 2), target_minutes FROM fresh),
roles AS (SELECT pipeline_id, max(rank) FILTER (role = 'source') AS s, max(rank) FILTER (role = 'processing') AS p, max(rank) FILTER (role = 'delivery') AS v,
  max(last_success_at) FILTER ((role <> 'source' OR service) AND signal NOT IN ('stream', 'delivery')) AS last_success_at,
  max(lag) FILTER (role = 'delivery') AS lag, max(target) FILTER (role = 'delivery') AS target, sum(missing) AS missing FROM parts JOIN states USING (signal) GROUP BY ALL),
af AS (SELECT pipeline_id, count(*) AS n, max(CASE severity WHEN 'critical' THEN 3 ELSE 2 END) AS r, max(triggered_at) AS at FROM alarms GROUP BY ALL),
ef AS (SELECT pipeline_id, max(timestamp) AS at, arg_min(summary, position) AS e FROM errors GROUP BY ALL),
hm AS (SELECT pipeline_id, sum(missing) AS m FROM (SELECT 'forecast-pipeline' AS pipeline_id, missing FROM graded WHERE signal = 'live_api' UNION ALL SELECT 'anomaly-pipeline', missing FROM graded WHERE signal = 'live_api') GROUP BY ALL),
health AS (SELECT pipeline_id, upper(left(pipeline_id, 1)) || replace(substr(pipeline_id, 2), '-', ' ') AS name, greatest(s, p, v, coalesce(af.r, 0)) AS w, s, p, v, last_success_at, greatest(ef.at, af.at) AS last_failure_at,
  coalesce(n, 0) AS alarm_count, coalesce(e, '') AS recent_error_summary, lag, target, CAST(missing + coalesce(m, 0) AS BIGINT) AS missing_metrics
  FROM roles LEFT JOIN af USING (pipeline_id) LEFT JOIN ef USING (pipeline_id) LEFT JOIN hm USING (pipeline_id)),
pipelines AS (SELECT *, {_RANKS}[w + 1] AS overall_status, CASE WHEN w = 0 THEN name || ' is healthy and operating inside its expected freshness targets.'
  ELSE name || ' is ' || {_RANKS}[w + 1] || '. ' || concat_ws('; ', CASE WHEN alarm_count > 0 THEN alarm_count || ' active alarm(s)' END,
    CASE WHEN lag IS NOT NULL THEN 'freshness lag ' || CAST(round_even(lag, 0) AS BIGINT) || 'm against a ' || target || 'm target' END, nullif(rtrim(recent_error_summary, '.'), '')) || '.' END AS summary FROM health)
"""
_SQL_ALL_HEALTH = f"{B.SQL_TELEMETRY}, {_SQL_SIGNALS}, {B.SQL_FRESHNESS}, {B.SQL_ALARMS}, {B.SQL_LOGS}, {B.SQL_ROUTES}, {_SQL_ERRORS}, {_SQL_HEALTH}"


@query("health_rollup", f"""
WITH {_SQL_ALL_HEALTH} SELECT pipeline_id, name, overall_status, {_RANKS}[s + 1] AS source_status, {_RANKS}[p + 1] AS processing_status, {_RANKS}[v + 1] AS delivery_status,
  {_RANKS}[v + 1] AS freshness_status, last_success_at, last_failure_at, alarm_count, recent_error_summary, summary, missing_metrics, FALSE AS partial_data FROM pipelines
""")
def health_rollup(spark, d):
    """Roll-up of each pipeline."""
    rows = _health(spark, d).drop("components", "impacted_resources")
    for name in ("last_success_at", "last_failure_at"):
        rows = rows.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return rows


_SQL_COMPONENTS = B._sql_values([(p, n, signal, role) for p, n, _, _, signal, _, role in health.K.PIPELINE_COMPONENTS])


def _gapped(spark, d):
    """The roll-up without telemetry of the transformation and without finance files."""
    fresh = _fresh(spark, d).filter("dataset <> 'finance'")
    signals = _signals(spark, d).filter("signal <> 'transform'")
    return fresh, signals, health.pipeline_health(fresh, signals, _active(spark, d), _errors(spark, d))


@query("health_partial", f"""
WITH {_SQL_ALL_HEALTH}, comps(pipeline_id, position, signal, role) AS (VALUES {_SQL_COMPONENTS}),
known AS (SELECT signal, rank, resource FROM graded WHERE signal <> 'transform' UNION ALL SELECT dataset, list_position({_RANKS}, status) - 1, 'dataset:' || dataset FROM fresh WHERE dataset <> 'finance'),
c AS (SELECT pipeline_id, position, coalesce(rank, 3) AS rank, coalesce(resource, 'unavailable') AS resource, rank IS NULL AS gap FROM comps LEFT JOIN known USING (signal) WHERE role <> 'serving' OR resource IS NOT NULL),
gaps AS (SELECT pipeline_id, bool_or(gap) AS partial_data FROM c GROUP BY ALL),
u AS (SELECT pipeline_id, resource, 0 AS part, position AS o, NULL::TIMESTAMP AS t FROM c WHERE position = 1 OR rank > 0
  UNION ALL SELECT pipeline_id, resource, 1, -max(list_position(['low', 'medium', 'high', 'critical'], severity)), min(triggered_at) FROM alarms GROUP BY pipeline_id, resource),
x AS (SELECT *, row_number() OVER (PARTITION BY pipeline_id, resource ORDER BY part, o, t) AS again FROM u WHERE pipeline_id IS NOT NULL)
SELECT pipeline_id, partial_data, CASE WHEN partial_data THEN 'down' ELSE overall_status END AS overall_status, row_number() OVER (PARTITION BY pipeline_id ORDER BY part, o, t, resource) - 1 AS place, resource
FROM x JOIN gaps USING (pipeline_id) JOIN pipelines USING (pipeline_id) WHERE again = 1
""")
def health_partial(spark, d):
    """Impacted resources, and which pipelines' data are partial, where telemetry is missing."""
    rows = _gapped(spark, d)[2]
    return rows.select("pipeline_id", "partial_data", "overall_status", F.posexplode("impacted_resources").alias("place", "resource"))


@query("health_warnings", """
SELECT * FROM (VALUES ('transform', 'No telemetry for transform.'), ('finance', 'No telemetry for finance.')) AS t(signal, warning)
""")
def health_warnings(spark, d):
    """What the snapshot warns of when telemetry is missing."""
    fresh, signals, _ = _gapped(spark, d)
    return health.signal_warnings(fresh, signals)


@query("health_overview", f"""
WITH {_SQL_ALL_HEALTH} SELECT count(*) AS total_pipelines, count(*) FILTER (w = 0) AS healthy, count(*) FILTER (w IN (1, 2)) AS degraded, count(*) FILTER (w = 3) AS down, CAST(sum(alarm_count) AS BIGINT) AS active_alarms FROM pipelines
""")
def health_overview(spark, d):
    """Pipelines by status."""
    return health.health_overview(_health(spark, d))


@query("health_view", f"""
WITH {_SQL_ALL_HEALTH} SELECT name, overall_status, alarm_count FROM pipelines WHERE overall_status = 'down' AND name LIKE '%n%'
""")
def health_view(spark, d):
    """Pipelines that are down, by name part, most severe first."""
    view = health.pipeline_view(_health(spark, d), status="down", query=" N ")
    return view.select("name", "overall_status", "alarm_count")


@query("metric_5m", """
SELECT event_type AS metric, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS sum_value,
  CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS avg_value, max(value) AS max_value, count(*) AS n FROM events GROUP BY ALL
""")
def metric_5m(spark, d):
    """Sum, mean and maximum per metric and five minutes."""
    rows = alarms.metric_windows(_event_metrics(spark, d))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _event_metrics(spark, d):
    return B.table(spark, d, "events").select(F.col("event_type").alias("metric"), B.at_utc("ts").alias("ts"), "value")


@query("error_lines_5m", """
SELECT 'service-' || (user_id % 6) AS service, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL
""")
def error_lines_5m(spark, d):
    """Error lines per service and five minutes."""
    rows = alarms.error_line_windows(B.logs(spark, d))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_BINDINGS = (
    ("iterator-age", "click", 20000.0), ("write-throttle", "purchase", 2.0), ("delivery-freshness", "view", 100.0), ("transform-errors", "error", 1.0),
    ("transform-duration", "signup", 40000.0), ("forecast-errors", "error", 1.0), ("anomaly-errors", "error", 1.0), ("anomaly-duration", "signup", 100000.0),
    ("public-cdc-latency-target", "click", 100.0), ("finance-cdc-latency-target", "view", 50.0),
)
_SQL_ALARM_EVAL = f"""
bound(alarm, metric, scale) AS (VALUES {B._sql_values(_BINDINGS)}),
rules(alarm, stat, threshold, periods, in_composite) AS (VALUES {B._sql_values(alarms.K.ALARM_RULES)}),
m AS (SELECT alarm, time_bucket(INTERVAL 5 MINUTE, ts) AS w, value * scale AS v FROM events JOIN bound ON metric = event_type),
g AS (SELECT alarm, w, CAST(sum(CAST(v AS DECIMAL(28,6))) AS DOUBLE) AS s, CAST(sum(CAST(v AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS a, max(v) AS x FROM m GROUP BY ALL),
b AS (SELECT alarm, alarm AS metric, w AS window_start, CASE stat WHEN 'sum' THEN s WHEN 'avg' THEN a ELSE x END AS value, periods, in_composite, CASE stat WHEN 'sum' THEN s WHEN 'avg' THEN a ELSE x END > threshold AS breach FROM g JOIN rules USING (alarm)),
st AS (SELECT *, CASE WHEN breach AND (periods = 1 OR EXISTS (SELECT 1 FROM b p WHERE p.alarm = b.alarm AND p.breach AND p.window_start = b.window_start - INTERVAL 5 MINUTE)) THEN 'ALARM' ELSE 'OK' END AS state FROM b)
"""


def alarm_metrics(spark, d):
    """Datapoints of each alarm's metric, which is named after the alarm."""
    bound = spark.createDataFrame(list(_BINDINGS), "alarm string, metric string, scale double")
    return _event_metrics(spark, d).join(F.broadcast(bound), "metric").select(
        F.col("alarm").alias("metric"), "ts", (F.col("value") * F.col("scale")).alias("value")
    )


def _states(spark, d):
    pairs = alarms.rules(spark).select("alarm", F.col("alarm").alias("metric"))
    return alarms.evaluate_alarms(alarms.metric_windows(alarm_metrics(spark, d)), alarms.rules(spark), pairs)


@query("alarm_eval", f"WITH {_SQL_ALARM_EVAL} SELECT alarm, metric, window_start, value, breach, state, in_composite FROM st")
def alarm_eval(spark, d):
    """State of every alarm rule at every window."""
    return _states(spark, d).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("alarm_composite", f"""
WITH {_SQL_ALARM_EVAL} SELECT window_start, CASE WHEN bool_or(in_composite AND state = 'ALARM') THEN 'ALARM' ELSE 'OK' END AS state, count(*) FILTER (in_composite AND state = 'ALARM') AS alarms_on FROM st GROUP BY ALL
""")
def alarm_composite(spark, d):
    """Windows in which any alarm of the composite is on."""
    rows = alarms.composite_state(_states(spark, d))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
