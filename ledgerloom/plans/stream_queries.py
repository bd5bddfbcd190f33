"""Queries that go through files and streams.

They stage the given tables as files in the session's shared folder, run the stream over
all of them, and return what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, ship_code
from ..sources import files, sinks
from ..operators import alarms, cdc
from ..streaming import ingest, stateful
from . import bindings as B
from . import finance_queries  # noqa: F401  its SQL checks a stream too
from .platform_queries import alarm_metrics, change_lines
from .registry import ORACLES, query


def folder(spark, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _run_to_end(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _collect_batches(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what is there, appending each batch under its number."""
    _run_to_end(stateful.start_batches(df, path, checkpoint, None))


FILES = 6
#: Files of a part; equal rows are in the same one.
SALTS = 2


def _in_parts(rows: DataFrame, path: str, number, text: bool = False) -> str:
    """Stage ``rows`` as files that land one part after the other, by the number of their part.

    One write deals all parts out; the times of the files, by which a stream orders them, are
    then set part by part.
    """
    columns = [c for c in rows.columns if c != "_number"]
    salt = F.pmod(F.xxhash64(*columns), F.lit(SALTS))
    staged = rows.withColumn("part", number).select("part", *columns, salt.alias("_salt")).repartition(FILES * SALTS, "part", "_salt")
    write = staged.drop("_salt").write.mode("append").partitionBy("part")
    write.text(path, compression="gzip") if text else write.parquet(path)
    spark = rows.sparkSession
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listFiles(folder, True)
    while files.hasNext():  # some dozen files
        file = files.next().getPath()
        part = int(file.getParent().getName().partition("=")[2] or 0) if "=" in file.getParent().getName() else 0
        system.setTimes(file, 1_700_000_000_000 + part * 1000, -1)
    return path


def _late(key: str, ts: str, before: str):
    """Part numbers that mix all times, but for the oldest rows, which land last."""
    mixed = F.pmod(F.xxhash64(key), F.lit(FILES - 1))
    return F.when(F.col(ts) < F.lit(before), FILES - 1).otherwise(mixed)


def _stream(spark, rows: DataFrame, path: str) -> DataFrame:
    """The staged files as a stream of several batches."""
    reader = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", str(SALTS)).parquet(path)


def _stage_lines(spark, d) -> str:
    """Change lines as raw text files below ``raw/``, some of them in two files."""
    path = f"{folder(spark, 'raw')}/raw/2024/01/31"
    lines = change_lines(spark, d).select("line")
    number = F.coalesce(F.regexp_extract("line", '"(?:transaction_)?id":([0-9]+)', 1).try_cast("bigint"), F.lit(0))
    again = F.when(number % 3 == 0, F.array(number % FILES, (number + 2) % FILES)).otherwise(F.array(number % FILES))
    copies = lines.withColumn("_number", F.explode(again))
    _in_parts(copies, path, F.col("_number"), text=True)
    return path


_SQL_KEPT = """
kept AS (SELECT CASE event_type WHEN 'purchase' THEN 'finance' ELSE 'employees' END AS domain,
  CASE event_type WHEN 'purchase' THEN 'transactions' ELSE 'employees' END AS "table", event_id, event_type
  FROM events WHERE event_type IN ('purchase', 'signup', 'view'))
"""


@query("stream_ingest", f"""
WITH {_SQL_KEPT} SELECT domain, "table", CAST(event_id AS VARCHAR) AS record_id, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS copies FROM kept
""")
def stream_ingest(spark, d):
    """Landed files cleaned by the stream into the trusted table; each file is its own scope for copies."""
    raw, out = _stage_lines(spark, d), folder(spark, "ingest")
    stream = ingest.raw_stream(spark, raw, 1 << 10)
    _run_to_end(ingest.start_ingest(
        stream, "acme", f"{out}/trusted", f"{out}/rejects", f"{out}/backup", f"{out}/checkpoint", every=None
    ))
    trusted = spark.read.parquet(f"{out}/trusted").select("domain", "table", F.json_tuple("record", "transaction_id", "id").alias("_transaction", "_id"))
    record = F.coalesce("_transaction", "_id")
    return trusted.groupBy("domain", "table", record.alias("record_id")).agg(F.count("*").cast("int").alias("copies"))


@query("stream_dedupe", f"""
WITH {_SQL_KEPT} SELECT domain || '/' || "table" AS route, CAST(event_id AS VARCHAR) AS record_id FROM kept
""")
def stream_dedupe(spark, d):
    """Cleaned records of the stream without copies across files, in whatever batch they come."""
    raw, out = _stage_lines(spark, d), folder(spark, "dedupe")
    lines = ingest.raw_stream(spark, raw, 1 << 10).withColumn("company_id", F.lit("acme"))
    _run_to_end(ingest.start_dedupe(ingest.stream_records(lines), f"{out}/rows", f"{out}/checkpoint", None))
    return spark.read.parquet(f"{out}/rows").select(
        "route",
        F.coalesce(F.get_json_object("record", "$.transaction_id"), F.get_json_object("record", "$.id")).alias("record_id"),
    )


@query("stream_headcount", f"""
WITH {B.SQL_EMPLOYEES}, s AS (
  SELECT company_id, date, CAST(coalesce(is_active, TRUE) AS INTEGER) - CAST(coalesce(lag(coalesce(is_active, TRUE)) OVER (PARTITION BY company_id, employee_id ORDER BY ts, seq), FALSE) AS INTEGER) AS step FROM emp)
SELECT company_id, date, CAST(sum(step) AS BIGINT) AS change FROM s GROUP BY ALL HAVING sum(step) <> 0
""")
def stream_headcount(spark, d):
    """Daily changes of the active set, followed by a stream whose oldest events come last."""
    out = folder(spark, "heads")
    rows = B.employees(spark, d)
    _in_parts(rows, f"{out}/events", _late("seq", "event_ts", "2024-01-06"))
    ship_code(spark)
    stream = _stream(spark, rows, f"{out}/events")
    _collect_batches(stateful.headcount_changes(stream), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows").groupBy("company_id", "date").agg(
        F.sum("change").alias("change")).filter("change <> 0")


@query("stream_metric_5m", """
SELECT event_type AS metric, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS sum_value, max(value) AS max_value, count(value) AS n FROM events GROUP BY ALL
""")
def stream_metric_5m(spark, d):
    """Five-minute figures of every window, from batches with late rows."""
    out = folder(spark, "metric")
    rows = B.table(spark, d, "events").select(F.col("event_type").alias("metric"), B.at_utc("ts").alias("ts"), "value")
    _in_parts(rows, f"{out}/events", _late("value", "ts", "2024-01-06"))
    stream = _stream(spark, rows, f"{out}/events")
    _run_to_end(stateful.start_partials(stream, stateful.metric_partials, f"{out}/rows", f"{out}/checkpoint", every=None))
    return stateful.merged_metrics(spark.read.parquet(f"{out}/rows")).select(
        "metric", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "sum_value", "max_value", "n"
    )


@query("stream_daily_totals", """
SELECT event_type AS source_area, CAST(ts AS DATE) AS date,
  CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS daily_total, count(*) AS transaction_count FROM events GROUP BY ALL
""")
def stream_daily_totals(spark, d):
    """Running daily totals over batches that bring old days last."""
    out = folder(spark, "daily")
    rows = B.table(spark, d, "events").select(
        F.lit("acme").alias("company_id"), F.col("event_type").alias("source_area"), B.at_utc("ts").alias("event_ts"), F.col("value").alias("amount"))
    _in_parts(rows, f"{out}/events", _late("amount", "event_ts", "2024-01-06"))
    stream = _stream(spark, rows, f"{out}/events")
    _run_to_end(stateful.start_partials(stream, stateful.daily_total_partials, f"{out}/rows", f"{out}/checkpoint", every=None))
    return stateful.merged_daily_totals(spark.read.parquet(f"{out}/rows")).drop("company_id")


@query("stream_reviews", f"""
WITH {B.SQL_REVIEWS} SELECT company_id, anomaly_id, status, last_action, CAST(audit_count AS INTEGER) AS audit_count FROM reviews
""")
def stream_reviews(spark, d):
    """Reviews folded as their actions arrive."""
    out = folder(spark, "reviews")
    rows = B.review_actions(spark, d)
    _in_parts(rows, f"{out}/actions", F.pmod(F.xxhash64("anomaly_id", "action"), F.lit(FILES)))
    stream = _stream(spark, rows, f"{out}/actions")
    ship_code(spark)
    _run_to_end(stateful.start_reviews(stream, f"{out}/state", f"{out}/checkpoint"))
    return stateful.current_reviews(spark, f"{out}/state").select(
        "company_id", "anomaly_id", "status", "last_action", F.size("audit_trail").alias("audit_count")
    )


@query("stream_spend", ORACLES["spend_window"])
def stream_spend(spark, d):
    """Spend figures refreshed by a stream whose oldest rows come last; some expenses have no date."""
    out = folder(spark, "spend")
    rows = B.orders_finance(spark, d, "live").select("company_id", "record_id", "date", "amount", "source_area").withColumn(
        "date", F.when(F.col("record_id").cast("bigint") % 50 > 0, F.col("date")))
    _in_parts(rows, f"{out}/rows", _late("record_id", "date", "1996-01-01"))
    ship_code(spark)
    stream = _stream(spark, rows, f"{out}/rows")
    _run_to_end(stateful.start_spend(stream, f"{out}/figures", f"{out}/checkpoint", (7, 30, 90), None))
    return stateful.current_spend(spark, f"{out}/figures")


@query("stream_alarms", f"SELECT alarm, window_start, state FROM ({ORACLES['alarm_eval']})")
def stream_alarms(spark, d):
    """States of every alarm, followed by a stream whose oldest windows come last."""
    out = folder(spark, "alarms")
    windows = alarms.metric_windows(alarm_metrics(spark, d)).join(alarms.rules(spark).withColumnRenamed("alarm", "metric"), "metric")
    value = F.when(F.col("stat") == "sum", F.col("sum_value")).when(F.col("stat") == "avg", F.col("avg_value"))
    rows = windows.select("metric", "window_start", F.coalesce(value, "max_value").alias("value"), "threshold", "periods")
    _in_parts(rows, f"{out}/windows", _late("window_start", "window_start", "2024-01-06"))
    ship_code(spark)
    stream = _stream(spark, rows, f"{out}/windows")
    _run_to_end(stateful.start_batches(stateful.alarm_states(stream), f"{out}/rows", f"{out}/checkpoint", None))
    return stateful.current_alarms(spark.read.parquet(f"{out}/rows")).select(
        F.col("metric").alias("alarm"), F.col("window_start").cast("timestamp_ntz").alias("window_start"), "state")


@query("read_polyglot", """
SELECT 'customer' AS kind, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation
""")
def read_polyglot(spark, d):
    """Records from whole-file objects, arrays, and lines with broken ones among them."""
    root = folder(spark, "polyglot")
    customer = B.table(spark, d, "customer")
    rows = customer.select(
        F.floor(F.col("c_custkey") / 200).alias("chunk"),
        F.to_json(F.struct("c_custkey", "c_name")).alias("j"),
    )
    chunks = rows.groupBy("chunk").agg(F.sort_array(F.collect_list("j")).alias("js"))
    array = F.concat(F.lit("[1, "), F.array_join("js", ", "), F.lit("]"))
    lines = F.concat(F.lit("{broken\n\n"), F.array_join("js", "\n"), F.lit("\n[2]\n"))
    chunks.select(F.when(F.col("chunk") % 2 == 0, array).otherwise(lines)).write.option("maxRecordsPerFile", 1).text(f"{root}/customer")
    nation = B.table(spark, d, "nation")
    nation.select(F.to_json(F.struct("n_nationkey", "n_name"))).write.option("maxRecordsPerFile", 1).text(f"{root}/nation")

    def field(raw: str, name: str, kind: str):
        return F.try_variant_get(F.try_element_at(raw, F.lit(name)), "$", kind)

    found = files.read_polyglot(spark, f"{root}/*")
    return found.select(
        F.when(F.map_contains_key("raw", "c_custkey"), "customer").otherwise("nation").alias("kind"),
        F.coalesce(field("raw", "c_custkey", "bigint"), field("raw", "n_nationkey", "bigint")).alias("key"),
        F.coalesce(field("raw", "c_name", "string"), field("raw", "n_name", "string")).alias("name"),
    )


@query("trusted_write", f"""
SELECT {B.sql_company('user_id')} AS company_id, CASE event_type WHEN 'purchase' THEN 'finance' ELSE 'employees' END AS domain,
  CASE event_type WHEN 'purchase' THEN 'transactions' ELSE 'employees' END AS "table", CAST(ts AS DATE) AS dt, count(*) AS n
FROM events WHERE event_type IN ('purchase', 'signup', 'view') GROUP BY ALL
""")
def trusted_write(spark, d):
    """The trusted table after a write and a replay of the same files."""
    path = folder(spark, "trusted")
    daily = change_lines(spark, d).withColumn("source_file", F.regexp_replace("source_file", "part-.*", "day.gz"))
    records = cdc.clean_lines(daily)
    sinks.write_trusted(records, path)
    sinks.write_trusted(records, path)
    return spark.read.parquet(path).groupBy("company_id", "domain", "table", "dt").agg(F.count("*").alias("n"))
