"""Queries that run whole jobs: the given tables as landing files, through to committed runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..jobs import anomalies, forecasting, inputs
from ..jobs.store import RunStore
from ..session import ship_code
from ..sources import files
from . import bindings as B
from .registry import query
from .stream_queries import folder

RUN_AT = "2024-01-31T00:00:00Z"
#: Landing files of a company.
LANDED = 2


def _put(spark, path: str, content: bytes) -> None:
    """One small file as it is."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(content))
    out.close()


def _json(*fields):
    return F.to_json(F.struct(*fields))


def _order_fields():
    return ("transaction_id", F.col("transaction_date").cast("string").alias("transaction_date"), "amount", "type", "category", "department", "vendor")


def _landing_lines(spark, d):
    """Change lines of every company: events as employees, orders as transactions."""
    def line(schema: str, name: str, *fields):
        head = F.struct(F.lit(schema).alias("schema-name"), F.lit(name).alias("table-name"))
        return F.to_json(F.struct(head.alias("metadata"), F.struct(*fields).alias("data"))).alias("line")

    staff = B.employee_records(spark, d).select(
        "company_id", line("public", "employees", "employee_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"), "status", "seq"))
    return staff.unionByName(B.order_records(spark, d).select("company_id", line("finance", "transactions", *_order_fields())))


_SQL_JOB_SERIES = f"""
{B.SQL_ALL_SERIES},
e AS (SELECT company_id, count(*) AS employees FROM emp GROUP BY ALL), f AS (SELECT company_id, count(*) AS finance FROM fin GROUP BY ALL),
m AS (SELECT company_id, metric, count(*) AS history_points, min(date) AS first_date, max(date) AS last_date FROM series GROUP BY ALL)
"""


@query("forecast_job", f"""
WITH {_SQL_JOB_SERIES}
SELECT company_id, metric, 'ok' AS run_status, 'ok' AS status, employees, finance, 2 AS employees_files, 2 AS finance_files, history_points, first_date, last_date,
  history_points - 14 AS rows_used, CASE WHEN metric = 'employee_headcount' THEN employees ELSE finance END AS source_rows, 7 AS days,
  CAST(last_date + 1 AS DATE) AS forecast_from, CAST(last_date + 7 AS DATE) AS forecast_to, 'RandomForestRegressor' AS model_name
FROM m JOIN e USING (company_id) JOIN f USING (company_id)
""")
def forecast_job(spark, d):
    """Raw landing files through cleaning, series, gate and forests into committed documents, read back."""
    ship_code(spark)
    root = folder(spark, "forecast-job")
    salt = F.pmod(F.xxhash64("line"), F.lit(LANDED)).alias("salt")
    lines = _landing_lines(spark, d).select("company_id", "line", salt).repartition("company_id", "salt")
    lines.write.partitionBy("company_id", "salt").text(f"{root}/raw", compression="gzip")
    company = F.regexp_extract("source_file", "/company_id=([^/]+)/", 1)
    inputs.ingest_raw(spark, root, company, f"{root}/trusted")
    store = RunStore(spark, f"{root}/runs")
    forecasting.forecast_job(store, lambda: inputs.table_inputs(spark, f"{root}/trusted"), "2024-01-31", RUN_AT, days=7)
    found = F.from_json(
        "document", "status string, rows_processed struct<employees:bigint,finance:bigint>, input_files struct<employees:int,finance:int>, "
        "metrics array<struct<metric:string,status:string,model_name:string,rows_used:bigint,source_rows:bigint,history_points:bigint,"
        "history:array<struct<date:date>>,forecast:array<struct<date:date>>>>")
    rows = store.documents("forecast").select("company_id", found.alias("d")).select("company_id", "d", F.explode("d.metrics").alias("m"))
    past, ahead = F.col("m.history.date"), F.col("m.forecast.date")
    return rows.select(
        "company_id", "m.metric", F.col("d.status").alias("run_status"), "m.status", "d.rows_processed.employees", "d.rows_processed.finance",
        F.col("d.input_files.employees").alias("employees_files"), F.col("d.input_files.finance").alias("finance_files"), "m.history_points",
        F.array_min(past).alias("first_date"), F.array_max(past).alias("last_date"), "m.rows_used", "m.source_rows",
        F.size(ahead).alias("days"), F.array_min(ahead).alias("forecast_from"), F.array_max(ahead).alias("forecast_to"), "m.model_name")


@query("anomaly_job", f"""
WITH {B.SQL_ORDERS}, {B.SQL_DAILY},
a AS (SELECT company_id, source_area, CAST(sum(transaction_count) AS BIGINT) AS n FROM daily GROUP BY ALL),
g AS (SELECT company_id, sum(n) AS n, CAST(sum(CASE WHEN n >= 20 THEN n END) AS BIGINT) AS modelled, count(CASE WHEN n >= 20 THEN 1 END) AS scored_groups FROM a GROUP BY ALL)
SELECT company_id, 'ok' AS status, 'transaction' AS mode, CAST(n AS BIGINT) AS rows_processed, CASE company_id WHEN 'europe' THEN 3 ELSE 2 END AS input_files,
  CASE company_id WHEN 'europe' THEN 1 ELSE 0 END AS unreadable_files, modelled AS rows_modeled, CAST(n AS BIGINT) AS records_read, CAST(scored_groups AS BIGINT) AS scored_groups,
  TRUE AS counts_agree, TRUE AS details_complete FROM g
""")
def anomaly_job(spark, d):
    """Trusted files, one company's without transactions and one file broken, into committed anomalies, read back."""
    ship_code(spark)
    root = folder(spark, "anomaly-job")
    # A company whose finance files are not split out yet has no folder of transactions.
    kind = F.when(F.col("company_id") == "asia", "accounts").otherwise("transactions")
    rows = B.order_records(spark, d).select(
        "company_id", F.lit("finance").alias("domain"), kind.alias("table"), F.pmod(F.xxhash64("transaction_id"), F.lit(LANDED)).alias("salt"),
        _json(*_order_fields()).alias("value"))
    staged = rows.repartition("company_id", "salt").write.partitionBy("company_id", "domain", "table", "salt")
    staged.text(f"{root}/trusted", compression="gzip")
    _put(spark, f"{root}/trusted/company_id=europe/domain=finance/table=transactions/broken.json.gz", b"this is not gzip")
    _put(spark, f"{root}/trusted/company_id=europe/domain=finance/table=accounts/other.json", b'{"transaction_id": "left out", "amount": 1}')
    store = RunStore(spark, f"{root}/runs")
    anomalies.anomaly_job(store, lambda: inputs.file_inputs(spark, f"{root}/trusted", prefer_transactions=True), "2024-01-31", RUN_AT)
    found = F.from_json(
        "document", "status string, summary struct<total:bigint,by_severity:map<string,bigint>,by_type:map<string,bigint>>, "
        "source struct<input_files:int,unreadable_files:int,rows_processed:bigint>, metadata struct<mode:string,rows_modeled:bigint,records_read:bigint,scored_groups:bigint>, "
        "anomalies array<struct<anomaly_id:string,features_used:array<string>,details:struct<transaction:string,features:struct<amount:double>>>>")

    def total(counts):
        return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda s, n: s + n)

    items = F.col("d.anomalies")
    n = F.col("d.summary.total")
    agree = (n > 0) & (n <= 200) & (n == total(F.col("d.summary.by_severity"))) & (n == total(F.col("d.summary.by_type"))) & (
        n == F.size(F.array_distinct(items.getField("anomaly_id"))))
    complete = F.forall(items, lambda i: (F.size(i["features_used"]) == 6) & i["details"]["transaction"].contains('"transaction_id"') & i["details"]["features"]["amount"].isNotNull())
    return store.documents("anomaly").select("company_id", found.alias("d")).select(
        "company_id", "d.status", "d.metadata.mode", "d.source.rows_processed", "d.source.input_files", "d.source.unreadable_files",
        "d.metadata.rows_modeled", "d.metadata.records_read", "d.metadata.scored_groups", agree.alias("counts_agree"), complete.alias("details_complete"))


@query("raw_scan", """
WITH c AS (SELECT c_custkey // 200 AS chunk, count(*) AS n FROM customer GROUP BY ALL)
SELECT 'customer' AS kind, 'read' AS outcome, count(*) AS files, CAST(sum(n) AS BIGINT) AS records, CAST(sum(CASE WHEN chunk % 2 = 0 THEN 1 ELSE 2 END) AS BIGINT) AS bad_items FROM c
UNION ALL SELECT 'nation', 'read', count(*), count(*), 0 FROM nation
UNION ALL SELECT * FROM (VALUES ('broken', 'unreadable', 2, 0, 0), ('broken', 'empty', 1, 0, 0), ('broken', 'no_records', 1, 0, 1))
""")
def raw_scan(spark, d):
    """What became of every file: arrays, lines, single objects, and files that cannot be read."""
    root = folder(spark, "scan")
    customer = B.table(spark, d, "customer").select(F.floor(F.col("c_custkey") / 200).alias("chunk"), _json("c_custkey", "c_name").alias("j"))
    chunks = customer.groupBy("chunk").agg(F.sort_array(F.collect_list("j")).alias("js"))  # at most 200 to a file
    array = F.concat(F.lit("[1, "), F.array_join("js", ", "), F.lit("]"))
    lines = F.concat(F.lit("{broken\n\n"), F.array_join("js", "\n"), F.lit("\n[2]\n"))
    chunks.select(F.when(F.col("chunk") % 2 == 0, array).otherwise(lines)).write.option("maxRecordsPerFile", 1).text(f"{root}/customer")
    B.table(spark, d, "nation").select(_json("n_nationkey", "n_name")).write.option("maxRecordsPerFile", 1).text(f"{root}/nation")
    _put(spark, f"{root}/broken/a.json.gz", b"this is not gzip")
    _put(spark, f"{root}/broken/b.json", '{"name": "é"}'.encode("latin-1"))
    _put(spark, f"{root}/broken/c.json", b"")
    _put(spark, f"{root}/broken/d.json", b"no json")
    _, account = files.read_accounted(spark, root)
    kind = F.regexp_extract("source_file", "/([a-z]+)/[^/]+$", 1)
    return account.filter("NOT endswith(source_file, '_SUCCESS')").groupBy(kind.alias("kind"), "outcome").agg(
        F.count(F.lit(1)).alias("files"), F.sum("records").alias("records"), F.sum("bad_items").alias("bad_items"))


@query("registered_table", """
SELECT year(o_orderdate) AS year, count(*) AS n, count(CASE WHEN year(o_orderdate) >= 1996 THEN o_orderstatus END) AS with_status,
  CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS total FROM orders GROUP BY ALL
""")
def registered_table(spark, d):
    """A catalog table over partitions that were written with two versions of the columns."""
    path, name = folder(spark, "table"), f"orders_{uuid.uuid4().hex[:12]}"
    rows = B.table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    rows.filter("year < 1996").select("o_orderkey", "o_totalprice", "year").write.partitionBy("year").parquet(path)
    files.register_table(spark, name, path)
    later = rows.filter("year >= 1996").select("o_orderkey", "o_totalprice", "o_orderstatus", "year")
    later.write.mode("append").partitionBy("year").parquet(path)
    found = files.register_table(spark, name, path)
    return found.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderstatus").alias("with_status"),
        F.sum(F.col("o_totalprice").cast("decimal(28,6)")).cast("double").alias("total"))
