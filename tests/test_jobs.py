"""Jobs end to end: from files to committed runs, with broken files, failures and repeats."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.jobs import anomalies, forecasting, inputs
from ledgerloom.jobs.store import RunStore
from ledgerloom.operators import reviews
from ledgerloom.sources import files

RUN_AT = "2026-03-01T06:00:00Z"


def put(path, text, packed=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())


def day(n, start=dt.date(2026, 1, 1)):
    return (start + dt.timedelta(days=n)).isoformat()


def staff(n):
    return {"id": f"emp-{n + 1}", "updated_at": f"{day(n)}T09:00:00+00:00", "employment_status": "active"}


def sale(n, amount=None, kind="sale"):
    return {"transaction_id": f"t{n + 1}", "transaction_date": day(n), "amount": 1000 + n * 15 if amount is None else amount, "type": kind}


def as_lines(rows):
    return "\n".join(json.dumps(r) for r in rows)


def documents(store, job):
    return {r.company_id: json.loads(r.document) for r in store.documents(job).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return RunStore(spark, f"{tmp_path}/runs")


# --- files and their account ------------------------------------------------------------------
def test_every_file_is_accounted_for(spark, tmp_path):
    root = tmp_path / "trusted"
    put(root / "one.json", '{"id": 1}')
    put(root / "many.json", '[{"id": 2}, 5, null, {"id": 3}]')
    put(root / "lines.json", '{"id": 4}\nbroken\n\n[7]\r\n{"id": 5}\n')
    put(root / "deep/er/ok.json.gz", '{"id": 6}\n{"id": 7}', packed=True)
    put(root / "blank.json", "  \n ")
    put(root / "empty.json", "")
    put(root / "words.json", "no json at all")
    (root / "bad.json.gz").write_bytes(b"this is not gzip")
    (root / "latin.json").write_bytes('{"id": "é"}'.encode("latin-1"))
    put(root / "torn.json.gz", '{"id": 8}\n' * 5000, packed=True)
    (root / "torn.json.gz").write_bytes((root / "torn.json.gz").read_bytes()[:-20])
    (root / "parts.json.gz").write_bytes(gzip.compress(b'{"id": 10}\n') + gzip.compress(b'{"id": 11}'))
    records, account = files.read_accounted(spark, str(root))
    ids = records.select(F.try_variant_get(F.try_element_at("raw", F.lit("id")), "$", "int").alias("i"), "source_modified", "position").collect()
    assert sorted(r.i for r in ids) == [1, 2, 3, 4, 5, 6, 7, 10, 11] and all(r.source_modified for r in ids)
    found = {r.source_file.rpartition("/")[2]: (r.outcome, r.records, r.bad_items) for r in account.collect()}
    assert found == {
        "one.json": ("read", 1, 0), "many.json": ("read", 2, 2), "lines.json": ("read", 2, 2), "ok.json.gz": ("read", 2, 0),
        "blank.json": ("no_records", 0, 0), "empty.json": ("empty", 0, 0), "words.json": ("no_records", 0, 1),
        "bad.json.gz": ("unreadable", 0, 0), "latin.json": ("unreadable", 0, 0), "torn.json.gz": ("unreadable", 0, 0),
        "parts.json.gz": ("read", 2, 0),
    }
    assert {r.bytes for r in account.filter("outcome = 'empty'").collect()} == {0}


def test_large_files_are_read_by_line(spark, tmp_path):
    put(tmp_path / "t/big.json", as_lines([{"id": n} for n in range(400)]) + "\nbroken\n")
    put(tmp_path / "t/small.json", '[{"id": 1000}]')
    records, account = files.read_accounted(spark, f"{tmp_path}/t", whole=1000)
    assert records.count() == 401
    found = {r.source_file.rpartition("/")[2]: (r.outcome, r.records, r.bad_items) for r in account.collect()}
    assert found == {"big.json": ("read", 400, 1), "small.json": ("read", 1, 0)}
    chosen = account.filter("bytes < 1000").select("source_file", F.lit("x").alias("tag"))
    records, account = files.read_accounted(spark, f"{tmp_path}/t", chosen, whole=1000)
    assert {r.tag for r in records.collect()} == {"x"} and account.count() == 1


def test_raw_scan_takes_its_folder_only(spark, tmp_path):
    put(tmp_path / "lake/raw/2026/01/01/a.gz", "{}\nx", packed=True)
    put(tmp_path / "lake/other/b.json", "{}")
    assert files.read_raw_lines(spark, f"{tmp_path}/lake", under="raw/").count() == 2


# --- forecast job -----------------------------------------------------------------------------
def test_raw_files_to_a_committed_forecast(spark, tmp_path, store):
    lines = []
    for n in range(30):
        lines.append({"metadata": {"schema-name": "public", "table-name": "employees"}, "data": staff(n)})
        lines.append({"metadata": {"schema-name": "finance", "table-name": "transactions"}, "data": sale(n)})
    put(tmp_path / "lake/raw/2026/03/01/source.json.gz", as_lines(lines), packed=True)
    inputs.ingest_raw(spark, f"{tmp_path}/lake", "acme", f"{tmp_path}/trusted")
    commit = forecasting.forecast_job(store, lambda: inputs.table_inputs(spark, f"{tmp_path}/trusted"), "r1", RUN_AT, days=7, trees=16)
    assert commit.status == "committed" and commit.attempt == 1
    document = documents(store, "forecast")["acme"]
    assert document["status"] == "ok" and document["schema_version"] == "2.0"
    assert document["rows_processed"] == {"employees": 30, "finance": 30} and document["input_files"] == {"employees": 1, "finance": 1}
    found = {m["metric"]: m for m in document["metrics"]}
    assert sorted(found) == ["employee_headcount", "expenditure", "revenue"]
    for metric in found.values():
        assert metric["status"] == "ok" and metric["model_name"] == "RandomForestRegressor" and metric["rows_used"] == 16
        assert len(metric["features_used"]) == 7 and len(metric["forecast"]) == 7 and len(metric["history"]) == 30
    assert found["employee_headcount"]["history"][-1] == {"date": day(29), "value": 30.0}
    assert [p["date"] for p in found["revenue"]["forecast"]] == [day(n) for n in range(30, 37)]
    points = store.read("forecast", "points", newest=True)
    assert points.filter("step > 0").count() == 21 and points.filter("step > 0 AND model_name IS NULL").count() == 0


def test_companies_of_all_kinds_in_one_run(spark, tmp_path, store):
    root = tmp_path / "trusted"
    put(root / "acme/employees/2026/01/31/a.json", json.dumps([staff(n) for n in range(25)]))
    put(root / "acme/finance/transactions/2026/01/31/a.json.gz", as_lines([sale(n) for n in range(25)]), packed=True)
    put(root / "acme/finance/transactions/2026/01/31/broken.json.gz", "x")
    put(root / "short/finance/transactions/a.json", as_lines([sale(n) for n in range(5)]))
    put(root / "odd/finance/a.json", as_lines([{"note": "nothing to use"}]))
    put(root / "odd/employees/a.json", as_lines([{"name": "no id"}]))
    put(root / "acme/notes/readme.json", "{}")
    companies = spark.createDataFrame([("acme",), ("short",), ("odd",), ("none",)], "company_id string")
    forecasting.forecast_job(store, lambda: inputs.file_inputs(spark, str(root), companies), "r1", RUN_AT, days=3, trees=8)
    found = documents(store, "forecast")
    assert {c: d["status"] for c, d in found.items()} == {"acme": "ok", "short": "partial_data", "odd": "partial_data", "none": "no_input_data"}
    assert found["acme"]["input_files"] == {"employees": 1, "finance": 2} and found["acme"]["unreadable_files"] == {"employees": 0, "finance": 1}
    messages = {(c, m["metric"]): m["message"] for c, d in found.items() for m in d["metrics"]}
    assert messages["acme", "revenue"] is None
    assert messages["short", "revenue"] == "Need at least 21 daily points for RandomForestRegressor; found 5."
    assert messages["odd", "employee_headcount"] == "Employee records exist but missing usable IDs/timestamps."
    assert messages["odd", "revenue"] == "Finance files exist but no usable amount/timestamp records were found."
    assert messages["none", "expenditure"] == "No finance records found under none/finance/."
    assert all(m["forecast"] == [] for c in ("short", "odd", "none") for m in found[c]["metrics"])
    account = {r.source_file.rpartition("/")[2]: r.outcome for r in store.read("forecast", "files").filter("company_id = 'acme'").collect()}
    assert account == {"a.json": "read", "a.json.gz": "read", "broken.json.gz": "unreadable"}


def test_first_files_of_each_company(spark, tmp_path):
    for n in range(4):
        put(tmp_path / f"trusted/acme/finance/transactions/2026/01/0{n + 1}/f.json", as_lines([sale(n)]))
    found = inputs.file_inputs(spark, f"{tmp_path}/trusted", max_files=2)
    assert sorted(r.source_file[-18:] for r in found.files.collect()) == ["/2026/01/01/f.json"[-18:], "/2026/01/02/f.json"[-18:]]
    assert found.records.count() == 2


# --- anomaly job ------------------------------------------------------------------------------
def test_anomalies_to_reviews(spark, tmp_path, store):
    root = tmp_path / "trusted"
    put(root / "acme/finance/transactions/2026/03/01/t.json", as_lines([sale(n, 7000 if n == 19 else 125 + n % 4, "expense") for n in range(28)]))
    put(root / "acme/finance/accounts/2026/03/01/a.json", as_lines([sale(n, 5) for n in range(9)]))
    put(root / "late/finance/accounts/2026/03/09/a.json", as_lines([sale(n, 9000 if n == 10 else 1000) for n in range(18)]))
    put(root / "tiny/finance/transactions/t.json", as_lines([sale(n) for n in range(3)]))
    put(root / "void/finance/transactions/t.json", '{"note": "x"}')

    def read():
        return inputs.file_inputs(spark, str(root), prefer_transactions=True)

    anomalies.anomaly_job(store, read, "r1", RUN_AT)
    found = documents(store, "anomaly")
    acme, late, tiny, void = (found[c] for c in ("acme", "late", "tiny", "void"))
    assert acme["status"] == "ok" and acme["source"] == {"input_files": 1, "unreadable_files": 0, "rows_processed": 28}
    assert acme["metadata"]["mode"] == "transaction" and acme["metadata"]["rows_modeled"] == 28 and acme["metadata"]["scored_groups"] == 1
    assert acme["metadata"]["parameters"] == {"n_estimators": 150, "contamination": 0.08, "random_state": 42}
    top = acme["anomalies"][0]
    assert top["record_id"] == "t20" and top["metrics"]["actual_value"] == 7000.0 and top["audit_trail"] == []
    assert top["features_used"][0] == "amount" and len(top["features_used"]) == 6
    assert json.loads(top["details"]["transaction"])["type"] == "expense" and top["details"]["features"]["day_of_week"] == 1
    assert acme["summary"]["total"] == len(acme["anomalies"]) == sum(acme["summary"]["by_severity"].values()) == sum(acme["summary"]["by_type"].values())
    assert late["metadata"]["mode"] == "daily" and late["source"]["rows_processed"] == 18 and late["status"] == "ok"
    assert late["anomalies"][0]["record_id"] == "revenue-2026-01-11" and late["anomalies"][0]["details"]["record"]["daily_total"] == 9000.0
    assert late["anomalies"][0]["source_table"] == "finance_daily" and len(late["metadata"]["feature_columns"]) == 5
    assert tiny["status"] == "insufficient_data" and tiny["metadata"]["message"].startswith("Not enough finance history") and tiny["metadata"]["rows_modeled"] == 3
    assert void["metadata"] == {**void["metadata"], "mode": "none", "rows_modeled": 0, "records_read": 1, "feature_columns": []}
    assert void["anomalies"] == [] and void["summary"] == {"total": 0, "by_severity": {}, "by_type": {}}

    rows = store.read("anomaly", "anomalies", newest=True).filter("company_id = 'acme'")
    first = rows.orderBy(F.desc("anomaly_score")).first()
    action = spark.createDataFrame(
        [("acme", first.anomaly_id, "mark_reviewed", "", "rita", "Validated.", dt.datetime(2026, 3, 2), 1)],
        "company_id string, anomaly_id string, action string, status string, actor string, note string, at timestamp, seq bigint")
    review = reviews.review_state(action).first()
    assert review.status == "reviewed" and review.audit_trail[0].action == "mark_reviewed" and review.notes[0].note == "Validated."
    before = {r.anomaly_id for r in rows.collect()}
    anomalies.anomaly_job(store, read, "r1", RUN_AT)
    again = store.read("anomaly", "anomalies", run_id="r1").filter("company_id = 'acme'")
    assert {r.anomaly_id for r in again.collect()} == before


# --- the commit point -------------------------------------------------------------------------
def table(spark, n):
    return spark.range(n).select(F.lit("acme").alias("company_id"), F.lit(RUN_AT).cast("timestamp").alias("generated_at"), F.lit("{}").alias("document"))


def test_a_failed_run_leaves_a_record_and_nothing_else(spark, store, tmp_path):
    def broken():
        good = table(spark, 3)
        return {"documents": good, "points": good.withColumn("x", F.raise_error(F.lit("boom")).cast("int"))}

    with pytest.raises(Exception, match="boom"):
        store.run("forecast", "r1", RUN_AT, broken)
    commit = store.run("forecast", "r1", RUN_AT, lambda: 1 / 0, raise_errors=False)
    assert commit.status == "failed" and commit.attempt == 2 and commit.error.startswith("ZeroDivisionError")
    assert store.read("forecast", "documents") is None
    assert not list(tmp_path.glob("runs/documents/**/*.parquet")) and not list(tmp_path.glob("runs/points/**/*.parquet"))
    row = store.documents("forecast").first()
    assert row.company_id is None and json.loads(row.document)["status"] == "failed"


def test_a_repeated_run_replaces_its_result(spark, store):
    store.run("forecast", "r1", RUN_AT, lambda: {"documents": table(spark, 1)})
    store.run("forecast", "r2", "2026-03-02T06:00:00Z", lambda: {"documents": table(spark, 5)})
    store.run("forecast", "r1", RUN_AT, lambda: {"documents": table(spark, 2)})
    store.run("anomaly", "r1", RUN_AT, lambda: {"documents": table(spark, 9)})
    assert store.read("forecast", "documents").count() == 7
    assert store.read("forecast", "documents", run_id="r1").count() == 2
    assert store.read("forecast", "documents", newest=True).count() == 5
    store.run("forecast", "r1", RUN_AT, lambda: 1 / 0, raise_errors=False)
    assert store.read("forecast", "documents", run_id="r1").count() == 2  # the last good result stays
    assert {(r.run_id, r.status, r.attempt) for r in store.runs().filter("job = 'forecast'").collect()} == {("r1", "failed", 3), ("r2", "committed", 1)}


def test_what_is_not_committed_is_not_read(spark, store, tmp_path):
    store.run("forecast", "r1", RUN_AT, lambda: {"documents": table(spark, 1)})
    table(spark, 50).write.parquet(f"{tmp_path}/runs/documents/2026-03-01/forecast-dead-1-0")
    assert store.read("forecast", "documents").count() == 1
