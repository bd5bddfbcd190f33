"""Files in all layouts, broken ones, replays; streams equal the batch jobs."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cdc, workforce
from ledgerloom.sources import files, sinks
from ledgerloom.streaming import ingest, stateful


def envelope(table, data, schema="finance"):
    return json.dumps({"metadata": {"schema-name": schema, "table-name": table}, "data": data})


def write_gz(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines))


def test_polyglot_layouts(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": 1}')
    (tmp_path / "many.json").write_text('[{"id": 2}, 5, null, {"id": 3}]')
    (tmp_path / "lines.json").write_text('{"id": 4}\nbroken\n\n[7]\r\n{"id": 5}\n')
    (tmp_path / "blank.json").write_text("  ")
    (tmp_path / "bad.gz").write_bytes(b"this is not gzip")
    write_gz(tmp_path / "ok.gz", ['{"id": 6}', '{"id": 7}'])
    found = files.read_polyglot(spark, str(tmp_path))
    ids = found.select(F.try_variant_get(F.try_element_at("raw", F.lit("id")), "$", "int").alias("i"), "source_file", "source_modified")
    rows = ids.collect()
    assert sorted(r.i for r in rows) == [1, 2, 3, 4, 5, 6, 7]
    assert all(r.source_file.endswith((".json", ".gz")) and r.source_modified for r in rows)


def test_raw_scan_fails_on_corrupt_gzip(spark, tmp_path):
    write_gz(tmp_path / "raw" / "a.gz", ["{}", "x"])
    assert files.read_raw_lines(spark, str(tmp_path / "raw")).count() == 2
    (tmp_path / "raw" / "b.gz").write_bytes(b"this is not gzip")
    with pytest.raises(Exception):
        files.read_raw_lines(spark, str(tmp_path / "raw")).count()


def test_trusted_key(spark):
    key = sinks.trusted_key(F.lit("s3://lake/raw/2026/02/24/part.gz"), F.lit("finance"), F.lit("transactions"), F.lit("acme"))
    assert spark.range(1).select(key).first()[0] == "trusted/acme/finance/transactions/2026/02/24/part.json"


def test_replay_replaces_only_its_own_files(spark, tmp_path):
    def records(name, ids):
        rows = [("acme", f"/raw/2026/02/24/{name}", envelope("transactions", {"id": i})) for i in ids]
        return cdc.clean_lines(spark.createDataFrame(rows, "company_id string, source_file string, line string"))

    out = str(tmp_path / "trusted")
    sinks.write_trusted(records("a.gz", [1, 2]), out)
    sinks.write_trusted(records("b.gz", [3]), out)
    sinks.write_trusted(records("a.gz", [1, 2, 4]), out)
    assert spark.read.parquet(out).count() == 4
    sinks.write_trusted(records("b.gz", [3]).filter("false"), out)
    assert spark.read.parquet(out).count() == 4


def landed(spark, names, day="24", extra=""):
    rows = [("acme", f"/raw/2026/02/{day}/{name}", envelope("transactions", {"id": f"{name}-{k}{extra}"})) for name in names for k in range(2)]
    return cdc.clean_lines(spark.createDataFrame(rows, "company_id string, source_file string, line string"))


def ids_of(spark, path):
    return sorted(json.loads(r.record)["id"] for r in spark.read.parquet(path).collect())


def test_a_thousand_landing_files_make_few_files(spark, tmp_path):
    out = str(tmp_path / "trusted")
    names = [f"f{n}.gz" for n in range(1000)]
    sinks.write_trusted(landed(spark, names), out)
    assert spark.read.parquet(out).count() == 2000 and len(list(tmp_path.glob("trusted/company_id*/**/*.parquet"))) <= 4
    before = ids_of(spark, out)
    sinks.write_trusted(landed(spark, names[:300]), out)  # a replay of some
    assert ids_of(spark, out) == before and len(list(tmp_path.glob("trusted/company_id*/**/*.parquet"))) <= 4
    for n in range(12):
        sinks.write_trusted(landed(spark, [f"later{n}.gz"]), out)
    assert len(ids_of(spark, out)) == 2024
    before = ids_of(spark, out)
    assert sinks.compact_trusted(spark, out, 4) == 1 and ids_of(spark, out) == before
    assert len(list(tmp_path.glob("trusted/company_id*/**/*.parquet"))) <= 4 and sinks.compact_trusted(spark, out, 4) == 0


def test_a_replay_replaces_what_its_batch_wrote_and_no_more(spark, tmp_path):
    out = str(tmp_path / "trusted")
    sinks.write_trusted(landed(spark, ["a.gz", "b.gz"]).unionByName(landed(spark, ["c.gz"], "25")), out)
    sinks.write_trusted(landed(spark, ["a.gz"], extra="x"), out)
    assert ids_of(spark, out) == ["a.gz-0x", "a.gz-1x", "b.gz-0", "b.gz-1", "c.gz-0", "c.gz-1"]
    # The same file, now with rows of another table only: the old partition loses its last row of the batch.
    rows = [("acme", "/raw/2026/02/25/c.gz", envelope("accounts", {"id": "moved"}))]
    sinks.write_trusted(cdc.clean_lines(spark.createDataFrame(rows, "company_id string, source_file string, line string")), out)
    assert ids_of(spark, out) == ["a.gz-0x", "a.gz-1x", "b.gz-0", "b.gz-1", "moved"]


def test_a_write_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "trusted")
    save = sinks._save
    monkeypatch.setattr(sinks, "_save", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.write_trusted(landed(spark, ["a.gz"]), out)  # noted, but not written
    monkeypatch.undo()
    sinks.write_trusted(landed(spark, ["a.gz"]), out)
    assert ids_of(spark, out) == ["a.gz-0", "a.gz-1"]
    # Rows that were written, though the batch was to be written again, do not stay twice.
    save(sinks.with_batch(landed(spark, ["a.gz"])), out, "parquet", "append")
    sinks.write_trusted(landed(spark, ["a.gz"]), out)
    assert ids_of(spark, out) == ["a.gz-0", "a.gz-1"]


def test_run_sink_appends(spark, tmp_path):
    run = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), "{}")], "company_id string, generated_at timestamp, document string")
    sinks.write_run(run, str(tmp_path / "runs"), "r1")
    sinks.write_run(run, str(tmp_path / "runs"), "r2")
    rows = spark.read.parquet(str(tmp_path / "runs"))
    assert {(str(r.run_date), r.run_id) for r in rows.collect()} == {("2026-01-01", "r1"), ("2026-01-01", "r2")}


def test_file_choices(spark):
    rows = spark.createDataFrame(
        [("a", f"f{n}", dt.datetime(2026, 1, 9 - n), n * 10 + k) for n in range(4) for k in range(3)],
        "company_id string, source_file string, source_modified timestamp, v int",
    )
    oldest_keys = files.bounded_files(rows, 2, ["company_id"])
    assert {r.source_file for r in oldest_keys.collect()} == {"f0", "f1"} and oldest_keys.count() == 6
    newest = files.bounded_files(rows, 1, ["company_id"], "mtime_desc")
    assert {r.source_file for r in newest.collect()} == {"f0"}
    assert [r.v for r in files.latest_batch(rows, ["company_id"], 2, [F.desc("v")]).orderBy("v").collect()] == [1, 2]


def test_merged_table_is_registered(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(path)
    spark.range(1).withColumn("extra", F.lit("x")).withColumn("p", F.lit(2)).write.mode("append").partitionBy("p").parquet(path)
    df = files.register_table(spark, "merged_rows", path)
    try:
        assert set(df.columns) == {"id", "extra", "p"} and spark.table("merged_rows").count() == 3
        assert spark.table("merged_rows").filter("extra = 'x'").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS merged_rows")


def ingest_all(spark, root):
    stream = ingest.raw_stream(spark, f"{root}/raw/2026/02/24", 1)
    query = ingest.start_ingest(
        stream, "acme", f"{root}/trusted", f"{root}/rejects", f"{root}/backup", f"{root}/checkpoint", every=None
    )
    query.awaitTermination()
    assert query.exception() is None


def test_ingest_equals_batch_and_goes_on(spark, tmp_path):
    lines = [envelope("transactions", {"id": n, "timestamp": n}) for n in range(5)] + ["broken", envelope("audit", {"id": 1})]
    write_gz(tmp_path / "raw/2026/02/24/one.gz", lines + lines[:2])
    write_gz(tmp_path / "raw/2026/02/24/two.gz", lines[:1] + [envelope("employees", {"id": 9}, "public")])
    ingest_all(spark, tmp_path)
    trusted = lambda: spark.read.parquet(f"{tmp_path}/trusted")
    batch = cdc.clean_lines(
        files.read_raw_lines(spark, f"{tmp_path}/raw/2026/02/24").withColumn("company_id", F.lit("acme"))
    )
    assert sorted(r.record for r in trusted().collect()) == sorted(r.record for r in batch.collect())
    assert trusted().count() == 7 and spark.read.parquet(f"{tmp_path}/rejects").count() == 2
    assert spark.read.json(f"{tmp_path}/backup").count() == 11
    write_gz(tmp_path / "raw/2026/02/24/three.gz", [envelope("accounts", {"id": 1})])
    ingest_all(spark, tmp_path)
    ingest_all(spark, tmp_path)
    assert trusted().count() == 8 and trusted().filter("table = 'accounts'").count() == 1


def test_ingest_parses_a_line_once_and_spreads_a_file(spark, tmp_path, monkeypatch):
    parsed = []
    parse = F.try_parse_json
    monkeypatch.setattr(F, "try_parse_json", lambda c: parsed.append(c) or parse(c))
    lines = [envelope("transactions", {"id": n, "note": "x" * n}) for n in range(120)]
    lines += lines[:30] + ["broken", "broken", "", envelope("audit", {"id": 1}), '{"metadata": {}}', "[1]", "{}"]
    write_gz(tmp_path / "raw/2026/02/24/one.gz", lines)

    def files_of(name):
        return list((tmp_path / name).rglob("part-*"))

    ingest_all(spark, tmp_path)
    assert len(parsed) == 1  # in one batch
    assert len(files_of("backup")) == len(files_of("rejects")) == 1  # few lines are in one file
    rejects = spark.read.parquet(f"{tmp_path}/rejects")
    assert sorted(rejects.columns) == ["batch", "company_id", "line", "reject", "source_file", "source_modified"]
    assert sorted(r.reject for r in rejects.collect()) == [
        "blank_line", "control_record", "empty_record", "malformed_json", "malformed_json", "not_an_object", "unrouted_table"]
    copy = spark.read.json(f"{tmp_path}/backup")
    assert sorted(copy.columns) == ["batch", "company_id", "line", "source_file", "source_modified"]
    assert sorted(r.line for r in copy.collect()) == sorted(lines)
    assert ids_of(spark, f"{tmp_path}/trusted") == list(range(120))

    monkeypatch.setattr(ingest, "LINES", 20, raising=False)
    write_gz(tmp_path / "raw/2026/02/24/two.gz", lines)  # one task reads it, several make what becomes of it
    ingest_all(spark, tmp_path)
    assert len([f for f in files_of("backup") if "batch=1" in str(f)]) > 1
    assert spark.read.json(f"{tmp_path}/backup").count() == 2 * len(lines) and len(ids_of(spark, f"{tmp_path}/trusted")) == 240


def run_batches(spark, df, out, checkpoint):
    def write(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.parquet(out)


def test_copies_across_files_are_dropped_on_demand(spark, tmp_path):
    line = envelope("transactions", {"id": 1})
    write_gz(tmp_path / "in/one.gz", [line, line])
    write_gz(tmp_path / "in/two.gz", [line, envelope("transactions", {"id": 2})])
    lines = ingest.raw_stream(spark, str(tmp_path / "in"), 1).withColumn("company_id", F.lit("a"))
    query = ingest.start_dedupe(ingest.stream_records(lines), str(tmp_path / "out"), str(tmp_path / "cp"), every=None)
    query.awaitTermination()
    assert query.exception() is None and spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_late_files_are_not_lost(spark, tmp_path):
    import os

    for number, day in enumerate((10, 10, 1)):
        path = tmp_path / f"in/{number}.gz"
        write_gz(path, [envelope("transactions", {"id": number}), envelope("transactions", {"id": 0})])
        stamp = dt.datetime(2026, 1, day).timestamp()
        os.utime(path, (stamp, stamp))
    lines = ingest.raw_stream(spark, str(tmp_path / "in"), 1).withColumn("company_id", F.lit("a"))
    query = ingest.start_dedupe(ingest.stream_records(lines), str(tmp_path / "out"), str(tmp_path / "cp"), every=None)
    query.awaitTermination()
    assert query.exception() is None and spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_headcount_stream_follows_batches(spark, tmp_path):
    schema = "company_id string, employee_id string, event_ts timestamp, is_active boolean, seq bigint"
    events = [("a", f"e{n % 5}", dt.datetime(2026, 1, 1 + n // 4, n % 4), n % 3 != 0, n) for n in range(40)]
    for part in (events[20:30], events[30:], events[:20]):  # the oldest come last
        part = spark.createDataFrame(part, schema)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        rows = run_batches(spark, stateful.headcount_changes(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.date: r.c for r in rows.groupBy("date").agg(F.sum("change").alias("c")).filter("c <> 0").collect()}
    batch = workforce.headcount_changes(spark.createDataFrame(events, schema))
    assert got == {r.date: r.change for r in batch.filter("change <> 0").collect()}


def test_alarm_stream_remembers_the_run(spark, tmp_path):
    schema = "metric string, window_start timestamp, value double"
    start = dt.datetime(2026, 1, 1)
    points = [("m", start + dt.timedelta(minutes=5 * n), v) for n, v in ((0, 9.0), (1, 9.0), (2, 1.0), (3, 9.0), (4, 9.0), (6, 9.0))]
    for part in (points[:1], points[1:4], points[4:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        rows = run_batches(spark, stateful.alarm_states(stream, 5.0, 2), str(tmp_path / "out"), str(tmp_path / "cp"))
    on = sorted(r.window_start.minute for r in rows.filter("state = 'ALARM'").collect())
    assert on == [5, 20]


def test_log_counts_slide(spark, tmp_path):
    logs = spark.createDataFrame(
        [("s", dt.datetime(2026, 1, 1, 0, n), "ERROR x" if n % 2 else "fine") for n in range(0, 60, 3)], "service string, ts timestamp, message string"
    )
    logs.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(logs.schema).parquet(str(tmp_path / "in"))
    query = stateful.start_partials(stream, stateful.log_partials, str(tmp_path / "out"), str(tmp_path / "cp"), every=None)
    query.awaitTermination()
    rows = stateful.merged_logs(spark.read.parquet(str(tmp_path / "out")))
    row = rows.filter("window_end = '2026-01-01 00:30:00'").first()
    assert row.n == 3


def test_spend_stream_equals_batch(spark, tmp_path):
    from ledgerloom.operators import finance, spend

    rows = spark.createDataFrame(
        [("a", str(n), dt.datetime(2026, 1, 1 + n % 9), "expenditure", 10.0 * n, "v") for n in range(1, 20)],
        "company_id string, record_id string, event_ts timestamp, source_area string, amount double, vendor string",
    ).withColumn("date", F.to_date("event_ts"))
    for part in rows.randomSplit([0.5, 0.5], 1):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        query = stateful.start_spend(stream, f"{tmp_path}/out", f"{tmp_path}/cp", (7,), None)
        query.awaitTermination()
        assert query.exception() is None
    figures = spark.read.parquet(f"{tmp_path}/out").orderBy(F.desc("batch")).drop("batch").first()
    assert figures == spend.spend_window(spend.daily_spend(rows), 7).first()
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    query = stateful.start_partials(stream, stateful.daily_total_partials, f"{tmp_path}/totals", f"{tmp_path}/cp2", every=None)
    query.awaitTermination()
    totals = stateful.merged_daily_totals(spark.read.parquet(f"{tmp_path}/totals"))
    seen = {(r.company_id, r.date): r.daily_total for r in totals.collect()}
    assert seen == {(r.company_id, r.date): r.daily_total for r in finance.daily_totals(rows).collect()}
