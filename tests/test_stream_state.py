"""Streams that keep state: any order gives the batch result, and no batch reads what earlier ones wrote."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import reviews, spend, workforce
from ledgerloom.streaming import ingest, stateful

from test_files_and_streams import envelope, write_gz


def land(spark, rows, schema, folder, parts, seed=0):
    """Rows in random order as files that land one after the other."""
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    for n in range(parts):
        spark.createDataFrame(rows[n::parts], schema).coalesce(1).write.mode("append").parquet(f"{folder}/p{n}")
    for n in range(parts):
        for file in os.listdir(f"{folder}/p{n}"):
            os.utime(f"{folder}/p{n}/{file}", (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, schema, folder):
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1")
    return reader.parquet(folder)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


# --- alarms -----------------------------------------------------------------------------------
def brute_alarms(windows, periods):
    on, run, last = {}, 0, None
    for w in sorted(windows):
        run = (run if last == w - 1 else 0) + 1 if windows[w] else 0
        on[w], last = run >= periods, w
    return on


@pytest.mark.parametrize("seed", range(30))
def test_runs_join_and_split_in_any_order(seed):
    source = random.Random(seed)
    periods = source.choice([1, 2, 3, 5])
    starts, ends, known, shown = [], [], {}, {}
    for _ in range(40):
        arrived = {source.randrange(60): source.random() < 0.7 for _ in range(source.randrange(1, 6))}
        known.update(arrived)  # a window may come again with another value
        shown.update(stateful._changed_windows(starts, ends, arrived, periods))
        assert shown == brute_alarms(known, periods)
        assert all(a <= b for a, b in zip(starts, ends)) and all(b + 1 < a for b, a in zip(ends, starts[1:]))


def test_late_windows_change_earlier_states(spark, tmp_path):
    schema = "metric string, window_start timestamp, value double"
    start = dt.datetime(2026, 1, 1)
    source = random.Random(4)
    values = {(m, n): float(source.random() < 0.7) * 9 for m in "ab" for n in range(60) if source.random() < 0.9}
    land(spark, [(m, start + dt.timedelta(minutes=5 * n), v) for (m, n), v in values.items()], schema, f"{tmp_path}/in", 5)
    states = stateful.alarm_states(stream(spark, schema, f"{tmp_path}/in"), 5.0, 3)
    finish(stateful.start_batches(states, f"{tmp_path}/out", f"{tmp_path}/cp", None))
    written = spark.read.parquet(f"{tmp_path}/out")
    found = {(r.metric, (r.window_start - start).total_seconds() // 300): r.state == "ALARM" for r in stateful.current_alarms(written).collect()}
    expected = {}
    for metric in "ab":
        expected |= {(metric, n): on for n, on in brute_alarms({n: v > 5 for (m, n), v in values.items() if m == metric}, 3).items()}
    assert found == expected and written.count() > len(found)


# --- reviews ----------------------------------------------------------------------------------
ACTIONS = "company_id string, anomaly_id string, action string, status string, actor string, note string, at timestamp, seq bigint"


def actions(n, seed=0):
    source = random.Random(seed)
    words = ["mark_reviewed", "Mark-as-confirmed", "quarantine", "drop", "nonsense", "mark as false positive"]
    return [("a", f"x{source.randrange(4)}", source.choice(words), source.choice(["", "Resolved", "odd"]), source.choice(["rita", None]),
             source.choice([" ", None, f"note {i}"]), dt.datetime(2026, 1, 1) + dt.timedelta(minutes=source.randrange(500)), i) for i in range(n)]


def plain(rows):
    return sorted((r.asDict(recursive=True) for r in rows), key=lambda r: r["anomaly_id"])


def test_review_stream_equals_the_fold_of_all(spark, tmp_path):
    rows = actions(1100)  # more per anomaly than a review keeps
    land(spark, rows, ACTIONS, f"{tmp_path}/in", 6)
    finish(stateful.start_reviews(stream(spark, ACTIONS, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp"))
    batch = reviews.review_state(spark.createDataFrame(rows, ACTIONS))
    found = stateful.current_reviews(spark, f"{tmp_path}/out").select(*batch.columns)
    assert plain(found.collect()) == plain(batch.collect())
    assert max(len(r.audit_trail) for r in found.collect()) == 100 and max(len(r.notes) for r in found.collect()) == 50


# --- spend ------------------------------------------------------------------------------------
SPENT = "company_id string, record_id string, date date, source_area string, amount double"


def test_spend_stream_with_late_undated_and_old_rows(spark, tmp_path):
    source = random.Random(1)
    rows = [(source.choice("abc"), str(i), source.choice([None, dt.date(2025, 6, 1) + dt.timedelta(days=source.randrange(300))]),
             source.choice(["expenditure", "expenditure", "revenue"]), round(source.uniform(1, 500), 2)) for i in range(600)]
    rows += [("undated", "u", None, "expenditure", 5.0), ("huge", "h", dt.date(2026, 1, 1), "expenditure", 1e30), ("huge", "i", dt.date(2026, 1, 1), "expenditure", 2.5)]
    land(spark, rows, SPENT, f"{tmp_path}/in", 7)
    finish(stateful.start_spend(stream(spark, SPENT, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp", (7, 90), None))
    found = stateful.current_spend(spark, f"{tmp_path}/out")
    daily = spend.daily_spend(spark.createDataFrame(rows, SPENT), undated=True)
    expected = spend.spend_window(daily, 7).unionByName(spend.spend_window(daily, 90))

    def rounded(df):
        return sorted(
            tuple(round(v, 6) if isinstance(v, float) and v < 1e20 else v for v in r)
            for r in df.select(*expected.columns).fillna({"current_total": -1.0, "previous_total": -1.0, "average": -1.0, "peak": -1.0}).collect())

    key = [tuple(map(str, r)) for r in rounded(found)]
    assert key == [tuple(map(str, r)) for r in rounded(expected)] and len(key) == 10


# --- headcount --------------------------------------------------------------------------------
HEADS = "company_id string, employee_id string, event_ts timestamp, is_active boolean, seq bigint"


def test_employees_of_a_bucket_share_a_state(spark, tmp_path):
    source = random.Random(2)
    start = dt.datetime(2025, 12, 20)
    rows = [(source.choice(["a", "b", None]), f"e{source.randrange(300)}", start + dt.timedelta(hours=source.randrange(900)),
             source.choice([True, False, None]), n) for n in range(3000)]
    rows += [("a", f"e{n}", start - dt.timedelta(days=40000), True, -n) for n in range(9)]  # long before 1970
    land(spark, rows, HEADS, f"{tmp_path}/in", 4)
    changes = stateful.headcount_changes(stream(spark, HEADS, f"{tmp_path}/in"), buckets=8)
    query = finish(stateful.start_batches(changes, f"{tmp_path}/out", f"{tmp_path}/cp", None))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 8  # not one for each of some 800 employees
    written = spark.read.parquet(f"{tmp_path}/out")

    def totals(changes, *keys):
        return {(*r,) for r in changes.groupBy(*keys).agg(F.sum("change").alias("c")).filter("c <> 0").collect()}

    batch = workforce.headcount_changes(spark.createDataFrame(rows, HEADS))
    assert totals(written, "company_id", "date") == totals(batch, "company_id", "date")
    single = workforce.headcount_changes(spark.createDataFrame(rows, HEADS), ("company_id", "employee_id"))
    assert totals(written, "company_id", "employee_id", "date") == totals(single, "company_id", "employee_id", "date")


def test_headcount_events_need_a_time(spark, tmp_path):
    land(spark, [("a", "e", None, True, 1)], HEADS, f"{tmp_path}/in", 1)
    query = stateful.start_batches(stateful.headcount_changes(stream(spark, HEADS, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/cp", None)
    with pytest.raises(Exception, match="an event has no time"):
        query.awaitTermination()


# --- what a batch reads -----------------------------------------------------------------------
def bytes_read(spark):
    """Bytes all stages so far have read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway
    stages = store.stageList(
        gateway.jvm.java.util.ArrayList(), False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


BATCHES = 50


def flat(per_batch):
    """The last batches read no more than as many early ones, but for the size of single files."""
    some = min(10, len(per_batch) // 2 - 2)
    first, last = sum(per_batch[2 : 2 + some]), sum(per_batch[-some:])
    return 0 < last <= 1.2 * first


def read_by_batch(spark, lands, start):
    seen = []
    for n in range(BATCHES):
        lands(n)
        before = bytes_read(spark)
        finish(start())
        seen.append(bytes_read(spark) - before)
    return seen


def test_dedupe_reads_only_its_batch(spark, tmp_path):
    def lands(n):
        own = [envelope("transactions", {"id": n * 100 + k, "note": "x" * 200}) for k in range(100)]
        write_gz(tmp_path / f"in/{n}.gz", [*own, envelope("transactions", {"id": n * 50, "note": "x" * 200})])

    def start():
        lines = ingest.raw_stream(spark, f"{tmp_path}/in").withColumn("company_id", F.lit("a"))
        return ingest.start_dedupe(ingest.stream_records(lines), f"{tmp_path}/out", f"{tmp_path}/cp", None)

    assert flat(read_by_batch(spark, lands, start))
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert rows.count() == rows.select("row_hash").distinct().count() == BATCHES * 100


def test_reviews_and_spend_read_only_their_batch(spark, tmp_path):
    def lands(n):
        spark.createDataFrame(actions(40, n), ACTIONS).coalesce(1).write.parquet(f"{tmp_path}/acts/{n}")
        rows = [("a", f"{n}-{k}", dt.date(2026, 1, 1) + dt.timedelta(days=k % 60), "expenditure", 1.5 * k) for k in range(60)]
        spark.createDataFrame(rows, SPENT).coalesce(1).write.parquet(f"{tmp_path}/spent/{n}")

    def review():
        return stateful.start_reviews(stream(spark, ACTIONS, f"{tmp_path}/acts"), f"{tmp_path}/reviews", f"{tmp_path}/cp1")

    seen = []
    for n in range(16):
        lands(n)
        before = bytes_read(spark)
        finish(review())
        finish(stateful.start_spend(stream(spark, SPENT, f"{tmp_path}/spent"), f"{tmp_path}/figures", f"{tmp_path}/cp2", (7,), None))
        seen.append(bytes_read(spark) - before)
    assert flat(seen)
    every = reviews.review_state(spark.createDataFrame([a for n in range(16) for a in actions(40, n)], ACTIONS))
    found = stateful.current_reviews(spark, f"{tmp_path}/reviews")
    assert {(r.anomaly_id, r.updated_at) for r in found.collect()} == {(r.anomaly_id, r.updated_at) for r in every.collect()}
    assert stateful.current_spend(spark, f"{tmp_path}/figures").first().transaction_count == 16 * 60
