"""Streams with state: headcount changes, partial figures, alarm states, reviews."""

from __future__ import annotations

import bisect
import json
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import constants as K
from ..functions.values import exact, money_sum
from ..operators.reviews import normalize_actions
from ..operators.spend import expenses, spend_window
from .ingest import state_on_disk


#: The last event of one employee's day; ``who`` is the place of the employee in the bucket's list.
_LAST = np.dtype([("who", "<i4"), ("day", "<i4"), ("micros", "<i8"), ("seq", "<i8"), ("active", "?")])
#: Buckets of employees that share a state.
BUCKETS = 8192


def _last_of_days(rows: np.ndarray) -> np.ndarray:
    """The last row of every employee and day, in order; of equal times and numbers, the later row."""
    rows = rows[np.lexsort((rows["seq"], rows["micros"], rows["day"], rows["who"]))]
    last = np.ones(len(rows), bool)
    last[:-1] = (rows["who"][1:] != rows["who"][:-1]) | (rows["day"][1:] != rows["day"][:-1])
    return rows[last]


def _daily_changes(days: np.ndarray) -> np.ndarray:
    """Change of the active state on each day of ``_last_of_days``."""
    changes = days["active"].astype(np.int32)
    same = days["who"][1:] == days["who"][:-1]
    changes[1:] -= days["active"][:-1] & same
    return changes


def _moved(before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The days of ``after`` whose change is another than ``before``, and by how much."""
    moved = _daily_changes(after)
    place = [days["who"].astype(np.int64) << 32 | days["day"].astype(np.int64) + (1 << 31) for days in (before, after)]
    moved[np.searchsorted(place[1], place[0])] -= _daily_changes(before)  # no day is ever forgotten
    return after[moved != 0], moved[moved != 0]


def headcount_changes(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Changes of the active set: their sums per day are those of the batch job.

    State is the last event of every day of an employee.  A batch may bring events of any
    age; it emits what its events add to or take from the changes of the days they touch,
    so the sums do not depend on how files fall into batches.

    Employees share a state by the hash of their id, as a call of Python costs more than the
    days of some dozen employees; a batch reads and writes the states of the buckets it
    touches.  More ``buckets`` are for many more employees than a million; a stream keeps the
    number it began with.  An unknown state counts as active, events without a time are an error.
    """
    state_on_disk(events.sparkSession)
    micros = F.unix_micros(F.col("event_ts").cast("timestamp"))
    untold = F.raise_error(F.lit("an event has no time")).cast("bigint")
    rows = events.select(
        F.pmod(F.xxhash64("company_id", "employee_id"), F.lit(buckets)).cast("int").alias("bucket"),
        "company_id", "employee_id",
        F.datediff(F.to_date("event_ts"), F.lit("1970-01-01").cast("date")).alias("day"),
        F.when(micros.isNull(), untold).otherwise(micros).alias("micros"),
        F.coalesce(F.col("seq").cast("bigint"), F.lit(-(1 << 63))).alias("seq"),
        F.coalesce("is_active", F.lit(True)).alias("active"))

    def replay(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, kept = state.get if state.exists else ("[]", b"")
        people = {tuple(name): n for n, name in enumerate(json.loads(names))}
        before = after = np.frombuffer(kept, _LAST)
        for batch in batches:  # Arrow hands over a bucket's rows in pieces; a row per day stays of each
            new = np.empty(len(batch), _LAST)
            new["who"] = [people.setdefault(name, len(people)) for name in zip(batch["company_id"], batch["employee_id"])]
            for name in _LAST.names[1:]:
                new[name] = batch[name]
            after = _last_of_days(np.concatenate([after, new]))
        state.update((json.dumps(list(people)), after.tobytes()))
        days, change = _moved(before, after)
        names = np.empty(len(people), object)
        names[:] = list(people)
        company, employee = zip(*names[days["who"]]) if len(days) else ((), ())
        yield pd.DataFrame({"company_id": company, "employee_id": employee, "day": days["day"], "change": change})

    moved = rows.groupBy("bucket").applyInPandasWithState(
        replay,
        "company_id string, employee_id string, day int, change int",
        "people string, days binary",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return moved.select(
        "company_id", "employee_id", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias("date"), "change")


def start_batches(rows: DataFrame, out: str, checkpoint: str, every: str | None = "60 seconds",
                  change: Callable[[DataFrame], DataFrame] | None = None):
    """Write every batch (or what ``change`` makes of it) under its number; a repeated batch replaces its own."""

    def write(batch: DataFrame, epoch: int) -> None:
        (change(batch) if change else batch).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def start_partials(
    rows: DataFrame, partial: Callable[[DataFrame], DataFrame], log: str, checkpoint: str, every: str | None = "60 seconds"
):
    """Write what ``partial`` makes of each batch under the batch's number.

    Partial figures of one window or day from several batches add up when they are read, so
    rows of any age count and every window is there as soon as a row of it has arrived.
    """
    return start_batches(rows, log, checkpoint, every, partial)


def metric_partials(metrics: DataFrame, keys: tuple[str, ...] = ("metric",), minutes: int = 5) -> DataFrame:
    """Exact sum, maximum and count of each metric and tumbling window of a batch."""
    return metrics.groupBy(*keys, F.window("ts", f"{minutes} minutes").alias("_w")).agg(
        F.sum(exact(F.col("value"))).alias("total"), F.max("value").alias("max_value"), F.count("value").alias("n"),
    ).select(*keys, F.col("_w.start").alias("window_start"), "total", "max_value", "n")


def merged_metrics(partials: DataFrame, keys: tuple[str, ...] = ("metric",)) -> DataFrame:
    """Figures as ``metric_windows`` gives them, from the partial ones of all batches."""
    total = F.sum("total").cast("double")
    return partials.groupBy(*keys, "window_start").agg(
        total.alias("sum_value"), (total / F.sum("n")).alias("avg_value"), F.max("max_value").alias("max_value"),
        F.sum("n").alias("n"))


def log_partials(logs: DataFrame) -> DataFrame:
    """Elevated lines of 15 minutes, every 5 minutes, per service, in a batch."""
    return (
        logs.filter(F.col("message").rlike("|".join(K.LOG_WORDS)))
        .groupBy("service", F.window("ts", "15 minutes", "5 minutes").alias("_w"))
        .agg(F.count("*").alias("n"))
        .select("service", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "n")
    )


def merged_logs(partials: DataFrame) -> DataFrame:
    return partials.groupBy("service", "window_start", "window_end").agg(F.sum("n").alias("n"))


def _changed_windows(
    starts: list[int], ends: list[int], arrived: dict[int, bool], periods: int
) -> dict[int, bool]:
    """Whether the alarm is on, for every window that arrived or that an arrival changes.

    ``starts`` and ``ends`` are the runs of breaching windows, in order and apart; they are
    brought up to date.  A window that breaches late joins the runs around it, one that turns
    out not to breach splits its run; only the first windows of the run behind it can change.
    """
    on: dict[int, bool] = {}
    for w in sorted(arrived):
        at = bisect.bisect_right(starts, w) - 1
        was = at >= 0 and w <= ends[at]
        if arrived[w] and not was:
            left = at >= 0 and ends[at] == w - 1
            right = at + 1 < len(starts) and starts[at + 1] == w + 1
            first, last = starts[at] if left else w, ends[at + 1] if right else w
            low, high = at if left else at + 1, at + 2 if right else at + 1
            starts[low:high], ends[low:high] = [first], [last]
            on[w] = w - first + 1 >= periods
            on.update({k: k - first + 1 >= periods for k in range(w + 1, min(last, w + periods - 1) + 1)})
        elif was and not arrived[w]:
            first, last = starts[at], ends[at]
            parts = [(a, b) for a, b in ((first, w - 1), (w + 1, last)) if a <= b]
            starts[at : at + 1], ends[at : at + 1] = [a for a, _ in parts], [b for _, b in parts]
            on[w] = False
            on.update({k: k - w >= periods for k in range(w + 1, min(last, w + periods - 1) + 1)})
        else:
            on[w] = was and w - starts[at] + 1 >= periods
    return on


def alarm_states(
    windows: DataFrame, threshold: float | None = None, periods: int | None = None, minutes: int = 5
) -> DataFrame:
    """State of one rule per metric as its windows arrive, in any order.

    ``windows`` has ``metric``, ``window_start`` and ``value``, and ``threshold`` and ``periods``
    where they are not given, the same for all windows of a metric.  State is the runs of breaching
    windows; a window of any age may arrive, or arrive again with another value (of several in
    one batch the largest counts).  A batch gives the windows that arrived and those whose
    state they changed; the newest row of a window is its state (``current_alarms``).
    """
    width = minutes * 60

    def follow(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        starts, ends = (json.loads(text) for text in state.get) if state.exists else ([], [])
        breaches: dict[int, bool] = {}
        needed = 1
        for batch in batches:
            seconds = (pd.to_datetime(batch["window_start"]) - pd.Timestamp(0)) // pd.Timedelta(seconds=1)
            for number, breach in zip((seconds // width).tolist(), (batch["value"] > batch["threshold"]).tolist()):
                breaches[number] = breaches.get(number, False) or breach
            needed = int(batch["periods"].max())
        on = _changed_windows(starts, ends, breaches, needed)
        state.update((json.dumps(starts), json.dumps(ends)))
        yield pd.DataFrame({
            "metric": key[0], "window_start": [pd.Timestamp(w * width, unit="s") for w in on],
            "state": ["ALARM" if x else "OK" for x in on.values()],
        })

    ruled = windows
    for name, value in (("threshold", threshold), ("periods", periods)):
        ruled = ruled if value is None else ruled.withColumn(name, F.lit(value))
    return ruled.select("metric", "window_start", "value", "threshold", "periods").groupBy("metric").applyInPandasWithState(
        follow,
        "metric string, window_start timestamp, state string",
        "starts string, ends string",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def newest_rows(written: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the last batch that wrote a key; ``written`` has a column ``batch``."""
    last = written.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return written.join(last, [*keys, "batch"], "left_semi").drop("batch")


def current_alarms(written: DataFrame) -> DataFrame:
    """The state of every window, from what the batches of ``alarm_states`` wrote."""
    return newest_rows(written, ["metric", "window_start"])


def review_changes(actions: DataFrame, audit_limit: int = K.AUDIT_LIMIT, notes_limit: int = K.NOTES_LIMIT) -> DataFrame:
    """The reviews that a batch of actions touches, as ``review_state`` folds them.

    State is what a review keeps anyway: its newest audit entries and notes.  Actions of any
    age may come; entries are in the order of ``at`` and ``seq``.
    """
    ids = ["company_id", "anomaly_id"]
    valid = normalize_actions(actions).filter("invalid IS NULL").select(
        *ids, "at", F.col("seq").cast("bigint").alias("seq"), "actor", "action", "status", "message", "note")
    columns = ["at", "seq", "actor", "action", "status", "message", "note"]

    def order(entry: list) -> tuple:
        return entry[0] is not None, entry[0] or 0, entry[1] is not None, entry[1] or 0, [(x is not None, x or "") for x in entry[2:]]

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        audit, notes = (json.loads(text) for text in state.get) if state.exists else ([], [])
        for batch in batches:
            micros = [None if pd.isna(x) else pd.Timestamp(x).value // 1000 for x in batch["at"]]
            rows = batch[columns[1:]].astype(object).where(batch[columns[1:]].notna(), None)
            new = [[at, None if row[0] is None else int(row[0]), *row[1:]] for at, row in zip(micros, rows.itertuples(index=False, name=None))]
            audit = sorted([*audit, *new], key=order)[-audit_limit:]
            notes = sorted([*notes, *(e for e in new if e[6] is not None)], key=order)[-notes_limit:]
        state.update((json.dumps(audit), json.dumps(notes)))
        yield pd.DataFrame([{"company_id": key[0], "anomaly_id": key[1], "audit": json.dumps(audit), "kept_notes": json.dumps(notes)}])

    folded = valid.groupBy(*ids).applyInPandasWithState(
        fold, "company_id string, anomaly_id string, audit string, kept_notes string", "audit string, notes string",
        "append", GroupStateTimeout.NoTimeout)
    entry = "array<array<string>>"

    def entries(column: str, fields: dict[str, int]):
        return F.transform(F.from_json(column, entry), lambda e: F.struct(
            F.timestamp_micros(e[0].cast("bigint")).alias("at"), e[1].cast("bigint").alias("seq"),
            *[e[n].alias(name) for name, n in fields.items()]))

    out = folded.select(
        *ids, entries("audit", {"actor": 2, "action": 3, "status": 4, "message": 5, "note": 6}).alias("audit_trail"),
        entries("kept_notes", {"author": 2, "note": 6, "action": 3}).alias("notes"))
    last = F.element_at("audit_trail", -1)
    return out.withColumns({
        "notes": F.when(F.size("notes") > 0, F.col("notes")), "status": last.getField("status"),
        "last_action": last.getField("action"), "updated_at": last.getField("at"), "updated_by": last.getField("actor"),
    })


def start_reviews(actions: DataFrame, out: str, checkpoint: str, every: str | None = None):
    """Write the reviews each batch touches; no batch reads what earlier ones wrote."""
    state_on_disk(actions.sparkSession)
    return start_batches(review_changes(actions), out, checkpoint, every)


def current_reviews(spark, out: str) -> DataFrame:
    """The newest fold of every anomaly a review stream has written."""
    return newest_rows(spark.read.parquet(out), ["company_id", "anomaly_id"])


def spend_days(rows: DataFrame, span: int = 90) -> DataFrame:
    """Daily spend of the last ``span`` days of every company that a batch touches.

    State is these days, by company, and the number of all expenses; figures look no further
    back, and the last day never moves back.  Amounts are added up exactly, in whole
    millionths; those beyond decimals as doubles.  Expenses without a date, or before the span,
    are in a row without a date.
    """
    amount = F.col("amount")
    fixed = exact(amount)
    spent = expenses(rows).select(
        "company_id", F.datediff("date", F.lit("1970-01-01").cast("date")).alias("day"),
        F.coalesce((fixed * 1_000_000).cast("decimal(38,0)").cast("string"), F.lit("0")).alias("micros"),
        F.when(fixed.isNull(), F.coalesce(amount, F.lit(0.0))).otherwise(0.0).alias("beyond"))

    def added(days: dict, parts) -> None:
        for day, micros, beyond, n in parts:
            old = days.get(day, (0, 0.0, 0))
            days[day] = (old[0] + micros, old[1] + beyond, old[2] + n)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # a company with most of a batch sends a row per day and Arrow batch
            sums: dict = {}
            day = [None if pd.isna(d) else int(d) for d in batch["day"]]
            added(sums, zip(zip(batch["company_id"], day), map(int, batch["micros"]), batch["beyond"], [1] * len(batch)))
            yield pd.DataFrame(
                [(c, d, str(m), b, n) for (c, d), (m, b, n) in sums.items()], columns=["company_id", "day", "micros", "beyond", "n"])

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, total = json.loads(state.get[0]) if state.exists else ([], 0)
        days = {d: (int(m), b, n) for d, m, b, n in known}
        for batch in batches:
            total += int(batch["n"].sum())
            dated = batch[batch["day"].notna()]
            added(days, zip(dated["day"].astype(int), map(int, dated["micros"]), dated["beyond"], dated["n"].astype(int)))
        last = max(days, default=0)
        days = {int(d): v for d, v in days.items() if d > last - span}
        state.update((json.dumps([[[d, str(m), float(b), int(n)] for d, (m, b, n) in sorted(days.items())], total]),))
        rows = [(key[0], d, str(m), float(b), int(n)) for d, (m, b, n) in days.items()]
        rows.append((key[0], None, "0", 0.0, total - sum(n for _, _, n in days.values())))
        out = pd.DataFrame(rows, columns=["company_id", "day", "micros", "beyond", "transactions"])
        out["day"] = out["day"].astype("Int64")
        yield out

    kind = "company_id string, day bigint, micros string, beyond double, "
    parts = spent.mapInPandas(combine, kind + "n bigint")
    kept = parts.groupBy("company_id").applyInPandasWithState(
        follow, kind + "transactions bigint", "days string", "append", GroupStateTimeout.NoTimeout)
    value = (F.col("micros").cast("decimal(38,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,6)").cast("double")
    return kept.select(
        "company_id", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day").cast("int")).alias("date"),
        (value + F.col("beyond")).alias("value"), "transactions")


def start_spend(
    rows: DataFrame, out: str, checkpoint: str, windows: tuple[int, ...] = (7, 30, 90), every: str | None = "60 seconds"
):
    """Refresh the spend figures of the companies whose finance rows arrive.

    A batch computes them from the stream's state of the last days, at most a row per day and
    company; it reads nothing that earlier batches wrote.
    """
    state_on_disk(rows.sparkSession)
    span = max(90, max(windows))

    def write(batch: DataFrame, epoch: int) -> None:
        days = batch.filter("date IS NOT NULL OR transactions > 0").persist()
        try:
            figures = reduce(DataFrame.unionByName, [spend_window(days, n, span=span) for n in windows])
            figures.write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        finally:
            days.unpersist()

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        spend_days(rows, span).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def current_spend(spark, out: str) -> DataFrame:
    """The newest figures of every company and window."""
    return newest_rows(spark.read.parquet(out), ["company_id", "window_days"])


def daily_total_partials(rows: DataFrame) -> DataFrame:
    """Exact daily totals of a batch."""
    return rows.groupBy("company_id", "source_area", F.to_date("event_ts").alias("date")).agg(
        F.sum(exact(F.col("amount"))).alias("total"), F.count("*").alias("n"))


def merged_daily_totals(partials: DataFrame) -> DataFrame:
    return partials.groupBy("company_id", "source_area", "date").agg(
        F.sum("total").cast("double").alias("daily_total"), F.sum("n").alias("transaction_count"))
