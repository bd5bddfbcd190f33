"""Pipeline health from metrics, alarms, logs, capture tasks and file times.

All look-backs end at ``as_of``, a parameter, so a run can be repeated.  The tables the
model is wired with (pipelines, components, services) are a few fixed rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rules import freshness_of, ladder, name_in, rank_in, worst_of
from ..functions.values import compact_message, log_level

_COMPONENT_SCHEMA = (
    "pipeline_id string, position int, component string, area string, signal string, "
    "is_freshness boolean, role string"
)


def components(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(K.PIPELINE_COMPONENTS), _COMPONENT_SCHEMA)


def _as_of(as_of) -> Column:
    """``as_of`` as a timestamp: a Column stays, text is read as UTC."""
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _before(as_of, minutes: int) -> Column:
    return _as_of(as_of) - F.make_dt_interval(mins=F.lit(minutes))


def latest_metric(
    metrics: DataFrame, as_of, keys: tuple[str, ...] = ("resource", "metric", "stat"),
    minutes: int = K.METRIC_LOOKBACK_MINUTES,
) -> DataFrame:
    """The newest datapoint of each metric within the look-back."""
    recent = metrics.filter((F.col("ts") >= _before(as_of, minutes)) & (F.col("ts") <= _as_of(as_of)))
    return recent.groupBy(*keys).agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
    )


def minutes_text(minutes: Column) -> Column:
    return F.when(minutes >= 120, F.format_string("%.1fh", minutes / 60.0)).otherwise(
        F.concat(F.rint(minutes).cast("bigint").cast("string"), F.lit("m"))
    )


def seconds_text(seconds: Column) -> Column:
    shown = F.concat(F.rint(seconds).cast("bigint").cast("string"), F.lit("s"))
    return F.coalesce(shown, F.lit("n/a"))


def duration_text(millis: Column) -> Column:
    return F.when(millis >= 1000, F.format_string("%.1fs", millis / 1000.0)).otherwise(
        F.concat(F.rint(millis).cast("bigint").cast("string"), F.lit("ms"))
    )


def freshness(files: DataFrame, targets: DataFrame, as_of) -> DataFrame:
    """Health of each expected dataset from its newest file.

    ``targets`` has ``dataset`` and ``target_minutes``; a dataset without files is down.
    """
    newest = files.groupBy("dataset").agg(F.max("mtime").alias("last_success_at"))
    lag = F.greatest(
        F.lit(0.0),
        (F.unix_micros(_as_of(as_of)) - F.unix_micros("last_success_at")) / 60e6,
    )
    return (
        targets.join(newest, "dataset", "left")
        .withColumn("lag", F.when(F.col("last_success_at").isNotNull(), lag))
        .withColumn("status", freshness_of(F.col("lag"), F.col("target_minutes")))
        .withColumn("lag_minutes", F.bround("lag", 2))
        .withColumn(
            "detail",
            F.when(
                F.col("lag").isNull(),
                F.concat(F.lit("No recent objects were found under "), "dataset", F.lit(".")),
            ).otherwise(
                F.concat(
                    F.lit("Latest successful object under "), "dataset", F.lit(" arrived "),
                    minutes_text(F.col("lag")), F.lit(" ago."),
                )
            ),
        )
        .drop("lag")
    )


def _task_state(status: Column) -> Column:
    word = F.lower(F.coalesce(status, F.lit("unknown")))
    return (
        F.when(word.isin("running", "starting", "ready"), "healthy")
        .when(word.isin("stopping", "modifying", "moving"), "warning")
        .when(word == "stopped", "degraded")
        .otherwise("down")
    )


def service_signals(latest: DataFrame, services: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Health, resource, last success and detail of each service.

    ``services``: ``signal``, ``kind`` (cdc, stream, delivery, function), ``name`` (blank
    when not configured), ``label``, ``timeout_ms``, ``required``.  ``latest``: newest
    datapoints by ``resource`` (the service name).  ``tasks``: ``task_id, status,
    stop_reason``.  A missing metric reads as 0, thus healthy; ``missing`` counts them.
    """
    names = {
        "src": "CDCLatencySource", "tgt": "CDCLatencyTarget",
        "age": "GetRecords.IteratorAgeMilliseconds",
        "wthr": "WriteProvisionedThroughputExceeded", "inc": "IncomingRecords",
        "fresh": "DeliveryToS3.DataFreshness", "ok": "DeliveryToS3.Success",
        "runs": "Invocations", "errors": "Errors", "dur": "Duration", "thr": "Throttles",
    }
    wide = latest.groupBy("resource").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(a) for a, m in names.items()],
        *[F.max(F.when(F.col("metric") == m, F.col("ts"))).alias(f"{a}_at") for a, m in names.items()],
    )
    joined = services.join(wide, services["name"] == wide["resource"], "left").drop("resource")
    if tasks is not None:
        states = tasks.select(
            F.col("task_id").alias("_task"), F.lower("status").alias("task_status"), "stop_reason"
        )
        joined = joined.join(states, F.col("name") == F.col("_task"), "left").drop("_task")
    else:
        joined = joined.withColumn("task_status", F.lit(None).cast("string")).withColumn(
            "stop_reason", F.lit(None).cast("string")
        )

    def number(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0))

    def whole(name: str) -> Column:
        return F.rint(number(name)).cast("bigint").cast("string")

    runs, errors, thr = number("runs"), number("errors"), number("thr")
    rate = F.when(runs > 0, errors / F.greatest(runs, F.lit(1.0))).otherwise(0.0)
    failing = (
        F.when((runs > 0) & (errors >= runs) & (errors >= 1), "down")
        .when((errors >= 5) | (rate >= 0.25), "degraded")
        .when(errors >= 1, "warning")
        .otherwise("healthy")
    )
    throttled = F.when(thr >= 3, "down").when(thr >= 1, "degraded").otherwise("healthy")
    ratio = F.when(F.col("timeout_ms") > 0, number("dur") / F.col("timeout_ms")).otherwise(0.0)
    written = number("wthr")
    write_limited = (
        F.when(written >= 50, "down").when(written >= 10, "degraded")
        .when(written > 0, "warning").otherwise("healthy")
    )
    kind, unset = F.col("kind"), F.coalesce(F.col("name"), F.lit("")) == ""
    status = (
        F.when(unset, F.when(F.col("required"), "down").otherwise("healthy"))
        .when(
            kind == "cdc",
            worst_of(
                _task_state(F.col("task_status")),
                ladder(F.greatest(number("src"), number("tgt")), 60, 300, 900),
            ),
        )
        .when(
            kind == "stream",
            worst_of(ladder(number("age") / 1000.0, 30, 120, 300), write_limited),
        )
        .when(kind == "delivery", ladder(number("fresh"), 300, 900, 1800))
        .otherwise(worst_of(failing, throttled, ladder(ratio, 0.6, 0.8, 0.95)))
    )
    state = F.coalesce("task_status", F.lit("unknown"))
    task_detail = F.concat_ws(
        " ",
        F.concat("label", F.lit(" is "), state, F.lit(".")),
        F.when(
            F.col("src").isNotNull() | F.col("tgt").isNotNull(),
            F.concat(
                F.lit("source latency "), seconds_text(F.col("src")),
                F.lit("; target latency "), seconds_text(F.col("tgt")), F.lit("."),
            ),
        ),
        F.nullif(F.trim("stop_reason"), F.lit("")),
    )
    detail = (
        F.when(unset, F.concat("label", F.lit(" is not configured.")))
        .when(kind == "cdc", task_detail)
        .when(
            kind == "stream",
            F.concat(
                F.lit("Kinesis iterator age is "), seconds_text(number("age") / 1000.0),
                F.lit("; write throttles: "), whole("wthr"),
                F.lit("; incoming records: "), whole("inc"), F.lit("."),
            ),
        )
        .when(
            kind == "delivery",
            F.concat(
                F.lit("Firehose S3 freshness is "), seconds_text(F.col("fresh")),
                F.lit("; successful delivery datapoints: "), whole("ok"), F.lit("."),
            ),
        )
        .otherwise(
            F.concat(
                "label", F.lit(" ran "), whole("runs"), F.lit(" time(s) with "), whole("errors"),
                F.lit(" error(s), "), whole("thr"), F.lit(" throttle(s), and average duration "),
                duration_text(number("dur")), F.lit("."),
            )
        )
    )

    def newest(*columns: str) -> Column:
        return F.greatest(*[F.col(c) for c in columns])

    at = (
        F.when(kind == "cdc", newest("src_at", "tgt_at"))
        .when(kind == "stream", newest("age_at", "inc_at"))
        .when(kind == "delivery", newest("fresh_at", "ok_at"))
        .otherwise(newest("runs_at", "dur_at"))
    )
    needed = {
        "cdc": ("src", "tgt"), "stream": ("age", "wthr", "inc"),
        "delivery": ("fresh", "ok"), "function": ("runs", "errors", "dur", "thr"),
    }
    missing = reduce(
        lambda chain, item: chain.when(
            kind == item[0],
            reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in item[1]]),
        ),
        needed.items(),
        F.when(F.lit(False), 0),
    )
    prefix = (
        F.when(kind == "cdc", "dms").when(kind == "stream", "kinesis")
        .when(kind == "delivery", "firehose").otherwise("lambda")
    )
    return joined.select(
        "signal",
        status.alias("status"),
        F.when(unset & (kind == "function"), "")
        .otherwise(F.concat_ws(":", prefix, F.when(unset, "unconfigured").otherwise(F.col("name"))))
        .alias("resource"),
        at.alias("last_success_at"),
        detail.alias("detail"),
        F.coalesce(missing, F.lit(0)).alias("missing"),
        (unset & F.col("required")).alias("unconfigured"),
    )


def active_alarms(
    alarms: DataFrame,
    prefix: str = "",
    task_ids: dict[str, str] | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Alarms in state ALARM, one row per pipeline they concern (none: one shared row).

    ``task_ids`` maps ``public`` and ``finance`` to capture task ids, ``names`` service
    kinds to resource names.
    """
    tasks, names = task_ids or {}, names or {}
    low = F.lower("name")

    def has(*words: str) -> Column:
        return reduce(lambda a, b: a | b, [low.contains(w) for w in words])

    rules, resources = [], []
    for which, pipeline in (("finance", "finance-pipeline"), ("public", "employee-pipeline")):
        if tasks.get(which):
            rules.append((has(tasks[which].lower()), (pipeline,)))
    for which in ("public", "finance"):
        if tasks.get(which):
            resources.append((has(tasks[which].lower()), f"dms:{tasks[which]}"))
    rules += [
        (has("finance"), ("finance-pipeline",)),
        (has("forecast", "prediction", "-ml-"), ("forecast-pipeline",)),
        (has("anomaly"), ("anomaly-pipeline",)),
        (has("kinesis", "firehose", "transform"), ("employee-pipeline", "finance-pipeline")),
        (has("live-api"), ("forecast-pipeline", "anomaly-pipeline")),
    ]
    resources += [
        (has("kinesis"), f"kinesis:{names.get('stream', '')}"),
        (has("firehose"), f"firehose:{names.get('delivery', '')}"),
        (has("transform"), f"lambda:{names.get('transform', '')}"),
        (has("ml", "forecast", "prediction"), f"lambda:{names.get('ml', '')}"),
        (has("anomaly"), f"lambda:{names.get('anomaly', '')}"),
        (has("live-api"), f"lambda:{names.get('live_api', '')}"),
    ]

    def first(pairs, wrap) -> Column:
        chain = F.when(pairs[0][0], wrap(pairs[0][1]))
        for rule, value in pairs[1:]:
            chain = chain.when(rule, wrap(value))
        return chain

    routed = first(rules, lambda ids: F.array(*[F.lit(i) for i in ids]))
    severity = (
        F.when(has("pipeline-health", "anomaly"), "critical")
        .when(has("errors", "failed", "latency"), "high")
        .otherwise("medium")
    )
    label = reduce(
        lambda chain, item: chain.when(F.col("pipeline_id") == item[0], item[1]),
        K.PIPELINES,
        F.when(F.lit(False), ""),
    ).otherwise("Shared platform")
    text = F.coalesce(
        F.nullif("description", F.lit("")), F.nullif("reason", F.lit("")),
        F.concat("name", F.lit(" is in ALARM")),
    )
    return (
        alarms.filter((F.col("state") == "ALARM") & F.col("name").startswith(prefix))
        .withColumn("severity", severity)
        .withColumn("resource", first(resources, F.lit))
        .withColumn("resource", F.coalesce("resource", F.concat(F.lit("cloudwatch:"), low)))
        .withColumn("pipeline_id", F.explode_outer(routed))
        .select(
            F.concat_ws(":", "name", F.coalesce("pipeline_id", F.lit("shared"))).alias("alarm_id"),
            "pipeline_id",
            label.alias("pipeline_name"),
            "name",
            "severity",
            text.alias("summary"),
            "resource",
            F.col("updated_at").alias("triggered_at"),
        )
    )


def order_alarms(alarms: DataFrame) -> DataFrame:
    """Most severe first, then oldest."""
    return alarms.orderBy(
        rank_in(K.SEVERITIES, F.col("severity")).desc(), "triggered_at", "alarm_id"
    )


def _elevated(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("message").rlike("|".join(K.LOG_WORDS)))


def log_summary(logs: DataFrame, services: DataFrame, as_of) -> DataFrame:
    """Per service: elevated lines of the last 15 minutes (shown up to 50), and level and
    text of the newest one of the last 240.  ``services`` lists the expected ones."""
    newest = F.struct("ts", "message")
    per = (
        _elevated(logs)
        .filter((F.col("ts") >= _before(as_of, K.LOG_LOOKBACK_MINUTES)) & (F.col("ts") <= _as_of(as_of)))
        .groupBy("service")
        .agg(
            F.count_if(F.col("ts") >= _before(as_of, K.LOG_WINDOW_MINUTES)).alias("_n"),
            F.max(newest).alias("_last"),
        )
    )
    text = F.coalesce(compact_message(F.col("_last.message")), F.lit("No recent elevated logs."))
    text = F.when(F.col("_last").isNull(), "No recent elevated logs.").otherwise(text)
    return services.select("service").join(per, "service", "left").select(
        "service",
        log_level(text).alias("level"),
        F.least(F.coalesce("_n", F.lit(0)), F.lit(K.LOG_COUNT_CAP)).alias("count_15m"),
        text.alias("latest_message"),
        F.col("_last.ts").alias("updated_at"),
    )


def recent_errors(
    logs: DataFrame, routes: DataFrame, as_of, k: int = K.RECENT_ERRORS, tie: str = "message"
) -> DataFrame:
    """The newest elevated lines of each pipeline.

    ``routes`` maps ``service`` to ``pipeline_id``.  A service shows at most its own
    newest ``k``, so lines are limited per service before they meet the pipelines.
    """
    def newest(key: str) -> Column:
        return F.row_number().over(
            W.partitionBy(key).orderBy(F.desc("ts"), F.desc(tie), "service")
        )

    lines = (
        _elevated(logs)
        .filter((F.col("ts") >= _before(as_of, K.LOG_LOOKBACK_MINUTES)) & (F.col("ts") <= _as_of(as_of)))
        .withColumn("_n", newest("service"))
        .filter(F.col("_n") <= k)
    )
    return (
        lines.join(routes, "service")
        .withColumn("position", newest("pipeline_id"))
        .filter(F.col("position") <= k)
        .select(
            "pipeline_id", "position", "service", F.col("ts").alias("timestamp"),
            compact_message(F.col("message")).alias("summary"),
        )
    )


def error_lines(logs: DataFrame, service: str, k: int = K.LOG_DETAIL_CAP) -> DataFrame:
    """The newest ERROR lines of one service."""
    return (
        logs.filter((F.col("service") == service) & F.col("message").contains("ERROR"))
        .orderBy(F.desc("ts"), "message")
        .limit(k)
    )


def pipeline_health(
    fresh: DataFrame, signals: DataFrame, alarms: DataFrame, errors: DataFrame
) -> DataFrame:
    """One row per pipeline: statuses by role, worst of all, alarms, last times, summary.

    The serving route counts as a component but not in the roll-up.  ``impacted_resources``
    lists the first component, those that are not healthy, and up to ``LIST_LIMIT`` resources of
    alarms, the most severe and then the oldest first.
    """
    spark = fresh.sparkSession
    of_data = fresh.select(
        F.col("dataset").alias("signal"), "status",
        F.concat(F.lit("dataset:"), "dataset").alias("resource"), "last_success_at", "detail",
        F.lit(0).alias("missing"), "lag_minutes", "target_minutes",
    )
    of_service = signals.select(
        "signal", "status", "resource", "last_success_at", "detail", "missing",
        F.lit(None).cast("double").alias("lag_minutes"),
        F.lit(None).cast("int").alias("target_minutes"),
    )
    parts = (
        components(spark)
        .join(of_data.unionByName(of_service), "signal", "left")
        .withColumn("_gap", F.col("status").isNull())
        .withColumn("status", F.coalesce("status", F.lit("down")))
        .filter("role <> 'serving' OR coalesce(resource, '') <> ''")
        # A component without telemetry is down and listed, though nobody knows its resource.
        .withColumn("resource", F.coalesce("resource", F.lit(K.NO_RESOURCE)))
        .withColumn("detail", F.coalesce("detail", F.concat("component", F.when(
            F.col("is_freshness"), K.NO_OBJECTS).otherwise(K.NO_TELEMETRY))))
    )
    role, rank = F.col("role"), rank_in(K.HEALTH_STATUSES, F.col("status"))

    def role_rank(name: str) -> Column:
        return F.coalesce(F.max(F.when(role == name, rank)), F.lit(0)).alias(name)

    shown = F.sort_array(
        F.collect_list(F.struct("position", "component", "area", "status", "resource", "detail"))
    )
    feeds = ~F.col("signal").isin("stream", "delivery", "live_api")
    own = (role != "source") | ~F.col("is_freshness")
    per = parts.groupBy("pipeline_id").agg(
        role_rank("source"), role_rank("processing"), role_rank("delivery"),
        F.max(F.when(feeds & own, F.col("last_success_at"))).alias("last_success_at"),
        F.max(F.when(role == "delivery", F.col("lag_minutes"))).alias("lag_minutes"),
        F.max(F.when(role == "delivery", F.col("target_minutes"))).alias("target_minutes"),
        F.sum(F.coalesce("missing", F.lit(0))).alias("missing_metrics"),
        F.count_if("_gap").alias("missing_signals"),
        shown.alias("components"),
    )
    severity = rank_in(K.SEVERITIES, F.col("severity"))
    by_resource = alarms.filter("pipeline_id IS NOT NULL").groupBy("pipeline_id", "resource").agg(
        F.count("*").alias("n"),
        F.max(severity).alias("_severity"),
        F.min("triggered_at").alias("_first"),
        F.max("triggered_at").alias("_at"),
    )
    order = F.struct((-F.col("_severity")).alias("s"), "_first", "resource")
    alarm_facts = by_resource.groupBy("pipeline_id").agg(
        F.sum("n").alias("alarm_count"),
        F.max(F.when(F.col("_severity") == 3, 3).otherwise(2)).alias("_alarm"),
        F.max("_at").alias("_alarm_at"),
    )
    place = F.row_number().over(W.partitionBy("pipeline_id").orderBy(F.desc("_severity"), "_first", "resource"))
    named = by_resource.withColumn("_n", place).filter(F.col("_n") <= K.LIST_LIMIT).groupBy("pipeline_id").agg(
        F.transform(F.sort_array(F.collect_list(order)), lambda a: a.resource).alias("_alarm_resources"))
    error_facts = errors.groupBy("pipeline_id").agg(
        F.max("timestamp").alias("_error_at"), F.min_by("summary", "position").alias("_error")
    )
    names = spark.createDataFrame(list(K.PIPELINES), "pipeline_id string, name string")
    joined = (
        names.join(per, "pipeline_id", "left")
        .join(alarm_facts, "pipeline_id", "left")
        .join(named, "pipeline_id", "left")
        .join(error_facts, "pipeline_id", "left")
        .fillna({"alarm_count": 0, "_alarm": 0, "_error": ""})
        .withColumn("_worst", F.greatest("source", "processing", "delivery", "_alarm"))
    )
    status = name_in(K.HEALTH_STATUSES, F.col("_worst"))
    facts = F.concat_ws(
        "; ",
        F.when(F.col("alarm_count") > 0, F.concat(F.col("alarm_count").cast("string"), F.lit(" active alarm(s)"))),
        F.when(
            F.col("lag_minutes").isNotNull(),
            F.concat(
                F.lit("freshness lag "), F.rint("lag_minutes").cast("bigint").cast("string"),
                F.lit("m against a "), F.col("target_minutes").cast("string"), F.lit("m target"),
            ),
        ),
        F.nullif(F.regexp_replace("_error", r"\.+$", ""), F.lit("")),
    )
    body = F.coalesce(F.nullif(facts, F.lit("")), F.lit("recent telemetry indicates degraded health"))
    summary = F.when(
        status == "healthy",
        F.concat("name", F.lit(" is healthy and operating inside its expected freshness targets.")),
    ).otherwise(F.concat("name", F.lit(" is "), status, F.lit(". "), body, F.lit(".")))
    listed = F.col("components")
    unhealthy = F.filter(
        listed,
        lambda c, i: (c.resource != "") & ((i == 0) | (c.status != "healthy")),
    )
    impacted = F.array_distinct(
        F.concat(
            F.transform(unhealthy, lambda c: c.resource),
            F.coalesce("_alarm_resources", F.array().cast("array<string>")),
        )
    )
    return joined.select(
        "pipeline_id",
        "name",
        status.alias("overall_status"),
        *[name_in(K.HEALTH_STATUSES, F.col(r)).alias(f"{r}_status") for r in ("source", "processing", "delivery")],
        name_in(K.HEALTH_STATUSES, F.col("delivery")).alias("freshness_status"),
        "last_success_at",
        F.greatest("_error_at", "_alarm_at").alias("last_failure_at"),
        "alarm_count",
        F.col("_error").alias("recent_error_summary"),
        summary.alias("summary"),
        impacted.alias("impacted_resources"),
        listed,
        "missing_metrics",
        ((F.col("missing_signals") > 0)).alias("partial_data"),
    )


def health_overview(pipelines: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts by status, a warning counting as degraded, optionally per group."""
    status = F.col("overall_status")
    return pipelines.groupBy(*keys).agg(
        F.count("*").alias("total_pipelines"),
        F.count_if(status == "healthy").alias("healthy"),
        F.count_if(status.isin("warning", "degraded")).alias("degraded"),
        F.count_if(status == "down").alias("down"),
        F.sum("alarm_count").alias("active_alarms"),
    )


def pipeline_view(
    pipelines: DataFrame, group: str = "all", status: str = "all", query: str = "",
    order: str = "severity", group_column: str = "pipeline_group",
) -> DataFrame:
    """Pipelines by group, status and name part, ordered by severity or name."""
    rows = pipelines
    if group != "all":
        rows = rows.filter(F.col(group_column) == group)
    if status != "all":
        rows = rows.filter(F.col("overall_status") == status)
    if query.strip():
        rows = rows.filter(F.contains(F.lower("name"), F.lit(query.strip().lower())))
    orders = {
        "severity": [rank_in(K.HEALTH_STATUSES, F.col("overall_status")).desc(), F.asc("name")],
        "name-asc": [F.asc("name")],
        "name-desc": [F.desc("name")],
    }
    return rows.orderBy(*orders[order])


def signal_warnings(fresh: DataFrame, signals: DataFrame) -> DataFrame:
    """What is missing: signals without any row, and services that are not configured."""
    wired = components(fresh.sparkSession).select("signal").distinct()
    seen = fresh.select(F.col("dataset").alias("signal")).unionByName(signals.select("signal"))
    absent = wired.join(seen, "signal", "left_anti").select(
        "signal", F.concat(F.lit("No telemetry for "), "signal", F.lit(".")).alias("warning")
    )
    return absent.unionByName(
        signals.filter("unconfigured").select("signal", F.col("detail").alias("warning"))
    )


def with_group(
    pipelines: DataFrame, prefixes: dict[str, str], default: str, column: str = "pipeline_group"
) -> DataFrame:
    """Add a pipeline's group, told by the prefix of its id unless it has one."""
    told = reduce(
        lambda chain, item: chain.when(F.col("pipeline_id").startswith(item[0]), item[1]),
        prefixes.items(),
        F.when(F.lit(False), ""),
    ).otherwise(default)
    own = F.nullif(column, F.lit("")) if column in pipelines.columns else F.lit(None).cast("string")
    return pipelines.withColumn(column, F.coalesce(own, told))
