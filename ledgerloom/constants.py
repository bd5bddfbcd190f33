"""Fixed values.

These word lists, field priorities, thresholds and labels decide results, so they
are stated here as plain data and nowhere else.
"""

# --- record fields, in priority order -----------------------------------------
EMPLOYEE_ID_FIELDS = ("employee_id", "emp_id", "staff_id", "person_id", "id")
EMPLOYEE_DATE_FIELDS = (
    "hire_date", "start_date", "date", "event_time", "event_timestamp",
    "timestamp", "datetime", "created_at", "updated_at",
)
TERMINATION_FIELDS = ("termination_date", "terminated_at", "end_date", "resignation_date")
STATUS_FIELDS = ("employment_status", "status", "state")
TRANSACTION_ID_FIELDS = ("transaction_id", "txn_id", "id", "entry_id")
AMOUNT_FIELDS = ("amount", "transaction_amount", "value", "total", "net_amount")
HINT_FIELDS = ("transaction_type", "type", "category", "entry_type", "direction")
CATEGORY_FIELDS = ("category", "transaction_type", "type", "entry_type")
VENDOR_FIELDS = (
    "merchant", "merchant_name", "vendor", "vendor_name",
    "supplier", "payee", "counterparty", "description",
)
DEPARTMENT_FIELDS = ("department", "dept", "team", "division")
STANDARD_TIME_FIELDS = ("timestamp", "created_at", "updated_at", "datetime", "date")

# Date priorities differ by consumer.  "fallback" says what stands in for a record
# without a usable date field; "undated" says whether such a record is kept.
FINANCE_PROFILES = {
    "job": {
        "dates": ("transaction_date", "event_time", "event_timestamp", "date",
                  "datetime", "timestamp", "created_at", "updated_at"),
        "fallback": ("path", "mtime"),
        "undated": False,
    },
    "api": {
        "dates": ("transaction_date", "event_time", "event_timestamp", "date",
                  "datetime", "timestamp", "created_at", "updated_at"),
        "fallback": ("mtime",),
        "undated": False,
    },
    "ui": {
        "dates": ("transaction_date", "event_time", "event_timestamp", "timestamp",
                  "datetime", "date", "created_at", "updated_at"),
        "fallback": (),
        "undated": True,
    },
    "live": {
        "dates": ("transaction_date", "txn_ts", "event_time", "event_timestamp",
                  "timestamp", "datetime", "date"),
        "fallback": (),
        "undated": True,
    },
}

# --- words --------------------------------------------------------------------
REVENUE_WORDS = ("revenue", "income", "credit", "sale", "sales", "deposit", "inflow", "received")
EXPENDITURE_WORDS = (
    "expense", "expenditure", "debit", "cost", "purchase", "withdrawal", "outflow", "payment",
)
TRUE_WORDS = ("true", "1", "yes", "y", "active", "employed")
FALSE_WORDS = ("false", "0", "no", "n", "inactive", "terminated")
ACTIVE_STATUS_WORDS = ("active", "employed", "current")
INACTIVE_STATUS_WORDS = ("inactive", "terminated", "left", "resigned")

# --- change-data routing ------------------------------------------------------
INTERNAL_TABLE_PREFIX = "awsdms_"
FINANCE_SCHEMA = "finance"
FINANCE_TABLES = ("transactions", "accounts")
PUBLIC_SCHEMAS = ("public", "")
INTERNAL_PUBLIC_TABLES = (
    "awsdms_status", "awsdms_history", "awsdms_apply_exceptions", "awsdms_suspended_tables",
)

# --- forecasting --------------------------------------------------------------
FORECAST_FEATURES = (
    "lag_1", "lag_7", "lag_14", "rolling_mean_7", "rolling_mean_14", "day_of_week", "month",
)
FOREST_TREES = 160
FOREST_DEPTH = 8
FOREST_MIN_LEAF = 2
MODEL_SEED = 42
MAX_LAG = 14
MIN_TRAINING_ROWS = 7
MIN_HISTORY_POINTS = MAX_LAG + MIN_TRAINING_ROWS
FORECAST_DAYS = 60
# Accepted mean absolute error, root mean squared error and mean percentage error of a week ahead.
FORECAST_LIMITS = {
    "employee_headcount": (3.0, 4.0, 3.0), "revenue": (80.0, 90.0, 5.0), "expenditure": (50.0, 60.0, 5.0)}

# --- anomaly detection --------------------------------------------------------
ISOLATION_TREES = 150
ISOLATION_SAMPLE = 256
CONTAMINATION = 0.08
TRANSACTION_FEATURES = (
    "amount", "daily_total", "transaction_count",
    "rolling_mean_7", "rolling_deviation_7", "day_of_week",
)
DAILY_FEATURES = (
    "daily_total", "transaction_count", "rolling_mean_7", "rolling_deviation_7", "day_of_week",
)
MIN_TRANSACTION_ROWS = 20
MIN_DAILY_ROWS = 14
MAX_ANOMALIES = 200
DOCUMENT_VERSION = "2.0"
ISOLATION_MODEL = "IsolationForest"
FOREST_MODEL = "RandomForestRegressor"
NO_FINANCE_ROWS = "No usable finance timestamps and amounts were available."
SHORT_FINANCE_HISTORY = "Not enough finance history to train IsolationForest safely."
# (records but none usable, no records at all); %s is where they were looked for
NO_EMPLOYEE_SERIES = (
    "Employee records exist but missing usable IDs/timestamps.", "No employee records found under %s.")
NO_FINANCE_SERIES = (
    "Finance files exist but no usable amount/timestamp records were found.", "No finance records found under %s.")
SHORT_SERIES = "Need at least %d daily points for %s; found %d."
SERIES_AREAS = {
    "employee_headcount": "employees", "revenue": "finance_revenue", "expenditure": "finance_expenditure"}
SNAPSHOT_FIELDS = 12

# --- anomaly review -----------------------------------------------------------
REVIEW_STATUSES = ("new", "investigating", "reviewed", "confirmed", "false_positive", "resolved")
REVIEWED_STATUSES = ("reviewed", "confirmed", "false_positive", "resolved")
REVIEW_ACTIONS = {
    # action: (status, message)
    "mark_reviewed": ("reviewed", "Marked as reviewed"),
    "mark_false_positive": ("false_positive", "Marked as false positive"),
    "mark_confirmed": ("confirmed", "Marked as confirmed"),
    "mark_investigating": ("investigating", "Marked as investigating"),
    "mark_resolved": ("resolved", "Marked as resolved"),
    "propose_edit": ("investigating", "Proposed data edit"),
    "quarantine_record": ("investigating", "Proposed quarantine"),
    "exclude_from_analytics": ("reviewed", "Excluded from analytics"),
    "soft_drop_record": ("investigating", "Proposed soft drop"),
    "drop_record": ("investigating", "Proposed soft drop"),
}
REVIEW_SYNONYMS = {
    "mark_as_reviewed": "mark_reviewed",
    "mark_as_false_positive": "mark_false_positive",
    "mark_as_confirmed": "mark_confirmed",
    "quarantine": "quarantine_record",
    "soft_drop": "soft_drop_record",
    "drop": "soft_drop_record",
    "drop_from_analytics": "soft_drop_record",
}
AUDIT_LIMIT = 100
NOTES_LIMIT = 50
LIST_LIMIT = 200

# --- pipeline health ----------------------------------------------------------
HEALTH_STATUSES = ("healthy", "warning", "degraded", "down")       # rank = position
SEVERITIES = ("low", "medium", "high", "critical")                 # rank = position
LOG_WORDS = ("ERROR", "Error", "Exception", "WARN", "Warning", "FATAL")
ERROR_LINE_WORDS = ("ERROR", "Error", "FATAL")
METRIC_LOOKBACK_MINUTES = 180
LOG_LOOKBACK_MINUTES = 240
LOG_WINDOW_MINUTES = 15
LOG_COUNT_CAP = 50
LOG_DETAIL_CAP = 20
RECENT_ERRORS = 5
FRESHNESS_TARGETS = {"employees": 15, "finance": 15, "predictions": 90, "anomalies": 180}
PIPELINES = (
    ("employee-pipeline", "Employee pipeline"),
    ("finance-pipeline", "Finance pipeline"),
    ("forecast-pipeline", "Forecast pipeline"),
    ("anomaly-pipeline", "Anomaly pipeline"),
)
NO_RESOURCE = "unavailable"
NO_TELEMETRY = " has no recent telemetry."
NO_OBJECTS = " has no recent successful objects."
# (pipeline, position, component, area, signal, is_freshness, role in the roll-up)
PIPELINE_COMPONENTS = (
    ("employee-pipeline", 1, "PostgreSQL public CDC", "Source", "cdc_public", False, "source"),
    ("employee-pipeline", 2, "Kinesis ingest stream", "Ingestion", "stream", False, "source"),
    ("employee-pipeline", 3, "Firehose delivery stream", "Ingestion", "delivery", False, "source"),
    ("employee-pipeline", 4, "Transform Lambda", "Processing", "transform", False, "processing"),
    ("employee-pipeline", 5, "Trusted employees dataset", "Delivery", "employees", True, "delivery"),
    ("finance-pipeline", 1, "Finance schema CDC", "Source", "cdc_finance", False, "source"),
    ("finance-pipeline", 2, "Kinesis ingest stream", "Ingestion", "stream", False, "source"),
    ("finance-pipeline", 3, "Firehose delivery stream", "Ingestion", "delivery", False, "source"),
    ("finance-pipeline", 4, "Transform Lambda", "Processing", "transform", False, "processing"),
    ("finance-pipeline", 5, "Trusted finance dataset", "Delivery", "finance", True, "delivery"),
    ("forecast-pipeline", 1, "Trusted employees input", "Source", "employees", True, "source"),
    ("forecast-pipeline", 2, "Trusted finance input", "Source", "finance", True, "source"),
    ("forecast-pipeline", 3, "ML forecast Lambda", "Processing", "ml", False, "processing"),
    ("forecast-pipeline", 4, "Predictions dataset", "Delivery", "predictions", True, "delivery"),
    ("forecast-pipeline", 5, "Live API forecasts route", "Serving", "live_api", False, "serving"),
    ("anomaly-pipeline", 1, "Predictions input", "Source", "predictions", True, "source"),
    ("anomaly-pipeline", 2, "Anomaly Lambda", "Processing", "anomaly", False, "processing"),
    ("anomaly-pipeline", 3, "Anomalies dataset", "Delivery", "anomalies", True, "delivery"),
    ("anomaly-pipeline", 4, "Live API anomalies route", "Serving", "live_api", False, "serving"),
)
# (alarm, statistic, threshold, consecutive five-minute periods, part of the composite)
ALARM_RULES = (
    ("iterator-age", "max", 60000.0, 2, True),
    ("write-throttle", "sum", 10.0, 2, True),
    ("delivery-freshness", "max", 900.0, 1, True),
    ("transform-errors", "sum", 5.0, 1, True),
    ("transform-duration", "avg", 240000.0, 2, False),
    ("forecast-errors", "sum", 3.0, 1, True),
    ("anomaly-errors", "sum", 3.0, 1, True),
    ("anomaly-duration", "avg", 780000.0, 2, False),
    ("public-cdc-latency-target", "max", 300.0, 2, True),
    ("finance-cdc-latency-target", "max", 300.0, 2, True),
)
# Days of actuals shown next to a forecast of the given horizon.
ACTUAL_DAYS_BY_HORIZON = {7: 14, 30: 30, 90: 60}

# --- what a tenant's expression may contain ----------------------------------------
EXPRESSION_FUNCTIONS = frozenset(
    "abs round floor ceil sqrt power mod greatest least coalesce nullif ifnull nvl if lower upper trim ltrim rtrim "
    "length substring substr left right concat replace contains startswith endswith cast try_cast date to_date year "
    "month day dayofweek date_trunc date_add date_sub datediff current_date isnull isnotnull".split()
)
EXPRESSION_WORDS = frozenset(
    "and or not in is null true false between like ilike rlike case when then else end as asc desc nulls first last "
    "distinct from string int bigint double date timestamp boolean decimal interval".split()
)
