"""Plans: what is pushed down, what is read, and where Python runs."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import anomaly, cdc, finance, reviews, spend, tenant
from ledgerloom.plans import bindings as B
from ledgerloom.plans.platform_queries import change_lines
from ledgerloom.sources.sinks import write_trusted

PYTHON_ALLOWED = {"iforest", "anomaly_rows", "forecast", "stream_headcount"}


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "daily_series", "rolling_features", "normalize_finance", "cdc_clean", "headcount", "spend_window", "kpi_metrics",
    "review_state", "anomaly_list", "health_rollup", "alarm_eval", "tenant_select", "run_document", "insight_rows",
])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not re.search(r"PythonUDF|ArrowEvalPython|FlatMapGroups|MapInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_used_columns(spark):
    text = physical(finance.daily_totals(B.lines_finance(spark, SF)))
    read = set(re.findall(r"\b[lpsnr]_[a-z]+", " ".join(re.findall(r"FileScan parquet \[(.*?)\]", text))))
    assert "l_shipdate" in read
    assert not read & {"l_tax", "l_linestatus", "l_quantity", "p_name", "s_acctbal", "n_name"}


def test_copies_are_combined_before_the_shuffle(spark):
    rows = B.orders_finance(spark, SF)
    for df in (finance.daily_totals(rows), spend.recurring_spend(rows), cdc.clean_lines(change_lines(spark, SF))):
        text = physical(df)
        exchange = text.index("Exchange hashpartitioning")
        assert "partial_" in text[exchange:]


def test_line_is_parsed_once(spark):
    lines = spark.createDataFrame([("c", "f", "{}")], "company_id string, source_file string, line string")
    text = physical(cdc.clean_lines(lines))
    assert text.count("parseJson") == 1


def test_ranks_are_limited_before_the_shuffle(spark):
    for df in (
        reviews.review_state(B.review_actions(spark, SF)), finance.recent_rows(B.order_records(spark, SF), tie="transaction_id"),
        reviews.newest_items(reviews.normalize_items(B.items(spark, SF))), spend.unusual_expenses(B.lines_finance(spark, SF)),
    ):
        assert "WindowGroupLimit" in physical(df) and "Partial" in physical(df)


def test_tenant_filter_prunes_partitions(spark, tmp_path):
    records = cdc.clean_lines(change_lines(spark, SF))
    write_trusted(records, str(tmp_path / "trusted"))
    trusted = spark.read.parquet(str(tmp_path / "trusted"))
    text = physical(tenant.tenant_select(trusted, "asia", "record", dataset="transactions"))
    filters = re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)
    assert "company_id" in filters and "domain" in filters and "table" in filters


def test_typed_dates_are_pushed_to_the_scan(spark):
    rows = B.orders_finance(spark, SF).filter(F.col("event_ts") >= "2000-01-01")
    assert "isnotnull(o_orderdate" in physical(rows)


def test_scores_run_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "_CHUNK_ROWS", 20)
    rows = B.orders_finance(spark, SF).filter("company_id = 'asia'")
    split = anomaly.isolation_scores(rows).select("record_id", "raw_score")
    monkeypatch.undo()
    whole = anomaly.isolation_scores(rows).select("record_id", "raw_score")
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
