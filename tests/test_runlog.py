"""Run-metrics queries on a small hand-made log."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderflow.operators import runlog
from orderflow.sources.metric_log import parse_records

# A week of one nightly load (n1 to n4), a load of another pipeline, and a run that died before its
# own record, so that only its steps are known. n2 and n3 ended at the same instant.
RECORDS = [
    dict(timestamp="2025-03-03T02:00:00+00:00", metric_name="pipeline_runs", pipeline_name="nightly", run_id="n1",
         status="success", duration_seconds=120.5),
    dict(timestamp="2025-03-04T02:10:00+00:00", metric_name="pipeline_runs", pipeline_name="nightly", run_id="n2",
         status="failed", failed_step="type", duration_seconds=15.0),
    dict(timestamp="2025-03-04T02:10:00+00:00", metric_name="pipeline_runs", pipeline_name="nightly", run_id="n3",
         status="failed", failed_step="load", duration_seconds=3.5),
    dict(timestamp="2025-03-05T01:00:00+00:00", metric_name="pipeline_runs", pipeline_name="nightly", run_id="n4",
         status="success"),
    dict(timestamp="2025-03-04T12:00:00+00:00", metric_name="pipeline_runs", pipeline_name="adhoc", run_id="a1",
         status=""),
    dict(timestamp="2025-03-05T00:20:00+00:00", metric_name="pipeline_steps", run_id="n4", step="load",
         status="success", duration_seconds=40.0, attempt=1),
    dict(timestamp="2025-03-05T00:30:00+00:00", metric_name="pipeline_steps", run_id="n4", step="type",
         status="success", duration_seconds=20.25, attempt=2),
    dict(started_at="2025-03-06T00:00:00+00:00", metric_name="pipeline_steps", run_id="dead", step="load",
         status="Failed", duration_seconds=6.75, attempt=1),
    dict(metric_name="pipeline_steps", run_id="dead", step="load", status="skipped", attempt=2),
    dict(timestamp="2025-03-03T01:30:00+00:00", metric_name="orders_data_quality", pipeline_name="nightly",
         run_id="n1", invalid_percentage=0.25, invalid_rows=2, rule_failure_counts={"invalid_quantity": 2}),
    dict(timestamp="2025-03-05T00:40:00+00:00", metric_name="orders_data_quality", pipeline_name="nightly",
         run_id="n4", invalid_percentage=7.75, invalid_count=31,
         quarantine_reason_counts={"unknown_product_id": 8, "missing_customer_id": 20, "invalid_quantity": 8}),
    dict(timestamp="2025-03-05T00:20:30+00:00", metric_name="step_metrics", run_id="n4", step="load",
         rows_read=400, rows_written=0),
    dict(timestamp="2025-03-05T00:50:00+00:00", metric_name="gold_sales_metrics", run_id="n4",
         total_revenue=1000.0, total_orders=7, gold_table_last_updated_timestamp="2025-03-05T00:45:00+00:00"),
    dict(timestamp="2025-03-05T00:55:00+00:00", metric_name="freshness_metrics", run_id="n4",
         latest_order_date="2025-03-04", gold_table_last_updated_timestamp="not known"),
]


@pytest.fixture
def log(spark):
    lines = [(json.dumps(record),) for record in RECORDS]
    return parse_records(spark.createDataFrame(lines, "value string"))


def _gauges(frame):
    return {
        (r.gauge, tuple(sorted(r.labels.items()))): r.value for r in frame.collect()
    }


def test_counts_are_zero_filled(log):
    counts = {r.metric_name: r.records for r in runlog.record_counts(log).collect()}
    assert counts == {
        "pipeline_runs": 5, "pipeline_steps": 4, "step_metrics": 1, "orders_data_quality": 2,
        "gold_sales_metrics": 1, "freshness_metrics": 1,
    }
    none = {r.metric_name: r.records for r in runlog.record_counts(log.filter("run_id = 'a1'")).collect()}
    assert sum(none.values()) == none["pipeline_runs"] == 1 and len(none) == 6


def test_latest_uses_fallback_times_and_breaks_ties(log):
    latest = {r.metric_name: (r.run_id, r.attempt) for r in runlog.latest_records(log).collect()}
    assert latest["pipeline_runs"][0] == latest["orders_data_quality"][0] == "n4"
    # The start is all that is known of the dead run's failed step, and it is the latest step.
    assert latest["pipeline_steps"] == ("dead", 1)
    same_time = log.filter("run_id IN ('n2', 'n3')")
    greater = same_time.agg(F.max_by("run_id", "record_id")).first()[0]
    assert runlog.latest_records(same_time).first().run_id == greater


def test_run_status_and_duration(log):
    rows = {
        r.run_id: (r.pipeline_name, r.status, r.duration_seconds) for r in runlog.run_status(log).collect()
    }
    assert rows == {
        "n1": ("nightly", "success", 120.5), "n2": ("nightly", "failed", 15.0), "n3": ("nightly", "failed", 3.5),
        # Its own record has no duration, so that of the steps is summed.
        "n4": ("nightly", "success", 60.25), "a1": ("adhoc", "", 0.0), "dead": ("Unknown", "failed", 6.75),
    }


def test_filters(log):
    assert {r.run_id for r in runlog.failures(log).collect()} == {"n2", "n3", "dead"}
    day = runlog.filtered(log, first_day="2025-03-04", last_day="2025-03-04")
    assert {r.run_id for r in day.collect()} == {"n2", "n3", "a1"}
    assert runlog.filtered(log, first_day="2025-03-05").count() == 7
    some = runlog.filtered(log, metric_names=["pipeline_steps"], run_ids=["n4", "n1"])
    assert some.count() == 2
    assert runlog.typed(log, "pipeline_steps").columns[-2:] == ["recorded_at", "record_id"]


def test_step_views(log):
    assert {r.status: r.steps for r in runlog.step_status_counts(log).collect()} == {
        "Failed": 1, "success": 2, "skipped": 1,
    }
    steps = {r.step: tuple(r)[1:] for r in runlog.step_durations(log).collect()}
    assert steps == {"load": (2, 23.375, 40.0), "type": (1, 20.25, 20.25)}
    assert {r.row_type: r.rows for r in runlog.step_rows(log).collect()} == {"read": 400, "written": 0}


def test_rule_failures_come_from_the_newest_record(log):
    rows = [tuple(r) for r in runlog.rule_failures(log).collect()]
    assert rows == [("missing_customer_id", 20), ("invalid_quantity", 8), ("unknown_product_id", 8)]
    older = runlog.rule_failures(log.filter("run_id = 'n1'")).collect()
    assert [tuple(r) for r in older] == [("invalid_quantity", 2)]


def test_trend_and_history(log):
    trend = runlog.invalid_trend(log).collect()
    assert [(r.run_id, r.invalid_percentage) for r in trend] == [("n1", 0.25), ("n4", 7.75)]
    history = [r.run_id for r in runlog.run_history(log).collect()]
    assert history[:2] == ["n4", "a1"] and set(history[2:4]) == {"n2", "n3"} and history[4:] == ["n1"]


def test_gauges(log):
    gauges = _gauges(runlog.gauges(log))
    n4 = (("pipeline", "nightly"), ("run_id", "n4"))
    only_run = ("run_id", "n4")
    assert gauges[("pipeline_run_status", n4 + (("status", "success"),))] == 1
    assert gauges[("pipeline_run_status", (("pipeline", "adhoc"), ("run_id", "a1"), ("status", "unknown")))] == 0
    assert gauges[("latest_pipeline_run_failed", n4 + (("status", "success"),))] == 0
    assert gauges[("latest_orders_invalid_percentage", n4)] == 7.75
    assert gauges[("orders_invalid_count", n4)] == 31
    assert gauges[("orders_invalid_count", (("pipeline", "nightly"), ("run_id", "n1")))] == 2
    assert gauges[("business_metric", (("metric", "average_order_value"), only_run))] == 142.86
    assert gauges[("step_rows", (("row_type", "quarantined"), only_run, ("step", "load")))] == 0
    assert gauges[("metrics_records_total", (("metric_name", "pipeline_runs"),))] == 5
    fresh = {labels: value for (name, labels), value in gauges.items() if name == "freshness_timestamp_seconds"}
    assert fresh == {
        (("metric", "gold_table_last_updated_timestamp"), only_run, ("source", "gold_sales_metrics")):
            datetime.fromisoformat("2025-03-05T00:45:00+00:00").timestamp(),
        (("metric", "latest_order_date"), only_run, ("source", "freshness_metrics")):
            datetime.fromisoformat("2025-03-04T00:00:00+00:00").timestamp(),
    }
    failed = _gauges(runlog.latest_gauges(log.filter("run_id = 'n2'")))
    assert failed[("latest_pipeline_run_failed", (
        ("failed_step", "type"), ("pipeline", "nightly"), ("run_id", "n2"), ("status", "failed")))] == 1
    assert not any(name == "latest_orders_invalid_percentage" for name, _ in failed)


def test_gauges_read_the_log_twice_at_most(log, tmp_path, spark):
    """Once record by record, and once for all newest records and counts."""
    path = str(tmp_path / "log")
    log.write.parquet(path)
    plan = runlog.gauges(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_maxima(log):
    row = runlog.maxima(log).collect()[0]
    assert tuple(row) == (1, 120.5, 7.75, 1000.0)


def test_alerts(log):
    def state(frame, as_of):
        return {r.alert: (r.firing, r.value) for r in runlog.alerts(frame, as_of).collect()}

    fresh = state(log, "2025-03-05 02:45:00")
    assert fresh["pipeline_run_failed"] == (False, 0.0)
    assert fresh["high_invalid_percentage"] == (True, 7.75)
    assert fresh["gold_stale"] == (False, 7200.0)
    assert state(log, "2025-03-05 02:45:01")["gold_stale"] == (True, 7201.0)
    early = state(log.filter("run_id IN ('n1', 'n2')"), "2025-03-05 00:00:00")
    assert early == {
        "pipeline_run_failed": (True, 1.0),
        "high_invalid_percentage": (False, 0.25),
        "gold_stale": (False, None),
        "pipeline_metrics_missing": (False, 2.0),
        "data_quality_metrics_missing": (False, 1.0),
        "gold_metrics_missing": (True, 0.0),
    }
    nothing = state(log.filter(F.lit(False)), "2025-03-05 00:00:00")
    assert {k for k, v in nothing.items() if v[0]} == {
        "pipeline_metrics_missing", "data_quality_metrics_missing", "gold_metrics_missing",
    }
