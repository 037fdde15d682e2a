"""Queries over the run-metrics log.

A log frame has the fields of ``schemas.METRIC_LOG`` plus ``recorded_at`` (its parsed timestamp) and
``record_id`` (unique per record, used to order records of the same instant).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.functions.values import as_timestamp, SECONDS
from orderflow.schemas import METRIC_NAMES, METRIC_SCHEMAS

# Limits and severities of the alert rules.
INVALID_PERCENTAGE_LIMIT = 5.0
GOLD_MAX_AGE_SECONDS = 7200
REQUIRED_METRICS = {
    "pipeline_metrics_missing": "pipeline_runs",
    "data_quality_metrics_missing": "orders_data_quality",
    "gold_metrics_missing": "gold_sales_metrics",
}
ROW_COUNTERS = {"rows_read": "read", "rows_written": "written", "rows_quarantined": "quarantined"}
FRESHNESS_FIELDS = ("latest_order_date", "gold_table_last_updated_timestamp")


def _is(metric_name: str) -> Column:
    return F.col("metric_name") == metric_name


def _sort_time() -> Column:
    return F.coalesce(
        F.col("recorded_at"),
        as_timestamp("ended_at"),
        as_timestamp("started_at"),
        F.timestamp_seconds(F.lit(0)),
    )


def _recency(condition: Column) -> Column:
    """Ordering of the records that meet the condition; NULL, hence ignored, for all others."""
    return F.when(condition, F.struct(_sort_time(), F.col("record_id")))


def typed(log: DataFrame, metric_name: str) -> DataFrame:
    """Records of one type with just its own fields."""
    fields = METRIC_SCHEMAS[metric_name].fieldNames()
    return log.filter(_is(metric_name)).select(
        *[name for name in fields if name in log.columns], "recorded_at", "record_id"
    )


def filtered(
    log: DataFrame,
    metric_names: list[str] | None = None,
    run_ids: list[str] | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Records by type, run and inclusive range of UTC days."""
    if metric_names is not None:
        log = log.filter(F.col("metric_name").isin(*metric_names))
    if run_ids is not None:
        log = log.filter(F.col("run_id").isin(*run_ids))
    if first_day is not None:
        log = log.filter(F.col("recorded_at") >= F.lit(first_day).cast("timestamp"))
    if last_day is not None:
        after = F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp")
        log = log.filter(F.col("recorded_at") < after)
    return log


def failures(log: DataFrame) -> DataFrame:
    return log.filter(F.lower("status") == "failed")


def latest_records(log: DataFrame) -> DataFrame:
    """The newest record of every type, whole."""
    newest = F.max_by(F.struct(*log.columns), F.struct(_sort_time(), F.col("record_id")))
    return log.groupBy("metric_name").agg(newest.alias("_newest")).select("_newest.*")


def record_counts(log: DataFrame) -> DataFrame:
    """Records per expected type, zero where there are none."""
    counts = [
        F.struct(F.lit(name).alias("metric_name"), F.count_if(_is(name)).alias("records"))
        for name in METRIC_NAMES
    ]
    return log.agg(F.array(*counts).alias("_counts")).select(F.inline("_counts"))


def run_status(log: DataFrame) -> DataFrame:
    """Final status and duration of every run.

    The last run record decides; without one, a run with any failed record has failed and its
    duration is the sum over its records.
    """
    status = F.lower("status")
    duration = F.col("duration_seconds")
    is_run = _is("pipeline_runs")
    return (
        log.filter(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(
            F.min("pipeline_name").alias("pipeline_name"),
            F.max_by(status, _recency(is_run & status.isNotNull())).alias("_status"),
            F.coalesce(F.bool_or(status == "failed"), F.lit(False)).alias("_failed"),
            F.max_by(duration, _recency(is_run & duration.isNotNull())).alias("_last"),
            F.sum(duration.cast(SECONDS)).alias("_sum"),
        )
        .select(
            "run_id",
            F.coalesce("pipeline_name", F.lit("Unknown")).alias("pipeline_name"),
            F.coalesce(
                F.col("_status"), F.when(F.col("_failed"), "failed").otherwise("unknown")
            ).alias("status"),
            F.coalesce(F.col("_last"), F.col("_sum").cast("double"), F.lit(0.0)).alias(
                "duration_seconds"
            ),
        )
    )


def step_status_counts(log: DataFrame) -> DataFrame:
    return (
        log.filter(_is("pipeline_steps") & F.col("status").isNotNull())
        .groupBy("status")
        .agg(F.count("*").alias("steps"))
    )


def step_durations(log: DataFrame) -> DataFrame:
    """Attempts, mean and longest duration per step."""
    measured = log.filter(_is("pipeline_steps") & F.col("duration_seconds").isNotNull())
    total = F.sum(F.col("duration_seconds").cast(SECONDS)).cast("double")
    return measured.groupBy("step").agg(
        F.count("*").alias("attempts"),
        (total / F.count("*")).alias("mean_seconds"),
        F.max("duration_seconds").alias("longest_seconds"),
    )


def step_rows(log: DataFrame) -> DataFrame:
    """Row counters of every step record in long form."""
    counters = log.filter(_is("step_metrics")).select(
        "run_id", "step", "record_id", *[F.col(c).alias(t) for c, t in ROW_COUNTERS.items()]
    )
    long = counters.unpivot(
        ["run_id", "step", "record_id"], list(ROW_COUNTERS.values()), "row_type", "rows"
    )
    return long.filter(F.col("rows").isNotNull())


def rule_failures(log: DataFrame) -> DataFrame:
    """Failures per rule in the newest quality record, most frequent first."""
    counts = F.coalesce("rule_failure_counts", "quarantine_reason_counts")
    newest = log.agg(F.max_by(counts, _recency(_is("orders_data_quality"))).alias("_counts"))
    exploded = newest.select(F.explode("_counts").alias("rule", "failures"))
    return exploded.orderBy(F.col("failures").desc(), "rule")


def invalid_trend(log: DataFrame) -> DataFrame:
    trend = log.filter(
        _is("orders_data_quality")
        & F.col("recorded_at").isNotNull()
        & F.col("invalid_percentage").isNotNull()
    )
    return trend.select("recorded_at", "run_id", "invalid_percentage").orderBy("recorded_at")


def run_history(log: DataFrame) -> DataFrame:
    """Run records, newest first."""
    return (
        log.filter(_is("pipeline_runs"))
        .select(
            "recorded_at", "record_id", "pipeline_name", "run_id", "status", "duration_seconds",
            "total_steps", "successful_steps", "failed_steps", "skipped_steps", "failed_step",
        )
        .orderBy(F.col("recorded_at").desc_nulls_last(), "record_id")
    )


def _labels(**values: Column) -> Column:
    """Map of the labels that have a value, names ascending."""
    entries = []
    for name in sorted(values):
        entries += [F.lit(name), values[name].cast("string")]
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


def _gauge(name: str, value: Column, record: str = "", **labels: Column) -> Column:
    """A gauge of the row's record, or of the one in the named struct column."""
    common = {"pipeline": F.col(f"{record}pipeline_name"), "run_id": F.col(f"{record}run_id")}
    return F.struct(
        F.lit(name).alias("gauge"),
        _labels(**common, **labels).alias("labels"),
        F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"),
    )


def _run_status_label(record: str = "") -> Column:
    status = F.col(f"{record}status")
    return F.coalesce(F.when(status != "", status), F.lit("unknown"))


def _average_order_value() -> Column:
    computed = F.when(
        F.col("total_orders") > 0, F.round(F.col("total_revenue") / F.col("total_orders"), 2)
    )
    return F.coalesce(F.col("average_order_value"), computed)


def _freshness_seconds(field: str) -> Column:
    return F.unix_micros(as_timestamp(field)) / F.lit(1_000_000.0)


def record_gauges(log: DataFrame) -> DataFrame:
    """Every record as the gauge values it stands for: name, label map, value."""
    status = _run_status_label()
    step = F.col("step")
    runs = [
        _gauge("pipeline_run_status", (status == "success").cast("double"), status=status),
        _gauge("pipeline_run_duration_seconds", F.col("duration_seconds"), status=status),
    ]
    steps = [
        _gauge(
            "pipeline_step_duration_seconds", F.col("duration_seconds"),
            step=step, status=F.col("status"), attempt=F.col("attempt"),
        )
    ]
    rows = [
        _gauge("step_rows", F.col(counter), step=step, row_type=F.lit(row_type))
        for counter, row_type in ROW_COUNTERS.items()
    ]
    quality = [
        _gauge("orders_invalid_count", F.coalesce("invalid_count", "invalid_rows")),
        _gauge("orders_invalid_percentage", F.col("invalid_percentage")),
    ]
    business = [
        _gauge("business_metric", F.col("total_revenue"), metric=F.lit("total_revenue")),
        _gauge("business_metric", F.col("total_orders"), metric=F.lit("total_orders")),
        _gauge("business_metric", _average_order_value(), metric=F.lit("average_order_value")),
    ]
    fresh = [
        F.when(
            as_timestamp(field).isNotNull(),
            _gauge(
                "freshness_timestamp_seconds", _freshness_seconds(field),
                metric=F.lit(field), source=F.col("metric_name"),
            ),
        )
        for field in FRESHNESS_FIELDS
    ]
    by_type = {
        "pipeline_runs": runs,
        "pipeline_steps": steps,
        "step_metrics": rows,
        "orders_data_quality": quality,
        "gold_sales_metrics": business + fresh,
        "freshness_metrics": fresh,
    }
    gauges = F.lit(None)
    for metric_name, values in by_type.items():
        gauges = F.when(_is(metric_name), F.array(*values)).otherwise(gauges)
    return log.select(F.inline(gauges)).filter(F.col("gauge").isNotNull())


def latest_gauges(log: DataFrame) -> DataFrame:
    """Flags for the newest run and quality record, and records per type, from one aggregation."""
    run, quality = _is("pipeline_runs"), _is("orders_data_quality")
    state = log.agg(
        F.max_by(F.struct("pipeline_name", "run_id", "status", "failed_step"), _recency(run)).alias("run"),
        F.max_by(F.struct("pipeline_name", "run_id", "invalid_percentage"), _recency(quality)).alias("quality"),
        *[F.count_if(_is(name)).alias(name) for name in METRIC_NAMES],
    )
    status = _run_status_label("run.")
    failed = _gauge(
        "latest_pipeline_run_failed", (status != "success").cast("double"), "run.",
        status=status, failed_step=F.col("run.failed_step"),
    )
    invalid = _gauge("latest_orders_invalid_percentage", F.col("quality.invalid_percentage"), "quality.")
    counts = [
        F.struct(
            F.lit("metrics_records_total").alias("gauge"),
            F.create_map(F.lit("metric_name"), F.lit(name)).alias("labels"),
            F.col(name).cast("double").alias("value"),
        )
        for name in METRIC_NAMES
    ]
    newest = [F.when(F.col("run").isNotNull(), failed), F.when(F.col("quality").isNotNull(), invalid)]
    return state.select(F.inline(F.array_compact(F.array(*newest, *counts))))


def gauges(log: DataFrame) -> DataFrame:
    """Gauges of every record, and of the newest ones.

    Two scans, each of its own columns: one scan for both would have to shuffle every record.
    """
    return record_gauges(log).unionByName(latest_gauges(log))


def maxima(log: DataFrame) -> DataFrame:
    """One row of panel values: best run status, longest run, worst quality, largest revenue."""
    is_run = _is("pipeline_runs")
    return log.agg(
        F.max(F.when(is_run, (_run_status_label() == "success").cast("int"))).alias("run_status"),
        F.max(F.when(is_run, F.col("duration_seconds"))).alias("duration_seconds"),
        F.max(F.when(_is("orders_data_quality"), F.col("invalid_percentage"))).alias(
            "invalid_percentage"
        ),
        F.max(F.when(_is("gold_sales_metrics"), F.col("total_revenue"))).alias("total_revenue"),
    )


def alerts(log: DataFrame, as_of: str) -> DataFrame:
    """State of every alert rule at ``as_of``, from one aggregation over the log."""
    has_freshness = _is("gold_sales_metrics") | _is("freshness_metrics")
    written = F.max(
        F.when(has_freshness, _freshness_seconds("gold_table_last_updated_timestamp"))
    )
    failed = (_run_status_label() != "success").cast("double")
    quality = _is("orders_data_quality")
    state = log.agg(
        F.max_by(failed, _recency(_is("pipeline_runs"))).alias("_failed"),
        F.max_by(F.coalesce("invalid_percentage", F.lit(0.0)), _recency(quality)).alias("_invalid"),
        (F.unix_micros(F.lit(as_of).cast("timestamp")) / F.lit(1_000_000.0) - written).alias("_age"),
        *[F.count_if(_is(name)).alias(alert) for alert, name in REQUIRED_METRICS.items()],
    )

    def rule(name: str, severity: str, value: Column, firing: Column) -> Column:
        return F.struct(
            F.lit(name).alias("alert"),
            F.lit(severity).alias("severity"),
            F.coalesce(firing, F.lit(False)).alias("firing"),
            value.cast("double").alias("value"),
        )

    rules = [
        rule("pipeline_run_failed", "critical", F.col("_failed"), F.col("_failed") == 1),
        rule(
            "high_invalid_percentage", "warning", F.col("_invalid"),
            F.col("_invalid") > INVALID_PERCENTAGE_LIMIT,
        ),
        rule("gold_stale", "warning", F.col("_age"), F.col("_age") > GOLD_MAX_AGE_SECONDS),
        *[rule(a, "warning", F.col(a), F.col(a) == 0) for a in REQUIRED_METRICS],
    ]
    return state.select(F.inline(F.array(*rules)))
