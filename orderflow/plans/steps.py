"""The publishing steps from raw files to business metrics, each a plain function that runs jobs.

Order and retries belong to whatever schedules them. Each step reads tables, writes tables, logs
the table operation and appends one record of its row counts to the run-metrics log.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date as calendar_day
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orderflow.operators import audit, backfill, clean, gold, quality, review, scd2, versions
from orderflow.schemas import (
    CUSTOMER_COLUMNS,
    CUSTOMERS_RAW,
    ORDERS_RAW,
    PRODUCT_COLUMNS,
    PRODUCTS_RAW,
)
from orderflow.sources import tables
from orderflow.sources.files import CORRUPT_RECORD, read_csv
from orderflow.sources.metric_log import append_records, read_log
from orderflow.sources.staging import observed, observed_rows, stage, stage_counted, staging_scope

DIMENSIONS = {
    "customers": (CUSTOMERS_RAW, "customer_id", CUSTOMER_COLUMNS, clean.clean_customers),
    "products": (PRODUCTS_RAW, "product_id", PRODUCT_COLUMNS, clean.clean_products),
}


@dataclass(frozen=True)
class Lake:
    """Where the tables live, and the parameters one run shares between its steps.

    ``order_buckets`` is for the first load of bronze: its files are then bucketed by order id.
    """

    spark: SparkSession
    database: str
    metrics_path: str
    run_id: str
    pipeline_name: str = "orders"
    as_of: str | None = None
    start_date: str | None = None
    end_date: str | None = None
    order_buckets: int | None = None

    def __post_init__(self) -> None:
        # Pinned once, so that all steps of the run and all their tables agree.
        if self.as_of is None:
            now = self.spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
            object.__setattr__(self, "as_of", now)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def has(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    @property
    def is_backfill(self) -> bool:
        return self.start_date is not None or self.end_date is not None

    def windowed(self, df: DataFrame) -> DataFrame:
        return backfill.in_window(df, self.start_date, self.end_date)

    def window_fields(self) -> dict:
        return {
            "backfill_start_date": self.start_date,
            "backfill_end_date": self.end_date,
            "is_backfill": self.is_backfill,
        }

    def log(self, table: str, operation: str, rows: int) -> None:
        tables.log_operation(
            self.spark, self.name("operations_log"), self.name(table), operation, rows
        )

    def record(self, metric_name: str, fields: dict) -> None:
        append_records(
            self.spark, self.metrics_path, metric_name, [fields], self.pipeline_name, self.run_id
        )

    def step_record(
        self, step: str, started: float, rows_read: int, inputs, target: str,
        rows_quarantined: int = 0, status: str = "success", write_mode: str | None = None,
        rows_written: int = 0, days: frozenset = frozenset(),
    ) -> None:
        """Row accounting of a step, from the writes it made."""
        self.record(
            "step_metrics",
            {
                "step": step, "status": status, "rows_read": rows_read, "rows_written": rows_written,
                "rows_quarantined": rows_quarantined,
                "duration_seconds": time.time() - started,
                "input_path": json.dumps(inputs) if isinstance(inputs, list) else inputs,
                "output_path": target, "write_mode": write_mode, **self.window_fields(),
                "affected_dates": _iso(days),
            },
        )


def _iso(days: frozenset) -> list[str]:
    return sorted(day.isoformat() for day in days if day)


def _step(build: Callable) -> Callable:
    """Drop what a step staged once it is done."""

    @wraps(build)
    def run(*args, **kwargs):
        with staging_scope():
            return build(*args, **kwargs)

    return run


def _operation(outcome: str) -> str:
    return "MERGE" if outcome == "merged" else "WRITE"


def _parsed(lake: Lake, path: str, contract, table: str, batch: str) -> tuple[DataFrame, int]:
    """A raw file parsed once; lines that do not fit are kept as they came, beside the table."""
    feed = stage(read_csv(lake.spark, path, contract))
    bad = feed.filter(F.col(CORRUPT_RECORD).isNotNull()).select(F.col(CORRUPT_RECORD).alias("line"))
    return feed.drop(CORRUPT_RECORD), tables.publish_batch(bad, lake.name(f"{table}_corrupt"), batch)


@_step
def ingest_orders(lake: Lake, path: str, batch: str, step: str = "ingest_orders_bronze") -> str:
    """Merge one raw order file into bronze.

    Rows without an order id are kept in ``orders_unkeyed`` and the text of malformed lines in
    ``orders_corrupt``, one partition per batch.
    """
    started = time.time()
    feed, _ = _parsed(lake, path, ORDERS_RAW, "orders", batch)
    window = lake.windowed(feed)
    normalized, read = stage_counted(versions.normalize_orders(window, lake.as_of))
    unkeyed = tables.publish_unkeyed(normalized, lake.name("orders_unkeyed"), batch)
    keyed = versions.keep_latest(versions.with_key(normalized, "order_id"), "order_id")
    done = tables.publish_upsert(keyed, lake.name("orders_bronze"), buckets=lake.order_buckets)
    lake.log("orders_bronze", _operation(done.outcome), done.rows)
    lake.step_record(
        step, started, read, path, "orders_bronze", write_mode=done.outcome,
        rows_written=done.rows, rows_quarantined=unkeyed, days=done.days,
    )
    return done.outcome


@_step
def ingest_dimensions(lake: Lake, paths: dict[str, str]) -> None:
    started, read = time.time(), 0
    for name, path in paths.items():
        feed, _ = _parsed(lake, path, DIMENSIONS[name][0], name, lake.run_id)
        rows = tables.publish_table(feed, lake.name(f"{name}_bronze"))
        lake.log(f"{name}_bronze", "WRITE", rows)
        read += rows
    lake.step_record(
        "ingest_customers_products_bronze", started, read, list(paths.values()), "bronze",
        rows_written=read,
    )


def check_history(lake: Lake, table: str = "orders_bronze") -> DataFrame:
    return audit.require_operations(lake.table("operations_log"), lake.name(table))


def _replace(lake: Lake, df: DataFrame, table: str, days: set | None) -> tables.Published:
    """The listed days in a backfill, everything otherwise."""
    if days is not None:
        done = tables.publish_dates(df, lake.name(table), days)
    else:
        done = tables.publish_all_dates(df, lake.name(table))
    lake.log(table, "WRITE", done.rows)
    return done


def _days(lake: Lake, *published: str) -> set | None:
    """In a backfill, the window's days in the named tables, from the catalog: a day that lost all
    its rows is rebuilt too."""
    if not lake.is_backfill:
        return None
    low = calendar_day.fromisoformat(lake.start_date) if lake.start_date else calendar_day.min
    high = calendar_day.fromisoformat(lake.end_date) if lake.end_date else calendar_day.max
    found = set()
    for table in filter(lake.has, published):
        found |= tables.stored_days(lake.spark, lake.name(table), "order_date")
    return {day for day in found if day and low <= day <= high}


def _rows_read(done: tables.Published, seen: Observation) -> int:
    """Rows an observed input gave to a publication; one that was skipped has read nothing."""
    return 0 if done.outcome == "skipped" else observed_rows(seen)


@_step
def validate_orders(
    lake: Lake, threshold: float = quality.DEFAULT_THRESHOLD, today: str | None = None,
    summary_path: str | None = None,
) -> DataFrame:
    """Split bronze into validated and quarantined rows; fails after publishing when too many rows
    are invalid. Returns the one-row summary."""
    started = time.time()
    today = today or lake.spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    days = _days(lake, "orders_bronze", "orders_validated", "orders_quarantine")
    bronze = lake.table("orders_bronze")
    if lake.has("orders_unkeyed"):
        unkeyed = lake.table("orders_unkeyed").drop("batch")
        bronze = bronze.unionByName(unkeyed)
        if days is not None:
            dated = lake.windowed(unkeyed).select("order_date").distinct().collect()
            days |= {row[0] for row in dated}
    orders = lake.windowed(bronze)
    # Tagged once; everything below reads the staged rows.
    tagged = stage(
        quality.tag_reasons(
            orders, today,
            lake.table("customers_bronze").select("customer_id"),
            lake.table("products_bronze").select("product_id"),
        )
    )
    summary = stage(quality.summary(tagged, threshold))
    valid = _replace(lake, quality.valid_rows(tagged), "orders_validated", days)
    bad = _replace(lake, quality.quarantined_rows(tagged), "orders_quarantine", days)
    if summary_path:
        tables.write_document(quality.summary_document(summary, orders), summary_path)
    found = summary.collect()[0]
    row = found.asDict()
    counts = dict(row["quarantine_reason_counts"])
    touched = valid.days | bad.days
    lake.record(
        "orders_data_quality",
        {
            **row,
            "invalid_count": row["invalid_rows"],
            "rule_failure_counts": counts,
            "summary_path": summary_path,
            "quarantine_path": lake.name("orders_quarantine"),
            "validated_path": lake.name("orders_validated"),
            **lake.window_fields(),
            "affected_dates": _iso(touched),
        },
    )
    lake.step_record(
        "validate_orders", started, row["total_rows"],
        [lake.name(t) for t in ("orders_bronze", "customers_bronze", "products_bronze")],
        "orders_validated", rows_quarantined=row["invalid_rows"], write_mode=valid.outcome,
        status="success" if row["threshold_passed"] else "failed",
        rows_written=row["valid_rows"], days=touched,
    )
    quality.enforce_threshold(row)
    return lake.spark.createDataFrame([found], summary.schema)


@_step
def build_silver_orders(lake: Lake) -> None:
    started = time.time()
    validated, seen = observed(lake.windowed(lake.table("orders_validated")))
    days = _days(lake, "orders_validated", "orders_silver")
    done = _replace(lake, clean.silver_orders(validated), "orders_silver", days)
    lake.step_record(
        "silver_orders", started, _rows_read(done, seen), "orders_validated", "orders_silver",
        write_mode=done.outcome, rows_written=done.rows, days=done.days,
    )


@_step
def merge_dimensions(lake: Lake, guard: bool = True) -> None:
    """Merge the raw dimensions into the type 2 tables.

    Rows without a key are kept in ``<name>_unkeyed``, one partition per run, and versions older than
    the current one in ``<name>_silver_late``; both count as quarantined.
    """
    started, read, written, apart = time.time(), 0, 0, 0
    for name, (_, key, columns, cleaner) in DIMENSIONS.items():
        bronze, rows = stage_counted(cleaner(lake.table(f"{name}_bronze")))
        read += rows
        apart += tables.publish_unkeyed(bronze, lake.name(f"{name}_unkeyed"), lake.run_id, key)
        prepared = stage(versions.prepare_dimension(bronze, key, columns, lake.as_of))
        done, late = tables.publish_dimension(
            prepared, lake.name(f"{name}_silver"), key, columns, guard
        )
        lake.log(f"{name}_silver", _operation(done.outcome), done.rows)
        written += done.rows
        apart += late
    lake.step_record(
        "silver_customers_products", started, read, ["customers_bronze", "products_bronze"],
        "silver dimensions", rows_written=written, rows_quarantined=apart,
    )


def _decisions(lake: Lake) -> DataFrame:
    if lake.has("orders_review_decisions"):
        return lake.table("orders_review_decisions")
    return lake.spark.createDataFrame([], review.DECISIONS)


@_step
def review_late_orders(lake: Lake, tolerance_hours: int = 24) -> DataFrame:
    """Note bronze orders that came too long after their day, with the decisions made so far.

    The reports leave out what is pending or rejected. Returns the counts per day and status.
    """
    started = time.time()
    bronze, seen = observed(lake.windowed(lake.table("orders_bronze")))
    late = review.late_versions(bronze, tolerance_hours)
    days = _days(lake, "orders_bronze", "orders_review")
    done = _replace(lake, review.review_state(late, _decisions(lake)), "orders_review", days)
    counts = review.status_counts(lake.windowed(lake.table("orders_review"))).collect()
    held = sum(row.orders for row in counts if row.review_status != review.RELEASED)
    lake.step_record(
        "review_late_orders", started, _rows_read(done, seen), "orders_bronze", "orders_review",
        rows_quarantined=held, write_mode=done.outcome, rows_written=done.rows, days=done.days,
    )
    return lake.spark.createDataFrame(
        counts, "order_date date, review_status string, orders long, longest_hours double"
    )


@_step
def decide_late_orders(
    lake: Lake, order_ids: DataFrame, decision: str, batch: str, decided_by: str
) -> set:
    """Release, reject or take back the late versions of the named orders.

    The decisions of a batch are kept in a partition of their own, so that replaying it changes
    nothing. Only the days of these orders change in the review table; they are returned, and are
    what ``build_daily_sales`` and ``build_revenue`` need to publish again.
    """
    started = time.time()
    state = lake.table("orders_review")
    made, rows = stage_counted(
        review.decide(state, order_ids, decision, lake.as_of, decided_by)
    )
    days = {row[0] for row in made.select("order_date").distinct().collect()}
    tables.publish_batch(made.drop("order_date"), lake.name("orders_review_decisions"), batch)
    kept = state.filter(F.col("order_date").isin(*days)).drop("review_status", "decided_at", "decided_by")
    done = tables.publish_dates(review.review_state(kept, _decisions(lake)), lake.name("orders_review"), days)
    lake.log("orders_review", "WRITE", done.rows)
    lake.step_record(
        "decide_late_orders", started, rows, "orders_review", "orders_review",
        write_mode=done.outcome, rows_written=done.rows, days=done.days,
    )
    return days


def _publish_gold(
    lake: Lake, step: str, table: str, build: Callable[[DataFrame], DataFrame], days: set | None
) -> None:
    """Replace the report's dates: the given ones, those of a backfill, or every date it has or had.

    Late orders that have not been released stay out.
    """
    started = time.time()
    source = lake.windowed(lake.table("orders_silver"))
    if days is not None:
        source = source.filter(F.col("order_date").isin(*days))
    silver, seen = observed(source)
    if lake.has("orders_review"):
        silver = review.withhold(silver, lake.table("orders_review"))
    listed = _days(lake, "orders_silver", table) if days is None else days
    done = _replace(lake, build(silver), table, listed)
    lake.step_record(
        step, started, _rows_read(done, seen), "orders_silver", table,
        write_mode=done.outcome, rows_written=done.rows, days=done.days,
    )


@_step
def build_daily_sales(lake: Lake, days: set | None = None) -> None:
    _publish_gold(lake, "gold_daily_sales", "daily_sales_summary", gold.daily_sales, days)


@_step
def build_revenue(lake: Lake, days: set | None = None) -> None:
    customers, products = (
        scd2.current(lake.table(f"{name}_silver")) for name in ("customers", "products")
    )
    _publish_gold(
        lake, "gold_revenue", "revenue_by_category_country",
        lambda silver: gold.revenue_by_category_country(silver, customers, products, sketch=True),
        days,
    )


def collect_gold_metrics(lake: Lake) -> dict:
    """Business and freshness records from the published reports."""
    daily, revenue = lake.table("daily_sales_summary"), lake.table("revenue_by_category_country")
    totals = gold.totals(daily).collect()[0].asDict()
    latest = gold.freshness(lake.table("orders_silver")).collect()[0][0]
    written = gold.last_written(daily).collect()[0][0]
    fresh = {
        "latest_order_date": latest.isoformat() if latest else None,
        "gold_table_last_updated_timestamp": written.isoformat() if written else None,
        "daily_sales_summary_path": lake.name("daily_sales_summary"),
        "revenue_by_category_country_path": lake.name("revenue_by_category_country"),
        **lake.window_fields(),
    }
    top = {
        label: [tuple(row) for row in gold.top_by_revenue(revenue, column).collect()]
        for label, column in (("top_countries", "country"), ("top_categories", "category"))
    }
    metrics = {**totals, **top, **fresh}
    lake.record("gold_sales_metrics", metrics)
    lake.record("freshness_metrics", fresh)
    return metrics


def record_run(lake: Lake) -> dict:
    """Append the run's record, derived from the step records of the run."""
    steps = (
        read_log(lake.spark, lake.metrics_path, "step_metrics")
        .filter(F.col("run_id") == lake.run_id)
        .select("step", "status", "duration_seconds", "timestamp", "record_id")
        .orderBy("timestamp", "record_id")
        .collect()
    )
    failed = [row.step for row in steps if row.status != "success"]
    fields = {
        "status": "failed" if failed else "success",
        "duration_seconds": sum(row.duration_seconds or 0.0 for row in steps),
        "started_at": steps[0].timestamp if steps else None,
        "ended_at": steps[-1].timestamp if steps else None,
        "total_steps": len(steps),
        "successful_steps": len(steps) - len(failed),
        "failed_steps": len(failed),
        "skipped_steps": 0,
        "skipped_steps_list": [],
        "failed_step": failed[0] if failed else None,
        "selected_steps": [row.step for row in steps],
        "backfill_start_date": lake.start_date,
        "backfill_end_date": lake.end_date,
    }
    lake.record("pipeline_runs", fields)
    return fields
