"""The registered queries: each operator over the supplied tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow.functions.hashing import record_hash
from orderflow.functions.privacy import mask_customers
from orderflow.operators import (
    audit, backfill, clean, gold, quality, review, runlog, scd2, upsert, versions,
)
from orderflow.plans import testmap as tm
from orderflow.schemas import (
    CUSTOMER_COLUMNS,
    METRIC_SCHEMAS,
    ORDER_COLUMNS,
    ORDERS_RAW,
    PRODUCT_COLUMNS,
    fill_missing,
    schema_report,
)
from orderflow.sources import tables
from orderflow.sources.files import CORRUPT_RECORD, read_csv
from orderflow.sources.metric_log import append_frame, read_log
from orderflow.sources.staging import stage, work_root

Query = Callable[[SparkSession, str], DataFrame]
WINDOW = ("1997-03-01", "1998-02-28")
_registry: dict[str, Query] = {}


def _as_text(df: DataFrame) -> DataFrame:
    """Dates, timestamps and arrays as text, so that two engines hash the same bytes."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(
                F.array_sort(F.map_entries(column)),
                lambda e: F.concat(e["key"], F.lit("="), e["value"]),
            )
            column = F.array_join(pairs, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _query(build: Query) -> Query:
    _registry[build.__name__] = lambda spark, sf_dir: _as_text(build(spark, sf_dir))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_registry)


# Versions and hashes ------------------------------------------------------------------------


@_query
def orders_normalized(spark, d):
    return versions.normalize_orders(tm.orders_feed(spark, d), tm.FIRST_LOAD)


@_query
def order_record_hash(spark, d):
    feed = tm.dirty_feed(spark, d)
    return feed.select("order_id", record_hash(feed, ORDER_COLUMNS).alias("record_hash"))


@_query
def dim_record_hash(spark, d):
    feed = tm.customers_feed(spark, d)
    return feed.select("customer_id", record_hash(feed, CUSTOMER_COLUMNS).alias("record_hash"))


@_query
def dim_initial_load(spark, d):
    return versions.normalize_dimension(tm.products_feed(spark, d), PRODUCT_COLUMNS, tm.FIRST_LOAD)


@_query
def orders_latest(spark, d):
    return versions.keep_latest(
        versions.normalize_orders(tm.orders_feed(spark, d), tm.FIRST_LOAD), "order_id"
    )


@_query
def dim_latest(spark, d):
    """Several versions of a key in one batch collapse to the newest."""
    history = tm.customer_history(spark, d).select(*CUSTOMER_COLUMNS, "source_update_ts")
    return versions.prepare_dimension(history, "customer_id", CUSTOMER_COLUMNS, tm.FIRST_LOAD)


@_query
def missing_columns_filled(spark, d):
    return fill_missing(tm.orders_feed(spark, d).drop("product_id", "quantity", "status"))


@_query
def schema_errors(spark, d):
    feed = tm.orders_feed(spark, d).drop("product_id")
    return schema_report(feed.withColumn("status", F.col("order_id") % 3))


# Merges -------------------------------------------------------------------------------------


@_query
def orders_upsert(spark, d):
    return upsert.upsert(tm.first_orders(spark, d), tm.order_updates(spark, d))


def _stored(prepared: DataFrame) -> DataFrame:
    """Prepared orders as a stored copy without their hashes, which are computed when it is read."""
    return versions.rehashed(stage(prepared.drop("record_hash"))).select(*prepared.columns)


@_query
def orders_changed_rows(spark, d):
    """What a merge would change; the publishing path rewrites only these rows' dates."""
    changes = upsert.changed_rows(tm.first_orders(spark, d), _stored(tm.order_updates(spark, d)))
    return changes.select("order_id", "order_date", "replaced_date", "record_hash")


@_query
def orders_upsert_dates(spark, d):
    return upsert.touched_dates(
        upsert.changed_rows(tm.first_orders(spark, d), _stored(tm.order_updates(spark, d)))
    )


@_query
def orders_upsert_unconditional(spark, d):
    bare = tm.order_updates(spark, d).select(*ORDER_COLUMNS)
    return upsert.upsert_unconditional(tm.first_orders(spark, d), bare)


@_query
def orders_migrate(spark, d):
    bare = tm.first_orders(spark, d).select(*ORDER_COLUMNS)
    return versions.migrate_orders(bare, tm.order_updates(spark, d), tm.SECOND_LOAD)


@_query
def dim_migrate(spark, d):
    bare = tm.customers_feed(spark, d)
    return versions.migrate_dimension(
        bare, tm.customer_updates(spark, d), "customer_id", CUSTOMER_COLUMNS, tm.SECOND_LOAD
    )


@_query
def scd2_merge(spark, d):
    return scd2.scd2_merge(
        tm.customer_versions(spark, d), tm.customer_updates(spark, d), "customer_id"
    )


@_query
def scd2_merge_unguarded(spark, d):
    return scd2.scd2_merge(
        tm.customer_versions(spark, d), tm.customer_updates(spark, d), "customer_id", guard=False
    )


@_query
def scd2_changed_rows(spark, d):
    return scd2.changed_versions(
        tm.customer_versions(spark, d), tm.customer_updates(spark, d), "customer_id"
    )


@_query
def scd2_current(spark, d):
    return scd2.current(tm.customer_history(spark, d))


# Validation ---------------------------------------------------------------------------------


def _bronze_dirty(spark, d):
    """The dirty feed as a stored table, which is what validation reads."""
    return stage(tm.dirty_feed(spark, d))


def _tagged(spark, d):
    return quality.tag_reasons(
        _bronze_dirty(spark, d),
        tm.TODAY,
        tm.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id")),
        tm.table(spark, d, "part").select(F.col("p_partkey").alias("product_id")),
    )


@_query
def quality_reasons(spark, d):
    return _tagged(spark, d)


@_query
def quality_reasons_text_ids(spark, d):
    """Ids that arrive as text, some of them no numbers, against numeric reference ids."""
    orders = _bronze_dirty(spark, d)
    for name in ("order_id", "customer_id", "product_id"):
        text = F.col(name).cast("string")
        orders = orders.withColumn(name, F.when(F.col(name) % 137 == 0, F.concat(F.lit("X"), text)).otherwise(text))
    return quality.tag_reasons(
        orders,
        tm.TODAY,
        tm.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id")),
        tm.table(spark, d, "part").select(F.col("p_partkey").alias("product_id")),
    )


@_query
def quality_reasons_row_only(spark, d):
    return quality.tag_row_reasons(tm.dirty_feed(spark, d), tm.TODAY)


@_query
def invalid_predicate(spark, d):
    return tm.dirty_feed(spark, d).filter(quality.invalid_order(tm.TODAY))


@_query
def valid_orders(spark, d):
    return quality.valid_rows(_tagged(spark, d))


@_query
def quarantined_orders(spark, d):
    return quality.quarantined_rows(_tagged(spark, d))


@_query
def quality_summary(spark, d):
    return quality.summary(_tagged(spark, d))


@_query
def quality_first_reason_counts(spark, d):
    return quality.first_reason_counts(_tagged(spark, d))


@_query
def quality_all_reason_counts(spark, d):
    return quality.all_reason_counts(_tagged(spark, d))


# Silver -------------------------------------------------------------------------------------


@_query
def silver_orders(spark, d):
    return clean.silver_orders(tm.orders_feed(spark, d))


@_query
def silver_summary(spark, d):
    return clean.silver_summary(clean.silver_orders(tm.orders_feed(spark, d)))


@_query
def customers_clean(spark, d):
    return clean.clean_customers(tm.customers_feed(spark, d))


@_query
def products_clean(spark, d):
    return clean.clean_products(tm.products_feed(spark, d))


@_query
def masked_customers(spark, d):
    """Names and addresses of every form, over all customers."""
    key = F.col("customer_id")
    feed = tm.customers_feed(spark, d).withColumns(
        {
            "customer_name": F.when(key % 7 == 0, F.lit(None))
            .when(key % 7 == 1, F.lit("   "))
            .when(key % 7 == 2, F.concat(F.lit("  émile  o "), F.col("customer_name")))
            .otherwise(F.col("customer_name")),
            "email": F.when(key % 6 == 0, F.lit(None))
            .when(key % 6 == 1, F.lit("@no-local-part"))
            .when(key % 6 == 2, F.concat(F.col("customer_name"), F.lit("@")))
            .when(key % 6 == 3, F.concat(F.lit("A@b@"), F.col("customer_name")))
            .when(key % 6 == 4, F.lit("not-an-email"))
            .otherwise(F.col("email")),
        }
    )
    return mask_customers(feed)


@_query
def late_orders(spark, d):
    feed = clean.flag_late(tm.orders_feed(spark, d))
    return feed.select("order_id", "order_date", "source_update_ts", "is_late")


def _review_state(spark, d):
    orders = _stored(tm.first_orders(spark, d))
    return orders, stage(review.review_state(review.late_versions(orders), tm.late_decisions(orders)))


@_query
def late_orders_review(spark, d):
    """Every late order with what was decided about it last."""
    return _review_state(spark, d)[1].drop("source_update_ts")


@_query
def gold_daily_sales_reviewed(spark, d):
    """Daily sales without the late orders that have not been released."""
    orders, state = _review_state(spark, d)
    return gold.daily_sales(review.withhold(clean.silver_orders(orders), state))


# Gold ---------------------------------------------------------------------------------------


def _silver(spark, d):
    return clean.silver_orders(tm.orders_feed(spark, d))


def _stored_silver(spark, d):
    """Silver as a stored table, for reports that read it more than once."""
    return stage(_silver(spark, d))


def _current_dimensions(spark, d):
    return (
        clean.clean_customers(tm.customers_feed(spark, d)),
        clean.clean_products(tm.products_feed(spark, d)),
    )


def _revenue(spark, d):
    return gold.revenue_by_category_country(_silver(spark, d), *_current_dimensions(spark, d))


@_query
def gold_daily_sales(spark, d):
    return gold.daily_sales(_silver(spark, d))


@_query
def gold_revenue(spark, d):
    return _revenue(spark, d)


@_query
def gold_revenue_unmatched(spark, d):
    """Unknown and absent customers and products stay in the report without attributes."""
    silver = clean.silver_orders(tm.dirty_feed(spark, d))
    return gold.revenue_by_category_country(silver, *_current_dimensions(spark, d))


@_query
def gold_revenue_as_of(spark, d):
    return gold.revenue_as_of(
        _stored_silver(spark, d), tm.customer_history(spark, d), tm.product_history(spark, d)
    )


@_query
def orders_as_of_country(spark, d):
    joined = scd2.as_of_join(
        _stored_silver(spark, d), tm.customer_history(spark, d), "customer_id", "order_date", ["country"]
    )
    return joined.select("order_id", "customer_id", "order_date", "total_amount", "country")


@_query
def gold_rollup_category_country(spark, d):
    return gold.rollup_category_country(_revenue(spark, d))


@_query
def gold_distinct_customers(spark, d):
    """Customers over all dates from gold's sketches, held against the exact number."""
    silver, dimensions = _stored_silver(spark, d), _current_dimensions(spark, d)
    stored = stage(gold.revenue_by_category_country(silver, *dimensions, sketch=True))
    estimated = gold.distinct_customers(stored, "country", "category")
    star = silver.join(dimensions[0], "customer_id").join(dimensions[1], "product_id")
    exact = star.groupBy("country", "category").agg(F.count_distinct("customer_id").alias("exact"))
    allowed = F.greatest(F.lit(1.0), F.lit(3 * gold.SKETCH_ERROR) * F.col("exact"))
    return exact.join(estimated, ["country", "category"]).select(
        "country", "category", F.col("exact").alias("customers"),
        (F.abs(F.col("customers") - F.col("exact")) <= allowed).alias("within_bound"),
    )


@_query
def gold_totals(spark, d):
    return gold.totals(gold.daily_sales(_silver(spark, d)))


@_query
def gold_top_countries(spark, d):
    return gold.top_by_revenue(_revenue(spark, d), "country")


@_query
def gold_top_categories(spark, d):
    return gold.top_by_revenue(_revenue(spark, d), "category")


@_query
def freshness(spark, d):
    return gold.freshness(_silver(spark, d))


# Backfill and audit -------------------------------------------------------------------------


@_query
def backfill_window(spark, d):
    return backfill.in_window(tm.dirty_feed(spark, d), *WINDOW)


@_query
def affected_dates(spark, d):
    """Dates whose gold must be rebuilt after all returned orders of the feed were completed."""
    feed = tm.orders_feed(spark, d)
    before = gold.daily_sales(clean.silver_orders(feed))
    return backfill.affected_dates(before, feed.filter(F.col("status") == "returned"))


@_query
def replace_partitions(spark, d):
    """Gold with the window's dates rebuilt from updated orders; emptied dates disappear."""
    before = stage(gold.daily_sales(_silver(spark, d)))
    updates = backfill.in_window(clean.silver_orders(tm.order_updates(spark, d)), *WINDOW)
    sunday = F.dayofweek("order_date") == 1
    moved = F.when(sunday, F.date_add("order_date", 1)).otherwise(F.col("order_date"))
    shifted = updates.withColumn("order_date", moved)
    after = stage(gold.daily_sales(shifted))
    days = backfill.affected_dates(backfill.in_window(before, *WINDOW), after)
    return backfill.replace_dates(before, after, days)


def _operations(spark, d):
    """An operations log: first loads and merges of one table per order status and month."""
    feed = tm.orders_feed(spark, d)
    return feed.groupBy(
        F.concat_ws("_", F.lit("orders"), "status", F.date_format("order_date", "yyyyMM")).alias(
            "table_name"
        ),
        F.when(F.col("order_id") % 10 < 7, "WRITE").otherwise("MERGE").alias("operation"),
    ).agg(F.max("source_update_ts").alias("logged_at"), F.count("*").alias("rows"))


@_query
def history_audit(spark, d):
    return audit.operation_coverage(_operations(spark, d), ("WRITE", "MERGE", "DELETE"))


@_query
def history_missing(spark, d):
    return audit.missing_operations(_operations(spark, d), ("WRITE", "MERGE", "DELETE"))


# Run-metrics log ----------------------------------------------------------------------------


def _brief(log: DataFrame) -> DataFrame:
    return log.select(
        "record_id", "recorded_at", "metric_name", "run_id", "status", "duration_seconds"
    )


@_query
def metrics_filtered(spark, d):
    return _brief(
        runlog.filtered(
            tm.run_log(spark, d),
            metric_names=["pipeline_runs", "step_metrics"],
            run_ids=["1", "2", "3", "5", "8"],
            first_day="2024-01-03",
            last_day="2024-01-20",
        )
    )


@_query
def metrics_failures(spark, d):
    return _brief(runlog.failures(tm.run_log(spark, d)))


@_query
def metrics_latest(spark, d):
    return _brief(runlog.latest_records(tm.run_log(spark, d)))


@_query
def metrics_record_counts(spark, d):
    return runlog.record_counts(tm.run_log(spark, d))


@_query
def metrics_run_status(spark, d):
    return runlog.run_status(tm.run_log(spark, d))


@_query
def metrics_step_status(spark, d):
    return runlog.step_status_counts(tm.run_log(spark, d))


@_query
def metrics_step_duration(spark, d):
    return runlog.step_durations(tm.run_log(spark, d))


@_query
def metrics_step_rows(spark, d):
    return runlog.step_rows(tm.run_log(spark, d))


@_query
def metrics_rule_failures(spark, d):
    return runlog.rule_failures(tm.run_log(spark, d))


@_query
def metrics_invalid_trend(spark, d):
    return runlog.invalid_trend(tm.run_log(spark, d))


@_query
def metrics_run_history(spark, d):
    return runlog.run_history(tm.run_log(spark, d))


@_query
def metrics_gauges(spark, d):
    return runlog.gauges(tm.run_log(spark, d))


@_query
def metrics_maxima(spark, d):
    return runlog.maxima(tm.run_log(spark, d))


@_query
def metrics_alerts(spark, d):
    return runlog.alerts(tm.run_log(spark, d), tm.LOG_AS_OF)


# Files and tables ---------------------------------------------------------------------------


def _scratch(spark, name: str) -> str:
    return f"{work_root(spark)}/orderflow/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@_query
def csv_feed(spark, d):
    """The dirty feed written as CSV files with headers and read by contract."""
    path = _scratch(spark, "feed")
    feed = tm.dirty_feed(spark, d)
    feed.select(*[F.col(name).cast("string") for name in feed.columns]).write.option("header", True).csv(path)
    read = read_csv(spark, path, ORDERS_RAW)
    return read.withColumn("is_corrupt", F.col(CORRUPT_RECORD).isNotNull()).drop(CORRUPT_RECORD)


@_query
def json_log(spark, d):
    """The run log written as JSON lines by type, with a broken copy of some lines, and read back."""
    path = _scratch(spark, "log")
    log = stage(tm.run_log(spark, d))
    fields = {field.name for schema in METRIC_SCHEMAS.values() for field in schema.fields}
    records = log.select(*[name for name in log.columns if name in fields])
    append_frame(records, path)
    broken = log.filter(F.col("rows_written") % 370 == 0).select(
        F.substring(F.to_json(F.struct(*records.columns)), 1, 40).alias("value"), "metric_name"
    )
    broken.write.mode("append").partitionBy("metric_name").text(path)
    return read_log(spark, path).select(
        "metric_name", "recorded_at", "run_id", "status", "step", "attempt", "duration_seconds",
        "rows_read", "invalid_percentage", "quarantine_reason_counts", "total_revenue",
    )


def _monthly(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_month", F.trunc("order_date", "month"))


def _published(spark, d) -> str:
    """A catalog table, bucketed by order and partitioned by month, after two publications."""
    database = f"queries_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(spark, 'tables')}'")
    name = f"{database}.orders"
    for orders in (tm.first_orders(spark, d), tm.order_updates(spark, d)):
        tables.publish_upsert(_monthly(orders), name, date="order_month", buckets=4)
    return name


@_query
def published_upsert(spark, d):
    """The merged table as a reader of the catalog sees it."""
    return spark.table(_published(spark, d)).drop("order_month")


@_query
def published_unconditional(spark, d):
    """Every update forced into the published table; what the updates lack is NULL."""
    name = _published(spark, d)
    bare = _monthly(tm.order_updates(spark, d)).select(*ORDER_COLUMNS, "order_month")
    tables.publish_unconditional(bare, name, date="order_month")
    return spark.table(name).drop("order_month")


@_query
def published_partitions(spark, d):
    """Rows per partition of a published report after its window was replaced, read as a folder tree."""
    database = f"queries_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(spark, 'tables')}'")
    name = f"{database}.daily"
    daily = stage(gold.daily_sales(_silver(spark, d)).withColumn("order_month", F.trunc("order_date", "month")))
    tables.publish_all_dates(daily, name, "order_month")
    window = backfill.in_window(daily, *WINDOW, date="order_month")
    mondays = window.filter(F.dayofweek("order_date") == 2)
    tables.publish_dates(mondays, name, window.select("order_month").distinct(), "order_month")
    (key,) = tables.partition_columns(spark, name)
    written = gold.last_written(spark.table(name)).first()[0]
    return spark.table(name).groupBy(key).agg(
        F.count("*").alias("days"), F.sum("total_orders").alias("total_orders"),
    ).withColumn("was_written", F.lit(written is not None))
