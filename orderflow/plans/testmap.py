"""The order domain expressed over the supplied tables.

Line items joined to their orders make the order feed, customers with their nations and parts make
the dimensions, and events make the run-metrics log. Nothing is filtered: updates and dirty values
are whole-table rewrites of some column by a rule on the key, mirrored in ``oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.functions.hashing import record_hash
from orderflow.operators.versions import prepare_dimension, prepare_orders
from orderflow.schemas import CUSTOMER_COLUMNS, PRODUCT_COLUMNS
from orderflow.session import apply_settings
from orderflow.sources.files import spread

TODAY = "2001-06-01"
FIRST_LOAD = "2001-01-01 00:00:00"
SECOND_LOAD = "2002-01-01 00:00:00"
LOG_AS_OF = "2024-02-01 00:00:00"
NEW_KEY_OFFSET = 1_000_000_000
UNKNOWN_OFFSET = 1_000_000_000
EVENT_METRICS = {
    "view": "step_metrics",
    "click": "pipeline_steps",
    "signup": "pipeline_runs",
    "error": "orders_data_quality",
    "purchase": "gold_sales_metrics",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int, key: str) -> Column:
    return F.col(key) % n == 0


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; ids repeat naturally."""
    lines = spread(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(
        F.col("o_orderstatus") == "O", "cancelled"
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("unit_price"),
        status.otherwise("returned").alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("source_update_ts"),
    )


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with faults of every kind; dates arrive as text, some unreadable."""
    feed = orders_feed(spark, sf_dir)

    def on(n: int, faulty, column: str) -> Column:
        return F.when(_every(n, "order_id"), faulty).otherwise(F.col(column))

    customer = F.when(_every(89, "order_id"), F.lit(None)).otherwise(
        on(97, F.col("customer_id") + UNKNOWN_OFFSET, "customer_id")
    )
    product = F.when(_every(83, "order_id"), F.lit(None)).otherwise(
        on(101, F.col("product_id") + UNKNOWN_OFFSET, "product_id")
    )
    return feed.select(
        on(127, F.lit(None), "order_id").alias("order_id"),
        customer.alias("customer_id"),
        product.alias("product_id"),
        F.when(_every(113, "order_id"), F.lit("not a date"))
        .when(_every(131, "order_id"), F.lit(None))
        .otherwise(F.col("order_date").cast("string"))
        .alias("order_date"),
        on(103, F.lit(0), "quantity").alias("quantity"),
        on(107, -F.col("unit_price"), "unit_price").alias("unit_price"),
        on(109, F.lit("unknown"), "status").alias("status"),
        "source_update_ts",
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target of merges: the whole feed, prepared."""
    return prepare_orders(orders_feed(spark, sf_dir), FIRST_LOAD)


def order_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed again: every 5th id is new, every 7th has a new price, every 9th moved to
    another date, every 11th is a late copy of an older state, every 29th has no update time and
    every 31st no id."""
    feed = orders_feed(spark, sf_dir)
    price = F.when(
        _every(7, "order_id"), (F.col("unit_price") * F.lit("1.03").cast("decimal(3,2)"))
    ).otherwise(F.col("unit_price")).cast("decimal(18,2)")
    date = F.when(_every(9, "order_id"), F.date_add("order_date", 3)).otherwise(F.col("order_date"))
    late = F.col("source_update_ts") - F.expr("INTERVAL 30 DAYS")
    return prepare_orders(
        feed.select(
            F.when(_every(31, "order_id"), F.lit(None))
            .when(_every(5, "order_id"), F.col("order_id") + NEW_KEY_OFFSET)
            .otherwise(F.col("order_id"))
            .alias("order_id"),
            "customer_id",
            "product_id",
            date.alias("order_date"),
            "quantity",
            price.alias("unit_price"),
            "status",
            F.when(_every(29, "order_id"), F.lit(None))
            .when(_every(11, "order_id"), late)
            .otherwise(F.col("source_update_ts"))
            .alias("source_update_ts"),
        ),
        SECOND_LOAD,
    )


def late_decisions(orders: DataFrame) -> DataFrame:
    """Every 3rd order is released, every 6th rejected after that; every 5th has a decision on a
    version that is not there."""
    def made(n: int, version: Column, decision: str, when: str, who: str) -> DataFrame:
        return orders.filter(_every(n, "order_id")).select(
            "order_id",
            version.alias("record_hash"),
            F.lit(decision).alias("decision"),
            F.lit(when).cast("timestamp").alias("decided_at"),
            F.lit(who).alias("decided_by"),
        )

    own = F.col("record_hash")
    first = made(3, own, "released", FIRST_LOAD, "first")
    second = made(6, own, "rejected", SECOND_LOAD, "second")
    return first.unionByName(second).unionByName(
        made(5, F.reverse(own), "released", SECOND_LOAD, "third")
    )


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    mail = F.concat(F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@Example.com "))
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        mail.alias("email"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("country"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias(
            "signup_date"
        ),
    )


def products_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("  "), F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_cost"),
    )


def first_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_dimension(
        products_feed(spark, sf_dir), "product_id", PRODUCT_COLUMNS, FIRST_LOAD
    )


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers again: every 11th moved country, every 13th is new, every 17th is older."""
    feed = customers_feed(spark, sf_dir)
    return prepare_dimension(
        feed.select(
            F.when(_every(13, "customer_id"), F.col("customer_id") + NEW_KEY_OFFSET)
            .otherwise(F.col("customer_id"))
            .alias("customer_id"),
            "customer_name",
            "email",
            F.when(_every(11, "customer_id"), F.lit("NATION_NEW"))
            .otherwise(F.col("country"))
            .alias("country"),
            "signup_date",
            F.when(_every(17, "customer_id"), F.lit("2000-01-01 00:00:00"))
            .otherwise(F.lit(SECOND_LOAD))
            .cast("timestamp")
            .alias("source_update_ts"),
        ),
        "customer_id",
        CUSTOMER_COLUMNS,
        SECOND_LOAD,
    )


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with up to three consecutive versions inside the period the orders cover."""
    return _history(customers_feed(spark, sf_dir), "customer_id", "country", CUSTOMER_COLUMNS)


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as a merge target: every 19th customer has closed versions only, and every 23rd
    has closed versions without a flag."""
    history = customer_history(spark, sf_dir)
    all_closed = _every(19, "customer_id")
    unflagged = _every(23, "customer_id") & F.col("valid_to").isNotNull()
    ended = F.lit(FIRST_LOAD).cast("timestamp")
    return history.withColumns(
        {
            "is_current": F.when(all_closed, F.lit(False))
            .when(unflagged, F.lit(None))
            .otherwise(F.col("is_current")),
            "valid_to": F.when(all_closed, F.coalesce("valid_to", ended)).otherwise(
                F.col("valid_to")
            ),
        }
    )


def product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(products_feed(spark, sf_dir), "product_id", "category", PRODUCT_COLUMNS)


def _history(feed: DataFrame, key: str, attribute: str, business: list[str]) -> DataFrame:
    """From 1996-01-01 on, from a day in 1998 at noon (even keys), from one in 2000 (every 3rd)."""
    shift = (F.col(key) % 300).cast("int")
    second = (F.date_add(F.lit("1998-01-01").cast("date"), shift).cast("timestamp")
              + F.expr("INTERVAL 12 HOURS"))
    third = F.date_add(F.lit("2000-01-01").cast("date"), shift).cast("timestamp")
    even, by_three = _every(2, key), _every(3, key)

    def version(start, end, suffix, exists):
        return F.when(
            exists,
            F.struct(
                start.alias("valid_from"),
                end.cast("timestamp").alias("valid_to"),
                F.concat(F.trim(attribute), F.lit(suffix)).alias("_value"),
            ),
        )

    start = F.lit("1996-01-01").cast("timestamp")
    open_end = F.lit(None)
    versions = F.array_compact(
        F.array(
            version(
                start, F.when(even, second).when(by_three, third).otherwise(open_end), "",
                F.lit(True),
            ),
            version(second, F.when(by_three, third).otherwise(open_end), "/2", even),
            version(third, open_end, "/3", by_three),
        )
    )
    unrolled = feed.withColumn("_v", F.explode(versions))
    dated = unrolled.withColumns({attribute: F.col("_v._value"), "valid_from": F.col("_v.valid_from")})
    arrival = F.lit(FIRST_LOAD).cast("timestamp")
    return dated.select(
        *business,
        F.col("valid_from").alias("source_update_ts"),
        arrival.alias("ingestion_ts"),
        arrival.cast("date").alias("ingestion_date"),
        record_hash(dated, business).alias("record_hash"),
        "valid_from",
        F.col("_v.valid_to").alias("valid_to"),
        F.col("_v.valid_to").isNull().alias("is_current"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one record of the run-metrics log."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    metric = F.element_at(
        F.create_map(*[F.lit(x) for pair in EVENT_METRICS.items() for x in pair]), kind
    )
    step = F.concat(F.lit("step_"), F.col("k") % 10)
    stamp = F.col("ts").cast("string")
    counts = F.create_map(
        F.lit("invalid_quantity"), F.col("k").cast("bigint"),
        F.lit("invalid_status"), (F.col("k") % 7).cast("bigint"),
        F.lit("unknown_customer_id"), F.col("event_id") % 13,
    )
    events = spread(table(spark, sf_dir, "events")).withColumns({"k": k, "metric_name": metric})
    status = (
        F.when(F.col("k") % 40 == 7, F.lit(None))
        .when(F.col("k") % 10 == 0, "failed")
        .when(F.col("k") % 10 == 1, "FAILED")
        .otherwise("success")
    )
    is_run = F.col("metric_name") == "pipeline_runs"
    is_quality = F.col("metric_name") == "orders_data_quality"
    is_gold = F.col("metric_name") == "gold_sales_metrics"
    value = F.col("value")
    log = events.select(
        F.when(F.col("k") % 50 != 0, stamp).alias("timestamp"),
        "metric_name",
        F.lit("orders").alias("pipeline_name"),
        F.col("user_id").cast("string").alias("run_id"),
        F.when(~is_quality & ~is_gold, status).alias("status"),
        F.when(~is_quality & ~is_gold, value).alias("duration_seconds"),
        F.when(F.col("k") % 2 == 0, F.lit("2024-01-01 00:00:00")).alias("started_at"),
        F.when(F.col("k") % 100 != 0, stamp).alias("ended_at"),
        F.when(~is_run, step).alias("step"),
        (F.col("k") % 3 + 1).alias("attempt"),
        F.when(is_run, F.lit(10)).alias("total_steps"),
        F.when(is_run, 10 - F.col("k") % 4).alias("successful_steps"),
        F.when(is_run, F.col("k") % 4).alias("failed_steps"),
        F.when(is_run, F.lit(0)).alias("skipped_steps"),
        F.when(is_run & (F.col("k") % 4 > 0), step).alias("failed_step"),
        (F.col("event_id") * 10 + F.col("k")).alias("rows_read"),
        (F.col("event_id") * 10).alias("rows_written"),
        F.col("k").cast("bigint").alias("rows_quarantined"),
        F.when(is_quality, F.col("k").cast("bigint")).alias("invalid_count"),
        F.when(is_quality, F.col("k").cast("bigint")).alias("invalid_rows"),
        F.when(is_quality, value).alias("invalid_percentage"),
        F.when(is_quality & (F.col("k") % 2 == 0), counts).alias("rule_failure_counts"),
        F.when(is_quality, counts).alias("quarantine_reason_counts"),
        F.when(is_gold, value).alias("total_revenue"),
        F.when(is_gold, F.col("k").cast("bigint")).alias("total_orders"),
        F.when(is_gold & (F.col("k") % 2 == 0), F.lit(1.5)).alias("average_order_value"),
        F.when(is_gold, F.col("ts").cast("date").cast("string")).alias("latest_order_date"),
        F.when(is_gold, stamp).alias("gold_table_last_updated_timestamp"),
        F.col("event_id").cast("string").alias("record_id"),
    )
    return log.withColumn("recorded_at", F.col("timestamp").try_cast("timestamp"))
