"""What the physical plans must look like for the library to hold at scale, and hot keys."""

import os
import re
from contextlib import contextmanager
from datetime import date

import pytest
from conftest import order
from pyspark.sql import functions as F

from orderflow.operators import backfill, clean, gold, quality, scd2, upsert, versions
from orderflow.plans.queries import all_queries
from orderflow.sources import tables
from orderflow.sources.staging import stage

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are absent")
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_query_crosses_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(all_queries()[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_window_prunes_partitions(spark, database, orders_frame):
    from conftest import order

    name = f"{database}.bronze"
    rows = [order(i, order_date=date(2026, 1, i)) for i in range(1, 10)]
    tables.publish_table(orders_frame(*rows), name, ["order_date"])
    df = backfill.in_window(spark.table(name), "2026-01-03", "2026-01-04")
    filters = re.search(r"PartitionFilters: \[(.*?)\], ", plan_of(df)).group(1)
    assert "2026-01-03" in filters and "2026-01-04" in filters
    assert df.count() == 2 and len(df.select("order_id", "order_date").inputFiles()) == 2


def test_reports_read_only_their_columns(spark, database, orders_frame):
    from conftest import order

    silver = stage(clean.silver_orders(versions.prepare_orders(orders_frame(order(1)))))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(gold.daily_sales(silver))).group(1)
    read = {item.split(":")[0] for item in schema.split(",")}
    assert read == {"order_id", "customer_id", "order_date", "total_amount"}


def test_current_filter_reaches_the_scan(spark):
    rows = spark.createDataFrame([(1, True), (2, False)], "id int, is_current boolean")
    plan = plan_of(scd2.current(stage(rows)))
    assert "EqualTo(is_current,true)" in plan or "IsNotNull(is_current)" in plan


def test_latest_prunes_before_the_shuffle(spark, orders_frame):
    from conftest import order

    feed = versions.normalize_orders(orders_frame(order(1)).repartition(3), "2026-01-01")
    plan = plan_of(versions.keep_latest(stage(feed), "order_id"))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Partial" in limits[1]


def test_small_batches_leave_the_target_unshuffled(spark, orders_frame):
    from conftest import order

    target = stage(versions.prepare_orders(orders_frame(*[order(i) for i in range(50)]), "2026-01-01"))
    updates = stage(versions.prepare_orders(orders_frame(order(1, quantity=3)), "2026-01-02"))
    changes = upsert.changed_rows(target, updates)
    plan = plan_of(changes)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert changes.count() == 1


SMALL_PARTITIONS = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__files__maxPartitionBytes": "50KB",
}
HOT = 7


@pytest.fixture(scope="module")
def skewed(spark):
    """A feed where one customer, one product and one order id hold a third of the rows each."""
    n = 60_000
    hot = lambda column, shift: F.when((F.col("id") + shift) % 3 == 0, HOT).otherwise(column)
    feed = spark.range(n).select(
        hot(F.col("id") + 1000, 0).cast("int").alias("order_id"),
        hot(F.col("id") % 5000, 1).cast("int").alias("customer_id"),
        hot(F.col("id") % 900, 2).cast("int").alias("product_id"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("order_date"),
        (F.col("id") % 5).cast("int").alias("quantity"),
        F.lit(1.5).alias("unit_price"),
        F.lit("completed").alias("status"),
    )
    return stage(feed)


def test_hot_keys_are_split_in_validation(spark, skewed):
    customers = spark.range(5000).filter("id % 2 = 0 AND id != 7").select(
        F.col("id").cast("int").alias("customer_id"))
    products = spark.range(450).filter("id != 7").select(F.col("id").cast("int").alias("product_id"))
    with settings(spark, **NO_BROADCAST, **SMALL_PARTITIONS):
        tagged = quality.tag_reasons(skewed, "2026-12-31", customers, products)
        assert "skew=true" in plan_of(tagged, final=True)
        got = {r[0]: r[1] for r in tagged.groupBy(
            F.concat_ws(",", quality.REASONS)).count().collect()}
    expected = {}
    for row in skewed.collect():
        reasons = []
        if row.quantity <= 0:
            reasons.append("invalid_quantity")
        if row.order_id == HOT:
            reasons.append("duplicate_order_id")
        if row.customer_id % 2 or row.customer_id == HOT:
            reasons.append("unknown_customer_id")
        if row.product_id >= 450 or row.product_id == HOT:
            reasons.append("unknown_product_id")
        text = ",".join(reasons)
        expected[text] = expected.get(text, 0) + 1
    assert got == expected


def test_reports_shrink_hot_customers_before_the_join(spark, skewed):
    silver = clean.silver_orders(skewed)
    customers = stage(spark.range(5000).select(
        F.col("id").cast("int").alias("customer_id"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("country")))
    products = stage(spark.range(900).select(
        F.col("id").cast("int").alias("product_id"),
        F.concat(F.lit("p"), F.col("id") % 3).alias("category")))
    with settings(spark, **NO_BROADCAST, **SMALL_PARTITIONS):
        report = gold.revenue_by_category_country(silver, customers, products)
        assert "skew=true" in plan_of(report, final=True), "the hot product is split"
        plan = plan_of(gold.revenue_by_category_country(silver, customers, products))
        got = {
            (r.order_date, r.country, r.category): (r.total_orders, r.unique_customers, r.revenue)
            for r in report.collect()
        }
    join = plan.index("SortMergeJoin [customer_id")
    assert "HashAggregate(keys=[order_date" in plan[join:], "aggregated below the customer join"
    assert "Expand" not in plan
    expected = {}
    for r in silver.collect():
        key = (r.order_date, f"c{r.customer_id % 4}", f"p{r.product_id % 3}")
        orders, people, revenue = expected.setdefault(key, [0, set(), 0.0])
        expected[key] = [orders + 1, people | {r.customer_id}, revenue + r.total_amount]
    assert got == {k: (o, len(p), round(v, 2)) for k, (o, p, v) in expected.items()}


def test_as_of_lookup_on_hot_keys(spark, skewed):
    """A key with many versions and a third of the facts forms no pairs of both."""
    history = stage(
        spark.range(3000).select(
            F.when(F.col("id") < 2000, HOT).otherwise(F.col("id") % 500).cast("int").alias("customer_id"),
            F.expr("timestamp'2025-12-20' + make_interval(0, 0, 0, 0, 0, int(id) * 30)").alias("valid_from"),
            F.col("id").cast("string").alias("country"),
        ).dropDuplicates(["customer_id", "valid_from"])
    ).withColumn("record_hash", F.col("country"))
    from pyspark.sql import Window

    history = history.withColumn(
        "valid_to", F.lead("valid_from").over(Window.partitionBy("customer_id").orderBy("valid_from"))
    )
    facts = skewed.select("customer_id", "order_date")
    got = scd2.as_of_join(facts, history, "customer_id", "order_date", ["country"])
    assert got.count() == facts.count()
    ours = {(r[0], r[1]): r[2] for r in got.distinct().collect()}
    brute = facts.distinct().alias("f").join(
        history.alias("h"),
        (F.col("f.customer_id") == F.col("h.customer_id"))
        & (F.col("h.valid_from") <= F.col("f.order_date"))
        & (F.col("h.valid_to").isNull() | (F.col("f.order_date") < F.col("h.valid_to"))),
        "left",
    )
    theirs = {
        (r[0], r[1]): r[2]
        for r in brute.select("f.customer_id", "f.order_date", "h.country").collect()
    }
    assert ours == theirs


def test_as_of_report_scans_silver_once(spark, tmp_path, orders_frame):
    path = str(tmp_path / "silver-scan")
    clean.silver_orders(orders_frame(order(1), order(2, customer_id=5))).write.parquet(path)
    history = spark.createDataFrame(
        [(101, 1001, "A", "B", "2025-01-01 00:00:00", None, "h")],
        "customer_id long, product_id long, country string, category string, valid_from string, "
        "valid_to string, record_hash string",
    ).selectExpr("* EXCEPT (valid_from, valid_to)", "CAST(valid_from AS TIMESTAMP) AS valid_from",
                 "CAST(valid_to AS TIMESTAMP) AS valid_to")
    scans = []

    def keep(df):
        scans.append(len([f for f in df.inputFiles() if "silver-scan" in f]) > 0)
        return stage(df)

    report = gold.revenue_as_of(spark.read.parquet(path), history, history, materialize=keep)
    assert scans == [True] and not any("silver-scan" in f for f in report.inputFiles())
    rows = sorted(((r.country, r.category, r.revenue) for r in report.collect()), key=str)
    assert rows == [("A", "B", 10.0), (None, "B", 10.0)]
