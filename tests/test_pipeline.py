"""All steps over the fixture files, with the expected reports; replays, backfills and failures."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from orderflow.operators import runlog
from orderflow.operators.audit import MissingOperations
from orderflow.operators.quality import QualityThresholdExceeded
from orderflow.plans import steps
from orderflow.sources.metric_log import read_log
from orderflow.sources.tables import partition_columns


def _lake(spark, database, tmp_path, **settings):
    return steps.Lake(
        spark, database, str(tmp_path / "metrics"), settings.pop("run_id", "run-1"),
        as_of=settings.pop("as_of", "2025-05-20 00:00:00"), **settings,
    )


def _load(lake, feeds, *order_files):
    for number, name in enumerate(order_files):
        steps.ingest_orders(lake, feeds[name], f"batch-{number}")
    steps.ingest_dimensions(lake, {n: feeds[n] for n in ("customers", "products")})


def _publish(lake):
    steps.build_silver_orders(lake)
    steps.merge_dimensions(lake)
    steps.build_daily_sales(lake)
    steps.build_revenue(lake)


def _daily(lake):
    rows = lake.table("daily_sales_summary").orderBy("order_date").collect()
    return [
        (str(r.order_date), r.total_orders, r.unique_customers, r.daily_revenue) for r in rows
    ]


EXPECTED_DAILY = [
    ("2025-05-10", 1, 1, 59.7), ("2025-05-11", 3, 3, 192.5), ("2025-05-14", 1, 1, 39.8),
]


def test_full_run_matches_expected_reports(spark, database, tmp_path, feeds):
    lake = _lake(spark, database, tmp_path)
    # The same file twice: the second merge must change nothing.
    _load(lake, feeds, "orders", "orders")
    assert lake.table("orders_bronze").count() == 7
    assert {r.operation for r in steps.check_history(lake).collect()} == {"WRITE", "MERGE"}

    summary = steps.validate_orders(
        lake, today="2025-07-01", summary_path=str(tmp_path / "nested" / "summary")
    ).collect()[0]
    assert (summary.total_rows, summary.valid_rows, summary.invalid_rows) == (7, 7, 0)
    assert summary.threshold_passed
    document = spark.read.json(str(tmp_path / "nested" / "summary")).collect()[0]
    assert len(document.expectations) == 12 and document.levels.schema.passed

    _publish(lake)
    silver = lake.table("orders_silver")
    assert silver.count() == 5
    assert {r.status for r in silver.collect()} == {"completed"}
    assert _daily(lake) == EXPECTED_DAILY
    revenue = lake.table("revenue_by_category_country").groupBy("country", "category").agg(
        F.sum("total_orders"), F.sum("unique_customers"), F.round(F.sum("revenue"), 2)
    )
    assert sorted(tuple(r) for r in revenue.collect()) == [
        ("Chile", "Kitchen", 1, 1, 14.5),
        ("Norway", "Kitchen", 1, 1, 29.0),
        ("Norway", "Outdoor", 3, 3, 248.5),
    ]
    for name in ("orders_bronze", "orders_validated", "orders_silver", "daily_sales_summary",
                 "revenue_by_category_country"):
        assert partition_columns(spark, lake.name(name)) == ["order_date"]

    metrics = steps.collect_gold_metrics(lake)
    assert (metrics["total_days"], metrics["total_orders"]) == (3, 5)
    assert (metrics["total_revenue"], metrics["average_order_value"]) == (292.0, 58.4)
    assert metrics["top_countries"] == [("Norway", 277.5, 4), ("Chile", 14.5, 1)]
    assert metrics["latest_order_date"] == "2025-05-14"

    log = read_log(spark, lake.metrics_path)
    counts = {r.metric_name: r.records for r in runlog.record_counts(log).collect()}
    assert counts["step_metrics"] == 8 and counts["gold_sales_metrics"] == 1
    gold = runlog.typed(log, "gold_sales_metrics").collect()[0]
    assert gold.top_countries[0].country == "Norway" and gold.run_id == "run-1"
    validated = log.filter("step = 'validate_orders'").collect()[0]
    assert (validated.rows_read, validated.rows_written, validated.rows_quarantined) == (7, 7, 0)
    assert validated.affected_dates == ["2025-05-10", "2025-05-11", "2025-05-13", "2025-05-14"]

    # A whole second run over unchanged input leaves every report as it is.
    steps.validate_orders(lake, today="2025-07-01")
    _publish(lake)
    assert _daily(lake) == EXPECTED_DAILY
    assert lake.table("customers_silver").count() == 3


def test_too_many_invalid_rows_fail_after_publishing(spark, database, tmp_path, feeds):
    lake = _lake(spark, database, tmp_path)
    _load(lake, feeds, "orders", "invalid")
    with pytest.raises(QualityThresholdExceeded):
        steps.validate_orders(lake, today="2025-07-01")
    assert lake.table("orders_validated").count() == 7
    reasons = {
        r.order_id: (r.quarantine_reason, r.quarantine_reasons)
        for r in lake.table("orders_quarantine").collect()
    }
    assert {k: v[0] for k, v in reasons.items()} == {
        9101: "invalid_status", 9102: "missing_customer_id", 9103: "invalid_quantity",
        9104: "invalid_unit_price", 9105: "missing_product_id", 9106: "invalid_quantity",
    }
    log = read_log(spark, lake.metrics_path)
    assert log.filter("step = 'validate_orders'").collect()[0].status == "failed"
    quality = runlog.rule_failures(log).collect()
    assert (quality[0].rule, quality[0].failures) == ("invalid_quantity", 2)


def test_orders_without_id_are_kept_and_quarantined_once(spark, database, tmp_path, feeds):
    path = tmp_path / "keyless.csv"
    path.write_text(
        "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n"
        "9001,7001,51,2025-05-10,3,19.90,completed\n"
        ",7001,51,2025-05-10,3,19.90,completed\n"
        ",7001,51,2025-05-10,3,19.90,completed\n"
        ",7002,52,2025-05-11,1,149.00,completed\n"
    )
    lake = _lake(spark, database, tmp_path)
    for _ in range(2):
        steps.ingest_orders(lake, str(path), "keyless")
    steps.ingest_dimensions(lake, {n: feeds[n] for n in ("customers", "products")})
    steps.validate_orders(lake, threshold=90, today="2025-07-01")
    assert lake.table("orders_bronze").count() == 1
    quarantined = lake.table("orders_quarantine").collect()
    assert [r.quarantine_reason for r in quarantined] == ["missing_order_id"] * 3


def test_incremental_batch_moves_an_order_and_drops_its_emptied_date(
    spark, database, tmp_path, feeds
):
    lake = _lake(spark, database, tmp_path)
    _load(lake, feeds, "orders")
    steps.validate_orders(lake, today="2025-07-01")
    _publish(lake)
    path = tmp_path / "batch2.csv"
    # Columns in another order and with an update time; 9001 and 9002 leave their date, 9007 has a
    # new price, 9200 is new, and 9003 comes as an older copy that must lose.
    path.write_text(
        "status,order_id,customer_id,product_id,order_date,quantity,unit_price,update_timestamp\n"
        "completed,9007,7003,51,2025-05-14,2,25.00,2025-06-01 00:00:00\n"
        "completed,9001,7001,51,2025-05-13,3,19.90,2025-06-01 00:00:00\n"
        "returned,9002,7002,52,2025-05-13,1,149.00,2025-06-01 00:00:00\n"
        "completed,9200,7002,53,2025-05-13,10,7.25,2025-06-01 00:00:00\n"
        "completed,9003,7003,53,2025-05-11,9,7.25,2025-01-01 00:00:00\n"
    )
    assert steps.ingest_orders(lake, str(path), "batch-2") == "merged"
    bronze = {r.order_id: r for r in lake.table("orders_bronze").collect()}
    assert len(bronze) == 8
    assert (bronze[9007].unit_price, bronze[9003].quantity) == (25.0, 4)
    assert bronze[9001].order_date == date(2025, 5, 13)
    partitions = {r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.orders_bronze").collect()}
    assert "order_date=2025-05-10" not in partitions

    # A backfill over the touched window rebuilds those dates only and drops the emptied one.
    window = _lake(
        spark, database, tmp_path, run_id="run-2", start_date="2025-05-10", end_date="2025-05-13"
    )
    steps.validate_orders(window, today="2025-07-01")
    steps.build_silver_orders(window)
    steps.build_daily_sales(window)
    assert _daily(lake) == [
        ("2025-05-11", 3, 3, 192.5), ("2025-05-13", 2, 2, 132.2), ("2025-05-14", 1, 1, 39.8),
    ]
    # The next full run picks up the price change outside the window.
    steps.validate_orders(lake, today="2025-07-01")
    _publish(lake)
    assert _daily(lake)[-1] == ("2025-05-14", 1, 1, 50.0)


def test_replayed_batch_without_keyless_rows_removes_the_old_ones(spark, database, tmp_path, feeds):
    path = tmp_path / "batch.csv"
    head = "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n"
    lake = _lake(spark, database, tmp_path)
    path.write_text(head + ",7001,51,2025-05-10,3,19.90,completed\n9301,7001,51,2025-05-10,x,1,completed\n")
    steps.ingest_orders(lake, str(path), "b")
    assert lake.table("orders_unkeyed").count() == 1
    assert lake.table("orders_corrupt").collect()[0].line == "9301,7001,51,2025-05-10,x,1,completed"
    path.write_text(head + "9300,7001,51,2025-05-10,3,19.90,completed\n")
    steps.ingest_orders(lake, str(path), "b")
    assert lake.table("orders_unkeyed").count() == lake.table("orders_corrupt").count() == 0


def test_keyless_and_late_dimension_rows_are_kept_apart(spark, database, tmp_path):
    lake = _lake(spark, database, tmp_path)
    head = "customer_id,customer_name,email,country,signup_date,updated_at\n"
    products = tmp_path / "products.csv"
    products.write_text("product_id,product_name,category,unit_cost\n51,Lantern,Outdoor,14.00\n")
    customers = tmp_path / "customers.csv"

    def load(*lines):
        customers.write_text(head + "".join(lines))
        steps.ingest_dimensions(lake, {"customers": str(customers), "products": str(products)})
        steps.merge_dimensions(lake)

    load("7001,M,m@x.example,Norway,2024-03-09,2025-05-02 00:00:00\n", ",N,n@x.example,Peru,2024-01-01,\n")
    assert [r.country for r in lake.table("customers_unkeyed").collect()] == ["Peru"]
    load("7001,M,m@x.example,Peru,2024-03-09,2025-05-01 00:00:00\n")
    assert [r.country for r in lake.table("customers_silver_late").collect()] == ["Peru"]
    assert lake.table("customers_silver").count() == 1 and lake.table("customers_unkeyed").isEmpty()
    log = read_log(spark, lake.metrics_path, "step_metrics").filter("step = 'silver_customers_products'")
    assert [r.rows_quarantined for r in log.orderBy("timestamp").collect()] == [1, 1]


def test_run_record_makes_the_run_known(spark, database, tmp_path, feeds):
    lake = _lake(spark, database, tmp_path)
    _load(lake, feeds, "orders")
    steps.validate_orders(lake, today="2025-07-01")
    _publish(lake)
    record = steps.record_run(lake)
    assert (record["status"], record["total_steps"], record["failed_steps"]) == ("success", 7, 0)
    log = read_log(spark, lake.metrics_path)
    assert [(r.run_id, r.status) for r in runlog.run_status(log).collect()] == [("run-1", "success")]
    firing = {r.alert for r in runlog.alerts(log, "2025-07-01 00:00:00").collect() if r.firing}
    assert "pipeline_metrics_missing" not in firing


def test_history_check_names_what_is_missing(spark, database, tmp_path, feeds):
    lake = _lake(spark, database, tmp_path)
    _load(lake, feeds, "orders")
    with pytest.raises(MissingOperations, match="MERGE"):
        steps.check_history(lake)
