"""Reading feeds and logs, staging, and publishing tables."""

import json
from datetime import date, datetime, timezone

import pytest
from conftest import order
from pyspark.sql import functions as F

from orderflow import schemas
from orderflow.operators import gold, versions
from orderflow.sources import tables
from orderflow.sources.files import (
    CORRUPT_RECORD, HEADER_BYTES, _files_by_header, first_record, read_csv, read_table,
)
from orderflow.sources.metric_log import append_records, read_log
from orderflow.sources.staging import stage, staging_scope, work_root


def test_csv_with_contract(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "customer_id,order_id,product_id,order_date,quantity,unit_price,status,updated_at\n"
        "101,1,1001,2026-01-01,2,25.50,completed,2026-01-05 10:00:00\n"
        "102,2,1002,not-a-date,many,1.0,completed,\n"
    )
    feed = read_csv(spark, str(path), schemas.ORDERS_RAW)
    rows = {r.order_id: r for r in feed.collect()}
    assert rows[1].customer_id == 101 and rows[1].order_date == date(2026, 1, 1)
    assert rows[1].updated_at == "2026-01-05 10:00:00" and rows[1][CORRUPT_RECORD] is None
    assert rows[2].order_date is None and rows[2].quantity is None
    assert "many" in rows[2][CORRUPT_RECORD]


def test_inferred_types_meet_the_raw_contracts(spark, feeds):
    for name, contract in (
        ("orders", schemas.ORDERS_RAW), ("customers", schemas.CUSTOMERS_RAW),
        ("products", schemas.PRODUCTS_RAW),
    ):
        inferred = read_csv(spark, feeds[name])
        assert inferred.columns == contract.fieldNames()
    assert schemas.schema_error_rows(read_csv(spark, feeds["orders"])) == []


def test_inline_rows_round_trip(spark, database):
    rows = [(1, "Mira", 20.5), (2, "Jonas", 7.0), (3, "Leila", 31.99)]
    frame = spark.createDataFrame(rows, "order_id int, customer_name string, amount double")
    assert tables.publish_table(frame, f"{database}.smoke") == 3
    assert sorted(tuple(r) for r in read_table(spark, f"{database}.smoke").collect()) == rows


def test_staged_copy_is_equal_and_on_shared_storage(spark, orders_frame):
    staged = stage(orders_frame(order(1), order(2)))
    assert staged.schema == schemas.ORDERS_RAW and staged.count() == 2
    assert all(work_root(spark) in name for name in staged.inputFiles())
    folder = staged.inputFiles()[0].rpartition("/")[0]
    assert read_table(spark, folder).count() == 2


def test_log_round_trip_and_tolerance(spark, tmp_path):
    path = str(tmp_path / "metrics")
    stamp = datetime(2026, 1, 1, tzinfo=timezone.utc)
    append_records(spark, path, "pipeline_runs", [{"status": "success", "total_steps": 3}],
                   "orders", "run-1", stamp)
    append_records(spark, path, "orders_data_quality",
                   [{"rule_failure_counts": {"invalid_status": 2}, "invalid_percentage": 1.5}],
                   "orders", "run-1", stamp)
    with pytest.raises(ValueError, match="no fields"):
        append_records(spark, path, "pipeline_runs", [{"nonsense": 1}])
    log = read_log(spark, path)
    rows = {r.metric_name: r for r in log.collect()}
    assert set(rows) == {"pipeline_runs", "orders_data_quality"}
    run = rows["pipeline_runs"]
    assert (run.run_id, run.pipeline_name, run.total_steps) == ("run-1", "orders", 3)
    assert run.recorded_at == datetime(2026, 1, 1)
    assert rows["orders_data_quality"].rule_failure_counts == {"invalid_status": 2}


def test_flat_log_files_with_bad_lines(spark, tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    good = {"metric_name": "step_metrics", "timestamp": "2026-01-01T10:00:00+00:00",
            "step": "s", "rows_read": 5, "input_path": ["a", "b"], "unheard_of": 1}
    lines = [json.dumps(good), "", "   ", "{broken", '{"metric_name": "step_metrics", "rows_re',
             "[1, 2]", json.dumps({**good, "timestamp": "not a time", "input_path": "a"})]
    (folder / "step_metrics.jsonl").write_text("\n".join(lines) + "\n")
    log = read_log(spark, str(folder))
    assert log.count() == 2
    rows = sorted(log.collect(), key=lambda r: r.input_path)
    assert [r.input_path for r in rows] == ['["a","b"]', "a"]
    assert rows[0].recorded_at == datetime(2026, 1, 1, 10) and rows[1].recorded_at is None
    assert {r.source_file for r in rows} == {"step_metrics.jsonl"}


def _sales(spark, *rows):
    return spark.createDataFrame(list(rows), "order_date date, n int")


def _days(spark, *days):
    return spark.createDataFrame([(date(2026, 1, d),) for d in days], "order_date date")


def _content(spark, name):
    return sorted(((str(r.order_date), r.n) for r in spark.table(name).collect()))


def test_publish_dates_outcomes(spark, database):
    name = f"{database}.sales"
    first = _sales(spark, *[(date(2026, 1, d), d) for d in (1, 2, 3)])
    assert tables.publish_dates(first, name, _days(spark))[:2] == ("skipped", 0)
    assert tables.publish_dates(first, name, _days(spark, 1, 2, 3))[:2] == ("created", 3)
    assert tables.partition_columns(spark, name) == ["order_date"]
    again = _sales(spark, (date(2026, 1, 2), 20), (date(2026, 1, 2), 21))
    assert tables.publish_dates(again, name, _days(spark, 2, 3))[:2] == ("replaced_partitions", 2)
    assert _content(spark, name) == [("2026-01-01", 1), ("2026-01-02", 20), ("2026-01-02", 21)]
    # A replacement that reads the table it changes.
    doubled = spark.table(name).filter("order_date = '2026-01-02'").selectExpr(
        "order_date", "n * 2 AS n"
    )
    tables.publish_dates(doubled, name, _days(spark, 2))
    assert _content(spark, name) == [("2026-01-01", 1), ("2026-01-02", 40), ("2026-01-02", 42)]
    with pytest.raises(ValueError, match="outside the dates"):
        tables.publish_dates(first, name, _days(spark, 1))
    assert tables.publish_dates(first.limit(0), name, _days(spark, 1))[:2] == (
        "replaced_partitions", 0,
    )
    assert _content(spark, name) == [("2026-01-02", 40), ("2026-01-02", 42)]


def test_other_dates_survive_a_session_with_static_overwrite(spark, database):
    name, setting = f"{database}.sales", "spark.sql.sources.partitionOverwriteMode"
    assert spark.conf.get(setting).lower() == "static"
    tables.publish_dates(
        _sales(spark, (date(2026, 1, 1), 1), (date(2026, 1, 2), 2)), name, _days(spark, 1, 2)
    )
    tables.publish_dates(_sales(spark, (date(2026, 1, 2), 3)), name, _days(spark, 2))
    assert _content(spark, name) == [("2026-01-01", 1), ("2026-01-02", 3)]
    assert spark.conf.get(setting).lower() == "static"


def test_partition_columns_of_a_folder(spark, tmp_path):
    path = str(tmp_path / "by_date")
    _sales(spark, (date(2026, 1, 1), 1)).write.partitionBy("order_date").parquet(path)
    assert tables.partition_columns(spark, path) == ["order_date"]
    plain = str(tmp_path / "plain")
    _sales(spark, (date(2026, 1, 1), 1)).write.parquet(plain)
    assert tables.partition_columns(spark, plain) == []


def test_other_partitioning_is_refused(spark, database):
    name = f"{database}.plain"
    frame = _sales(spark, (date(2026, 1, 1), 1))
    tables.publish_table(frame, name)
    with pytest.raises(tables.PartitioningMismatch):
        tables.publish_dates(frame, name, _days(spark, 1))


def test_replacing_everything_drops_stale_dates_and_the_undated(spark, database):
    name = f"{database}.all_dates"
    tables.publish_all_dates(_sales(spark, (date(2026, 1, 1), 1), (None, 2)), name)
    tables.publish_all_dates(_sales(spark, (date(2026, 1, 2), 3)), name)
    assert _content(spark, name) == [("2026-01-02", 3)]
    tables.publish_all_dates(_sales(spark).limit(0), name)
    assert _content(spark, name) == []
    wider = _sales(spark, (date(2026, 1, 5), 5)).selectExpr("*", "'x' AS note")
    tables.publish_all_dates(wider, name)
    assert spark.table(name).columns == ["n", "note", "order_date"]


def test_upsert_keeps_undated_rows_of_other_orders(spark, database, orders_frame):
    name = f"{database}.bronze"
    first = versions.prepare_orders(
        orders_frame(order(1), order(2, order_date=None), order(3, order_date=None)), "2026-01-01"
    )
    assert tables.publish_upsert(first, name)[0] == "created"
    second = versions.prepare_orders(
        orders_frame(order(4, order_date=None), order(3, order_date=date(2026, 1, 9))), "2026-01-02"
    )
    assert tables.publish_upsert(second, name)[:2] == ("merged", 3)
    got = {r.order_id: r.order_date for r in spark.table(name).collect()}
    assert got == {1: date(2026, 1, 1), 2: None, 3: date(2026, 1, 9), 4: None}
    assert tables.publish_upsert(second, name)[:2] == ("merged", 0)
    third = versions.prepare_orders(
        orders_frame(*[order(i, order_date=date(2026, 1, 3)) for i in (2, 4)]), "2026-01-03"
    )
    tables.publish_upsert(third, name)
    assert spark.table(name).filter("order_date IS NULL").isEmpty()


def test_upsert_migrates_a_table_without_metadata(spark, database, orders_frame):
    name = f"{database}.old_bronze"
    tables.publish_table(orders_frame(order(1), order(2)), name, ["order_date"])
    update = versions.prepare_orders(orders_frame(order(2, quantity=5), order(3)), "2026-01-02")
    assert tables.publish_upsert(update, name)[:2] == ("migrated", 3)
    got = {r.order_id: r.quantity for r in spark.table(name).collect()}
    assert got == {1: 1, 2: 5, 3: 1}


def test_dimension_publishing(spark, database):
    name = f"{database}.customers"
    business = schemas.CUSTOMER_COLUMNS

    def prepared(when, *rows):
        feed = spark.createDataFrame(
            [(i, "n", "e", c, date(2025, 1, 1)) for i, c in rows], schemas.CUSTOMERS_RAW
        )
        return versions.prepare_dimension(feed, "customer_id", business, when)

    args = (name, "customer_id", business)
    assert tables.publish_dimension(prepared("2026-01-01", (1, "A"), (2, "B")), *args)[0].outcome == "created"
    for _ in range(2):
        closed = set(spark.table(name).filter("NOT is_current").inputFiles())
        done, late = tables.publish_dimension(prepared("2026-01-02", (1, "C"), (3, "D")), *args)
        assert (done.outcome, late) == ("merged", 0)
        assert spark.table(name).count() == 4
        # Files of closed versions are never rewritten.
        assert closed <= set(spark.table(name).filter("NOT is_current").inputFiles())
    current = spark.table(name).filter("is_current").collect()
    assert {r.customer_id: r.country for r in current} == {1: "C", 2: "B", 3: "D"}

    bare = f"{database}.bare_customers"
    tables.publish_table(
        spark.createDataFrame([(1, "n", "e", "A", date(2025, 1, 1))], schemas.CUSTOMERS_RAW), bare
    )
    done, _ = tables.publish_dimension(
        prepared("2026-01-02", (1, "C")), bare, "customer_id", business
    )
    assert done[:2] == ("migrated", 1)
    assert spark.table(bare).collect()[0].country == "C"


def test_last_written_is_recent(spark, database):
    name = f"{database}.fresh"
    before = datetime.now(timezone.utc).timestamp() - 5
    tables.publish_table(_sales(spark, (date(2026, 1, 1), 1)), name)
    written = gold.last_written(spark.table(name)).selectExpr(
        "unix_millis(last_updated) / 1000"
    ).collect()[0][0]
    assert before <= written <= datetime.now(timezone.utc).timestamp() + 5


def test_document_is_one_json_file(spark, tmp_path):
    target = tmp_path / "a" / "b"
    tables.write_document(spark.createDataFrame([(1, "x")], "a int, b string"), str(target))
    parts = list(target.glob("part-*.json"))
    assert len(parts) == 1 and json.loads(parts[0].read_text()) == {"a": 1, "b": "x"}


def test_each_file_has_its_own_header_and_wide_keys(spark, tmp_path):
    folder = tmp_path / "two files"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n"
        "3000000000,7001,51,2025-05-10,1,2.5,completed\n"
    )
    (folder / "b.csv").write_text(
        "status,unit_price,quantity,order_date,product_id,customer_id,order_id,note\n"
        "returned,3.5,2,2025-05-11,52,7002,2,hello\n"
    )
    feed = read_csv(spark, str(folder), schemas.ORDERS_RAW).orderBy("order_id").collect()
    assert [(r.order_id, r.customer_id, r.product_id, r.note) for r in feed] == [
        (2, 7002, 52, "hello"), (3000000000, 7001, 51, None),
    ]
    assert all(r[CORRUPT_RECORD] is None for r in feed)


def test_partition_columns_of_odd_folder_names(spark, tmp_path):
    path = str(tmp_path / "a b" / "") + "/by day"
    _sales(spark, (date(2026, 1, 1), 1)).write.partitionBy("order_date").parquet(path)
    assert tables.partition_columns(spark, path) == ["order_date"]


def test_failed_publication_leaves_the_old_table(spark, database):
    name = f"{database}.kept"
    tables.publish_table(_sales(spark, (date(2026, 1, 1), 1)), name, ["order_date"])
    broken = _sales(spark, (date(2026, 1, 2), 2)).selectExpr("order_date", "raise_error('no') AS n")
    for publish in (lambda: tables.publish_table(broken, name, ["order_date"]),
                    lambda: tables.publish_all_dates(broken.selectExpr("order_date", "CAST(n AS INT) AS n"), name)):
        with pytest.raises(Exception, match="no"):
            publish()
        assert _content(spark, name) == [("2026-01-01", 1)]


def test_published_frames_are_evaluated_once(spark, database):
    name = f"{database}.once"
    tables.publish_all_dates(_sales(spark, (date(2026, 1, 1), 1)), name)
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda n: seen.add(1) or n, "int")
    rows = spark.range(100).selectExpr("date'2026-01-02' AS order_date", "CAST(id AS INT) AS n")
    tables.publish_all_dates(rows.withColumn("n", count("n")), name)
    assert seen.value == 100 and spark.table(name).count() == 100


def test_log_filters_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    append_records(spark, path, "pipeline_runs", [{"status": "success"}], "p", "r")
    append_records(spark, path, "step_metrics", [{"step": "s", "rows_read": 3}], "p", "r")
    log = read_log(spark, path, "step_metrics")
    assert [(r.metric_name, r.rows_read) for r in log.collect()] == [("step_metrics", 3)]
    assert log.columns == read_log(spark, path).columns
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [metric_name" in plan.replace("isnotnull(metric_name", "metric_name")


def test_staged_copies_are_dropped_with_their_scope(spark, orders_frame):
    with staging_scope():
        path = stage(orders_frame(order(1))).inputFiles()[0]
        assert spark.read.parquet(path).columns == schemas.ORDER_COLUMNS
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)


def test_unconditional_upsert_publishes_whatever_the_age(spark, database, orders_frame):
    name = f"{database}.forced"
    first = versions.prepare_orders(orders_frame(order(1), order(2)), "2026-01-05")
    assert tables.publish_unconditional(first, name)[:2] == ("created", 2)
    older = versions.prepare_orders(
        orders_frame(order(2, quantity=9, order_date=date(2026, 1, 2)), order(3)), "2026-01-01"
    )
    assert tables.publish_unconditional(older, name)[:2] == ("merged", 3)
    assert {r.order_id: r.quantity for r in spark.table(name).collect()} == {1: 1, 2: 9, 3: 1}


def test_header_bytes_do_not_grow_with_the_files(spark, tmp_path):
    head = "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n"
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")

    def read_bytes(lines):
        folder = tmp_path / f"feed-{lines}"
        folder.mkdir()
        for name in ("a", "b", "c"):
            body = "1,7001,51,2025-05-10,1,2.5,completed\n" * lines
            (folder / f"{name}.csv").write_text((head if name != "c" else "note," + head) + body)
        before = stats.getLong("bytesRead")
        groups = _files_by_header(spark, str(folder))
        assert sorted(len(files) for files in groups.values()) == [1, 2]
        return stats.getLong("bytesRead") - before

    small, large = read_bytes(1_000), read_bytes(200_000)
    assert 0 < large <= small + 3 * (64 << 10)


def test_quoted_headers_with_line_breaks(spark, tmp_path):
    folder = tmp_path / "quoted"
    folder.mkdir()
    (folder / "a.csv").write_bytes(
        b'\r\n"order_id",customer_id,product_id,order_date,quantity,unit_price,status,"a \\"long\\"\r\nname"\r\n'
        b'1,7001,51,2025-05-10,1,2.5,completed,"first\nsecond"\r\n'
    )
    (folder / "b.csv").write_text(
        "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n2,7001,51,2025-05-11,1,2.5,completed\n"
    )
    (folder / "empty.csv").write_text("")
    feed = read_csv(spark, str(folder), schemas.ORDERS_RAW)
    rows = {r.order_id: r for r in feed.collect()}
    assert set(rows) == {1, 2} and all(r[CORRUPT_RECORD] is None for r in rows.values())
    extra = [name for name in feed.columns if name.startswith("a ")]
    assert len(extra) == 1 and "\n" in extra[0]
    assert rows[1][extra[0]].split() == ["first", "second"] and rows[2][extra[0]] is None


def test_long_headers_and_files_without_line_end(spark, tmp_path):
    names = ["order_id", *[f"column_{k}_{'x' * 50}" for k in range(900)]]
    path = tmp_path / "wide.csv"
    path.write_text(",".join(names) + "\n" + ",".join("1" for _ in names))
    assert len(names[1]) * 900 > 2 * HEADER_BYTES
    assert read_csv(spark, str(path), schemas.ORDERS_RAW).select("order_id", names[-1]).collect() == [(1, "1")]
    only = tmp_path / "only.csv"
    only.write_text("order_id,status")
    assert read_csv(spark, str(only), schemas.ORDERS_RAW).collect() == []
    assert first_record(b'"a\nb",c\\"\r\nd') == b'"a\nb",c\\"' and first_record(b'"a\nb') is None
