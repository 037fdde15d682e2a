"""Single operators on small frames: every rule, edge values, replays and invariants."""

from datetime import date, datetime

import pytest
from conftest import order
from pyspark.sql import functions as F

from orderflow import schemas
from orderflow.functions.hashing import record_hash
from orderflow.functions.privacy import mask_customers
from orderflow.functions.values import as_date
from orderflow.operators import audit, backfill, clean, gold, quality, scd2, upsert, versions

TODAY = "2026-01-10"
CUSTOMER = ["customer_id", "customer_name", "email", "country", "signup_date"]


def ts(text):
    return datetime.fromisoformat(text)


def in_memory(df, partition_by=()):
    """Stands in for staging where a test does not look at stored tables."""
    return df


# Versions -----------------------------------------------------------------------------------


def test_keep_latest_prefers_the_newest_update(spark):
    rows = [
        (31, 7001, 51, "2025-05-10", 4, 3.5, "completed", "2025-05-12 10:30:00"),
        (31, 7001, 51, "2025-05-10", 5, 3.5, "completed", "2025-05-12 10:29:00"),
        (31, 7001, 51, "2025-05-10", 6, 3.5, "returned", None),
        (32, 7002, 52, "2025-05-11", 1, 8.0, "cancelled", None),
    ]
    feed = spark.createDataFrame(rows, schemas.ORDER_COLUMNS + ["update_timestamp"])
    prepared = versions.prepare_orders(feed, "2025-05-01 00:00:00")
    latest = {r.order_id: r for r in prepared.collect()}
    assert sorted(latest) == [31, 32]
    assert (latest[31].quantity, latest[31].status) == (4, "completed")
    assert latest[31].source_update_ts == ts("2025-05-12T10:30:00")
    assert latest[32].source_update_ts is None
    assert latest[32].ingestion_date == date(2025, 5, 1) and len(latest[32].record_hash) == 64


def test_normalized_orders_have_the_contract_columns_in_order(spark, orders_frame):
    feed = orders_frame(order(1)).withColumn("extra", F.lit(1)).select("extra", "status", *[
        c for c in schemas.ORDER_COLUMNS if c != "status"])
    assert versions.normalize_orders(feed, "2026-01-01").columns == (
        schemas.ORDER_COLUMNS + schemas.INGESTION_COLUMNS
    )


@pytest.mark.parametrize("column", ["update_timestamp", "updated_at", "source_update_ts"])
def test_source_time_comes_from_the_first_known_column(spark, orders_frame, column):
    feed = orders_frame(order(1)).withColumn(column, F.lit("2026-01-03 01:02:03"))
    row = versions.normalize_orders(feed, "2026-01-09 00:00:00").collect()[0]
    assert row.source_update_ts == ts("2026-01-03T01:02:03")
    assert row.ingestion_ts == ts("2026-01-09T00:00:00")


def test_source_time_defaults(orders_frame):
    feed = orders_frame(order(1))
    assert versions.normalize_orders(feed, "2026-01-09").collect()[0].source_update_ts == ts(
        "2026-01-09T00:00:00"
    )
    given = versions.normalize_orders(feed, "2026-01-09", "1970-01-01").collect()[0]
    assert given.source_update_ts == ts("1970-01-01T00:00:00")


def test_hash_tells_nulls_apart_and_ignores_how_doubles_print(spark):
    df = spark.createDataFrame(
        [("x", None, 1e7), (None, "x", 1e7)], "a string, b string, c double"
    )
    hashes = [r[0] for r in df.select(record_hash(df, ["a", "b", "c"])).collect()]
    assert hashes[0] != hashes[1]
    whole = df.withColumn("c", F.lit("10000000.0000000000"))
    assert hashes == [r[0] for r in whole.select(record_hash(whole, ["a", "b", "c"])).collect()]


def test_dimension_preparation_keeps_one_open_version(spark):
    rows = [
        (101, "Alice", "a@x", "France", "2026-01-01", "2026-01-02 08:00:00"),
        (101, "Alice", "a@x", "Germany", "2026-01-01", "2026-01-03 08:00:00"),
        (102, "Bob", "b@x", "France", "2026-01-02", "2026-01-02 09:00:00"),
        (None, "Nobody", "n@x", "France", "2026-01-02", "2026-01-02 09:00:00"),
    ]
    feed = spark.createDataFrame(rows, CUSTOMER + ["update_timestamp"])
    prepared = {
        r.customer_id: r
        for r in versions.prepare_dimension(feed, "customer_id", CUSTOMER).collect()
    }
    assert set(prepared) == {101, 102}
    alice = prepared[101]
    assert alice.country == "Germany" and alice.is_current and alice.valid_to is None
    assert alice.valid_from == alice.source_update_ts == ts("2026-01-03T08:00:00")


# Upsert -------------------------------------------------------------------------------------


def _prepared(orders_frame, when, *rows):
    return versions.prepare_orders(orders_frame(*rows), when)


def test_upsert_is_idempotent_and_refuses_older_rows(orders_frame):
    target = _prepared(
        orders_frame, "2026-01-02", order(1), order(2), order(3), order(4, quantity=4)
    )
    newer = _prepared(orders_frame, "2026-01-03", order(2, quantity=9), order(3), order(5))
    older = _prepared(orders_frame, "2026-01-01", order(4, quantity=1))
    once = upsert.upsert(target, newer)
    rows = {r.order_id: r for r in once.collect()}
    assert {k: v.quantity for k, v in rows.items()} == {1: 1, 2: 9, 3: 1, 4: 4, 5: 1}
    assert rows[3].ingestion_ts == ts("2026-01-02T00:00:00"), "equal content is not rewritten"
    assert sorted(upsert.upsert(once, newer).collect()) == sorted(once.collect())
    assert sorted(upsert.upsert(once, older).collect()) == sorted(once.collect())


def test_change_set_rebuilds_the_same_table(orders_frame):
    target = _prepared(orders_frame, "2026-01-02", *[order(i) for i in range(1, 9)])
    updates = _prepared(
        orders_frame, "2026-01-03",
        order(2, quantity=5), order(3, order_date=date(2026, 1, 4)), order(20), order(4),
        order(5, order_date=None),
    )
    changes = upsert.changed_rows(target, updates)
    assert {r.order_id for r in changes.collect()} == {2, 3, 5, 20}
    dates = upsert.touched_dates(changes)
    assert {r[0] for r in dates.collect()} == {date(2026, 1, 1), date(2026, 1, 4), None}
    rebuilt = upsert.rows_of_dates(target, changes, dates)
    full = upsert.upsert(target, updates)
    assert sorted(map(str, rebuilt.collect())) == sorted(map(str, full.collect()))


def test_unconditional_upsert_fills_missing_columns_with_null(orders_frame):
    target = _prepared(orders_frame, "2026-01-02", order(1), order(2))
    rows = {
        r.order_id: r
        for r in upsert.upsert_unconditional(
            target, orders_frame(order(2, quantity=-2), order(3))
        ).collect()
    }
    assert {k: v.quantity for k, v in rows.items()} == {1: 1, 2: -2, 3: 1}
    assert rows[1].record_hash and rows[2].record_hash is None


def test_migration_lets_any_update_win(orders_frame):
    bare = orders_frame(order(1), order(2))
    assert versions.lacks_metadata(bare, schemas.INGESTION_COLUMNS)
    updates = _prepared(orders_frame, "1999-01-01", order(2, quantity=7), order(3))
    rows = {r.order_id: r for r in versions.migrate_orders(bare, updates).collect()}
    assert {k: v.quantity for k, v in rows.items()} == {1: 1, 2: 7, 3: 1}
    assert rows[1].source_update_ts == ts("1970-01-01T00:00:00")


# Type 2 dimensions --------------------------------------------------------------------------


def _dimension(spark, when, *rows):
    feed = spark.createDataFrame(
        [(i, "n", "e", country, date(2025, 1, 1)) for i, country in rows], schemas.CUSTOMERS_RAW
    )
    return versions.prepare_dimension(feed, "customer_id", CUSTOMER, when)


def test_scd2_second_and_third_run(spark):
    first = _dimension(spark, "2026-01-01", (1, "France"), (2, "Spain"), (3, "Italy"))
    second = _dimension(spark, "2026-01-02", (1, "Germany"), (2, "Spain"), (4, "Malta"))
    merged = scd2.scd2_merge(first, second, "customer_id")
    state = {
        (r.customer_id, r.country): (r.valid_from, r.valid_to, r.is_current)
        for r in merged.collect()
    }
    day1, day2 = ts("2026-01-01T00:00:00"), ts("2026-01-02T00:00:00")
    assert state == {
        (1, "France"): (day1, day2, False),
        (1, "Germany"): (day2, None, True),
        (2, "Spain"): (day1, None, True),
        (3, "Italy"): (day1, None, True),
        (4, "Malta"): (day2, None, True),
    }
    again = scd2.scd2_merge(merged, second, "customer_id")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
    back = scd2.scd2_merge(
        merged, _dimension(spark, "2026-01-03", (1, "France")), "customer_id"
    )
    versions_of_1 = back.filter("customer_id = 1").orderBy("valid_from").collect()
    assert [r.country for r in versions_of_1] == ["France", "Germany", "France"]
    assert scd2.current(back).groupBy("customer_id").count().filter("count > 1").isEmpty()


def test_scd2_guard_against_older_versions(spark):
    first = _dimension(spark, "2026-01-05", (1, "France"))
    older = _dimension(spark, "2026-01-01", (1, "Spain"))
    assert scd2.scd2_merge(first, older, "customer_id").count() == 1
    unguarded = scd2.scd2_merge(first, older, "customer_id", guard=False).collect()
    assert {(r.country, r.is_current) for r in unguarded} == {("France", False), ("Spain", True)}
    assert scd2.changed_versions(first, older, "customer_id").count() == 1
    assert scd2.changed_versions(first, older, "customer_id", guard=True).isEmpty()


def test_as_of_lookup_against_brute_force(spark):
    history = spark.createDataFrame(
        [
            (1, "A", ts("2026-01-02T00:00:00"), ts("2026-01-05T12:00:00")),
            (1, "B", ts("2026-01-05T12:00:00"), ts("2026-01-05T18:00:00")),
            (1, "C", ts("2026-01-05T18:00:00"), ts("2026-01-09T00:00:00")),
            (2, "D", ts("2026-01-03T00:00:00"), None),
            (3, "E", ts("2026-01-04T00:00:00"), ts("2026-01-03T00:00:00")),
        ],
        "customer_id int, country string, valid_from timestamp, valid_to timestamp",
    ).withColumn("record_hash", F.col("country"))
    facts = spark.createDataFrame(
        [(k, date(2026, 1, d)) for k in (1, 2, 3, 4, None) for d in range(1, 12)] * 2,
        "customer_id int, order_date date",
    )
    got = scd2.as_of_join(facts, history, "customer_id", "order_date", ["country"]).collect()
    rows = history.collect()

    def valid_on(key, day):
        moment = datetime(day.year, day.month, day.day)
        found = [
            r.country for r in rows
            if r.customer_id == key and r.valid_from <= moment
            and (r.valid_to is None or moment < r.valid_to)
        ]
        assert len(found) <= 1
        return found[0] if found else None

    assert len(got) == 110
    for row in got:
        assert row.country == valid_on(row.customer_id, row.order_date), row


# Validation ---------------------------------------------------------------------------------


def test_summary_counts_first_and_all_reasons(orders_frame):
    orders = orders_frame(
        order(11, unit_price=-0.5, status="lost"),
        order(12), order(12, quantity=0), order(12),
        order(13, product_id=None, order_date=None),
        order(14), order(15), order(16), order(17),
        order(18, unit_price=1e19),
    )
    tagged = quality.tag_reasons(orders, TODAY, materialize=in_memory)
    row = quality.summary(tagged, threshold=59.9).collect()[0]
    assert (row.total_rows, row.valid_rows, row.invalid_rows) == (10, 4, 6)
    assert row.invalid_percentage == 60.0 and not row.threshold_passed
    assert row.quarantine_reason_counts == {
        "invalid_unit_price": 2, "duplicate_order_id": 2, "invalid_quantity": 1,
        "missing_product_id": 1,
    }
    assert row.all_quarantine_reason_counts == {
        "invalid_unit_price": 2, "duplicate_order_id": 3, "invalid_quantity": 1,
        "missing_product_id": 1, "invalid_status": 1, "future_order_date": 1,
    }
    assert quality.valid_rows(tagged).columns == schemas.ORDER_COLUMNS
    part = quality.summary(quality.quarantined_rows(tagged), threshold=59.9, total_rows=10)
    assert part.collect()[0] == row
    assert {r.quarantine_reason: r.rows for r in quality.first_reason_counts(tagged).collect()} == (
        row.quarantine_reason_counts
    )


def test_unknown_references_come_last_and_in_order(spark, orders_frame):
    customers = spark.createDataFrame([(101,), (101,)], "customer_id int")
    products = spark.createDataFrame([(1001,)], "product_id int")
    orders = orders_frame(order(1), order(2, customer_id=999, product_id=888),
                          order(3, customer_id=None, product_id=None))
    tagged = quality.tag_reasons(orders, TODAY, customers, products, materialize=in_memory)
    reasons = {r.order_id: r.quarantine_reasons for r in tagged.collect()}
    assert reasons == {
        1: [],
        2: ["unknown_customer_id", "unknown_product_id"],
        3: ["missing_customer_id", "missing_product_id"],
    }


def test_all_reasons_are_listed_in_rule_order(spark):
    orders = spark.createDataFrame(
        [(7, 999, 888, "2026-02-30", 0, -1.0, None), (7, None, None, None, None, None, "?"),
         (None, 101, 1001, "2026-01-11", 1, 0.0, "returned"),
         (None, 101, 1001, "2026-01-10", 1, 0.0, "returned")],
        "order_id int, customer_id int, product_id int, order_date string, quantity int, "
        "unit_price double, status string",
    )
    customers = spark.createDataFrame([(101,)], "customer_id int")
    products = spark.createDataFrame([(1001,)], "product_id int")
    tagged = quality.tag_reasons(orders, TODAY, customers, products, materialize=in_memory)
    found = sorted(tuple(r.quarantine_reasons) for r in tagged.collect())
    assert found == sorted([
        ("invalid_quantity", "invalid_unit_price", "invalid_status", "future_order_date",
         "duplicate_order_id", "unknown_customer_id", "unknown_product_id"),
        ("missing_customer_id", "missing_product_id", "invalid_quantity", "invalid_unit_price",
         "invalid_status", "future_order_date", "duplicate_order_id"),
        ("missing_order_id", "future_order_date"),
        ("missing_order_id",),
    ])
    invalid = tagged.filter(quality.invalid_order(TODAY)).count()
    assert invalid == 4


def test_row_rules_alone_accept_a_null_date(orders_frame):
    orders = orders_frame(order(1, order_date=None), order(1, order_date=date(2026, 1, 11)))
    lenient = {str(r.order_date): r.quarantine_reason
               for r in quality.tag_row_reasons(orders, TODAY).collect()}
    assert lenient == {"None": None, "2026-01-11": "future_order_date"}
    strict = quality.tag_row_reasons(orders, TODAY, null_date_is_invalid=True)
    assert quality.quarantined_rows(strict).count() == 2


def test_missing_columns_count_as_missing_values(orders_frame):
    feed = orders_frame(order(1)).drop("product_id")
    tagged = quality.tag_reasons(feed, TODAY, materialize=in_memory)
    assert tagged.collect()[0].quarantine_reasons == ["missing_product_id"]


def test_empty_input_passes(orders_frame, spark):
    empty = spark.createDataFrame([], schemas.ORDERS_RAW)
    row = quality.summary(quality.tag_reasons(empty, TODAY, materialize=in_memory)).collect()[0]
    assert (row.total_rows, row.invalid_percentage, row.threshold_passed) == (0, 0.0, True)
    assert row.quarantine_reason_counts == {}


def test_thresholds(orders_frame):
    orders = orders_frame(*[order(i) for i in range(19)], order(99, quantity=0))
    row = quality.summary(quality.tag_row_reasons(orders, TODAY), threshold=5.0).collect()[0]
    assert row.invalid_percentage == 5.0 and row.threshold_passed
    quality.enforce_threshold(row)
    with pytest.raises(quality.QualityThresholdExceeded):
        quality.enforce_no_invalid(row)
    tighter = quality.summary(quality.tag_row_reasons(orders, TODAY), threshold=4.99).collect()[0]
    with pytest.raises(quality.QualityThresholdExceeded, match="5.0%"):
        quality.enforce_threshold(tighter)


def test_schema_errors(spark, orders_frame):
    good = orders_frame(order(1))
    assert schemas.schema_error_rows(good) == []
    bad = good.drop("product_id").withColumn("status", F.lit(1))
    rows = schemas.schema_errors(spark, bad).collect()
    assert [(r.column, r.reason) for r in rows] == [
        ("product_id", "missing_required_column"), ("status", "invalid_column_type"),
    ]
    report = schemas.schema_report(bad).collect()
    assert [(r.column, r.rows_affected) for r in report] == [("product_id", 1), ("status", 1)]
    assert schemas.schema_report(good).count() == 0


# Silver and gold ----------------------------------------------------------------------------


def test_masking(spark):
    rows = [
        ("Mira van Okafor", "MIRA+shop@Mail.example"), ("  jonas   vidal ", " JV@x.org\t"),
        ("Émile Zola", "no at sign"), ("A", "@x"), ("", "x@"), ("   ", "a@b@c"), (None, None),
        ("O'Neil-Smith", ""),
    ]
    df = spark.createDataFrame(rows, "customer_name string, email string")
    assert [tuple(r) for r in mask_customers(df).collect()] == [
        ("M*** v*** O***", "m***@mail.example"), ("j*** v***", "j***@x.org"),
        ("É*** Z***", "***"), ("A***", "***"), ("", "***"), ("", "a***@b@c"), (None, None),
        ("O***", "***"),
    ]
    other = spark.createDataFrame([(1,)], "id int")
    assert mask_customers(other).columns == ["id"]


def test_silver_types_and_exact_totals(spark):
    df = spark.createDataFrame(
        [("3", "1.005", "completed", "2026-01-01"), ("x", "1", "completed", "bad"),
         ("1", "2", "returned", "2026-01-01")],
        "quantity string, unit_price string, status string, order_date string",
    )
    silver = clean.silver_orders(df)
    assert dict(silver.dtypes) == {
        "quantity": "int", "unit_price": "double", "status": "string", "order_date": "date",
        "total_amount": "double",
    }
    rows = silver.orderBy(F.col("quantity").desc_nulls_last()).collect()
    assert [(r.quantity, r.unit_price, r.total_amount) for r in rows] == [
        (3, 1.005, 3.02), (None, 1.0, None),
    ]
    assert rows[1].order_date is None


def test_late_orders(spark):
    df = spark.createDataFrame(
        [("2026-01-01", "2026-01-03 00:00:00"), ("2026-01-01", "2026-01-03 00:00:01"),
         (None, "2026-01-03 00:00:00")],
        "order_date string, source_update_ts string",
    )
    assert [r.is_late for r in clean.flag_late(df).collect()] == [False, True, False]


def test_gold_on_edge_inputs(spark):
    silver = spark.createDataFrame(
        [(1, 1, 1, date(2026, 1, 1), 0.1), (2, 1, 2, date(2026, 1, 1), 0.2),
         (3, None, 1, date(2026, 1, 1), 1.0), (4, 9, 9, date(2026, 1, 2), None)],
        "order_id int, customer_id int, product_id int, order_date date, total_amount double",
    )
    daily = {str(r.order_date): r for r in gold.daily_sales(silver).collect()}
    first = daily["2026-01-01"]
    assert (first.total_orders, first.unique_customers, first.daily_revenue) == (3, 1, 1.3)
    assert daily["2026-01-02"].daily_revenue is None

    customers = spark.createDataFrame([(1, "France")], "customer_id int, country string")
    products = spark.createDataFrame(
        [(1, "Toys"), (2, "Toys")], "product_id int, category string"
    )
    revenue = gold.revenue_by_category_country(silver, customers, products)
    got = {(r.country, r.category): (r.total_orders, r.unique_customers, r.revenue)
           for r in revenue.collect()}
    assert got == {
        ("France", "Toys"): (2, 1, 0.3), (None, "Toys"): (1, 0, 1.0), (None, None): (1, 1, None),
    }
    empty = gold.totals(gold.daily_sales(silver.limit(0))).collect()[0]
    assert tuple(empty) == (0, 0, 0.0, 0.0)
    ties = spark.createDataFrame(
        [("b", 1.0, 1), ("a", 1.0, 1), (None, 1.0, 1), ("c", 2.0, 1)],
        "country string, revenue double, total_orders bigint",
    )
    assert [r.country for r in gold.top_by_revenue(ties, "country", 4).collect()] == [
        "c", "a", "b", None,
    ]


# Backfill and audit -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "start, end, expected",
    [(None, None, 5), ("2026-01-02", None, 3), (None, "2026-01-02", 2),
     ("2026-01-02", "2026-01-03", 2), ("2026-02-01", None, 0)],
)
def test_window_bounds_are_inclusive(spark, start, end, expected):
    df = spark.createDataFrame(
        [("2026-01-01",), ("2026-01-02",), ("2026-01-03",), ("2026-01-04",), ("bad",)],
        "order_date string",
    )
    assert backfill.in_window(df, start, end).count() == expected


def test_replace_dates(spark):
    existing = spark.createDataFrame(
        [(date(2026, 1, d), d) for d in (1, 2, 3)], "order_date date, n int"
    )
    new = spark.createDataFrame([(date(2026, 1, 2), 20)], "order_date date, n int")
    days = spark.createDataFrame([(date(2026, 1, d),) for d in (2, 3)], "order_date date")
    replaced = backfill.replace_dates(existing, new, days)
    assert sorted(r.n for r in replaced.collect()) == [1, 20]
    outside = spark.createDataFrame([(date(2026, 1, 1), 9)], "order_date date, n int")
    with pytest.raises(Exception, match="outside the dates"):
        backfill.replace_dates(existing, outside, days).collect()
    dates = backfill.affected_dates(existing, new, spark.createDataFrame(
        [(None, 1)], "order_date date, n int"))
    assert dates.count() == 3


def test_operation_coverage(spark):
    log = spark.createDataFrame(
        [("a", None, "WRITE", 1), ("a", None, "MERGE", 1), ("b", None, "WRITE", 2)],
        audit.OPERATIONS_LOG,
    )
    missing = [tuple(r) for r in audit.missing_operations(log).collect()]
    assert missing == [("b", "MERGE")]
    assert audit.require_operations(log, "a").count() == 2
    with pytest.raises(audit.MissingOperations, match="b: missing operations"):
        audit.require_operations(log, "b")


def test_unreadable_dates_are_null(spark):
    df = spark.createDataFrame([("2026-02-30",), ("2026-01-05",)], "d string")
    assert [r[0] for r in df.select(as_date("d")).collect()] == [None, date(2026, 1, 5)]


def test_sized_settings():
    from orderflow.session import sized_settings

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_settings(10**12, 4000)[key] == "7451"
    assert sized_settings(10**6, 64)[key] == "64"
