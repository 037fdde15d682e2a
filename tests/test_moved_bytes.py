"""What shuffles and staged copies carry: no hash texts, the same results."""

from datetime import datetime

from pyspark.sql import functions as F, types as T

from conftest import order
from orderflow.functions.hashing import (
    packed_hash,
    unpacked_hash,
    with_packed_hash,
    with_unpacked_hash,
)
from orderflow.operators import quality, review, upsert, versions
from orderflow.schemas import ORDER_COLUMNS
from orderflow.sources.staging import setting, stage

HASH = "0a" * 32



def test_packed_hashes_come_back_as_they_were(spark):
    texts = [HASH, HASH.upper(), "0a", "", "h2", "ä", "\x00" * 33, HASH + "0a", "g" * 64, None]
    rows = spark.createDataFrame([(text,) for text in texts], "record_hash string")
    found = rows.select("record_hash", packed_hash().alias("b"), unpacked_hash(packed_hash()).alias("back")).collect()
    assert [row.back for row in found] == texts
    assert len(found[0].b) == 32 and all(row.b is None or len(row.b) > 32 for row in found[1:])
    assert len({bytes(row.b) for row in found if row.b is not None}) == len(texts) - 1


def test_latest_orders_move_no_hash_text(spark, orders_frame):
    orders = orders_frame(order(1), order(1, quantity=7), order(1, quantity=3), order(2))
    prepared = versions.prepare_orders(orders, "2026-01-02 00:00:00")
    whole = versions.keep_latest(versions.normalize_orders(orders, "2026-01-02 00:00:00"), "order_id")
    assert sorted(prepared.collect()) == sorted(whole.collect())
    assert prepared.columns == whole.columns
    plan = prepared._jdf.queryExecution().executedPlan().toString()
    plan = plan.partition("== Initial Plan ==")[0]
    below = plan[plan.index("Exchange"):]
    assert "_tie" in below and "AS record_hash" not in below
    assert "AS ingestion_ts" not in below


def test_arrival_times_of_rows_still_decide(spark, orders_frame):
    orders = orders_frame(order(1, quantity=1), order(1, quantity=2)).withColumn(
        "source_update_ts", F.lit("2026-01-01 00:00:00")
    )
    arrival = F.to_timestamp(F.concat(F.lit("2026-01-0"), F.col("quantity")))
    (row,) = versions.prepare_orders(orders, arrival).collect()
    assert row.quantity == 2 and row.ingestion_ts == datetime(2026, 1, 2)


def test_staged_copies_hold_hashes_as_bytes(spark):
    rows = spark.createDataFrame([(1, HASH), (2, "h2"), (3, None)], "order_id bigint, record_hash string")
    copy = stage(rows)
    assert copy.schema == rows.schema and sorted(copy.collect()) == sorted(rows.collect())
    (folder,) = {file.rpartition("/")[0] for file in copy.inputFiles()}
    assert isinstance(spark.read.parquet(folder).schema["record_hash"].dataType, T.BinaryType)


def test_merges_and_reviews_meet_on_bytes(spark, orders_frame):
    first = versions.prepare_orders(orders_frame(order(1), order(2)), "2026-01-03 12:00:00")
    second = versions.prepare_orders(orders_frame(order(1, quantity=5), order(3)), "2026-01-04 00:00:00")
    changes = upsert.changed_rows(stage(first), stage(second))
    wanted = second.select("order_id", "record_hash")
    assert sorted(changes.select("order_id", "record_hash").collect()) == sorted(wanted.collect())
    late = review.late_versions(first)
    made = first.filter("order_id = 1").select(
        "order_id", "record_hash", F.lit("released").alias("decision"),
        F.lit("2026-01-05").cast("timestamp").alias("decided_at"), F.lit("a").alias("decided_by"),
    )
    state = review.review_state(late, made)
    assert dict(state.select("order_id", "review_status").collect()) == {1: "released", 2: "pending"}
    assert review.withhold(first, state).select(*ORDER_COLUMNS).collect() == first.filter(
        "order_id = 1"
    ).select(*ORDER_COLUMNS).collect()


def test_few_unknown_ids_are_broadcast_beside_many_duplicates(spark):
    n = 200_000
    feed = stage(
        spark.range(n).select(
            F.xxhash64(F.floor(F.col("id") / 2)).alias("order_id"),
            F.when(F.col("id") < 3, -1).otherwise(F.col("id") % 50).cast("bigint").alias("customer_id"),
            F.when(F.col("id") == 9, -1).otherwise(F.col("id") % 40).cast("bigint").alias("product_id"),
            F.lit("2026-01-01").cast("date").alias("order_date"),
            F.lit(1).alias("quantity"),
            F.lit(1.5).alias("unit_price"),
            F.lit("completed").alias("status"),
        )
    )
    known = spark.range(50)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "100KB"):
        tagged = quality.tag_reasons(
            feed, "2026-12-31", known.withColumnRenamed("id", "customer_id"), known.withColumnRenamed("id", "product_id")
        )
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
        assert dict(quality.all_reason_counts(tagged).collect()) == {
            "duplicate_order_id": n, "unknown_customer_id": 3, "unknown_product_id": 1,
        }


def test_hashes_of_a_rows_own_columns_are_left_out(spark, orders_frame):
    first = versions.prepare_orders(orders_frame(order(1), order(2, quantity=None), order(3), order(4)), "2026-01-03")
    foreign = F.when(F.col("order_id") == 3, HASH).when(F.col("order_id") != 4, F.col("record_hash"))
    rows = first.withColumn("record_hash", foreign).localCheckpoint()
    packed = with_packed_hash(rows)
    sizes = dict(packed.select("order_id", F.octet_length("record_hash")).collect())
    assert sizes == {1: 0, 2: 0, 3: 32, 4: None}
    for copy in (with_unpacked_hash(packed, rows.schema), stage(rows)):
        assert copy.schema == rows.schema and sorted(copy.collect()) == sorted(rows.collect())
    empty = rows.withColumn("record_hash", F.lit(""))
    assert with_unpacked_hash(with_packed_hash(empty), rows.schema).collect() == empty.collect()
    narrow = rows.select("order_id", "record_hash")
    assert sorted(stage(narrow).collect()) == sorted(narrow.collect())


def test_merged_rows_of_other_types_keep_their_hashes(spark, orders_frame):
    held = versions.prepare_orders(orders_frame(order(1), order(2, unit_price=2.5)), "2026-01-03 00:00:00")
    new = versions.prepare_orders(
        orders_frame(order(2, unit_price=7.25), order(3)).withColumn("unit_price", F.col("unit_price").cast("decimal(18,2)")),
        "2026-01-04 00:00:00",
    )
    assert held.schema["unit_price"].dataType != new.schema["unit_price"].dataType
    merged = upsert.merged_rows(held, new.withColumn("replaced_date", F.col("order_date")))
    hashes = dict(held.union(new).filter("order_id != 2").select("order_id", "record_hash").collect())
    hashes[2] = new.filter("order_id = 2").first().record_hash
    assert dict(merged.select("order_id", "record_hash").collect()) == hashes


def test_changes_are_marked_once_a_key(spark):
    rows = [(1, "2026-01-01"), (1, "2026-01-02"), (2, None), (None, "2026-01-01"), (None, "2026-01-01")]
    changes = spark.createDataFrame(rows, "order_id bigint, replaced_date string")
    marked = upsert.once_per_key(changes).filter(upsert.FIRST).select("order_id").collect()
    assert sorted(row.order_id or 0 for row in marked) == [0, 0, 1, 2]
