"""Switching tables to new folders: faults between statements, retired folders, layouts, row counts."""

import glob
import os
import time
from datetime import date

import pytest
from conftest import order
from pyspark.sql import functions as F

from orderflow.operators import upsert, versions
from orderflow.sources import staging, tables
from orderflow.sources.staging import stage, stage_counted


class Fault(Exception):
    pass


def sales(spark, *rows):
    return spark.createDataFrame(
        [(None if d is None else date(2026, 1, d), n) for d, n in rows], "order_date date, n int"
    )


def by_day(spark, name):
    found = {}
    for row in spark.table(name).collect():
        found.setdefault(row.order_date and row.order_date.day, []).append(row.n)
    return {day: sorted(values) for day, values in found.items()}


def failing_at(monkeypatch, statement):
    """Let the n-th statement (from 0) fail; returns the list of statements run."""
    run, original = [], tables.execute

    def execute(spark, text):
        if len(run) == statement:
            run.append(None)
            raise Fault(text)
        run.append(text)
        original(spark, text)

    monkeypatch.setattr(tables, "execute", execute)
    return run


OLD = [(1, 1), (2, 2), (3, 3), (None, 9)]
NEW = [(1, 10), (2, 20), (5, 50), (6, 60)]


@pytest.mark.parametrize("fault", range(7))
def test_a_fault_between_statements_leaves_each_date_old_or_new(spark, database, monkeypatch, fault):
    name = f"{database}.sales"
    tables.publish_all_dates(sales(spark, *OLD), name)
    monkeypatch.setattr(tables, "DDL_BATCH", 1)
    with monkeypatch.context() as patch:
        run = failing_at(patch, fault)
        try:
            tables.publish_all_dates(sales(spark, *NEW), name)
        except Fault:
            assert run[-1] is None
        else:
            assert len(run) == 6 == fault  # every statement has failed once
    old, new = {d: [n] for d, n in OLD}, {d: [n] for d, n in NEW}
    found = by_day(spark, name)
    for day in {*old, *new}:
        assert found.get(day) in (old.get(day), new.get(day))
    if fault == 0:
        assert found == old
    assert tables.publish_all_dates(sales(spark, *NEW), name).rows == 4
    assert by_day(spark, name) == new


@pytest.mark.parametrize("fault", range(2))
def test_a_table_without_partitions_switches_in_one_statement(spark, database, monkeypatch, fault):
    name = f"{database}.plain"
    tables.publish_table(sales(spark, (1, 1)), name)
    with monkeypatch.context() as patch:
        run = failing_at(patch, fault)
        if fault == 0:
            with pytest.raises(Fault):
                tables.publish_table(sales(spark, (2, 2)), name)
            assert by_day(spark, name) == {1: [1]}
        else:
            tables.publish_table(sales(spark, (2, 2)), name)
            assert [t.split()[0:2] for t in run][:1] == [["ALTER", "TABLE"]] and len(run) == 1
            assert by_day(spark, name) == {2: [2]}


@pytest.mark.parametrize("fault", range(8))
def test_a_retyped_table_is_renamed_when_it_is_complete(spark, database, monkeypatch, fault):
    name = f"{database}.retyped"
    tables.publish_table(sales(spark, (1, 1)), name, ["order_date"])
    retyped = sales(spark, (1, 5), (2, 6)).selectExpr("order_date", "'x' AS label")
    with monkeypatch.context() as patch:
        failing_at(patch, fault)
        try:
            tables.publish_table(retyped, name, ["order_date"])
        except Fault:
            pass
    tables.restore_table(spark, name)
    assert spark.table(name).columns in (["n", "order_date"], ["label", "order_date"])
    assert spark.table(name).count() == (1 if "n" in spark.table(name).columns else 2)
    assert tables.publish_table(retyped, name, ["order_date"]) == 2
    assert spark.table(name).columns == ["label", "order_date"]
    assert {t.name for t in spark.catalog.listTables(database)} == {"retyped"}


def test_new_columns_are_added_in_place(spark, database):
    name = f"{database}.wider"
    tables.publish_all_dates(sales(spark, (1, 1), (2, 2)), name)
    wider = sales(spark, (2, 3)).selectExpr("'new' AS note", "order_date", "n")
    assert tables.publish_all_dates(wider, name).rows == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [(3, "new", date(2026, 1, 2))]
    tables.publish_dates(sales(spark, (4, 4)).withColumn("note", F.lit("x")), name, {date(2026, 1, 4)})
    assert by_day(spark, name) == {2: [3], 4: [4]}


def test_readers_that_planned_before_a_switch_can_finish(spark, database):
    name = f"{database}.read"
    tables.publish_all_dates(sales(spark, (1, 1), (2, 2)), name)
    planned = spark.table(name)
    files = planned.inputFiles()
    before = spark.read.parquet(*{f.rpartition("/")[0] for f in files})
    tables.publish_all_dates(sales(spark, (1, 7)), name)
    assert sorted(r.n for r in before.collect()) == [1, 2]
    assert by_day(spark, name) == {1: [7]}
    assert tables.sweep_retired(spark, name) == 0
    assert tables.sweep_retired(spark, name, older_than=-5) == 2
    assert by_day(spark, name) == {1: [7]}
    with pytest.raises(Exception):
        spark.read.parquet(*{f.rpartition("/")[0] for f in files}).collect()


def test_odd_partition_values(spark, database):
    name = f"{database}.batches"
    for batch in ("a b", "it's", "50%", "x=y/z", "ü\\n"):
        assert tables.publish_batch(sales(spark, (1, 1)), name, batch) == 1
    assert tables.publish_batch(sales(spark, (1, 2), (1, 3)), name, "it's") == 2
    assert tables.publish_batch(sales(spark), name, "50%") == 0
    rows = sorted((r.batch, r.n) for r in spark.table(name).collect())
    assert rows == [("a b", 1), ("it's", 2), ("it's", 3), ("x=y/z", 1), ("ü\\n", 1)]


def test_untouched_dates_keep_their_files(spark, database, orders_frame):
    name = f"{database}.bronze"
    first = versions.prepare_orders(
        orders_frame(*[order(i, order_date=date(2026, 1, i)) for i in (1, 2, 3)]), "2026-01-05"
    )
    tables.publish_upsert(first, name)

    def files(day):
        return set(spark.table(name).filter(F.col("order_date") == date(2026, 1, day)).inputFiles())

    before = {day: files(day) for day in (1, 2, 3)}
    older = versions.prepare_orders(
        orders_frame(order(2, quantity=9, order_date=date(2026, 1, 4)), order(None)), "2026-01-01"
    )
    bare = older.select("order_id", "customer_id", "order_date", "quantity")
    bare = bare.unionByName(bare.limit(1).withColumn("order_id", F.lit(None).cast("long")))
    done = tables.publish_unconditional(bare, name)
    assert done.days == {date(2026, 1, 2), date(2026, 1, 4)}
    assert files(1) == before[1] and files(3) == before[3] and files(2) == set()
    got = sorted((r.order_id or 0, r.quantity, r.status) for r in spark.table(name).collect())
    assert got == [(0, 9, None), (1, 1, "completed"), (2, 9, None), (3, 1, "completed")]


def test_a_merge_does_not_shuffle_a_bucketed_target(spark, database, orders_frame):
    name = f"{database}.bucketed"
    first = versions.prepare_orders(
        orders_frame(*[order(i, order_date=date(2026, 1, 1 + i % 3)) for i in range(60)]), "2026-01-05"
    )
    assert tables.publish_upsert(first, name, buckets=4).outcome == "created"
    assert tables.bucketing(spark, name) == ("order_id", 4)
    batch = versions.prepare_orders(
        orders_frame(*[order(i, quantity=7, order_date=date(2026, 1, 2)) for i in range(50, 70)]), "2026-01-06"
    )
    with staging.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        for merge in (upsert.changed_rows, upsert.forced_rows):
            changes = merge(spark.table(name), stage(batch))
            plan = changes._jdf.queryExecution().executedPlan().toString()
            scans = [line for line in plan.splitlines() if "bucketed" in line.lower()]
            assert scans and "Bucketed: true" in "".join(scans)
            # Every exchange moves the batch: below the target's scan there is none.
            assert _exchanges_over(changes, "bucketed") == 0
        assert tables.publish_upsert(batch, name).rows > 0
    plain = f"{database}.plain"
    tables.publish_upsert(first, plain)
    tables.publish_upsert(batch, plain)
    assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, spark.table(plain).collect()))
    assert tables.bucketing(spark, name) == ("order_id", 4) and spark.table(name).count() == 70
    assert {t.name for t in spark.catalog.listTables(database)} == {"bucketed", "plain"}


def test_a_table_that_outgrew_its_buckets_is_read_without_them(spark, database, orders_frame, monkeypatch):
    first = versions.prepare_orders(
        orders_frame(*[order(i, order_date=date(2026, 1, 1 + i % 3)) for i in range(60)]), "2026-01-05"
    )
    batch = versions.prepare_orders(
        orders_frame(*[order(i, quantity=7, order_date=date(2026, 1, 2)) for i in range(50, 70)]), "2026-01-06"
    )
    bare = batch.select("order_id", "customer_id", "order_date", "quantity")
    plans = {}

    def staged(df):
        plans.setdefault(at, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    monkeypatch.setattr(tables, "stage", staged)
    held = {}
    for at in ("within", "outgrown"):
        name = f"{database}.{at}"
        tables.publish_upsert(first, name, buckets=4)
        with monkeypatch.context() as patch, staging.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            if at == "outgrown":
                patch.setattr(tables, "BUCKET_BYTES", 1)
            tables.publish_upsert(batch, name)
            tables.publish_unconditional(bare, name)
        assert tables.bucketing(spark, name) == ("order_id", 4)
        held[at] = sorted(map(str, spark.table(name).collect()))
    assert held["within"] == held["outgrown"] and len(held["within"]) == 70
    assert sum("Bucketed: true" in plan for plan in plans["within"]) == 2
    assert not any("Bucketed: true" in plan for plan in plans["outgrown"])


def _exchanges_over(df, table):
    """Shuffles between the scan of a table and the root, counted on the physical plan's lines."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    count = 0
    for line in reversed(lines[:at]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            # A join above the scan ends the target's own branch.
            if "Join" in line:
                break
            count += "Exchange" in line
    return count


def test_a_key_left_under_two_dates_is_mended_by_the_next_change(spark, database, orders_frame):
    name = f"{database}.twice"
    first = versions.prepare_orders(orders_frame(order(1), order(2)), "2026-01-05")
    tables.publish_upsert(first, name)
    moved = versions.prepare_orders(orders_frame(order(1, order_date=date(2026, 1, 3))), "2026-01-06")
    # What a run leaves that dies after it has added the new date and before it takes the row from the old.
    tables.publish_dates(moved, name, {date(2026, 1, 3)})
    assert spark.table(name).filter("order_id = 1").count() == 2
    again = versions.prepare_orders(
        orders_frame(order(1, quantity=8, order_date=date(2026, 1, 4))), "2026-01-07"
    )
    tables.publish_upsert(again, name)
    assert sorted((r.order_id, r.quantity) for r in spark.table(name).collect()) == [(1, 8), (2, 1)]


def test_counts_come_from_the_write_also_for_empty_input(spark, database, orders_frame):
    for rows in ([], [order(1), order(2)]):
        source = stage(orders_frame(*rows))
        seen_rows, seen = staging.observed(source)
        staged, written = stage_counted(seen_rows.groupBy("order_date").count().repartition(3))
        assert staging.observed_rows(seen) == len(rows)
        assert written == staged.count() == min(1, len(rows))
    name = f"{database}.none"
    empty, seen = staging.observed(stage(sales(spark)))
    joined = empty.join(sales(spark, (1, 1)).select("order_date"), "order_date")
    assert tables.publish_all_dates(joined, name).rows == 0
    assert staging.observed_rows(seen) == 0
    with pytest.raises(Exception, match="no count"):
        stage_counted(sales(spark, (1, 1)).withColumn("n", F.expr("raise_error('no count')").cast("int")))


def test_an_upsert_evaluates_its_batch_once(spark, database, orders_frame):
    name = f"{database}.once"
    tables.publish_upsert(versions.prepare_orders(orders_frame(order(1)), "2026-01-05"), name)
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda n: seen.add(1) or n, "int")
    batch = versions.prepare_orders(orders_frame(*[order(i) for i in range(1, 41)]), "2026-01-06")
    done = tables.publish_upsert(batch.withColumn("quantity", count("quantity")), name)
    assert (seen.value, done.rows, spark.table(name).count()) == (40, 40, 40)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {file for place in blocks.localDirsString() for file in glob.glob(f"{place}/*/shuffle_*.data")}


def test_a_publication_leaves_its_table_alone_on_disk(spark, database, orders_frame, monkeypatch):
    name, work = f"{database}.lean", staging.work_root(spark)
    copies, held = [], []

    def staged(df):
        held.append([os.path.exists(path) for path in copies])
        copy = stage(df)
        copies.extend({file.removeprefix("file:").rpartition("/")[0] for file in copy.inputFiles()})
        return copy

    def replaced(*args):
        held.append([os.path.exists(path) for path in copies])
        return replace(*args)

    replace = tables._replace_days
    monkeypatch.setattr(tables, "stage", staged)
    monkeypatch.setattr(tables, "_replace_days", replaced)
    before = shuffle_files(spark)
    first, second = (
        versions.prepare_orders(
            orders_frame(*[order(i, quantity=n, order_date=date(2026, 1, 1 + i % 3)) for i in range(40 * n)]), f"2026-01-0{n}"
        )
        for n in (1, 2)
    )
    with staging.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        tables.publish_upsert(first, name, buckets=4)
        tables.publish_upsert(second, name)
        # The batch is gone before the dates are rewritten, the changes afterwards.
        assert held == [[], [True], [False, True]] and work in copies[0]
        tables.publish_unconditional(second.select("order_id", "customer_id", "order_date"), name)
    assert len(copies) == 4 and not any(map(os.path.exists, copies))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.table(name).count() == 80
    assert all(".zstd." in file for file in spark.table(name).inputFiles())


def test_a_codec_the_session_names_is_used(spark, database):
    with staging.setting(spark, "spark.sql.parquet.compression.codec", "gzip"):
        tables.publish_table(sales(spark, (1, 1)), f"{database}.zipped")
    assert all(".gz." in file for file in spark.table(f"{database}.zipped").inputFiles())
