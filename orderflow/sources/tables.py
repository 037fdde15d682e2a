"""Publishing: every function here runs jobs.

Tables are catalog tables over Parquet, partitioned by date where the contract says so. Every
publication writes a fresh folder, completely, in one evaluation of its rows; its row count is observed on
that write and its dates are the folders it made. Then the catalog is pointed there:

* a table without partitions by one ``SET LOCATION``;
* a partitioned table by one ``SET LOCATION`` per partition it already has, then one ``ADD PARTITION`` for
  new ones and one ``DROP PARTITION`` for emptied ones. Should a run die between two of these statements, each
  date still has all of its old or all of its new rows, and running the publication again completes it;
* a table that is new, or whose columns were removed or retyped, under a name of its own that is
  renamed when it is complete. Columns that are only added are added in place.

Replaced folders stay for readers that have already planned on them; a later publication deletes them
once they have been out of use for RETAIN_SECONDS.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date as calendar_day
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow.functions.hashing import with_packed_hash, with_unpacked_hash
from orderflow.operators import scd2, upsert as merging, versions
from orderflow.operators.audit import OPERATIONS_LOG
from orderflow.schemas import DIMENSION_METADATA_COLUMNS, INGESTION_COLUMNS
from orderflow.sources.staging import (
    counted_write,
    delete_folder,
    discard,
    file_system,
    lean_jobs,
    setting,
    stage,
    stage_counted,
    staging_scope,
)

# Partitions named in one statement.
DDL_BATCH = 300
# How long a replaced folder is kept.
RETAIN_SECONDS = 24 * 3600
# Bytes of files, of table and batch together, up to which one task reads a whole bucket.
BUCKET_BYTES = 128 << 20
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class PartitioningMismatch(ValueError):
    """The stored table is not partitioned the way a partition replacement needs."""


class Published(NamedTuple):
    """Outcome of a publication, rows written, and the days that were written or dropped."""

    outcome: str
    rows: int
    days: frozenset = frozenset()


class Bucketing(NamedTuple):
    """The key a table's files are bucketed by, and into how many buckets."""

    key: str
    number: int


class _Version(NamedTuple):
    """A folder written completely: its rows, and the folder of every partition value (as text)."""

    path: str
    rows: int
    folders: dict


def partition_columns(spark: SparkSession, name_or_path: str) -> list[str]:
    """Partition columns of a catalog table, or of a folder: those its files do not hold."""
    if "/" not in name_or_path:
        return [c.name for c in spark.catalog.listColumns(name_or_path) if c.isPartition]
    held = spark.read.option("recursiveFileLookup", True).parquet(name_or_path).columns
    return [name for name in spark.read.parquet(name_or_path).columns if name not in held]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row.col_name: row.data_type for row in rows}


def bucketing(spark: SparkSession, table: str) -> Bucketing | None:
    found = _described(spark, table)
    number = int(found.get("Num Buckets", 0))
    return Bucketing(found["Bucket Columns"].strip("[]`"), number) if number > 0 else None


def table_root(spark: SparkSession, table: str) -> str:
    """The folder under which a table's versions are written, in its database's location."""
    database, _, name = table.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{name}"


def execute(spark: SparkSession, statement: str) -> None:
    """All statements that change the catalog go through here."""
    spark.sql(statement)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(column: str, kind: T.DataType, value: str | None) -> str:
    if value is None:
        return f"PARTITION (`{column}` = NULL)"
    literal = f"DATE {_quoted(value)}" if isinstance(kind, T.DateType) else _quoted(value)
    return f"PARTITION (`{column}` = {literal})"


def _value_of(folder_name: str) -> str | None:
    """The partition value in a name like ``date=2026-01-01``; None for that of NULL."""
    value = unquote(folder_name.partition("=")[2])
    return None if value == _NO_VALUE else value


def _batches(clauses: list[str], joiner: str) -> Iterator[str]:
    for at in range(0, len(clauses), DDL_BATCH):
        yield joiner.join(clauses[at : at + DDL_BATCH])


# Writing a version -------------------------------------------------------------------------------


def _laid_out(df: DataFrame, keys: list[str], buckets: Bucketing | None) -> DataFrame:
    """Gather each partition's rows into few files; AQE splits a partition that is too large."""
    if not buckets:
        return df.hint("rebalance", *[F.col(name) for name in keys]) if keys else df
    bucket = F.pmod(F.hash(buckets.key), F.lit(buckets.number))
    marked = df.withColumn("_bucket", bucket)
    return marked.hint("rebalance", *[F.col(name) for name in [*keys, "_bucket"]]).drop("_bucket")


def _columns_sql(schema: T.StructType, keys: list[str]) -> str:
    fields = sorted(schema.fields, key=lambda field: field.name in keys)
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)


def _create(
    spark: SparkSession, table: str, schema: T.StructType, keys: list[str], path: str,
    buckets: Bucketing | None,
) -> None:
    by = f"PARTITIONED BY ({', '.join(f'`{name}`' for name in keys)})" if keys else ""
    clustered = f"CLUSTERED BY (`{buckets.key}`) INTO {buckets.number} BUCKETS" if buckets else ""
    execute(
        spark,
        f"CREATE TABLE {table} ({_columns_sql(schema, keys)}) USING parquet {by} {clustered} "
        f"LOCATION {_quoted(path)}",
    )


def _write_version(
    df: DataFrame, table: str, keys: list[str], buckets: Bucketing | None = None
) -> _Version:
    """Write the rows to a fresh folder, once; bucketed files need a table to be written through."""
    spark = df.sparkSession
    path = f"{table_root(spark, table)}/v-{uuid.uuid4().hex}"
    rows = with_unpacked_hash(_laid_out(with_packed_hash(df), keys, buckets), df.schema)
    if buckets:
        through = f"{table}__load_{uuid.uuid4().hex}"
        _create(spark, through, df.schema, keys, path, buckets)
        ordered = rows.select(*spark.table(through).columns)
        count = counted_write(ordered, lambda counted: counted.write.insertInto(through))
        execute(spark, f"DROP TABLE {through}")
    else:
        count = counted_write(rows, lambda counted: counted.write.partitionBy(*keys).parquet(path))
    if not keys:
        return _Version(path, count, {})
    system, root = file_system(spark, path)
    made = [status.getPath() for status in system.listStatus(root) if status.isDirectory()]
    names = [(folder.getName(), folder.toString()) for folder in made]
    folders = {_value_of(name): place for name, place in names if name.startswith(f"{keys[0]}=")}
    return _Version(path, count, folders)


# Pointing the catalog at a version -----------------------------------------------------------------


def stored_values(spark: SparkSession, table: str) -> set:
    """Values a table has partitions for, as text, from the catalog; None for that of NULL."""
    return {_value_of(row[0]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _as_day(value: str | None) -> calendar_day | None:
    return None if value is None else calendar_day.fromisoformat(value)


def stored_days(spark: SparkSession, table: str, date: str) -> set:
    """Days a table has partitions for; None for the partition of NULL."""
    return {_as_day(value) for value in stored_values(spark, table)}


def _folders_in_use(spark: SparkSession, table: str, column: str | None = None, values: set = frozenset()) -> set:
    """Folders that hold the files of some partitions, or of a table without partitions."""
    df = spark.table(table)
    if column is not None:
        text = F.col(column).cast("string")
        named = text.isin(*[value for value in values if value is not None])
        df = df.filter(named | text.isNull() if None in values else named)
    return {unquote(file.rpartition("/")[0]) for file in df.inputFiles()}


def _bytes_of(spark: SparkSession, folders: set) -> int:
    total = 0
    for folder in folders:
        system, path = file_system(spark, folder)
        total += system.getContentSummary(path).getLength()
    return total


@contextmanager
def bounded_buckets(spark: SparkSession, table: str, batch: DataFrame) -> Iterator[None]:
    """Plans made inside read the table by buckets only while one task can hold a bucket.

    A join on the bucketed key has one task a bucket, whatever the size of the table and of the staged
    batch. Where they have outgrown the table's buckets, it is shuffled like any other.
    """
    found = bucketing(spark, table)
    if found:
        folders = _folders_in_use(spark, table)
        folders |= {unquote(file.rpartition("/")[0]) for file in batch.inputFiles()}
        if _bytes_of(spark, folders) > BUCKET_BYTES * found.number:
            with setting(spark, "spark.sql.sources.bucketing.enabled", "false"):
                yield
            return
    yield


def _point_partitions(
    spark: SparkSession, table: str, column: str, folders: dict, gone: set
) -> None:
    """Let the table's partitions be these folders, and drop those that are gone."""
    kind = spark.table(table).schema[column].dataType
    held = stored_values(spark, table)
    replaced = (set(folders) | gone) & held
    old = _folders_in_use(spark, table, column, replaced) if replaced else set()
    for value in sorted(set(folders) & held, key=str):
        spec = _spec(column, kind, value)
        execute(spark, f"ALTER TABLE {table} {spec} SET LOCATION {_quoted(folders[value])}")
    added = [
        f"{_spec(column, kind, value)} LOCATION {_quoted(folders[value])}"
        for value in sorted(set(folders) - held, key=str)
    ]
    for clauses in _batches(added, " "):
        execute(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
    dropped = [_spec(column, kind, value) for value in sorted(gone & held, key=str)]
    for clauses in _batches(dropped, ", "):
        execute(spark, f"ALTER TABLE {table} DROP IF EXISTS {clauses}")
    _retire(spark, table, old)


def _swap_partitions(
    df: DataFrame, table: str, column: str, listed: set | None = None, keep_others: bool = False
) -> tuple[int, frozenset]:
    """Swap in the partitions the rows have and drop the listed ones (by default all) they lack.

    Values are text. With ``keep_others`` nothing is dropped.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    version = _write_version(rows, table, [column], bucketing(spark, table))
    present = set(version.folders)
    if keep_others:
        listed = present
    elif listed is None:
        listed = stored_values(spark, table) | present
    outside = sorted(str(value) for value in present - listed)
    if outside:
        delete_folder(spark, version.path)
        raise ValueError(f"rows outside the dates to replace in {table}: {outside[:5]}")
    _point_partitions(spark, table, column, version.folders, listed - present)
    return version.rows, frozenset(listed)


def _retire(spark: SparkSession, table: str, folders: set) -> None:
    """Note folders nothing points at any more, and delete those noted long enough ago."""
    root = table_root(spark, table)
    if folders:
        system, note = file_system(spark, f"{root}/_retired/{uuid.uuid4().hex}")
        stream = system.create(note)
        stream.write(bytearray("\n".join(sorted(folders)).encode()))
        stream.close()
    sweep_retired(spark, table)


def sweep_retired(spark: SparkSession, table: str, older_than: float | None = None) -> int:
    """Delete folders that were replaced at least so many seconds ago; returns how many."""
    system, notes = file_system(spark, f"{table_root(spark, table)}/_retired")
    limit = time.time() - (RETAIN_SECONDS if older_than is None else older_than)
    deleted = 0
    for status in system.listStatus(notes) if system.exists(notes) else []:
        if status.getModificationTime() / 1000 <= limit:
            stream = system.open(status.getPath())
            folders = bytes(stream.readAllBytes()).decode().split("\n")
            stream.close()
            for folder in folders:
                delete_folder(spark, folder)
            system.delete(status.getPath(), False)
            deleted += len(folders)
    return deleted


def restore_table(spark: SparkSession, table: str) -> None:
    """Finish the renaming of a table that a run died in; does nothing otherwise."""
    following, old = f"{table}__next", f"{table}__old"
    if spark.catalog.tableExists(old):
        if not spark.catalog.tableExists(table):
            execute(spark, f"ALTER TABLE {following} RENAME TO {table}")
        execute(spark, f"DROP TABLE IF EXISTS {old}")


def _recreate(
    version: _Version, table: str, schema: T.StructType, keys: list[str],
    buckets: Bucketing | None, spark: SparkSession,
) -> None:
    """Create the table complete under another name, then rename."""
    following, old = f"{table}__next", f"{table}__old"
    execute(spark, f"DROP TABLE IF EXISTS {following}")
    _create(spark, following, schema, keys, version.path, buckets)
    if keys:
        _point_partitions(spark, following, keys[0], version.folders, set())
    folders = set()
    if spark.catalog.tableExists(table):
        folders = _folders_in_use(spark, table)
        execute(spark, f"ALTER TABLE {table} RENAME TO {old}")
    execute(spark, f"ALTER TABLE {following} RENAME TO {table}")
    execute(spark, f"DROP TABLE IF EXISTS {old}")
    _retire(spark, table, folders)


def _types(schema: T.StructType) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in schema.fields}


def publish_table(
    df: DataFrame, table: str, partition_by: list[str] | None = None,
    buckets: Bucketing | None = None,
) -> int:
    """Create a table or replace all of it, schema included; returns the rows written.

    The frame may read the table it replaces, and a write that fails leaves the old table as it was.
    At most one partition column; a replaced table keeps its bucketing unless another is given.
    """
    spark, keys = df.sparkSession, list(partition_by or [])
    if len(keys) > 1:
        raise ValueError("tables have at most one partition column")
    restore_table(spark, table)
    wanted = _types(df.schema)
    if spark.catalog.tableExists(table):
        present = _types(spark.table(table).schema)
        found = bucketing(spark, table)
        buckets = buckets or found
        widened = all(wanted.get(name) == kind for name, kind in present.items())
        if widened and buckets == found and partition_columns(spark, table) == keys:
            return _replace_all(df, table, keys, present)
    version = _write_version(df, table, keys, buckets)
    _recreate(version, table, df.schema, keys, buckets, spark)
    return version.rows


def _replace_all(df: DataFrame, table: str, keys: list[str], present: dict[str, str]) -> int:
    """Replace all rows of a table with the same layout, after adding the columns it lacks."""
    spark = df.sparkSession
    missing = [field for field in df.schema.fields if field.name not in present]
    # Written before the first statement, so that a failing frame changes nothing.
    ordered = df.select(*[name for name in df.columns if name not in keys], *keys)
    version = _write_version(ordered, table, keys, bucketing(spark, table))
    if missing:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        execute(spark, f"ALTER TABLE {table} ADD COLUMNS ({added})")
    if keys:
        gone = stored_values(spark, table) - set(version.folders)
        _point_partitions(spark, table, keys[0], version.folders, gone)
    else:
        old = _folders_in_use(spark, table)
        execute(spark, f"ALTER TABLE {table} SET LOCATION {_quoted(version.path)}")
        _retire(spark, table, old)
    return version.rows


# Publications --------------------------------------------------------------------------------------


def _days(df: DataFrame, date: str) -> set:
    """Distinct days as driver values, for partition statements only; bounded by the calendar."""
    with lean_jobs(df.sparkSession):
        return {row[0] for row in df.select(date).distinct().collect()}


def _texts(days: set) -> set:
    return {None if day is None else day.isoformat() for day in days}


def _replace_days(df: DataFrame, table: str, date: str, listed: set | None = None) -> tuple[int, frozenset]:
    texts = None if listed is None else _texts(listed)
    rows, values = _swap_partitions(df, table, date, texts)
    return rows, frozenset(_as_day(value) for value in values)


def _require_partitioning(spark: SparkSession, table: str, date: str) -> None:
    found = partition_columns(spark, table)
    if found != [date]:
        raise PartitioningMismatch(f"{table} is partitioned by {found}, not by ['{date}']")


def _created(
    df: DataFrame, table: str, date: str, outcome: str = "created", buckets: Bucketing | None = None
) -> Published:
    rows = publish_table(df, table, [date], buckets)
    return Published(outcome, rows, frozenset(stored_days(df.sparkSession, table, date)))


def publish_dates(
    df: DataFrame, table: str, dates: DataFrame | set, date: str = "order_date"
) -> Published:
    """Replace exactly the listed dates of a table with the rows of ``df``.

    The outcome is ``skipped``, ``created`` or ``replaced_partitions``. A table with other partition
    columns is refused, because rewriting it from a window of rows would lose all other dates; so is
    a row outside the listed dates.
    """
    spark = df.sparkSession
    listed = (dates if isinstance(dates, set) else _days(dates, date)) - {None}
    if not listed:
        return Published("skipped", 0)
    if not spark.catalog.tableExists(table):
        return _created(df, table, date)
    _require_partitioning(spark, table, date)
    return Published("replaced_partitions", *_replace_days(df, table, date, listed))


def publish_all_dates(df: DataFrame, table: str, date: str = "order_date") -> Published:
    """Replace every date of a table; the old content stays until the new one is written.

    Columns the table lacks are added to it.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table) or set(spark.table(table).columns) != set(df.columns):
        return _created(df, table, date)
    _require_partitioning(spark, table, date)
    return Published("overwrite", *_replace_days(df, table, date))


def _merged(
    found: Callable, updates: DataFrame, target: DataFrame, table: str, key: str, date: str
) -> Published:
    """Find the changes a batch makes and publish them; staged copies go as soon as they were read."""
    with staging_scope():
        batch = stage(updates)
        with bounded_buckets(updates.sparkSession, table, batch):
            changes = stage(merging.once_per_key(found(target, batch, key, date), key))
        discard(batch)
        return _publish_changes(changes, target, table, key, date)


def _publish_changes(
    changes: DataFrame, target: DataFrame, table: str, key: str, date: str
) -> Published:
    """Rewrite the dates that staged changes touch, reading no others."""
    spark = changes.sparkSession
    touched = _days(merging.touched_dates(changes, date), date)
    if not touched:
        return Published("merged", 0)
    # A literal list lets the scan skip all other partitions while it is planned.
    named = F.col(date).isin(*[day for day in touched if day])
    pruned = target.filter(named | F.col(date).isNull() if None in touched else named)
    content = merging.merged_rows(pruned, changes, key)
    with bounded_buckets(spark, table, changes):
        return Published("merged", *_replace_days(content, table, date, touched))


def publish_upsert(
    updates: DataFrame, table: str, key: str = "order_id", date: str = "order_date",
    buckets: int | None = None,
) -> Published:
    """Merge prepared updates into a date-partitioned table, rewriting only the dates they touch.

    The outcome is ``created``, ``migrated`` (the table had no metadata columns yet) or ``merged``. A
    table created with ``buckets`` has its files bucketed by the key: a merge then shuffles the
    batch only, while a bucket is no more than a task can read (``bounded_buckets``).
    """
    spark = updates.sparkSession
    wanted = Bucketing(key, buckets) if buckets else None
    if not spark.catalog.tableExists(table):
        return _created(updates, table, date, buckets=wanted)
    target = spark.table(table)
    if versions.lacks_metadata(target, INGESTION_COLUMNS):
        migrated = versions.migrate_orders(target, updates)
        return _created(migrated, table, date, "migrated", wanted)
    return _merged(merging.changed_rows, updates, target, table, key, date)


def publish_unconditional(
    updates: DataFrame, table: str, key: str = "order_id", date: str = "order_date"
) -> Published:
    """Replace rows by key whatever their age and add new ones; only the touched dates are rewritten."""
    spark = updates.sparkSession
    if not spark.catalog.tableExists(table):
        return _created(updates, table, date)
    target = spark.table(table)
    return _merged(merging.forced_rows, updates, target, table, key, date)


def publish_dimension(
    updates: DataFrame, table: str, key: str, business_columns: list[str], guard: bool = True
) -> tuple[Published, int]:
    """Merge prepared versions into a type 2 dimension; also returns the number of late versions.

    The table is partitioned by ``is_current``. Newly closed versions are appended to the closed
    ones, whose files are left alone, unless a run that died had appended them before; then the
    current ones are replaced. With ``guard``, versions that start before the current one are kept in
    a table of their own, with ``_late`` added to the name, one partition per day of arrival.
    """
    spark, flag = updates.sparkSession, "is_current"
    if not spark.catalog.tableExists(table):
        return Published("created", publish_table(updates, table, [flag])), 0
    target = spark.table(table)
    if versions.lacks_metadata(target, DIMENSION_METADATA_COLUMNS):
        migrated = versions.migrate_dimension(target, updates, key, business_columns)
        return Published("migrated", publish_table(migrated, table, [flag])), 0
    if partition_columns(spark, table) != [flag]:
        publish_table(target, table, [flag])
        target = spark.table(table)
    late, late_rows = None, 0
    if guard:
        late, late_rows = stage_counted(scd2.late_versions(target, updates, key))
    current = scd2.merge_current(target, updates, key, guard).select(*target.columns)
    merged, rows = stage_counted(current)
    same = [key, "valid_from", "record_hash"]
    closed = merged.filter(f"NOT {flag}").join(
        target.filter(f"NOT {flag}").select(*same), same, "left_anti"
    )
    closed.select(*target.columns).write.insertInto(table)
    _swap_partitions(merged.filter(flag), table, flag, {"true"})
    if late_rows:
        _keep_apart(late, f"{table}_late", "ingestion_date")
    return Published("merged", rows), late_rows


def _keep_apart(rows: DataFrame, table: str, partition: str) -> None:
    if not rows.sparkSession.catalog.tableExists(table):
        publish_table(rows, table, [partition])
    else:
        _swap_partitions(rows, table, partition, keep_others=True)


def publish_batch(rows: DataFrame, table: str, batch: str) -> int:
    """Keep rows that cannot be merged beside a table, in one partition per batch.

    Replaying a batch replaces its partition, and removes it if there are no such rows any more.
    """
    spark = rows.sparkSession
    kept, count = stage_counted(rows.withColumn("batch", F.lit(batch)))
    if count:
        _keep_apart(kept, table, "batch")
    elif spark.catalog.tableExists(table):
        _point_partitions(spark, table, "batch", {}, {batch})
    return count


def publish_unkeyed(normalized: DataFrame, table: str, batch: str, key: str = "order_id") -> int:
    """Keep a batch's rows without a key beside the merged table, all of them."""
    return publish_batch(versions.without_key(normalized, key), table, batch)


def log_operation(
    spark: SparkSession, log_table: str, table: str, operation: str, rows: int
) -> None:
    entry = spark.createDataFrame(
        [(table, operation, rows)], "table_name string, operation string, rows bigint"
    ).withColumn("logged_at", F.current_timestamp())
    entry = entry.select(*OPERATIONS_LOG.fieldNames())
    if spark.catalog.tableExists(log_table):
        entry.write.insertInto(log_table)
    else:
        entry.write.format("parquet").saveAsTable(log_table)


def write_document(one_row: DataFrame, path: str) -> None:
    """A one-row frame as a JSON document with the columns in the given order."""
    one_row.coalesce(1).write.mode("overwrite").json(path)
