"""Type 2 dimensions: merging new versions, current rows and as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def current(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("is_current"))


def _supersedes(guard: bool) -> Column:
    changed = F.col("s.record_hash") != F.col("t.record_hash")
    if guard:
        changed &= F.col("s.valid_from") >= F.col("t.valid_from")
    return F.coalesce(changed, F.lit(False))


def changed_versions(
    target: DataFrame, updates: DataFrame, key: str, guard: bool = False
) -> DataFrame:
    """Updates whose content differs from the current version of the same key."""
    s, t = updates.alias("s"), current(target).alias("t")
    return (
        s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"))
        .filter(_supersedes(guard))
        .select("s.*")
    )


def late_versions(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates that the guarded merge refuses: other content, but an earlier start."""
    s, t = updates.alias("s"), current(target).alias("t")
    return (
        s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"))
        .filter(_supersedes(guard=False) & ~_supersedes(guard=True))
        .select("s.*")
    )


def scd2_merge(target: DataFrame, updates: DataFrame, key: str, guard: bool = True) -> DataFrame:
    """The dimension after one batch of prepared updates: history, and ``merge_current``."""
    history = target.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    return history.unionByName(merge_current(target, updates, key, guard))


def merge_current(target: DataFrame, updates: DataFrame, key: str, guard: bool = True) -> DataFrame:
    """What becomes of the current versions: kept, or closed and followed by a new one.

    A changed key has its current version closed at the start of the new one; a new key is added;
    equal content and keys absent from the batch stay as they are. History never enters the join,
    so a key with very many versions costs no more than any other. ``guard`` refuses versions that
    start before the current one (see ``late_versions``); without it an older row would close a
    newer one.
    """
    columns = target.columns
    t, s = current(target).alias("t"), updates.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")

    held = F.struct(*[F.col(f"t.{name}").alias(name) for name in columns])
    incoming = F.struct(*[F.col(f"s.{name}").alias(name) for name in columns])
    closing = {"valid_to": F.col("s.valid_from"), "is_current": F.lit(False)}
    closed = F.struct(
        *[closing.get(name, F.col(f"t.{name}")).alias(name) for name in columns]
    )
    outcome = (
        F.when(F.col(f"t.{key}").isNull(), F.array(incoming))
        .when(_supersedes(guard), F.array(closed, incoming))
        .otherwise(F.array(held))
    )
    return joined.select(F.inline(outcome)).select(*columns)


def _first_full_day(ts: Column) -> Column:
    day = ts.cast("date")
    return F.when(ts > day.cast("timestamp"), F.date_add(day, 1)).otherwise(day)


def versions_on_days(
    days: DataFrame, dimension: DataFrame, key: str, day: str, columns: list[str]
) -> DataFrame:
    """For each distinct (key, day): the version with ``valid_from <= day < valid_to``.

    The latest start is carried forward along each key's days in one sorted pass. Both inputs are
    first reduced to one row per key and day, so a window group is bounded by the calendar however
    many facts or versions a key has, and no pairs of facts and versions are formed.
    """
    wanted = days.select(key, F.col(day).alias("_day")).distinct()
    # valid_from orders the versions that first apply on the same midnight; the last one holds it.
    starts = (
        dimension.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
        .withColumn("_day", _first_full_day(F.col("valid_from")))
        .groupBy(key, "_day")
        .agg(
            F.max_by(
                F.struct("valid_to", *columns), F.struct("valid_from", "record_hash")
            ).alias("_version")
        )
    )
    events = starts.withColumn("_asked", F.lit(False)).unionByName(
        wanted.withColumn("_asked", F.lit(True)), allowMissingColumns=True
    )
    # At equal days False sorts first, so a version starting that day is visible to the question.
    along = Window.partitionBy(key).orderBy("_day", "_asked")
    answered = events.withColumn(
        "_version", F.last("_version", ignorenulls=True).over(along)
    ).filter("_asked")
    still_open = F.col("_version.valid_to").isNull() | (
        F.col("_day").cast("timestamp") < F.col("_version.valid_to")
    )
    return answered.select(
        key,
        F.col("_day").alias(day),
        *[F.when(still_open, F.col(f"_version.{name}")).alias(name) for name in columns],
    )


def as_of_join(
    facts: DataFrame, dimension: DataFrame, key: str, day: str, columns: list[str]
) -> DataFrame:
    """Facts with the dimension columns that were valid on each fact's day (NULL if none)."""
    return facts.join(versions_on_days(facts, dimension, key, day, columns), [key, day], "left")
