"""Idempotent merges of updates into an existing table, as a full new state or as a change set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.functions.hashing import (
    hash_digest,
    same_content,
    with_packed_hash,
    with_unpacked_hash,
)

# Marks, in staged changes, one change of each key.
FIRST = "_first"


def _wins(source_ts: Column, target_ts: Column, source_hash: Column, target_hash: Column) -> Column:
    return (source_ts >= target_ts) & (source_hash != target_hash)


def upsert(target: DataFrame, updates: DataFrame, key: str = "order_id") -> DataFrame:
    """The table after the merge: one full outer join, each side shuffled once on its key.

    A matching update replaces the row only when it is not older and its content differs, so
    replaying a batch changes nothing. Both sides must hold one row per key (``prepare_orders``).
    """
    t, s = target.alias("t"), updates.alias("s")
    take_source = F.col(f"t.{key}").isNull() | _wins(
        F.col("s.source_update_ts"),
        F.col("t.source_update_ts"),
        F.col("s.record_hash"),
        F.col("t.record_hash"),
    )
    merged = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return merged.select(
        *[
            F.when(F.col(f"s.{key}").isNotNull() & take_source, F.col(f"s.{name}"))
            .otherwise(F.col(f"t.{name}"))
            .alias(name)
            for name in target.columns
        ]
    )


def changed_rows(
    target: DataFrame, updates: DataFrame, key: str = "order_id", date: str = "order_date"
) -> DataFrame:
    """Updates that would change the table, with the date the row stood under before (for a new
    row its own date).

    Of the target only the key, date, time and a digest of the hash take part, and they are first reduced
    to the keys being updated: a batch small enough to broadcast leaves the target unshuffled.
    ``rows_of_dates`` then rewrites just the dates this touches.
    """
    held = target.select(
        key,
        F.col(date).alias("replaced_date"),
        F.col("source_update_ts").alias("_ts"),
        hash_digest().alias("_hash"),
    )
    matched = held.join(updates.select(key), key, "left_semi").withColumnRenamed(key, "_key")
    wins = F.col("_key").isNull() | _wins(
        F.col("source_update_ts"), F.col("_ts"), hash_digest(), F.col("_hash")
    )
    joined = with_packed_hash(updates).join(matched, F.col(key) == F.col("_key"), "left")
    return (
        with_unpacked_hash(joined, updates.schema)
        .filter(wins)
        .withColumn(
            "replaced_date", F.when(F.col("_key").isNull(), F.col(date)).otherwise(F.col("replaced_date"))
        )
        .drop("_key", "_ts", "_hash")
    )


def once_per_key(changes: DataFrame, key: str = "order_id") -> DataFrame:
    """Changes with a mark on one of each key and on all without a key.

    A key that stood under two dates, because a run died between switching them, has a change for each.
    Marked where the join left the changes by key, they need not be moved once more to be told apart; where
    they are moved, those without a key are spread.
    """
    unkeyed = F.col(key).isNull()
    spread = changes.withColumn("_spread", F.when(unkeyed, F.monotonically_increasing_id()))
    of_key = Window.partitionBy(key, "_spread").orderBy(key)
    return spread.withColumn(FIRST, unkeyed | (F.row_number().over(of_key) == 1)).drop("_spread")


def touched_dates(changes: DataFrame, date: str = "order_date") -> DataFrame:
    """Old and new dates of every changed row: the partitions a merge has to rewrite. NULL stands
    for the rows without a readable date, which share one partition."""
    both = F.array(F.col("replaced_date"), F.col(date))
    return changes.select(F.explode(both).alias(date)).distinct()


def merged_rows(kept: DataFrame, changes: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows of whole dates after the merge: the changed keys' rows give way to the changes.

    A key with several changes comes back once (``once_per_key``). Changes without a key are added as
    they are.
    """
    columns, schema = kept.columns, kept.schema
    if FIRST not in changes.columns:
        changes = once_per_key(changes, key)
    derived = same_content(kept, changes)
    kept, changes = with_packed_hash(kept, derived), with_packed_hash(changes, derived)
    rest = kept.join(changes.select(key), key, "left_anti").select(*columns)
    merged = rest.unionByName(changes.filter(FIRST).select(*columns))
    return with_unpacked_hash(merged, schema)


def rows_of_dates(
    target: DataFrame, changes: DataFrame, dates: DataFrame, key: str = "order_id",
    date: str = "order_date",
) -> DataFrame:
    """New content of the touched partitions."""
    listed = dates.select(F.col(date).alias("_listed"))
    kept = target.join(listed, F.col(date).eqNullSafe(F.col("_listed")), "left_semi")
    return merged_rows(kept, changes, key)


def forced_rows(
    target: DataFrame, updates: DataFrame, key: str = "order_id", date: str = "order_date"
) -> DataFrame:
    """Every update in the target's columns, with the date its row stood under before.

    Columns an update lacks become NULL. Only keys and dates of the target are read.
    """
    lacking = [name for name in target.columns if name not in updates.columns]
    filled = updates.withColumns({name: F.lit(None).cast(target.schema[name].dataType) for name in lacking})
    held = target.select(F.col(key).alias("_key"), F.col(date).alias("replaced_date"))
    matched = held.join(updates.select(F.col(key).alias("_key")), "_key", "left_semi")
    replaced = F.when(F.col("_key").isNull(), F.col(date)).otherwise(F.col("replaced_date"))
    joined = filled.join(matched, F.col(key) == F.col("_key"), "left")
    return joined.select(*target.columns, replaced.alias("replaced_date"))


def upsert_unconditional(target: DataFrame, updates: DataFrame, key: str = "order_id") -> DataFrame:
    """Every update replaces its match or is added; columns it lacks become NULL.

    ``updates`` must hold one row per key. NULL keys match nothing and are added.
    """
    return target.join(updates.select(key), key, "left_anti").unionByName(
        updates, allowMissingColumns=True
    ).select(*target.columns)
