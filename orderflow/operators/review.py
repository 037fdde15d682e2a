"""Late orders under review: kept in bronze, withheld from the reports until they are released.

What is reviewed is a version of an order (its id and content hash): a later version of a released
order that is late again is pending again. Decisions are only ever added; the newest one counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from orderflow.functions.hashing import packed_hash, unpacked_hash
from orderflow.functions.values import as_date, as_timestamp
from orderflow.operators.clean import flag_late
from orderflow.schemas import struct_of

PENDING, RELEASED, REJECTED = "pending", "released", "rejected"
VERSION = ["order_id", "record_hash"]
DECISIONS = struct_of(
    order_id=T.LongType(),
    record_hash=T.StringType(),
    decision=T.StringType(),
    decided_at=T.TimestampType(),
    decided_by=T.StringType(),
)


def late_versions(orders: DataFrame, tolerance_hours: int = 24) -> DataFrame:
    """The late orders, by version, with the hours between the end of their day and their arrival.

    Orders without an id or a readable date are not reviewed; validation quarantines them.
    """
    closes = F.date_add(as_date("order_date"), 1).cast("timestamp")
    hours = (F.unix_seconds(as_timestamp("source_update_ts")) - F.unix_seconds(closes)) / 3600
    late = flag_late(orders, tolerance_hours).filter("is_late AND order_id IS NOT NULL")
    return late.select(
        *VERSION, "source_update_ts", hours.alias("hours_late"), as_date("order_date").alias("order_date")
    )


def _packed(versions: DataFrame) -> DataFrame:
    """Hashes as bytes: they are keys of the shuffles, and most of what these would move."""
    return versions.withColumn("record_hash", packed_hash())


def _newest(decisions: DataFrame) -> DataFrame:
    given = F.struct("decision", "decided_at", "decided_by")
    newest = F.max_by(given, F.struct("decided_at", "decision", "decided_by"))
    return decisions.groupBy(*VERSION).agg(newest.alias("_d")).select(*VERSION, "_d.*")


def newest_decisions(decisions: DataFrame) -> DataFrame:
    """The last decision on every version; of equal times the greater word, so a release counts.

    ``pending`` may be decided too: it takes a release back. Combined before the shuffle.
    """
    return _newest(_packed(decisions)).withColumn("record_hash", unpacked_hash())


def review_state(late: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every late version with its status: pending, unless a decision says otherwise."""
    joined = _packed(late).join(_newest(_packed(decisions)), VERSION, "left")
    return joined.select(
        "order_id", unpacked_hash().alias("record_hash"), "source_update_ts", "hours_late",
        F.coalesce("decision", F.lit(PENDING)).alias("review_status"),
        "decided_at", "decided_by", "order_date",
    )


def withheld(state: DataFrame) -> DataFrame:
    return state.filter(F.col("review_status") != RELEASED)


def withhold(orders: DataFrame, state: DataFrame) -> DataFrame:
    """The orders without the versions under review; date and key join, so both sides can be pruned."""
    held = _packed(withheld(state).select("order_date", *VERSION))
    left = _packed(orders).join(held, ["order_date", *VERSION], "left_anti")
    return left.withColumn("record_hash", unpacked_hash()).select(*orders.columns)


def decide(state: DataFrame, order_ids: DataFrame, decision: str, decided_at, decided_by: str) -> DataFrame:
    """Decisions on all reviewed versions of the named orders, as rows to be added."""
    if decision not in (PENDING, RELEASED, REJECTED):
        raise ValueError(f"no such decision: {decision}")
    chosen = state.join(order_ids.select("order_id"), "order_id", "left_semi")
    return chosen.select(
        *VERSION,
        F.lit(decision).alias("decision"),
        F.lit(decided_at).cast("timestamp").alias("decided_at"),
        F.lit(decided_by).alias("decided_by"),
        "order_date",
    )


def status_counts(state: DataFrame) -> DataFrame:
    """Orders and longest delay per day and status, for whoever has to decide."""
    return state.groupBy("order_date", "review_status").agg(
        F.count("*").alias("orders"), F.max("hours_late").alias("longest_hours")
    )
