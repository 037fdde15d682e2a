"""Normalising incoming records and keeping the latest version of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.functions.hashing import record_hash, source_timestamp
from orderflow.functions.values import as_date
from orderflow.schemas import DIMENSION_METADATA_COLUMNS, INGESTION_COLUMNS, ORDER_COLUMNS

LATEST_FIRST = ("source_update_ts", "ingestion_ts", "record_hash")
TIE_DIGITS = 32
BEFORE_METADATA = "1970-01-01 00:00:00"


def _instant(value) -> Column:
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def _with_ingestion(df: DataFrame, columns: list[str], as_of, default_source_ts) -> DataFrame:
    arrival = _instant(as_of)
    default = arrival if default_source_ts is None else _instant(default_source_ts)
    return df.withColumns(
        {
            "source_update_ts": source_timestamp(df, default),
            "ingestion_ts": arrival,
            "ingestion_date": arrival.cast("date"),
            "record_hash": record_hash(df, columns),
        }
    )


def normalize_orders(orders: DataFrame, as_of=None, default_source_ts=None) -> DataFrame:
    """Contract columns in order plus ingestion metadata.

    ``as_of`` is the arrival time of the batch and, where the feed carries no update time of its
    own, also the source time; the current time when left out.
    """
    if "order_date" in orders.columns:
        orders = orders.withColumn("order_date", as_date("order_date"))
    normalized = _with_ingestion(orders, ORDER_COLUMNS, as_of, default_source_ts)
    return normalized.select(
        *[name for name in ORDER_COLUMNS + INGESTION_COLUMNS if name in normalized.columns]
    )


def normalize_dimension(
    dimension: DataFrame, business_columns: list[str], as_of=None, default_source_ts=None
) -> DataFrame:
    """Business columns plus ingestion and validity metadata, as a first open version."""
    normalized = _with_ingestion(dimension, business_columns, as_of, default_source_ts).withColumns(
        {"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    )
    normalized = normalized.withColumn("valid_from", F.col("source_update_ts"))
    return normalized.select(
        *[name for name in business_columns if name in normalized.columns],
        *DIMENSION_METADATA_COLUMNS,
    )


def keep_latest(df: DataFrame, *keys: str, order: tuple[str, ...] = LATEST_FIRST) -> DataFrame:
    """One row per key, the first in descending order.

    Spark turns the rank filter into a group limit that runs before the shuffle as well, so a key
    that holds a large share of the input leaves at most one row per map task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return (
        df.withColumn("_version_rank", F.row_number().over(newest))
        .filter(F.col("_version_rank") == 1)
        .drop("_version_rank")
    )


def with_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def without_key(df: DataFrame, key: str) -> DataFrame:
    """Rows no merge can match; they are kept apart and go to quarantine, never folded together."""
    return df.filter(F.col(key).isNull())


def rehashed(prepared: DataFrame) -> DataFrame:
    """Prepared orders with their content hash, which need not be moved or stored, computed again."""
    return prepared.withColumn("record_hash", record_hash(prepared, ORDER_COLUMNS))


def prepare_orders(orders: DataFrame, as_of=None) -> DataFrame:
    """One row per order id, the latest, normalised.

    The hash text would be most of what the shuffle moves. Its first 128 bits decide ties as the whole
    does (equal ones mean equal content), and the whole is computed again from the rows that are
    left. An arrival time that all rows share decides nothing and is added afterwards.
    """
    normalized = normalize_orders(with_key(orders, "order_id"), as_of)
    shared = [] if isinstance(as_of, Column) else ["ingestion_ts", "ingestion_date"]
    moved = [name for name in normalized.columns if name not in ("record_hash", *shared)]
    tie = F.unhex(F.substring("record_hash", 1, TIE_DIGITS)).alias("_tie")
    order = tuple(name for name in LATEST_FIRST if name in moved)
    latest = keep_latest(normalized.select(*moved, tie), "order_id", order=(*order, "_tie"))
    if shared:
        arrival = _instant(as_of)
        latest = latest.withColumns({"ingestion_ts": arrival, "ingestion_date": arrival.cast("date")})
    return rehashed(latest).select(*normalized.columns)


def prepare_dimension(
    dimension: DataFrame, key: str, business_columns: list[str], as_of=None
) -> DataFrame:
    return keep_latest(normalize_dimension(with_key(dimension, key), business_columns, as_of), key)


def lacks_metadata(target: DataFrame, metadata: list[str]) -> bool:
    return bool(set(metadata) - set(target.columns))


def migrate_orders(target: DataFrame, prepared: DataFrame, as_of=None) -> DataFrame:
    """Bring a table without metadata under versioning: any update beats what it held before."""
    existing = normalize_orders(target, as_of, default_source_ts=BEFORE_METADATA)
    return keep_latest(existing.unionByName(prepared, allowMissingColumns=True), "order_id")


def migrate_dimension(
    target: DataFrame, prepared: DataFrame, key: str, business_columns: list[str], as_of=None
) -> DataFrame:
    existing = normalize_dimension(
        target, business_columns, as_of, default_source_ts=BEFORE_METADATA
    )
    return keep_latest(existing.unionByName(prepared, allowMissingColumns=True), key)
