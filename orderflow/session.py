"""Session settings the library's results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates and hashes are rendered as text in places, so the zone must not vary by machine.
# Everything else (AQE, skew-join splitting, partition coalescing) is Spark's default.
SESSION_SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def sized_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about the given number of bytes.

    AQE merges shuffle partitions but never adds any, so the first count has to suit the largest
    shuffle; 128 MB each leaves room for sorting within an executor core's share of memory.
    """
    partition_bytes = 128 * 1024 * 1024
    partitions = max(cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def build_session(
    app_name: str, master: str | None = None, extra: dict | None = None
) -> SparkSession:
    """A session with the required settings and the given ones, e.g. ``sized_settings``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the required runtime settings on a session somebody else built."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
