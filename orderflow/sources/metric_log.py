"""The run-metrics log: JSON lines, one record each, partitioned by record type."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow.functions.values import as_timestamp
from orderflow.schemas import METRIC_LOG, METRIC_SCHEMAS


def append_records(
    spark: SparkSession, path: str, metric_name: str, records: list[dict],
    pipeline_name: str | None = None, run_id: str | None = None, now: datetime | None = None,
) -> None:
    """Append records of one type (a job); each is stamped with time, pipeline and run."""
    stamp = (now or datetime.now(timezone.utc)).isoformat()
    schema = METRIC_SCHEMAS[metric_name]
    common = {
        "timestamp": stamp, "metric_name": metric_name,
        "pipeline_name": pipeline_name, "run_id": run_id,
    }
    unknown = {name for record in records for name in record} - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"{metric_name} has no fields {sorted(unknown)}")
    rows = [tuple({**common, **r}.get(n) for n in schema.fieldNames()) for r in records]
    append_frame(spark.createDataFrame(rows, schema), path)


def append_frame(records: DataFrame, path: str) -> None:
    """Append a frame of records that has a ``metric_name`` column (a job)."""
    records.write.mode("append").partitionBy("metric_name").json(path)


_MALFORMED = "_malformed"


def parse_records(lines: DataFrame, metric_names: tuple[str, ...] = ()) -> DataFrame:
    """Parse a frame with a text column ``value``; blank and malformed lines are left out.

    Each line is parsed once, with only the named types' fields if there are any; the other columns
    of the log are NULL then.
    """
    wanted = {f.name for n in metric_names or METRIC_SCHEMAS for f in METRIC_SCHEMAS[n].fields}
    schema = T.StructType(
        [f for f in METRIC_LOG.fields if f.name in wanted]
        + [T.StructField(_MALFORMED, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MALFORMED}
    parsed = lines.withColumn("_r", F.from_json("value", schema, options)).filter(
        F.col("_r").isNotNull() & F.col(f"_r.{_MALFORMED}").isNull() & F.startswith(F.ltrim("value"), F.lit("{"))
    )
    carried = [name for name in ("source_file",) if name in lines.columns]
    fields = [
        (F.col(f"_r.{f.name}") if f.name in wanted else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in METRIC_LOG.fields
    ]
    if "metric_name" in lines.columns:
        at = METRIC_LOG.fieldNames().index("metric_name")
        fields[at] = F.coalesce(F.col("_r.metric_name"), F.col("metric_name")).alias("metric_name")
    return parsed.select(
        *fields,
        *carried,
        as_timestamp("_r.timestamp").alias("recorded_at"),
        F.sha2("value", 256).alias("record_id"),
    )


def read_log(spark: SparkSession, path: str, *metric_names: str) -> DataFrame:
    """All records under a folder, flat files or partitioned by type, with their file name.

    With record types named, only their partitions are read and only their fields parsed.
    """
    lines = spark.read.text(path)
    if metric_names and "metric_name" in lines.columns:
        lines = lines.filter(F.col("metric_name").isin(*metric_names))
    lines = lines.withColumn("source_file", F.col("_metadata.file_name"))
    records = parse_records(lines, metric_names)
    return records.filter(F.col("metric_name").isin(*metric_names)) if metric_names else records
