"""Checks over the log of table operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from orderflow.schemas import struct_of

OPERATIONS_LOG = struct_of(
    table_name=T.StringType(),
    logged_at=T.TimestampType(),
    operation=T.StringType(),
    rows=T.LongType(),
)
EXPECTED_OPERATIONS = ("WRITE", "MERGE")


class MissingOperations(AssertionError):
    """A table's history lacks operations that should have happened."""


def operation_coverage(log: DataFrame, expected=EXPECTED_OPERATIONS) -> DataFrame:
    """Per table and expected operation: how often it was logged, zero when never."""
    counts = [
        F.struct(
            F.lit(op).alias("operation"), F.count_if(F.col("operation") == op).alias("times")
        )
        for op in expected
    ]
    return log.groupBy("table_name").agg(F.array(*counts).alias("_c")).select(
        "table_name", F.inline("_c")
    )


def missing_operations(log: DataFrame, expected=EXPECTED_OPERATIONS) -> DataFrame:
    return operation_coverage(log, expected).filter(F.col("times") == 0).drop("times")


def require_operations(log: DataFrame, table_name: str, expected=EXPECTED_OPERATIONS) -> DataFrame:
    """The history of one table, or an error naming what is missing (collects operation names)."""
    history = log.filter(F.col("table_name") == table_name)
    observed = {row["operation"] for row in history.select("operation").distinct().collect()}
    missing = sorted(set(expected) - observed)
    if missing:
        raise MissingOperations(
            f"{table_name}: missing operations {missing}, observed {sorted(observed)}"
        )
    return history
