"""Non-throwing casts and exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Wide enough for the largest quantity times the largest unit price; sums have 8 more digits.
MONEY = "decimal(30,2)"
# Durations, in seconds, are summed to the nanosecond.
SECONDS = "decimal(28,9)"
# Unit prices keep extra digits until the product has been rounded.
UNIT_PRICE = "decimal(24,6)"


def as_date(column: Column | str) -> Column:
    """Date of a date, timestamp or text value; NULL where the text is not a date."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("date")


def as_timestamp(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("timestamp")


def exact_sum(column: str) -> Column:
    """Sum of a two-decimal amount that does not depend on row order."""
    return F.sum(F.col(column).cast(MONEY))
