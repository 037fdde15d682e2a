"""Date windows and replacing exactly the affected dates of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orderflow.functions.values import as_date


def in_window(
    df: DataFrame, start: str | None = None, end: str | None = None, date: str = "order_date"
) -> DataFrame:
    """Rows dated within [start, end], either bound optional.

    With a bound set, rows without a readable date fall out, since they belong to no window.
    """
    if dict(df.dtypes)[date] != "date":
        df = df.withColumn(date, as_date(date))
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end).cast("date"))
    return df


def affected_dates(*frames: DataFrame, date: str = "order_date") -> DataFrame:
    """Distinct dates over all frames. Pass the old gold and the new input together so that dates
    which lost all their rows are included."""
    days = [df.select(F.col(date).cast("date").alias(date)).distinct() for df in frames]
    return reduce(DataFrame.unionByName, days).filter(F.col(date).isNotNull()).distinct()


def _listed(dates: DataFrame, date: str) -> DataFrame:
    """Distinct calendar days; Spark broadcasts them when they are as few as they mostly are."""
    return dates.select(date).distinct()


def _require_listed(rows: DataFrame, dates: DataFrame, date: str = "order_date") -> DataFrame:
    """The rows unchanged; the query fails when one of them lies outside the dates."""
    marked = rows.join(_listed(dates, date).withColumn("_listed", F.lit(True)), date, "left")
    outside = F.raise_error(F.lit("a new row lies outside the dates to replace")).cast("date")
    checked = F.when(F.col("_listed"), F.col(date)).otherwise(outside)
    return marked.withColumn(date, checked).select(*rows.columns)


def replace_dates(
    existing: DataFrame, new_rows: DataFrame, dates: DataFrame, date: str = "order_date"
) -> DataFrame:
    """The table with the listed dates replaced by ``new_rows``; all other dates are kept."""
    kept = existing.join(_listed(dates, date), date, "left_anti")
    return kept.unionByName(_require_listed(new_rows, dates, date).select(*existing.columns))
