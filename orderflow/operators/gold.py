"""Published aggregates and the business metrics derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from orderflow.functions.values import MONEY, exact_sum
from orderflow.operators.scd2 import versions_on_days
from orderflow.sources.staging import stage

SKETCH = "customer_sketch"
# A sketch has 2^12 registers: at most 4 kB a row, and this standard error of a count.
SKETCH_LG_K = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG_K / 2)


def daily_sales(silver: DataFrame) -> DataFrame:
    return silver.groupBy("order_date").agg(
        F.count("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        exact_sum("total_amount").cast("double").alias("daily_revenue"),
    )


def _combine(rows: DataFrame, *keys: str) -> DataFrame:
    """Re-aggregate order counts and amounts; combined on the map side before each shuffle."""
    return rows.groupBy(*keys).agg(
        F.sum("total_orders").alias("total_orders"), F.sum("amount").alias("amount")
    )


def _per_day_customer_product(silver: DataFrame) -> DataFrame:
    return silver.groupBy("order_date", "customer_id", "product_id").agg(
        F.count("order_id").alias("total_orders"), exact_sum("total_amount").alias("amount")
    )


def _by_category_country(rows: DataFrame, sketch: bool = False) -> DataFrame:
    """Final step; ``rows`` hold one row per date, customer and category, so customers count once."""
    columns = [
        F.sum("total_orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.round(F.sum("amount"), 2).cast("double").alias("revenue"),
    ]
    if sketch:
        columns.append(F.hll_sketch_agg("customer_id", F.lit(SKETCH_LG_K)).alias(SKETCH))
    return rows.groupBy("order_date", "country", "category").agg(*columns)


def revenue_by_category_country(
    silver: DataFrame, customers: DataFrame, products: DataFrame, sketch: bool = False
) -> DataFrame:
    """Revenue per date, country and category; unmatched orders keep NULL attributes.

    With ``sketch``, a column lets ``distinct_customers`` count customers over any set of dates.

    Orders join products, shrink to one row per date, customer and category, and only then meet
    the customers: a customer holding a large share of all orders reaches that join with at most
    one row per day and category, and distinct customers need no separate pass. ``customers`` and
    ``products`` hold one current row per key.
    """
    priced = silver.select("order_date", "customer_id", "product_id", "order_id", "total_amount")
    with_category = priced.join(products.select("product_id", "category"), "product_id", "left")
    per_customer = with_category.groupBy("order_date", "customer_id", "category").agg(
        F.count("order_id").alias("total_orders"), exact_sum("total_amount").alias("amount")
    )
    located = per_customer.join(customers.select("customer_id", "country"), "customer_id", "left")
    return _by_category_country(located, sketch)


def revenue_as_of(
    silver: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    materialize: Callable[..., DataFrame] = stage,
) -> DataFrame:
    """The same report with the attributes that were valid on each order's date.

    Orders are reduced to one row per date, customer and product, which is staged (this runs a
    job); both lists of keys and days come from it, so silver is scanned once.
    """
    per_product = materialize(_per_day_customer_product(silver))
    categories = versions_on_days(per_product, products, "product_id", "order_date", ["category"])
    countries = versions_on_days(per_product, customers, "customer_id", "order_date", ["country"])
    with_category = per_product.join(categories, ["product_id", "order_date"], "left")
    per_customer = _combine(with_category, "order_date", "customer_id", "category")
    located = per_customer.join(countries, ["customer_id", "order_date"], "left")
    return _by_category_country(located)


def rollup_category_country(revenue: DataFrame) -> DataFrame:
    """Gold re-aggregated over dates. Summed daily customers are customer-days, not customers."""
    return revenue.groupBy("country", "category").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("unique_customers").alias("customer_days"),
        exact_sum("revenue").cast("double").alias("revenue"),
    )


def distinct_customers(revenue: DataFrame, *keys: str) -> DataFrame:
    """Distinct customers over all dates (and other groups) of the given gold rows, per key.

    Merges the stored sketches, so only gold is read. The relative standard error is
    SKETCH_ERROR; three of them bound 99.7 % of the counts, and small groups are nearly exact.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg(SKETCH))
    if not keys:
        return revenue.agg(F.coalesce(merged, F.lit(0)).alias("customers"))
    return revenue.groupBy(*keys).agg(merged.alias("customers"))


def totals(daily: DataFrame) -> DataFrame:
    """One row: days, orders, revenue and average order value; zeros for an empty table."""
    summed = daily.agg(
        F.count("*").alias("total_days"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(exact_sum("daily_revenue"), F.lit(0).cast(MONEY)).alias("revenue"),
    )
    average = F.when(
        F.col("total_orders") > 0,
        F.round(F.col("revenue").cast("double") / F.col("total_orders"), 2),
    ).otherwise(F.lit(0.0))
    return summed.select(
        "total_days",
        "total_orders",
        F.col("revenue").cast("double").alias("total_revenue"),
        average.alias("average_order_value"),
    )


def top_by_revenue(revenue: DataFrame, dimension: str, k: int = 5) -> DataFrame:
    """The k largest by revenue; equal revenues are ordered by name."""
    ranked = revenue.groupBy(dimension).agg(
        F.round(exact_sum("revenue"), 2).cast("double").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
    )
    return ranked.orderBy(F.col("total_revenue").desc(), F.col(dimension).asc_nulls_last()).limit(k)


def freshness(silver: DataFrame) -> DataFrame:
    return silver.agg(F.max("order_date").alias("latest_order_date"))


def last_written(table_scan: DataFrame) -> DataFrame:
    """Newest file time under a scanned table, for any file system Spark can read."""
    return table_scan.select(
        F.col("_metadata.file_modification_time").alias("_written")
    ).agg(F.max("_written").alias("last_updated"))


def display_order(revenue: DataFrame) -> DataFrame:
    return revenue.orderBy("order_date", "country", "category")
