"""Typed, trimmed tables between the validated feed and the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.functions.values import UNIT_PRICE, as_date, as_timestamp


def silver_orders(validated: DataFrame) -> DataFrame:
    """Completed orders with contract types and the exact line total.

    The product is formed in decimals and rounded once, then handed on as a double.
    """
    quantity = F.col("quantity").try_cast("int")
    total = F.round(quantity * F.col("unit_price").try_cast(UNIT_PRICE), 2)
    return (
        validated.filter(F.col("status") == "completed")
        .withColumn("total_amount", total.cast("double"))
        .withColumns(
            {
                "order_date": as_date("order_date"),
                "quantity": quantity,
                "unit_price": F.col("unit_price").try_cast("double"),
            }
        )
    )


def silver_summary(silver: DataFrame) -> DataFrame:
    """One row of control totals over the silver table."""
    return silver.agg(
        F.count_distinct("order_id").alias("distinct_orders"),
        F.count("*").alias("rows"),
        F.count_distinct("status").alias("distinct_statuses"),
        F.min("status").alias("first_status"),
        F.sum(F.col("total_amount").cast("decimal(30,2)")).cast("double").alias("total_amount"),
    )


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumns(
        {
            "customer_name": F.trim("customer_name"),
            "email": F.lower(F.trim("email")),
            "country": F.trim("country"),
            "signup_date": as_date("signup_date"),
        }
    )


def clean_products(products: DataFrame) -> DataFrame:
    return products.withColumns(
        {
            "product_name": F.trim("product_name"),
            "category": F.trim("category"),
            "unit_cost": F.col("unit_cost").try_cast("double"),
        }
    )


def flag_late(orders: DataFrame, tolerance_hours: int = 24) -> DataFrame:
    """Mark orders that arrived more than the tolerance after their business day closed."""
    day_closes = F.date_add(as_date("order_date"), 1).cast("timestamp")
    deadline = day_closes + F.expr(f"INTERVAL {int(tolerance_hours)} HOURS")
    late = as_timestamp("source_update_ts") > deadline
    return orders.withColumn("is_late", F.coalesce(late, F.lit(False)))
