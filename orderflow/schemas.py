"""Table contracts, schema checks and the fields of the run-metrics log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


_INT, _LONG, _DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
_TEXT, _DATE, _BOOL = T.StringType(), T.DateType(), T.BooleanType()
_TEXTS, _COUNTS = T.ArrayType(_TEXT), T.MapType(_TEXT, _LONG)


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ORDERS_RAW = struct_of(
    order_id=_LONG,
    customer_id=_LONG,
    product_id=_LONG,
    order_date=_DATE,
    quantity=_INT,
    unit_price=_DOUBLE,
    status=_TEXT,
)
CUSTOMERS_RAW = struct_of(
    customer_id=_LONG, customer_name=_TEXT, email=_TEXT, country=_TEXT, signup_date=_DATE
)
PRODUCTS_RAW = struct_of(
    product_id=_LONG, product_name=_TEXT, category=_TEXT, unit_cost=_DOUBLE
)

ORDER_COLUMNS = ORDERS_RAW.fieldNames()
CUSTOMER_COLUMNS = CUSTOMERS_RAW.fieldNames()
PRODUCT_COLUMNS = PRODUCTS_RAW.fieldNames()

INGESTION_COLUMNS = ["source_update_ts", "ingestion_ts", "ingestion_date", "record_hash"]
VALIDITY_COLUMNS = ["valid_from", "valid_to", "is_current"]
DIMENSION_METADATA_COLUMNS = INGESTION_COLUMNS + VALIDITY_COLUMNS

# The types each order column may arrive with.
_KEY_TYPES = (T.IntegerType, T.LongType, T.StringType)
_NUMBER_TYPES = (
    T.IntegerType,
    T.LongType,
    T.ShortType,
    T.DoubleType,
    T.FloatType,
    T.DecimalType,
)
ACCEPTED_ORDER_TYPES = {
    "order_id": _KEY_TYPES,
    "customer_id": _KEY_TYPES,
    "product_id": _KEY_TYPES,
    "order_date": (T.DateType, T.TimestampType, T.StringType),
    "quantity": _NUMBER_TYPES,
    "unit_price": _NUMBER_TYPES,
    "status": (T.StringType,),
}

SCHEMA_ERRORS = struct_of(level=_TEXT, column=_TEXT, reason=_TEXT, message=_TEXT)

_COMMON = {name: _TEXT for name in ("timestamp", "metric_name", "pipeline_name", "run_id")}
_WINDOW = {"backfill_start_date": _TEXT, "backfill_end_date": _TEXT}
_RETRIES = {"retries_configured": _INT, "retries_used": _INT}
_GOLD = {
    name: _TEXT
    for name in (
        "latest_order_date",
        "gold_table_last_updated_timestamp",
        "daily_sales_summary_path",
        "revenue_by_category_country_path",
    )
}


def _ranking(name: str) -> T.ArrayType:
    return T.ArrayType(struct_of(**{name: _TEXT}, total_revenue=_DOUBLE, total_orders=_LONG))


# Record types of the run-metrics log and their fields.
METRIC_SCHEMAS = {
    "pipeline_runs": struct_of(
        **_COMMON,
        status=_TEXT,
        duration_seconds=_DOUBLE,
        started_at=_TEXT,
        ended_at=_TEXT,
        total_steps=_INT,
        successful_steps=_INT,
        failed_steps=_INT,
        skipped_steps=_INT,
        skipped_steps_list=_TEXTS,
        failed_step=_TEXT,
        failure_reason=_TEXT,
        **_RETRIES,
        selected_steps=_TEXTS,
        **_WINDOW,
    ),
    "pipeline_steps": struct_of(
        **_COMMON,
        step=_TEXT,
        module=_TEXT,
        status=_TEXT,
        started_at=_TEXT,
        ended_at=_TEXT,
        attempt=_INT,
        max_attempts=_INT,
        **_RETRIES,
        duration_seconds=_DOUBLE,
        return_code=_INT,
        failure_reason=_TEXT,
        **_WINDOW,
    ),
    "step_metrics": struct_of(
        **_COMMON,
        step=_TEXT,
        status=_TEXT,
        rows_read=_LONG,
        rows_written=_LONG,
        rows_quarantined=_LONG,
        duration_seconds=_DOUBLE,
        input_path=_TEXT,
        output_path=_TEXT,
        write_mode=_TEXT,
        affected_dates=_TEXTS,
        **_WINDOW,
        is_backfill=_BOOL,
    ),
    "orders_data_quality": struct_of(
        **_COMMON,
        total_rows=_LONG,
        valid_rows=_LONG,
        invalid_count=_LONG,
        invalid_rows=_LONG,
        invalid_percentage=_DOUBLE,
        invalid_percentage_threshold=_DOUBLE,
        threshold_passed=_BOOL,
        rule_failure_counts=_COUNTS,
        quarantine_reason_counts=_COUNTS,
        all_quarantine_reason_counts=_COUNTS,
        summary_path=_TEXT,
        quarantine_path=_TEXT,
        validated_path=_TEXT,
        affected_dates=_TEXTS,
        **_WINDOW,
        is_backfill=_BOOL,
    ),
    "gold_sales_metrics": struct_of(
        **_COMMON,
        total_days=_LONG,
        total_orders=_LONG,
        total_revenue=_DOUBLE,
        average_order_value=_DOUBLE,
        top_countries=_ranking("country"),
        top_categories=_ranking("category"),
        **_GOLD,
        **_WINDOW,
        is_backfill=_BOOL,
    ),
    "freshness_metrics": struct_of(**_COMMON, **_GOLD, **_WINDOW, is_backfill=_BOOL),
}
METRIC_NAMES = list(METRIC_SCHEMAS)


def _merged(schemas) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))


# One wide row type that can hold any record of the log.
METRIC_LOG = _merged(METRIC_SCHEMAS.values())


def schema_error_rows(orders: DataFrame) -> list[tuple[str, str, str, str]]:
    """Compare a frame's schema (metadata only, no job) with the order contract."""
    present = {field.name: field.dataType for field in orders.schema.fields}
    errors = []
    for name, accepted in ACCEPTED_ORDER_TYPES.items():
        if name not in present:
            errors.append(
                ("schema", name, "missing_required_column", f"The feed has no column {name}")
            )
        elif not isinstance(present[name], accepted):
            wanted = ", ".join(kind.typeName() for kind in accepted)
            errors.append(
                (
                    "schema",
                    name,
                    "invalid_column_type",
                    f"Column {name} is {present[name].simpleString()}, accepted: {wanted}",
                )
            )
    return errors


def schema_errors(spark: SparkSession, orders: DataFrame) -> DataFrame:
    return spark.createDataFrame(schema_error_rows(orders), SCHEMA_ERRORS)


def schema_report(orders: DataFrame) -> DataFrame:
    """Every schema error next to the number of rows it touches, counted in one pass."""
    found = F.array(
        *[
            F.struct(*[F.lit(value).alias(name) for name, value in zip(SCHEMA_ERRORS.names, row)])
            for row in schema_error_rows(orders)
        ]
    ).cast(T.ArrayType(SCHEMA_ERRORS))
    return orders.agg(F.count(F.lit(1)).alias("rows_affected")).select(
        F.inline(found), "rows_affected"
    )


def fill_missing(orders: DataFrame, contract: T.StructType = ORDERS_RAW) -> DataFrame:
    """Add absent contract columns as typed NULLs."""
    absent = {
        field.name: F.lit(None).cast(field.dataType)
        for field in contract.fields
        if field.name not in orders.columns
    }
    return orders.withColumns(absent) if absent else orders
