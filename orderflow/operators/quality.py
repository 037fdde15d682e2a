"""Row validation: ordered reasons, quarantine, summary and the failure threshold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.functions.values import UNIT_PRICE, as_date
from orderflow.schemas import fill_missing, schema_error_rows
from orderflow.sources.staging import stage

REASON = "quarantine_reason"
REASONS = "quarantine_reasons"
DEFAULT_THRESHOLD = 5.0

# Fixed values.
VALID_STATUSES = ("completed", "cancelled", "returned")
EXPECTATIONS = (
    ("required_order_columns_present", "schema", "missing_required_column"),
    ("order_id_unique", "uniqueness", "duplicate_order_id"),
    ("order_id_not_null", "null", "missing_order_id"),
    ("customer_id_not_null", "null", "missing_customer_id"),
    ("product_id_not_null", "null", "missing_product_id"),
    ("quantity_positive", "range", "invalid_quantity"),
    ("unit_price_non_negative", "range", "invalid_unit_price"),
    ("status_allowed", "business_rule", "invalid_status"),
    ("order_date_not_future", "business_rule", "future_order_date"),
    ("customer_id_exists", "referential", "unknown_customer_id"),
    ("product_id_exists", "referential", "unknown_product_id"),
    (
        "invalid_row_percentage_below_threshold",
        "business_rule",
        "invalid_percentage_threshold_exceeded",
    ),
)
# The order in which a row's reasons are listed.
ROW_REASONS = (
    "missing_order_id",
    "missing_customer_id",
    "missing_product_id",
    "invalid_quantity",
    "invalid_unit_price",
    "invalid_status",
    "future_order_date",
    "duplicate_order_id",
    "unknown_customer_id",
    "unknown_product_id",
)


class QualityThresholdExceeded(Exception):
    """Too large a share of the rows is invalid; raised after the outputs are published."""


def _today(today) -> Column:
    if today is None:
        return F.current_date()
    return today if isinstance(today, Column) else F.lit(today).cast("date")


def _row_conditions(today, null_date_is_invalid: bool) -> dict[str, Column]:
    """Rules that need nothing but the row itself."""
    date = as_date("order_date")
    bad_date = date.isNull() if null_date_is_invalid else (
        F.col("order_date").isNotNull() & date.isNull()
    )
    return {
        "missing_order_id": F.col("order_id").isNull(),
        "missing_customer_id": F.col("customer_id").isNull(),
        "missing_product_id": F.col("product_id").isNull(),
        "invalid_quantity": F.col("quantity").isNull() | (F.col("quantity") <= 0),
        # A price too large for the exact line total counts as invalid, or its total would be NULL.
        "invalid_unit_price": F.col("unit_price").try_cast(UNIT_PRICE).isNull()
        | (F.col("unit_price") < 0),
        "invalid_status": F.col("status").isNull() | ~F.col("status").isin(*VALID_STATUSES),
        "future_order_date": bad_date | (date > _today(today)),
    }


def _with_reasons(orders: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Append the reasons. Blanks are removed by value rather than by a lambda, which would take
    the projection out of generated code."""
    applicable = [reason for reason in ROW_REASONS if reason in conditions]
    slots = [F.when(conditions[r], F.lit(r)).otherwise(F.lit("")) for r in applicable]
    first = F.coalesce(*[F.when(conditions[r], F.lit(r)) for r in applicable])
    return orders.withColumns(
        {REASONS: F.array_remove(F.array(*slots), ""), REASON: first}
    )


def invalid_order(today=None) -> Column:
    """One predicate for the row rules, without the list of reasons."""
    combined = F.lit(False)
    for condition in _row_conditions(today, null_date_is_invalid=True).values():
        combined |= F.coalesce(condition, F.lit(False))
    return combined


def tag_row_reasons(orders: DataFrame, today=None, null_date_is_invalid: bool = False) -> DataFrame:
    """Reasons from the row rules alone; by default a NULL date is accepted here."""
    return _with_reasons(fill_missing(orders), _row_conditions(today, null_date_is_invalid))


def duplicate_ids(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Ids carried by more than one row, from counts combined before the shuffle."""
    counted = orders.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_copies"))
    return counted.filter(F.col("_copies") > 1).select(key)


def unknown_ids(orders: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Distinct ids the feed uses and the reference lacks; a feed's text ids are compared as text."""
    used = orders.select(key).filter(F.col(key).isNotNull()).distinct()
    known = reference.select(F.col(key).cast(orders.schema[key].dataType))
    return used.join(known, key, "left_anti")


def offending_ids(
    orders: DataFrame, customer_ids: DataFrame | None, product_ids: DataFrame | None
) -> dict[str, DataFrame]:
    """The ids that give their rows a reason, by reason, each in the column that the rows have it in."""
    found = {"duplicate_order_id": duplicate_ids(orders)}
    if customer_ids is not None:
        found["unknown_customer_id"] = unknown_ids(orders, customer_ids, "customer_id")
    if product_ids is not None:
        found["unknown_product_id"] = unknown_ids(orders, product_ids, "product_id")
    return found


def tag_reasons(
    orders: DataFrame,
    today=None,
    customer_ids: DataFrame | None = None,
    product_ids: DataFrame | None = None,
    materialize: Callable[..., DataFrame] = stage,
) -> DataFrame:
    """Every row with its ordered reasons and the first of them.

    Offending ids are found from single columns of the feed and staged first (this runs a job a reason),
    one copy per reason, so that the size the planner sees is that reason's own: partitions of one folder would
    each count as all of it. The rows then meet three tables whose sizes are known: small ones are
    broadcast and the feed is not shuffled at all; large ones are sort-merged, where a hot id can
    be split by AQE because nothing but a scan stands on the other side.
    """
    orders = fill_missing(orders)
    columns = orders.columns
    conditions = _row_conditions(today, null_date_is_invalid=True)
    for reason, found in offending_ids(orders, customer_ids, product_ids).items():
        (key,), flag = found.columns, f"_{reason}"
        ids = materialize(found).select(key, F.lit(True).alias(flag))
        orders = orders.join(ids, key, "left")
        conditions[reason] = F.col(flag).isNotNull()
    return _with_reasons(orders, conditions).select(*columns, REASONS, REASON)


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON, REASONS)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def _positive_counts(predicate: Callable[[str], Column]) -> Column:
    """Map from reason to the number of rows for which the predicate holds, zeros left out."""
    entries = []
    for reason in ROW_REASONS:
        entries += [F.lit(reason), F.count_if(predicate(reason))]
    return F.map_filter(F.create_map(*entries), lambda _, rows: rows > 0)


def summary(
    tagged: DataFrame, threshold: float = DEFAULT_THRESHOLD, total_rows: int | None = None
) -> DataFrame:
    """One row with all counts, in a single pass with partial aggregation.

    Where the number of all rows is known, ``tagged`` may hold just the quarantined ones.
    """
    counts = tagged.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("invalid_rows"),
        _positive_counts(lambda reason: F.col(REASON) == reason).alias("quarantine_reason_counts"),
        _positive_counts(lambda reason: F.array_contains(F.col(REASONS), reason)).alias(
            "all_quarantine_reason_counts"
        ),
    )
    total = F.col("_rows") if total_rows is None else F.lit(total_rows).cast("bigint")
    invalid = F.col("invalid_rows")
    share = F.when(total > 0, F.round(invalid / total * 100, 2)).otherwise(F.lit(0.0))
    return counts.select(
        total.alias("total_rows"),
        (total - invalid).alias("valid_rows"),
        "invalid_rows",
        share.alias("invalid_percentage"),
        F.lit(float(threshold)).alias("invalid_percentage_threshold"),
        (share <= F.lit(float(threshold))).alias("threshold_passed"),
        "quarantine_reason_counts",
        "all_quarantine_reason_counts",
    )


def first_reason_counts(tagged: DataFrame) -> DataFrame:
    return quarantined_rows(tagged).groupBy(REASON).agg(F.count("*").alias("rows"))


def all_reason_counts(tagged: DataFrame) -> DataFrame:
    """Rows per reason; a row with several reasons counts under each."""
    exploded = quarantined_rows(tagged).select(F.explode(REASONS).alias("reason"))
    return exploded.groupBy("reason").agg(F.count("*").alias("rows"))


def summary_document(tagged_summary: DataFrame, orders: DataFrame) -> DataFrame:
    """The one-row summary with the rule catalogue and schema errors, as published in JSON."""
    errors = schema_error_rows(orders)
    names = ("level", "column", "reason", "message")
    error_list = F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in errors]
    ) if errors else F.from_json(
        F.lit("[]"), "array<struct<level:string,column:string,reason:string,message:string>>"
    )
    rules = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(lv).alias("level"), F.lit(r).alias("reason"))
            for n, lv, r in EXPECTATIONS
        ]
    )
    by_level = {
        level: F.array(*[F.lit(r) for _, lv, r in EXPECTATIONS if lv == level and r in ROW_REASONS])
        for level in ("null", "uniqueness", "range", "referential", "business_rule")
    }
    levels = F.struct(
        F.struct(F.lit(not errors).alias("passed"), error_list.alias("errors")).alias("schema"),
        *[F.struct(reasons.alias("reasons")).alias(level) for level, reasons in by_level.items()],
    )
    document = tagged_summary.withColumns({"expectations": rules, "levels": levels})
    return document.select(*sorted(document.columns))


def enforce_threshold(summary_row) -> None:
    """Fail when the collected one-row summary is over its threshold."""
    if not summary_row["threshold_passed"]:
        raise QualityThresholdExceeded(
            f"{summary_row['invalid_percentage']}% of rows are invalid, above the allowed "
            f"{summary_row['invalid_percentage_threshold']}%"
        )


def enforce_no_invalid(summary_row) -> None:
    """Strict form: any invalid row fails."""
    if summary_row["invalid_rows"] > 0:
        raise QualityThresholdExceeded(f"{summary_row['invalid_rows']} rows are invalid")
