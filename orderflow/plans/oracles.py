"""For every registered query, the same result in DuckDB SQL over the same tables."""

from __future__ import annotations

from orderflow.plans.queries import WINDOW
from orderflow.plans.testmap import (
    EVENT_METRICS,
    FIRST_LOAD,
    LOG_AS_OF,
    NEW_KEY_OFFSET,
    SECOND_LOAD,
    TODAY,
    UNKNOWN_OFFSET,
)
from orderflow.schemas import CUSTOMER_COLUMNS, METRIC_NAMES, ORDER_COLUMNS, PRODUCT_COLUMNS

_TEXT_COLUMNS = {
    "order_date", "signup_date", "source_update_ts", "ingestion_ts", "ingestion_date",
    "valid_from", "valid_to", "recorded_at", "replaced_date", "latest_order_date", "decided_at",
}
_INGESTION = ["source_update_ts", "ingestion_ts", "ingestion_date", "record_hash"]
_VALIDITY = ["valid_from", "valid_to", "is_current"]
_ORDER_TABLE = ORDER_COLUMNS + _INGESTION
_CUSTOMER_TABLE = CUSTOMER_COLUMNS + _INGESTION + _VALIDITY
_PRODUCT_TABLE = PRODUCT_COLUMNS + _INGESTION + _VALIDITY


def _out(columns: list[str], alias: str = "") -> str:
    """Select list with dates and times as text and prices as doubles."""
    prefix = f"{alias}." if alias else ""
    items = []
    for name in columns:
        if name in _TEXT_COLUMNS:
            items.append(f"CAST({prefix}{name} AS VARCHAR) AS {name}")
        elif name in ("unit_price", "unit_cost"):
            items.append(f"CAST({prefix}{name} AS DOUBLE) AS {name}")
        else:
            items.append(f"{prefix}{name} AS {name}")
    return ", ".join(items)


def _hash(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '<NULL>')" for name in columns)
    return f"sha256(concat_ws('||', {parts}))"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FEED = """feed AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS customer_id,
         l_partkey AS product_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled'
              ELSE 'returned' END AS status,
         l_shipdate AS source_update_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DIRTY = FEED + f""",
dirty AS (
  SELECT CASE WHEN order_id % 127 = 0 THEN NULL ELSE order_id END AS order_id,
         CASE WHEN order_id % 89 = 0 THEN NULL
              WHEN order_id % 97 = 0 THEN customer_id + {UNKNOWN_OFFSET}
              ELSE customer_id END AS customer_id,
         CASE WHEN order_id % 83 = 0 THEN NULL
              WHEN order_id % 101 = 0 THEN product_id + {UNKNOWN_OFFSET}
              ELSE product_id END AS product_id,
         CASE WHEN order_id % 113 = 0 THEN 'not a date' WHEN order_id % 131 = 0 THEN NULL
              ELSE CAST(order_date AS VARCHAR) END AS order_date,
         CASE WHEN order_id % 103 = 0 THEN 0 ELSE quantity END AS quantity,
         CASE WHEN order_id % 107 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
         CASE WHEN order_id % 109 = 0 THEN 'unknown' ELSE status END AS status,
         source_update_ts
  FROM feed)"""


def _normalized(name: str, source: str, columns: list[str], as_of: str, validity: bool = False,
                source_ts: str = "source_update_ts") -> str:
    """A CTE adding ingestion metadata, and an open validity for dimensions."""
    extra = (
        f", {source_ts} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current"
        if validity
        else ""
    )
    return f"""{name} AS (
  SELECT {", ".join(columns)}, {source_ts} AS source_update_ts,
         TIMESTAMP '{as_of}' AS ingestion_ts, CAST(TIMESTAMP '{as_of}' AS DATE) AS ingestion_date,
         {_hash(columns)} AS record_hash{extra}
  FROM {source})"""


def _latest(name: str, source: str, key: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY source_update_ts DESC NULLS LAST,
           ingestion_ts DESC NULLS LAST, record_hash DESC NULLS LAST) AS rk
    FROM {source}) WHERE rk = 1)"""


ORDERS_FIRST = ",\n".join(
    [FEED, _normalized("n1", "feed", ORDER_COLUMNS, FIRST_LOAD), _latest("target", "n1", "order_id")]
)
ORDER_UPDATES = ",\n".join(
    [
        f"""changed_all AS (
  SELECT CASE WHEN order_id % 31 = 0 THEN NULL
              WHEN order_id % 5 = 0 THEN order_id + {NEW_KEY_OFFSET} ELSE order_id END AS order_id,
         customer_id, product_id,
         CASE WHEN order_id % 9 = 0 THEN order_date + 3 ELSE order_date END AS order_date,
         quantity,
         CAST(CASE WHEN order_id % 7 = 0 THEN unit_price * CAST(1.03 AS DECIMAL(3,2))
                   ELSE unit_price END AS DECIMAL(18,2)) AS unit_price,
         status,
         CASE WHEN order_id % 29 = 0 THEN NULL
              WHEN order_id % 11 = 0 THEN source_update_ts - INTERVAL 30 DAY
              ELSE source_update_ts END AS source_update_ts
  FROM feed),
changed AS (SELECT * FROM changed_all WHERE order_id IS NOT NULL)""",
        _normalized("n2", "changed", ORDER_COLUMNS, SECOND_LOAD),
        _latest("updates", "n2", "order_id"),
    ]
)
ORDER_MERGE = ORDERS_FIRST + ",\n" + ORDER_UPDATES + """,
winners AS (
  SELECT u.*,
         CASE WHEN t.order_id IS NULL THEN u.order_date ELSE t.order_date END AS replaced_date
  FROM updates u LEFT JOIN target t ON u.order_id = t.order_id
  WHERE t.order_id IS NULL
     OR (u.source_update_ts >= t.source_update_ts AND u.record_hash <> t.record_hash))"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         ' ' || replace(c_name, '#', '.') || '@Example.com ' AS email,
         n_name || ' ' AS country,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, '  ' || p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost
  FROM part)"""
CUSTOMER_UPDATES = f"""moved AS (
  SELECT CASE WHEN customer_id % 13 = 0 THEN customer_id + {NEW_KEY_OFFSET}
              ELSE customer_id END AS customer_id,
         customer_name, email,
         CASE WHEN customer_id % 11 = 0 THEN 'NATION_NEW' ELSE country END AS country, signup_date,
         CASE WHEN customer_id % 17 = 0 THEN TIMESTAMP '2000-01-01 00:00:00'
              ELSE TIMESTAMP '{SECOND_LOAD}' END AS source_update_ts
  FROM customers),
""" + _normalized("updates", "moved", CUSTOMER_COLUMNS, SECOND_LOAD, True)


def _history(name: str, source: str, key: str, attribute: str, columns: list[str]) -> str:
    others = ", ".join(c for c in columns if c != attribute)
    second = (
        f"CAST(DATE '1998-01-01' + CAST({key} % 300 AS INT) AS TIMESTAMP) + INTERVAL 12 HOUR"
    )
    third = f"CAST(DATE '2000-01-01' + CAST({key} % 300 AS INT) AS TIMESTAMP)"
    open_end = "CAST(NULL AS TIMESTAMP)"
    return f"""{name}_versions AS (
  SELECT {others}, trim({attribute}) AS {attribute},
         TIMESTAMP '1996-01-01 00:00:00' AS valid_from,
         CASE WHEN {key} % 2 = 0 THEN {second} WHEN {key} % 3 = 0 THEN {third}
              ELSE {open_end} END AS valid_to
  FROM {source}
  UNION ALL
  SELECT {others}, trim({attribute}) || '/2', {second},
         CASE WHEN {key} % 3 = 0 THEN {third} ELSE {open_end} END
  FROM {source} WHERE {key} % 2 = 0
  UNION ALL
  SELECT {others}, trim({attribute}) || '/3', {third}, {open_end}
  FROM {source} WHERE {key} % 3 = 0),
{name} AS (
  SELECT {", ".join(columns)}, valid_from AS source_update_ts,
         TIMESTAMP '{FIRST_LOAD}' AS ingestion_ts, CAST(TIMESTAMP '{FIRST_LOAD}' AS DATE)
         AS ingestion_date, {_hash(columns)} AS record_hash, valid_from, valid_to,
         valid_to IS NULL AS is_current
  FROM {name}_versions)"""


CUSTOMER_HISTORY = (
    CUSTOMERS + ",\n"
    + _history("customer_history", "customers", "customer_id", "country", CUSTOMER_COLUMNS)
)
PRODUCT_HISTORY = (
    PRODUCTS + ",\n"
    + _history("product_history", "products", "product_id", "category", PRODUCT_COLUMNS)
)

_ROW_REASONS = (
    "missing_order_id", "missing_customer_id", "missing_product_id", "invalid_quantity",
    "invalid_unit_price", "invalid_status", "future_order_date", "duplicate_order_id",
    "unknown_customer_id", "unknown_product_id",
)
CUSTOMER_VERSIONS_MERGE = CUSTOMER_HISTORY + f""",
target AS (
  SELECT * REPLACE (
    CASE WHEN customer_id % 19 = 0 THEN false
         WHEN customer_id % 23 = 0 AND valid_to IS NOT NULL THEN NULL
         ELSE is_current END AS is_current,
    CASE WHEN customer_id % 19 = 0 THEN coalesce(valid_to, TIMESTAMP '{FIRST_LOAD}')
         ELSE valid_to END AS valid_to)
  FROM customer_history),
""" + CUSTOMER_UPDATES
_BAD_DATE = "TRY_CAST(order_date AS DATE) IS NULL"
_FUTURE = f"TRY_CAST(order_date AS DATE) > DATE '{TODAY}'"
_ROW_RULES = {
    "missing_order_id": "order_id IS NULL",
    "missing_customer_id": "customer_id IS NULL",
    "missing_product_id": "product_id IS NULL",
    "invalid_quantity": "quantity IS NULL OR quantity <= 0",
    "invalid_unit_price": "unit_price IS NULL OR unit_price < 0",
    "invalid_status": "status IS NULL OR status NOT IN ('completed','cancelled','returned')",
    "future_order_date": f"{_BAD_DATE} OR {_FUTURE}",
}
_ALL_RULES = {
    **_ROW_RULES,
    "duplicate_order_id": "order_id IS NOT NULL AND copies > 1",
    "unknown_customer_id": (
        "customer_id IS NOT NULL AND customer_id NOT IN (SELECT c_custkey FROM customer)"
    ),
    "unknown_product_id": (
        "product_id IS NOT NULL AND product_id NOT IN (SELECT p_partkey FROM part)"
    ),
}


def _reasons(rules: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {rules[r]} THEN '{r}' END" for r in _ROW_REASONS if r in rules)
    return f"concat_ws(',', {cases})"


def _tag(source: str, rules: dict[str, str]) -> str:
    return f"""tagged AS (
  SELECT * EXCLUDE (found), found AS quarantine_reasons,
         nullif(split_part(found, ',', 1), '') AS quarantine_reason
  FROM (SELECT *, {_reasons(rules)} AS found FROM {source}))"""


TAGGED = (
    DIRTY
    + ",\ncounted AS (SELECT *, count(*) OVER (PARTITION BY order_id) AS copies FROM dirty),\n"
    + _tag("counted", _ALL_RULES)
)
_FEED_OUT = _out(ORDER_COLUMNS + ["source_update_ts"])

SILVER_COLUMNS = """order_id, customer_id, product_id, order_date, quantity,
         CAST(unit_price AS DOUBLE) AS unit_price, status, source_update_ts,
         CAST(round(quantity * unit_price, 2) AS DOUBLE) AS total_amount"""
_SHIFTED_COLUMNS = SILVER_COLUMNS.replace(
    " order_date,",
    " CASE WHEN dayofweek(order_date) = 0 THEN order_date + 1 ELSE order_date END AS order_date,",
)
SILVER = FEED + f""",
silver AS (SELECT {SILVER_COLUMNS} FROM feed WHERE status = 'completed')"""
DIMENSIONS = CUSTOMERS + ",\n" + PRODUCTS
_AMOUNT = "CAST(total_amount AS DECIMAL(18,2))"


def _revenue(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT order_date, country, category, count(order_id) AS total_orders,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(round(sum({_AMOUNT}), 2) AS DOUBLE) AS revenue
  FROM {source} GROUP BY ALL)"""


STAR = """star AS (
  SELECT s.*, trim(c.country) AS country, trim(p.category) AS category
  FROM silver s LEFT JOIN customers c USING (customer_id) LEFT JOIN products p USING (product_id))"""
REVENUE = ",\n".join([SILVER, DIMENSIONS, STAR, _revenue("revenue", "star")])
_REVENUE_OUT = _out(
    ["order_date", "country", "category", "total_orders", "unique_customers", "revenue"]
)


def _daily(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT order_date, count(order_id) AS total_orders,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(sum({_AMOUNT}) AS DOUBLE) AS daily_revenue
  FROM {source} GROUP BY order_date)"""


DAILY = SILVER + ",\n" + _daily("daily", "silver")
_DAILY_OUT = _out(["order_date", "total_orders", "unique_customers", "daily_revenue"])


def _top(dimension: str) -> str:
    return _with(REVENUE) + f"""SELECT {dimension},
  CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_revenue,
  CAST(sum(total_orders) AS BIGINT) AS total_orders
FROM revenue GROUP BY {dimension} ORDER BY total_revenue DESC, {dimension} ASC NULLS LAST LIMIT 5"""


_METRIC_CASE = " ".join(f"WHEN '{event}' THEN '{name}'" for event, name in EVENT_METRICS.items())
LOG = f"""keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CASE event_type {_METRIC_CASE} END AS metric_name
  FROM events),
log AS (
  SELECT CAST(event_id AS VARCHAR) AS record_id, event_id,
         CASE WHEN k % 50 <> 0 THEN ts END AS recorded_at,
         coalesce(CASE WHEN k % 50 <> 0 THEN ts END, CASE WHEN k % 100 <> 0 THEN ts END,
                  CASE WHEN k % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END,
                  TIMESTAMP '1970-01-01 00:00:00') AS sort_ts,
         metric_name, 'orders' AS pipeline_name, CAST(user_id AS VARCHAR) AS run_id, k, ts,
         CASE WHEN metric_name IN ('orders_data_quality', 'gold_sales_metrics') THEN NULL
              WHEN k % 40 = 7 THEN NULL WHEN k % 10 = 0 THEN 'failed' WHEN k % 10 = 1 THEN 'FAILED'
              ELSE 'success' END AS status,
         CASE WHEN metric_name IN ('orders_data_quality', 'gold_sales_metrics') THEN NULL
              ELSE value END AS duration_seconds,
         CASE WHEN metric_name <> 'pipeline_runs' THEN 'step_' || (k % 10) END AS step,
         CASE WHEN metric_name = 'pipeline_runs' AND k % 4 > 0
              THEN 'step_' || (k % 10) END AS failed_step,
         value
  FROM keyed)"""
_BRIEF = _out(["record_id", "recorded_at", "metric_name", "run_id", "status", "duration_seconds"])


def _newest(metric: str, value: str) -> str:
    """The value held by the newest record of a type; NULL values are kept."""
    return (
        f"(SELECT {value} FROM log WHERE metric_name = '{metric}' "
        "ORDER BY sort_ts DESC, record_id DESC LIMIT 1)"
    )


def _gauge(name: str, record_type: str, value: str, **labels: str) -> str:
    everything = {"pipeline": "pipeline_name", "run_id": "run_id", **labels}
    text = ", ".join(
        f"'{label}=' || CAST({everything[label]} AS VARCHAR)" for label in sorted(everything)
    )
    return (
        f"SELECT '{name}' AS gauge, concat_ws(',', {text}) AS labels, "
        f"CAST(coalesce({value}, 0) AS DOUBLE) AS value FROM log WHERE metric_name = '{record_type}'"
    )


_LABEL = "coalesce(status, 'unknown')"
_FAILED = f"CASE WHEN {_LABEL} = 'success' THEN 0 ELSE 1 END"
_GAUGES = [
    _gauge("pipeline_run_status", "pipeline_runs",
           f"CASE WHEN {_LABEL} = 'success' THEN 1 ELSE 0 END", status=_LABEL),
    _gauge("pipeline_run_duration_seconds", "pipeline_runs", "duration_seconds", status=_LABEL),
    _gauge("pipeline_step_duration_seconds", "pipeline_steps", "duration_seconds",
           step="step", status="status", attempt="k % 3 + 1"),
    _gauge("step_rows", "step_metrics", "event_id * 10 + k", step="step", row_type="'read'"),
    _gauge("step_rows", "step_metrics", "event_id * 10", step="step", row_type="'written'"),
    _gauge("step_rows", "step_metrics", "k", step="step", row_type="'quarantined'"),
    _gauge("orders_invalid_count", "orders_data_quality", "k"),
    _gauge("orders_invalid_percentage", "orders_data_quality", "value"),
    _gauge("business_metric", "gold_sales_metrics", "value", metric="'total_revenue'"),
    _gauge("business_metric", "gold_sales_metrics", "k", metric="'total_orders'"),
    _gauge("business_metric", "gold_sales_metrics",
           "CASE WHEN k % 2 = 0 THEN 1.5 WHEN k > 0 THEN CAST(round(CAST(value AS DECIMAL(18,2)) "
           "/ CAST(k AS DECIMAL(18,2)), 2) AS DOUBLE) END",
           metric="'average_order_value'"),
    _gauge("freshness_timestamp_seconds", "gold_sales_metrics",
           "epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) / 1000000.0",
           metric="'latest_order_date'", source="metric_name"),
    _gauge("freshness_timestamp_seconds", "gold_sales_metrics", "epoch_us(ts) / 1000000.0",
           metric="'gold_table_last_updated_timestamp'", source="metric_name"),
    f"(SELECT 'latest_pipeline_run_failed', concat_ws(',', 'failed_step=' || failed_step, "
    f"'pipeline=' || pipeline_name, 'run_id=' || run_id, 'status=' || {_LABEL}), "
    f"CAST({_FAILED} AS DOUBLE) FROM log WHERE metric_name = 'pipeline_runs' "
    "ORDER BY sort_ts DESC, record_id DESC LIMIT 1)",
    "(SELECT 'latest_orders_invalid_percentage', 'pipeline=' || pipeline_name || ',run_id=' || "
    "run_id, value FROM log WHERE metric_name = 'orders_data_quality' "
    "ORDER BY sort_ts DESC, record_id DESC LIMIT 1)",
    *[
        f"SELECT 'metrics_records_total', 'metric_name={name}', CAST(count(*) AS DOUBLE) "
        f"FROM log WHERE metric_name = '{name}'"
        for name in METRIC_NAMES
    ],
]
_MISSING = {
    "pipeline_metrics_missing": "pipeline_runs",
    "data_quality_metrics_missing": "orders_data_quality",
    "gold_metrics_missing": "gold_sales_metrics",
}


def _scd2(guard: str) -> str:
    supersedes = f"t.record_hash <> s.record_hash{guard}"
    closed = ", ".join(
        {"valid_to": "s.valid_from", "is_current": "false"}.get(c, f"t.{c}")
        + f" AS {c}" for c in _CUSTOMER_TABLE
    )
    return _with(CUSTOMER_VERSIONS_MERGE + f""",
open AS (SELECT * FROM target WHERE is_current IS TRUE),
merged AS (
  SELECT * FROM target WHERE is_current IS NOT TRUE
  UNION ALL
  SELECT {closed} FROM open t JOIN updates s USING (customer_id) WHERE {supersedes}
  UNION ALL
  SELECT t.* FROM open t LEFT JOIN updates s USING (customer_id)
  WHERE s.customer_id IS NULL OR NOT ({supersedes})
  UNION ALL
  SELECT s.* FROM updates s LEFT JOIN open t USING (customer_id)
  WHERE t.customer_id IS NULL OR ({supersedes}))""") + (
        f"SELECT {_out(_CUSTOMER_TABLE)} FROM merged"
    )


_WINDOW_SQL = f"BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'"
_OPERATIONS = FEED + """,
operations AS (
  SELECT 'orders_' || status || '_' || strftime(order_date, '%Y%m') AS table_name,
         CASE WHEN order_id % 10 < 7 THEN 'WRITE' ELSE 'MERGE' END AS operation, count(*) AS rows
  FROM feed GROUP BY ALL),
coverage AS (
  SELECT t.table_name, e.operation,
         count(o.operation) AS times
  FROM (SELECT DISTINCT table_name FROM operations) t
  CROSS JOIN (VALUES ('WRITE'), ('MERGE'), ('DELETE')) e(operation)
  LEFT JOIN operations o ON o.table_name = t.table_name AND o.operation = e.operation
  GROUP BY ALL)"""


REVIEW = ORDERS_FIRST + f""",
review_state AS (
  SELECT order_id, record_hash, order_date,
         (epoch(source_update_ts) - epoch(CAST(order_date + 1 AS TIMESTAMP))) / 3600.0 AS hours_late,
         CASE WHEN order_id % 6 = 0 THEN 'rejected' WHEN order_id % 3 = 0 THEN 'released' ELSE 'pending' END
           AS review_status,
         CASE WHEN order_id % 6 = 0 THEN TIMESTAMP '{SECOND_LOAD}'
              WHEN order_id % 3 = 0 THEN TIMESTAMP '{FIRST_LOAD}' END AS decided_at,
         CASE WHEN order_id % 6 = 0 THEN 'second' WHEN order_id % 3 = 0 THEN 'first' END AS decided_by
  FROM target
  WHERE source_update_ts > CAST(order_date + 1 AS TIMESTAMP) + INTERVAL 24 HOUR)"""


def _schema_rows() -> str:
    message = "The feed has no column product_id"
    typed = "Column status is bigint, accepted: string"
    return (
        _with(FEED)
        + f"""SELECT e.*, n.rows_affected FROM (SELECT count(*) AS rows_affected FROM feed) n,
  (VALUES ('schema', 'product_id', 'missing_required_column', '{message}'),
          ('schema', 'status', 'invalid_column_type', '{typed}'))
  e(level, "column", reason, message)"""
    )


_ORACLES = {
    "orders_normalized": _with(FEED, _normalized("n", "feed", ORDER_COLUMNS, FIRST_LOAD))
    + f"SELECT {_out(_ORDER_TABLE)} FROM n",
    "order_record_hash": _with(DIRTY)
    + f"SELECT order_id, {_hash(ORDER_COLUMNS)} AS record_hash FROM dirty",
    "dim_record_hash": _with(CUSTOMERS)
    + f"SELECT customer_id, {_hash(CUSTOMER_COLUMNS)} AS record_hash FROM customers",
    "dim_initial_load": _with(
        PRODUCTS,
        _normalized("n", "products", PRODUCT_COLUMNS, FIRST_LOAD, True,
                    f"TIMESTAMP '{FIRST_LOAD}'"),
    )
    + f"SELECT {_out(_PRODUCT_TABLE)} FROM n",
    "orders_latest": _with(ORDERS_FIRST) + f"SELECT {_out(_ORDER_TABLE)} FROM target",
    "dim_latest": _with(
        CUSTOMER_HISTORY,
        _normalized("n", "customer_history", CUSTOMER_COLUMNS, FIRST_LOAD, True),
        _latest("newest", "n", "customer_id"),
    )
    + f"SELECT {_out(_CUSTOMER_TABLE)} FROM newest",
    "missing_columns_filled": _with(FEED)
    + f"""SELECT {_out(["order_id", "customer_id", "order_date", "unit_price", "source_update_ts"])},
  CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS INT) AS quantity, CAST(NULL AS VARCHAR) AS status
FROM feed""",
    "schema_errors": _schema_rows(),
    "orders_upsert": _with(ORDER_MERGE)
    + f"""SELECT {_out(_ORDER_TABLE)} FROM winners
UNION ALL
SELECT {_out(_ORDER_TABLE)} FROM target WHERE order_id NOT IN (SELECT order_id FROM winners)""",
    "orders_changed_rows": _with(ORDER_MERGE)
    + f"SELECT {_out(['order_id', 'order_date', 'replaced_date', 'record_hash'])} FROM winners",
    "orders_upsert_dates": _with(ORDER_MERGE)
    + """SELECT DISTINCT CAST(d AS VARCHAR) AS order_date FROM (
  SELECT order_date AS d FROM winners UNION ALL SELECT replaced_date FROM winners)""",
    "orders_upsert_unconditional": _with(ORDERS_FIRST, ORDER_UPDATES)
    + f"""SELECT {_out(_ORDER_TABLE)} FROM target
WHERE order_id NOT IN (SELECT order_id FROM updates)
UNION ALL
SELECT {_out(ORDER_COLUMNS)}, NULL, NULL, NULL, NULL FROM updates""",
    "orders_migrate": _with(
        ORDERS_FIRST,
        ORDER_UPDATES,
        _normalized("bare", "target", ORDER_COLUMNS, SECOND_LOAD,
                    source_ts="TIMESTAMP '1970-01-01 00:00:00'"),
        "both_sides AS (SELECT * FROM bare UNION ALL SELECT * FROM updates)",
        _latest("newest", "both_sides", "order_id"),
    )
    + f"SELECT {_out(_ORDER_TABLE)} FROM newest",
    "dim_migrate": _with(
        CUSTOMERS,
        CUSTOMER_UPDATES,
        _normalized("bare", "customers", CUSTOMER_COLUMNS, SECOND_LOAD, True,
                    "TIMESTAMP '1970-01-01 00:00:00'"),
        "both_sides AS (SELECT * FROM bare UNION ALL SELECT * FROM updates)",
        _latest("newest", "both_sides", "customer_id"),
    )
    + f"SELECT {_out(_CUSTOMER_TABLE)} FROM newest",
    "scd2_merge": _scd2(" AND s.valid_from >= t.valid_from"),
    "scd2_merge_unguarded": _scd2(""),
    "scd2_changed_rows": _with(CUSTOMER_VERSIONS_MERGE)
    + f"""SELECT {_out(_CUSTOMER_TABLE, 's')}
FROM updates s JOIN target t USING (customer_id)
WHERE t.is_current IS TRUE AND s.record_hash <> t.record_hash""",
    "scd2_current": _with(CUSTOMER_HISTORY)
    + f"SELECT {_out(_CUSTOMER_TABLE)} FROM customer_history WHERE is_current",
    "late_orders_review": _with(REVIEW)
    + f"SELECT {_out(['order_id', 'record_hash', 'hours_late', 'review_status', 'decided_at', 'decided_by', 'order_date'])} FROM review_state",
    "gold_daily_sales_reviewed": _with(
        REVIEW,
        f"""kept AS (SELECT {SILVER_COLUMNS} FROM target WHERE status = 'completed' AND order_id NOT IN (
  SELECT order_id FROM review_state WHERE review_status <> 'released'))""",
        _daily("daily", "kept"),
    )
    + f"SELECT {_DAILY_OUT} FROM daily",
    "gold_distinct_customers": _with(SILVER, DIMENSIONS, STAR)
    + """SELECT country, category, count(DISTINCT customer_id) AS customers, true AS within_bound
FROM star GROUP BY country, category""",
    "csv_feed": _with(DIRTY)
    + """SELECT order_id, customer_id, product_id, CAST(TRY_CAST(order_date AS DATE) AS VARCHAR) AS order_date,
  quantity, CAST(unit_price AS DOUBLE) AS unit_price, status, CAST(source_update_ts AS VARCHAR) AS source_update_ts,
  coalesce(order_date = 'not a date', false) AS is_corrupt FROM dirty""",
    "json_log": _with(LOG)
    + f"""SELECT metric_name, {_out(['recorded_at'])}, run_id, status, step, k % 3 + 1 AS attempt, duration_seconds,
  event_id * 10 + k AS rows_read,
  CASE WHEN metric_name = 'orders_data_quality' THEN value END AS invalid_percentage,
  CASE WHEN metric_name = 'orders_data_quality' THEN
    'invalid_quantity=' || k || ',invalid_status=' || (k % 7) || ',unknown_customer_id=' || (event_id % 13) END
    AS quarantine_reason_counts,
  CASE WHEN metric_name = 'gold_sales_metrics' THEN value END AS total_revenue FROM log""",
    "published_upsert": _with(ORDER_MERGE)
    + f"""SELECT {_out(_ORDER_TABLE)} FROM winners
UNION ALL
SELECT {_out(_ORDER_TABLE)} FROM target WHERE order_id NOT IN (SELECT order_id FROM winners)""",
    "published_unconditional": _with(ORDER_MERGE)
    + f"""SELECT {_out(_ORDER_TABLE)} FROM target WHERE order_id NOT IN (SELECT order_id FROM updates)
UNION ALL
SELECT {_out(ORDER_COLUMNS)}, NULL, NULL, NULL, NULL FROM updates""",
    "published_partitions": _with(DAILY)
    + f"""SELECT CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR) AS order_month,
  count(*) AS days, CAST(sum(total_orders) AS BIGINT) AS total_orders, true AS was_written
FROM daily WHERE NOT CAST(date_trunc('month', order_date) AS DATE) {_WINDOW_SQL} OR dayofweek(order_date) = 1
GROUP BY 1""",
    "quality_reasons": _with(TAGGED)
    + f"SELECT {_FEED_OUT}, quarantine_reasons, quarantine_reason FROM tagged",
    "quality_reasons_text_ids": _with(
        DIRTY + ",\ntexts AS (SELECT * REPLACE (" + ", ".join(
            f"CASE WHEN {n} % 137 = 0 THEN 'X' || {n} ELSE CAST({n} AS VARCHAR) END AS {n}"
            for n in ("order_id", "customer_id", "product_id")
        ) + ") FROM dirty),\n"
        "counted AS (SELECT *, count(*) OVER (PARTITION BY order_id) AS copies FROM texts)",
        _tag("counted", {
            name: rule.replace("SELECT c_custkey", "SELECT CAST(c_custkey AS VARCHAR)")
            .replace("SELECT p_partkey", "SELECT CAST(p_partkey AS VARCHAR)")
            for name, rule in _ALL_RULES.items()
        }),
    )
    + f"SELECT {_FEED_OUT}, quarantine_reasons, quarantine_reason FROM tagged",
    "quality_reasons_row_only": _with(
        DIRTY,
        _tag("dirty", {**_ROW_RULES,
                       "future_order_date": f"(order_date IS NOT NULL AND {_BAD_DATE}) OR {_FUTURE}"}),
    )
    + f"SELECT {_FEED_OUT}, quarantine_reasons, quarantine_reason FROM tagged",
    "invalid_predicate": _with(DIRTY)
    + f"SELECT {_FEED_OUT} FROM dirty WHERE {' OR '.join(f'({r})' for r in _ROW_RULES.values())}",
    "valid_orders": _with(TAGGED)
    + f"SELECT {_FEED_OUT} FROM tagged WHERE quarantine_reason IS NULL",
    "quarantined_orders": _with(TAGGED)
    + f"""SELECT {_FEED_OUT}, quarantine_reasons, quarantine_reason FROM tagged
WHERE quarantine_reason IS NOT NULL""",
    "quality_first_reason_counts": _with(TAGGED)
    + """SELECT quarantine_reason, count(*) AS rows FROM tagged
WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason""",
    "quality_all_reason_counts": _with(TAGGED)
    + """SELECT reason, count(*) AS rows
FROM (SELECT unnest(string_split(quarantine_reasons, ',')) AS reason FROM tagged
      WHERE quarantine_reason IS NOT NULL) GROUP BY reason""",
    "quality_summary": _with(
        TAGGED,
        """totals AS (SELECT count(*) AS total_rows,
    count(*) FILTER (WHERE quarantine_reason IS NULL) AS valid_rows,
    count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS invalid_rows FROM tagged)""",
        "share AS (SELECT *, round(invalid_rows / total_rows * 100, 2) AS pct FROM totals)",
        """firsts AS (SELECT quarantine_reason AS r, count(*) AS n FROM tagged
    WHERE quarantine_reason IS NOT NULL GROUP BY 1)""",
        """everyone AS (SELECT r, count(*) AS n FROM (
    SELECT unnest(string_split(quarantine_reasons, ',')) AS r FROM tagged
    WHERE quarantine_reason IS NOT NULL) GROUP BY r)""",
    )
    + """SELECT total_rows, valid_rows, invalid_rows, pct AS invalid_percentage,
  CAST(5.0 AS DOUBLE) AS invalid_percentage_threshold, pct <= 5.0 AS threshold_passed,
  (SELECT string_agg(r || '=' || n, ',' ORDER BY r) FROM firsts) AS quarantine_reason_counts,
  (SELECT string_agg(r || '=' || n, ',' ORDER BY r) FROM everyone) AS all_quarantine_reason_counts
FROM share""",
    "silver_orders": _with(SILVER)
    + f"SELECT {_out(ORDER_COLUMNS + ['source_update_ts', 'total_amount'])} FROM silver",
    "silver_summary": _with(SILVER)
    + f"""SELECT count(DISTINCT order_id) AS distinct_orders, count(*) AS rows,
  count(DISTINCT status) AS distinct_statuses, min(status) AS first_status,
  CAST(sum({_AMOUNT}) AS DOUBLE) AS total_amount FROM silver""",
    "customers_clean": _with(CUSTOMERS)
    + """SELECT customer_id, trim(customer_name) AS customer_name, lower(trim(email)) AS email,
  trim(country) AS country, CAST(signup_date AS VARCHAR) AS signup_date FROM customers""",
    "products_clean": _with(PRODUCTS)
    + """SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
  CAST(unit_cost AS DOUBLE) AS unit_cost FROM products""",
    "masked_customers": _with(
        CUSTOMERS,
        """forms AS (
  SELECT customer_id,
         CASE customer_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '   '
              WHEN 2 THEN '  émile  o ' || customer_name ELSE customer_name END AS customer_name,
         CASE customer_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '@no-local-part'
              WHEN 2 THEN customer_name || '@' WHEN 3 THEN 'A@b@' || customer_name
              WHEN 4 THEN 'not-an-email' ELSE email END AS email,
         country, signup_date
  FROM customers)""",
    )
    + """SELECT customer_id,
  CASE WHEN customer_name IS NULL THEN NULL WHEN trim(customer_name) = '' THEN ''
       ELSE array_to_string(list_transform(
         string_split_regex(trim(customer_name), '\\s+'), lambda w: w[1] || '***'), ' ')
  END AS customer_name,
  CASE WHEN email IS NULL THEN NULL
       WHEN strpos(trim(email), '@') < 2 OR strpos(trim(email), '@') = length(trim(email))
       THEN '***'
       ELSE lower(left(trim(email), 1)) || '***'
            || lower(substr(trim(email), strpos(trim(email), '@'))) END AS email,
  country, CAST(signup_date AS VARCHAR) AS signup_date FROM forms""",
    "late_orders": _with(FEED)
    + f"""SELECT {_out(["order_id", "order_date", "source_update_ts"])},
  source_update_ts > CAST(order_date AS TIMESTAMP) + INTERVAL 48 HOUR AS is_late FROM feed""",
    "gold_daily_sales": _with(DAILY) + f"SELECT {_DAILY_OUT} FROM daily",
    "gold_revenue": _with(REVENUE) + f"SELECT {_REVENUE_OUT} FROM revenue",
    "gold_revenue_unmatched": _with(
        DIRTY,
        f"""silver AS (SELECT {SILVER_COLUMNS.replace('order_date', 'TRY_CAST(order_date AS DATE) AS order_date')}
  FROM dirty WHERE status = 'completed')""",
        DIMENSIONS, STAR, _revenue("revenue", "star"),
    )
    + f"SELECT {_REVENUE_OUT} FROM revenue",
    "gold_revenue_as_of": _with(
        SILVER, CUSTOMER_HISTORY, PRODUCT_HISTORY,
        """star AS (
  SELECT s.*, c.country, p.category FROM silver s
  LEFT JOIN customer_history c ON s.customer_id = c.customer_id AND c.valid_from <= s.order_date
       AND (c.valid_to IS NULL OR s.order_date < c.valid_to)
  LEFT JOIN product_history p ON s.product_id = p.product_id AND p.valid_from <= s.order_date
       AND (p.valid_to IS NULL OR s.order_date < p.valid_to))""",
        _revenue("revenue", "star"),
    )
    + f"SELECT {_REVENUE_OUT} FROM revenue",
    "orders_as_of_country": _with(SILVER, CUSTOMER_HISTORY)
    + """SELECT s.order_id, s.customer_id, CAST(s.order_date AS VARCHAR) AS order_date,
  s.total_amount, c.country
FROM silver s LEFT JOIN customer_history c ON s.customer_id = c.customer_id
  AND c.valid_from <= s.order_date AND (c.valid_to IS NULL OR s.order_date < c.valid_to)""",
    "gold_rollup_category_country": _with(REVENUE)
    + """SELECT country, category, CAST(sum(total_orders) AS BIGINT) AS total_orders,
  CAST(sum(unique_customers) AS BIGINT) AS customer_days,
  CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM revenue GROUP BY country, category""",
    "gold_totals": _with(
        DAILY,
        """summed AS (SELECT count(*) AS total_days, CAST(sum(total_orders) AS BIGINT) AS total_orders,
  CAST(sum(CAST(daily_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM daily)""",
    )
    + """SELECT *, round(total_revenue / total_orders, 2) AS average_order_value FROM summed""",
    "gold_top_countries": _top("country"),
    "gold_top_categories": _top("category"),
    "freshness": _with(SILVER)
    + "SELECT CAST(max(order_date) AS VARCHAR) AS latest_order_date FROM silver",
    "backfill_window": _with(DIRTY)
    + f"SELECT {_FEED_OUT} FROM dirty WHERE TRY_CAST(order_date AS DATE) {_WINDOW_SQL}",
    "affected_dates": _with(DAILY)
    + """SELECT DISTINCT CAST(order_date AS VARCHAR) AS order_date FROM (
  SELECT order_date FROM daily UNION ALL SELECT order_date FROM feed WHERE status = 'returned')
WHERE order_date IS NOT NULL""",
    "replace_partitions": _with(
        ORDERS_FIRST, ORDER_UPDATES,
        f"silver AS (SELECT {SILVER_COLUMNS} FROM feed WHERE status = 'completed')",
        _daily("daily", "silver"),
        f"""rebuilt_silver AS (SELECT {_SHIFTED_COLUMNS} FROM updates
  WHERE status = 'completed' AND order_date {_WINDOW_SQL})""",
        _daily("rebuilt", "rebuilt_silver"),
    )
    + f"""SELECT {_DAILY_OUT} FROM daily WHERE NOT order_date {_WINDOW_SQL}
UNION ALL SELECT {_DAILY_OUT} FROM rebuilt""",
    "history_audit": _with(_OPERATIONS) + "SELECT * FROM coverage",
    "history_missing": _with(_OPERATIONS)
    + "SELECT table_name, operation FROM coverage WHERE times = 0",
    "metrics_filtered": _with(LOG)
    + f"""SELECT {_BRIEF} FROM log
WHERE metric_name IN ('pipeline_runs', 'step_metrics') AND run_id IN ('1', '2', '3', '5', '8')
  AND recorded_at >= TIMESTAMP '2024-01-03 00:00:00'
  AND recorded_at < TIMESTAMP '2024-01-21 00:00:00'""",
    "metrics_failures": _with(LOG) + f"SELECT {_BRIEF} FROM log WHERE lower(status) = 'failed'",
    "metrics_latest": _with(LOG)
    + f"""SELECT {_BRIEF} FROM log
QUALIFY row_number() OVER (PARTITION BY metric_name ORDER BY sort_ts DESC, record_id DESC) = 1""",
    "metrics_record_counts": _with(LOG)
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS metric_name, count(*) AS records FROM log WHERE metric_name = '{name}'"
        for name in METRIC_NAMES
    ),
    "metrics_run_status": _with(LOG)
    + """SELECT run_id, min(pipeline_name) AS pipeline_name,
  coalesce(arg_max(lower(status), (sort_ts, record_id))
             FILTER (WHERE metric_name = 'pipeline_runs' AND status IS NOT NULL),
           CASE WHEN bool_or(lower(status) = 'failed') THEN 'failed' ELSE 'unknown' END) AS status,
  coalesce(arg_max(duration_seconds, (sort_ts, record_id))
             FILTER (WHERE metric_name = 'pipeline_runs' AND duration_seconds IS NOT NULL),
           CAST(sum(CAST(duration_seconds AS DECIMAL(28,9))) AS DOUBLE), 0.0) AS duration_seconds
FROM log WHERE run_id IS NOT NULL GROUP BY run_id""",
    "metrics_step_status": _with(LOG)
    + """SELECT status, count(*) AS steps FROM log
WHERE metric_name = 'pipeline_steps' AND status IS NOT NULL GROUP BY status""",
    "metrics_step_duration": _with(LOG)
    + """SELECT step, count(*) AS attempts,
  CAST(sum(CAST(duration_seconds AS DECIMAL(28,9))) AS DOUBLE) / count(*) AS mean_seconds,
  max(duration_seconds) AS longest_seconds
FROM log WHERE metric_name = 'pipeline_steps' AND duration_seconds IS NOT NULL GROUP BY step""",
    "metrics_step_rows": _with(LOG)
    + "\nUNION ALL\n".join(
        f"SELECT run_id, step, record_id, '{kind}' AS row_type, CAST({expression} AS BIGINT) AS rows "
        "FROM log WHERE metric_name = 'step_metrics'"
        for kind, expression in (
            ("read", "event_id * 10 + k"), ("written", "event_id * 10"), ("quarantined", "k")
        )
    ),
    "metrics_rule_failures": _with(LOG)
    + "\nUNION ALL\n".join(
        f"SELECT '{rule}' AS rule, CAST({_newest('orders_data_quality', value)} AS BIGINT) AS failures"
        for rule, value in (
            ("invalid_quantity", "k"), ("invalid_status", "k % 7"),
            ("unknown_customer_id", "event_id % 13"),
        )
    ),
    "metrics_invalid_trend": _with(LOG)
    + """SELECT CAST(recorded_at AS VARCHAR) AS recorded_at, run_id, value AS invalid_percentage
FROM log WHERE metric_name = 'orders_data_quality' AND recorded_at IS NOT NULL""",
    "metrics_run_history": _with(LOG)
    + """SELECT CAST(recorded_at AS VARCHAR) AS recorded_at, record_id, pipeline_name, run_id,
  status, duration_seconds, 10 AS total_steps, 10 - k % 4 AS successful_steps,
  k % 4 AS failed_steps, 0 AS skipped_steps, failed_step
FROM log WHERE metric_name = 'pipeline_runs'""",
    "metrics_gauges": _with(LOG) + "\nUNION ALL\n".join(_GAUGES),
    "metrics_maxima": _with(LOG)
    + f"""SELECT max(CASE WHEN metric_name = 'pipeline_runs' THEN 1 - {_FAILED} END) AS run_status,
  max(CASE WHEN metric_name = 'pipeline_runs' THEN duration_seconds END) AS duration_seconds,
  max(CASE WHEN metric_name = 'orders_data_quality' THEN value END) AS invalid_percentage,
  max(CASE WHEN metric_name = 'gold_sales_metrics' THEN value END) AS total_revenue FROM log""",
    "metrics_alerts": _with(
        LOG,
        f"""state AS (SELECT
    CAST({_newest('pipeline_runs', _FAILED)} AS DOUBLE) AS failed,
    CAST({_newest('orders_data_quality', 'value')} AS DOUBLE) AS invalid,
    epoch_us(TIMESTAMP '{LOG_AS_OF}') / 1000000.0 - (SELECT max(epoch_us(ts) / 1000000.0)
      FROM log WHERE metric_name = 'gold_sales_metrics') AS age)""",
    )
    + "\nUNION ALL\n".join(
        [
            """SELECT 'pipeline_run_failed' AS alert, 'critical' AS severity,
  coalesce(failed = 1, false) AS firing, failed AS value FROM state""",
            """SELECT 'high_invalid_percentage', 'warning', coalesce(invalid > 5, false), invalid
FROM state""",
            "SELECT 'gold_stale', 'warning', coalesce(age > 7200, false), age FROM state",
            *[
                f"SELECT '{alert}', 'warning', count(*) = 0, CAST(count(*) AS DOUBLE) FROM log "
                f"WHERE metric_name = '{metric}'"
                for alert, metric in _MISSING.items()
            ],
        ]
    ),
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
