"""Queries for profiling and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import orders as A
from ..operators import profile as PR
from ..operators import quality as Q
from ..operators import sales as G
from ..operators.rules import DEFAULT_RULES
from .fixtures import (CONFIG_ORDERS_SQL, DIRTY_ORDERS_SQL, DIRTY_SALES_SQL, config_orders,
                       dirty_orders, dirty_sales, table, with_sql)
from .registry import register
from .sqlbits import TRIM_WS

DO = with_sql(DIRTY_ORDERS_SQL) + """, prof AS (SELECT * FROM dirty_orders WHERE status IS NOT NULL)
"""
# Column names and Spark type names of the order-export fixture, in order.
_ORDER_TYPES = [("item_id", "string"), ("status", "string"), ("created_at", "timestamp_ntz"),
                ("sku", "string"), ("price", "decimal(18,8)"), ("qty_ordered", "int"),
                ("grand_total", "decimal(18,4)"), ("increment_id", "string"), ("category_name_1", "string"),
                ("discount_amount", "decimal(18,4)"), ("payment_method", "string"), ("year", "int"),
                ("month", "int"), ("customer_id", "string")]
_NUMERIC = [c for c, t in _ORDER_TYPES if t in PR.NUMERIC_TYPES]
_STRINGS = [c for c, t in _ORDER_TYPES if t == "string"]


def _profiled(spark, d):
    return C.drop_null_ordinal(dirty_orders(spark, d), 1)


@register("a08_basic_stats", DO + f"""
SELECT COUNT(*) AS total_records, CAST({len(_ORDER_TYPES)} AS BIGINT) AS total_columns,
       CAST({len(_NUMERIC)} AS BIGINT) AS numeric_columns FROM prof""")
def a08(spark, d):
    return PR.basic_stats(_profiled(spark, d))


@register("a09_column_profile", DO + "\nUNION ALL\n".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name,
       CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_values,
       CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS null_count, '{t}' AS data_type FROM prof"""
    for i, (c, t) in enumerate(_ORDER_TYPES)))
def a09(spark, d):
    return PR.column_profile(_profiled(spark, d))


def _num_sql(c: str) -> str:
    n = f"CAST(COUNT({c}) AS DOUBLE)"
    sx = f"CAST(SUM(CAST({c} AS BIGINT)) AS DOUBLE)"
    stats = [("count", n), ("mean", f"{sx} / {n}"),
             ("stddev", f"ROUND(stddev_samp(CAST({c} AS DOUBLE)), 6)"),
             ("min", f"CAST(MIN({c}) AS DOUBLE)"), ("max", f"CAST(MAX({c}) AS DOUBLE)")]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{s}' AS stat, COALESCE({e}, 0.0) AS value FROM prof" for s, e in stats)


@register("a10_numeric_profile", DO + "\nUNION ALL\n".join(_num_sql(c) for c in _NUMERIC))
def a10(spark, d):
    out = PR.numeric_profile(_profiled(spark, d))
    return out.withColumn("value", F.when(F.col("stat") == "stddev", F.round("value", 6)).otherwise(F.col("value")))


@register("a11_categorical_profile", DO + "\nUNION ALL\n".join(
    f"""(SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, {c} AS value, COUNT(*) AS count
        FROM prof GROUP BY {c} ORDER BY count DESC, value ASC NULLS FIRST LIMIT 10)"""
    for i, c in enumerate(_STRINGS)))
def a11(spark, d):
    return PR.categorical_profile(_profiled(spark, d))


_DIRTY_TYPES = [("order_id", "string"), ("line_no", "int"), ("order_date", "string"), ("ship_date", "string"),
                ("customer", "string"), ("category", "string"), ("subcategory", "string"),
                ("product_name", "string"), ("region", "string"), ("state", "string"), ("city", "string"),
                ("quantity", "string"), ("discount", "string"), ("sales", "string"), ("profit", "string")]
DS = with_sql(DIRTY_SALES_SQL)


@register("g14_dataset_profile", DS + "\nUNION ALL\n".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type,
       CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS null_count, COUNT(*) AS row_count FROM dirty_sales"""
    for i, (c, t) in enumerate(_DIRTY_TYPES)))
def g14(spark, d):
    return PR.dataset_profile(dirty_sales(spark, d))


@register("g16_date_range", DS + """
SELECT CASE WHEN MIN(TRY_CAST(order_date AS TIMESTAMP)) IS NULL THEN 'No valid dates available'
            ELSE strftime(MIN(TRY_CAST(order_date AS TIMESTAMP)), '%Y-%m-%d') || ' to '
                 || strftime(MAX(TRY_CAST(order_date AS TIMESTAMP)), '%Y-%m-%d') END AS date_range
FROM dirty_sales""")
def g16(spark, d):
    return G.date_range(dirty_sales(spark, d))


_NULLS = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c, _ in _DIRTY_TYPES)


@register("g49_quality_report", DS + f"""
SELECT COUNT(*) AS rows, CAST({len(_DIRTY_TYPES)} AS BIGINT) AS columns,
       CAST(SUM({_NULLS}) AS BIGINT) AS missing_values,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty_sales)) AS duplicate_rows
FROM dirty_sales""")
def g49(spark, d):
    return G.quality_report(dirty_sales(spark, d), reread=False)


_TEXT = ["customer", "product_name", "category", "subcategory", "city", "state"]
_CLEANED_SQL = DS + """,
coerced AS (SELECT DISTINCT order_id, line_no, TRY_CAST(order_date AS TIMESTAMP) AS order_date,
                   TRY_CAST(ship_date AS TIMESTAMP) AS ship_date, customer, category, subcategory, product_name,
                   region, state, city, TRY_CAST(quantity AS DECIMAL(18,4)) AS quantity,
                   TRY_CAST(discount AS DECIMAL(18,4)) AS discount, TRY_CAST(sales AS DECIMAL(18,4)) AS sales,
                   TRY_CAST(profit AS DECIMAL(18,4)) AS profit FROM dirty_sales),
cleaned AS (SELECT * REPLACE (""" + ", ".join(f"{TRIM_WS(c)} AS {c}" for c in _TEXT) + """) FROM coerced)
"""
_CLEAN_COLS = [c for c, _ in _DIRTY_TYPES]
_CLEAN_NULLS = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in _CLEAN_COLS)


def _basic_cleaning(df):
    """The upload cleaning path: numbers, dates, exact duplicates, text."""
    x = C.coerce_numeric(df, to="decimal(18,4)")
    x = C.coerce_dates(x)
    x = C.dedup_rows(x, reread=False)
    return C.trim_text(x)


@register("g50_cleaning_summary", _CLEANED_SQL + f"""
SELECT COUNT(*) AS rows, CAST({len(_CLEAN_COLS)} AS BIGINT) AS columns,
       CAST(SUM({_CLEAN_NULLS}) AS BIGINT) AS missing_values,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM cleaned)) AS duplicate_rows,
       CAST(COALESCE(SUM(sales), 0) AS DOUBLE) AS total_sales, CAST(COALESCE(SUM(profit), 0) AS DOUBLE) AS total_profit,
       CAST(SUM(discount) AS DOUBLE) / CAST(COUNT(discount) AS DOUBLE) * 100.0 AS avg_discount_pct
FROM cleaned""")
def g50(spark, d):
    # rows dealt by order stay where they are for both groupings by value
    return G.cleaning_summary(_basic_cleaning(dirty_sales(spark, d, True)), reread=False)


_SUMMARY_SQL = with_sql(DIRTY_ORDERS_SQL) + """,
summary AS (SELECT category_name_1, payment_method, SUM(grand_total) AS total_revenue, COUNT(*) AS transaction_count
            FROM dirty_orders WHERE status IS NOT NULL GROUP BY 1, 2)
"""


@register("q01_quality_score", _SUMMARY_SQL + """
SELECT COUNT(*) AS record_count, CAST(COUNT_IF(category_name_1 IS NULL) AS BIGINT) AS null_category_name_1,
       CAST(COUNT_IF(total_revenue IS NULL) AS BIGINT) AS null_total_revenue,
       CAST(100 - (COUNT_IF(category_name_1 IS NULL) + COUNT_IF(total_revenue IS NULL)) * 10 AS BIGINT) AS quality_score,
       100 - (COUNT_IF(category_name_1 IS NULL) + COUNT_IF(total_revenue IS NULL)) * 10 >= 90 AS passed
FROM summary""")
def q01(spark, d):
    return Q.quality_score(A.category_payment_summary(dirty_orders(spark, d)))


_DQ = DEFAULT_RULES["data_quality"]["orders"]
_HC = DEFAULT_RULES["monitoring"]["health_checks"]
CO = with_sql(CONFIG_ORDERS_SQL)


def _q02_sql_part() -> str:
    return (f"SELECT 'min_records' AS \"check\", 'orders' AS subject, CAST(COUNT(*) AS DOUBLE) AS value, "
            f"CAST({_DQ['min_records']} AS DOUBLE) AS threshold, COUNT(*) >= {_DQ['min_records']} AS passed "
            f"FROM config_orders")


def _q04_sql_part() -> str:
    parts = []
    for c, t in _DQ["null_thresholds"].items():
        share = f"COALESCE(CAST(COUNT_IF({c} IS NULL) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 0.0)"
        parts.append(f"SELECT 'null_threshold' AS \"check\", 'orders.{c}' AS subject, {share} AS value, "
                     f"CAST({t} AS DOUBLE) AS threshold, {share} <= {float(t)} AS passed FROM config_orders")
    return "\nUNION ALL\n".join(parts)


_NOW = "2024-01-31 00:00:00"


def _q06_sql_part(events: str = "events") -> str:
    age = (f"CAST(epoch_us(TIMESTAMP '{_NOW}') - epoch_us(MAX(ts)) AS DOUBLE) / 3.6e9")
    return f"""SELECT 'data_freshness_hours' AS "check", 'ts' AS subject, {age} AS value,
       CAST({_HC['data_freshness_hours']} AS DOUBLE) AS threshold, {age} <= {float(_HC['data_freshness_hours'])} AS passed
FROM {events}
UNION ALL
SELECT 'min_daily_records', 'ts', CAST(MIN(n) AS DOUBLE), CAST({_HC['min_daily_records']} AS DOUBLE),
       MIN(n) >= {_HC['min_daily_records']}
FROM (SELECT day, COUNT(e.ts) AS n
      FROM (SELECT unnest(generate_series((SELECT MIN(ts) FROM {events})::DATE::TIMESTAMP, TIMESTAMP '{_NOW}' - INTERVAL 1 MICROSECOND,
                                          INTERVAL 1 DAY))::DATE AS day) s
      LEFT JOIN {events} e ON CAST(e.ts AS DATE) = s.day GROUP BY day)
UNION ALL
SELECT 'max_error_rate', 'event_type', CAST(COUNT_IF(event_type = 'error') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE),
       {float(_HC['max_error_rate'])},
       CAST(COUNT_IF(event_type = 'error') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) <= {float(_HC['max_error_rate'])}
FROM {events}"""


@register("q02_min_records", CO + _q02_sql_part())
def q02(spark, d):
    return Q.check_min_records(config_orders(spark, d), _DQ["min_records"], "orders")


@register("q04_null_thresholds", CO + _q04_sql_part())
def q04(spark, d):
    return Q.check_null_thresholds(config_orders(spark, d), _DQ["null_thresholds"], "orders")


@register("q06_health_checks", _q06_sql_part())
def q06(spark, d):
    return Q.health_checks(table(spark, d, "events"), now=_NOW, freshness_hours=_HC["data_freshness_hours"],
                           min_daily=_HC["min_daily_records"], max_error_rate=_HC["max_error_rate"])


@register("q06_health_checks_gap", """WITH moved AS (
  SELECT CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN ts + INTERVAL 1 DAY ELSE ts END AS ts, event_type FROM events)
""" + _q06_sql_part("moved"))
def q06_gap(spark, d):
    """All events, those of one day dated a day later: that day has none."""
    day = F.to_date("ts") == F.lit("2024-01-10").cast("date")
    moved = table(spark, d, "events").withColumn("ts", F.when(day, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")))
    return Q.health_checks(moved, now=_NOW, freshness_hours=_HC["data_freshness_hours"],
                           min_daily=_HC["min_daily_records"], max_error_rate=_HC["max_error_rate"])


@register("q07_grade_checks", CO + f""",
checks AS ({_q02_sql_part()}
UNION ALL
{_q04_sql_part()}
UNION ALL
{_q06_sql_part()})
SELECT COUNT(*) AS total_checks, CAST(COUNT_IF(passed) AS BIGINT) AS passed_checks,
       CAST(COUNT_IF(passed) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0 AS passed_pct,
       CASE WHEN CAST(COUNT_IF(passed) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0 >= 90 THEN 'excellent'
            WHEN CAST(COUNT_IF(passed) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0 >= 70 THEN 'good'
            WHEN CAST(COUNT_IF(passed) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0 >= 50 THEN 'fair'
            ELSE 'poor' END AS grade
FROM checks""")
def q07(spark, d):
    co = config_orders(spark, d)
    checks = (Q.check_min_records(co, _DQ["min_records"], "orders")
              .unionByName(Q.check_null_thresholds(co, _DQ["null_thresholds"], "orders"))
              .unionByName(q06(spark, d)))
    return Q.grade_checks(checks)
