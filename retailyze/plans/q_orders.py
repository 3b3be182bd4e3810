"""Queries over the order-export schema."""

from __future__ import annotations

from ..operators import orders as A
from .fixtures import DIRTY_ORDERS_SQL, dirty_orders, with_sql
from .registry import register

_W = with_sql(DIRTY_ORDERS_SQL) + """, valid AS (
  SELECT * FROM dirty_orders WHERE status IS NOT NULL AND price > 0 AND grand_total > 0)
"""
_MEAN_GT = "CAST(SUM(grand_total) AS DOUBLE) / CAST(COUNT(grand_total) AS DOUBLE)"


def _valid(spark, d):
    return A.valid_orders(dirty_orders(spark, d))


@register("c01_valid_orders", _W + """
SELECT item_id, status, CAST(price AS DOUBLE) AS price, CAST(grand_total AS DOUBLE) AS grand_total
FROM valid""")
def c01(spark, d):
    return _valid(spark, d).select("item_id", "status", "price", "grand_total")


@register("a01_revenue_kpis", _W + f"""
SELECT CAST(SUM(grand_total) AS DOUBLE) AS total_revenue, {_MEAN_GT} AS avg_order_value,
       COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers
FROM valid""")
def a01(spark, d):
    return A.revenue_kpis(_valid(spark, d))


@register("a02_category_performance", _W + f"""
SELECT category_name_1, CAST(SUM(grand_total) AS DOUBLE) AS category_revenue,
       COUNT(*) AS category_orders, {_MEAN_GT} AS category_avg_order
FROM valid GROUP BY category_name_1
ORDER BY SUM(grand_total) DESC, category_name_1 ASC NULLS LAST LIMIT 10""")
def a02(spark, d):
    return A.category_performance(_valid(spark, d))


@register("a03_monthly_trends", _W + """
SELECT year, month, CAST(SUM(grand_total) AS DOUBLE) AS monthly_revenue, COUNT(*) AS monthly_orders
FROM valid GROUP BY year, month ORDER BY year, month""")
def a03(spark, d):
    return A.monthly_trends(_valid(spark, d))


@register("a04_payment_analysis", _W + """
SELECT payment_method, CAST(SUM(grand_total) AS DOUBLE) AS payment_revenue, COUNT(*) AS payment_orders
FROM valid GROUP BY payment_method ORDER BY SUM(grand_total) DESC""")
def a04(spark, d):
    return A.payment_analysis(_valid(spark, d))


@register("a05_status_distribution", _W + """
SELECT status, COUNT(*) AS status_count, CAST(SUM(grand_total) AS DOUBLE) AS status_revenue
FROM valid GROUP BY status""")
def a05(spark, d):
    return A.status_distribution(_valid(spark, d))


@register("a06_executive_summary", _W + f""",
kpi AS (SELECT CAST(SUM(grand_total) AS DOUBLE) AS total_revenue, {_MEAN_GT} AS avg_order_value,
               COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers FROM valid),
cat AS (SELECT category_name_1, SUM(grand_total) AS rev FROM valid GROUP BY 1),
top AS (SELECT category_name_1, rev FROM cat ORDER BY rev DESC, category_name_1 DESC LIMIT 1)
SELECT kpi.*, COALESCE((SELECT category_name_1 FROM top), 'N/A') AS top_category,
       CAST(COALESCE((SELECT rev FROM top), 0) AS DOUBLE) AS top_category_revenue
FROM kpi""")
def a06(spark, d):
    return A.executive_summary(_valid(spark, d))


@register("a07_category_payment_summary", with_sql(DIRTY_ORDERS_SQL) + f"""
SELECT category_name_1, payment_method, CAST(SUM(grand_total) AS DOUBLE) AS total_revenue,
       COUNT(*) AS transaction_count, {_MEAN_GT} AS avg_transaction_value
FROM dirty_orders WHERE status IS NOT NULL GROUP BY 1, 2""")
def a07(spark, d):
    return A.category_payment_summary(dirty_orders(spark, d))


@register("c02_drop_null_ordinal", with_sql(DIRTY_ORDERS_SQL) + """
SELECT item_id, status FROM dirty_orders WHERE status IS NOT NULL""")
def c02(spark, d):
    from ..operators.clean import drop_null_ordinal
    return drop_null_ordinal(dirty_orders(spark, d).select("item_id", "status"), 1)

