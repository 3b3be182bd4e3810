"""Queries over the canonical sales table (G01-G50, N01-N05) with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sales as G
from ..operators import windows as N
from .fixtures import (ORDERS_FACT_SQL, SALES_FACT_SQL, orders_fact, sales_fact, with_sql)
from .registry import register
from .sqlbits import D, EDGE_BINS, FS, MEAN, PCT, QUANT

S = with_sql(SALES_FACT_SQL)
O = with_sql(ORDERS_FACT_SQL)


@register("g01_sales_kpis", S + f"""
SELECT {FS('sales')} AS total_sales, {FS('profit')} AS total_profit, COUNT(*) AS total_orders,
       {FS('profit')} / NULLIF({FS('sales')}, 0) * 100.0 AS profit_margin
FROM sales_fact""")
def g01(spark, d):
    return G.sales_kpis(sales_fact(spark, d))


@register("g02_top_categories_by_count", S + """
SELECT category, COUNT(*) AS count FROM sales_fact WHERE category IS NOT NULL
GROUP BY 1 ORDER BY count DESC, category LIMIT 5""")
def g02(spark, d):
    return G.top_by_count(sales_fact(spark, d), "category", 5)


@register("g03_top_regions_by_count", S + """
SELECT region, COUNT(*) AS count FROM sales_fact WHERE region IS NOT NULL
GROUP BY 1 ORDER BY count DESC, region LIMIT 5""")
def g03(spark, d):
    return G.top_by_count(sales_fact(spark, d), "region", 5)


@register("g04_monthly_sales_prefix", S + f"""
SELECT substr(CAST(order_date AS VARCHAR), 1, 7) AS month, {FS('sales')} AS sales
FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1""")
def g04(spark, d):
    return G.monthly_sales_prefix(sales_fact(spark, d))


@register("g05_sales_by_category", S + f"""
SELECT category, {FS('sales')} AS sales FROM sales_fact WHERE category IS NOT NULL GROUP BY 1""")
def g05(spark, d):
    return G.sum_by(sales_fact(spark, d), "category", "sales")


@register("g06_profit_by_region", S + f"""
SELECT region, {FS('profit')} AS profit FROM sales_fact WHERE region IS NOT NULL GROUP BY 1""")
def g06(spark, d):
    return G.sum_by(sales_fact(spark, d), "region", "profit")


@register("g07_top_rows_by_sales", S + """
SELECT product_name, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit
FROM sales_fact ORDER BY sales DESC NULLS LAST, product_name, sales, profit LIMIT 10""")
def g07(spark, d):
    return G.top_rows(sales_fact(spark, d), 10)


@register("g08_order_analytics", O + f""",
kpi AS (SELECT COUNT(*) AS total_orders, {FS('price')} AS total_revenue,
               COUNT(DISTINCT customer_id) AS unique_customers FROM orders_fact),
top AS (SELECT category_name_1 AS category, COUNT(*) AS category_count FROM orders_fact
        WHERE category_name_1 IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT kpi.*, category, category_count,
       CAST(row_number() OVER (ORDER BY category_count DESC, category) AS INTEGER) AS category_rank
FROM top, kpi""")
def g08(spark, d):
    return G.order_analytics(orders_fact(spark, d))


@register("g09_revenue_by_category_top10", O + f"""
SELECT category_name_1, {FS('grand_total')} AS revenue FROM orders_fact
WHERE category_name_1 IS NOT NULL GROUP BY 1 ORDER BY SUM(grand_total) DESC, 1 LIMIT 10""")
def g09(spark, d):
    return G.revenue_by_category(orders_fact(spark, d), 10)


@register("g10_revenue_by_month", O + f"""
SELECT month, {FS('grand_total')} AS revenue FROM orders_fact WHERE month IS NOT NULL GROUP BY 1""")
def g10(spark, d):
    return G.revenue_by_month(orders_fact(spark, d))


@register("g11_payment_share", O + f"""
SELECT payment_method, COUNT(*) AS count,
       {D('COUNT(*)')} / NULLIF({D('SUM(COUNT(*)) OVER ()')}, 0) * 100.0 AS share_pct
FROM orders_fact WHERE payment_method IS NOT NULL GROUP BY 1""")
def g11(spark, d):
    return G.value_share(orders_fact(spark, d), "payment_method")


@register("g12_status_counts", O + """
SELECT status, COUNT(*) AS count FROM orders_fact WHERE status IS NOT NULL GROUP BY 1""")
def g12(spark, d):
    return G.value_counts(orders_fact(spark, d), "status")


@register("g13_order_kpis", O + f"""
SELECT COUNT(*) AS total_orders, {FS('grand_total')} AS total_revenue,
       {MEAN('grand_total')} AS avg_order_value, COUNT(DISTINCT category_name_1) AS categories
FROM orders_fact""")
def g13(spark, d):
    return G.order_kpis(orders_fact(spark, d))


@register("g15_insights", S + """,
a AS (SELECT COUNT(*) AS total_orders, COALESCE(SUM(sales), 0) AS s, COALESCE(SUM(profit), 0) AS p FROM sales_fact),
b AS (SELECT total_orders,
             CAST(s AS DOUBLE) AS total_sales, CAST(p AS DOUBLE) AS total_profit FROM a)
SELECT total_sales, total_profit, total_orders,
       CASE WHEN total_orders > 0 AND total_sales > 0 THEN total_sales / total_orders ELSE 0.0 END AS avg_order_value,
       CASE WHEN total_sales > 0 THEN total_profit / total_sales * 100.0 ELSE 0.0 END AS profit_margin
FROM b""")
def g15(spark, d):
    return G.insights(sales_fact(spark, d))


@register("g17_monthly_growth", S + """,
m AS (SELECT strftime(order_date, '%Y-%m') AS m, COALESCE(SUM(sales), 0) AS s
      FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1),
a AS (SELECT COUNT(*) AS months, arg_min(s, m) AS first, arg_max(s, m) AS last FROM m)
SELECT months, CAST(first AS DOUBLE) AS first_month_sales, CAST(last AS DOUBLE) AS last_month_sales,
       CASE WHEN months > 1 AND first > 0 THEN CAST(last - first AS DOUBLE) / CAST(first AS DOUBLE) * 100.0
            ELSE 0.0 END AS monthly_growth
FROM a""")
def g17(spark, d):
    return G.monthly_growth(sales_fact(spark, d))


def _contrib_sql(key: str) -> str:
    return S + f""",
tot AS (SELECT COALESCE(SUM(sales), 0) AS tot FROM sales_fact),
per AS (SELECT {key} AS k, COALESCE(SUM(sales), 0) AS s FROM sales_fact WHERE {key} IS NOT NULL GROUP BY 1),
top AS (SELECT k, s FROM per ORDER BY s DESC, k DESC LIMIT 1)
SELECT '{key}' AS key_column, CASE WHEN top.s > 0 THEN CAST(top.k AS VARCHAR) ELSE 'N/A' END AS top_value,
       CAST(top.s AS DOUBLE) AS top_sales,
       CASE WHEN top.s > 0 AND tot > 0 THEN CAST(top.s AS DOUBLE) / CAST(tot AS DOUBLE) * 100.0 ELSE 0.0 END
         AS contribution_pct
FROM top, tot"""


@register("g18_top_category_contribution", _contrib_sql("category"))
def g18(spark, d):
    return G.top_contributor(sales_fact(spark, d), "category")


@register("g19_top_region_contribution", _contrib_sql("region"))
def g19(spark, d):
    return G.top_contributor(sales_fact(spark, d), "region")


@register("g20_sales_by_category_desc", S + f"""
SELECT category, {FS('sales')} AS sales FROM sales_fact WHERE category IS NOT NULL
GROUP BY 1 ORDER BY SUM(sales) DESC, category""")
def g20(spark, d):
    return G.sales_by_category(sales_fact(spark, d))


@register("g21_top_regions_share", S + f""",
top AS (SELECT region, COALESCE(SUM(sales), 0) AS sales FROM sales_fact WHERE region IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT region, CAST(sales AS DOUBLE) AS sales, {PCT('sales', 'SUM(sales) OVER ()')} AS share_pct FROM top""")
def g21(spark, d):
    return G.top_regions_share(sales_fact(spark, d), 10)


@register("g22_profitability", S + f""",
g AS (SELECT category, COALESCE(SUM(sales), 0) AS sales, COALESCE(SUM(profit), 0) AS profit
      FROM sales_fact WHERE category IS NOT NULL GROUP BY 1),
h AS (SELECT *, {PCT('profit', 'sales')} AS profit_margin FROM g)
SELECT category, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, profit_margin,
       CASE WHEN MIN(profit_margin) OVER () < 0 THEN profit_margin + abs(MIN(profit_margin) OVER ()) + 1.0
            ELSE profit_margin END AS bubble_size
FROM h""")
def g22(spark, d):
    return G.profitability(sales_fact(spark, d))


@register("g23_discount_impact", S + f""",
x AS (SELECT CAST(discount AS DOUBLE) AS x, profit, sales FROM sales_fact WHERE discount IS NOT NULL),
st AS (SELECT MIN(x) AS mn, MAX(x) AS mx FROM x),
st2 AS (SELECT mn, mx, (mx - mn) / 10.0 AS w FROM st WHERE mx > mn),
r AS (SELECT {EDGE_BINS('x', 'mn', 'w', 10)} AS bin, profit, sales FROM x, st2),
agg AS (SELECT bin, {MEAN('profit')} AS avg_profit, COUNT(sales) AS rows FROM r GROUP BY bin),
spine AS (SELECT mn, mx, w, CAST(b AS INTEGER) AS bin FROM st2, range(1, 11) t(b))
SELECT spine.bin,
       CASE WHEN spine.bin = 1 THEN mn - (mx - mn) * 0.001 ELSE CAST(spine.bin - 1 AS DOUBLE) * w + mn END AS bin_lo,
       CASE WHEN spine.bin = 10 THEN mx ELSE CAST(spine.bin AS DOUBLE) * w + mn END AS bin_hi,
       avg_profit, COALESCE(rows, 0) AS rows
FROM spine LEFT JOIN agg ON spine.bin = agg.bin""")
def g23(spark, d):
    return G.discount_impact(sales_fact(spark, d), 10)


@register("g24_daily_sales", S + f"""
SELECT strftime(CAST(order_date AS DATE), '%Y-%m-%d') AS day, {FS('sales')} AS sales
FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1""")
def g24(spark, d):
    return G.daily_sales(sales_fact(spark, d))


@register("g25_monthly_summary", S + f"""
SELECT strftime(order_date, '%Y-%m') AS month, {FS('sales')} AS sales, {FS('profit')} AS profit,
       COUNT(order_id) AS orders
FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1""")
def g25(spark, d):
    return G.monthly_summary(sales_fact(spark, d))


@register("g26_segment_summary", S + f"""
SELECT category AS segment, {FS('sales')} AS sales, {FS('profit')} AS profit, {FS('quantity')} AS quantity
FROM sales_fact WHERE category IS NOT NULL GROUP BY 1""")
def g26(spark, d):
    return G.segment_summary(sales_fact(spark, d))


@register("g27_top_products_by_profit", S + f"""
SELECT product_name AS item, {FS('profit')} AS value FROM sales_fact WHERE product_name IS NOT NULL
GROUP BY 1 ORDER BY SUM(profit) DESC, item LIMIT 15""")
def g27(spark, d):
    return G.top_products(sales_fact(spark, d), k=15)


@register("g28_performance_summary", S + f""",
a AS (SELECT COUNT(DISTINCT customer) AS customers, {FS('quantity')} AS items_sold,
             {MEAN('discount')} AS dsc, COALESCE(SUM(sales), 0) AS s FROM sales_fact)
SELECT customers, items_sold, dsc * 100.0 AS avg_discount_pct,
       CASE WHEN items_sold > 0 THEN CAST(s AS DOUBLE) / items_sold ELSE 0.0 END AS avg_unit_price
FROM a""")
def g28(spark, d):
    return G.performance_summary(sales_fact(spark, d))


@register("g29_customer_value", S + f"""
SELECT customer, CAST(ROUND(COALESCE(SUM(sales), 0), 2) AS DOUBLE) AS total_sales,
       COUNT(sales) AS order_count,
       FLOOR(({MEAN('sales')}) * 100.0 + 0.5) / 100.0 AS avg_order_value,
       CAST(ROUND(COALESCE(SUM(profit), 0), 2) AS DOUBLE) AS total_profit,
       ROUND({FS('quantity')}, 2) AS total_quantity
FROM sales_fact WHERE customer IS NOT NULL GROUP BY customer
ORDER BY SUM(sales) DESC, customer LIMIT 20""")
def g29(spark, d):
    return G.customer_value(sales_fact(spark, d), 20)


@register("g30_customer_segments", S + """,
tot AS (SELECT customer, COALESCE(SUM(sales), 0) AS t FROM sales_fact WHERE customer IS NOT NULL GROUP BY 1),
ql AS (SELECT list_sort(list(CAST(t AS DOUBLE))) AS xs, COUNT(t) AS n FROM tot),
q AS (SELECT """ + QUANT('xs', 'n', 0.5) + """ AS p50, """ + QUANT('xs', 'n', 0.8) + """ AS p80 FROM ql),
seg AS (SELECT CASE WHEN CAST(t AS DOUBLE) > p80 THEN 'High Value'
                    WHEN CAST(t AS DOUBLE) > p50 THEN 'Medium Value' ELSE 'Low Value' END AS segment, t
        FROM tot, q),
agg AS (SELECT segment, COUNT(*) AS customers, SUM(t) AS revenue FROM seg GROUP BY 1),
spine AS (SELECT * FROM (VALUES ('High Value', 0), ('Medium Value', 1), ('Low Value', 2)) v(segment, segment_order))
SELECT spine.segment, CAST(segment_order AS INTEGER) AS segment_order, COALESCE(customers, 0) AS customers,
       CAST(COALESCE(revenue, 0) AS DOUBLE) AS revenue
FROM spine LEFT JOIN agg ON spine.segment = agg.segment""")
def g30(spark, d):
    return G.customer_segments(sales_fact(spark, d))


def _rollup_sql(outer: str, inner: str, measures: list[str]) -> str:
    sums = ", ".join(f"COALESCE(SUM({m}), 0) AS {m}" for m in measures)
    outs = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in measures)
    first = measures[0]
    parent = (f"CASE WHEN gid = 0 THEN MAX(CASE WHEN gid = 1 THEN {first} END) OVER (PARTITION BY {outer}) "
              f"WHEN gid = 1 THEN MAX(CASE WHEN gid = 3 THEN {first} END) OVER () ELSE {first} END")
    return S + f""",
r AS (SELECT {outer}, {inner}, {sums}, GROUPING({outer}, {inner}) AS gid
      FROM sales_fact WHERE {outer} IS NOT NULL AND {inner} IS NOT NULL GROUP BY ROLLUP ({outer}, {inner}))
SELECT CASE WHEN gid = 3 THEN 'total' WHEN gid = 1 THEN '{outer}' ELSE '{inner}' END AS level,
       {outer}, {inner}, {outs}, {D(first)} / NULLIF({D(parent)}, 0) * 100.0 AS pct_of_parent
FROM r"""


@register("g31_product_hierarchy", _rollup_sql("category", "subcategory", ["sales", "profit", "quantity"]))
def g31(spark, d):
    return G.product_hierarchy(sales_fact(spark, d))


def _hist_sql(expr: str, bins: int, median: bool, floating: bool = False) -> str:
    mean_sql = f"ROUND({MEAN('v')}, 9)" if floating else MEAN('v')
    med = (", " + QUANT("list_sort(list(x) FILTER (WHERE x IS NOT NULL))", "COUNT(x)", 0.5, True)
           + " AS median") if median else ""
    med_out = ", median" if median else ""
    return S + f""",
src AS (SELECT {expr} AS v FROM sales_fact),
x AS (SELECT CAST(v AS DOUBLE) AS x, v FROM src),
st AS (SELECT MIN(x) AS mn, MAX(x) AS mx, {mean_sql} AS mean{med} FROM x),
st2 AS (SELECT *, (mx - mn) / {float(bins)} AS w FROM st),
r AS (SELECT LEAST({bins}, COALESCE(CAST(FLOOR((x - mn) / NULLIF(w, 0)) AS BIGINT), 0) + 1) AS bin
      FROM x, st2 WHERE x IS NOT NULL),
cnt AS (SELECT bin, COUNT(*) AS count FROM r GROUP BY 1),
spine AS (SELECT st2.*, CAST(b AS INTEGER) AS bin FROM st2, range(1, {bins + 1}) t(b))
SELECT spine.bin, CAST(spine.bin - 1 AS DOUBLE) * w + mn AS bin_lo,
       CASE WHEN spine.bin = {bins} THEN mx ELSE CAST(spine.bin AS DOUBLE) * w + mn END AS bin_hi,
       COALESCE(count, 0) AS count, mean{med_out}
FROM spine LEFT JOIN cnt ON spine.bin = cnt.bin"""


_ROW_MARGIN_SQL = f"COALESCE({PCT('profit', 'sales')}, 0.0)"


@register("g32_margin_histogram", _hist_sql(_ROW_MARGIN_SQL, 30, False, floating=True))
def g32a(spark, d):
    from ..operators.shape import row_margin
    return G.histogram(row_margin(sales_fact(spark, d)), "profit_margin", 30)


@register("g32_sales_histogram", _hist_sql("sales", 50, True))
def g32b(spark, d):
    return G.histogram(sales_fact(spark, d), "sales", 50, with_median=True)


@register("g33_regional_metrics", S + f"""
SELECT region, state, {FS('sales')} AS sales, {FS('profit')} AS profit, COUNT(DISTINCT customer) AS customers
FROM sales_fact WHERE region IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2""")
def g33(spark, d):
    return G.regional_metrics(sales_fact(spark, d))


@register("g34_top_cities", S + f"""
SELECT city, {FS('sales')} AS sales, {FS('profit')} AS profit, COUNT(DISTINCT customer) AS customers
FROM sales_fact WHERE city IS NOT NULL GROUP BY 1 ORDER BY SUM(sales) DESC, city LIMIT 15""")
def g34(spark, d):
    return G.top_cities(sales_fact(spark, d), 15)


@register("g35_business_summary", S + f""",
tot AS (SELECT COALESCE(SUM(sales), 0) AS s, COALESCE(SUM(profit), 0) AS p,
               COUNT(DISTINCT customer) AS customers, {MEAN('sales')} AS avg_sales FROM sales_fact),
cat AS (SELECT category, COALESCE(SUM(sales), 0) AS cs FROM sales_fact WHERE category IS NOT NULL GROUP BY 1),
mon AS (SELECT CAST(month(order_date) AS INTEGER) AS m, COALESCE(SUM(sales), 0) AS ms
        FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1)
SELECT CASE WHEN s > 0 THEN CAST(p AS DOUBLE) / CAST(s AS DOUBLE) * 100.0 ELSE 0.0 END AS profit_margin,
       CASE WHEN (SELECT MAX(cs) FROM cat) > 0
            THEN (SELECT category FROM cat ORDER BY cs DESC, category DESC LIMIT 1) ELSE 'N/A' END AS best_category,
       CASE WHEN (SELECT MIN(cs) FROM cat) >= 0
            THEN (SELECT category FROM cat ORDER BY cs ASC, category ASC LIMIT 1) ELSE 'N/A' END AS worst_category,
       CASE WHEN (SELECT MAX(ms) FROM mon) > 0
            THEN CAST((SELECT m FROM mon ORDER BY ms DESC, m DESC LIMIT 1) AS VARCHAR) ELSE 'N/A' END AS best_month,
       customers, avg_sales
FROM tot""")
def g35(spark, d):
    return G.business_summary(sales_fact(spark, d))


@register("g36_box_stats", S + """,
d AS (SELECT category, CAST(profit AS DOUBLE) AS x FROM sales_fact WHERE category IS NOT NULL AND profit IS NOT NULL),
ql AS (SELECT category, list_sort(list(x)) AS xs, COUNT(x) AS n FROM d GROUP BY 1),
q AS (SELECT category, """ + QUANT('xs', 'n', 0.25) + """ AS q1, """ + QUANT('xs', 'n', 0.5) + """ AS median,
             """ + QUANT('xs', 'n', 0.75) + """ AS q3 FROM ql)
SELECT d.category, q1, median, q3, COUNT(*) AS n, MIN(x) AS min, MAX(x) AS max,
       MIN(CASE WHEN x >= q1 - (q3 - q1) * 1.5 THEN x END) AS whisker_lo,
       MAX(CASE WHEN x <= q3 + (q3 - q1) * 1.5 THEN x END) AS whisker_hi
FROM d JOIN q ON d.category = q.category GROUP BY d.category, q1, median, q3""")
def g36(spark, d):
    return G.box_stats(sales_fact(spark, d))


@register("g37_correlation", S + """
SELECT COUNT(CASE WHEN sales IS NOT NULL AND profit IS NOT NULL THEN 1 END) AS n,
       ROUND(corr(CAST(sales AS DOUBLE), CAST(profit AS DOUBLE)), 9) AS correlation FROM sales_fact""")
def g37(spark, d):
    return G.correlation(sales_fact(spark, d)).withColumn("correlation", F.round("correlation", 9))


@register("g38_trend_line", S + """,
b AS (SELECT CAST(sales AS DOUBLE) AS x, CAST(profit AS DOUBLE) AS y FROM sales_fact
      WHERE sales IS NOT NULL AND profit IS NOT NULL),
m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, MIN(x) AS mn, MAX(x) AS mxx FROM b),
p AS (SELECT CAST(i AS INTEGER) AS i,
             CASE WHEN i = 99 THEN mxx ELSE CAST(i AS DOUBLE) * ((mxx - mn) / 99.0) + mn END AS x,
             slope, intercept FROM m, range(0, 100) t(i))
SELECT i, x, ROUND(slope, 9) AS slope, ROUND(intercept, 4) AS intercept, ROUND(slope * x + intercept, 3) AS y FROM p""")
def g38(spark, d):
    line = G.trend_line(sales_fact(spark, d))
    return line.withColumns({"slope": F.round("slope", 9), "intercept": F.round("intercept", 4), "y": F.round("y", 3)})


@register("g39_weekday_pattern", S + f"""
SELECT CAST(isodow(order_date) AS INTEGER) AS day_index, dayname(order_date) AS day_of_week,
       {MEAN('sales')} AS avg_sales
FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1, 2 ORDER BY 1""")
def g39(spark, d):
    return G.weekday_pattern(sales_fact(spark, d))


@register("g40_seasonality", S + f"""
SELECT CAST(month(order_date) AS INTEGER) AS month_index, monthname(order_date) AS month, {FS('sales')} AS sales
FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1, 2 ORDER BY 1""")
def g40(spark, d):
    return G.seasonality(sales_fact(spark, d))


@register("g41_purchase_frequency", S + """
SELECT purchase_count, COUNT(*) AS customer_count
FROM (SELECT customer, COUNT(*) AS purchase_count FROM sales_fact WHERE customer IS NOT NULL GROUP BY 1)
GROUP BY 1""")
def g41(spark, d):
    return G.purchase_frequency(sales_fact(spark, d))


_RFM = S + f""",
rfm AS (SELECT customer,
               CAST(date_diff('day', CAST(MAX(order_date) AS DATE),
                              CAST((SELECT MAX(order_date) FROM sales_fact) AS DATE)) AS INTEGER) AS recency,
               COUNT(order_id) AS frequency, {FS('sales')} AS monetary
        FROM sales_fact WHERE customer IS NOT NULL GROUP BY customer)
"""


@register("g42_rfm", _RFM + "SELECT * FROM rfm")
def g42(spark, d):
    return G.rfm(sales_fact(spark, d))


@register("g43_rfm_first_100", _RFM + "SELECT * FROM rfm ORDER BY monetary DESC, customer LIMIT 100")
def g43(spark, d):
    return G.rfm_top(sales_fact(spark, d), 100)


@register("g44_subcategory_matrix", S + f""",
g AS (SELECT subcategory, COALESCE(SUM(sales), 0) AS sales, COALESCE(SUM(profit), 0) AS profit,
             {FS('quantity')} AS quantity FROM sales_fact WHERE subcategory IS NOT NULL GROUP BY 1),
h AS (SELECT *, CAST(SUM(sales) OVER () AS DOUBLE) / CAST(COUNT(*) OVER () AS DOUBLE) AS avg_sales,
                CAST(SUM(profit) OVER () AS DOUBLE) / CAST(COUNT(*) OVER () AS DOUBLE) AS avg_profit FROM g)
SELECT subcategory, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, quantity, avg_sales, avg_profit,
       CASE WHEN CAST(sales AS DOUBLE) >= avg_sales AND CAST(profit AS DOUBLE) >= avg_profit THEN 'high sales, high profit'
            WHEN CAST(sales AS DOUBLE) >= avg_sales THEN 'high sales, low profit'
            WHEN CAST(profit AS DOUBLE) >= avg_profit THEN 'low sales, high profit'
            ELSE 'low sales, low profit' END AS quadrant
FROM h""")
def g44(spark, d):
    return G.subcategory_matrix(sales_fact(spark, d))


@register("g45_category_radar", S + f""",
g AS (SELECT category, COALESCE(SUM(sales), 0) AS sales, COALESCE(SUM(profit), 0) AS profit,
             {FS('quantity')} AS quantity FROM sales_fact WHERE category IS NOT NULL GROUP BY 1)
SELECT category, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, quantity,
       {PCT('sales', 'MAX(sales) OVER ()')} AS sales_norm, {PCT('profit', 'MAX(profit) OVER ()')} AS profit_norm,
       {PCT('quantity', 'MAX(quantity) OVER ()')} AS quantity_norm
FROM g""")
def g45(spark, d):
    return G.category_radar(sales_fact(spark, d))


def _state_corr_sql() -> str:
    names = ["sales", "profit", "customer"]
    sel = []
    for a in names:
        for b in names:
            r = f"ROUND(corr({a}, {b}), 9)"
            sel.append(f"SELECT '{a}' AS var_x, '{b}' AS var_y, {r} AS correlation FROM top")
    return S + """,
top AS (SELECT state, CAST(COALESCE(SUM(sales), 0) AS DOUBLE) AS sales,
               CAST(COALESCE(SUM(profit), 0) AS DOUBLE) AS profit, CAST(COUNT(DISTINCT customer) AS DOUBLE) AS customer
        FROM sales_fact WHERE state IS NOT NULL GROUP BY 1 ORDER BY SUM(sales) DESC, state LIMIT 15)
""" + "\nUNION ALL\n".join(sel)


@register("g46_state_correlation", _state_corr_sql())
def g46(spark, d):
    return G.state_correlation(sales_fact(spark, d), 15).withColumn("correlation", F.round("correlation", 9))


@register("g47_regional_hierarchy", _rollup_sql("region", "state", ["sales", "profit"]))
def g47(spark, d):
    return G.regional_hierarchy(sales_fact(spark, d))


@register("g48_margin_by_quintile", S + f""",
el AS (SELECT list_sort(list(CAST(sales AS DOUBLE))) AS xs, COUNT(sales) AS n FROM sales_fact WHERE sales IS NOT NULL),
e AS (SELECT {QUANT('xs', 'n', 0.2)} AS e1, {QUANT('xs', 'n', 0.4)} AS e2,
             {QUANT('xs', 'n', 0.6)} AS e3, {QUANT('xs', 'n', 0.8)} AS e4 FROM el),
r AS (SELECT (CASE WHEN CAST(sales AS DOUBLE) > e1 THEN 1 ELSE 0 END + CASE WHEN CAST(sales AS DOUBLE) > e2 THEN 1 ELSE 0 END
            + CASE WHEN CAST(sales AS DOUBLE) > e3 THEN 1 ELSE 0 END + CASE WHEN CAST(sales AS DOUBLE) > e4 THEN 1 ELSE 0 END)
             AS segment_order, profit, sales
      FROM sales_fact, e WHERE sales IS NOT NULL),
g AS (SELECT segment_order, {MEAN('profit')} AS profit, {MEAN('sales')} AS sales FROM r GROUP BY 1)
SELECT CASE segment_order WHEN 0 THEN 'Very Low' WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High'
            ELSE 'Very High' END AS sales_segment,
       CAST(segment_order AS INTEGER) AS segment_order, profit, sales, profit / sales * 100.0 AS profit_margin
FROM g""")
def g48(spark, d):
    return G.margin_by_quintile(sales_fact(spark, d))


# ------------------------------------------------------------ windows
@register("n01_customer_acquisition", S + """,
f AS (SELECT customer, MIN(order_date) AS first FROM sales_fact WHERE customer IS NOT NULL GROUP BY 1),
m AS (SELECT strftime(first, '%Y-%m') AS month, COUNT(*) AS new_customers FROM f WHERE first IS NOT NULL GROUP BY 1)
SELECT month, new_customers,
       CAST(SUM(new_customers) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS cumulative_customers
FROM m""")
def n01(spark, d):
    return N.customer_acquisition(sales_fact(spark, d))


_ABC = S + """,
p AS (SELECT product_name, COALESCE(SUM(sales), 0) AS sales FROM sales_fact WHERE product_name IS NOT NULL GROUP BY 1),
r AS (SELECT product_name, sales,
             SUM(sales) OVER (ORDER BY sales DESC, product_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             row_number() OVER (ORDER BY sales DESC, product_name) AS rank, SUM(sales) OVER () AS total FROM p)
"""


@register("n02_abc_analysis", _ABC + """
SELECT product_name, CAST(sales AS DOUBLE) AS sales, CAST(cum AS DOUBLE) AS cumulative_sales,
       CAST(cum AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * 100.0 AS cumulative_percent, rank
FROM r WHERE rank <= 50""")
def n02(spark, d):
    return N.abc_analysis(sales_fact(spark, d), 50)


@register("n03_abc_class", _ABC + """
SELECT product_name, CAST(sales AS DOUBLE) AS sales, CAST(cum AS DOUBLE) AS cumulative_sales,
       CAST(cum AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * 100.0 AS cumulative_percent, rank,
       CASE WHEN CAST(cum AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * 100.0 <= 80.0 THEN 'A' ELSE 'B' END AS abc_class
FROM r""")
def n03(spark, d):
    return N.abc_class(N.abc_analysis(sales_fact(spark, d), None), 80.0)


_MONTHLY = S + """,
m AS (SELECT strftime(order_date, '%Y-%m') AS month, COALESCE(SUM(sales), 0) AS sales
      FROM sales_fact WHERE order_date IS NOT NULL GROUP BY 1)
"""


@register("n04_mom_growth", _MONTHLY + """
SELECT month, CAST(sales AS DOUBLE) AS sales,
       (CAST(sales AS DOUBLE) / NULLIF(CAST(LAG(sales) OVER (ORDER BY month) AS DOUBLE), 0) - 1.0) * 100.0 AS growth_pct
FROM m""")
def n04(spark, d):
    return N.mom_growth(sales_fact(spark, d))


@register("n05_moving_averages", _MONTHLY + """
SELECT month, CAST(sales AS DOUBLE) AS sales,
       CASE WHEN COUNT(sales) OVER w3 = 3 THEN CAST(SUM(sales) OVER w3 AS DOUBLE) / 3.0 END AS ma_3,
       CASE WHEN COUNT(sales) OVER w6 = 6 THEN CAST(SUM(sales) OVER w6 AS DOUBLE) / 6.0 END AS ma_6
FROM m
WINDOW w3 AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
       w6 AS (ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def n05(spark, d):
    return N.moving_averages(sales_fact(spark, d), (3, 6))

