"""Queries for cleaning, coercion and shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import sales as G
from ..operators import shape as P
from ..operators.rules import DEFAULT_RULES, merged_processing
from .fixtures import (CONFIG_ORDERS_SQL, DIRTY_SALES_SQL, ORDERS_FACT_SQL, SALES_FACT_SQL,
                       config_orders, dirty_sales, orders_fact, sales_fact, with_sql)
from .registry import register
from .sqlbits import FS, PCT, QUANT, TRIM_WS

S = with_sql(SALES_FACT_SQL)
DS = with_sql(DIRTY_SALES_SQL)
CO = with_sql(CONFIG_ORDERS_SQL)
_ORDERS_RULES = merged_processing(DEFAULT_RULES, "orders")


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _fmt_ts(df, *cols):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})


@register("c03_explore_filter", S + """
SELECT order_id, line_no, category, state, CAST(sales AS DOUBLE) AS sales FROM sales_fact
WHERE category IN ('ECONOMY', 'SMALL') AND state IN ('NATION_1', 'NATION_2', 'NATION_3') AND sales >= 10000""")
def c03(spark, d):
    out = C.explore(sales_fact(spark, d), ["ECONOMY", "SMALL"], ["NATION_1", "NATION_2", "NATION_3"], 10000)
    return out.select("order_id", "line_no", "category", "state", "sales")


@register("c04_coerce_numeric", DS + """
SELECT order_id, line_no, TRY_CAST(sales AS DOUBLE) AS sales, TRY_CAST(profit AS DOUBLE) AS profit,
       TRY_CAST(discount AS DOUBLE) AS discount, TRY_CAST(quantity AS DOUBLE) AS quantity
FROM dirty_sales""")
def c04(spark, d):
    return C.coerce_numeric(dirty_sales(spark, d)).select(
        "order_id", "line_no", "sales", "profit", "discount", "quantity")


@register("c05_coerce_dates", DS + f"""
SELECT order_id, line_no, {_ts('TRY_CAST(order_date AS TIMESTAMP)')} AS order_date,
       {_ts('TRY_CAST(ship_date AS TIMESTAMP)')} AS ship_date
FROM dirty_sales""")
def c05(spark, d):
    out = C.coerce_dates(dirty_sales(spark, d)).select("order_id", "line_no", "order_date", "ship_date")
    return _fmt_ts(out, "order_date", "ship_date")


@register("c06_dedup_rows", DS + "SELECT DISTINCT * FROM dirty_sales")
def c06(spark, d):
    return C.dedup_rows(dirty_sales(spark, d), reread=False)


@register("c07_trim_text", DS + f"""
SELECT order_id, line_no, {TRIM_WS('customer')} AS customer, {TRIM_WS('city')} AS city,
       {TRIM_WS('category')} AS category
FROM dirty_sales""")
def c07(spark, d):
    return C.trim_text(dirty_sales(spark, d)).select("order_id", "line_no", "customer", "city", "category")


_CO_COLS = ["order_id", "line_no", "customer_id", "customer_name", "customer_email", "customer_phone",
            "order_amount", "product_price", "order_date", "quantity", "product_category", "product_name",
            "discount_amount", "shipping_address"]


@register("c08_dedup_by_key", CO + """
SELECT * EXCLUDE (rn) REPLACE (CAST(discount_amount AS DOUBLE) AS discount_amount) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY """ + ", ".join(
    f"{c} ASC NULLS FIRST" for c in _CO_COLS if c != "order_id") + """) AS rn FROM config_orders)
WHERE rn = 1""")
def c08(spark, d):
    return C.dedup_by(config_orders(spark, d), _ORDERS_RULES["duplicate_subset"])


_CONST_RULES = {"customer_name": "Unknown", "customer_email": "Unknown",
                "shipping_address": "Unknown", "discount_amount": 0}


@register("c09_fill_constant", CO + """
SELECT order_id, line_no, COALESCE(customer_name, 'Unknown') AS customer_name,
       COALESCE(customer_email, 'Unknown') AS customer_email,
       COALESCE(shipping_address, 'Unknown') AS shipping_address,
       CAST(COALESCE(discount_amount, 0) AS DOUBLE) AS discount_amount
FROM config_orders""")
def c09(spark, d):
    out = C.fill_missing(config_orders(spark, d), _CONST_RULES)
    return out.select("order_id", "line_no", "customer_name", "customer_email", "shipping_address",
                      "discount_amount")


@register("c10_fill_mean", CO + """,
x AS (SELECT order_id, line_no, TRY_CAST(order_amount AS DECIMAL(18,4)) AS amt FROM config_orders),
m AS (SELECT CAST(CAST(SUM(amt) AS DOUBLE) / CAST(COUNT(amt) AS DOUBLE) AS DECIMAL(18,4)) AS mu FROM x)
SELECT order_id, line_no, CAST(COALESCE(amt, mu) AS DOUBLE) AS order_amount FROM x, m""")
def c10(spark, d):
    x = C.coerce_numeric(config_orders(spark, d), ["order_amount"], to="decimal(18,4)")
    return C.fill_missing(x, {"order_amount": "mean"}).select("order_id", "line_no", "order_amount")


@register("c11_fill_mode", CO + """,
m AS (SELECT product_category AS mo FROM config_orders WHERE product_category IS NOT NULL
      GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
SELECT order_id, line_no, COALESCE(product_category, (SELECT mo FROM m)) AS product_category
FROM config_orders""")
def c11(spark, d):
    out = C.fill_missing(config_orders(spark, d), {"product_category": "mode"})
    return out.select("order_id", "line_no", "product_category")


@register("c12_fill_drop", CO + """
SELECT order_id, line_no, order_date FROM config_orders WHERE order_date IS NOT NULL""")
def c12(spark, d):
    out = C.fill_missing(config_orders(spark, d), {"order_date": "drop"})
    return out.select("order_id", "line_no", "order_date")


@register("c13_fill_defaults", DS + f"""
SELECT order_id, line_no,
       {_ts("COALESCE(TRY_CAST(order_date AS TIMESTAMP), TIMESTAMP '2024-01-01 00:00:00')")} AS order_date,
       {_ts('TRY_CAST(ship_date AS TIMESTAMP)')} AS ship_date,
       COALESCE(customer, 'Unknown') AS customer, COALESCE(category, 'Unknown') AS category,
       COALESCE(subcategory, 'Unknown') AS subcategory, COALESCE(product_name, 'Unknown') AS product_name,
       COALESCE(region, 'Unknown') AS region, COALESCE(state, 'Unknown') AS state,
       COALESCE(city, 'Unknown') AS city,
       COALESCE(TRY_CAST(quantity AS DOUBLE), 1.0) AS quantity,
       COALESCE(TRY_CAST(discount AS DOUBLE), 0.0) AS discount,
       COALESCE(TRY_CAST(sales AS DOUBLE), 0.0) AS sales,
       COALESCE(TRY_CAST(profit AS DOUBLE), 0.0) AS profit
FROM dirty_sales""")
def c13(spark, d):
    x = C.coerce_dates(C.coerce_numeric(dirty_sales(spark, d)))
    return _fmt_ts(C.fill_defaults(x, today="2024-01-01"), "order_date", "ship_date")


@register("c14_cast_types", CO + f"""
SELECT order_id, line_no, {_ts('TRY_CAST(order_date AS TIMESTAMP)')} AS order_date,
       TRY_CAST(order_amount AS DOUBLE) AS order_amount, customer_id
FROM config_orders""")
def c14(spark, d):
    out = C.cast_types(config_orders(spark, d), DEFAULT_RULES["processing"]["data_types"])
    return _fmt_ts(out.select("order_id", "line_no", "order_date", "order_amount", "customer_id"), "order_date")


def _iqr_sql(col: str) -> str:
    return f"""
q_{col} AS (SELECT {QUANT('xs', 'n', 0.25)} AS q1, {QUANT('xs', 'n', 0.75)} AS q3
            FROM (SELECT list_sort(list(CAST({col} AS DOUBLE))) AS xs, COUNT({col}) AS n
                  FROM sales_fact WHERE {col} IS NOT NULL))"""


@register("c15_outliers_iqr", S + "," + _iqr_sql("sales") + "," + _iqr_sql("quantity") + """
SELECT order_id, line_no, CAST(sales AS DOUBLE) AS sales, quantity,
       COALESCE(CAST(sales AS DOUBLE) < s.q1 - 1.5 * (s.q3 - s.q1) OR CAST(sales AS DOUBLE) > s.q3 + 1.5 * (s.q3 - s.q1), false)
         AS sales_outlier,
       COALESCE(quantity < q.q1 - 1.5 * (q.q3 - q.q1) OR quantity > q.q3 + 1.5 * (q.q3 - q.q1), false)
         AS quantity_outlier
FROM sales_fact, q_sales s, q_quantity q""")
def c15(spark, d):
    out = C.outliers_iqr(sales_fact(spark, d), ["sales", "quantity"], action="flag")
    return out.select("order_id", "line_no", "sales", "quantity", "sales_outlier", "quantity_outlier")


@register("c16_outliers_zscore", S + """,
st AS (SELECT AVG(profit) AS mu, STDDEV_SAMP(CAST(profit AS DOUBLE)) AS sd FROM sales_fact)
SELECT order_id, line_no, CAST(profit AS DOUBLE) AS profit,
       COALESCE(abs(CAST(profit AS DOUBLE) - mu) / NULLIF(sd, 0) > 3.0, false) AS profit_outlier
FROM sales_fact, st""")
def c16(spark, d):
    out = C.outliers_zscore(sales_fact(spark, d), "profit", threshold=3.0)
    return out.select("order_id", "line_no", "profit", "profit_outlier")


_RANGE_RULES = {"sales": {"min": -1000000}, "quantity": {"min": 0}, "discount": {"max": 0.08}}


@register("c17_range_violations", DS + """,
x AS (SELECT order_id, line_no, TRY_CAST(sales AS DOUBLE) AS sales, TRY_CAST(quantity AS DOUBLE) AS quantity,
             TRY_CAST(discount AS DOUBLE) AS discount FROM dirty_sales)
SELECT order_id, line_no, 'sales' AS "column", 'min' AS rule, -1000000.0 AS bound, sales AS value
FROM x WHERE sales < -1000000.0
UNION ALL
SELECT order_id, line_no, 'quantity', 'min', 0.0, quantity FROM x WHERE quantity < 0.0
UNION ALL
SELECT order_id, line_no, 'discount', 'max', 0.08, discount FROM x WHERE discount > 0.08""")
def c17(spark, d):
    x = C.coerce_numeric(dirty_sales(spark, d))
    return C.range_violations(x, _RANGE_RULES, key=["order_id", "line_no"])


_EMAIL = f"lower({TRIM_WS('customer_email')})"


@register("c18_std_email", CO + f"""
SELECT order_id, line_no,
       CASE WHEN regexp_matches({_EMAIL}, '{C.EMAIL_PATTERN}') THEN {_EMAIL} END AS customer_email
FROM config_orders""")
def c18(spark, d):
    return C.std_email(config_orders(spark, d), ["customer_email"]).select("order_id", "line_no", "customer_email")


_PH = TRIM_WS("customer_phone")
_DIG = f"regexp_replace({_PH}, '[^0-9]', '', 'g')"


@register("c19_std_phone", CO + f"""
SELECT order_id, line_no,
       CASE WHEN length({_DIG}) > 0 THEN (CASE WHEN starts_with({_PH}, '+') THEN '+' ELSE '' END) || {_DIG} END
         AS customer_phone
FROM config_orders""")
def c19(spark, d):
    return C.std_phone(config_orders(spark, d), ["customer_phone"]).select("order_id", "line_no", "customer_phone")


def _cur_sql(c: str) -> str:
    num = f"TRY_CAST(regexp_replace(CAST({c} AS VARCHAR), '[^0-9.\\-]', '', 'g') AS DECIMAL(18,2))"
    return (f"CAST(CASE WHEN regexp_matches(CAST({c} AS VARCHAR), '^\\s*\\(.*\\)\\s*$') THEN -{num} "
            f"ELSE {num} END AS DOUBLE)")


@register("c20_std_currency", CO + f"""
SELECT order_id, line_no, {_cur_sql('product_price')} AS product_price, {_cur_sql('order_amount')} AS order_amount
FROM config_orders""")
def c20(spark, d):
    out = C.std_currency(config_orders(spark, d), ["product_price", "order_amount"])
    return out.select("order_id", "line_no", "product_price", "order_amount")


def _initcap_sql(c: str) -> str:
    s = TRIM_WS(f"regexp_replace({c}, '\\s+', ' ', 'g')")
    return (f"array_to_string(list_transform(string_split(lower({s}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


@register("c21_std_text", CO + f"""
SELECT order_id, line_no, {_initcap_sql('customer_name')} AS customer_name,
       {_initcap_sql('product_name')} AS product_name
FROM config_orders""")
def c21(spark, d):
    out = C.std_text(config_orders(spark, d), ["customer_name", "product_name"])
    return out.select("order_id", "line_no", "customer_name", "product_name")


@register("p01_select_columns", S + """
SELECT category, region, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, quantity FROM sales_fact""")
def p01(spark, d):
    return P.select_columns(sales_fact(spark, d), ["category", "region", "sales", "profit", "quantity"])


@register("p07_derived_columns", CO + """,
t AS (SELECT order_id, line_no, TRY_CAST(order_date AS TIMESTAMP) AS order_date,
             TRY_CAST(order_amount AS DOUBLE) AS order_amount FROM config_orders
      WHERE TRY_CAST(order_date AS TIMESTAMP) IS NOT NULL AND TRY_CAST(order_amount AS DOUBLE) IS NOT NULL)
SELECT order_id, line_no, 'ecommerce_pipeline' AS data_source,
       CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
       order_amount > 1000 AS high_value_order,
       CASE WHEN order_amount > 500 THEN 'premium' ELSE 'standard' END AS customer_segment
FROM t""")
def p07(spark, d):
    x = C.cast_types(config_orders(spark, d), DEFAULT_RULES["processing"]["data_types"])
    # rows whose date and amount parsed (the rule set drops undated rows)
    x = x.where(F.col("order_date").isNotNull() & F.col("order_amount").isNotNull())
    out = P.add_derived(x, DEFAULT_RULES["processing"]["derived_columns"], now_col=False)
    return out.select("order_id", "line_no", "data_source", "order_year", "order_month",
                      "high_value_order", "customer_segment")


@register("p08_row_margin", S + f"""
SELECT order_id, line_no, COALESCE({PCT('profit', 'sales')}, 0.0) AS profit_margin FROM sales_fact""")
def p08(spark, d):
    return P.row_margin(sales_fact(spark, d)).select("order_id", "line_no", "profit_margin")


@register("p09_calendar_columns", S + """
SELECT order_id, line_no, dayname(order_date) AS day_of_week, CAST(weekofyear(order_date) AS INTEGER) AS week_num,
       monthname(order_date) AS month_name
FROM sales_fact""")
def p09(spark, d):
    return P.add_calendar(sales_fact(spark, d)).select("order_id", "line_no", "day_of_week", "week_num",
                                                       "month_name")


@register("p10_format_kpis", S + f""",
k AS (SELECT {FS('sales')} AS total_sales, {FS('profit')} AS total_profit, COUNT(*) AS total_orders,
             {FS('profit')} / NULLIF({FS('sales')}, 0) * 100.0 AS profit_margin FROM sales_fact)
SELECT '$' || format('{{:,.2f}}', total_sales) AS total_sales, '$' || format('{{:,.2f}}', total_profit) AS total_profit,
       format('{{:,}}', total_orders) AS total_orders, format('{{:,.1f}}', profit_margin) || '%' AS profit_margin
FROM k""")
def p10(spark, d):
    return P.format_kpis(G.sales_kpis(sales_fact(spark, d)))


@register("p12_recent_orders", with_sql(ORDERS_FACT_SQL) + """
SELECT increment_id, category_name_1, CAST(grand_total AS DOUBLE) AS grand_total, status
FROM orders_fact ORDER BY created_at DESC NULLS LAST, item_id, category_name_1, grand_total, status LIMIT 10""")
def p12(spark, d):
    return P.recent_orders(orders_fact(spark, d), 10)


_C22_NUM = "TRY_CAST({c} AS DOUBLE)"


def _currency_sql(c: str) -> str:
    num = f"TRY_CAST(regexp_replace({c}, '[^0-9.\\-]', '', 'g') AS DECIMAL(18,2))"
    return f"CAST(CASE WHEN regexp_matches({c}, '^\\s*\\(.*\\)\\s*$') THEN -{num} ELSE {num} END AS DECIMAL(18,2))"


def _c22_sql() -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in _CO_COLS if c != "order_id")
    email = f"lower({TRIM_WS('customer_email')})"
    ph = TRIM_WS("customer_phone")
    dig = f"regexp_replace({ph}, '[^0-9]', '', 'g')"
    return CO + f""",
d AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) AS rn FROM config_orders)
      WHERE rn = 1),
s AS (SELECT * REPLACE (
          CASE WHEN regexp_matches({email}, '{C.EMAIL_PATTERN}') THEN {email} END AS customer_email,
          CASE WHEN length({dig}) > 0 THEN (CASE WHEN starts_with({ph}, '+') THEN '+' ELSE '' END) || {dig} END
            AS customer_phone,
          {_currency_sql('order_amount')} AS order_amount, {_currency_sql('product_price')} AS product_price,
          {_initcap_sql('customer_name')} AS customer_name,
          {_initcap_sql('product_name')} AS product_name)
      FROM d),
t AS (SELECT * REPLACE (TRY_CAST(order_date AS TIMESTAMP) AS order_date,
                        CAST(order_amount AS DECIMAL(18,4)) AS order_amount) FROM s),
st AS (SELECT CAST(CAST(SUM(order_amount) AS DOUBLE) / CAST(COUNT(order_amount) AS DOUBLE) AS DECIMAL(18,4)) AS mu FROM t),
mo AS (SELECT product_category AS mo FROM t WHERE product_category IS NOT NULL
       GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
f AS (SELECT order_id, line_no, customer_id, COALESCE(customer_name, 'Unknown') AS customer_name,
             COALESCE(customer_email, 'Unknown') AS customer_email, customer_phone,
             COALESCE(order_amount, (SELECT mu FROM st)) AS order_amount,
             product_price, order_date, quantity,
             COALESCE(product_category, (SELECT mo FROM mo)) AS product_category, product_name,
             COALESCE(discount_amount, 0) AS discount_amount,
             COALESCE(shipping_address, 'Unknown') AS shipping_address
      FROM t WHERE order_date IS NOT NULL),
qa AS (SELECT quantile_cont(CAST(order_amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(order_amount AS DOUBLE), 0.75) AS q3 FROM f),
qq AS (SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(quantity AS DOUBLE), 0.75) AS q3 FROM f),
o AS (SELECT f.*,
             COALESCE(CAST(order_amount AS DOUBLE) < qa.q1 - 1.5 * (qa.q3 - qa.q1)
                      OR CAST(order_amount AS DOUBLE) > qa.q3 + 1.5 * (qa.q3 - qa.q1), false) AS order_amount_outlier,
             COALESCE(quantity < qq.q1 - 1.5 * (qq.q3 - qq.q1) OR quantity > qq.q3 + 1.5 * (qq.q3 - qq.q1), false)
               AS quantity_outlier
      FROM f, qa, qq)
SELECT order_id, line_no, customer_id, customer_name, customer_email, customer_phone,
       CAST(order_amount AS DOUBLE) AS order_amount, CAST(product_price AS DOUBLE) AS product_price,
       {_ts('order_date')} AS order_date, quantity, product_category, product_name,
       CAST(discount_amount AS DOUBLE) AS discount_amount, shipping_address,
       order_amount_outlier, quantity_outlier, 'ecommerce_pipeline' AS data_source,
       CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
       order_amount > 1000 AS high_value_order,
       CASE WHEN order_amount > 500 THEN 'premium' ELSE 'standard' END AS customer_segment
FROM o"""


@register("c22_clean_rules", _c22_sql())
def c22(spark, d):
    from ..operators.rules import clean
    out = clean(config_orders(spark, d), DEFAULT_RULES, "orders", numeric_type="decimal(18,4)",
                timestamp_col=False)
    return _fmt_ts(out, "order_date")
