"""Queries over odd values: voted layouts and decimal marks, NaN, infinity, constants.

The texts are written here from the sales rows, so the SQL twins know the value
behind each text and never parse one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import quality as Q
from ..operators import sales as G
from ..operators import shape as P
from ..session import cut_lineage
from .fixtures import SALES_FACT_SQL, sales_fact, with_sql
from .registry import register

S = with_sql(SALES_FACT_SQL)


# ------------------------------------------------------------------ dates as text
_LAYOUTS = ["us_date", "eu_date", "named_date"]


def date_texts(spark, d):
    """Order dates as text: month-first with ISO between, day-first with three
    separators and two- and four-digit years, named months, year-first and eight
    digits; 'not a date' where the order id divides by 31, NULL by 29."""
    k = F.col("order_id")
    as_text = lambda layout: F.date_format("order_date", layout)
    bad = lambda c: F.when(k % 31 == 0, "not a date").when(k % 29 == 0, F.lit(None)).otherwise(c)
    us = F.when(k % 4 == 0, as_text("yyyy-MM-dd")).when(k % 4 == 1, as_text("M/d/yyyy H:mm")).otherwise(as_text("MM/dd/yyyy"))
    eu = (F.when(k % 4 == 0, as_text("d.M.yyyy")).when(k % 4 == 1, as_text("dd-MM-yyyy"))
           .when(k % 4 == 2, as_text("d/M/yy")).otherwise(as_text("dd/MM/yyyy HH:mm:ss")))
    named = (F.when(k % 5 == 0, as_text("MMM d, yyyy")).when(k % 5 == 1, as_text("dd-MMM-yyyy"))
              .when(k % 5 == 2, as_text("yyyyMMdd")).when(k % 5 == 3, as_text("yyyy/MM/dd")).otherwise(as_text("d MMMM yyyy")))
    return sales_fact(spark, d).select("order_id", "line_no", *[bad(c).alias(n) for n, c in zip(_LAYOUTS, (us, eu, named))])


_GOOD = "order_id % 31 <> 0 AND order_id % 29 <> 0"
_TRUE_DATE = f"CASE WHEN {_GOOD} THEN strftime(order_date, '%Y-%m-%d 00:00:00') END"


def _formatted(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in _LAYOUTS})


@register("c05_voted_date_layouts", S + f"""
SELECT order_id, line_no, {', '.join(f'{_TRUE_DATE} AS {c}' for c in _LAYOUTS)} FROM sales_fact""")
def c05_voted(spark, d):
    return _formatted(C.coerce_dates(date_texts(spark, d), _LAYOUTS))


@register("c14_voted_date_types", S + f"""
SELECT order_id, CAST(line_no AS VARCHAR) AS line_no, {', '.join(f'{_TRUE_DATE} AS {c}' for c in _LAYOUTS)} FROM sales_fact""")
def c14_voted(spark, d):
    rules = {c: "datetime" for c in _LAYOUTS} | {"line_no": "string"}
    return _formatted(C.cast_types(date_texts(spark, d), rules))


@register("g16_voted_date_range", S + f"""
SELECT strftime(MIN(order_date), '%Y-%m-%d') || ' to ' || strftime(MAX(order_date), '%Y-%m-%d') AS date_range
FROM sales_fact WHERE {_GOOD}""")
def g16_voted(spark, d):
    return G.date_range(date_texts(spark, d), "eu_date")


# ------------------------------------------------------------------ amounts as text
def amount_texts(spark, d):
    """Money as text. us: '$1,234.50', negative in brackets; eu: '1.234,50 EUR', whole
    thousands ('1.234') among them, minus behind; science: '12e3'. 'n/a' where the
    order id divides by 19."""
    k = F.col("order_id")
    cents, whole = F.format_number(F.abs("profit").cast("decimal(18,2)"), 2), F.format_number(F.floor(F.abs("profit")), 0)
    european = lambda c: F.translate(c, ",.", ".,")
    loss = F.col("profit") < 0
    us = F.when(loss, F.concat(F.lit("($"), cents, F.lit(")"))).otherwise(F.concat(F.lit("$ "), cents))
    eu = european(F.when(k % 3 == 0, whole).otherwise(cents))
    eu = F.concat(eu, F.when(loss, F.lit("-")).otherwise(F.lit(" EUR")))
    science = F.concat(F.floor("quantity").cast("string"), F.when(k % 2 == 0, F.lit("e3")).otherwise(F.lit(".5E+2")))
    return sales_fact(spark, d).select("order_id", "line_no", *[
        F.when(k % 19 == 0, "n/a").otherwise(c).alias(n) for n, c in (("us", us), ("eu", eu), ("science", science))])


@register("c20_voted_amounts", S + """,
x AS (SELECT order_id, line_no, profit < 0 AS loss, CAST(abs(profit) AS DECIMAL(18,2)) AS cents, floor(abs(profit)) AS whole,
             floor(quantity) AS q FROM sales_fact)
SELECT order_id, line_no,
       CASE WHEN order_id % 19 = 0 THEN NULL ELSE CAST(CASE WHEN loss THEN -cents ELSE cents END AS DOUBLE) END AS us,
       CASE WHEN order_id % 19 = 0 THEN NULL WHEN order_id % 3 = 0 THEN CAST(CASE WHEN loss THEN -whole ELSE whole END AS DOUBLE)
            ELSE CAST(CASE WHEN loss THEN -cents ELSE cents END AS DOUBLE) END AS eu,
       CASE WHEN order_id % 19 = 0 THEN NULL WHEN order_id % 2 = 0 THEN q * 1000.0 ELSE (q + 0.5) * 100.0 END AS science
FROM x""")
def c20_voted(spark, d):
    return C.std_currency(amount_texts(spark, d), ["us", "eu", "science"])


# ------------------------------------------------------------------ NaN, infinity, constants
def odd_sales(spark, d):
    """Sales rows in double, NaN profit on % 17, NaN sales on % 19, infinite sales on
    % 101, text that is no number in ``noted`` on % 13, a constant column."""
    k = F.col("order_id")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    money = lambda c: F.col(c).cast("double")
    return sales_fact(spark, d).select(
        "order_id", "line_no", "state", "customer", F.when(k % 17 == 0, nan).otherwise(money("profit")).alias("profit"),
        F.when(k % 19 == 0, nan).when(k % 101 == 0, inf).otherwise(money("sales")).alias("sales"),
        F.when(k % 13 == 0, "none").otherwise(F.col("quantity").cast("string")).alias("noted"), F.lit(7.0).alias("fixed"))


O = S.rstrip() + """,
odd AS (SELECT order_id, line_no, state, customer, CASE WHEN order_id % 17 <> 0 THEN CAST(profit AS DOUBLE) END AS profit,
               CASE WHEN order_id % 19 <> 0 AND order_id % 101 <> 0 THEN CAST(sales AS DOUBLE) END AS sales,
               order_id % 19 <> 0 AND order_id % 101 = 0 AS endless,
               CASE WHEN order_id % 13 <> 0 THEN quantity END AS noted FROM sales_fact)
"""


@register("g37_correlation_odd_values", O + """
SELECT COUNT(*) AS n, ROUND(corr(sales, profit), 9) AS correlation, CAST(NULL AS DOUBLE) AS with_constant
FROM odd WHERE sales IS NOT NULL AND profit IS NOT NULL""")
def g37_odd(spark, d):
    x = odd_sales(spark, d)
    fixed = G.correlation(x, "sales", "fixed").select(F.col("correlation").alias("with_constant"))
    return G.with_stats(G.correlation(x), fixed).withColumn("correlation", F.round("correlation", 9))


@register("g46_state_correlation_equal_sales", S + """,
t AS (SELECT state, CAST(SUM(profit) AS DOUBLE) AS profit, CAST(COUNT(DISTINCT customer) AS DOUBLE) AS customer
      FROM sales_fact GROUP BY state ORDER BY state LIMIT 15),
r AS (SELECT ROUND(corr(profit, customer), 9) AS c, ROUND(corr(profit, profit), 9) AS pp, ROUND(corr(customer, customer), 9) AS cc FROM t)
SELECT a.v AS var_x, b.v AS var_y, CASE WHEN a.v = 'sales' OR b.v = 'sales' THEN NULL WHEN a.v <> b.v THEN c
       WHEN a.v = 'profit' THEN pp ELSE cc END AS correlation
FROM r, (VALUES ('sales'), ('profit'), ('customer')) a(v), (VALUES ('sales'), ('profit'), ('customer')) b(v)""")
def g46_equal(spark, d):
    """All states sell the same: nothing correlates with a constant."""
    x = sales_fact(spark, d).withColumn("sales", F.lit(0).cast("decimal(18,4)"))
    return G.state_correlation(x, 15).withColumn("correlation", F.round("correlation", 9))


@register("c15_outliers_odd_values", O + """,
f AS (SELECT quantile_cont(profit, 0.25) AS q1, quantile_cont(profit, 0.75) AS q3 FROM odd),
g AS (SELECT quantile_cont(noted, 0.25) AS q1, quantile_cont(noted, 0.75) AS q3 FROM odd)
SELECT order_id, line_no, COALESCE(profit < f.q1 - 1.5 * (f.q3 - f.q1) OR profit > f.q3 + 1.5 * (f.q3 - f.q1), false) AS profit_outlier,
       COALESCE(noted < g.q1 - 1.5 * (g.q3 - g.q1) OR noted > g.q3 + 1.5 * (g.q3 - g.q1), false) AS noted_outlier
FROM odd, f, g""")
def c15_odd(spark, d):
    # read for the fences and for the flags: the columns in use are stored between
    x = cut_lineage(odd_sales(spark, d).select("order_id", "line_no", "profit", "noted"))
    out = C.outliers_iqr(x, ["profit", "noted"], action="flag")
    return out.select("order_id", "line_no", "profit_outlier", "noted_outlier")


@register("c16_zscore_odd_values", O + """,
st AS (SELECT AVG(sales) AS ms, STDDEV_SAMP(sales) AS ss, AVG(noted) AS mn, STDDEV_SAMP(noted) AS sn FROM odd)
SELECT order_id, line_no, endless OR COALESCE(abs(sales - ms) / ss > 2.0, false) AS sales_outlier,
       COALESCE(abs(noted - mn) / sn > 1.5, false) AS noted_outlier, false AS fixed_outlier FROM odd, st""")
def c16_odd(spark, d):
    x = C.outliers_zscore(C.outliers_zscore(odd_sales(spark, d), "sales", 2.0), "noted", 1.5)
    return C.outliers_zscore(x, "fixed", 1.0).select("order_id", "line_no", "sales_outlier", "noted_outlier", "fixed_outlier")


@register("c17_ranges_odd_values", O + """
SELECT order_id, line_no, 'profit' AS "column", 'max' AS rule, 5000.0 AS bound, profit AS value FROM odd WHERE profit > 5000
UNION ALL SELECT order_id, line_no, 'noted', 'min', 10.0, noted FROM odd WHERE noted < 10""")
def c17_odd(spark, d):
    return C.range_violations(odd_sales(spark, d), {"profit": {"max": 5000}, "noted": {"min": 10}}, key=["order_id", "line_no"])


@register("p08_margin_odd_values", O + """
SELECT order_id, line_no, COALESCE(profit / NULLIF(sales, 0) * 100.0, 0.0) AS profit_margin FROM odd""")
def p08_odd(spark, d):
    return P.row_margin(odd_sales(spark, d)).select("order_id", "line_no", "profit_margin")


@register("q04_nulls_odd_values", O + """
SELECT 'null_threshold' AS "check", 'odd.profit' AS subject, CAST(COUNT(*) - COUNT(profit) AS DOUBLE) * 100.0 / COUNT(*) AS value,
       5.0 AS threshold, CAST(COUNT(*) - COUNT(profit) AS DOUBLE) * 100.0 / COUNT(*) <= 5.0 AS passed FROM odd""")
def q04_odd(spark, d):
    return Q.check_null_thresholds(odd_sales(spark, d), {"profit": 5.0}, "odd")


@register("q01_score_odd_values", O + """
SELECT COUNT(*) AS record_count, COUNT(*) - COUNT(profit) AS null_profit,
       100 - 10 * (COUNT(*) - COUNT(profit)) AS quality_score, 100 - 10 * (COUNT(*) - COUNT(profit)) >= 90 AS passed FROM odd""")
def q01_odd(spark, d):
    return Q.quality_score(odd_sales(spark, d), ["profit"])


@register("g32_histogram_odd_values", O + """
SELECT COUNT(sales) AS rows, ROUND(MIN(sales), 6) AS lowest, ROUND(MAX(sales), 6) AS highest, ROUND(AVG(sales), 6) AS mean FROM odd""")
def g32_odd(spark, d):
    """Edges, mean and row count of the bins: finite values only."""
    h = G.histogram(odd_sales(spark, d), "sales", 10)
    return h.agg(F.sum("count").alias("rows"), F.round(F.min("bin_lo"), 6).alias("lowest"), F.round(F.max("bin_hi"), 6).alias("highest"),
                 F.round(F.max("mean"), 6).alias("mean"))
