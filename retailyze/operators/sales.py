"""Sales analytics over the canonical sales table.

pandas-origin semantics (see the operator notes): grouping drops NULL keys,
empty sums are 0, NaN/inf are treated as missing where the original did so,
top-k lists are tie-broken by the key. Every statistic that needs a global
value (a total, a max, a quantile) gets it from a one-row aggregate attached
as a scalar subquery (computed once, a constant in the plan) - never by
collecting to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fsum, mean, month_key, nan_missing, pct, with_stats
from ..functions.layouts import parse_dates
from ..functions.ordered import quantiles, quantiles_of, ranked_values
from ..functions.rowhash import counted_rows, repeated_row_count
from ..functions.roles import detect_roles
from ..session import cut_lineage



def _all() -> Window:
    """The whole (already aggregated, small) table as one window."""
    return Window.partitionBy()


def _one_row_join(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a single-row statistics table to every row (scalar subquery)."""
    return with_stats(df, stats)


def _nn(df: DataFrame, *keys: str) -> DataFrame:
    """pandas groupby drops NULL keys."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def _num(df: DataFrame, c: str) -> Column:
    """Numeric view of a column: exact types stay exact; text is coerced; NaN
    and +-inf count as 0 (the reference's safe conversion)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DecimalType, T.IntegralType)):
        return F.col(c)
    x = F.col(c).try_cast("double") if isinstance(dt, T.StringType) else F.col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(0.0)).otherwise(x)


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def round_half_up(c: Column, d: int = 2) -> Column:
    """Round half up on the double value; identical in every IEEE engine."""
    s = float(10 ** d)
    return F.floor(c.cast("double") * s + F.lit(0.5)) / F.lit(s)


# --------------------------------------------------------------------- KPIs
def sales_kpis(df: DataFrame, sales: str = "sales", profit: str = "profit") -> DataFrame:
    """Total sales, total profit, rows, margin % (NULL when sales sum to 0).
    Infinite values count as 0, as NaN does."""
    return df.agg(fsum(_num(df, sales)).alias("total_sales"), fsum(_num(df, profit)).alias("total_profit"),
                  F.count(F.lit(1)).alias("total_orders")).withColumn(
        "profit_margin", pct("total_profit", "total_sales"))


def top_by_count(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """``value_counts().head(k)``: most frequent non-NULL keys."""
    return (_nn(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(key)).limit(k))


def monthly_sales_prefix(df: DataFrame, date: str = "order_date", sales: str = "sales",
                         k: int | None = None) -> DataFrame:
    """Sales by the first 7 characters of the date text, every month (the
    first ``k`` keys only if ``k`` is given)."""
    key = F.substring(F.col(date).cast("string"), 1, 7)
    g = df.where(F.col(date).isNotNull()).groupBy(key.alias("month")).agg(fsum(sales).alias("sales"))
    return g if k is None else g.orderBy("month").limit(k)


def sum_by(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """``groupby(key)[value].sum()``."""
    return _nn(df, key).groupBy(key).agg(fsum(value).alias(out or value))


def top_rows(df: DataFrame, k: int = 10, by: str = "sales",
             cols: Sequence[str] = ("product_name", "sales", "profit"),
             tie: Sequence[str] = ()) -> DataFrame:
    """``nlargest(k, by)`` - k rows with the largest value (TakeOrdered)."""
    order = [F.desc_nulls_last(by)] + [F.asc(c) for c in (tie or cols)]
    return df.select(*dict.fromkeys([*cols, *tie])).orderBy(*order).limit(k).select(*cols)


def order_analytics(df: DataFrame, price: str = "price", customer: str = "customer_id",
                    category: str = "category_name_1", k: int = 5) -> DataFrame:
    """Rows, sum(price), distinct customers + the top-k categories by
    count; one output row per top category, KPI columns repeated."""
    kpi = df.agg(F.count(F.lit(1)).alias("total_orders"), fsum(price).alias("total_revenue"),
                 F.countDistinct(customer).alias("unique_customers"))
    top = top_by_count(df, category, k)
    top = top.withColumn("category_rank", F.row_number().over(
        Window.orderBy(F.desc("count"), F.asc(category))))
    return _one_row_join(top, kpi).select(
        "total_orders", "total_revenue", "unique_customers",
        F.col(category).alias("category"), F.col("count").alias("category_count"), "category_rank")


def revenue_by_category(df: DataFrame, k: int = 10, key: str = "category_name_1",
                        value: str = "grand_total") -> DataFrame:
    """Top-k categories by revenue."""
    return (sum_by(df, key, value, "revenue")
            .orderBy(F.desc("revenue"), F.asc(key)).limit(k))


def revenue_by_month(df: DataFrame, month: str = "month", value: str = "grand_total") -> DataFrame:
    """Revenue per month column."""
    return sum_by(df, month, value, "revenue")


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-NULL value."""
    return _nn(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def value_share(df: DataFrame, key: str) -> DataFrame:
    """Counts with their share of all counted rows, in %."""
    vc = value_counts(df, key)
    tot = vc.agg(F.sum("count").alias("_total"))  # one row: a scalar subquery
    return with_stats(vc, tot).select(key, "count", pct(F.col("count"), F.col("_total")).alias("share_pct"))


def order_kpis(df: DataFrame, value: str = "grand_total", category: str = "category_name_1") -> DataFrame:
    """Rows, revenue, average, distinct categories."""
    return df.agg(F.count(F.lit(1)).alias("total_orders"), fsum(value).alias("total_revenue"),
                  mean(value).alias("avg_order_value"),
                  F.countDistinct(category).alias("categories"))


# ---------------------------------------------------------------- insights
def insights(df: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """One row - sums of sales and profit (NaN or infinite -> 0), rows,
    average order value and margin % (0 when sales <= 0)."""
    roles = dict(roles or detect_roles(df))
    s, p = roles.get("sales"), roles.get("profit")
    zero = F.lit(0)
    agg = [F.count(F.lit(1)).alias("total_orders")]
    agg.append(fsum(_num(df, s)).alias("_s") if s else zero.alias("_s"))
    agg.append(fsum(_num(df, p)).alias("_p") if p else zero.alias("_p"))
    a = df.agg(*agg)

    def guard(c):
        return F.when(F.abs(_dbl(c)) < F.lit(float("inf")), _dbl(c)).otherwise(F.lit(0.0))
    a = a.select("total_orders", guard("_s").alias("total_sales"), guard("_p").alias("total_profit"))
    return a.select(
        "total_sales", "total_profit", "total_orders",
        F.when((F.col("total_orders") > 0) & (F.col("total_sales") > 0),
               F.col("total_sales") / F.col("total_orders")).otherwise(F.lit(0.0)).alias("avg_order_value"),
        F.when(F.col("total_sales") > 0, F.col("total_profit") / F.col("total_sales") * 100.0)
         .otherwise(F.lit(0.0)).alias("profit_margin"))


def date_range(df: DataFrame, date: str = "order_date") -> DataFrame:
    """G16: 'YYYY-MM-DD to YYYY-MM-DD' of the valid dates, else a fixed text. Text
    dates are read by the column's voted layout."""
    if isinstance(df.schema[date].dataType, T.StringType):
        df = parse_dates(df.select(date), [date])
    d = F.col(date)
    a = df.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    return a.select(F.when(F.col("_lo").isNull(), F.lit("No valid dates available")).otherwise(
        F.concat(F.date_format("_lo", "yyyy-MM-dd"), F.lit(" to "),
                 F.date_format("_hi", "yyyy-MM-dd"))).alias("date_range"))


def monthly_growth(df: DataFrame, date: str = "order_date", sales: str = "sales") -> DataFrame:
    """First-to-last month growth %; 0 with one month or first <= 0."""
    m = (df.where(F.col(date).isNotNull())
           .groupBy(month_key(date).alias("m")).agg(fsum(_num(df, sales)).alias("s")))
    a = m.agg(F.count(F.lit(1)).alias("months"), F.min_by("s", "m").alias("first"),
              F.max_by("s", "m").alias("last"))
    g = F.when((F.col("months") > 1) & (F.col("first") > 0),
               _dbl(F.col("last") - F.col("first")) / _dbl("first") * 100.0).otherwise(F.lit(0.0))
    return a.select("months", _dbl("first").alias("first_month_sales"),
                    _dbl("last").alias("last_month_sales"), g.alias("monthly_growth"))


def top_contributor(df: DataFrame, key: str, sales: str = "sales") -> DataFrame:
    """The key with the largest sales and its % of all sales
    ('N/A' and 0 when the largest is <= 0)."""
    total = df.agg(fsum(_num(df, sales)).alias("_tot"))
    per = _nn(df, key).groupBy(key).agg(fsum(_num(df, sales)).alias("_s"))
    top = per.agg(F.max_by(F.col(key), F.struct(F.col("_s"), F.col(key))).alias("_k"),
                  F.max("_s").alias("_top"))
    j = _one_row_join(top, total)
    ok = F.col("_top") > 0
    return j.select(
        F.lit(key).alias("key_column"),
        F.when(ok, F.col("_k").cast("string")).otherwise(F.lit("N/A")).alias("top_value"),
        _dbl("_top").alias("top_sales"),
        F.when(ok & (F.col("_tot") > 0), _dbl("_top") / _dbl("_tot") * 100.0)
         .otherwise(F.lit(0.0)).alias("contribution_pct"))


# ------------------------------------------------------- chart data tables
def sales_by_category(df: DataFrame, category: str = "category", sales: str = "sales") -> DataFrame:
    """Category sales, descending."""
    return sum_by(df, category, sales).orderBy(F.desc(sales), F.asc(category))


def top_regions_share(df: DataFrame, k: int = 10, region: str = "region",
                      sales: str = "sales") -> DataFrame:
    """Top-k regions by sales and each one's share of those k, in %."""
    top = sum_by(df, region, sales).orderBy(F.desc(sales), F.asc(region)).limit(k)
    return top.withColumn("share_pct", pct(F.col(sales), F.sum(sales).over(_all())))


def profitability(df: DataFrame, category: str = "category", sales: str = "sales",
                  profit: str = "profit") -> DataFrame:
    """Per category sums, margin %, and a bubble size that is the margin
    shifted positive (+|min|+1) when any margin is negative."""
    g = _nn(df, category).groupBy(category).agg(fsum(sales).alias("sales"), fsum(profit).alias("profit"))
    g = g.withColumn("profit_margin", pct("profit", "sales"))
    g = with_stats(g, g.agg(F.min("profit_margin").alias("_mn")))
    mn = F.col("_mn")
    return g.select(category, "sales", "profit", "profit_margin",
                    F.when(mn < 0, F.col("profit_margin") + F.abs(mn) + 1.0)
                     .otherwise(F.col("profit_margin")).alias("bubble_size"))


def _edge_bins(x: Column, lo: Column, width: Column, bins: int) -> Column:
    """1-based right-closed bin: 1 + #{j in 1..bins-1 : x > lo + j * width}."""
    b = F.lit(1)
    for j in range(1, bins):
        b = b + F.when(x > F.lit(float(j)) * width + lo, 1).otherwise(0)
    return b


def discount_impact(df: DataFrame, bins: int = 10, discount: str = "discount",
                    profit: str = "profit", sales: str = "sales") -> DataFrame:
    """Mean profit and row count in ``bins`` equal-width discount bins.

    Right-closed bins over [min, max] with the first edge lowered by 0.1 % of
    the range (pandas ``cut``); empty bins are present with count 0. No rows
    when the discount column is constant or empty.
    """
    x = _dbl(discount)
    st = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx")).where(F.col("_mx") > F.col("_mn"))
    st = st.withColumn("_w", (F.col("_mx") - F.col("_mn")) / float(bins))
    rows = _one_row_join(df.where(x.isNotNull()), st).withColumn(
        "bin", _edge_bins(x, F.col("_mn"), F.col("_w"), bins))
    agg = rows.groupBy("bin").agg(mean(profit).alias("avg_profit"),
                                  F.count(F.col(sales)).alias("rows"))
    spine = st.select("_mn", "_mx", "_w", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = spine.join(agg, "bin", "left")
    lo_edge = F.when(F.col("bin") == 1, F.col("_mn") - (F.col("_mx") - F.col("_mn")) * 0.001).otherwise(
        (F.col("bin") - 1).cast("double") * F.col("_w") + F.col("_mn"))
    hi_edge = F.when(F.col("bin") == bins, F.col("_mx")).otherwise(
        F.col("bin").cast("double") * F.col("_w") + F.col("_mn"))
    return out.select("bin", lo_edge.alias("bin_lo"), hi_edge.alias("bin_hi"), "avg_profit",
                      F.coalesce(F.col("rows"), F.lit(0).cast("bigint")).alias("rows"))


def daily_sales(df: DataFrame, date: str = "order_date", sales: str = "sales") -> DataFrame:
    """Sales per calendar day."""
    return (df.where(F.col(date).isNotNull())
              .groupBy(F.date_format(F.to_date(date), "yyyy-MM-dd").alias("day"))
              .agg(fsum(sales).alias("sales")))


def monthly_summary(df: DataFrame, date: str = "order_date", sales: str = "sales",
                    profit: str = "profit", order_id: str = "order_id") -> DataFrame:
    """Sales, profit and order-id count per month."""
    return (df.where(F.col(date).isNotNull())
              .groupBy(month_key(date).alias("month"))
              .agg(fsum(sales).alias("sales"), fsum(profit).alias("profit"),
                   F.count(order_id).alias("orders")))


def segment_summary(df: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """Per category: sum of sales and, where those roles exist, of profit and quantity."""
    roles = dict(roles or detect_roles(df))
    cat = roles["category"]
    aggs = [fsum(roles["sales"]).alias("sales")]
    if roles.get("profit"):
        aggs.append(fsum(roles["profit"]).alias("profit"))
    if roles.get("quantity"):
        aggs.append(fsum(roles["quantity"]).alias("quantity"))
    return _nn(df, cat).groupBy(F.col(cat).alias("segment")).agg(*aggs)


def top_products(df: DataFrame, roles: Mapping[str, str] | None = None, k: int = 15) -> DataFrame:
    """Top-k products (else categories) by profit (else sales)."""
    roles = dict(roles or detect_roles(df))
    key = roles.get("product") or roles.get("category")
    val = roles.get("profit") or roles.get("sales")
    g = _nn(df, key).groupBy(F.col(key).alias("item")).agg(fsum(val).alias("value"))
    return g.orderBy(F.desc("value"), F.asc("item")).limit(k)


def performance_summary(df: DataFrame, customer: str = "customer", quantity: str = "quantity",
                        discount: str = "discount", sales: str = "sales") -> DataFrame:
    """Distinct customers, items sold, mean discount %, sales per item (0 without items)."""
    a = df.agg(F.countDistinct(customer).alias("customers"), fsum(quantity).alias("items_sold"),
               mean(discount).alias("_d"), fsum(sales).alias("_s"))
    return a.select("customers", "items_sold", (F.col("_d") * 100.0).alias("avg_discount_pct"),
                    F.when(F.col("items_sold") > 0, _dbl("_s") / _dbl("items_sold"))
                     .otherwise(F.lit(0.0)).alias("avg_unit_price"))


def customer_value(df: DataFrame, k: int = 20, customer: str = "customer", sales: str = "sales",
                   profit: str = "profit", quantity: str = "quantity") -> DataFrame:
    """Per customer sum/count/mean of sales, profit and quantity sums,
    rounded to 2 places, top-k by total sales."""
    g = _nn(df, customer).groupBy(customer).agg(
        F.round(fsum(sales), 2).alias("total_sales"), F.count(sales).alias("order_count"),
        round_half_up(mean(sales), 2).alias("avg_order_value"),
        F.round(fsum(profit), 2).alias("total_profit"),
        F.round(fsum(quantity), 2).alias("total_quantity"))
    return g.orderBy(F.desc("total_sales"), F.asc(customer)).limit(k)


# Customer value segment labels, highest first.
SEGMENTS = ["High Value", "Medium Value", "Low Value"]


def customer_segments(df: DataFrame, customer: str = "customer", sales: str = "sales",
                      method: str = "exact") -> DataFrame:
    """Customers by total sales: High > p80, Medium in (p50, p80],
    Low <= p50 (linear quantiles); count and revenue, all three rows always."""
    # one narrow row a customer, read twice below: stored, so the sales are read once
    tot = cut_lineage(_nn(df, customer).groupBy(customer).agg(fsum(sales).alias("_t")).select("_t"))
    q = quantiles(tot, "_t", [0.5, 0.8], out_prefix="_p", method=method)
    t = _one_row_join(tot, q)
    seg = (F.when(_dbl("_t") > F.col("_p_1"), F.lit(SEGMENTS[0]))
            .when(_dbl("_t") > F.col("_p_0"), F.lit(SEGMENTS[1])).otherwise(F.lit(SEGMENTS[2])))
    agg = t.groupBy(seg.alias("segment")).agg(F.count(F.lit(1)).alias("customers"),
                                              F.sum("_t").alias("revenue"))
    spine = df.sparkSession.createDataFrame([(s, i) for i, s in enumerate(SEGMENTS)],
                                            "segment string, segment_order int")
    out = F.broadcast(spine).join(agg, "segment", "left")
    return out.select("segment", "segment_order",
                      F.coalesce("customers", F.lit(0).cast("bigint")).alias("customers"),
                      F.coalesce("revenue", F.lit(0).cast(agg.schema["revenue"].dataType)).alias("revenue"))


def _rollup_with_parent(df: DataFrame, outer: str, inner: str, measures: Sequence[str]) -> DataFrame:
    r = (_nn(df, outer, inner).rollup(outer, inner)
         .agg(*[fsum(m).alias(m) for m in measures], F.grouping_id().alias("_gid")))
    lvl = F.when(F.col("_gid") == 3, F.lit("total")).when(F.col("_gid") == 1, F.lit(outer)).otherwise(F.lit(inner))
    first = measures[0]
    # grand total from a one-row aggregate; parent of an inner row from a
    # window partitioned by the outer key
    r = with_stats(r, r.agg(F.max(F.when(F.col("_gid") == 3, F.col(first))).alias("_grand")))
    grand = F.col("_grand")
    parent_outer = F.max(F.when(F.col("_gid") == 1, F.col(first))).over(Window.partitionBy(outer))
    parent = F.when(F.col("_gid") == 0, parent_outer).when(F.col("_gid") == 1, grand).otherwise(F.col(first))
    return r.select(lvl.alias("level"), outer, inner, *measures,
                    pct(F.col(first), parent).alias(f"pct_of_parent"))


def product_hierarchy(df: DataFrame, category: str = "category", subcategory: str = "subcategory",
                      measures: Sequence[str] = ("sales", "profit", "quantity")) -> DataFrame:
    """Category -> subcategory sums with every node's % of its parent
    (category of the grand total, subcategory of its category)."""
    return _rollup_with_parent(df, category, subcategory, list(measures))


def regional_hierarchy(df: DataFrame, region: str = "region", state: str = "state",
                       measures: Sequence[str] = ("sales", "profit")) -> DataFrame:
    """Region -> state sums with parents, the sunburst's data."""
    return _rollup_with_parent(df, region, state, list(measures))


def histogram(df: DataFrame, c: str, bins: int, with_median: bool = False,
              method: str = "exact") -> DataFrame:
    """``bins`` equal-width bins over [min, max] (the last bin closed),
    count per bin with empty bins present, plus the column mean (and median).
    Infinite values count as missing, as NaN does."""
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        df = df.withColumn(c, F.when(F.abs(F.col(c)) < F.lit(float("inf")), F.col(c)))
    # the ends have to be known before a row's bin is: the column is stored, so ``df`` is read once
    df = cut_lineage(df.select(c))
    x = _dbl(c)
    # the mean is taken on the column itself (exact for decimal money); a
    # floating column's mean is rounded to 9 places, below the noise of the
    # engine's summation order
    m = mean(F.col(c))
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        m = F.round(m, 9)
    st = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"), m.alias("mean"))
    if with_median:
        med = quantiles(df, c, [0.5], out_prefix="_med", midpoint_median=True, method=method).select(
            F.col("_med_0").alias("median"))
        st = _one_row_join(st, med)
    st = st.withColumn("_w", (F.col("_mx") - F.col("_mn")) / float(bins))
    rows = _one_row_join(df.select(x.alias("_x")).where(F.col("_x").isNotNull()), st.select("_mn", "_w"))
    rows = rows.select(F.least(F.lit(bins), F.coalesce(
        F.floor(F.try_divide(F.col("_x") - F.col("_mn"), F.col("_w"))), F.lit(0)) + 1).alias("bin"))
    cnt = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spine = st.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = spine.join(cnt, "bin", "left")
    extra = ["median"] if with_median else []
    return out.select(
        "bin", ((F.col("bin") - 1).cast("double") * F.col("_w") + F.col("_mn")).alias("bin_lo"),
        F.when(F.col("bin") == bins, F.col("_mx")).otherwise(
            F.col("bin").cast("double") * F.col("_w") + F.col("_mn")).alias("bin_hi"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"), "mean", *extra)


def regional_metrics(df: DataFrame, region: str = "region", state: str = "state",
                     sales: str = "sales", profit: str = "profit", customer: str = "customer") -> DataFrame:
    """Per (region, state): sales, profit, distinct customers."""
    return _nn(df, region, state).groupBy(region, state).agg(
        fsum(sales).alias("sales"), fsum(profit).alias("profit"),
        F.countDistinct(customer).alias("customers"))


def top_cities(df: DataFrame, k: int = 15, city: str = "city", sales: str = "sales",
               profit: str = "profit", customer: str = "customer") -> DataFrame:
    """Top-k cities by sales with profit and distinct customers."""
    g = _nn(df, city).groupBy(city).agg(fsum(sales).alias("sales"), fsum(profit).alias("profit"),
                                        F.countDistinct(customer).alias("customers"))
    return g.orderBy(F.desc("sales"), F.asc(city)).limit(k)


def business_summary(df: DataFrame, sales: str = "sales", profit: str = "profit",
                     category: str = "category", date: str = "order_date",
                     customer: str = "customer") -> DataFrame:
    """Margin %, best and worst category, peak calendar month, distinct
    customers, mean sales. The sums by customer, category and month are one
    aggregate (grouping sets), so the rows are read once."""
    rows = df.select(F.col(customer).alias("_k"), F.col(category).alias("_c"), F.month(date).alias("_m"),
                     F.col(sales).alias("_v"), F.col(profit).alias("_w"))
    keys = [F.col(k) for k in ("_k", "_c", "_m")]
    g = rows.groupingSets([[k] for k in keys], *keys).agg(
        F.sum("_v").alias("_s"), F.sum("_w").alias("_p"), F.count("_v").alias("_n"), F.grouping_id().alias("_of"))
    # the bits of grouping_id stand for the keys that a row is not grouped by
    by_customer, s = F.col("_of") == 0b011, F.coalesce("_s", F.lit(0))
    by_category = (F.col("_of") == 0b101) & F.col("_c").isNotNull()
    by_month = (F.col("_of") == 0b110) & F.col("_m").isNotNull()
    cat, mon = F.when(by_category, F.struct(s.alias("s"), F.col("_c"))), F.when(by_month, F.struct(s.alias("s"), F.col("_m")))
    j = g.agg(fsum(F.when(by_customer, F.col("_s"))).alias("_s"), fsum(F.when(by_customer, F.col("_p"))).alias("_p"),
              F.count(F.when(by_customer, F.col("_k"))).alias("customers"),
              F.try_divide(F.sum(F.when(by_customer, F.col("_s"))).cast("double"),
                           F.sum(F.when(by_customer, F.col("_n"))).cast("double")).alias("avg_sales"),
              F.max(cat).alias("_hi"), F.min(cat).alias("_lo"), F.max(mon).alias("_top"))
    j = j.select("*", F.col("_hi._c").alias("_best"), F.col("_hi.s").alias("_cmax"), F.col("_lo._c").alias("_worst"),
                 F.col("_lo.s").alias("_cmin"), F.col("_top._m").alias("_bm"), F.col("_top.s").alias("_mmax"))
    return j.select(
        F.when(F.col("_s") > 0, _dbl("_p") / _dbl("_s") * 100.0).otherwise(F.lit(0.0)).alias("profit_margin"),
        F.when(F.col("_cmax") > 0, F.col("_best")).otherwise(F.lit("N/A")).alias("best_category"),
        F.when(F.col("_cmin") >= 0, F.col("_worst")).otherwise(F.lit("N/A")).alias("worst_category"),
        F.when(F.col("_mmax") > 0, F.col("_bm").cast("string")).otherwise(F.lit("N/A")).alias("best_month"),
        "customers", "avg_sales")


def box_stats(df: DataFrame, key: str = "category", value: str = "profit",
              method: str = "exact") -> DataFrame:
    """Per key min, q1, median, q3, max and the 1.5*IQR whisker ends
    (most extreme values inside the fences)."""
    d = _nn(df, key)
    if method == "exact":
        # quartiles and whiskers come from one table of distinct values: the rows are read once
        rows = ranked_values(d, value, [key])
        q = quantiles_of(rows, [0.25, 0.5, 0.75], [key], "_q")
    else:
        rows = d.select(key, _dbl(value).alias("_v"), F.lit(1).alias("_cnt")).where(F.col("_v").isNotNull())
        q = quantiles(d, value, [0.25, 0.5, 0.75], by=[key], out_prefix="_q", method=method)
    q = q.select(F.col(key).alias("_key"), F.col("_q_0").alias("q1"), F.col("_q_1").alias("median"), F.col("_q_2").alias("q3"))
    # q has one row per key; joined on the key (AQE broadcasts it when small)
    j = rows.join(q, F.col(key) == F.col("_key"))
    v = F.col("_v")
    lo_f = F.col("q1") - (F.col("q3") - F.col("q1")) * 1.5
    hi_f = F.col("q3") + (F.col("q3") - F.col("q1")) * 1.5
    return j.groupBy(key, "q1", "median", "q3").agg(
        F.sum("_cnt").cast("bigint").alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.min(F.when(v >= lo_f, v)).alias("whisker_lo"), F.max(F.when(v <= hi_f, v)).alias("whisker_hi"))


def _co_moments(x: Column, y: Column, name: str = "") -> list[Column]:
    """Aggregates over the rows where both are present and finite: count, centred
    sums of squares and of products (``_n``, ``_xx``, ``_yy``, ``_xy`` + name). They
    are updated and merged about running means, so shifted data keep their digits."""
    inf = F.lit(float("inf"))
    both = (F.abs(x) < inf) & (F.abs(y) < inf)
    a, b = F.when(both, x), F.when(both, y)
    n = F.count(F.when(both, F.lit(1)))
    # population moments times n: the centred sums themselves, no division by n - 1
    return [n.alias(f"_n{name}"), F.var_pop(a).alias(f"_xx{name}"), F.var_pop(b).alias(f"_yy{name}"),
            F.covar_pop(a, b).alias(f"_xy{name}"), F.min(a).alias(f"_xlo{name}"), F.max(a).alias(f"_xhi{name}"),
            F.min(b).alias(f"_ylo{name}"), F.max(b).alias(f"_yhi{name}")]


def _pearson(name: str = "") -> Column:
    """Correlation from ``_co_moments``; NULL with fewer than two pairs or where one
    side has a single value (there is no correlation with a constant)."""
    varies = (F.col(f"_xlo{name}") < F.col(f"_xhi{name}")) & (F.col(f"_ylo{name}") < F.col(f"_yhi{name}"))
    r = F.try_divide(F.col(f"_xy{name}"), F.sqrt(F.col(f"_xx{name}")) * F.sqrt(F.col(f"_yy{name}")))
    return F.when((F.col(f"_n{name}") > 1) & varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def correlation(df: DataFrame, x: str = "sales", y: str = "profit") -> DataFrame:
    """Pearson correlation over rows where both are present; NULL where a
    column is constant."""
    return df.agg(*_co_moments(_dbl(x), _dbl(y))).select(F.col("_n").alias("n"), _pearson().alias("correlation"))


def trend_line(df: DataFrame, x: str = "sales", y: str = "profit", n: int = 100) -> DataFrame:
    """Least-squares line y = slope * x + intercept and ``n`` evenly
    spaced points from min(x) to max(x)."""
    a, b = _dbl(x), _dbl(y)
    both = a.isNotNull() & b.isNotNull()
    m = df.agg(F.count(F.when(both, F.lit(1))).alias("_n"), F.regr_slope(b, a).alias("slope"),
               F.regr_intercept(b, a).alias("intercept"),
               F.min(F.when(both, a)).alias("_mn"), F.max(F.when(both, a)).alias("_mx")).where(F.col("_n") > 1)
    pts = m.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    step = (F.col("_mx") - F.col("_mn")) / float(n - 1)
    xv = F.when(F.col("i") == n - 1, F.col("_mx")).otherwise(F.col("i").cast("double") * step + F.col("_mn"))
    return pts.select("i", xv.alias("x"), "slope", "intercept").withColumn(
        "y", F.col("slope") * F.col("x") + F.col("intercept"))


# Weekday and month names in calendar order.
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_ORDER = ["January", "February", "March", "April", "May", "June",
               "July", "August", "September", "October", "November", "December"]


def weekday_pattern(df: DataFrame, date: str = "order_date", sales: str = "sales") -> DataFrame:
    """Mean sales per weekday, Monday first (day_index 1..7)."""
    d = df.where(F.col(date).isNotNull())
    return (d.groupBy((F.weekday(date) + 1).alias("day_index"),
                      F.date_format(date, "EEEE").alias("day_of_week"))
             .agg(mean(sales).alias("avg_sales")).orderBy("day_index"))


def seasonality(df: DataFrame, date: str = "order_date", sales: str = "sales") -> DataFrame:
    """Sales per calendar month name, January first."""
    d = df.where(F.col(date).isNotNull())
    return (d.groupBy(F.month(date).alias("month_index"), F.date_format(date, "MMMM").alias("month"))
             .agg(fsum(sales).alias("sales")).orderBy("month_index"))


def purchase_frequency(df: DataFrame, customer: str = "customer") -> DataFrame:
    """How many customers made n purchases (rows), per n."""
    per = _nn(df, customer).groupBy(customer).agg(F.count(F.lit(1)).alias("purchase_count"))
    return per.groupBy("purchase_count").agg(F.count(F.lit(1)).alias("customer_count"))


def rfm(df: DataFrame, customer: str = "customer", date: str = "order_date",
        sales: str = "sales", order_id: str | None = "order_id") -> DataFrame:
    """Recency (days from the customer's last order to the latest order
    date overall), frequency (order-id count, else rows), monetary (sales)."""
    mx = df.agg(F.max(date).alias("_now"))
    freq = F.count(order_id) if order_id and order_id in df.columns else F.count(F.lit(1))
    per = _nn(df, customer).groupBy(customer).agg(F.max(date).alias("_last"), freq.alias("frequency"),
                                                  fsum(sales).alias("monetary"))
    return _one_row_join(per, mx).select(
        customer, F.datediff(F.col("_now"), F.col("_last")).alias("recency"), "frequency", "monetary")


def rfm_top(df: DataFrame, n: int = 100, customer: str = "customer", **kw) -> DataFrame:
    """The n customers with the highest monetary value (ties by key)."""
    return rfm(df, customer=customer, **kw).orderBy(F.desc("monetary"), F.asc(customer)).limit(n)


def subcategory_matrix(df: DataFrame, subcategory: str = "subcategory", sales: str = "sales",
                       profit: str = "profit", quantity: str | None = "quantity") -> DataFrame:
    """Per subcategory sums, the means over subcategories (quadrant
    lines) and the quadrant of each subcategory."""
    q = fsum(quantity) if quantity and quantity in df.columns else F.count(F.lit(1))
    g = _nn(df, subcategory).groupBy(subcategory).agg(fsum(sales).alias("sales"), fsum(profit).alias("profit"),
                                                      q.alias("quantity"))
    g = with_stats(g, g.agg(
        (F.sum("sales").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_sales"),
        (F.sum("profit").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_profit")))
    hs, hp = _dbl("sales") >= F.col("avg_sales"), _dbl("profit") >= F.col("avg_profit")
    quad = (F.when(hs & hp, F.lit("high sales, high profit")).when(hs, F.lit("high sales, low profit"))
             .when(hp, F.lit("low sales, high profit")).otherwise(F.lit("low sales, low profit")))
    return g.withColumn("quadrant", quad)


def category_radar(df: DataFrame, category: str = "category", sales: str = "sales",
                   profit: str = "profit", quantity: str | None = "quantity") -> DataFrame:
    """Category sums and each as % of the largest category's value."""
    q = fsum(quantity) if quantity and quantity in df.columns else F.count(F.lit(1))
    g = _nn(df, category).groupBy(category).agg(fsum(sales).alias("sales"), fsum(profit).alias("profit"),
                                                q.alias("quantity"))
    g = with_stats(g, g.agg(*[F.max(m).alias(f"_max_{m}") for m in ("sales", "profit", "quantity")]))
    return g.select(category, "sales", "profit", "quantity",
                    *[pct(F.col(m), F.col(f"_max_{m}")).alias(f"{m}_norm") for m in ("sales", "profit", "quantity")])


def state_correlation(df: DataFrame, k: int = 15, state: str = "state", sales: str = "sales",
                      profit: str = "profit", customer: str = "customer") -> DataFrame:
    """Over the top-k states by sales, the 3x3 Pearson matrix of sales,
    profit and distinct customers, long form (var_x, var_y, correlation)."""
    g = _nn(df, state).groupBy(state).agg(fsum(sales).alias("sales"), fsum(profit).alias("profit"),
                                          F.countDistinct(customer).alias("customer"))
    top = g.orderBy(F.desc("sales"), F.asc(state)).limit(k)
    # k rows: the matrix is computed in double on the small top-k table
    top = top.select(state, *[_dbl(m).alias(m) for m in ("sales", "profit", "customer")])
    names = ["sales", "profit", "customer"]
    pairs = [(a, b) for a in names for b in names]
    m = top.agg(*[c for i, (a, b) in enumerate(pairs) for c in _co_moments(F.col(a), F.col(b), str(i))])
    rows = [F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"), _pearson(str(i)).alias("correlation"))
            for i, (a, b) in enumerate(pairs)]
    return m.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


# Sales quintile labels, lowest first.
QUINTILES = ["Very Low", "Low", "Medium", "High", "Very High"]


def margin_by_quintile(df: DataFrame, sales: str = "sales", profit: str = "profit",
                       method: str = "exact") -> DataFrame:
    """Rows cut at the 20/40/60/80 % sales quantiles (right-closed, the
    first bin includes the minimum); per bin mean profit, mean sales and
    margin % = mean profit / mean sales * 100. Duplicate edges raise an error,
    as quantile cuts do."""
    q = quantiles(df, sales, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], out_prefix="_e", method=method)
    e = [F.col(f"_e_{i}") for i in range(6)]
    dup = (e[0] >= e[1]) | (e[1] >= e[2]) | (e[2] >= e[3]) | (e[3] >= e[4]) | (e[4] >= e[5])
    q = q.withColumn("_ok", F.when(dup, F.raise_error(F.lit("duplicate quantile edges"))).otherwise(F.lit(True)))
    # the rows are read again, but only five groups of them are shuffled: a table of
    # values with their sums would be as long as the rows where sales hardly repeat
    x = _dbl(sales)
    rows = _one_row_join(df.where(F.col(sales).isNotNull()), q)
    b = F.lit(0)
    for i in range(1, 5):
        b = b + F.when(x > e[i], 1).otherwise(0)
    labels = F.array(*[F.lit(s) for s in QUINTILES])
    g = rows.where(F.col("_ok")).groupBy(b.alias("segment_order")).agg(
        mean(profit).alias("profit"), mean(sales).alias("sales"))
    return g.select(F.element_at(labels, F.col("segment_order") + 1).alias("sales_segment"),
                    "segment_order", "profit", "sales",
                    (F.col("profit") / F.col("sales") * 100.0).alias("profit_margin"))


# --------------------------------------------------------------- quality
def _missing(cols: Sequence[str]) -> Column:
    """NULL cells of a row."""
    cells = [F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in cols]
    missing = cells[0] if cells else F.lit(0)
    for c in cells[1:]:
        missing = missing + c
    return missing


def _quality_aggs(df: DataFrame) -> list[Column]:
    missing = _missing(df.columns)
    return [F.count(F.lit(1)).cast("bigint").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"),
            fsum(missing).cast("bigint").alias("missing_values")]


def quality_report(df: DataFrame, reread: bool = True) -> DataFrame:
    """Rows, columns, missing cells, duplicate rows (rows that repeat an
    earlier identical row). Duplicates are counted fingerprint first, so whole rows
    are neither grouped nor shuffled (``functions.rowhash``). With ``reread=False`` (a
    table that is dear to read twice) all four come from the counts of its distinct rows."""
    if not reread and df.columns:
        counted, n = counted_rows(df), F.col("_n")
        cells = counted.columns[:-1]
        missing = _missing(cells)
        return counted.agg(fsum(n).cast("bigint").alias("rows"), F.lit(len(cells)).cast("bigint").alias("columns"),
                           fsum(n * missing).cast("bigint").alias("missing_values"),
                           fsum(n - 1).cast("bigint").alias("duplicate_rows"))
    return _one_row_join(df.agg(*_quality_aggs(df)), repeated_row_count(df)).select(
        "rows", "columns", "missing_values", F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"))


def cleaning_summary(df: DataFrame, sales: str = "sales", profit: str = "profit",
                     discount: str = "discount", reread: bool = True) -> DataFrame:
    """G49 plus total sales, total profit and mean discount % of the same scan
    (exact for decimal money). With ``reread=False`` (a table that is dear to read twice)
    all of them come from the counts of its distinct rows."""
    if not reread and df.columns:
        money = [F.sum(F.col(c)) for c in (sales, profit, discount)]
        kinds = [f.dataType for f in df.agg(*[m.alias(f"_s{i}") for i, m in enumerate(money)]).schema.fields]
        places = [f"_{df.columns.index(c)}" for c in (sales, profit, discount)]
        counted, n = counted_rows(df, places), F.col("_n")
        # in the types that adding up the rows themselves gives
        total = [F.sum(f"_s{i}").cast(kind) for i, kind in enumerate(kinds)]
        known = F.sum(F.when(F.col(places[2]).isNotNull(), n))
        cells = [f"_{i}" for i in range(len(df.columns))]
        return counted.agg(fsum(n).cast("bigint").alias("rows"), F.lit(len(cells)).cast("bigint").alias("columns"),
                           fsum(n * _missing(cells)).cast("bigint").alias("missing_values"),
                           fsum(n - 1).cast("bigint").alias("duplicate_rows"),
                           F.coalesce(total[0], F.lit(0)).alias("total_sales"), F.coalesce(total[1], F.lit(0)).alias("total_profit"),
                           (F.try_divide(total[2].cast("double"), known.cast("double")) * 100.0).alias("avg_discount_pct"))
    totals = df.agg(*_quality_aggs(df), fsum(sales).alias("total_sales"), fsum(profit).alias("total_profit"),
                    (mean(discount) * 100.0).alias("avg_discount_pct"))
    return _one_row_join(totals, repeated_row_count(df)).select(
        "rows", "columns", "missing_values", F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
        "total_sales", "total_profit", "avg_discount_pct")


nan_missing(globals())
