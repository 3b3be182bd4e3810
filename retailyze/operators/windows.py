"""Window analytics.

Monthly series (N01, N04, N05) are windows over the monthly aggregate - one row
per month, a few hundred rows at most - so the un-partitioned window runs on a
tiny table. The product Pareto (N02/N03) can have millions of products; its
running total uses the distributed ``running_total`` (range-partitioned sort,
per-partition sums, broadcast offsets) instead of a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fsum, month_key, nan_missing, pct, with_stats
from ..functions.ordered import running_total
from ..session import cut_lineage


def _monthly(df: DataFrame, date: str, sales: str) -> DataFrame:
    return (df.where(F.col(date).isNotNull())
              .groupBy(month_key(date).alias("month")).agg(fsum(sales).alias("sales")))


def customer_acquisition(df: DataFrame, customer: str = "customer", date: str = "order_date") -> DataFrame:
    """Customers whose first order falls in each month, and the running total."""
    first = (df.where(F.col(customer).isNotNull())
               .groupBy(customer).agg(F.min(date).alias("_first")))
    per_month = (first.where(F.col("_first").isNotNull())
                      .groupBy(month_key("_first").alias("month"))
                      .agg(F.count(F.lit(1)).alias("new_customers")))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return per_month.withColumn("cumulative_customers", F.sum("new_customers").over(w))


def abc_analysis(df: DataFrame, k: int | None = 50, product: str = "product_name",
                 sales: str = "sales") -> DataFrame:
    """Products by sales descending with running total, running % of all
    sales and rank; the first k (all when k is None)."""
    per = (df.where(F.col(product).isNotNull())
             .groupBy(product).agg(fsum(sales).alias("sales")))
    total = per.agg(F.sum("sales").alias("_total"))
    if k is not None:  # k rows: a bounded top-k, then a window over them alone
        top = per.orderBy(F.desc("sales"), F.asc(product)).limit(k)
        w = Window.orderBy(F.desc("sales"), F.asc(product))
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        out = with_stats(top.withColumns({"cumulative_sales": F.sum("sales").over(upto),
                                          "rank": F.row_number().over(w).cast("bigint")}), total)
        return out.select(product, "sales", "cumulative_sales",
                          pct("cumulative_sales", "_total").alias("cumulative_percent"), "rank")
    per = cut_lineage(per)  # one row a product: the sales are read once for order and total
    total = per.agg(F.sum("sales").alias("_total"))
    ranked = running_total(per, [F.desc("sales"), F.asc(product)], "sales",
                           out="cumulative_sales", rank="rank")
    out = with_stats(ranked, total)  # the grand total, as a scalar subquery
    return out.select(product, "sales", "cumulative_sales",
                      pct("cumulative_sales", "_total").alias("cumulative_percent"), "rank")


def abc_class(abc: DataFrame, cut: float = 80.0) -> DataFrame:
    """N03: 'A' for products inside the cut line of cumulative sales %, else 'B'."""
    return abc.withColumn("abc_class", F.when(F.col("cumulative_percent") <= F.lit(cut), F.lit("A"))
                          .otherwise(F.lit("B")))


def mom_growth(df: DataFrame, date: str = "order_date", sales: str = "sales") -> DataFrame:
    """Month-over-month growth % = (this / previous - 1) * 100; NULL for
    the first month and after a zero month."""
    m = _monthly(df, date, sales)
    prev = F.lag("sales").over(Window.orderBy("month"))
    return m.withColumn("growth_pct", (F.try_divide(F.col("sales").cast("double"), prev.cast("double"))
                                       - F.lit(1.0)) * F.lit(100.0))


def moving_averages(df: DataFrame, windows: Sequence[int] = (3, 6), date: str = "order_date",
                    sales: str = "sales") -> DataFrame:
    """Trailing n-month moving averages, NULL until n months are present."""
    m = _monthly(df, date, sales)
    cols = {}
    for n in windows:
        w = Window.orderBy("month").rowsBetween(-(n - 1), 0)
        cols[f"ma_{n}"] = F.when(F.count("sales").over(w) == n,
                                 F.sum("sales").over(w).cast("double") / F.lit(float(n)))
    return m.withColumns(cols)


nan_missing(globals())
