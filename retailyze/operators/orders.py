"""Order-export analytics (raw order schema; Spark-origin, NULL groups kept).

Each function returns a DataFrame; the batch run fans one cleaned plan out to
several of these, so callers cache the cleaned input when more than one action
follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import mean, nan_missing, with_stats


def valid_orders(df: DataFrame, status: str = "status", price: str = "price",
                 total: str = "grand_total") -> DataFrame:
    """Status present, positive price and grand total (pushed to the scan)."""
    return df.where(F.col(status).isNotNull() & (F.col(price) > 0) & (F.col(total) > 0))


def revenue_kpis(df: DataFrame, total: str = "grand_total",
                 customer: str = "customer_id") -> DataFrame:
    """One row - total revenue, average order value, rows, distinct customers."""
    return df.agg(
        F.sum(total).alias("total_revenue"),
        mean(total).alias("avg_order_value"),
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct(customer).alias("unique_customers"))


def category_performance(df: DataFrame, k: int = 10, category: str = "category_name_1",
                         total: str = "grand_total") -> DataFrame:
    """Top-k categories by revenue with order count and average."""
    g = df.groupBy(category).agg(
        F.sum(total).alias("category_revenue"),
        F.count(F.lit(1)).alias("category_orders"),
        mean(total).alias("category_avg_order"))
    return g.orderBy(F.desc("category_revenue"), F.asc_nulls_last(category)).limit(k)


def monthly_trends(df: DataFrame, total: str = "grand_total") -> DataFrame:
    """Revenue and orders per (year, month), in calendar order."""
    return (df.groupBy("year", "month")
              .agg(F.sum(total).alias("monthly_revenue"),
                   F.count(F.lit(1)).alias("monthly_orders"))
              .orderBy("year", "month"))


def payment_analysis(df: DataFrame, method: str = "payment_method",
                     total: str = "grand_total") -> DataFrame:
    """Payment methods by revenue, descending."""
    return (df.groupBy(method)
              .agg(F.sum(total).alias("payment_revenue"),
                   F.count(F.lit(1)).alias("payment_orders"))
              .orderBy(F.desc("payment_revenue"), F.asc_nulls_last(method)))


def status_distribution(df: DataFrame, status: str = "status",
                        total: str = "grand_total") -> DataFrame:
    """Rows and revenue per status."""
    return df.groupBy(status).agg(
        F.count(F.lit(1)).alias("status_count"),
        F.sum(total).alias("status_revenue"))


def executive_summary(df: DataFrame, category: str = "category_name_1",
                      total: str = "grand_total", customer: str = "customer_id") -> DataFrame:
    """KPIs plus the top category by revenue ('N/A' / 0 when there is none).

    The per-category revenues are reduced with ``max_by`` in a second, tiny
    aggregate (one row per category), so no join back to the fact is needed.
    """
    kpi = revenue_kpis(df, total, customer)
    per_cat = df.groupBy(category).agg(F.sum(total).alias("_rev"))
    top = per_cat.agg(
        F.max_by(F.col(category), F.struct(F.col("_rev"), F.col(category))).alias("_top"),
        F.max("_rev").alias("_top_rev"))
    # the top-category row is attached as a scalar subquery (one row)
    return with_stats(kpi, top).select(
        "total_revenue", "avg_order_value", "total_orders", "unique_customers",
        F.coalesce(F.col("_top"), F.lit("N/A")).alias("top_category"),
        F.coalesce(F.col("_top_rev"), F.lit(0).cast(per_cat.schema["_rev"].dataType))
         .alias("top_category_revenue"))


def category_payment_summary(df: DataFrame, category: str = "category_name_1",
                             method: str = "payment_method", total: str = "grand_total",
                             status: str = "status") -> DataFrame:
    """Revenue, count, average per (category, payment method) of rows with a status."""
    return (df.where(F.col(status).isNotNull())
              .groupBy(category, method)
              .agg(F.sum(total).alias("total_revenue"),
                   F.count(F.lit(1)).alias("transaction_count"),
                   mean(total).alias("avg_transaction_value")))


nan_missing(globals())
