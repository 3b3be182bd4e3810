"""Queries for the header and envelope operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import shape as P
from ..sinks.writers import to_envelope
from ..streaming.ingest import parse_envelope
from .fixtures import SALES_FACT_SQL, sales_fact, table, with_sql
from .registry import register

S = with_sql(SALES_FACT_SQL)


@register("p02_drop_empty_columns", S + "SELECT order_id, line_no, region FROM sales_fact")
def p02(spark, d):
    s = sales_fact(spark, d).select("order_id", "line_no", F.lit(None).cast("string").alias("note"), "region",
                                    F.lit(None).cast("double").alias("tax"))
    return P.drop_empty_columns(s)


@register("p03_drop_index_columns", "SELECT c_custkey, c_name FROM customer")
def p03(spark, d):
    c = table(spark, d, "customer")
    low = c.agg(F.min("c_custkey")).first()[0]
    return P.drop_index_columns(c.select((F.col("c_custkey") - low).alias("index"), "c_custkey", "c_name",
                                         F.lit(1).alias("Unnamed: 0")))


@register("p04_clean_headers", S + "SELECT order_id, line_no, region FROM sales_fact")
def p04(spark, d):
    return P.clean_headers(sales_fact(spark, d).select("order_id", "line_no", "region").toDF(
        "﻿order_id", " line_no ", "region\t"))


@register("p06_sanitize_columns", S + "SELECT order_id, line_no, region AS sales_region_x FROM sales_fact")
def p06(spark, d):
    return P.sanitize_columns(sales_fact(spark, d).select("order_id", "line_no", "region").toDF(
        "order-id", "line no", "sales region.x"))


@register("q05_sql_validations", """
SELECT 'sql_validation' AS "check", q AS subject, CAST(n AS DOUBLE) AS value, CAST(m AS DOUBLE) AS threshold, n >= m AS passed
FROM (SELECT 'SELECT COUNT(*) FROM processed_orders' AS q, (SELECT COUNT(*) FROM orders) AS n, 10 AS m
      UNION ALL
      SELECT 'SELECT COUNT(*) FROM processed_customers', (SELECT COUNT(*) FROM customer), 5000000)""")
def q05(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("processed_orders")
    table(spark, d, "customer").createOrReplaceTempView("processed_customers")
    return Q.run_validations(spark, [
        {"query": "SELECT COUNT(*) FROM processed_orders", "expected_min": 10},
        {"query": "SELECT COUNT(*) FROM processed_customers", "expected_min": 5000000}])


@register("t01_envelope_round_trip", """
SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM events""")
def t01(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    back, _ = parse_envelope(to_envelope(rows, ts="ts"), rows.drop("ts").schema)
    return back.select("event_id", "event_type", "value", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))
