"""Fact views over the driver's star-schema tables.

``sales_fact`` is the canonical analytics table (one row per order item with
sales, profit, category, customer, region, ... names), ``orders_fact`` the same
rows under the raw order-export names, ``dirty_sales`` a string-typed copy with
deterministic dirt for the cleaning operators. Each view has a Spark builder
and a SQL twin (``*_SQL``) that the DuckDB oracle uses as a CTE, so both sides
start from identical rows.

Money is DECIMAL so sums are exact and independent of the order in which the
engine adds them.
"""

from __future__ import annotations

import weakref

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


# Per-session memo of scanned tables and prepared (materialized) facts: a
# parquet DataFrame is immutable, so reusing it skips repeated file listing and
# footer reads when many queries run in one session.
_SCANS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()
_PREPARED: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    memo = _SCANS.setdefault(spark, {})
    key = (sf_dir, name)
    if key not in memo:
        memo[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return memo[key]


def prepare_facts(spark: SparkSession, sf_dir: str, out_dir: str, cache: bool = False,
                  records_per_file: int = 0) -> dict[str, str]:
    """Materialize ``sales_fact`` and ``orders_fact`` once as parquet (a flat
    fact table, as a production deployment stores it) and serve later calls
    for ``sf_dir`` from there. ``cache=True`` also keeps the flat facts in
    executor memory (spilling to disk) for a fan-out of many queries - a lost
    cached block is re-read from the written parquet, not recomputed from the
    joins. ``records_per_file`` bounds the files' rows (0: not at all), so that a small
    fact is still read by all cores. Returns the written paths."""
    paths = {}
    for name, build in (("sales_fact", _build_sales_fact), ("orders_fact", _build_orders_fact)):
        path = f"{out_dir}/{name}"
        build(spark, sf_dir).write.mode("overwrite").option("maxRecordsPerFile", records_per_file).parquet(path)
        paths[name] = path
    reg = _PREPARED.setdefault(spark, {})
    for name, path in paths.items():
        df = spark.read.parquet(path)
        if cache:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            df.count()
        reg[(sf_dir, name)] = df
    return paths


def _prepared(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    return _PREPARED.get(spark, {}).get((sf_dir, name))


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions:
    # a proven bound, so they are broadcast into the customer side.
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))


def _items(spark: SparkSession, sf_dir: str, with_customer: bool = True, by_order: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    # Join sizes are left to Catalyst + AQE: lineitem/orders shuffle on the
    # order key; part and customer are broadcast only if AQE measures them
    # under the broadcast threshold at runtime.
    if by_order:
        # The same rows; the items are shuffled twice instead of three times. They end up
        # dealt by the order's key as text, so grouping by an ``order_id`` of that form and
        # more columns needs no shuffle of whole rows.
        o = o.join(_dim_customer(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        x = li.join(p, F.col("l_partkey") == p.p_partkey)
        return x.join(o, F.col("l_orderkey").cast("string") == F.col("o_orderkey").cast("string"))
    x = li.join(o, li.l_orderkey == o.o_orderkey)
    if with_customer:
        x = x.join(_dim_customer(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return x.join(p, F.col("l_partkey") == p.p_partkey)


# Factor precisions keep every product at precision <= 18, so Spark computes
# it on unscaled longs instead of BigDecimal (the values are exact either way):
# decimal(10,2) * decimal(5,2) -> decimal(16,4); decimal(6,2) * decimal(10,2)
# -> decimal(17,4); their difference -> decimal(18,4).
def _net_price():
    return (F.col("l_extendedprice").cast("decimal(10,2)")
            * (F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)")))


def _sales_expr():
    return _net_price().cast(MONEY)


def _cost_expr():
    return (F.col("l_quantity").cast("decimal(6,2)")
            * F.col("p_retailprice").cast("decimal(10,2)"))


def sales_fact(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """Canonical sales rows (see module doc); the prepared copy when one exists.
    ``by_order`` joins them in another sequence, for tables grouped by order (``_items``)."""
    p = _prepared(spark, sf_dir, "sales_fact")
    return p if p is not None else _build_sales_fact(spark, sf_dir, by_order)


def _build_sales_fact(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    x = _items(spark, sf_dir, by_order=by_order)
    sales = _sales_expr()
    return x.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("c_name").alias("customer"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("product_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.concat(F.col("n_name"), F.lit("-"), (F.col("c_custkey") % 5).cast("string")).alias("city"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        sales.alias("sales"),
        (_net_price() - _cost_expr()).cast(MONEY).alias("profit"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("status"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
    )


SALES_FACT_SQL = """
sales_fact AS (
  SELECT o.o_orderkey AS order_id, l.l_linenumber AS line_no,
         o.o_orderdate AS order_date, l.l_shipdate AS ship_date,
         c.c_name AS customer, o.o_custkey AS customer_id,
         p.p_type AS category, p.p_brand AS subcategory, p.p_name AS product_name,
         r.r_name AS region, n.n_name AS state,
         n.n_name || '-' || CAST(c.c_custkey % 5 AS VARCHAR) AS city,
         l.l_quantity AS quantity, CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS sales,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              - CAST(l.l_quantity AS DECIMAL(12,2)) * CAST(p.p_retailprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS profit,
         o.o_orderpriority AS payment_method, o.o_orderstatus AS status,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS list_price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows under the raw order-export column names."""
    p = _prepared(spark, sf_dir, "orders_fact")
    return p if p is not None else _build_orders_fact(spark, sf_dir)


def _build_orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # no customer attribute is exported under the order names, so only
    # lineitem, orders and part are joined (every foreign key resolves in the
    # driver tables, so the rows are those of sales_fact)
    x = _items(spark, sf_dir, with_customer=False)
    sales = _sales_expr()
    return x.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("item_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("p_name").alias("sku"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(18,8)").alias("price"),
        F.col("l_quantity").cast("int").alias("qty_ordered"),
        sales.alias("grand_total"),
        F.col("o_orderkey").cast("string").alias("increment_id"),
        F.col("p_type").alias("category_name_1"),
        (F.col("l_extendedprice").cast("decimal(10,2)")
         * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY).alias("discount_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("o_custkey").cast("string").alias("customer_id"),
    )


ORDERS_FACT_SQL = """
orders_fact AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS item_id,
         o.o_orderstatus AS status, o.o_orderdate AS created_at, p.p_name AS sku,
         CAST(l.l_extendedprice / l.l_quantity AS DECIMAL(18,8)) AS price,
         CAST(l.l_quantity AS INTEGER) AS qty_ordered,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS grand_total,
         CAST(o.o_orderkey AS VARCHAR) AS increment_id,
         p.p_type AS category_name_1,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS discount_amount,
         o.o_orderpriority AS payment_method,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         CAST(o.o_custkey AS VARCHAR) AS customer_id
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders_fact with deterministic dirt: NULL status on order key % 17,
    negative price on % 29."""
    o = orders_fact(spark, sf_dir)
    key = F.col("increment_id").cast("bigint")
    return o.withColumns({
        "status": F.when(key % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("status")),
        "price": F.when(key % 29 == 0, -F.col("price")).otherwise(F.col("price")),
    })


DIRTY_ORDERS_SQL = ORDERS_FACT_SQL + """,
dirty_orders AS (
  SELECT * REPLACE (
      CASE WHEN CAST(increment_id AS BIGINT) % 17 = 0 THEN NULL ELSE status END AS status,
      CASE WHEN CAST(increment_id AS BIGINT) % 29 = 0 THEN -price ELSE price END AS price)
  FROM orders_fact
)"""


def _twice_if(df: DataFrame, cond) -> DataFrame:
    """Every row where ``cond`` holds appears twice - one scan (an explode of a
    per-row copy count) instead of a union that reads the input again."""
    copies = F.explode(F.sequence(F.lit(1), F.when(cond, F.lit(2)).otherwise(F.lit(1))))
    return df.select("*", copies.alias("_copy")).drop("_copy")


def dirty_sales(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """String-typed sales rows as they arrive from an uploaded file.

    Dirt (keyed on order_id, identical in the SQL twin): 'n/a' in sales on
    % 19, text in profit on % 37, NULL category on % 11, padded customer
    names (tabs/spaces), NULL customer on % 13, unparseable order dates on % 31,
    NULL quantity on % 41, and every row of orders % 23 twice. ``by_order``: as in
    ``sales_fact``.
    """
    s = sales_fact(spark, sf_dir, by_order)
    k = F.col("order_id")
    null_s = F.lit(None).cast("string")
    base = s.select(
        k.cast("string").alias("order_id"),
        F.col("line_no"),
        F.when(k % 31 == 0, F.lit("not a date"))
         .otherwise(F.date_format("order_date", "yyyy-MM-dd")).alias("order_date"),
        F.date_format("ship_date", "yyyy-MM-dd").alias("ship_date"),
        F.when(k % 13 == 0, null_s)
         .otherwise(F.concat(F.lit(" \t"), F.col("customer"), F.lit("  "))).alias("customer"),
        F.when(k % 11 == 0, null_s).otherwise(F.col("category")).alias("category"),
        F.col("subcategory"), F.col("product_name"), F.col("region"), F.col("state"),
        F.concat(F.lit(" "), F.col("city")).alias("city"),
        F.when(k % 41 == 0, null_s).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("discount").cast("string").alias("discount"),
        F.when(k % 19 == 0, F.lit("n/a")).otherwise(F.col("sales").cast("string")).alias("sales"),
        F.when(k % 37 == 0, F.lit("unknown")).otherwise(F.col("profit").cast("string")).alias("profit"),
    )
    return _twice_if(base, F.col("order_id").cast("bigint") % 23 == 0)


DIRTY_SALES_SQL = SALES_FACT_SQL + """,
dirty_base AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, line_no,
         CASE WHEN order_id % 31 = 0 THEN 'not a date' ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
         strftime(ship_date, '%Y-%m-%d') AS ship_date,
         CASE WHEN order_id % 13 = 0 THEN NULL ELSE ' ' || chr(9) || customer || '  ' END AS customer,
         CASE WHEN order_id % 11 = 0 THEN NULL ELSE category END AS category,
         subcategory, product_name, region, state, ' ' || city AS city,
         CASE WHEN order_id % 41 = 0 THEN NULL ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CAST(discount AS VARCHAR) AS discount,
         CASE WHEN order_id % 19 = 0 THEN 'n/a' ELSE CAST(sales AS VARCHAR) END AS sales,
         CASE WHEN order_id % 37 = 0 THEN 'unknown' ELSE CAST(profit AS VARCHAR) END AS profit
  FROM sales_fact
),
dirty_sales AS (
  SELECT * FROM dirty_base
  UNION ALL
  SELECT * FROM dirty_base WHERE CAST(order_id AS BIGINT) % 23 = 0
)"""


def with_sql(*ctes: str) -> str:
    """``WITH`` prefix for the oracle from the given CTE blocks."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def config_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows under the names of the cleaning-rule config (orders source),
    as text with deterministic dirt keyed on the order id: NULL customer name
    (% 13), e-mail in upper case with spaces, invalid (% 7) or NULL (% 11),
    formatted phone numbers, 'n/a' (% 19) or NULL (% 29) amounts, currency
    text prices, NULL dates (% 31), NULL category (% 17), NULL discount (% 43),
    NULL address (% 5), and every row of orders % 23 twice."""
    s = sales_fact(spark, sf_dir)
    k = F.col("order_id")
    null_s = F.lit(None).cast("string")
    base = s.select(
        k.cast("string").alias("order_id"), F.col("line_no"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.when(k % 13 == 0, null_s).otherwise(
            F.lower(F.regexp_replace(F.col("customer"), "#", "  #"))).alias("customer_name"),
        F.when(k % 11 == 0, null_s).when(k % 7 == 0, F.lit("not-an-email")).otherwise(
            F.concat(F.lit("  "), F.upper(F.regexp_replace(F.col("customer"), "#", ".")),
                     F.lit("@Example.COM "))).alias("customer_email"),
        F.concat(F.lit("+1 ("), F.lpad((F.col("customer_id") % 1000).cast("string"), 3, "0"),
                 F.lit(") 555-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("customer_phone"),
        F.when(k % 19 == 0, F.lit("n/a")).when(k % 29 == 0, null_s)
         .otherwise(F.col("sales").cast("string")).alias("order_amount"),
        F.concat(F.lit("$"), F.col("list_price").cast("string")).alias("product_price"),
        F.when(k % 31 == 0, null_s).otherwise(F.date_format("order_date", "yyyy-MM-dd")).alias("order_date"),
        F.col("quantity"),
        F.when(k % 17 == 0, null_s).otherwise(F.col("category")).alias("product_category"),
        F.col("product_name"),
        F.when(k % 43 == 0, F.lit(None).cast("decimal(4,2)")).otherwise(F.col("discount")).alias("discount_amount"),
        F.when(k % 5 == 0, null_s).otherwise(F.col("city")).alias("shipping_address"),
    )
    return _twice_if(base, F.col("order_id").cast("bigint") % 23 == 0)


CONFIG_ORDERS_SQL = SALES_FACT_SQL + """,
config_base AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, line_no, CAST(customer_id AS VARCHAR) AS customer_id,
         CASE WHEN order_id % 13 = 0 THEN NULL ELSE lower(replace(customer, '#', '  #')) END AS customer_name,
         CASE WHEN order_id % 11 = 0 THEN NULL WHEN order_id % 7 = 0 THEN 'not-an-email'
              ELSE '  ' || upper(replace(customer, '#', '.')) || '@Example.COM ' END AS customer_email,
         '+1 (' || lpad(CAST(customer_id % 1000 AS VARCHAR), 3, '0') || ') 555-'
           || lpad(CAST(order_id % 10000 AS VARCHAR), 4, '0') AS customer_phone,
         CASE WHEN order_id % 19 = 0 THEN 'n/a' WHEN order_id % 29 = 0 THEN NULL
              ELSE CAST(sales AS VARCHAR) END AS order_amount,
         '$' || CAST(list_price AS VARCHAR) AS product_price,
         CASE WHEN order_id % 31 = 0 THEN NULL ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
         quantity,
         CASE WHEN order_id % 17 = 0 THEN NULL ELSE category END AS product_category,
         product_name,
         CASE WHEN order_id % 43 = 0 THEN NULL ELSE discount END AS discount_amount,
         CASE WHEN order_id % 5 = 0 THEN NULL ELSE city END AS shipping_address
  FROM sales_fact
),
config_orders AS (
  SELECT * FROM config_base
  UNION ALL
  SELECT * FROM config_base WHERE CAST(order_id AS BIGINT) % 23 = 0
)"""
