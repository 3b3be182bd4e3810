"""Distributed order statistics against pandas/numpy brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailyze.functions.ordered import exact_quantiles, global_index, running_total


def _lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


def test_global_index_is_a_permutation_in_order(spark):
    li = _lineitem(spark).select("l_orderkey", "l_linenumber", "l_extendedprice").repartition(7)
    idx = global_index(li, [F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], "i")
    pdf = idx.select("i", "l_extendedprice", "l_orderkey", "l_linenumber").toPandas().sort_values("i")
    n = li.count()
    assert list(pdf["i"]) == list(range(n))
    expect = pdf.sort_values(["l_extendedprice", "l_orderkey", "l_linenumber"])
    assert list(expect["i"]) == list(range(n))


def test_running_total_matches_cumsum(spark):
    per = (_lineitem(spark).groupBy("l_partkey")
           .agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("s")))
    rt = running_total(per, [F.desc("s"), F.asc("l_partkey")], "s", out="cum", rank="rank").toPandas()
    rt = rt.sort_values("rank")
    base = per.toPandas().sort_values(["s", "l_partkey"], ascending=[False, True])
    assert list(rt["rank"]) == list(range(1, len(base) + 1))
    assert list(rt["cum"]) == list(base["s"].cumsum())


def _np_quantile(xs, p):
    return float(np.quantile(np.asarray(xs, dtype=float), p))


def test_exact_quantiles_match_numpy_by_group(spark):
    li = _lineitem(spark).select("l_returnflag", "l_extendedprice", "l_quantity")
    q = exact_quantiles(li, "l_extendedprice", [0.0, 0.1, 0.25, 0.5, 0.8, 1.0], by=["l_returnflag"]).toPandas()
    pdf = li.toPandas()
    for _, row in q.iterrows():
        xs = pdf.loc[pdf.l_returnflag == row.l_returnflag, "l_extendedprice"]
        for i, p in enumerate([0.0, 0.1, 0.25, 0.5, 0.8, 1.0]):
            assert row[f"q_{i}"] == _np_quantile(xs, p)


def test_exact_quantiles_with_a_hot_group(spark):
    # one key holds a third of all rows; the sort spreads it over partitions
    li = _lineitem(spark).select("l_orderkey", "l_quantity")
    skew = li.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey") % 50))
    q = exact_quantiles(skew, "l_quantity", [0.5, 0.9], by=["k"]).toPandas()
    pdf = skew.toPandas()
    for _, row in q.iterrows():
        xs = pdf.loc[pdf.k == row.k, "l_quantity"]
        assert row["q_0"] == _np_quantile(xs, 0.5)
        assert row["q_1"] == _np_quantile(xs, 0.9)


def test_median_midpoint(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [1.0, 2.0, 4.0, 10.0]}))
    q = exact_quantiles(df, "x", [0.5], midpoint_median=True).first()
    assert q["q_0"] == 3.0


def test_approx_quantiles_are_close(spark):
    from retailyze.functions.ordered import quantiles
    li = _lineitem(spark).select("l_returnflag", "l_extendedprice")
    ex = quantiles(li, "l_extendedprice", [0.25, 0.5, 0.75], by=["l_returnflag"]).toPandas().sort_values("l_returnflag")
    ap = quantiles(li, "l_extendedprice", [0.25, 0.5, 0.75], by=["l_returnflag"],
                   method="approx", accuracy=100000).toPandas().sort_values("l_returnflag")
    pdf = li.toPandas()
    for (_, e), (_, a) in zip(ex.iterrows(), ap.iterrows()):
        xs = np.sort(pdf.loc[pdf.l_returnflag == e.l_returnflag, "l_extendedprice"].to_numpy())
        for i in range(3):
            # the approximate value is an element whose rank is within 1% of the exact one
            r_exact = np.searchsorted(xs, e[f"q_{i}"])
            r_approx = np.searchsorted(xs, a[f"q_{i}"])
            assert abs(r_exact - r_approx) <= 0.01 * len(xs) + 1
