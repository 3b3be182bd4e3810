"""NaN as missing, shifted data, large totals, hot values, date layouts, stream routing."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailyze.functions.ordered import _sorted_tagged, exact_quantiles
from retailyze.operators import clean as C
from retailyze.operators import profile as PR
from retailyze.operators import sales as G
from retailyze.operators.rules import DEFAULT_RULES
from retailyze.streaming import ingest as S


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", float("nan"), 3.0), ("b", 5.0, float("nan"))],
                               "category string, sales double, profit double")
    k = G.sales_kpis(df).first()
    assert (k["total_sales"], k["total_profit"], k["total_orders"]) == (6.0, 5.0, 3)
    assert {r["category"]: r["sales"] for r in G.sum_by(df, "category", "sales").collect()} == {"a": 1.0, "b": 5.0}
    assert exact_quantiles(df, "sales", [0.5]).first()[0] == 3.0
    stats = {(r["column_name"], r["stat"]): r["value"] for r in PR.numeric_profile(df).collect()}
    assert stats["sales", "count"] == 2 and stats["sales", "max"] == 5.0
    filled = C.fill_missing(df, {"sales": "mean"}).agg(F.sum("sales")).first()[0]
    assert filled == 9.0


def test_moments_keep_their_digits_on_shifted_data(spark):
    df = spark.range(10).select((F.col("id") + 1e9).alias("sales"), (F.col("id") + 1e9).alias("profit"),
                                (F.col("id") + 1_000_000_000).alias("n"))
    assert G.correlation(df).first()["correlation"] == pytest.approx(1.0, abs=1e-12)
    line = G.trend_line(df, n=3).first()
    assert line["slope"] == pytest.approx(1.0, abs=1e-9)
    sd = {r["column_name"]: r["value"] for r in PR.numeric_profile(df).where("stat = 'stddev'").collect()}
    assert sd["n"] == pytest.approx(np.std(np.arange(10), ddof=1), rel=1e-9)


def test_totals_over_1e15_are_reported(spark):
    df = spark.createDataFrame([(6e14, 1.0), (6e14, 1.0)], "sales double, profit double")
    r = G.insights(df, {"sales": "sales", "profit": "profit"}).first()
    assert r["total_sales"] == 1.2e15 and r["avg_order_value"] == 6e14


def test_quantiles_match_numpy_and_a_hot_value_reaches_no_sort_task(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random(20_000) < 0.6, 7.0, rng.normal(0, 100, 20_000).round(1))
    g = rng.integers(0, 3, 20_000)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)] + [(None, 1.0), (None, 3.0)], "g int, x double")
    got = {r["g"]: r[1:] for r in exact_quantiles(df, "x", [0.0, 0.1, 0.25, 0.9, 1.0], by=["g"]).collect()}
    for k in (0, 1, 2):
        assert got[k] == pytest.approx(np.quantile(x[g == k], [0.0, 0.1, 0.25, 0.9, 1.0]))
    assert got[None] == pytest.approx(np.quantile([1.0, 3.0], [0.0, 0.1, 0.25, 0.9, 1.0]))
    counts = df.groupBy("x").agg(F.count(F.lit(1)).alias("_cnt"))
    sizes = [r["n"] for r in _sorted_tagged(counts, [F.col("x")]).groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == len(set(x)) + 2 - len({1.0, 3.0} & set(x))


@pytest.mark.parametrize("text", ["2016-11-08", "11/8/2016", "11-08-2016", "2016/11/08", "2016-11-08 00:00:00", "11/8/2016 0:00"])
def test_date_layouts(spark, text):
    df = spark.createDataFrame([(text, "no date")], "order_date string, ship_date string")
    r = C.coerce_dates(df).first()
    assert str(r["order_date"]) == "2016-11-08 00:00:00" and r["ship_date"] is None
    assert G.date_range(df).first()[0] == "2016-11-08 to 2016-11-08"


def test_dedup_by_shuffles_each_row_once(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "z", 0)], "k int, s string, v int")
    out = C.dedup_by(df, ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "a", 9), (2, None, 1)]
    assert "min_by" not in out._jdf.queryExecution().toString()


def test_route_keeps_rejects_and_replays_without_copies(spark, tmp_dir):
    schema = spark.createDataFrame([], "order_id string, order_amount string, order_date string").schema
    good = [json.dumps({"timestamp": "2024-01-01T00:00:00", "data": {
        "order_id": str(i), "order_amount": str(10 * i), "order_date": "2024-01-01"}}) for i in range(1, 6)]
    rows = [("raw-orders", g) for g in good] + [("raw-orders", "not json"), ("other", good[0])]
    spark.createDataFrame(rows, "topic string, value string").coalesce(1).write.parquet(f"{tmp_dir}/in")

    def run(checkpoint):
        stream = spark.readStream.schema("topic string, value string").parquet(f"{tmp_dir}/in")
        reference = spark.createDataFrame([("0", "40", "2024-01-01")], schema)
        S.route(stream, {"raw-orders": schema}, f"{tmp_dir}/out", checkpoint, DEFAULT_RULES,
                reference={"orders": reference}).awaitTermination()

    run(f"{tmp_dir}/c1")
    run(f"{tmp_dir}/c2")  # the same batch again, as after a lost commit
    out = spark.read.parquet(f"{tmp_dir}/out/processed-orders")
    assert out.count() == 5 and out.select("batch_id").distinct().count() == 1
    # the quartiles come from the reference rows (all 40), not from the batch
    assert out.where("order_amount_outlier").count() == 4
    rejects = spark.read.parquet(f"{tmp_dir}/out/rejects")
    assert sorted(r["reason"] for r in rejects.collect()) == ["no route", "not an envelope"]


def test_partitioned_write_splits_a_large_value(spark, tmp_dir):
    from retailyze.sinks.writers import write_partitioned
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("one").alias("k"))
        write_partitioned(df, f"{tmp_dir}/p", ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    import os
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{tmp_dir}/p/k=one")) > 1
    assert math.isclose(spark.read.parquet(f"{tmp_dir}/p").count(), 200_000)
