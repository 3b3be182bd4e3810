"""Properties of the analytics on the driver tables, and plan-shape checks."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailyze.functions.ordered import exact_quantiles
from retailyze.plans import QUERIES
from retailyze.plans.fixtures import sales_fact


def _q(spark, name):
    return QUERIES[name](spark, SF_SMALL).toPandas()


def test_bins_cover_every_row(spark):
    n = sales_fact(spark, SF_SMALL).count()
    assert _q(spark, "g23_discount_impact")["rows"].sum() == n
    assert _q(spark, "g32_sales_histogram")["count"].sum() == n
    assert _q(spark, "g32_margin_histogram")["count"].sum() == n


def test_shares_sum_to_100(spark):
    assert abs(_q(spark, "g11_payment_share")["share_pct"].sum() - 100.0) < 1e-9
    assert abs(_q(spark, "g21_top_regions_share")["share_pct"].sum() - 100.0) < 1e-9
    abc = _q(spark, "n03_abc_class").sort_values("rank")
    assert abs(abc["cumulative_percent"].iloc[-1] - 100.0) < 1e-9
    assert abc["cumulative_sales"].is_monotonic_increasing


def test_rollup_parents_equal_children(spark):
    h = _q(spark, "g31_product_hierarchy")
    total = h[h.level == "total"]["sales"].iloc[0]
    cats = h[h.level == "category"].set_index("category")["sales"]
    subs = h[h.level == "subcategory"].groupby("category")["sales"].sum()
    assert abs(cats.sum() - total) < 1e-6
    assert (abs(cats - subs.reindex(cats.index)) < 1e-6).all()


def test_segments_partition_the_customers(spark):
    seg = _q(spark, "g30_customer_segments")
    n = sales_fact(spark, SF_SMALL).select("customer").distinct().count()
    assert seg["customers"].sum() == n and len(seg) == 3


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, xs, probs):
    df = spark.createDataFrame(pd.DataFrame({"x": [float(x) for x in xs]}))
    row = exact_quantiles(df, "x", probs).first()
    for i, p in enumerate(probs):
        assert row[f"q_{i}"] == float(np.quantile(np.asarray(xs, dtype=float), p))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_the_scan(spark):
    plan = _plan(QUERIES["g05_sales_by_category"](spark, SF_SMALL))
    lineitem_schema = [line for line in plan.splitlines() if "lineitem" in line]
    assert lineitem_schema and all("l_tax" not in line and "l_returnflag" not in line
                                   for line in lineitem_schema)


def test_filter_pushdown_to_the_scan(spark):
    plan = _plan(QUERIES["c03_explore_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(p_type), In(p_type" in plan or "In(p_type, [ECONOMY,SMALL])" in plan


def test_statistics_need_no_cartesian_join(spark):
    for name in ["g22_profitability", "g30_customer_segments", "g23_discount_impact", "c15_outliers_iqr",
                 "a06_executive_summary"]:
        df = QUERIES[name](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_profile_is_one_aggregation_job(spark):
    df = QUERIES["a09_column_profile"](spark, SF_SMALL)
    plan = _plan(df)
    assert plan.count("Expand") == 0  # no multi-distinct expansion
