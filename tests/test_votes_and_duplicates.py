"""Whole-row duplicates, voted date layouts and amounts, exact distinct counts, odd values."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from retailyze.functions import rowhash
from retailyze.functions.ordered import quantiles_of, ranked_values
from retailyze.operators import clean as C
from retailyze.operators import profile as PR
from retailyze.operators import quality as Q
from retailyze.operators import sales as G


def clash(df):
    """A fingerprint that most rows share."""
    return [F.pmod(F.xxhash64(*df.columns), F.lit(3))]


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([0.0, -0.0, float("nan"), 1.5])) for _ in range(60)]
    rows += [(i, "once", 2.5) for i in range(10, 40)] + [(7, "often", None)] * 100 + [(None, "x", None), ("x" and None, None, None)]
    return rows, spark.createDataFrame(rows, "a int, b string, c double").repartition(4)


def key(r):
    c = r[2]
    return (r[0], r[1], "nan" if c is not None and c != c else c if c is None else c + 0.0)


@pytest.mark.parametrize("fingerprint", [rowhash.row_fingerprint, clash])
@pytest.mark.parametrize("limit", [0, 1_000])
def test_duplicates_are_exact_whatever_the_hash_does(copies, fingerprint, limit):
    rows, df = copies
    n = Counter(map(key, rows))
    kept = rowhash.distinct_rows(df, fingerprint, limit)
    assert sorted(map(str, map(key, kept.collect()))) == sorted(map(str, n))
    assert rowhash.repeated_row_count(df, fingerprint, limit).first()[0] == sum(n.values()) - len(n)


def test_only_repeated_rows_are_shuffled(copies):
    _, df = copies
    plan = C.dedup_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan


def test_maps_nested_values_and_empty_tables(spark):
    rows = [(1, {"a": 1, "b": 2}, [{"x": 1}]), (1, {"b": 2, "a": 1}, [{"x": 1}]), (1, {"a": 1}, None), (1, None, None), (1, None, None)]
    df = spark.createDataFrame(rows, "k int, m map<string,int>, l array<map<string,int>>")
    assert C.dedup_rows(df).count() == 3
    assert C.dedup_rows(df.select("m")).count() == 3
    assert C.dedup_by(df, ["k"]).count() == 1
    assert C.dedup_by(df, ["m"]).count() == 3
    assert G.quality_report(df).first()["duplicate_rows"] == 2
    empty = df.limit(0)
    assert C.dedup_rows(empty).count() == 0 and tuple(G.quality_report(empty).first()) == (0, 3, 0, 0)


def test_null_positions_are_part_of_the_fingerprint(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert df.select(F.struct(*rowhash.row_fingerprint(df)).alias("f")).distinct().count() == 2


DATES = {"13/11/2016": "2016-11-13", "20161108": "2016-11-08", "Nov 8, 2016": "2016-11-08", "08-Nov-2016": "2016-11-08",
         "8.11.2016": "2016-11-08", "11/8/16": "2016-08-11", "1/2/69": "1969-02-01", "1/2/68": "2068-02-01", "31/02/2016": None,
         "2016/11/8 4:05": "2016-11-08 04:05:00", "25-12-2016 13:05:09": "2016-12-25 13:05:09", "1/2/2016 12:04 AM": "2016-02-01 00:04:00",
         "1/2/2016 3:04 pm": "2016-02-01 15:04:00", "sept 3 2016": "2016-09-03", "3 March 2016": "2016-03-03", "Noz 8, 2016": None,
         " 2016-11-08 ": "2016-11-08", "2016-11-08T10:00:00": "2016-11-08 10:00:00", "12:30": None, "": None, "n/a": None, None: None,
         "2016-13-01": None, "20161308": None}


def test_day_first_column(spark):
    df = spark.createDataFrame([(k, k) for k in DATES], "raw string, order_date string").repartition(3)
    got = {r["raw"]: r["order_date"] for r in C.coerce_dates(df).collect()}
    for raw, expected in DATES.items():
        assert got[raw] == (datetime.fromisoformat(expected) if expected else None), raw


def test_ties_are_read_month_first_and_columns_vote_apart(spark):
    df = spark.createDataFrame([("1/2/2016", "1/2/2016"), ("3/4/2016", "14/2/2016")], "order_date string, ship_date string")
    got = C.coerce_dates(df).select(F.month("order_date"), F.month("ship_date")).collect()
    assert [tuple(r) for r in got] == [(1, 2), (3, 2)]
    assert C.coerce_dates(df.limit(0)).count() == 0
    assert G.date_range(df, "ship_date").first()[0] == "2016-02-01 to 2016-02-14"


AMOUNTS = {"1e3": 1000, "1.5E-1": 0.15, "12.50": 12.5, "(12.50)": -12.5, "-$3": -3, "$-3": -3, "4-": -4, "EUR 7": 7, "Rs. 500": 500,
           "1'000.25": 1000.25, "1 234.5": 1234.5, "0.125": 0.13, ".5": 0.5, "n/a": None, "": None, "12-34": None, "1.2.3": None,
           "1,23,456": None, "5 apples": 5, None: None}


def test_amounts_by_the_columns_own_mark(spark):
    point = AMOUNTS | {"1,234": 1234, "1.234": 1.23, "1,234.50": 1234.5, "1,234,567": 1234567}
    swap = str.maketrans(",.", ".,")
    comma = {k if k is None or k == "Rs. 500" else k.translate(swap): v for k, v in point.items()}
    for column in (point, comma):
        df = spark.createDataFrame([(k, k) for k in column], "raw string, a string").repartition(3)
        got = {r["raw"]: r["a"] for r in C.std_currency(df, ["a"]).collect()}
        for raw, expected in column.items():
            assert (got[raw] is None) == (expected is None) and (expected is None or float(got[raw]) == expected), raw
    odd = C.std_currency(spark.createDataFrame([("1.234",), ("5",)], "a string"), ["a"]).collect()
    assert [float(r["a"]) for r in odd] == [1.23, 5.0]  # nothing tells: a point


def test_distinct_counts_of_all_types(spark):
    n = 4000
    df = spark.range(n).select(
        (F.col("id") % 7).cast("int").alias("small"), F.when(F.col("id") % 3 > 0, F.col("id") * 1000).alias("wide"),
        (F.col("id") * (1 << 40)).alias("sparse"), (F.col("id") * 40 - 2_000_000).alias("dense"), (F.col("id") % 2 == 0).alias("flag"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 5 == 1, F.lit(-0.0)).otherwise((F.col("id") % 5 - 2).cast("double")).alias("real"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 11)).alias("text"), (F.col("id") % 9).cast("decimal(12,3)").alias("money"),
        (F.col("id") / 3).cast("decimal(30,9)").alias("broad"), F.expr("date'2020-01-31' + cast(id % 40 as int)").alias("day"),
        F.timestamp_seconds("id").alias("at"), F.lit(None).cast("bigint").alias("nothing"), F.array("id").alias("list"))
    got = {r["column_name"]: (r["distinct_values"], r["null_count"]) for r in PR.column_profile(df.repartition(3)).collect()}
    assert got == {c: (df.select(c).distinct().count(), df.where(F.col(c).isNull()).count()) for c in df.columns}
    assert {(r[2], r[3]) for r in PR.column_profile(df.limit(0)).collect()} == {(0, 0)}


def test_bitmap_columns_make_no_row_per_cell(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("a"), (F.col("id") % 9).cast("int").alias("b"))
    plan = PR.column_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "hashpartitioning(position" not in plan


def test_health_of_days_without_rows_and_of_nothing(spark):
    e = spark.createDataFrame([("2024-01-01 05:00:00", "ok")] * 3 + [("2024-01-03 05:00:00", "error")], "ts string, event_type string")

    def run(df, now):
        return {r["check"]: (r["value"], r["passed"]) for r in Q.health_checks(df, now, min_daily=1).collect()}

    assert run(e, "2024-01-03 06:00:00")["min_daily_records"] == (0.0, False)
    assert run(e.where("ts < '2024-01-02'"), "2024-01-02 00:00:00")["min_daily_records"] == (3.0, True)
    assert run(e.limit(0), "2024-01-03 06:00:00") == {
        "data_freshness_hours": (None, False), "min_daily_records": (0.0, False), "max_error_rate": (0.0, True)}


def test_order_statistics_read_the_rows_once(spark):
    df = spark.createDataFrame([("a", float(i % 50)) for i in range(3000)] + [("b", 1.0)] * 500, "category string, profit double")
    out = {r["category"]: r for r in G.box_stats(df).collect()}
    assert (out["a"]["n"], out["a"]["min"], out["a"]["max"], out["b"]["whisker_lo"]) == (3000, 0.0, 49.0, 1.0)
    rows = ranked_values(df, "profit", ["category"], sums=["profit"])
    assert rows.count() == 51 and rows.agg(F.sum("_sum_profit")).first()[0] == df.agg(F.sum("profit")).first()[0]
    assert quantiles_of(rows, [0.5], ["category"]).where("category = 'b'").first()["q_0"] == 1.0


def test_correlation_keeps_shifted_digits_and_has_none_with_a_constant(spark):
    df = spark.createDataFrame([(1e9 + i, 1e9 - 2 * i, 5.0) for i in range(50)] + [(float("inf"), 1.0, 5.0), (None, 1.0, 5.0)],
                               "sales double, profit double, fixed double")
    r = G.correlation(df).first()
    assert r["n"] == 50 and r["correlation"] == pytest.approx(-1.0, abs=1e-12)
    assert G.correlation(df, "sales", "fixed").first()["correlation"] is None
    assert G.correlation(df.limit(0)).first()["n"] == 0
