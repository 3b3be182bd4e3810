"""Operators that read a table once, and steps whose generated code the JVM compiles."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from datetime import datetime
from decimal import Decimal

import pytest

from retailyze.functions import amounts, layouts
from retailyze.operators import clean as C
from retailyze.operators import profile as PR
from retailyze.operators import sales as G
from retailyze.operators import windows as N
from retailyze.plans import QUERIES, fixtures

SCHEMA = ("order_id string, customer string, category string, product_name string, order_date timestamp, "
          "sales decimal(18,4), profit decimal(18,4)")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    money = lambda: rng.choice([None, Decimal(rng.randrange(-50, 400))])
    out = [(str(i % 40), rng.choice([None, "x", "y", "z"]), rng.choice([None, "a", "b"]), rng.choice([None, "p", "q", "r"]),
            rng.choice([None, datetime(2024, rng.randrange(1, 13), 5)]), money(), money()) for i in range(90)]
    return out + out[:25] + [(None,) * 7] * 3


@pytest.fixture()
def counted(spark, rows):
    """The rows as a table, and how often a row of it has been read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, SCHEMA).repartition(3).mapInArrow(count, SCHEMA), seen


def test_duplicates_by_value_read_once(counted, rows):
    df, seen = counted
    assert Counter(map(tuple, C.dedup_rows(df, reread=False).collect())) == Counter(set(rows))
    assert seen.value == len(rows)


def test_quality_report_reads_once(counted, rows):
    df, seen = counted
    got = tuple(G.quality_report(df, reread=False).first())
    assert got == (len(rows), 7, sum(v is None for r in rows for v in r), len(rows) - len(set(rows)))
    assert seen.value == len(rows)
    assert tuple(G.quality_report(df.limit(0), reread=False).first()) == (0, 7, 0, 0)


def test_upload_cleaning_reads_once(spark, monkeypatch, counted, rows):
    from retailyze.plans import q_profile
    df, seen = counted
    monkeypatch.setattr(q_profile, "dirty_sales", lambda *_: df.selectExpr(
        "order_id", "1 AS line_no", "cast(order_date AS date) AS order_date", "cast(order_date AS date) AS ship_date", "customer", "category",
        "product_name", "cast(sales AS string) AS sales", "cast(profit AS string) AS profit", "cast(sales AS string) AS discount"))
    got = q_profile.g50(spark, "").first()
    assert got["rows"] == len(set(rows)) and got["duplicate_rows"] == 0
    assert seen.value == len(rows)


def test_cleaning_summary_reads_once(counted, rows):
    df, seen = counted
    columns = ("sales", "profit", "profit")
    got = G.cleaning_summary(df, *columns, reread=False)
    first = got.first()
    assert seen.value == len(rows)
    stored = df.sparkSession.createDataFrame(rows, SCHEMA)
    assert got.schema == G.cleaning_summary(stored, *columns).schema
    assert first == G.cleaning_summary(stored, *columns).first()
    assert first["duplicate_rows"] == len(rows) - len(set(rows)) and first["total_sales"] == sum(r[5] or 0 for r in rows)
    fine = stored.selectExpr("cast(sales AS decimal(38,12)) / 7 AS sales", "cast(order_id AS double) AS profit", "cast(order_id AS int) AS discount")
    assert G.cleaning_summary(fine, reread=False).collect() == G.cleaning_summary(fine).collect()
    assert G.cleaning_summary(stored.limit(0), *columns, reread=False).collect() == G.cleaning_summary(stored.limit(0), *columns).collect()


def star_tables(spark, folder):
    """Few rows with null and repeated keys; keys without a partner."""
    day = datetime(2024, 5, 6)
    tables = {
        "lineitem": ([(k, p, n, 2.0, 10.5, 0.05, day) for k in (1, 1, 2, 23, 46, 99, None) for p in (1, 2, 7, None) for n in (1, 2)],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"),
        "orders": ([(1, 1, "O", day, "5-LOW"), (1, 2, None, None, "1-URGENT"), (2, None, "O", day, "x"), (23, 2, "O", day, "x"), (46, 9, "F", day, "x"), (None, 1, "F", day, "x")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "part": ([(1, "p", "b", "t", 3.0), (1, "p", "b", "t", 3.0), (2, None, None, None, None), (None, "n", "b", "t", 1.0)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
        "customer": ([(1, "c", 0), (2, None, 0), (2, "d", 1), (3, "e", None), (None, "f", 0)], "c_custkey long, c_name string, c_nationkey int"),
        "nation": ([(0, "N", 0), (1, "M", 0)], "n_nationkey int, n_name string, n_regionkey int"), "region": ([(0, "R")], "r_regionkey int, r_name string")}
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_by_order_are_the_same(spark, tmp_dir, broadcast):
    star_tables(spark, tmp_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if broadcast else "-1")
    try:
        plain, by_order = (Counter(map(tuple, fixtures.dirty_sales(spark, tmp_dir, x).collect())) for x in (False, True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plain and plain == by_order


def test_cleaning_summary_shuffles_no_whole_rows(spark, tmp_dir):
    """With joins that shuffle, rows are dealt by the keys of the joins alone: for both
    groupings by value they lie right, and nothing is stored."""
    star_tables(spark, tmp_dir)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = QUERIES["g50_cleaning_summary"](spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\), ", plan)]
    assert set(keys) == {"l_partkey", "p_partkey", "o_custkey", "c_custkey", "cast(l_orderkey as string)", "cast(o_orderkey as string)"}
    assert "ExistingRDD" not in plan


def test_business_summary_reads_once(counted, rows):
    df, seen = counted
    got = G.business_summary(df).first()
    sums = {k: defaultdict(Decimal) for k in "cm"}
    for r in rows:
        if r[2] is not None:
            sums["c"][r[2]] += r[5] or 0
        if r[4] is not None:
            sums["m"][r[4].month] += r[5] or 0
    sold = [r[5] for r in rows if r[5] is not None]
    top = lambda k, f: f((s, key) for key, s in sums[k].items())[1]
    assert got["best_category"] == top("c", max) and got["worst_category"] == top("c", min) and got["best_month"] == str(top("m", max))
    assert got["customers"] == 3 and got["avg_sales"] == float(sum(sold)) / len(sold)
    assert got["profit_margin"] == float(sum(r[6] or 0 for r in rows)) / float(sum(sold)) * 100.0
    assert seen.value == len(rows)
    none = G.business_summary(df.limit(0)).first()
    assert tuple(none) == (0.0, "N/A", "N/A", "N/A", 0, None)


def test_segments_read_once(counted, rows):
    df, seen = counted
    got = G.customer_segments(df).collect()
    assert sum(r["customers"] for r in got) == 3
    assert seen.value == len(rows)


def test_histogram_reads_once(counted, rows):
    df, seen = counted
    got = G.histogram(df, "sales", 4, with_median=True).collect()
    sold = sorted(float(r[5]) for r in rows if r[5] is not None)
    assert sum(r["count"] for r in got) == len(sold)
    assert {r["median"] for r in got} == {(sold[(len(sold) - 1) // 2] + sold[len(sold) // 2]) / 2}
    assert seen.value == len(rows)


def test_odd_outliers_read_once(spark, monkeypatch, counted, rows):
    from retailyze.plans import q_odd
    df, seen = counted
    monkeypatch.setattr(q_odd, "odd_sales", lambda *_: df.selectExpr(
        "order_id", "1 AS line_no", "customer", "cast(profit AS double) AS profit", "cast(sales AS string) AS noted"))
    assert len(q_odd.c15_odd(spark, "").collect()) == len(rows)
    assert seen.value == len(rows)


@pytest.mark.parametrize("k", [None, 2])
def test_pareto_reads_once(counted, rows, k):
    df, seen = counted
    got = N.abc_analysis(df, k).collect()
    sums = Counter()
    for r in rows:
        if r[3] is not None:
            sums[r[3]] += r[5] or 0
    assert [(r["product_name"], r["sales"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted(
        sums.items(), key=lambda x: (-x[1], x[0]))[:k]
    assert seen.value == len(rows)


def test_column_profile_reads_twice(counted, rows):
    """Once for whole numbers and dates (here order_id as a number and the day), once for the rest."""
    df, seen = counted
    got = PR.column_profile(df.selectExpr("cast(order_id AS int) AS order_id", "cast(order_date AS date) AS day", "customer", "sales"))
    expected = [{r[0] and int(r[0]) for r in rows}, {r[4] for r in rows}, {r[1] for r in rows}, {r[5] for r in rows}]
    assert [r["distinct_values"] for r in sorted(got.collect(), key=lambda r: r["position"])] == [len(x) for x in expected]
    assert seen.value == 2 * len(rows)
    assert [r["distinct_values"] for r in PR.column_profile(df.limit(0)).collect()] == [0] * 7


def largest_method(df) -> int:
    """Bytes of the largest method that Spark generates for a plan; the JVM leaves methods
    of more than 8,000 to its interpreter."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_steps_of_dates_and_amounts_are_compiled(spark):
    names = ["a", "b", "c"]
    df = spark.range(10).selectExpr("id", *[f"cast(id AS string) AS {n}" for n in names])
    votes = spark.range(1).selectExpr(*[f"true AS {n}" for n in names])
    assert largest_method(amounts.parse_amounts(df, names, votes=votes)) < 8000
    assert largest_method(layouts.parse_dates(df, names, votes=votes)) < 8000


@pytest.mark.parametrize("name", ["c05_voted_date_layouts", "c14_voted_date_types", "c20_voted_amounts"])
def test_voted_queries_are_compiled(spark, name):
    assert largest_method(QUERIES[name](spark, "/root/testdata/sf0.001")) < 8000


def listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def expressions(e):
    return [e, *(x for c in listed(e.children()) for x in expressions(c))]


def plan_expressions(plan):
    """Every expression of a plan, those inside others too."""
    return [x for e in listed(plan.expressions()) for x in expressions(e)] + [x for c in listed(plan.children()) for x in plan_expressions(c)]


def test_date_patterns_are_compiled_once(spark):
    """A pattern that is no constant is compiled again whenever it differs from the last
    one: with columns of both orders, twice a row."""
    names = ["us", "eu"]
    df = spark.range(10).selectExpr("id", *[f"cast(id AS string) AS {n}" for n in names])
    votes = df.selectExpr("max(id) < 0 AS us", "max(id) > 0 AS eu")
    plan = layouts.parse_dates(df, names, votes=votes)._jdf.queryExecution().analyzed()
    found = [e for e in plan_expressions(plan) if e.getClass().getSimpleName() == "RegExpReplace"]
    assert found and all(e.regexp().foldable() for e in found)


def test_dates_of_all_shapes(spark):
    shapes = {"5/3/16": "2016-05-03|2016-03-05", "05-03-69 7:05": "1969-05-03 07:05|1969-03-05 07:05", "31.1.2016": "|2016-01-31",
              "1/31/2016 1:05 pm": "2016-01-31 13:05|", "20160305": "2016-03-05", "2016/3/5": "2016-03-05", "2016-3-5": "2016-03-05",
              "SEPT. 5, 2016": "2016-09-05", "5 - december, 2016 10:30": "2016-12-05 10:30", "5-May-2016": "2016-05-05",
              "Feb 30, 2016": "", "30 February 2016": "", "2016-anf-05": "", "Janu 5, 2016": "", "Jan 0, 2016": "", "12:30": "", "": "",
              "5/3/16x": "", "2016-Oct-5": "2016-10-05", "2016-oct-5x": "", "2016-Oct-5 PM": "", None: ""}
    df = spark.createDataFrame([(s, s) for s in shapes], "us string, eu string")
    votes = spark.range(1).selectExpr("false AS us", "true AS eu")
    got = layouts.parse_dates(df, ["us", "eu"], votes=votes).selectExpr(*[f"substr(cast({c} AS string), 1, 16)" for c in ("us", "eu")])
    for (text, dates), row in zip(shapes.items(), got.collect()):
        us, eu = (d and (d + " 00:00")[:16] for d in (dates.split("|") * 2)[:2])
        assert (row[0] or "", row[1] or "") == (us, eu), text
