"""Data-quality checks and run records (Q01-Q09).

A check result is a row ``(check, subject, value, threshold, passed)`` so that
checks from different sources can be unioned and graded together (Q07).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nan_as_null, with_stats

CHECK_SCHEMA = "check string, subject string, value double, threshold double, passed boolean"


def _check(check: str, subject: str, value: Column, threshold: float, passed: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"),
                    value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"),
                    passed.alias("passed"))


def quality_score(df: DataFrame, cols: Sequence[str] = ("category_name_1", "total_revenue"),
                  min_score: float = 90.0, fail: bool = False) -> DataFrame:
    """Q01: rows, NULL (or NaN) count of each given column, score = 100 - 10 * total
    NULLs, passed = score >= min_score. ``fail=True`` makes the job raise when
    the score is too low (checked inside the plan, no driver round trip)."""
    df = nan_as_null(df)
    aggs = [F.count(F.lit(1)).alias("record_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    a = df.agg(*aggs)
    total = sum((F.col(f"null_{c}") for c in cols), F.lit(0))
    a = a.withColumn("quality_score", (F.lit(100) - total * 10).cast("bigint"))
    a = a.withColumn("passed", F.col("quality_score") >= F.lit(min_score))
    if fail:
        a = a.withColumn("passed", F.when(F.col("passed"), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("Data quality score too low: "),
                                   F.col("quality_score").cast("string")))))
    return a


def check_min_records(df: DataFrame, n: int, subject: str = "table") -> DataFrame:
    """Q02: at least n rows."""
    c = F.count(F.lit(1))
    return df.agg(_check("min_records", subject, c, n, c >= n).alias("r")).select("r.*")


def check_required(df: DataFrame, cols: Sequence[str], subject: str = "table") -> DataFrame:
    """Q03: required columns present (schema only)."""
    rows = [("required_column", f"{subject}.{c}", 1.0 if c in df.columns else 0.0, 1.0, c in df.columns)
            for c in cols]
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def check_null_thresholds(df: DataFrame, thresholds: Mapping[str, float], subject: str = "table") -> DataFrame:
    """Q04: NULL (or NaN) share of each column, in %, at most its threshold (one
    pass). A missing column fails with value NULL."""
    df = nan_as_null(df)
    present = {c: t for c, t in thresholds.items() if c in df.columns}
    n = F.count(F.lit(1))
    structs = []
    for c, t in thresholds.items():
        if c in present:
            share = F.try_divide(F.count_if(F.col(c).isNull()).cast("double") * 100.0, n.cast("double"))
            structs.append(_check("null_threshold", f"{subject}.{c}", F.coalesce(share, F.lit(0.0)), t,
                                  F.coalesce(share, F.lit(0.0)) <= F.lit(float(t))))
        else:
            structs.append(_check("null_threshold", f"{subject}.{c}", F.lit(None), t, F.lit(False)))
    return df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def run_validations(spark: SparkSession, queries: Sequence[Mapping]) -> DataFrame:
    """Q05: each ``{"query": sql, "expected_min": n}`` is run with Spark SQL on
    the registered views; its single value is compared with the minimum. The
    results are one row each (bounded by the number of queries)."""
    parts = []
    for q in queries:
        r = spark.sql(q["query"])
        first = r.columns[0]
        parts.append(r.select(_check("sql_validation", q["query"], F.col(f"`{first}`"), q["expected_min"],
                                     F.col(f"`{first}`") >= F.lit(q["expected_min"])).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def health_checks(events: DataFrame, now: str, freshness_hours: float = 12, min_daily: int = 100,
                  max_error_rate: float = 0.05, ts: str = "ts", kind: str = "event_type",
                  error_value: str = "error") -> DataFrame:
    """Q06: data freshness (hours since the newest row <= limit), the smallest
    daily row count (>= minimum) and the error share (<= maximum).

    Days are counted on a spine from the first row's day to the last one that began
    before ``now``, so a day without rows counts 0. An empty table fails the first two checks (no age, a
    count of 0) and has an error share of 0."""
    t = F.col(ts).cast("timestamp")
    now_ts = F.lit(now).cast("timestamp")
    daily = events.where(t.isNotNull()).groupBy(F.to_date(t).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    last = F.to_date(now_ts - F.expr("INTERVAL 1 MICROSECOND"))
    first = daily.agg(F.least(F.min("_d"), last).alias("_first"))
    # one row per calendar day; an empty table has the last one alone
    spine = first.select(F.explode(F.sequence(F.coalesce("_first", last), last)).alias("_day"))
    d = spine.join(daily, F.col("_day") == F.col("_d"), "left").agg(F.min(F.coalesce("_n", F.lit(0))).alias("_min_daily"))
    a = events.agg(F.max(t).alias("_max_ts"),
                   F.try_divide(F.count_if(F.col(kind) == F.lit(error_value)).cast("double"),
                                F.count(F.lit(1)).cast("double")).alias("_err"))
    age_h = (F.unix_micros(now_ts) - F.unix_micros(F.col("_max_ts"))).cast("double") / 3.6e9
    j = with_stats(a, d).withColumn("_err", F.coalesce("_err", F.lit(0.0)))
    fresh = F.coalesce(age_h <= F.lit(float(freshness_hours)), F.lit(False))
    return j.select(F.explode(F.array(
        _check("data_freshness_hours", ts, age_h, freshness_hours, fresh),
        _check("min_daily_records", ts, F.col("_min_daily"), min_daily, F.col("_min_daily") >= min_daily),
        _check("max_error_rate", kind, F.col("_err"), max_error_rate, F.col("_err") <= F.lit(max_error_rate)),
    )).alias("r")).select("r.*")


def grade_checks(checks: DataFrame) -> DataFrame:
    """Q07: share of passed checks in % and its grade: excellent >= 90,
    good >= 70, fair >= 50, else poor."""
    a = checks.agg(F.count(F.lit(1)).alias("total_checks"),
                   F.count_if(F.col("passed")).alias("passed_checks"))
    share = F.try_divide(F.col("passed_checks").cast("double"), F.col("total_checks").cast("double")) * 100.0
    grade = (F.when(share >= 90, "excellent").when(share >= 70, "good")
              .when(share >= 50, "fair").otherwise("poor"))
    return a.select("total_checks", "passed_checks", share.alias("passed_pct"), grade.alias("grade"))


def run_record(metrics: Mapping[str, float], run_id: str, status: str = "SUCCESS",
               spark: SparkSession | None = None) -> DataFrame:
    """Q08: one run record row - id, status, step counts and score as a map,
    completion time. ``metrics`` are small per-step numbers collected with
    ``DataFrame.observe`` by the caller."""
    spark = spark or SparkSession.active()
    m = {k: float(v) for k, v in metrics.items()}
    df = spark.createDataFrame([(run_id, status, m)], "pipeline_run string, status string, "
                               "metrics map<string,double>")
    return df.withColumn("completion_time", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))


def observe_counts(df: DataFrame, name: str):
    """Attach a row-count observation to ``df``; returns (df, observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def register_dataset(spark: SparkSession, table: str, name: str, source_type: str, source_path: str,
                     metadata: Mapping | None = None, dataset_id: str | None = None) -> DataFrame:
    """Q09: append a registry row (id, name, source, record count, status,
    metadata JSON) to a catalog table. csv, json and parquet sources are read
    with Spark to count rows."""
    reader = {"csv": lambda p: spark.read.option("header", True).csv(p),
              "json": lambda p: spark.read.json(p),
              "parquet": lambda p: spark.read.parquet(p)}
    if source_type not in reader:
        raise ValueError(f"unsupported source type {source_type!r}")
    data = reader[source_type](source_path)
    row = data.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(dataset_id or str(uuid.uuid4())).alias("id"), F.lit(name).alias("name"),
        F.lit(source_type).alias("source_type"), F.lit(source_path).alias("source_path"),
        F.current_timestamp().alias("last_updated"), "record_count",
        F.lit("active").alias("status"), F.lit(json.dumps(dict(metadata or {}))).alias("metadata"))
    row.write.mode("append").saveAsTable(table)
    return spark.table(table)
