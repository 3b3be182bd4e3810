"""Streams cut differently give the same statistics; exports compute a section once."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from retailyze.operators.rules import DEFAULT_RULES, clean
from retailyze.sinks import writers as W
from retailyze.streaming import ingest as S
from retailyze.streaming.running import RunningStatistics

SCHEMA = "order_id string, order_amount string, product_price string, order_date string, product_category string, quantity double"


def messages(spark):
    rows = []
    for i in range(60):
        amount = None if i % 7 == 0 else f"{i % 9 + 1}.{i % 10}00,5" if i % 2 else f"{i % 9 + 1}.{i % 10}00"
        date = f"{i % 28 + 1}/{i % 12 + 1}/2024"
        rows.append({"order_id": str(i % 50), "order_amount": amount, "product_price": "3,50", "order_date": date,
                     "product_category": None if i % 5 == 0 else "ab"[i % 3 == 0], "quantity": float(i) if i < 58 else 900.0})
    return [json.dumps({"timestamp": f"2024-01-01T00:00:{i:02d}", "data": r}) for i, r in enumerate(rows)]


def run(spark, texts, batches, root, out, checkpoint):
    schema = spark.createDataFrame([], SCHEMA).schema
    for k in range(batches):
        part = [("raw-orders", t) for t in texts[k::batches]]
        spark.createDataFrame(part, "topic string, value string").coalesce(1).write.mode("overwrite").parquet(f"{root}/in/{k}")
    stream = (spark.readStream.schema("topic string, value string").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    S.route(stream, {"raw-orders": schema}, out, checkpoint, DEFAULT_RULES).awaitTermination()


def rows_of(df):
    cols = sorted(c for c in df.columns if c != "batch_id")
    return sorted(map(str, df.select(*cols).collect()))


def state(spark, out, name, keys):
    seen = spark.read.parquet(f"{out}/state/orders/{name}")
    return rows_of(seen.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in seen.columns if c not in [*keys, "batch_id"]]))


def test_batches_do_not_change_the_statistics(spark, tmp_dir):
    texts, settled, votes = messages(spark), [], []
    for n in (1, 3):
        root = f"{tmp_dir}/{n}"
        run(spark, texts, n, root, f"{root}/out", f"{root}/c1")
        assert spark.read.parquet(f"{root}/out/processed-orders").select("batch_id").distinct().count() == n
        S.settle(spark, "orders", f"{root}/out", f"{root}/settled")
        settled.append(rows_of(spark.read.parquet(f"{root}/settled")))
        votes.append([state(spark, f"{root}/out", name, ["c"]) for name in ("date_votes", "amount_votes")])
        before = rows_of(spark.read.parquet(f"{root}/out/processed-orders"))
        counts = state(spark, f"{root}/out", "counts", ["c", "v"])
        run(spark, texts, n, root, f"{root}/out", f"{root}/c2")  # every batch again
        assert rows_of(spark.read.parquet(f"{root}/out/processed-orders")) == before
        assert state(spark, f"{root}/out", "counts", ["c", "v"]) == counts
    assert settled[0] == settled[1] and len(settled[0]) == 50


def test_statistics_of_batches_are_those_of_all_rows(spark, tmp_dir):
    rows = [(float(i % 11) if i % 4 else None, "xyz"[i % 3] if i % 5 else None, f"{i % 28 + 1}/3/2024", f"{i}.5") for i in range(200)]
    df = spark.createDataFrame(rows, "a double, m string, d string, p string")
    fills = {"a": "mean", "m": "mode"}
    for k in range(4):
        part = spark.createDataFrame(rows[k * 50:(k + 1) * 50], df.schema)
        running = RunningStatistics(f"{tmp_dir}/s", k)
        got = running.statistics(part, fills, ["a"]).first()
        assert running.date_votes(part, ["d"]).first()["d"] is True
        assert running.amount_votes(part, ["p"]).first()["p"] is False
    whole = RunningStatistics(f"{tmp_dir}/w", 0).statistics(df, fills | {"a": "median"}, ["a"]).first()
    mean = df.agg(F.avg("a")).first()[0]
    assert got["_mean_a"] == pytest.approx(mean, abs=1e-12) and got["_mode_m"] == whole["_mode_m"]
    assert (got["_lo_a"], got["_hi_a"]) == (whole["_lo_a"], whole["_hi_a"])
    assert whole["_median_a"] == df.selectExpr("median(a)").first()[0]
    empty = RunningStatistics(f"{tmp_dir}/e", 0).statistics(df.limit(0), fills, ["a"]).first()
    assert empty["_mean_a"] is None and empty["_mode_m"] is None and empty["_lo_a"] is None
    assert clean(spark.createDataFrame([], SCHEMA), DEFAULT_RULES, "orders", timestamp_col=False).count() == 0


def test_a_section_in_two_formats_is_computed_once(spark, tmp_dir):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    both = spark.range(0, 40, 1, 4).mapInArrow(seen, "id long")
    one = spark.range(0, 7, 1, 1).mapInArrow(seen, "id long")
    paths = W.export_bundle({"both": both, "one": one}, f"{tmp_dir}/b", csv_sections=["both"])
    assert made.value == 47
    assert spark.read.option("header", True).csv(paths["both"]).count() == 40
    assert spark.read.json(f"{paths['complete_analytics']}/both").count() == 40
    assert spark.read.json(f"{paths['complete_analytics']}/one").count() == 7


def test_a_failed_publication_leaves_the_old_rows(spark, tmp_dir):
    name = "swap_test"
    W.write_table(spark.range(5), name)
    assert spark.table(name).count() == 5
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        W.write_table(bad, name)
    assert spark.table(name).count() == 5
    for n in (6, 7, 8):
        W.write_table(spark.range(n), name)
        assert spark.table(name).count() == n
    versions = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__v")]
    assert len(versions) <= 3
    # a plain table of that name is taken over
    spark.range(3).write.saveAsTable("swap_plain")
    W.write_table(spark.range(4), "swap_plain")
    assert spark.table("swap_plain").count() == 4
    assert W.publish_dataset(spark, spark.range(9).toDF("a b"), "swap", f"{tmp_dir}/csv") == "processed_data_swap"
    assert spark.table("processed_data_swap").count() == spark.read.option("header", True).csv(f"{tmp_dir}/csv").count() == 9
