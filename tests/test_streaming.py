"""Structured Streaming ingest (T01-T07) on file streams built from the driver tables."""

import os

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from retailyze.operators.rules import DEFAULT_RULES
from retailyze.plans.fixtures import config_orders, orders_fact, table
from retailyze.sinks.writers import to_envelope
from retailyze.streaming import ingest as S

ORDER_COLS = ["item_id", "status", "category_name_1", "payment_method", "grand_total"]


def _orders(spark):
    return orders_fact(spark, SF_SMALL).select(
        *ORDER_COLS[:-1], F.col("grand_total").cast("double").alias("grand_total"), "created_at")


def _envelope_files(spark, out):
    o = _orders(spark)
    env = to_envelope(o, ts="created_at")
    env.repartition(4).write.mode("overwrite").text(out)
    return o


def test_ingest_parse_and_land(spark, tmp_dir):
    o = _envelope_files(spark, f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/zz-bad.txt", "w") as f:
        f.write("{broken json\n")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).text(f"{tmp_dir}/in")
    rows, rejects = S.parse_envelope(stream, o.drop("created_at").schema)
    q = S.land(rows, f"{tmp_dir}/landing", f"{tmp_dir}/ck_land")
    q.awaitTermination()
    r = S.ingest_once(rejects, f"{tmp_dir}/rejects", f"{tmp_dir}/ck_rej", fmt="json")
    r.awaitTermination()
    landed = spark.read.parquet(f"{tmp_dir}/landing")
    assert landed.count() == o.count()
    assert "dt" in landed.columns
    assert any(p.startswith("dt=") for p in os.listdir(f"{tmp_dir}/landing"))
    assert spark.read.json(f"{tmp_dir}/rejects").count() == 1
    # re-running with the same checkpoint processes nothing twice
    again = S.land(S.parse_envelope(stream, o.drop("created_at").schema)[0], f"{tmp_dir}/landing",
                   f"{tmp_dir}/ck_land")
    again.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/landing").count() == o.count()


def test_hourly_summary_stream_equals_batch(spark, tmp_dir):
    ev = table(spark, SF_SMALL, "events").select(
        "ts", "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    ev.write.parquet(f"{tmp_dir}/events")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/events")
    agg = S.hourly_summary(stream, "ts", ["event_type"], "value", watermark="0 seconds")
    q = (agg.writeStream.format("memory").queryName("hourly").outputMode("complete")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("hourly").toPandas().sort_values(["window_start", "event_type"]).reset_index(drop=True)
    exp = (S.hourly_summary(ev, "ts", ["event_type"], "value").toPandas()
           .sort_values(["window_start", "event_type"]).reset_index(drop=True))
    pd.testing.assert_frame_equal(got, exp, check_dtype=False)


def test_watermark_drops_late_rows(spark, tmp_dir):
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("k", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    # Spark drops input rows against the watermark of the previous micro-batch
    # (eviction uses the current one): after batch 0 the watermark is 11:10,
    # so the 09:30 row arriving two batches later is dropped.
    batches = [
        [("2024-01-01 10:05:00", "a", 1.0), ("2024-01-01 12:10:00", "a", 2.0)],
        [("2024-01-01 14:00:00", "a", 3.0)],
        [("2024-01-01 09:30:00", "a", 100.0), ("2024-01-01 15:00:00", "a", 4.0)],  # 09:30 is late
    ]
    for i, b in enumerate(batches):
        # one file per batch, the late batch strictly newer: a fixed arrival order
        spark.createDataFrame(pd.DataFrame(b, columns=["ts", "k", "v"]).assign(
            ts=lambda d: pd.to_datetime(d.ts))).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src/b{i}")
        for root, _, files in os.walk(f"{tmp_dir}/src/b{i}"):
            for f in files:
                t = 1_700_000_000 + i * 100
                os.utime(os.path.join(root, f), (t, t))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/src"))
    agg = S.hourly_summary(stream, "ts", ["k"], "v", watermark="1 hour")
    q = (agg.writeStream.format("memory").queryName("late").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.table("late").toPandas()
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    assert 100.0 not in set(out["total_value"])
    assert "2024-01-01 10:00:00" in set(out["window_start"])


def test_dedup_within_watermark(spark, tmp_dir):
    o = _orders(spark).withColumn("event_time", F.col("created_at").cast("timestamp"))
    o.unionByName(o.where(F.col("item_id").endswith("-1"))).write.parquet(f"{tmp_dir}/dups")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_dir}/dups").schema).parquet(f"{tmp_dir}/dups")
    d = S.dedup_stream(stream, ["item_id"], "event_time", "1 hour")
    q = S.ingest_once(d, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == o.select("item_id").distinct().count()


def test_route_cleans_per_topic(spark, tmp_dir):
    co = config_orders(spark, SF_SMALL)
    env = to_envelope(co).withColumn("topic", F.lit("raw-orders"))
    env.write.parquet(f"{tmp_dir}/msgs")
    stream = spark.readStream.schema(env.schema).parquet(f"{tmp_dir}/msgs")
    q = S.route(stream, {"raw-orders": co.schema}, f"{tmp_dir}/out", f"{tmp_dir}/ck", DEFAULT_RULES)
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out/processed-orders")
    n_orders = co.select("order_id").distinct().count()
    undated = co.where(F.col("order_date").isNull()).select("order_id").distinct().count()
    assert out.count() == n_orders - undated  # one row per order, undated orders dropped
    assert out.where(F.col("customer_name").isNull()).count() == 0
    assert {"order_year", "customer_segment", "order_amount_outlier"} <= set(out.columns)


def test_replay_in_batches_of_100(spark, tmp_dir):
    o = _orders(spark).limit(450)
    S.replay_files(o.coalesce(1), f"{tmp_dir}/replay", batch=100)
    stream = S.replay_stream(spark, f"{tmp_dir}/replay", o.schema)
    q = S.ingest_once(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert max(sizes) <= 100 and sum(sizes) == 450


def test_hourly_category_payment_summary_on_order_stream(spark, tmp_dir):
    # the hourly category x payment summary of the order flow, fed by envelopes
    o = _orders(spark)
    env = to_envelope(o, ts="created_at")
    env.repartition(3).write.mode("overwrite").text(f"{tmp_dir}/in")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{tmp_dir}/in")
    rows, _ = S.parse_envelope(stream, o.drop("created_at").schema)
    agg = S.hourly_summary(rows.where(F.col("status").isNotNull()), "event_time",
                           ["category_name_1", "payment_method"], "grand_total", watermark="400 days")
    q = (agg.writeStream.format("memory").queryName("orders_hourly").outputMode("complete")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("orders_hourly").groupBy("category_name_1", "payment_method").agg(
        F.sum("events").alias("n")).toPandas().sort_values(["category_name_1", "payment_method"])
    from retailyze.operators.orders import category_payment_summary
    exp = category_payment_summary(orders_fact(spark, SF_SMALL)).select(
        "category_name_1", "payment_method", F.col("transaction_count").alias("n")).toPandas() \
        .sort_values(["category_name_1", "payment_method"])
    assert list(got["n"]) == list(exp["n"])
