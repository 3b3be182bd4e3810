"""The batch flows as single calls."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailyze import flows
from retailyze.plans.fixtures import config_orders, dirty_orders


def test_order_export(spark, tmp_dir):
    paths = flows.order_export(dirty_orders(spark, SF_SMALL), tmp_dir)
    assert spark.read.option("header", True).csv(paths["revenue"]).count() == 1
    assert spark.read.json(f"{paths['complete_analytics']}/order_status").count() > 1


def test_configured_run(spark, tmp_dir):
    config_orders(spark, SF_SMALL).write.option("header", True).csv(f"{tmp_dir}/orders.csv")
    checks = flows.configured_run(spark, {"orders": {"type": "csv", "config": {"file_path": f"{tmp_dir}/orders.csv"}}},
                                  f"{tmp_dir}/out")
    got = {r["check"]: r for r in checks.collect() if r["check"] == "min_records"}
    written = spark.read.parquet(f"{tmp_dir}/out/orders")
    assert got["min_records"]["passed"] and got["min_records"]["value"] == written.count()
    assert checks.where("not passed").count() == 0
    assert {"order_year", "order_month"} <= set(written.columns)
    assert written.groupBy("order_id").count().where(F.col("count") > 1).count() == 0
