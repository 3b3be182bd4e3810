"""Readers and writers on files made from the driver tables."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailyze.plans.fixtures import orders_fact, sales_fact
from retailyze.sinks import writers as W
from retailyze.sources import readers as R


def _raw_orders(spark):
    """orders_fact under the 21-column raw layout (money as double)."""
    o = orders_fact(spark, SF_SMALL)
    cols = []
    for f in R.ORDERS_RAW_SCHEMA.fields:
        if f.name in o.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return o.select(*cols)


def test_typed_and_inferred_csv(spark, tmp_dir):
    raw = _raw_orders(spark)
    W.write_csv(raw, f"{tmp_dir}/orders")
    typed = R.read_orders_csv(spark, f"{tmp_dir}/orders")
    assert typed.schema == R.ORDERS_RAW_SCHEMA
    assert typed.count() == raw.count()
    assert typed.agg(F.sum("qty_ordered")).first()[0] == raw.agg(F.sum("qty_ordered")).first()[0]
    inferred = R.read_csv_inferred(spark, f"{tmp_dir}/orders")
    assert dict(inferred.dtypes)["qty_ordered"] == "int"


def test_landing_tree_partition_discovery(spark, tmp_dir):
    s = sales_fact(spark, SF_SMALL).select("order_id", F.date_format("order_date", "yyyy-MM-dd").alias("dt"),
                                           "sales")
    s.write.partitionBy("dt").option("header", True).csv(f"{tmp_dir}/landing")
    back = R.read_landing(spark, f"{tmp_dir}/landing")
    assert "dt" in back.columns and back.count() == s.count()
    one = s.select("dt").first()[0]
    plan = back.where(F.col("dt") == one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert dict(back.dtypes)["sales"] == "string"


def _write_bytes(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def _rows_text(spark, sep=",", n=30):
    rows = sales_fact(spark, SF_SMALL).select("customer", "category", "sales").limit(n).collect()
    lines = [sep.join(["Unnamed: 0", " customer", "category", "sales", "empty"])]
    for i, r in enumerate(rows):
        cat = "N/A" if i == 3 else r["category"]
        lines.append(sep.join([str(i), f"{r['customer']} Café", cat, str(r["sales"]), ""]))
    return "\n".join(lines) + "\n"


def test_robust_reader_encodings_and_cleanup(spark, tmp_dir):
    _write_bytes(f"{tmp_dir}/a/utf8.csv", _rows_text(spark), "utf-8")
    df, att = R.read_csv_robust(spark, f"{tmp_dir}/a/utf8.csv")
    assert att == {"encoding": "utf-8", "sep": ","}
    assert df.columns == ["customer", "category", "sales"]  # index, empty dropped; header trimmed
    assert df.where(F.col("category").isNull()).count() == 1  # 'N/A' token
    assert df.where(F.col("customer").contains("Café")).count() == 30
    assert dict(df.dtypes)["sales"] == "double"

    # a numeric column with NA tokens is numeric once they are NULL
    txt = _rows_text(spark).splitlines()
    txt = [txt[0]] + [(",".join(line.split(",")[:3] + ["nan" if i == 5 else line.split(",")[3], ""]))
                      for i, line in enumerate(txt[1:])]
    _write_bytes(f"{tmp_dir}/a2/na.csv", "\n".join(txt) + "\n", "utf-8")
    df, _ = R.read_csv_robust(spark, f"{tmp_dir}/a2/na.csv")
    assert dict(df.dtypes)["sales"] == "double" and df.where(F.col("sales").isNull()).count() == 1

    _write_bytes(f"{tmp_dir}/b/cp.csv", _rows_text(spark), "cp1252")
    df, att = R.read_csv_robust(spark, f"{tmp_dir}/b/cp.csv")
    assert att["encoding"] == "cp1252"
    assert df.where(F.col("customer").contains("Café")).count() == 30

    _write_bytes(f"{tmp_dir}/c/semi.csv", _rows_text(spark, sep=";"), "utf-8")
    df, att = R.read_csv_robust(spark, f"{tmp_dir}/c/semi.csv")
    assert att["sep"] == ";" and df.columns == ["customer", "category", "sales"]

    _write_bytes(f"{tmp_dir}/d/bom.csv", "﻿" + _rows_text(spark), "utf-8")
    df, _ = R.read_csv_robust(spark, f"{tmp_dir}/d/bom.csv")
    assert df.columns == ["customer", "category", "sales"]

    # few rows are rows too; an unreadable shape and a missing path are errors
    _write_bytes(f"{tmp_dir}/e/short.csv", "a,b\n1,x\n2,None\n3,n/a\n", "utf-8")
    df, _ = R.read_csv_robust(spark, f"{tmp_dir}/e/short.csv")
    assert df.count() == 3 and df.where(F.col("b").isNull()).count() == 2
    _write_bytes(f"{tmp_dir}/f/one.csv", "a\n1\n", "utf-8")
    with pytest.raises(ValueError):
        R.read_csv_robust(spark, f"{tmp_dir}/f/one.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        R.read_csv_robust(spark, f"{tmp_dir}/missing.csv")
    # a quoted line break is part of its cell
    _write_bytes(f"{tmp_dir}/g/lines.csv", 'a,b\n1,"x\ny"\n2,z\n', "utf-8")
    df, _ = R.read_csv_robust(spark, f"{tmp_dir}/g/lines.csv")
    assert df.count() == 2 and df.where(F.col("b") == "x\ny").count() == 1


def test_robust_reader_profiles_once_and_reads_once(spark, tmp_dir):
    conf = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.legacy.javaCharsets")
    _write_bytes(f"{tmp_dir}/a/x.csv", "id;name;Preis €;day;at;flag;big;n\n0;\u201cA\u201d–€;1.5;2024-01-02;2024-01-02 03:04:05;true;5000000000;7\n"
                 "1;Zoë;NA;2024-01-03;2024-01-02;False;1;n/a\n", "cp1252")
    attempts = [{"encoding": "utf-8", "sep": ","}, {"encoding": "cp1252", "sep": ","}, {"encoding": "cp1252", "sep": ";"}]
    df, att = R.read_csv_robust(spark, f"{tmp_dir}/a/x.csv", attempts=attempts)
    assert att == attempts[2]
    assert dict(df.dtypes) == {"name": "string", "Preis €": "double", "day": "date", "at": "timestamp", "flag": "boolean",
                               "big": "bigint", "n": "int"}  # id was 0..n-1
    assert {r["name"] for r in df.collect()} == {"\u201cA\u201d–€", "Zoë"}
    # bytes that windows-1252 doesn't have: the next attempt
    with open(f"{tmp_dir}/raw.csv", "wb") as f:
        f.write(b"a,b\n1,x\x81\xe9\n")
    df, att = R.read_csv_robust(spark, f"{tmp_dir}/raw.csv")
    assert att["encoding"] == "iso-8859-1" and df.first()["b"] == "x\x81é"
    # U+FFFD itself is a character
    _write_bytes(f"{tmp_dir}/c/x.csv", "a,b\n1,�\n", "utf-8")
    assert R.read_csv_robust(spark, f"{tmp_dir}/c/x.csv")[1]["encoding"] == "utf-8"
    p = R.profile_text(spark, f"{tmp_dir}/a/x.csv")
    assert (p["lines"], p["not_utf8"], p["odd_quotes"]) == (3, 3, 0)
    with pytest.raises(ValueError):
        _write_bytes(f"{tmp_dir}/e/x.csv", "", "utf-8")
        R.read_csv_robust(spark, f"{tmp_dir}/e/x.csv")
    assert conf == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.legacy.javaCharsets"))


def test_robust_reader_splits_files_without_open_quotes(spark, tmp_dir):
    _write_bytes(f"{tmp_dir}/a/x.csv", "a,b\n" + "".join(f'{i},"v,{i}"\n' for i in range(40_000)), "utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df, _ = R.read_csv_robust(spark, f"{tmp_dir}/a/x.csv")
        assert df.rdd.getNumPartitions() > 4 and df.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_head_source_and_json(spark, tmp_dir):
    raw = _raw_orders(spark)
    W.write_csv(raw, f"{tmp_dir}/o")
    assert R.read_head(spark, f"{tmp_dir}/o", 100).count() == 100
    src = R.read_source(spark, {"type": "csv", "config": {
        "file_path": f"{tmp_dir}/o", "encoding": "utf-8", "separator": ",",
        "na_values": ["", "NULL", "null", "N/A"]}})
    assert src.count() == raw.count()
    raw.limit(50).write.json(f"{tmp_dir}/j")
    assert R.read_source(spark, {"type": "json", "config": {"file_path": f"{tmp_dir}/j"}}).count() == 50


def test_latest_json_file(spark, tmp_dir):
    d = f"{tmp_dir}/results"
    os.makedirs(d)
    for i, n in enumerate((3, 5)):
        with open(f"{d}/r{i}.json", "w") as f:
            for k in range(n):
                f.write(json.dumps({"run": i, "k": k}) + "\n")
        t = time.time() - 100 + i * 50
        os.utime(f"{d}/r{i}.json", (t, t))
    out = R.read_latest_json(spark, d)
    assert sorted(r["k"] for r in out.collect()) == list(range(5))
    assert {r["run"] for r in out.collect()} == {1}


def test_jdbc_publish_and_read_embedded_derby(spark, tmp_dir):
    from retailyze.operators.orders import category_payment_summary
    url = f"jdbc:derby:{tmp_dir}/db;create=true"
    summary = category_payment_summary(orders_fact(spark, SF_SMALL)).select(
        "category_name_1", "payment_method", F.col("total_revenue").cast("double"), "transaction_count")
    dated, current = W.publish_summary(summary, url, dt.date(2024, 1, 31))
    assert dated.endswith("_20240131")
    back = R.read_jdbc(spark, url, current.upper())
    assert back.count() == summary.count()
    cnt = R.read_jdbc(spark, url, f"(SELECT COUNT(*) AS N FROM {dated.upper()}) t").first()[0]
    assert cnt == summary.count()


def test_registry_and_publish(spark, tmp_dir):
    from retailyze.operators.quality import register_dataset
    raw = _raw_orders(spark)
    W.write_parquet(raw, f"{tmp_dir}/p")
    reg = register_dataset(spark, "dataset_registry", "orders", "parquet", f"{tmp_dir}/p",
                           {"owner": "tests"}, dataset_id="ds1")
    row = reg.where("id = 'ds1'").first()
    assert row["record_count"] == raw.count() and json.loads(row["metadata"]) == {"owner": "tests"}
    data = R.read_registered(spark, "dataset_registry", "ds1")
    assert data.count() == raw.count()
    renamed = data.withColumnRenamed("category_name_1", "category name-1.x")
    t = W.publish_dataset(spark, renamed, "orders", f"{tmp_dir}/pub")
    assert "category_name_1_x" in spark.table(t).columns


def test_export_bundle_and_documents(spark, tmp_dir):
    from retailyze.operators import orders as A
    v = A.valid_orders(orders_fact(spark, SF_SMALL))
    sections = {"revenue": A.revenue_kpis(v), "top_categories": A.category_performance(v),
                "payment_methods": A.payment_analysis(v)}
    paths = W.export_bundle(sections, tmp_dir)
    for name, section in sections.items():
        assert spark.read.json(f"{paths['complete_analytics']}/{name}").count() == section.count()
    assert spark.read.option("header", True).csv(paths["revenue"]).count() == 1
    W.export_dataset_json(A.revenue_kpis(v), v, f"{tmp_dir}/ds")
    assert spark.read.json(f"{tmp_dir}/ds/data").count() == v.count()
    assert spark.read.json(f"{tmp_dir}/ds/summary").count() == 1
    W.write_partitioned(v.select("item_id", "year", "month"), f"{tmp_dir}/part", ["year", "month"])
    assert any(p.startswith("year=") for p in os.listdir(f"{tmp_dir}/part"))
    W.export_processed(sales_fact(spark, SF_SMALL), f"{tmp_dir}/proc")
    meta = spark.read.json(f"{tmp_dir}/proc/metadata").first()
    assert meta["records"] == sales_fact(spark, SF_SMALL).count()


def test_envelope_round_trip(spark):
    from retailyze.streaming.ingest import parse_envelope
    o = orders_fact(spark, SF_SMALL).select("item_id", "status", "grand_total").limit(20)
    env = W.to_envelope(o)
    bad = spark.createDataFrame([("not json",), ('{"timestamp": "x"}',)], "value string")
    rows, rejects = parse_envelope(env.unionByName(bad), o.schema)
    assert rows.count() == 20 and rejects.count() == 2
    assert set(rows.columns) == {"event_time", "item_id", "status", "grand_total"}


def test_table_and_profile_bundle(spark, tmp_dir):
    from retailyze.operators import profile as PR
    o = orders_fact(spark, SF_SMALL)
    name = W.write_table(PR.basic_stats(o), "basic_stats", timestamped=True,
                         now=dt.datetime(2024, 1, 31, 12, 0, 0))
    assert name == "basic_stats_20240131_120000"
    assert spark.table(name).first()["total_records"] == o.count()
    sections = {"basic_stats": PR.basic_stats(o), "column_analysis": PR.column_profile(o),
                "numeric_analysis": PR.numeric_profile(o), "categorical_analysis": PR.categorical_profile(o)}
    paths = W.export_bundle(sections, tmp_dir, csv_sections=["basic_stats", "column_analysis"],
                            document="big_data_complete_analytics")
    doc = spark.read.json(f"{paths['big_data_complete_analytics']}/column_analysis")
    assert doc.count() == len(o.columns)
    cols = spark.read.option("header", True).csv(paths["column_analysis"]).columns
    assert cols[:2] == ["position", "column_name"]
