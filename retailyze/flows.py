"""End-to-end batch flows (L1, L2) as library calls."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .operators import orders as A
from .operators import quality as Q
from .operators.rules import DEFAULT_RULES, clean, partition_columns
from .sinks.writers import export_bundle, write_parquet, write_partitioned
from .sources.readers import read_source


def order_export_sections(clean_orders: DataFrame) -> dict[str, DataFrame]:
    """The five analytics sections of the order-export flow."""
    return {
        "revenue": A.revenue_kpis(clean_orders),
        "top_categories": A.category_performance(clean_orders),
        "monthly_trends": A.monthly_trends(clean_orders),
        "payment_methods": A.payment_analysis(clean_orders),
        "order_status": A.status_distribution(clean_orders),
    }


def order_export(raw_orders: DataFrame, out: str) -> dict[str, str]:
    """L1: valid rows -> analytics sections -> CSV folders and JSON lines.
    Returns the written paths."""
    sections = order_export_sections(A.valid_orders(raw_orders))
    return export_bundle(sections, out, csv_sections=["revenue", "top_categories", "monthly_trends", "payment_methods"])


def configured_run(spark: SparkSession, sources: Mapping[str, Mapping], out: str,
                   cfg: Mapping | None = None) -> DataFrame:
    """L2: for each configured source read -> clean by its rules -> quality
    checks -> (partitioned) write under ``out``. Each cleaned table is written
    first and checked from there, so a source is cleaned once. Returns the check
    rows of all sources (a few per rule)."""
    cfg = cfg or DEFAULT_RULES
    checks = []
    for name, source in sources.items():
        cleaned = clean(read_source(spark, source), cfg, name)
        columns = [c for c in partition_columns(cfg, name) if c in cleaned.columns]
        path = f"{out}/{name}"
        if columns:
            write_partitioned(cleaned, path, columns)
        else:
            write_parquet(cleaned, path)
        written = spark.read.parquet(path)
        rules = (cfg.get("data_quality") or {}).get(name) or {}
        if "min_records" in rules:
            checks.append(Q.check_min_records(written, rules["min_records"], name))
        if rules.get("required_columns"):
            checks.append(Q.check_required(written, rules["required_columns"], name))
        if rules.get("null_thresholds"):
            checks.append(Q.check_null_thresholds(written, rules["null_thresholds"], name))
    if not checks:
        return spark.createDataFrame([], Q.CHECK_SCHEMA)
    result = checks[0]
    for c in checks[1:]:
        result = result.unionByName(c)
    return result
