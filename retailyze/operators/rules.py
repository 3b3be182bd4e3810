"""Config-driven cleaning (C22) and quality rules.

The config has the JSON shape of the original rule file: a ``processing``
block (duplicate subset, missing values, data types, outliers,
standardization, derived columns) with per-source overrides in
``source_processing``, plus ``partitioning``, ``data_quality``,
``final_validation`` and ``monitoring`` blocks. ``clean`` applies dedup ->
standardize -> types -> missing -> outliers -> derive: a value is filled once it
is known to be missing (bad text, number or address), and fills stay.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..functions.layouts import text_columns
from ..session import cut_lineage
from . import clean as C
from .shape import add_derived

# The default rule set (same keys and values as the original
# configuration file; file paths, hosts and alert targets are left out).
DEFAULT_RULES: dict = {
    "processing": {
        "duplicate_subset": ["customer_id", "order_id"],
        "missing_values": {
            "customer_name": "Unknown",
            "order_amount": "mean",
            "order_date": "drop",
            "product_category": "mode",
            "customer_email": "Unknown",
        },
        "data_types": {
            "order_date": "datetime",
            "order_amount": "numeric",
            "customer_id": "string",
            "product_id": "string",
        },
        "outliers": {"columns": ["order_amount", "quantity"], "method": "iqr"},
        "standardization": {
            "email_columns": ["customer_email"],
            "phone_columns": ["customer_phone"],
            "currency_columns": ["order_amount", "product_price"],
            "text_columns": ["customer_name", "product_name"],
        },
        "derived_columns": {
            "add_processing_timestamp": True,
            "data_source": "ecommerce_pipeline",
            "custom_columns": {
                "order_year": "order_date.dt.year",
                "order_month": "order_date.dt.month",
                "high_value_order": "order_amount > 1000",
                "customer_segment": "case when order_amount > 500 then 'premium' else 'standard' end",
            },
        },
    },
    "source_processing": {
        "orders": {
            "duplicate_subset": ["order_id"],
            "missing_values": {"shipping_address": "Unknown", "discount_amount": 0},
        },
        "customers": {
            "duplicate_subset": ["customer_id", "email"],
            "missing_values": {"phone": "Unknown", "address": "Unknown"},
        },
    },
    "partitioning": {
        "orders": {"columns": ["order_year", "order_month"]},
        "customers": {"columns": ["customer_segment"]},
        "products": {"columns": ["product_category"]},
    },
    "data_quality": {
        "orders": {"min_records": 10,
                   "required_columns": ["order_id", "customer_id", "order_amount", "order_date"],
                   "null_thresholds": {"order_id": 0, "customer_id": 0, "order_amount": 5}},
        "customers": {"min_records": 5, "required_columns": ["customer_id", "customer_name"],
                      "null_thresholds": {"customer_id": 0, "customer_name": 10}},
        "products": {"min_records": 1, "required_columns": ["product_id", "product_name", "price"],
                     "null_thresholds": {"product_id": 0, "product_name": 5, "price": 0}},
    },
    "final_validation": {"queries": [
        {"query": "SELECT COUNT(*) FROM processed_orders", "expected_min": 10},
        {"query": "SELECT COUNT(*) FROM processed_customers", "expected_min": 5},
        {"query": "SELECT COUNT(*) FROM processed_products", "expected_min": 1},
    ]},
    "streaming": {"kafka": {
        "input_topics": ["raw-orders", "raw-customers", "raw-products"],
        "output_topics": {"raw-orders": "processed-orders", "raw-customers": "processed-customers",
                          "raw-products": "processed-products"},
    }},
    "monitoring": {"health_checks": {"data_freshness_hours": 12, "min_daily_records": 100,
                                     "max_error_rate": 0.05}},
}


def load_rules(path: str | None = None) -> dict:
    if path is None:
        return copy.deepcopy(DEFAULT_RULES)
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def merged_processing(cfg: Mapping, source: str | None) -> dict:
    """Global ``processing`` with the source's overrides merged on top: lists
    are replaced, dictionaries merged key by key."""
    out = copy.deepcopy(dict(cfg.get("processing", {})))
    for k, v in (cfg.get("source_processing", {}).get(source or "", {}) or {}).items():
        if isinstance(v, Mapping) and isinstance(out.get(k), Mapping):
            out[k] = {**out[k], **v}
        else:
            out[k] = copy.deepcopy(v)
    return out


def clean(df: DataFrame, cfg: Mapping | None = None, source: str | None = None,
          outlier_action: str = "flag", numeric_type: str = "double",
          timestamp_col: bool = True, stats_from: DataFrame | None = None, running=None) -> DataFrame:
    """The whole rule run on one source. Means, modes, quartiles
    and the votes on date layouts and decimal marks come from ``stats_from`` (raw
    rows of the same shape), by default from ``df``; or from ``running``
    (``streaming.running.RunningStatistics``), to which those of ``df`` are added."""
    p = merged_processing(cfg or DEFAULT_RULES, source)
    out = df

    def typed(x: DataFrame, votes: DataFrame | None = None) -> DataFrame:
        st = p.get("standardization") or {}
        money = [c for c in st.get("currency_columns", []) if c in x.columns]
        dates = [c for c, kind in (p.get("data_types") or {}).items() if kind == "datetime" and c in x.columns]
        marks = running.amount_votes(x, text_columns(x, money)) if running else None
        layouts = running.date_votes(x, text_columns(x, dates)) if running else None
        x = C.std_email(x, st.get("email_columns", []))
        x = C.std_phone(x, st.get("phone_columns", []))
        x = C.std_currency(x, money, votes_from=votes, votes=marks)
        x = C.std_text(x, st.get("text_columns", []))
        return C.cast_types(x, p.get("data_types") or {}, numeric_type=numeric_type, votes_from=votes, votes=layouts)

    keys = [k for k in p.get("duplicate_subset", []) if k in out.columns]
    if keys:
        out = C.dedup_by(out, keys)
        stats_needed = (any(r in ("mean", "median", "mode") for r in (p.get("missing_values") or {}).values())
                        or bool((p.get("outliers") or {}).get("columns")))
        if stats_needed and (stats_from is None or running):
            # the statistics (mean, mode, quartiles) and the row path all read the
            # deduplicated rows: materialize them once in the checkpoint dir
            out = cut_lineage(out)
    out = typed(out, stats_from)
    reference = typed(stats_from) if stats_from is not None and not running else None
    o = p.get("outliers") or {}
    known = running.statistics(out, p.get("missing_values") or {}, o.get("columns") or []) if running else None
    if p.get("missing_values"):
        out = C.fill_missing(out, p["missing_values"], stats_from=reference, stats=known)
    if o.get("columns"):
        if o.get("method", "iqr") != "iqr":
            raise ValueError(f"unsupported outlier method {o.get('method')!r}")
        out = C.outliers_iqr(out, o["columns"], action=outlier_action, stats_from=reference, fences=known)
    if p.get("derived_columns"):
        out = add_derived(out, p["derived_columns"], now_col=timestamp_col)
    return out


def partition_columns(cfg: Mapping | None, source: str) -> list[str]:
    """The configured partition columns of a source (``partitioning``)."""
    return list(((cfg or DEFAULT_RULES).get("partitioning", {}).get(source) or {}).get("columns", []))
