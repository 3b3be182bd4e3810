"""Projections and column shaping.

Name-only operators touch the schema alone; the two that inspect data
(P02 empty columns, P03 index-like columns) compute every statistic they need
in one aggregate pass over all columns.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pct


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Projection (pruned down to the scan by Catalyst)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose every value is NULL (one aggregate for all columns)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    empty = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]
    return df.drop(*empty)


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Drop 'Unnamed*' and blank-named columns, and 'index'/'id' columns
    whose values are exactly the row numbers 0..n-1 (tested order-free:
    min 0, max n-1, n distinct non-NULL integer values)."""
    by_name = [c for c in df.columns if c.startswith("Unnamed") or c.strip() == ""]
    cand = [c for c in df.columns if c.lower() in ("index", "id") and c not in by_name
            and isinstance(df.schema[c].dataType, T.IntegralType)]
    drop = list(by_name)
    if cand:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(cand):
            x = F.col(f"`{c}`")
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                     F.count_distinct(x).alias(f"nd{i}"), F.count(x).alias(f"nn{i}")]
        r = df.agg(*aggs).first()
        n = r["_n"]
        for i, c in enumerate(cand):
            if n and r[f"mn{i}"] == 0 and r[f"mx{i}"] == n - 1 and r[f"nd{i}"] == n and r[f"nn{i}"] == n:
                drop.append(c)
    return df.drop(*drop)


_BOM = "﻿"


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace and leading byte-order marks from names."""
    return df.toDF(*[c.strip().lstrip(_BOM).strip() for c in df.columns])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Space, '-' and '.' in names become '_'."""
    return df.toDF(*[re.sub(r"[ .\-]", "_", c) for c in df.columns])


_DT_PART = re.compile(r"^\s*([A-Za-z_][A-Za-z0-9_]*)\.dt\.(year|month|day|hour|quarter|dayofweek)\s*$")
_DT_FUN = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
           "quarter": F.quarter, "dayofweek": F.dayofweek}


def derived_expr(text: str):
    """A config expression as a Column: ``col.dt.year`` style date parts, else
    a Spark SQL expression (comparisons, CASE WHEN, arithmetic)."""
    m = _DT_PART.match(text)
    if m:
        return _DT_FUN[m.group(2)](F.col(m.group(1)))
    return F.expr(text)


def add_derived(df: DataFrame, cfg: Mapping, now_col: bool = True) -> DataFrame:
    """Derived columns from the config block ``derived_columns``:
    processing timestamp, data_source literal and custom expressions."""
    cols = {}
    if cfg.get("add_processing_timestamp") and now_col:
        cols["processing_timestamp"] = F.current_timestamp()
    if cfg.get("data_source"):
        cols["data_source"] = F.lit(cfg["data_source"])
    for name, text in (cfg.get("custom_columns") or {}).items():
        cols[name] = derived_expr(text)
    return df.withColumns(cols)


def row_margin(df: DataFrame, profit: str = "profit", sales: str = "sales",
               out: str = "profit_margin") -> DataFrame:
    """Per-row profit / sales * 100; 0 where sales are zero or missing, and
    wherever the result is no finite number (NaN or infinite profit)."""
    margin = pct(profit, sales)
    return df.withColumn(out, F.when(F.abs(margin) < F.lit(float("inf")), margin + 0.0).otherwise(F.lit(0.0)))


def add_calendar(df: DataFrame, date: str = "order_date") -> DataFrame:
    """Full weekday name, ISO week number, full month name."""
    return df.withColumns({
        "day_of_week": F.date_format(F.col(date), "EEEE"),
        "week_num": F.weekofyear(F.col(date)),
        "month_name": F.date_format(F.col(date), "MMMM"),
    })


def format_kpis(df: DataFrame, money: Sequence[str] = ("total_sales", "total_profit"),
                percent: Sequence[str] = ("profit_margin",),
                counts: Sequence[str] = ("total_orders",)) -> DataFrame:
    """P10: display strings - '$1,234.00', '12.5%', '1,234'."""
    cols = {}
    for c in money:
        cols[c] = F.concat(F.lit("$"), F.format_number(F.col(c).cast("double"), 2))
    for c in percent:
        cols[c] = F.concat(F.format_number(F.col(c).cast("double"), 1), F.lit("%"))
    for c in counts:
        cols[c] = F.format_number(F.col(c), 0)
    return df.withColumns(cols)


def stamp(df: DataFrame, name: str = "processing_timestamp") -> DataFrame:
    """Add the processing time - applied after aggregates, never before."""
    return df.withColumn(name, F.current_timestamp())


def recent_orders(df: DataFrame, n: int = 10,
                  cols: Sequence[str] = ("increment_id", "category_name_1", "grand_total", "status"),
                  date: str = "created_at",
                  tie: Sequence[str] = ("item_id", "category_name_1", "grand_total", "status")) -> DataFrame:
    """The n most recent orders (TakeOrdered; the tie-break runs through
    every shown column, so equal keys cannot change the result)."""
    return (df.orderBy(F.desc_nulls_last(date), *[F.asc(t) for t in tie])
              .limit(n).select(*cols))


def _bi_type(dt: T.DataType) -> str:
    if isinstance(dt, T.IntegralType):
        return "Int64"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "Double"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "DateTime"
    if isinstance(dt, T.BooleanType):
        return "Boolean"
    return "String"


def bi_schema(df: DataFrame) -> DataFrame:
    """One row per column - name, Spark type, BI type (schema only)."""
    rows = [(i, f.name, f.dataType.simpleString(), _bi_type(f.dataType))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, spark_type string, dataType string")
