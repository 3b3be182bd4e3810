"""Schema-agnostic data profiling.

The per-column statistics are fused: one aggregate computes distinct counts,
null counts and numeric moments for every profiled column at once, and the
wide result row is turned into one row per column with ``explode`` over an
array of structs (no per-column Spark jobs, no driver loop over data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_as_null
from ..session import cut_lineage

# The type names counted as numeric by the profiler.
NUMERIC_TYPES = ["double", "float", "int", "bigint"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES]


def string_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def basic_stats(df: DataFrame) -> DataFrame:
    """Rows, columns and numeric columns."""
    return df.agg(F.count(F.lit(1)).alias("total_records")).select(
        "total_records", F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.lit(len(numeric_columns(df))).cast("bigint").alias("numeric_columns"))


#: Values of one bitmap (Spark's), bitmaps a column may have inside the one-row
#: aggregate, and values of its range a row may stand for where bitmaps are grouped.
BITMAP, BITMAPS, SPARSE = 32_768, 16, 64


def _as_whole(dtype: T.DataType, c: Column) -> Column | None:
    """A value's identity as a long, where its type has one."""
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (c * F.lit(10 ** dtype.scale).cast(f"decimal({dtype.scale + 1},0)")).cast("bigint") if dtype.scale else c.cast("bigint")
    return None


def _distinct_by_bitmap(df: DataFrame, columns: dict[int, tuple[Column, int, int]]) -> DataFrame:
    """(position, distinct non-NULL values, NULLs) of columns with few possible values:
    one bit for each, in one aggregate over all columns; a task hands on its bitmaps."""
    aggs, rows = [], []
    for i, (v, low, span) in columns.items():
        at = v - F.lit(low)
        bits = [F.bitmap_construct_agg(F.when((at >= k * BITMAP) & (at < (k + 1) * BITMAP), at - k * BITMAP)).alias(f"b{i}_{k}")
                for k in range(-(-span // BITMAP))]
        aggs += [*bits, F.count_if(v.isNull()).alias(f"z{i}")]
        found = F.lit(0).cast("bigint")
        for k in range(len(bits)):
            found = found + F.coalesce(F.bitmap_count(F.col(f"b{i}_{k}")), F.lit(0))
        rows.append(F.struct(F.lit(i).alias("position"), found.alias("d"), F.col(f"z{i}").alias("z")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _distinct_by_bitmap_groups(df: DataFrame, i: int, v: Column, low: int) -> DataFrame:
    """The same for one dense column of any range: a bitmap for each stretch of values."""
    at = v - F.lit(low)
    per_stretch = df.select(F.floor(at / BITMAP).alias("k"), F.pmod(at, F.lit(BITMAP)).alias("bit")).groupBy("k").agg(
        F.bitmap_construct_agg("bit").alias("b"), F.count_if(F.col("bit").isNull()).alias("z"))
    return per_stretch.agg(F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.bitmap_count("b"))), F.lit(0)).alias("d"),
                           F.coalesce(F.sum("z"), F.lit(0)).alias("z")).select(F.lit(i).alias("position"), "d", "z")


def _distinct_by_value(df: DataFrame, columns: dict[int, tuple[str, Column]]) -> DataFrame:
    """The same for all other columns: (position, value) pairs are counted, combined on
    the map side. A pair holds the value as a long, a double or a text - none is
    turned into text that has a shorter form."""
    none = {"l": F.lit(None).cast("bigint"), "x": F.lit(None).cast("double"), "s": F.lit(None).cast("string")}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), *[(v if k == kind else none[k]).alias(k) for k in none])
        for i, (kind, v) in columns.items()])).alias("p")).select("p.*")
    per_value = pairs.groupBy("position", *none).agg(F.count(F.lit(1)).alias("n"))
    empty = F.col("l").isNull() & F.col("x").isNull() & F.col("s").isNull()
    return per_value.groupBy("position").agg(F.count_if(~empty).alias("d"),
                                             F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("z"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """For every column (or the given ones) - distinct values (NULL counts as one
    value, like ``select(c).distinct().count()``), NULL count and type.

    Exact, by what a column's values allow: whole numbers (also booleans and dates)
    of a small or dense range are bits of a bitmap, so a task hands on bitmaps and
    not values; the others are counted by value. -0.0 and 0.0 are one value, NaN too.
    """
    cols = list(columns or df.columns)
    types, fields = dict(df.dtypes), {f.name: f.dataType for f in df.schema.fields}
    whole = {i: _as_whole(fields[c], _q(c)) for i, c in enumerate(cols)}
    ranged = {i: v for i, v in whole.items() if v is not None and not isinstance(fields[cols[i]], (T.TimestampType, T.DecimalType))}
    # these few narrow columns are read for their ends, then for their bitmaps: stored between
    ints = cut_lineage(df.select(*[_q(cols[i]) for i in ranged])) if ranged else df.limit(0)
    ends = ints.agg(F.count(F.lit(1)).alias("rows"), *[
        a for i, v in ranged.items() for a in (F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"))]).first()  # one row
    small, parts, rest = {}, [], {}
    for i, c in enumerate(cols):
        if i in ranged:
            low, high = ends[f"lo{i}"] or 0, ends[f"hi{i}"] or 0
            span = high - low + 1
            if span <= BITMAP * BITMAPS:
                small[i] = (ranged[i], low, span)
                continue
            if span <= SPARSE * ends["rows"]:
                parts.append(_distinct_by_bitmap_groups(ints, i, ranged[i], low))
                continue
        if whole[i] is not None:
            rest[i] = ("l", whole[i])
        elif isinstance(fields[c], (T.FloatType, T.DoubleType)):
            rest[i] = ("x", _q(c).cast("double"))
        else:
            rest[i] = ("s", _q(c).cast("string"))
    if small:
        parts.append(_distinct_by_bitmap(ints, small))
    if rest:
        parts.append(_distinct_by_value(df, rest))
    prof = parts[0]
    for p in parts[1:]:
        prof = prof.unionByName(p)
    names = F.array(*[F.lit(c) for c in cols])
    kinds = F.array(*[F.lit(types[c]) for c in cols])
    # a column of an empty table still gets its row (0 values)
    spine = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("at"))
    out = spine.join(prof, F.col("at") == F.col("position"), "left")
    nulls = F.coalesce("z", F.lit(0)).cast("bigint")
    return out.select(
        F.col("at").alias("position"), F.element_at(names, F.col("at") + 1).alias("column_name"),
        (F.coalesce("d", F.lit(0)) + F.when(nulls > 0, 1).otherwise(0)).cast("bigint").alias("distinct_values"),
        nulls.alias("null_count"), F.element_at(kinds, F.col("at") + 1).alias("data_type"))


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: count, mean, sample stddev, min, max of every numeric column (or
    the given ones), NaN left out, long form (column_name, stat, value); NULL statistics read 0."""
    df = nan_as_null(df)
    cols = list(columns or numeric_columns(df))
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, stat string, value double")
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c)
        aggs += [F.count(x).cast("double").alias(f"n{i}"),
                 F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double")).alias(f"m{i}"),
                 F.stddev_samp(x.cast("double")).alias(f"s{i}"),
                 F.min(x).cast("double").alias(f"lo{i}"), F.max(x).cast("double").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        for stat, key in (("count", "n"), ("mean", "m"), ("stddev", "s"), ("min", "lo"), ("max", "hi")):
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(stat).alias("stat"),
                                 F.coalesce(F.col(f"{key}{i}"), F.lit(0.0)).alias("value")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """The k most frequent values (NULL included) of every string column
    (or the given ones); ties by value. Each column is a distributed count followed by a
    bounded top-k (TakeOrdered), so no column's values meet in one task."""
    parts = []
    for i, c in enumerate(columns or string_columns(df)):
        top = (df.groupBy(_q(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
                 .orderBy(F.desc("count"), F.asc_nulls_first("value")).limit(k))
        parts.append(top.select(F.lit(i).alias("position"), F.lit(c).alias("column_name"), "value", "count"))
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "position int, column_name string, value string, count bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_summary(df: DataFrame) -> DataFrame:
    """One row - rows, columns, processing date."""
    return df.agg(F.count(F.lit(1)).alias("total_records")).select(
        "total_records", F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("processing_date"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row per column - type, NULL count, table row count (one pass)."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(_q(c).isNull()).alias(f"z{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                     F.lit(t).alias("data_type"), F.col(f"z{i}").cast("bigint").alias("null_count"))
            for i, (c, t) in enumerate(df.dtypes)]
    return wide.select("_rows", F.explode(F.array(*rows)).alias("r")).select(
        "r.*", F.col("_rows").alias("row_count"))


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """G14 (sample part): the first n rows as JSON text (bounded by n)."""
    return df.limit(n).select(F.to_json(F.struct(*[_q(c) for c in df.columns])).alias("row_json"))
