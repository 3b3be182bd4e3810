"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import functools
import inspect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def pct(a, b) -> Column:
    """100 * a / b, NULL on a zero denominator."""
    return safe_div(a, b) * F.lit(100.0)


def mean(c) -> Column:
    """Mean as sum / count: exact sum first (decimal inputs stay exact), one
    final double division. Same value as ``avg`` for doubles."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)).cast("double"))


def fsum(c) -> Column:
    """pandas-style sum: all-NULL (or empty) sums to 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def month_key(c) -> Column:
    """pandas ``to_period('M')`` rendered as text: 'YYYY-MM'."""
    return F.date_format(col(c), "yyyy-MM")


def finalize(df: DataFrame) -> DataFrame:
    """Money leaves the engine as double: DECIMAL columns are cast at the very
    end, after all exact arithmetic."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in float columns counts as missing, as in pandas; other columns and
    tables without float columns are left untouched."""
    floats = [f for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")) for f in floats}) \
        if floats else df


def nan_missing(namespace: dict) -> None:
    """Let every public operator of a module see NaN as NULL in its first table."""
    for name, fn in list(namespace.items()):
        if inspect.isfunction(fn) and fn.__module__ == namespace["__name__"] and not name.startswith("_"):
            namespace[name] = _without_nan(fn)


def _without_nan(fn):
    @functools.wraps(fn)
    def run(df, *args, **kw):
        return fn(nan_as_null(df) if isinstance(df, DataFrame) else df, *args, **kw)

    return run


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach the columns of a one-row statistics DataFrame to every row.

    The statistics run once as a scalar subquery whose result is a constant in
    the plan - no join, no shuffle of ``df``. A statistics frame with no row
    gives NULLs; ``stats`` must not have more than one row (an aggregate
    without grouping always has exactly one).
    """
    cols = stats.columns
    s = stats.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_stats")).scalar()
    return (df.withColumn("_stats", s)
              .select(*[F.col(f"`{c}`") for c in df.columns],
                      *[F.col("_stats").getField(c).alias(c) for c in cols]))
