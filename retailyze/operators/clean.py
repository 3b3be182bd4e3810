"""Filters, coercion and cleaning (C02-C21) as DataFrame transformations.

All rules are built-in expressions; numeric coercion is ``try_cast`` and date
coercion ``try_to_timestamp`` so bad values become NULL instead of failing the
job under ANSI mode. Statistics a rule needs (mean, mode, quartiles, ...) are
computed in one aggregate pass and attached as a scalar subquery (one row,
evaluated once).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mean, nan_as_null, with_stats
from ..functions.amounts import parse_amounts
from ..functions.layouts import parse_dates
from ..functions.ordered import exact_quantiles, quantiles
from ..functions.rowhash import comparable, distinct_rows, has_map

# Text that counts as a missing value in uploaded files.
NA_TOKENS = ["", "NA", "N/A", "null", "NULL", "nan"]

# pandas' str.strip() removes all leading/trailing whitespace, not only spaces
_WS_TRIM = r"^\s+|\s+$"


def drop_null_ordinal(df: DataFrame, i: int = 1) -> DataFrame:
    """Keep rows whose i-th column (0-based position) is not NULL."""
    return df.where(F.col(f"`{df.columns[i]}`").isNotNull())


def explore(df: DataFrame, categories: Sequence[str] = (), states: Sequence[str] = (),
            min_sales: float | None = None, category: str = "category",
            state: str = "state", sales: str = "sales") -> DataFrame:
    """Explorer filter; an empty list means no filter on that column."""
    out = df
    if categories:
        out = out.where(F.col(category).isin(list(categories)))
    if states:
        out = out.where(F.col(state).isin(list(states)))
    if min_sales is not None:
        out = out.where(F.col(sales) >= F.lit(min_sales))
    return out


def coerce_numeric(df: DataFrame, cols: Iterable[str] = ("sales", "profit", "discount", "quantity"),
                   to: str = "double") -> DataFrame:
    """Text to number, unparseable -> NULL (pandas ``errors='coerce'``)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {to})") for c in present})


def coerce_dates(df: DataFrame, cols: Iterable[str] = ("order_date", "ship_date"),
                 fmt: str | None = None) -> DataFrame:
    """Text to timestamp, unparseable -> NULL. ISO, year-first, eight-digit,
    named-month and numeric layouts; day first or month first is voted per column
    (``functions.layouts``). ``fmt``: that layout alone."""
    present = [c for c in cols if c in df.columns]
    if fmt:
        return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string"), F.lit(fmt)) for c in present})
    return parse_dates(df, present) if present else df


def dedup_rows(df: DataFrame, reread: bool = True) -> DataFrame:
    """Drop exact duplicate rows. Fingerprints are counted first; only rows
    whose fingerprint repeats are compared by value (``functions.rowhash``). With
    ``reread=False`` (a table that is dear to read twice) all columns are the key."""
    return distinct_rows(df, reread=reread)


def trim_text(df: DataFrame, cols: Iterable[str] = (
        "customer", "product_name", "category", "subcategory", "city", "state")) -> DataFrame:
    """Strip leading/trailing whitespace (spaces, tabs, newlines); NULL stays NULL."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.regexp_replace(F.col(c), _WS_TRIM, "") for c in present})


def dedup_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per key combination, the first in ``order_by`` (default:
    all other columns ascending, so the result is deterministic).

    A row number of 1 is asked for, so Spark keeps one row of each key on the map
    side (window group limit) before it shuffles: a hot key reaches its task as one
    row from every mapper. Map columns are ordered by their sorted pairs.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    order = list(order_by) if order_by is not None else []
    order = [o if isinstance(o, Column) else F.col(o) for o in order]
    # ties of an explicit order, and the default: all other columns ascending
    order += [comparable(F.col(f"`{f.name}`"), f.dataType).asc_nulls_first() for f in df.schema.fields if f.name in others]
    place = "_place"
    while place in df.columns:
        place = "_" + place
    by = [comparable(F.col(f"`{f.name}`"), f.dataType) if has_map(f.dataType) else F.col(f"`{f.name}`")
          for k in keys for f in df.schema.fields if f.name == k]
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(place, F.row_number().over(w)).where(F.col(place) == 1).drop(place)


def _literal_for(dtype: T.DataType, value):
    return F.lit(value).cast(dtype)


def fill_missing(df: DataFrame, rules: Mapping[str, object], stats_from: DataFrame | None = None,
                 stats: DataFrame | None = None) -> DataFrame:
    """Per-column missing-value rule.

    rule = a constant | "mean" | "median" | "mode" | "drop".
    Statistics for all mean/median/mode columns come from one aggregate pass
    over ``stats_from`` (default: ``df`` itself), or are given as the one row ``stats``
    with columns ``_mean_<c>``, ``_median_<c>``, ``_mode_<c>``.
    """
    given = stats
    source = nan_as_null(stats_from if stats_from is not None else df)
    df = nan_as_null(df)
    rules = {c: r for c, r in rules.items() if c in df.columns}
    drop = [c for c, r in rules.items() if r == "drop"]
    def numeric(c: str) -> Column:
        # statistics of a text column are taken over its parseable values
        dt = df.schema[c].dataType
        return F.col(c) if isinstance(dt, T.NumericType) else F.col(c).try_cast("double")

    stat_aggs = [mean(numeric(c)).alias(f"_mean_{c}") for c, r in rules.items() if r == "mean"]
    stats = given if given is not None else source.agg(*stat_aggs) if stat_aggs else None
    for c, r in rules.items() if given is None else ():
        if r == "median":
            med = exact_quantiles(source, c, [0.5], out_prefix=f"_median_{c}", midpoint_median=True)
            med = med.select(F.col(f"_median_{c}_0").alias(f"_median_{c}"))
            stats = med if stats is None else with_stats(stats, med)
        elif r == "mode":
            # most frequent non-NULL value, smallest on ties: a distributed count
            # and a bounded top-1, never a value->count map in one task
            top = (source.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(f"_mode_{c}"))
                     .agg(F.count(F.lit(1)).alias("_n"))
                     .orderBy(F.desc("_n"), F.asc(f"_mode_{c}")).limit(1).drop("_n"))
            if stats is None:
                stats = source.agg(F.count(F.lit(1)).alias("_rows"))
            stats = with_stats(stats, top)
    out = df
    if stats is not None:
        # one-row statistics: a scalar subquery, constant in the plan
        out = with_stats(out, stats)
    repl = {}
    for c, r in rules.items():
        dtype = df.schema[c].dataType
        if r in ("mean", "median", "mode"):
            repl[c] = F.coalesce(F.col(c), F.col(f"_{r}_{c}").cast(dtype))
        elif r != "drop":
            repl[c] = F.coalesce(F.col(c), _literal_for(dtype, r))
    out = out.withColumns(repl).select(*df.columns)
    if drop:
        out = out.na.drop(subset=drop)
    return out


def fill_defaults(df: DataFrame, today: str, numeric: Mapping[str, float] | None = None,
                  date_cols: Sequence[str] = ("order_date",), text_fill: str = "Unknown") -> DataFrame:
    """Keep every row - sales/profit/discount 0, quantity 1, order_date
    ``today``, every other string column 'Unknown'."""
    numeric = dict(numeric or {"sales": 0, "profit": 0, "quantity": 1, "discount": 0})
    repl = {}
    for f in df.schema.fields:
        c = f.name
        if c in numeric:
            repl[c] = F.coalesce(F.col(c), F.lit(numeric[c]).cast(f.dataType))
        elif c in date_cols:
            repl[c] = F.coalesce(F.col(c), F.lit(today).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            repl[c] = F.coalesce(F.col(c), F.lit(text_fill))
    return df.withColumns(repl)


def cast_types(df: DataFrame, rules: Mapping[str, str], numeric_type: str = "double",
               votes_from: DataFrame | None = None, votes: DataFrame | None = None) -> DataFrame:
    """C14: 'datetime' -> timestamp (layouts voted per column, as in C05, over
    ``votes_from`` or ``df``), 'numeric' -> ``numeric_type`` (double by default, a
    decimal for exact money), 'string' -> string; bad values become NULL."""
    dates = [c for c, kind in rules.items() if kind == "datetime" and c in df.columns]
    repl = {}
    for c, kind in rules.items():
        if c not in df.columns:
            continue
        if kind == "datetime":
            continue
        if kind == "numeric":
            repl[c] = F.expr(f"try_cast(`{c}` AS {numeric_type})")
        elif kind == "string":
            repl[c] = F.col(c).cast("string")
        else:
            raise ValueError(f"unknown type rule {kind!r} for {c}")
    if dates:
        df = parse_dates(df, dates, votes_from, votes)
    return df.withColumns(repl)


def _number(c: str) -> Column:
    """A column's value as a double; text that is no number and NaN are NULL."""
    x = F.col(f"`{c}`").try_cast("double")
    return F.when(~F.isnan(x), x)


def outliers_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                 action: str = "flag", method: str = "exact",
                 stats_from: DataFrame | None = None, fences: DataFrame | None = None) -> DataFrame:
    """Tukey fences q1 - k*IQR, q3 + k*IQR per column (exact, linear
    quartiles). action: 'flag' adds ``<col>_outlier``; 'remove' keeps rows
    inside all fences (NULL values are kept); 'clip' caps values at the fences.
    Text that is no number and NaN count as NULL: no outliers, kept as they are.

    The quartiles of all columns come from one sort: the values of
    ``stats_from`` (default: ``df`` itself) are unpivoted to (column, value) and
    ranked per column. Or the fences are given as one row with columns ``_lo_<c>`` and
    ``_hi_<c>``.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if fences is None:
        fences = _fences(stats_from if stats_from is not None else df, cols, k, method)
    else:
        fences = fences.select(*[f"_{e}_{c}" for c in cols for e in ("lo", "hi")])
    out = with_stats(df, fences)
    for c in cols:
        x = _number(c)
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        if action == "flag":
            out = out.withColumn(f"{c}_outlier", F.coalesce((x < lo) | (x > hi), F.lit(False)))
        elif action == "remove":
            out = out.where(x.isNull() | ((x >= lo) & (x <= hi)))
        elif action == "clip":
            out = out.withColumn(c, F.when(x < lo, lo).when(x > hi, hi).otherwise(x))  # NaN and text: NULL
        else:
            raise ValueError(action)
    keep = list(df.columns) + ([f"{c}_outlier" for c in cols] if action == "flag" else [])
    return out.select(*keep)


def _fences(df: DataFrame, cols: Sequence[str], k: float, method: str = "exact") -> DataFrame:
    """One row: ``_lo_<c>``, ``_hi_<c>`` of every column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), _number(c).alias("_x")) for i, c in enumerate(cols)
    ])).alias("_p")).select("_p._c", "_p._x")
    q = quantiles(long, "_x", [0.25, 0.75], by=["_c"], out_prefix="_q", method=method)
    return fences_of(q, cols, k)


def fences_of(quartiles: DataFrame, cols: Sequence[str], k: float) -> DataFrame:
    """One row of fences from rows (``_c``: place in ``cols``, ``_q_0``, ``_q_1``)."""
    return quartiles.agg(*[
        F.max(F.when(F.col("_c") == i, F.col("_q_0") - k * (F.col("_q_1") - F.col("_q_0")))).alias(f"_lo_{c}")
        for i, c in enumerate(cols)] + [
        F.max(F.when(F.col("_c") == i, F.col("_q_1") + k * (F.col("_q_1") - F.col("_q_0")))).alias(f"_hi_{c}")
        for i, c in enumerate(cols)])


def outliers_zscore(df: DataFrame, c: str, threshold: float = 5.0) -> DataFrame:
    """Flag rows with |x - mean| / sample stddev > threshold. Text that is no
    number and NaN are left out of the mean and are never flagged; with fewer than
    two values or equal values nothing is. Mean and deviation are those of the finite
    values; an infinite one is an outlier of them."""
    exact = isinstance(df.schema[c].dataType, (T.DecimalType, T.IntegralType))
    finite = F.when(F.abs(_number(c)) < F.lit(float("inf")), _number(c))
    stats = df.agg((mean(c) if exact else F.avg(finite)).alias("_mu"), F.stddev_samp(finite).alias("_sd"))
    z = F.try_divide(F.abs(_number(c) - F.col("_mu")), F.col("_sd"))
    return (with_stats(df, stats)
              .withColumn(f"{c}_z", z)
              .withColumn(f"{c}_outlier", F.coalesce(z > threshold, F.lit(False)))
              .drop("_mu", "_sd"))


def range_violations(df: DataFrame, rules: Mapping[str, Mapping[str, float]],
                     key: Sequence[str] = ()) -> DataFrame:
    """C17: rows breaking a min/max rule, one output row per (row, broken rule):
    key columns, column, rule, bound, value. One scan; rules become an array
    that is exploded and filtered. NaN and text that is no number break no rule."""
    checks = []
    for c, rule in rules.items():
        if c not in df.columns:
            continue
        x = _number(c)
        if "min" in rule:
            checks.append(F.struct(F.lit(c).alias("column"), F.lit("min").alias("rule"),
                                   F.lit(float(rule["min"])).alias("bound"), x.alias("value"),
                                   (x < F.lit(float(rule["min"]))).alias("bad")))
        if "max" in rule:
            checks.append(F.struct(F.lit(c).alias("column"), F.lit("max").alias("rule"),
                                   F.lit(float(rule["max"])).alias("bound"), x.alias("value"),
                                   (x > F.lit(float(rule["max"]))).alias("bad")))
    if not checks:
        return df.select(*key, F.lit(None).cast("string").alias("column")).limit(0)
    ex = df.select(*key, F.explode(F.array(*checks)).alias("_c"))
    return ex.where(F.col("_c.bad")).select(*key, "_c.column", "_c.rule", "_c.bound", "_c.value")


# Fixed value: the e-mail shape accepted by std_email.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def std_email(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Trim + lower; anything that is not an address becomes NULL."""
    repl = {}
    for c in cols:
        if c in df.columns:
            e = F.lower(F.regexp_replace(F.col(c), _WS_TRIM, ""))
            repl[c] = F.when(e.rlike(EMAIL_PATTERN), e)
    return df.withColumns(repl)


def std_phone(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep digits and a leading '+'; no digits -> NULL."""
    repl = {}
    for c in cols:
        if c in df.columns:
            s = F.regexp_replace(F.col(c), _WS_TRIM, "")
            lead = F.when(s.startswith("+"), F.lit("+")).otherwise(F.lit(""))
            digits = F.regexp_replace(s, r"[^0-9]", "")
            repl[c] = F.when(F.length(digits) > 0, F.concat(lead, digits))
    return df.withColumns(repl)


def std_currency(df: DataFrame, cols: Iterable[str], to: str = "decimal(18,2)",
                 votes_from: DataFrame | None = None, votes: DataFrame | None = None) -> DataFrame:
    """C20: money text to decimal(18,2): symbols and units off, '(12.50)', '-12.50'
    and '12.50-' negative, exponents, decimal point or comma as the column's own
    numbers tell (``functions.amounts``); anything else -> NULL. Numbers are only
    cast (a double renders as '1.0E7')."""
    present = [c for c in cols if c in df.columns]
    numeric = [c for c in present if isinstance(df.schema[c].dataType, T.NumericType)]
    df = df.withColumns({c: F.col(f"`{c}`").try_cast(to) for c in numeric})
    return parse_amounts(df, [c for c in present if c not in numeric], to, votes_from, votes)


def std_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Collapse inner whitespace, strip, title case."""
    repl = {}
    for c in cols:
        if c in df.columns:
            s = F.regexp_replace(F.regexp_replace(F.col(c), r"\s+", " "), _WS_TRIM, "")
            repl[c] = F.initcap(s)
    return df.withColumns(repl)


def bounded_sample(df: DataFrame, n: int, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash (reproducible,
    independent of partitioning); all rows if there are no more. Nothing is
    sampled unless a caller asks for a number of rows.

    The hash is mapped to a uniform u in [0, 1). Rows with u below a threshold
    a little above n / rows are kept as candidates (a filter, no shuffle); only
    if fewer than n pass is the threshold widened. The final top-n by u then
    runs over about 1.1 * n candidates instead of n rows from every task.
    """
    total = df.count()
    if total <= n:
        return df
    cols = list(key) if key else df.columns
    h = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in cols])
    u = h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)
    scored = df.withColumn("_u", u)
    t = min(1.0, 1.1 * n / total + 1e-9)
    while True:
        cand = scored.where(F.col("_u") < F.lit(t))
        if t >= 1.0 or cand.count() >= n:
            break
        t = min(1.0, t * 2)
    return cand.orderBy("_u", *[F.col(f"`{c}`") for c in cols]).limit(n).drop("_u")

