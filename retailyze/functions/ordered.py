"""Order statistics that stay distributed.

* ``global_index`` numbers rows in a total order without a single-partition
  window: a range-partitioned sort, per-partition row counts (one row per
  partition, a proven bound) and a broadcast offset table.
* ``running_total`` is the cumulative sum over that order, computed per
  partition and shifted by the partition's offset.
* ``exact_quantiles`` gives linear-interpolated quantiles (pandas / SQL
  ``quantile_cont``) per group from the counts of distinct values: equal values
  are one row before anything is sorted, and a group's distinct values are split
  across many sort partitions, so neither a hot value nor a hot group is ever
  gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOW_BITS = (1 << 33) - 1


def _sorted_tagged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Globally sorted rows with their sort partition ``_pid`` and position
    ``_loc`` inside it (monotonically_increasing_id keeps the partition id in
    the upper 31 bits, the row number in the lower 33). Checkpointed, so every
    later pass sees the same partition layout, also after executor loss."""
    sorted_df = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = cut_lineage(sorted_df)
    return sorted_df.withColumns({
        "_pid": F.shiftright("_mid", 33),
        "_loc": F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)),
    }).drop("_mid")


def _offsets(per_pid: DataFrame) -> DataFrame:
    """Rows before each sort partition, from its row count ``_n``."""
    # one row per partition: a global window here is over a tiny table
    return per_pid.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_n")).alias("_off"))


def global_index(df: DataFrame, order: Sequence[Column], name: str = "_idx") -> DataFrame:
    """Add a 0-based position of each row in ``order`` (must be a total order)."""
    tagged = _sorted_tagged(df, order)
    offsets = _offsets(tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + F.col("_loc"))
                  .drop("_off", "_loc"))


def running_total(df: DataFrame, order: Sequence[Column], value: str,
                  out: str = "cumulative", rank: str | None = "rank") -> DataFrame:
    """Cumulative sum of ``value`` in ``order`` plus an optional 1-based rank.

    Per partition (partition = one contiguous range of the sort) a window sums
    the rows, then the partition's starting total, from a table with one row
    per partition, is added.
    """
    idx = global_index(df, order, "_gidx")
    part_tot = idx.groupBy("_pid").agg(F.sum(value).alias("_ptot"))
    starts = part_tot.select(
        "_pid",
        F.coalesce(F.sum("_ptot").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast(part_tot.schema["_ptot"].dataType)).alias("_start"))
    w = Window.partitionBy("_pid").orderBy("_gidx").rowsBetween(Window.unboundedPreceding, 0)
    res = (idx.withColumn("_local", F.sum(value).over(w))
              .join(F.broadcast(starts), "_pid")
              .withColumn(out, F.col("_start") + F.col("_local")))
    if rank:
        res = res.withColumn(rank, F.col("_gidx") + 1)
    return res.drop("_pid", "_start", "_local", "_gidx")


def ranked_values(df: DataFrame, value: str, by: Sequence[str] = (), sums: Sequence[str] = (),
                  weight: str | None = None) -> DataFrame:
    """One row per group and distinct value: ``_v`` (double), ``_cnt``, the ranks
    ``_from`` .. ``_to`` - 1 it holds in its group, the group's size ``_n``, and
    ``_sum_<c>`` / ``_count_<c>`` of the named columns. NULL and NaN values are left
    out. A row stands for ``weight`` equal ones, if given. The table is sorted, checkpointed and much smaller than ``df`` where values
    repeat: whatever asks for order statistics and what lies between them reads it
    instead of the rows."""
    by = list(by)
    x = F.col(value).try_cast("double")
    times = F.count(F.lit(1)) if weight is None else F.sum("_w")
    weights = [] if weight is None else [F.col(weight).alias("_w")]
    v = df.select(*by, x.alias("_v"), *weights, *[F.col(c).alias(f"_in_{c}") for c in sums]).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    # equal values are one row with a count (combined before the shuffle), so
    # neither a hot group nor a hot value reaches a sort task as its rows
    counts = v.groupBy(*by, "_v").agg(times.alias("_cnt"), *[
        a for c in sums for a in (F.sum(f"_in_{c}").alias(f"_sum_{c}"), F.count(f"_in_{c}").alias(f"_count_{c}"))])
    tagged = _sorted_tagged(counts, [*[F.col(b).asc_nulls_first() for b in by], F.col("_v")])
    inside = Window.partitionBy("_pid", *by).orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
    tagged = tagged.withColumn("_upto", F.sum("_cnt").over(inside))
    # one row per (sort partition, group): rows before it in its group, group size
    cells = tagged.groupBy("_pid", *by).agg(F.sum("_cnt").alias("_pn"))
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.select(F.col("_pid").alias("_cell"), *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
                         (F.sum("_pn").over(earlier) - F.col("_pn")).alias("_before"), F.sum("_pn").over(whole).alias("_n"))
    same = F.col("_pid") == F.col("_cell")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    kept = [f"_{k}_{c}" for c in sums for k in ("sum", "count")]
    return tagged.join(cells, same).select(
        *by, "_v", "_n", "_cnt", *kept, (F.col("_before") + F.col("_upto") - F.col("_cnt")).alias("_from"),
        (F.col("_before") + F.col("_upto")).alias("_to"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), out_prefix: str = "q",
                    midpoint_median: bool = False) -> DataFrame:
    """One row per group with columns ``{out_prefix}_{i}`` for ``probs[i]``.

    pos = (n - 1) * p, a/b the values at floor/ceil(pos) (NULLs ignored),
    t = pos - floor(pos); the result is numpy's linear interpolation
    a + (b - a) * t, evaluated as b - (b - a) * (1 - t) when t >= 0.5.
    ``midpoint_median`` makes p = 0.5 the mean of the two middle values
    (pandas ``median``).
    """
    return quantiles_of(ranked_values(df, value, by), probs, by, out_prefix, midpoint_median)


def quantiles_of(rows: DataFrame, probs: Sequence[float], by: Sequence[str] = (), out_prefix: str = "q",
                 midpoint_median: bool = False) -> DataFrame:
    """``exact_quantiles`` of a table that ``ranked_values`` made."""
    by = list(by)
    # a row holds the ranks _from.._to-1; the value at a rank is a conditional maximum
    aggs = [F.max("_n").alias("_n")]
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        for name, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v"))).alias(f"_{name}{i}"))
    g = rows.groupBy(*by).agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        a, b, t = F.col(f"_lo{i}"), F.col(f"_hi{i}"), pos - F.floor(pos)
        q = F.when(F.floor(pos) == F.ceil(pos), a)
        if midpoint_median and float(p) == 0.5:
            q = q.otherwise((a + b) / 2.0)
        else:
            q = q.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
        out.append(q.alias(f"{out_prefix}_{i}"))
    return g.select(*by, *out)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              out_prefix: str = "q", method: str = "exact", accuracy: int = 10000,
              midpoint_median: bool = False) -> DataFrame:
    """Quantiles per group, same output shape for both methods.

    ``exact`` (default): ``exact_quantiles``. ``approx``: ``percentile_approx``
    - one aggregation with a bounded sketch per group and no sort, relative
    rank error about 1 / ``accuracy``; for very large inputs where an
    approximate cut-off is acceptable.
    """
    if method == "exact":
        return exact_quantiles(df, value, probs, by, out_prefix, midpoint_median)
    if method != "approx":
        raise ValueError(f"unknown quantile method {method!r}")
    x = F.col(value).try_cast("double")
    pa = F.percentile_approx(x, [float(p) for p in probs], accuracy)
    g = df.groupBy(*by).agg(pa.alias("_qa"))
    return g.select(*by, *[F.col("_qa")[i].alias(f"{out_prefix}_{i}") for i in range(len(probs))])
