"""Statistics of a stream that don't depend on how it was cut into micro-batches.

For every source a batch adds what its rules need to know of its rows: how often
each value of a filled or fenced column occurs, and how many texts vote for a date
layout or a decimal mark. Both are counts, so batches merge by adding them up, and
mean, mode, median and fences are read off the merged table. A batch owns the folder
``batch_id=N`` and overwrites it, and reads the folders up to its own: running a
batch again changes nothing, for it and for those after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_stats
from ..functions.amounts import comma_counts
from ..functions.layouts import day_first_counts
from ..functions.ordered import quantiles_of, ranked_values
from ..operators.clean import fences_of

#: Sums of values are taken in this type: exact, and equal in any order.
EXACT = "decimal(28,9)"


class RunningStatistics:
    """The merged counts of one source, up to and including one batch."""

    def __init__(self, root: str, batch_id: int):
        self.root, self.batch_id = root, batch_id

    def _merged(self, name: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """This batch's counts are written, those of all batches so far added up."""
        batch.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={self.batch_id}")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
        seen = batch.sparkSession.read.schema(f"{schema}, batch_id long").parquet(f"{self.root}/{name}")
        sums = [F.sum(c).alias(c) for c in batch.columns if c not in keys]
        return seen.where(F.col("batch_id") <= self.batch_id).groupBy(*keys).agg(*sums)

    def _votes(self, name: str, counts: DataFrame, cols: Sequence[str]) -> DataFrame:
        long = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(f"{i}_yes").alias("yes"), F.col(f"{i}_no").alias("no"))
            for i, c in enumerate(cols)])).alias("v")).select("v.*")
        merged = self._merged(name, long, ["c"])
        return merged.agg(*[F.coalesce(F.max(F.when(F.col("c") == c, F.col("yes") > F.col("no"))), F.lit(False)).alias(c)
                            for c in cols])

    def date_votes(self, raw: DataFrame, cols: Sequence[str]) -> DataFrame | None:
        return self._votes("date_votes", day_first_counts(raw, cols), cols) if cols else None

    def amount_votes(self, raw: DataFrame, cols: Sequence[str]) -> DataFrame | None:
        return self._votes("amount_votes", comma_counts(raw, cols), cols) if cols else None

    def statistics(self, typed: DataFrame, fills: Mapping[str, object], fenced: Sequence[str], k: float = 1.5) -> DataFrame:
        """One row: ``_mean_<c>``, ``_median_<c>``, ``_mode_<c>`` as the fill rules ask,
        ``_lo_<c>`` and ``_hi_<c>`` of the fenced columns."""
        fills = {c: r for c, r in fills.items() if c in typed.columns and r in ("mean", "median", "mode")}
        cols = list(dict.fromkeys([*fills, *[c for c in fenced if c in typed.columns]]))
        spark = typed.sparkSession
        if not cols:
            return spark.range(1).select(F.lit(0).alias("_none"))
        cells = typed.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in cols])).alias("x")).select("x.*")
        counts = cells.where(F.col("v").isNotNull() & (F.col("v") != "NaN")).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        merged = self._merged("counts", counts, ["c", "v"])
        of = lambda c: merged.where(F.col("c") == c)
        row = spark.range(1).select(F.lit(0).alias("_none"))
        for c, r in fills.items():
            if r == "mean":
                x = F.when(F.col("v").try_cast("double").isNotNull(), F.col("n"))
                exact = F.sum(F.col("v").try_cast(EXACT) * F.col("n")).cast("double")
                one = of(c).agg(F.try_divide(exact, F.sum(x).cast("double")).alias(f"_mean_{c}"))
            elif r == "mode":
                one = of(c).agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias(f"_mode_{c}"))
            else:
                ranked = ranked_values(of(c), "v", weight="n")
                one = quantiles_of(ranked, [0.5], midpoint_median=True).select(F.col("q_0").alias(f"_median_{c}"))
            row = with_stats(row, one)
        fenced = [c for c in fenced if c in cols]
        if fenced:
            place = F.array_position(F.array(*[F.lit(c) for c in fenced]), F.col("c")) - 1
            values = merged.where(F.col("c").isin(fenced)).select(place.cast("int").alias("_c"), "v", "n")
            ranked = ranked_values(values, "v", ["_c"], weight="n")
            row = with_stats(row, fences_of(quantiles_of(ranked, [0.25, 0.75], ["_c"], "_q"), fenced, k))
        return row
