"""Whole-row duplicates, fingerprint first.

Equal rows have equal 128-bit fingerprints, so only rows whose fingerprint occurs
more than once can have an equal. The fingerprints are counted (16 bytes a row in
the shuffle, combined on the map side), and just the rows of the few groups above
one are compared by value; two different rows with one fingerprint are told apart
there, so results are exact whatever the hash does. Rows on their own are never
shuffled. The price is that the table is read again; one that is itself the result of
large joins is dearer to read than to shuffle, so there ``reread=False`` makes all
columns the key and reads it once (equal rows are combined on the map side).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Repeated fingerprints up to here are broadcast (16 bytes each); more of them
#: mean that much of the table is copies, and all columns become the group key.
BROADCAST_GROUPS = 1_000_000

Fingerprint = Callable[[DataFrame], list[Column]]


def has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(has_map(f.dataType) for f in dtype.fields)


def comparable(c: Column, dtype: T.DataType) -> Column:
    """The value in a form that Spark can group and order: a map becomes its sorted
    (key, value) pairs, also inside arrays and structs."""
    if not has_map(dtype):
        return c
    if isinstance(dtype, T.MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.struct(
            e["key"].alias("key"), comparable(e["value"], dtype.valueType).alias("value")))
        return F.array_sort(pairs)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: comparable(e, dtype.elementType))
    fields = [comparable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(c.isNotNull(), F.struct(*fields))


def row_values(df: DataFrame) -> list[Column]:
    return [comparable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]


def row_fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns. Hashing skips NULLs, so which columns are
    NULL is hashed as well."""
    values = row_values(df)
    masks = []
    for a in range(0, len(values), 60):
        bits = [F.when(v.isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, v in enumerate(values[a:a + 60])]
        mask = bits[0]
        for b in bits[1:]:
            mask = mask + b
        masks.append(mask)
    return [F.xxhash64(*masks, *values), F.xxhash64(F.lit(1), *reversed(values), *masks)]


def _free(df: DataFrame, names: list[str]) -> list[str]:
    """Names that no column of ``df`` has."""
    have = {c.lower() for c in df.columns}
    return ["_" * next(k for k in range(len(have) + 1) if "_" * k + n not in have) + n for n in names]


def _tagged(df: DataFrame, fingerprint: Fingerprint) -> tuple[DataFrame, list[str]]:
    keys = fingerprint(df)
    names = _free(df, [f"_h{i}" for i in range(len(keys))])
    return df.select("*", *[k.alias(n) for k, n in zip(keys, names)]), names


def _repeated(tagged: DataFrame, names: list[str]) -> DataFrame:
    """Fingerprints that occur more than once."""
    (n,) = _free(tagged, ["_n"])
    found = tagged.groupBy(*names).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(*names)
    return cut_lineage(found)


def _by_value(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows, all columns as the key."""
    maps = [f for f in df.schema.fields if has_map(f.dataType)]
    if not maps:
        return df.dropDuplicates()
    names = _free(df, [f"_m{i}" for i in range(len(maps))])
    keyed = df.withColumns({n: comparable(F.col(f"`{f.name}`"), f.dataType) for n, f in zip(names, maps)})
    plain = [f.name for f in df.schema.fields if not has_map(f.dataType)]
    return keyed.dropDuplicates([*plain, *names]).drop(*names)


def distinct_rows(df: DataFrame, fingerprint: Fingerprint = row_fingerprint,
                  broadcast_groups: int = BROADCAST_GROUPS, reread: bool = True) -> DataFrame:
    """``df`` without repeated rows (NULLs equal each other)."""
    if not df.columns:
        return df.dropDuplicates()
    if not reread:
        return _by_value(df)
    tagged, names = _tagged(df, fingerprint)
    repeated = _repeated(tagged, names)
    groups = repeated.count()
    if not groups:
        return df
    if groups > broadcast_groups:
        return _by_value(df)
    alone = tagged.join(F.broadcast(repeated), names, "left_anti").select(*df.columns)
    several = tagged.join(F.broadcast(repeated), names, "left_semi").select(*df.columns)
    return alone.unionByName(_by_value(several))


def repeated_row_count(df: DataFrame, fingerprint: Fingerprint = row_fingerprint,
                       broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """One row, ``duplicate_rows``: rows that repeat an earlier equal row."""
    spark, none = df.sparkSession, F.lit(0).cast("bigint").alias("duplicate_rows")
    if not df.columns:
        return df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("duplicate_rows"))
    tagged, names = _tagged(df, fingerprint)
    repeated = _repeated(tagged, names)
    groups = repeated.count()
    if not groups:
        return spark.range(1).select(none)
    if groups <= broadcast_groups:
        tagged = tagged.join(F.broadcast(repeated), names, "left_semi")
    return counted_rows(tagged.select(*[F.col(f"`{c}`") for c in df.columns])).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def counted_rows(df: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """Each distinct row once: its values ``_0``, ``_1``, ... in a form that can be
    grouped, and ``_n``, how often it occurs; ``_s0``, ``_s1``, ...: the sum over its
    occurrences of the values named in ``sums``."""
    values = df.select(*[v.alias(f"_{i}") for i, v in enumerate(row_values(df))])
    return values.groupBy(*values.columns).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_s{i}") for i, v in enumerate(sums)])
