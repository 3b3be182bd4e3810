"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a hash in (0, 1); a row goes to the shard with the
largest ``weight / -ln(hash)``. Only the key and the shard decide, so adding a
shard moves rows into the new shard and nowhere else, and about
``new weight / total weight`` of them. Built from DataFrame functions only.

The position inside a shard comes from two levels - the row's place inside its
(input partition, shard) cell and the number of the shard's rows in earlier
partitions - so no shard and no key is ever gathered into one task, however
many rows it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage
from .textstats import fresh

_LOW_BITS = (1 << 33) - 1


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard number of a key. ``weights[i] > 0`` is the share of shard i. Ties
    (equal scores) go to the smallest shard; a null key is hashed like any
    other value."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive and not empty")
    name = F.coalesce(key.cast("string"), F.lit("\x00null"))
    scores = []
    for i, w in enumerate(weights):
        h = F.xxhash64(name, F.lit(i))
        unit = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((F.lit(float(w)) / -F.log(unit)).alias("s"), F.lit(-i).alias("i")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return -best["i"]


def number_within(df: DataFrame, group: str, out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2 ... within each value of ``group``, without gaps.

    The rows are numbered in the order of the input partitions. The rows are
    checkpointed once, so that both passes see the same partitions also after
    a lost executor.
    """
    mid, part, row, g, p, n, start = fresh(df, "_mid", "_part", "_row", "_g", "_p", "_n", "_start")
    tagged = cut_lineage(df.withColumn(mid, F.monotonically_increasing_id()))
    tagged = tagged.withColumn(part, F.shiftright(mid, 33))
    cells = tagged.groupBy(F.col(group).alias(g), F.col(part).alias(p)).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(g).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(g, p, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(group, part).orderBy(mid)
    return (tagged.withColumn(row, F.row_number().over(inside) - 1)
            .join(starts, (F.col(group) == F.col(g)) & (F.col(part) == F.col(p)))
            .withColumn(out, (F.col(start) + F.col(row)).cast("long"))
            .drop(g, p, start, row, mid, part))


def shard_records(df: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 40,
                  grown_weight: float | None = 1.0) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (0, 1, ... inside the shard) and
    ``grown_shard`` (the shard after one more of ``grown_weight`` is added;
    null when ``grown_weight`` is None).

    Rows with the same key, equal rows included, share a shard and get
    different slots. Null keys form one key of their own. An empty table gives
    an empty result. Input columns named like the added ones are replaced.
    """
    df = df.drop("shard", "slot", "grown_shard")
    shard = rendezvous_shard(F.col(key), weights).cast("int")
    grown = (rendezvous_shard(F.col(key), [*weights, grown_weight]).cast("int")
             if grown_weight else F.lit(None).cast("int"))
    return number_within(df.withColumns({"shard": shard, "grown_shard": grown}), "shard", "slot")


def op9(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shards of all documents under the law ``key``: doc_id and the shard
    count decide. ``size`` is the text's UTF-8 bytes (null: 0) plus 16,
    ``text_crc32`` the unsigned CRC-32 of its UTF-8 bytes (null: of none)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    out = shard_records(rows, "doc_id", [1.0] * shards, 1.0)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
