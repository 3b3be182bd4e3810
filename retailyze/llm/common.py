"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage  # noqa: F401  (re-exported for the operators)

#: ASCII white space; words are the runs of everything else.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of tables that nothing reads any more, in whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null key: null)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(c.cast("string").cast("binary")) % F.lit(folds)


def words(text: Column) -> Column:
    """Array of the white-space separated words (null or blank text: empty array)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))


def once(expr: Column) -> Column:
    """The same value, but computed where it is written: the optimizer doesn't move
    non-deterministic columns, so a later filter on it can't copy a long
    expression (and its higher-order functions) into several places."""
    return F.when(F.spark_partition_id() >= 0, expr)


def text_slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` of text each (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()))
    ends, start, n = np.cumsum(sizes), 0, len(sizes)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield start, stop
        start = stop


def split_words(texts: pa.Array, lower: bool = True):
    """Words of each text as (row offsets, codes into the distinct words, distinct
    words). A null text has none; texts keep their order, words too."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    flat = parts.flatten()
    encoded = flat.dictionary_encode()
    codes = np.asarray(encoded.indices).astype(np.int64)
    offsets = np.asarray(parts.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    distinct = encoded.dictionary
    # a blank text splits into one empty word: drop it
    empty = np.asarray(pc.equal(pc.binary_length(distinct), 0))
    if empty.any():
        keep = ~empty[codes]
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets, codes, distinct
