"""Readers (S01-S10).

Every reader returns a lazy DataFrame; nothing is collected except the few
bounded facts a reader must decide on (does an attempt parse, which file is
the newest, where does a registered dataset live).
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import NA_TOKENS
from ..operators.shape import clean_headers, drop_index_columns

# The raw order-export schema (21 columns, all nullable).
ORDERS_RAW_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty_ordered", T.IntegerType()),
    T.StructField("grand_total", T.DoubleType()),
    T.StructField("increment_id", T.StringType()),
    T.StructField("category_name_1", T.StringType()),
    T.StructField("sales_commission_code", T.StringType()),
    T.StructField("discount_amount", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("working_date", T.StringType()),
    T.StructField("bi_status", T.StringType()),
    T.StructField("mv", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("customer_since", T.StringType()),
    T.StructField("m_y", T.StringType()),
    T.StructField("fy", T.StringType()),
    T.StructField("customer_id", T.StringType()),
])

_CSV_OPTS = {"header": "true", "escape": '"'}

# Text that the tolerant reader takes as missing.
READ_NA_TOKENS = [*NA_TOKENS, "n/a", "None", "NaN", "-NaN", "-nan", "<NA>", "#N/A", "#N/A N/A", "#NA", "1.#IND",
                  "1.#QNAN", "-1.#IND", "-1.#QNAN"]


def read_orders_csv(spark: SparkSession, path: str, schema: T.StructType = ORDERS_RAW_SCHEMA,
                    multiline: bool = False) -> DataFrame:
    """Typed CSV scan (header, '"' escape), no inference pass. ``multiline``
    allows line breaks inside quoted cells, but then one task reads a whole
    file."""
    return spark.read.schema(schema).options(**_CSV_OPTS, multiLine=multiline).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV scan with schema inference (one extra pass over the data)."""
    return spark.read.options(**_CSV_OPTS, multiLine=multiline).option("inferSchema", "true").csv(path)


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """All-string CSV over a landing tree; ``key=value`` date directories
    become partition columns (and prune when filtered)."""
    return (spark.read.option("header", "true")
            .option("inferSchema", "false")
            .option("recursiveFileLookup", "false")
            .csv(root))


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Text cells equal to an NA token become NULL (string columns only)."""
    toks = list(tokens)
    return df.withColumns({f.name: F.when(~F.col(f"`{f.name}`").isin(toks), F.col(f"`{f.name}`"))
                           for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def retype_numeric_text(df: DataFrame) -> DataFrame:
    """Text columns whose non-NULL values all parse as numbers become bigint
    (all integral) or double - what type inference gives once NA tokens are
    gone. One aggregate decides for every column (a single row reaches the
    driver)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    aggs = []
    for i, c in enumerate(strings):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), F.count(x.try_cast("double")).alias(f"d{i}"),
                 F.count(x.try_cast("bigint")).alias(f"l{i}")]
    r = df.agg(*aggs).first()
    casts = {}
    for i, c in enumerate(strings):
        n = r[f"n{i}"]
        if n and r[f"l{i}"] == n:
            casts[c] = F.col(f"`{c}`").try_cast("bigint")
        elif n and r[f"d{i}"] == n:
            casts[c] = F.col(f"`{c}`").try_cast("double")
    return df.withColumns(casts) if casts else df


# Read attempts of the tolerant reader, in order.
ROBUST_ATTEMPTS = [
    {"encoding": "utf-8", "sep": ","},
    {"encoding": "utf-8-sig", "sep": ","},
    {"encoding": "cp1252", "sep": ","},
    {"encoding": "iso-8859-1", "sep": ","},
    {"encoding": "utf-8", "sep": ";"},
    {"encoding": "latin-1", "sep": ","},
]
_JAVA_CHARSET = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "cp1252": "windows-1252",
                 "iso-8859-1": "ISO-8859-1", "latin-1": "ISO-8859-1"}
# Bytes that windows-1252 leaves undefined, and its characters for the other
# bytes from 0x80 to 0x9F, which ISO-8859-1 reads as control characters.
_UNDEFINED_1252 = "\x81\x8d\x8f\x90\x9d"
_CONTROLS = "".join(chr(b) for b in range(0x80, 0xA0) if chr(b) not in _UNDEFINED_1252)
_CHARS_1252 = _CONTROLS.encode("latin-1").decode("cp1252")


def profile_text(spark: SparkSession, path: str) -> dict:
    """One pass over a text file's bytes, one row back: lines, lines that are no UTF-8,
    lines that windows-1252 can't hold, lines with an odd number of quotes (a cell
    goes on in the next line), and the first line's bytes."""
    text = spark.read.text(path).where(F.length("value") > 0)
    raw = F.col("value").cast("binary")
    quotes = F.length(raw) - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")).cast("binary"))
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = text.select(F.is_valid_utf8("value").alias("utf8"), F.decode(raw, "ISO-8859-1").rlike(f"[{_UNDEFINED_1252}]").alias("no1252"),
                       (quotes % 2 == 1).alias("odd"), raw.alias("raw"), place.alias("place"))
    r = rows.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("utf8")).alias("not_utf8"),
                 F.count_if("no1252").alias("not_1252"), F.count_if("odd").alias("odd_quotes"),
                 F.min_by("raw", "place").alias("first")).first()
    return r.asDict() | {"first": bytes(r["first"] or b"")}


def _fits(profile: Mapping, encoding: str, sep: str, min_cols: int) -> bool:
    """Would this attempt decode cleanly and give at least ``min_cols`` columns?"""
    if profile["not_utf8"] if encoding.startswith("utf-8") else encoding == "cp1252" and profile["not_1252"]:
        return False
    header = profile["first"].decode("latin-1")
    return profile["lines"] > 0 and len(next(csv.reader([header], delimiter=sep))) >= min_cols


def _text_scan(spark: SparkSession, path: str, encoding: str, sep: str, multiline: bool) -> DataFrame:
    """All cells as text. windows-1252 is read as ISO-8859-1, a charset that every
    session allows, and its own characters are put in."""
    df = (spark.read.option("header", "true").option("sep", sep).option("inferSchema", "false")
          .option("encoding", "UTF-8" if encoding.startswith("utf-8") else "ISO-8859-1")
          .option("ignoreLeadingWhiteSpace", "true").option("multiLine", multiline).option("escape", '"')
          .option("mode", "PERMISSIVE").csv(path))
    if encoding == "cp1252":
        df = df.select(*[F.translate(F.col(f"`{c}`"), _CONTROLS, _CHARS_1252).alias(c.translate(str.maketrans(_CONTROLS, _CHARS_1252)))
                         for c in df.columns])
    return df


def typed_cells(df: DataFrame) -> DataFrame:
    """Text columns with the type that all their non-NULL values have (int, bigint,
    double, date, timestamp, boolean; else text); columns without a value are left
    out. One aggregate decides for all columns."""
    if not df.columns:
        return df
    aggs = []
    for i, c in enumerate(df.columns):
        x = F.col(f"`{c}`")
        day = x.rlike(r"^\d{4}-\d{2}-\d{2}$")
        aggs += [F.count(x).alias(f"n{i}"), F.count(x.try_cast("int")).alias(f"int{i}"), F.count(x.try_cast("bigint")).alias(f"bigint{i}"),
                 F.count(x.try_cast("double")).alias(f"double{i}"), F.count(F.when(day, x.try_cast("date"))).alias(f"date{i}"),
                 F.count(F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(x))).alias(f"timestamp{i}"),
                 F.count_if(F.lower(x).isin("true", "false")).alias(f"boolean{i}")]
    r = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(df.columns):
        n = r[f"n{i}"]
        kind = next((k for k in ("int", "bigint", "double", "date", "timestamp", "boolean") if r[f"{k}{i}"] == n), "string")
        if n:
            out.append(F.col(f"`{c}`").try_cast(kind).alias(c) if kind != "string" else F.col(f"`{c}`"))
    return df.select(*out)


def read_csv_robust(spark: SparkSession, path: str, min_cols: int = 2,
                    attempts: Sequence[Mapping[str, str]] = ROBUST_ATTEMPTS,
                    multiline: bool | None = None) -> tuple[DataFrame, dict]:
    """The first of ``attempts`` (encoding, separator) under which the file decodes
    and has >= min_cols columns, whatever its number of rows; NA tokens become NULL,
    columns get the type of all their values, empty and index-like columns are
    dropped, headers cleaned. Returns (DataFrame, the attempt used).

    One pass over the bytes decides on the attempt (``profile_text``), one over the
    cells on the types. Quoted cells may hold line breaks: where a line has an odd
    number of quotes each file is read by one task, else files are split
    (``multiline`` sets it by hand). No session setting is changed.
    """
    profile = profile_text(spark, path)
    if multiline is None:
        multiline = profile["odd_quotes"] > 0
    for att in attempts:
        if not _fits(profile, att["encoding"], att["sep"], min_cols):
            continue
        cells = null_tokens(_text_scan(spark, path, att["encoding"], att["sep"], multiline), READ_NA_TOKENS)
        named = [c for c in cells.columns if c.strip() and not c.startswith("Unnamed")]
        out = clean_headers(drop_index_columns(typed_cells(cells.select(*[F.col(f"`{c}`") for c in named]))))
        if len(out.columns) >= min_cols:
            return out, dict(att)
    raise ValueError(f"could not read {path} with any encoding/separator combination")


def read_head(spark: SparkSession, path: str, n: int, fmt: str = "csv") -> DataFrame:
    """The first n rows (a bounded scan: the limit stops reading early)."""
    r = spark.read.option("header", "true") if fmt == "csv" else spark.read
    return r.format(fmt).load(path).limit(n)


def read_source(spark: SparkSession, cfg: Mapping) -> DataFrame:
    """A configured source - ``{"type": "csv"|"json", "config":
    {"file_path", "encoding", "separator", "na_values"}}``."""
    kind = cfg.get("type", "csv")
    c = cfg.get("config", cfg)
    path = c["file_path"]
    if kind == "json":
        return spark.read.json(path)
    if kind != "csv":
        raise ValueError(f"unsupported source type {kind!r}")
    enc = c.get("encoding", "utf-8").lower()
    df = (spark.read.option("header", "true")
          .option("sep", c.get("separator", ","))
          .option("encoding", _JAVA_CHARSET.get(enc, enc))
          .option("inferSchema", "true")
          .csv(path))
    return retype_numeric_text(null_tokens(df, c.get("na_values", NA_TOKENS)))


def read_latest_json(spark: SparkSession, directory: str, pattern: str = "*.json") -> DataFrame:
    """Rows of the most recently modified JSON file in a directory.

    The newest file is found from the file listing (paths and times only, no
    content), then only that file is read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
             .select("path", "modificationTime"))
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()["p"]
    if newest is None:
        raise FileNotFoundError(f"no {pattern} in {directory}")
    return spark.read.json(newest)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping | None = None,
              column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A database table (or ``(SELECT ...) t`` query) over JDBC. With a
    numeric or date ``column`` and its bounds the table is read by
    ``num_partitions`` tasks, each a range of the column."""
    split = {"column": column, "lowerBound": lower, "upperBound": upper,
             "numPartitions": num_partitions} if column else {}
    return spark.read.jdbc(url, table, properties=dict(properties or {}), **split)


def read_registered(spark: SparkSession, registry_table: str, dataset_id: str) -> DataFrame:
    """Read a dataset registered in the catalog registry by id."""
    reg = spark.table(registry_table).where(F.col("id") == dataset_id).select(
        "source_type", "source_path").limit(2).collect()
    if len(reg) != 1:
        raise KeyError(f"dataset {dataset_id!r}: {len(reg)} registry rows")
    kind, path = reg[0]["source_type"], reg[0]["source_path"]
    r = spark.read.option("header", "true") if kind == "csv" else spark.read
    return r.format(kind).load(path)
