"""Writers and export bundles.

Result sections are DataFrames. A section that goes out in several formats is
computed once and written from there; a JSON "document" of several sections is a
folder of JSON lines for each, so rows stay distributed.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import with_stats
from ..operators.shape import sanitize_columns


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet."""
    df.write.mode(mode).parquet(path)


def publish_summary(df: DataFrame, url: str, run_date: _dt.date, base: str = "ecommerce_summary",
                    properties: Mapping | None = None) -> tuple[str, str]:
    """Replace the dated table ``<base>_YYYYMMDD`` and ``<base>_current``
    in a database with the summary rows (JDBC, overwrite).

    The current table is copied from the finished dated one, so the summary is
    computed once, a run that fails in computing it never reaches the current table,
    and both hold the same rows."""
    props = dict(properties or {})
    dated = f"{base}_{run_date.strftime('%Y%m%d')}"
    current = f"{base}_current"
    df.write.mode("overwrite").jdbc(url, dated, properties=props)
    df.sparkSession.read.jdbc(url, dated, properties=props).write.mode("overwrite").jdbc(url, current, properties=props)
    return dated, current


def replace_table(df: DataFrame, name: str, keep: int = 2) -> str:
    """Publish ``df`` under ``name``: the rows are written to a new version table and
    only then does the name, a view, point to it. Readers see the old rows or the new
    ones, never a half-written table, and a write that fails leaves the old ones in
    place. The last ``keep`` versions stay for readers that began with them."""
    spark = df.sparkSession
    database, _, short = name.rpartition(".")
    prefix = f"{short}__v"
    quoted = lambda t: f"`{database}`.`{t}`" if database else f"`{t}`"
    version = f"{prefix}{_dt.datetime.now().strftime('%Y%m%d%H%M%S%f')}"
    df.write.mode("errorifexists").saveAsTable(quoted(version))
    listed = spark.catalog.listTables(database or None)
    if any(t.name == short.lower() and t.tableType != "VIEW" and not t.isTemporary for t in listed):
        # a plain table of this name, from before there were versions, becomes the first one
        spark.sql(f"ALTER TABLE {quoted(short)} RENAME TO {quoted(prefix + '0')}")
        listed = spark.catalog.listTables(database or None)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(short)} AS SELECT * FROM {quoted(version)}")
    versions = sorted(t.name for t in listed if t.name.startswith(prefix.lower()) and t.tableType != "VIEW")
    for old in versions[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(old)}")
    return name


def write_table(df: DataFrame, name: str, timestamped: bool = False,
                now: _dt.datetime | None = None) -> str:
    """Catalog table overwrite (``replace_table``); with ``timestamped`` a table
    of its own, suffixed ``_YYYYMMDD_HHMMSS``."""
    if not timestamped:
        return replace_table(df, name)
    name = f"{name}_{(now or _dt.datetime.now()).strftime('%Y%m%d_%H%M%S')}"
    df.write.mode("overwrite").saveAsTable(name)
    return name


def write_partitioned(df: DataFrame, path: str, cols, mode: str = "overwrite",
                      source: str | None = None) -> None:
    """Hive-style ``col=value`` directories (later scans prune on them).
    ``cols`` is a column list, or a rule config (then ``source`` picks its
    ``partitioning`` entry). Rows are rebalanced by the partition columns first:
    each task writes few files per value, and a value that holds much of the
    table is split over several tasks."""
    if isinstance(cols, Mapping):
        from ..operators.rules import partition_columns
        cols = partition_columns(cols, source or "")
    cols = [cols] if isinstance(cols, str) else list(cols)
    df.hint("rebalance", *[F.col(c) for c in cols]).write.mode(mode).partitionBy(*cols).parquet(path)


def write_json_sections(sections: Mapping[str, DataFrame], out: str) -> None:
    """One folder of JSON lines per section; rows stay distributed, nothing is
    packed into one value or sent through the driver."""
    for name, section in sections.items():
        section.write.mode("overwrite").json(f"{out}/{name}")


def export_bundle(sections: Mapping[str, DataFrame], out: str, csv_sections=None,
                  document: str = "complete_analytics") -> dict[str, str]:
    """One CSV folder per chosen section plus a JSON document folder
    with every section as JSON lines. A section written in both formats is kept from
    its first write and computed once."""
    chosen = list(csv_sections if csv_sections is not None else sections.keys())
    paths = {name: f"{out}/{name}" for name in chosen}
    paths[document] = f"{out}/{document}"
    for name, section in sections.items():
        if name not in chosen:
            section.write.mode("overwrite").json(f"{paths[document]}/{name}")
            continue
        staged = section.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_csv(staged, paths[name])
            staged.write.mode("overwrite").json(f"{paths[document]}/{name}")
        finally:
            staged.unpersist()
    return paths


def append_run_record(df: DataFrame, path: str) -> None:
    """Append run records as JSON lines."""
    df.coalesce(1).write.mode("append").json(path)


def export_dataset_json(summary: DataFrame, df: DataFrame, out: str) -> None:
    """A two-table JSON dataset: the one-row summary and all rows, each its
    own folder of JSON lines."""
    write_json_sections({"summary": summary, "data": df}, out)


def publish_dataset(spark: SparkSession, data: DataFrame, name: str, out_csv: str) -> str:
    """Names sanitized, then table ``processed_data_<name>`` (``replace_table``) and
    a CSV copy of the published rows."""
    table = replace_table(sanitize_columns(data), f"processed_data_{name}")
    write_csv(spark.table(table), out_csv)
    return table


def export_processed(df: DataFrame, out: str, quality_score: DataFrame | None = None,
                     sales: str = "sales", profit: str = "profit") -> None:
    """The processed rows as CSV and a one-row metadata JSON (records,
    total sales, total profit, quality score)."""
    write_csv(df, f"{out}/data")
    aggs = [F.count(F.lit(1)).alias("records")]
    if sales in df.columns:
        aggs.append(F.coalesce(F.sum(sales), F.lit(0)).cast("double").alias("total_sales"))
    if profit in df.columns:
        aggs.append(F.coalesce(F.sum(profit), F.lit(0)).cast("double").alias("total_profit"))
    meta = df.agg(*aggs)
    if quality_score is not None:
        meta = with_stats(meta, quality_score.select("quality_score"))
    meta.coalesce(1).write.mode("overwrite").json(f"{out}/metadata")


def to_envelope(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Each row as a ``{"timestamp": ..., "data": {row}}`` JSON message in
    column ``value`` (the shape a Kafka sink takes). The timestamp is the
    current time, or column ``ts`` (then left out of ``data``); other columns
    of ``df`` that are not data (e.g. a topic) can be added afterwards."""
    t = F.col(ts) if ts else F.current_timestamp()
    data = [c for c in df.columns if c != ts]
    return df.select(F.to_json(F.struct(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(*[F.col(f"`{c}`") for c in data]).alias("data"))).alias("value"))


def write_kafka(df: DataFrame, topic: str, servers: str) -> None:
    """Publish envelopes to a Kafka topic (needs the Kafka connector jar)."""
    (to_envelope(df).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
