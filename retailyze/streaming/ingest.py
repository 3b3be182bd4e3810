"""Structured Streaming ingest.

Sources are Kafka (when its connector is on the classpath) or a file stream of
JSON / parquet; every query has a checkpoint location, so a restarted or
failed run resumes exactly where the last committed micro-batch ended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.rules import DEFAULT_RULES, clean
from .running import RunningStatistics


def envelope_schema(data_schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("timestamp", T.StringType()),
                         T.StructField("data", data_schema)])


def parse_envelope(stream: DataFrame, data_schema: T.StructType,
                   value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parse ``{"timestamp", "data": {...}}`` messages.

    Returns (rows, rejects): rows carry ``event_time`` plus the data fields;
    rejects keep the raw text of messages that are not valid JSON envelopes."""
    raw = stream.select(F.col(value).cast("string").alias("_raw"))
    parsed = raw.withColumn("_env", F.from_json("_raw", envelope_schema(data_schema),
                                                {"mode": "PERMISSIVE"}))
    ok = F.col("_env").isNotNull() & F.col("_env.data").isNotNull()
    rows = parsed.where(ok).select(F.to_timestamp("_env.timestamp").alias("event_time"), "_env.data.*")
    rejects = parsed.where(~ok | F.col("_env").isNull()).select(F.col("_raw").alias("value"))
    return rows, rejects


def read_stream(spark: SparkSession, source: str, fmt: str = "json", schema: T.StructType | None = None,
                max_files_per_trigger: int | None = None, max_offsets_per_trigger: int | None = None,
                options: Mapping[str, str] | None = None) -> DataFrame:
    """T02 source side: a Kafka topic (``fmt='kafka'``, from the earliest
    offset, at most ``max_offsets_per_trigger`` messages per batch) or a file
    stream (at most ``max_files_per_trigger`` files per batch)."""
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        r = r.option("subscribe", source).option("startingOffsets", "earliest")
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    else:
        if schema is not None:
            r = r.schema(schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load() if fmt == "kafka" else r.load(source)


def ingest_once(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Process everything available now in rate-limited micro-batches,
    then stop; the checkpoint makes re-runs continue (exactly-once file sink)."""
    w = (stream.writeStream.format(fmt).option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


def land(stream: DataFrame, root: str, checkpoint: str, ts: str = "event_time",
         fmt: str = "parquet") -> StreamingQuery:
    """Landing files by event date, ``dt=YYYY-MM-DD`` directories."""
    s = stream.withColumn("dt", F.date_format(F.col(ts), "yyyy-MM-dd"))
    return ingest_once(s, root, checkpoint, fmt=fmt, partition_by=["dt"])


def hourly_summary(df: DataFrame, ts: str, keys: Sequence[str], value: str,
                   watermark: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Per event-time window and key: total, count and mean of ``value``.

    On a stream the watermark bounds the state and a window is emitted once
    (append mode) when the watermark passes its end. Input rows are dropped
    as late against the watermark of the previous micro-batch (Spark's rule
    for late events), so the result is exact for data within the delay. On a
    batch DataFrame the same plan is a plain grouped aggregate."""
    t = F.col(ts)
    base = df.withColumn(ts, t.cast("timestamp"))
    if df.isStreaming:
        base = base.withWatermark(ts, watermark)
    g = base.groupBy(F.window(ts, window).alias("w"), *keys).agg(
        F.sum(value).alias("total_value"), F.count(F.lit(1)).alias("events"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), *keys,
                    "total_value", "events",
                    F.try_divide(F.col("total_value").cast("double"), F.col("events").cast("double"))
                     .alias("avg_value"))


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str = "event_time",
                 delay: str = "1 hour") -> DataFrame:
    """Drop repeated keys seen within the watermark delay (state bounded
    by the watermark)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def _source_of(topic: str) -> str:
    return topic.split("-", 1)[1] if "-" in topic else topic


def route(stream: DataFrame, schemas: Mapping[str, T.StructType], out_root: str, checkpoint: str,
          cfg: Mapping | None = None, topic_col: str = "topic", value_col: str = "value",
          writer: Callable[[DataFrame, str], None] | None = None,
          reference: Mapping[str, DataFrame] | None = None) -> StreamingQuery:
    """Per micro-batch, split messages by topic, parse each topic's
    envelope, apply that source's cleaning rules and write to the mapped
    output (``raw-orders`` -> ``processed-orders`` ...).

    Each batch owns the folder ``batch_id=N`` of an output and overwrites it, so
    a batch that is run again leaves no second copy. Messages that don't parse
    and messages of a topic without target or schema are kept in ``rejects``
    with their topic and reason.

    Means, modes, quartiles and votes on layouts come from ``reference`` (rows per
    source) or else from all batches so far: each adds its counts under
    ``state/<source>`` and keeps its parsed rows there, from which ``settle`` cleans a
    source once more with the statistics of the whole stream."""
    cfg = cfg or DEFAULT_RULES
    block = cfg["streaming"]
    targets = dict(block.get("kafka", block)["output_topics"])
    known = [t for t in targets if t in schemas]

    def write(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)

    sink = writer or write

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch is read once and split by topic from the cached copy
        batch = batch.select(topic_col, value_col).persist()
        try:
            other = F.col(topic_col).isNull() | ~F.col(topic_col).isin(known)
            rejected = batch.where(other).select(F.col(topic_col).alias("topic"), F.lit("no route").alias("reason"),
                                                 F.col(value_col).cast("string").alias("value"))
            for topic in known:
                part = batch.where(F.col(topic_col) == topic).select(F.col(value_col).alias("value"))
                rows, bad = parse_envelope(part, schemas[topic])
                rejected = rejected.unionByName(bad.select(
                    F.lit(topic).alias("topic"), F.lit("not an envelope").alias("reason"), "value"))
                source = _source_of(topic)
                given = (reference or {}).get(source)
                state = f"{out_root}/state/{source}"
                if given is None:
                    rows.write.mode("overwrite").parquet(f"{state}/rows/batch_id={batch_id}")
                    rows = rows.sparkSession.read.schema(rows.schema).parquet(f"{state}/rows/batch_id={batch_id}")
                running = RunningStatistics(state, batch_id) if given is None else None
                cleaned = clean(rows, cfg, source, timestamp_col=False, stats_from=given, running=running)
                sink(cleaned, f"{out_root}/{targets[topic]}/batch_id={batch_id}")
            sink(rejected, f"{out_root}/rejects/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def settle(spark: SparkSession, source: str, out_root: str, out: str, cfg: Mapping | None = None) -> None:
    """All rows that ``route`` has kept of a source, cleaned as one table: duplicates
    across batches go and every row is judged by the statistics of all, however the
    stream was cut into batches."""
    rows = spark.read.parquet(f"{out_root}/state/{source}/rows").drop("batch_id")
    clean(rows, cfg or DEFAULT_RULES, source, timestamp_col=False).write.mode("overwrite").parquet(out)


def replay_files(df: DataFrame, out_dir: str, batch: int = 100) -> None:
    """T07 (producer): write rows as JSON files of at most ``batch`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", str(batch)).json(out_dir)


def replay_stream(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """T07 (consumer): one file - at most ``batch`` rows - per micro-batch."""
    return read_stream(spark, out_dir, "json", schema, max_files_per_trigger=1)
