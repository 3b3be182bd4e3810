"""Batch twin of the hourly streaming summary (T04) over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.ingest import hourly_summary
from .fixtures import table
from .registry import register


@register("t04_hourly_summary", """
WITH e AS (SELECT ts, event_type, CAST(value AS DECIMAL(12,2)) AS v FROM events)
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, CAST(SUM(v) AS DOUBLE) AS total_value, COUNT(*) AS events,
       CAST(SUM(v) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_value
FROM e GROUP BY 1, 2, 3""")
def t04(spark, d):
    ev = table(spark, d, "events").select("ts", "event_type",
                                          F.col("value").cast("decimal(12,2)").alias("value"))
    return hourly_summary(ev, "ts", ["event_type"], "value")
