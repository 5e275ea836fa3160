"""Streaming jobs, run over the driver tables until their input is drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomset.session import scratch_path
from loomset.streaming import jobs

from . import sqltext as S
from .registry import query, table


def stream_of(spark, sf, name):
    return jobs.file_stream(spark, sf, f"{name}.parquet", table(spark, sf, name).schema)


def errors(spark, sf):
    return stream_of(spark, sf, "events").where("event_type = 'error'")


@query("stream_clean", f"SELECT doc_id, text FROM (SELECT doc_id, {S.clean_text()} AS text FROM documents) WHERE {S.is_valid_text()}")
def stream_clean(spark, sf):
    arriving = stream_of(spark, sf, "documents").select("doc_id", "text")
    cleaned = jobs.clean_stream(arriving)
    return jobs.drain(cleaned, "stream-clean")


# which row of a key comes first depends on arrival; the keys do not
@query("stream_exact_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_exact_dedup(spark, sf):
    events = stream_of(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    kept = jobs.first_arrivals(events, ["user_id", "event_type"], "ts", "40 days")
    return jobs.drain(kept, "stream-dedup", settings=jobs.ROCKSDB).select("user_id", "event_type")


@query("stream_error_rate", """
WITH e AS (SELECT ts FROM events WHERE event_type = 'error'), m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM e),
h AS (SELECT 'hour' AS span, date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS stop, count(*) AS n FROM e GROUP BY ALL),
d AS (SELECT 'day' AS span, s AS start, s + INTERVAL 24 HOUR AS stop, count(*) AS n FROM (SELECT unnest(range(date_trunc('hour', ts) - INTERVAL 23 HOUR, date_trunc('hour', ts) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS s FROM e) GROUP BY s)
SELECT span, strftime(start, '%Y-%m-%d %H:%M') AS start, n FROM (SELECT * FROM h UNION ALL SELECT * FROM d), m WHERE stop <= mark""")
def stream_error_rate(spark, sf):
    parts = []
    for span, length, slide in (("hour", "1 hour", None), ("day", "24 hours", "1 hour")):
        source = errors(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"))
        made = jobs.drain(jobs.rate(source, "ts", "10 minutes", length, slide), f"stream-{span}")
        parts.append(made.select(F.lit(span).alias("span"), F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n"))
    return parts[0].unionByName(parts[1])


# the state is followed event by event; breakers stay open for a day, and what the last watermark has not passed stays out
@query("stream_circuit_breaker", """
WITH RECURSIVE e AS (SELECT user_id AS key, event_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'error' AND value > 10),
m AS (SELECT max(t) // 1000 * 1000 - 600000000 AS mark FROM e),
w AS (
  SELECT key, event_id, t, n, 1::BIGINT AS failures, false AS open, 0::BIGINT AS reset, 0::BIGINT AS closed FROM e, m WHERE n = 1 AND t <= mark
  UNION ALL
  SELECT key, event_id, t, n, failures, failures >= 5 AS open, CASE WHEN failures >= 5 THEN t + 86400000000 ELSE reset END AS reset, closed
  FROM (SELECT e.key, e.event_id, e.t, e.n, w.reset, CASE WHEN w.open AND e.t > w.reset THEN w.reset ELSE 0 END AS closed,
               CASE WHEN w.open AND e.t > w.reset THEN 1 ELSE w.failures + 1 END AS failures FROM w JOIN e ON e.key = w.key AND e.n = w.n + 1, m WHERE e.t <= mark)),
ends AS (SELECT key, max_by(open, n) AS open, max_by(reset, n) AS reset FROM w GROUP BY key)
SELECT key, event_id, failures, open FROM w
UNION ALL SELECT key, NULL, 0, false FROM w WHERE closed > 0
UNION ALL SELECT key, NULL, 0, false FROM ends, m WHERE open AND reset < mark""")
def stream_circuit_breaker(spark, sf):
    severe = errors(spark, sf).where("value > 10")
    return jobs.drain(jobs.circuit_breaker(severe, "user_id", 5, 60 * 24), "stream-breaker", settings=jobs.ROCKSDB).drop("ts")


@query("stream_metrics_table", """
SELECT user_id AS run, CAST(date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) AS BIGINT) AS epoch, arg_max(value, (ts, event_id)) AS metric, max(event_id) FILTER (true) >= 0 AS seen FROM events GROUP BY 1, 2""")
def stream_metrics_table(spark, sf):
    events = stream_of(spark, sf, "events")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    rows = events.select(F.col("user_id").alias("run"), day.alias("epoch"), F.col("value").alias("metric"), "ts", "event_id")
    path = scratch_path(spark, "metrics")
    jobs.upsert_latest(rows, path, scratch_path(spark, "metrics-checkpoint"), ["run", "epoch"], ["ts", "event_id"])
    table_ = jobs.read_latest(spark, path, ["run", "epoch"], ["ts", "event_id"])
    return table_.select("run", "epoch", "metric", (F.col("event_id") >= 0).alias("seen"))
