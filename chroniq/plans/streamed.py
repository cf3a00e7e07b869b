"""Queries that run as streams over the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.sources.stored import scratch_path
from chroniq.streaming import stateful as X


def _through(spark: SparkSession, d: str, transform) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").filter("event_type in ('signup', 'purchase')")
    e = e.select(F.col("user_id").alias("ref"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_type") == "signup").alias("introduces"))
    path = scratch_path(spark, "events")
    X.ended(e, path)
    return X.run_through(spark, path, e.schema, transform)[0].filter("ref is not null")


def stream_unknown_uses(spark, d):
    """Purchases of users that have not signed up before, by a stream over the events."""
    return _through(spark, d, lambda s: X.unknown_uses(s, "1 hour")).select(F.col("id").alias("event_id"), F.col("ref").alias("user_id"))


def stream_sessions(spark, d):
    """Runs of a user's signups and purchases less than 30 days apart, by a stream over the events."""
    out = _through(spark, d, lambda s: X.sessions(s, "30 days", "1 hour"))
    return out.select(F.col("ref").alias("user_id"), F.unix_micros("start").alias("start"), F.unix_micros("last").alias("last"), "n")


QUERIES = {f.__name__: f for f in (stream_unknown_uses, stream_sessions)}
ORACLES = {
    "stream_unknown_uses": "SELECT event_id, user_id FROM events e WHERE event_type = 'purchase' AND user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND s.ts < e.ts)",
    "stream_sessions": """WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events WHERE event_type IN ('signup', 'purchase') AND user_id IS NOT NULL),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t) AS run FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < 30 * 86400000000 THEN 0 ELSE 1 END AS new FROM e))
        SELECT user_id, min(t) AS start, max(t) AS last, count(*) AS n FROM s GROUP BY user_id, run""",
}
