"""An append-only journal as a stream: the checks that need no look ahead, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions import text as T
from chroniq.plans.contract import EVENT

SCHEMA = "journal_id string, id string, type string, summary string, at timestamp"


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """Events appended as JSON lines in new files below ``path``."""
    return spark.readStream.schema(SCHEMA).json(path)


def once(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each event of a journal once; a repeat within the watermark is dropped, and so is state older than it."""
    return events.withWatermark("at", delay).dropDuplicatesWithinWatermark(["journal_id", "id"])


def malformed(events: DataFrame) -> DataFrame:
    """Events with a malformed id or without a summary, as they come."""
    return events.filter(~F.coalesce(T.full_match("id", EVENT), F.lit(False)) | (F.coalesce(F.col("summary"), F.lit("")) == ""))


def activity(events: DataFrame, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Events of each type in each window, by event time; a window is final once the watermark has passed it."""
    counts = events.withWatermark("at", delay).groupBy(F.window("at", window), "type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), "type", "n")
