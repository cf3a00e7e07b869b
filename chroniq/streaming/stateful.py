"""Streams with state of their own: sessions by event time, and references that are used before anything introduces them.

Both hold back what may still change until the watermark has passed it, and what they keep is bounded by that: open
sessions, uses that wait, and one time for each reference.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chroniq.sources.stored import scratch_path

UNKNOWN, HELD = "ref long, id long, at timestamp", "earliest long, ids array<long>, ats array<long>"


def sessions(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """ref, start, last, n: the runs of each reference's events (ref, id, at) that are less than ``gap`` apart, once the watermark has passed them."""
    d = events.withWatermark("at", delay).groupBy("ref", F.session_window("at", gap).alias("w")).agg(F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))
    return d.select("ref", F.col("w.start").alias("start"), "last", "n")


def unknown_uses(events: DataFrame, delay: str) -> DataFrame:
    """ref, id, at of uses that nothing has introduced before, of events (ref, id, at, introduces) in any order within ``delay``.

    A use waits until the watermark has passed it, as an introduction before it may come later; then it is
    judged by the earliest one. Of a reference only that time and the uses that wait are kept.
    """

    def step(key, batches, state: GroupState):
        earliest, ids, ats = state.get if state.exists else (None, [], [])
        ids, ats = list(ids), list(ats)
        for b in batches:  # a reference has few rows: arrays take a fraction of what series cost for each
            at, id_, introduces = b["at"].to_numpy("datetime64[us]"), b["id"].to_numpy(), b["introduces"].to_numpy()
            there = ~np.isnat(at) & ~pd.isna(introduces)
            at, id_, introduces = at[there].astype("int64"), id_[there], introduces[there].astype(bool)
            if introduces.any():
                first = int(at[introduces].min())
                earliest = first if earliest is None else min(earliest, first)
            ids += id_[~introduces].tolist()
            ats += at[~introduces].tolist()
        passed = state.getCurrentWatermarkMs() * 1000
        out = [(i, t) for i, t in zip(ids, ats, strict=True) if t < passed and (earliest is None or earliest >= t)]
        wait = [(i, t) for i, t in zip(ids, ats, strict=True) if t >= passed]
        if earliest is None and not wait:
            if state.exists:
                state.remove()
        else:
            state.update((earliest, [i for i, _ in wait], [t for _, t in wait]))
            if wait:
                state.setTimeoutTimestamp(max(min(t for _, t in wait), passed) // 1000 + 1)
        if out:
            yield pd.DataFrame({"ref": [key[0]] * len(out), "id": [i for i, _ in out], "at": np.array([t for _, t in out], "datetime64[us]")})

    return events.withWatermark("at", delay).groupBy("ref").applyInPandasWithState(step, UNKNOWN, HELD, "append", GroupStateTimeout.EventTimeTimeout)


def ended(events: DataFrame, path: str, files: int = 4) -> None:
    """Write events in the order of their time, as files for a stream, and last a row far ahead that lets the watermark pass them all."""
    spark = events.sparkSession
    events.repartitionByRange(files, "at").write.parquet(path)
    none = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "at" else (F.col("last") + F.expr("INTERVAL 10 YEARS")).cast(f.dataType).alias("at") for f in events.schema]
    last = spark.read.parquet(path).agg(F.max("at").alias("last")).filter("last is not null")
    last.select(*none).coalesce(1).write.mode("append").parquet(path)


def run_through(spark: SparkSession, source: str, schema, transform, files_at_once: int = 2) -> tuple[DataFrame, int]:
    """What a stream over files gives until they are read, as a stored table, and how many rows came too late for it."""
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    stream = transform(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source))
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return spark.read.schema(stream.schema).parquet(out), late
