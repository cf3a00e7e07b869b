"""Links between rows: what a chain of references leads to, and how far, without walking it step by step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.sources.stored import Scratch


def ancestors(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, root, depth of links (node, parent), each node once; null root and depth where a chain runs into a circle.

    A node without a parent, or whose parent is no node, is a root of depth 0. Pointers are doubled: each round a node takes over
    the pointer of what it points at, so a chain of n links takes log2(n) rounds. Each round is stored and replaces the one before;
    its joins read stored tables on both sides, so a root that very many nodes point at can be split.
    """
    scratch, mine = scratch or Scratch(links.sparkSession), []
    known = links.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    d = links.join(known, "parent", "left").select("node", F.when(F.col("there"), F.col("parent")).otherwise(F.col("node")).alias("to"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"))
    state, before = scratch.store(d.withColumn("settled", F.col("depth") == 0), "links"), None
    mine.append(state)
    while True:
        at = state.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"), F.col("settled").alias("there"))
        d = state.join(at, "to").select("node", F.when(F.col("settled"), F.col("to")).otherwise(F.col("next")).alias("to"), F.when(F.col("settled"), F.col("depth")).otherwise(F.col("depth") + F.col("more")).alias("depth"), (F.col("settled") | F.col("there")).alias("settled"))
        state = scratch.store(d, "links")
        mine.append(state)
        left = state.filter("not settled").count()
        if not left or left == before:  # chains settle from their roots on: what no longer shrinks is circles and what leads there
            return state.select("node", F.when(F.col("settled"), F.col("to")).alias("root"), F.when(F.col("settled"), F.col("depth")).alias("depth"))
        before = left


def forks(links: DataFrame) -> DataFrame:
    """parent, children of the nodes that more than one node names as its parent."""
    return links.filter("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("children")).filter("children > 1")


def reached(links: DataFrame, starts: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, steps of all that links (source, target) lead to from ``starts`` (node), by the fewest steps; a round for each step."""
    scratch = scratch or Scratch(links.sparkSession)
    found = scratch.store(starts.select("node").distinct().withColumn("steps", F.lit(0)), "found")
    front, n = found, 0
    while True:
        n += 1
        step = front.join(links, F.col("node") == F.col("source")).select(F.col("target").alias("node")).distinct()
        front = scratch.store(step.join(found.select("node"), "node", "left_anti").withColumn("steps", F.lit(n)), "front")
        if not front.limit(1).count():
            return found
        found = scratch.store(found.unionByName(front), "found")
