"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import Scratch


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges (a, b) connect."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        np.minimum.at(label, before[u], low)
        np.minimum.at(label, before[v], low)
        label = label[label]
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def components(edges: DataFrame) -> DataFrame:
    """(id, label): label is the smallest id of the component, for ids that have an edge; a stored table.

    ``edges`` has columns src and dst, read from storage. Each round takes the smallest label among the
    neighbours and then the label of the label, so the rounds grow with the logarithm of a component's
    width. Every join reads stored tables on both sides, so that a hub's rows can be split, and every
    aggregate is combined before its exchange.
    """
    scratch = Scratch(edges.sparkSession)
    rows = 2 * edges.count()
    both = scratch.store(edges.union(edges.select("dst", "src")).distinct(), "edges", rows)
    label = scratch.store(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("m")).select("id", F.least("id", "m").alias("label")), "labels", rows)
    while True:
        told = both.join(label, both.dst == label.id).select(F.col("src").alias("id"), "label", F.lit(None).cast("long").alias("old"))
        own = label.select("id", "label", F.col("label").alias("old"))
        low = scratch.store(told.union(own).groupBy("id").agg(F.min("label").alias("label"), F.max("old").alias("old")), "low", rows)
        to = low.select(F.col("id").alias("to"), F.col("label").alias("next"))
        new = scratch.store(low.join(to, low.label == F.col("to")).select("id", F.least("label", "next").alias("label"), "old"), "labels", rows)
        changed = new.filter("label <> old").limit(1).count()
        scratch.drop(both, new)  # the round before is stored in this one
        if not changed:
            scratch.drop(new)
            return new.select("id", "label")
        label = new.select("id", "label")
