"""States of approximate aggregates that are stored by key and merged later, so a total never reads the rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct count, and nominal entries of a set, each as a power of two; and the relative error that both keep in nearly
#: all cases: four standard errors of the coarser one.
HLL_BITS, THETA_BITS = 14, 13
ERROR = 4 / (1 << THETA_BITS) ** 0.5


def states(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, rows, count_state, set_state) of each key, of the distinct values of a column; nulls are no values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(column, F.lit(HLL_BITS)).alias("count_state"), F.theta_sketch_agg(column, F.lit(THETA_BITS)).alias("set_state"))


def merged(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The states of coarser keys from those of finer ones; what is merged is combined before it is exchanged."""
    return stored.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("count_state").alias("count_state"), F.theta_union_agg("set_state", F.lit(THETA_BITS)).alias("set_state"))


def estimates(stored: DataFrame) -> DataFrame:
    """With ``distinct``, the number of distinct values that the state of each row stands for."""
    return stored.withColumn("distinct", F.hll_sketch_estimate("count_state"))


def common(stored: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """(left, right, common) for each pair of keys that is asked for: about how many values both have."""
    d = pairs.select("left", "right")
    for side in ("left", "right"):
        d = d.join(stored.select(F.col(key).alias(side), F.col("set_state").alias(f"s_{side}")), side)
    return d.select("left", "right", F.theta_sketch_estimate(F.theta_intersection("s_left", "s_right")).alias("common"))
