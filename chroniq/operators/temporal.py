"""Joins along time: the latest row before each row, and intervals that overlap. Neither pairs rows that don't belong together.

Time is cut into bins, so a key that very many rows share is spread over its bins, and what a bin needs of those before
it is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of the left side in a bin from which on it is dealt to several tasks.
BIN_ROWS = 100_000
#: Rows of both sides up to which a key's intervals are paired without bins.
KEY_ROWS = 4_096


def seconds(time: Column) -> Column:
    """Seconds of a time stamp or date, with their fractions."""
    return F.unix_micros(time.cast("timestamp")) / 1_000_000


def asof(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, tie: str, columns: list[str], width: float) -> DataFrame:
    """Each row of ``left`` with ``columns`` of the latest row of ``right`` of its key that is not later; null without one.

    Of rows of ``right`` at the same time the one of the largest ``tie`` counts. Both sides go through a window of (key, bin of ``width``
    seconds); a row that finds nothing in its bin takes the last row of the bins before, of which there is one for each bin. Null keys and
    null times find nothing.
    """
    payload = F.struct(F.col(right_time).alias("_t"), F.col(tie).alias("_tie"), *[F.col(c) for c in columns])
    own = F.struct(*[F.col(c) for c in left.columns])
    a = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), own.alias("_l"))
    b = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), payload.alias("_r"))
    rows = a.unionByName(b, allowMissingColumns=True).withColumn("_bin", F.floor(seconds(F.col("_t")) / width))
    inside = W.partitionBy("_k", "_bin").orderBy("_t", "_side", "_r._tie").rowsBetween(W.unboundedPreceding, 0)
    found = rows.withColumn("_in", F.last("_r", ignorenulls=True).over(inside)).filter("_side = 1")
    # the last row of each bin, and for each bin that of the bins before
    bins = rows.filter("_bin is not null").groupBy("_k", "_bin").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.struct("_t", "_r._tie"))).alias("_last"))
    before = bins.select(F.col("_k").alias("_bk"), F.col("_bin").alias("_bb"), F.last("_last", ignorenulls=True).over(W.partitionBy("_k").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    d = found.join(before, (F.col("_k") == F.col("_bk")) & (F.col("_bin") == F.col("_bb")), "left")
    r = F.when(F.col("_k").isNotNull() & F.col("_t").isNotNull(), F.coalesce("_in", "_before"))
    return d.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns], *[r[c].alias(c) for c in columns])


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], width: float, bin_rows: int = BIN_ROWS) -> DataFrame:
    """(keys, left_id, right_id) of each pair of intervals (keys, id, start, stop) of equal keys that have a point in common.

    Intervals of a key of ``KEY_ROWS`` rows or fewer on both sides together (of ``bin_rows``, if that is less) are joined by their key alone. Of other keys, an interval lies in
    each bin of ``width`` seconds that it touches; a pair is formed in one bin only, that of the later of both starts. A bin of more than ``bin_rows`` rows
    of the left side is dealt to as many tasks as that asks for, to each of which the right side's rows of the bin are sent. Ends are
    included; an interval that ends before it starts, or lacks either, meets nothing. Both sides are read several times: store them, if they are costly.
    """
    named = lambda df, side: df.filter(F.col("start") <= F.col("stop")).select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in ("id", "start", "stop")])
    a, b = named(left, "left"), named(right, "right")
    # large keys and hot bins are few, as each has that many rows: they are broadcast, and neither side is exchanged to tell them
    rows = a.select(*keys).unionByName(b.select(*keys)).groupBy(*keys).count()
    large = F.broadcast(rows.filter(F.col("count") > min(KEY_ROWS, bin_rows)).select(*keys))
    meet = (F.col("left_start") <= F.col("right_stop")) & (F.col("right_start") <= F.col("left_stop"))
    few = a.join(large, keys, "left_anti").join(b.join(large, keys, "left_anti"), keys).filter(meet)
    of = lambda c: F.floor(seconds(F.col(c)) / width)
    binned = lambda df, side: df.join(large, keys, "left_semi").withColumn("_bin", F.explode(F.sequence(of(f"{side}_start"), of(f"{side}_stop"))))
    a, b = binned(a, "left"), binned(b, "right")
    hot = F.broadcast(a.groupBy(*keys, "_bin").count().filter(F.col("count") > bin_rows).select(*keys, "_bin", F.ceil(F.col("count") / bin_rows).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    a = a.join(hot, [*keys, "_bin"], "left").withColumn("_part", F.pmod(F.xxhash64("left_id"), parts).cast("int")).drop("_parts")
    b = b.join(hot, [*keys, "_bin"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    met = a.join(b, [*keys, "_bin", "_part"]).filter(meet)
    met = met.filter(F.col("_bin") == F.floor(seconds(F.greatest("left_start", "right_start")) / width))
    return few.select(*keys, "left_id", "right_id").unionByName(met.select(*keys, "left_id", "right_id"))
