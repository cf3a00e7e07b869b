"""Numbers and neighbours in a table's global order, without a task that sees the whole table.

Rows are dealt to ranges of the order and stored with their range's number. Within a range a window numbers them; what
ranges tell each other is one row each: how many rows they hold, and their last row. There are as many ranges as shuffle partitions,
so these rows are collected, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as t

from chroniq.sources.stored import Scratch


def _ranges(df: DataFrame, order: list[str], scratch: Scratch, parts: int | None) -> DataFrame:
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.store(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, order: list[str], name: str, scratch: Scratch | None = None, parts: int | None = None) -> DataFrame:
    """Each row with its number, from 1, in the order of columns that tell all rows apart; nulls come first."""
    spark = df.sparkSession
    ranged = _ranges(df, order, scratch or Scratch(spark), parts)
    before, total = [], 0
    for r in sorted(ranged.groupBy("_range").count().collect()):
        before.append((r["_range"], total))
        total += r["count"]
    offsets = spark.createDataFrame(before, "_range int, _before long")
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*order)).cast("long")
    return ranged.withColumn("_n", inside).join(F.broadcast(offsets), "_range").select(*df.columns, (F.col("_before") + F.col("_n")).alias(name))


def neighbours(df: DataFrame, order: list[str], columns: list[str], scratch: Scratch | None = None, parts: int | None = None) -> DataFrame:
    """Each row with ``previous_`` and the name of each column: its value in the row before, null in the first row.

    ``order`` has columns that tell all rows apart.
    """
    spark = df.sparkSession
    ranged = _ranges(df, order, scratch or Scratch(spark), parts)
    kept = F.struct(*[F.col(c) for c in columns])
    last = sorted(ranged.groupBy("_range").agg(F.max_by(kept, F.struct(*order)).alias("last")).collect(), key=lambda r: r["_range"])
    edges = [(b["_range"], a["last"]) for a, b in zip(last[:-1], last[1:], strict=True)]
    schema = t.StructType([t.StructField("_range", t.IntegerType()), t.StructField("_edge", t.StructType([df.schema[c] for c in columns]))])
    # the row before within the range, else the last row of the range before
    inside = F.lag(kept).over(W.partitionBy("_range").orderBy(*order))
    d = ranged.withColumn("_inside", inside).join(F.broadcast(spark.createDataFrame(edges, schema)), "_range", "left").withColumn("_before", F.coalesce("_inside", "_edge"))
    return d.select(*df.columns, *[F.col(f"_before.{c}").alias(f"previous_{c}") for c in columns])
