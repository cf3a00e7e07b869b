"""Queries over links and stored sketches on the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.operators import graph as G
from chroniq.operators import sketches as K
from chroniq.sources.stored import Scratch


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _chains(spark, d) -> DataFrame:
    """Each order with the one of its customer before it; a tenth of them begin anew, some customers' first order follows their last one."""
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.lag("o_orderkey").over(w).alias("before"), F.max("o_orderkey").over(W.partitionBy("o_custkey")).alias("last"))
    parent = F.when(F.col("before").isNull() & (F.col("o_custkey") % 97 == 5), F.col("last")).when(F.col("o_orderkey") % 10 != 3, F.col("before"))
    return o.select(F.col("o_orderkey").alias("node"), parent.alias("parent"))


def order_chains(spark, d):
    """The order that each order's chain begins with, and how far that is; null where a chain is a circle."""
    return G.ancestors(_chains(spark, d))


def order_forks(spark, d):
    """Orders that several are based on: each third order is based on the first of its customer's."""
    first = F.min("o_orderkey").over(W.partitionBy("o_custkey"))
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("node"), F.when(F.col("o_orderkey") % 3 == 0, first).alias("parent")).filter("node <> parent")
    return G.forks(o)


def pages_reached(spark, d):
    """Steps from the page 1 along links from each page to twice its number and the next."""
    p = _t(spark, d, "pages").select(F.col("page_id").alias("source")).filter("source % 11 <> 7")
    links = p.select("source", F.explode(F.array(F.col("source") * 2, F.col("source") * 2 + 1)).alias("target")).join(_t(spark, d, "pages").select(F.col("page_id").alias("target")), "target", "left_semi")
    return G.reached(links.select("source", "target"), p.filter("source = 1").select(F.col("source").alias("node")), Scratch(spark))


def _stored(spark, d) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_returnflag", F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("month"), "l_partkey")
    return K.merged(Scratch(spark).store(K.states(li, ["l_returnflag", "month"], "l_partkey"), "states"), ["l_returnflag"])


def sketched_parts(spark, d):
    """Distinct parts of each flag from states by month: the exact number, and whether the estimate is within its bound."""
    exact = _t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))
    got = K.estimates(_stored(spark, d)).join(exact, "l_returnflag")
    return got.select("l_returnflag", "rows", "parts", (F.abs(F.col("distinct") - F.col("parts")) <= K.ERROR * F.col("parts")).alias("within"))


def sketched_common(spark, d):
    """Parts that two flags have in common: the exact number, and whether the estimate is within its bound of the larger set."""
    p = _t(spark, d, "lineitem").select("l_returnflag", "l_partkey").distinct()
    a, b = (p.select(F.col("l_returnflag").alias(side), "l_partkey") for side in ("left", "right"))
    exact = a.join(b, "l_partkey").filter(F.col("left") < F.col("right")).groupBy("left", "right").agg(F.count(F.lit(1)).alias("parts"))
    bound = K.ERROR * p.select("l_partkey").distinct().agg(F.count(F.lit(1))).first()[0]
    pairs = spark.createDataFrame([("A", "N"), ("A", "R"), ("N", "R")], "left string, right string")
    return K.common(_stored(spark, d), "l_returnflag", pairs).join(exact, ["left", "right"]).select("left", "right", "parts", (F.abs(F.col("common") - F.col("parts")) <= bound).alias("within"))


QUERIES = {f.__name__: f for f in (order_chains, order_forks, pages_reached, sketched_parts, sketched_common)}
ORACLES = {
    "order_chains": """WITH RECURSIVE o AS (SELECT o_orderkey AS node, CASE WHEN before IS NULL AND o_custkey % 97 = 5 THEN last WHEN o_orderkey % 10 <> 3 THEN before END AS parent FROM
        (SELECT o_orderkey, o_custkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before, max(o_orderkey) OVER (PARTITION BY o_custkey) AS last FROM orders)),
        r AS (SELECT node, node AS root, 0::BIGINT AS depth FROM o WHERE parent IS NULL UNION ALL SELECT o.node, r.root, r.depth + 1 FROM o JOIN r ON o.parent = r.node)
        SELECT node, root, depth FROM o LEFT JOIN r USING (node)""",
    "order_forks": "SELECT parent, count(*) AS children FROM (SELECT o_orderkey AS node, CASE WHEN o_orderkey % 3 = 0 THEN min(o_orderkey) OVER (PARTITION BY o_custkey) END AS parent FROM orders) WHERE node <> parent GROUP BY parent HAVING count(*) > 1",
    "pages_reached": """WITH RECURSIVE r AS (SELECT page_id AS node, 0 AS steps FROM pages WHERE page_id = 1 UNION ALL SELECT p.page_id, steps + 1 FROM r JOIN pages p ON p.page_id IN (node * 2, node * 2 + 1) AND node % 11 <> 7) SELECT node, min(steps)::INTEGER AS steps FROM r GROUP BY node""",
    "sketched_parts": "SELECT l_returnflag, count(*) AS rows, count(DISTINCT l_partkey) AS parts, TRUE AS within FROM lineitem GROUP BY l_returnflag",
    "sketched_common": 'WITH p AS (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem) SELECT a.l_returnflag AS "left", b.l_returnflag AS "right", count(*) AS parts, TRUE AS within FROM p a JOIN p b USING (l_partkey) WHERE a.l_returnflag < b.l_returnflag GROUP BY ALL',
}
