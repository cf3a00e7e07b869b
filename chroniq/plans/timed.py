"""Queries along time and order on the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.operators import ordered as O
from chroniq.operators import state as S
from chroniq.operators import temporal as X
from chroniq.sources.stored import Scratch

DAY = 86_400.0


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def asof_order_of_events(spark, d):
    """The event before each error of any user, as an as-of join of two streams of one day's bins."""
    e = _t(spark, d, "events")
    errors = e.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    others = e.filter("event_type <> 'error'").select("user_id", F.col("ts").alias("seen"), F.col("event_id").alias("before_id"), F.col("event_type").alias("before_type"))
    return X.asof(errors, others, "user_id", "ts", "seen", "before_id", ["before_id", "before_type"], DAY).select("event_id", "before_id", "before_type")


def overlapping_orders(spark, d):
    """Pairs of a customer's orders that were under way at the same time: from the order to its last shipment."""
    o, li = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    last = li.groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_shipdate").alias("stop"))
    spans = o.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start")).join(last, "id").select("custkey", "id", "start", "stop")
    spans = Scratch(spark).store(spans, "spans")
    return X.overlaps(spans, spans, ["custkey"], 30 * DAY).filter("left_id < right_id")


def numbered_events(spark, d):
    """Each event's number in the order of all, and the event before with the microseconds since."""
    scratch = Scratch(spark)
    e = O.numbered(_t(spark, d, "events").select("ts", "event_id"), ["ts", "event_id"], "n", scratch)
    e = O.neighbours(e, ["ts", "event_id"], ["ts", "event_id"], scratch)
    since = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("previous_ts").cast("timestamp"))
    return e.select("event_id", "n", F.col("previous_event_id").alias("before_id"), since.alias("since"))


def _rebase(spark, d):
    o = _t(spark, d, "orders")
    latest = lambda df: df.groupBy(F.col("o_custkey").alias("target")).agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("value"))
    early, package = o.filter("o_orderkey % 4 < 2"), o.filter("o_orderkey % 3 = 0")
    return latest(early), latest(o.filter("o_orderkey % 4 < 3")), latest(package).withColumn("value", F.when(F.col("target") % 50 != 7, F.col("value")))


def rebase_orders(spark, d):
    """Customers' priorities: a package made on an older state, carried over to a newer one."""
    return S.rebase(*_rebase(spark, d))


def rebase_conflicts(spark, d):
    return S.conflicts(*_rebase(spark, d))


QUERIES = {f.__name__: f for f in (asof_order_of_events, overlapping_orders, numbered_events, rebase_orders, rebase_conflicts)}

_LATEST = "SELECT o_custkey AS target, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS value FROM orders WHERE {} GROUP BY o_custkey"
_MERGED = f"""WITH was AS ({_LATEST.format('o_orderkey % 4 < 2')}), now AS ({_LATEST.format('o_orderkey % 4 < 3')}), mine AS (SELECT target, CASE WHEN target % 50 <> 7 THEN value END AS value FROM ({_LATEST.format('o_orderkey % 3 = 0')})),
    m AS (SELECT target, was.value AS was, now.value AS now, mine.value AS mine, CASE WHEN mine.target IS NULL THEN 'current' WHEN now.value IS NOT DISTINCT FROM mine.value THEN 'agreed' WHEN now.value IS NOT DISTINCT FROM was.value THEN 'applied'
    WHEN mine.value IS NOT DISTINCT FROM was.value THEN 'unchanged' ELSE 'conflict' END AS outcome FROM now FULL JOIN mine USING (target) LEFT JOIN was USING (target))"""
ORACLES = {
    "asof_order_of_events": """SELECT event_id, max_by(before_id, (seen, before_id)) AS before_id, max_by(before_type, (seen, before_id)) AS before_type FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error') e
        LEFT JOIN (SELECT user_id, ts AS seen, event_id AS before_id, event_type AS before_type FROM events WHERE event_type <> 'error') o ON o.user_id = e.user_id AND o.seen <= e.ts GROUP BY event_id""",
    "overlapping_orders": """WITH s AS (SELECT o_custkey AS custkey, o_orderkey AS id, o_orderdate AS start, max(l_shipdate) AS stop FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL HAVING o_orderdate <= max(l_shipdate))
        SELECT a.custkey, a.id AS left_id, b.id AS right_id FROM s a JOIN s b ON a.custkey = b.custkey AND a.id < b.id AND a.start <= b.stop AND b.start <= a.stop""",
    "numbered_events": "SELECT event_id, row_number() OVER w AS n, lag(event_id) OVER w AS before_id, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS since FROM events WINDOW w AS (ORDER BY ts, event_id)",
    "rebase_orders": f"{_MERGED} SELECT target, CASE WHEN outcome = 'applied' THEN mine ELSE now END AS value, outcome FROM m",
    "rebase_conflicts": f"{_MERGED} SELECT target, was, now, mine FROM m WHERE outcome = 'conflict'",
}
