"""Order, joins along time, rebase and streams against plain Python."""

import datetime as dt
import random
from urllib.parse import unquote

from pyspark.sql import functions as F

from chroniq.functions import text as T
from chroniq.operators import graph as G
from chroniq.operators import ordered as O
from chroniq.operators import sketches as K
from chroniq.operators import state as S
from chroniq.operators import temporal as X
from chroniq.streaming import stateful as Y

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def test_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), i, rng.choice(["x", None])) for i in range(300)] + [(None, 300, "n"), (None, 301, None)]
    df = spark.createDataFrame(rows, "a int, id int, v string").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for parts in (1, 7):
        assert [(r.a, r.id, r.v) for r in O.numbered(df, ["a", "id"], "n", parts=parts).orderBy("n").collect()] == want
        got = {r.id: (r.previous_id, r.previous_v) for r in O.neighbours(df, ["a", "id"], ["id", "v"], parts=parts).collect()}
        assert got == {r[1]: (p[1], p[2]) if p else (None, None) for r, p in zip(want, [None, *want[:-1]], strict=True)}
    assert O.numbered(df.filter("false"), ["a", "id"], "n").count() == 0 and O.neighbours(df.filter("false"), ["a", "id"], ["v"]).count() == 0


def test_asof(spark):
    """Ties go to the largest id, equal times count, bins are crossed; null keys and times find nothing."""
    rng = random.Random(2)
    right = [(rng.choice([1, 2, None]), rng.choice([*range(0, 400, 7), None]), i, f"v{i}") for i in range(80)]
    left = [(rng.choice([1, 2, 3, None]), rng.choice([*range(0, 420, 5), None]), i) for i in range(120)]
    a = spark.createDataFrame([(k, at(t), i) for k, t, i in left], "k int, t timestamp, id int")
    b = spark.createDataFrame([(k, at(t), i, v) for k, t, i, v in right], "key int, u timestamp, n int, v string").withColumnRenamed("key", "k")
    want = {}
    for k, t, i in left:
        ok = [(u, n, v) for k2, u, n, v in right if k is not None and k == k2 and t is not None and u is not None and u <= t]
        want[i] = max(ok)[2] if ok else None
    for minutes in (10, 60, 10_000):
        got = X.asof(a, b, "k", "t", "u", "n", ["v"], 60.0 * minutes)
        assert got.columns == ["k", "t", "id", "v"] and {r.id: r.v for r in got.collect()} == want
    assert X.asof(a, b.filter("false"), "k", "t", "u", "n", ["v"], 60.0).filter("v is not null").count() == 0


def test_overlaps(spark):
    rng = random.Random(3)
    make = lambda n: [(rng.choice([1, 2, None]), i, s, s + rng.randrange(-5, 60)) for i in range(n) for s in [rng.randrange(600)]]
    a, b = make(70), make(60)
    df = lambda rows: spark.createDataFrame([(k, i, at(s), at(e)) for k, i, s, e in rows] + [(1, 999, None, at(5))], "k int, id int, start timestamp, stop timestamp")
    want = sorted((k, i, j) for k, i, s, e in a for k2, j, s2, e2 in b if k is not None and k == k2 and s <= e and s2 <= e2 and s <= e2 and s2 <= e)
    for minutes, rows in ((10, 100), (45, 3), (10_000, 5)):  # hot bins are dealt to parts
        assert sorted(map(tuple, X.overlaps(df(a), df(b), ["k"], 60.0 * minutes, rows).collect())) == want


def test_overlaps_of_small_keys_need_no_bins(spark):
    """An interval of ten years, of a key of few rows, is not written once for each of its milliseconds; a key of many rows beside it is binned."""
    rng = random.Random(7)
    many = [(2, i, s, s + rng.randrange(90)) for i in range(100, 160) for s in [rng.randrange(400)]]
    few = [(1, 1, 0, 5_256_000), (1, 2, 60, 61), (1, 3, 5_256_001, 5_256_002)]
    df = lambda rows: spark.createDataFrame([(k, i, at(s), at(e)) for k, i, s, e in rows], "k int, id int, start timestamp, stop timestamp")
    met = lambda rows: sorted((k, i, j) for k, i, s, e in rows for k2, j, s2, e2 in rows if k == k2 and s <= e2 and s2 <= e)
    assert sorted(map(tuple, X.overlaps(df(few), df(few), ["k"], 0.001).collect())) == met(few)
    both = [(1, 1, 0, 50), (1, 2, 20, 30), *many]
    assert sorted(map(tuple, X.overlaps(df(both), df(both), ["k"], 600.0, 10).collect())) == met(both)


def test_rebase(spark):
    was, now = {"a": "1", "b": "1", "c": "1", "d": "1", "e": "1"}, {"a": "1", "b": "2", "c": "2", "d": "2", "f": "9"}
    mine = {"a": "3", "b": "3", "c": "2", "d": "1", "e": None, "g": "5", "f": "8"}
    table = lambda d: spark.createDataFrame(list(d.items()), "target string, value string")
    got = {r.target: (r.value, r.outcome) for r in S.rebase(table(was), table(now), table(mine)).collect()}
    assert got == {"a": ("3", "applied"), "b": ("2", "conflict"), "c": ("2", "agreed"), "d": ("2", "unchanged"), "e": (None, "agreed"), "f": ("9", "conflict"), "g": ("5", "applied")}
    assert sorted(map(tuple, S.conflicts(table(was), table(now), table(mine)).collect())) == [("b", "1", "2", "3"), ("f", None, "9", "8")]


def test_percent_escapes(spark):
    rng = random.Random(4)
    pool = ["%41", "%2b", "+", "%", "%4", "%zz", "%D0%B6", "%E2%82", "%FF", "x", "\u0436", "%25", " "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(9))) for _ in range(400)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.percent_decoded("t").alias("x")).collect()
    assert [r.x for r in got] == [unquote(t) for t in texts]


SCHEMA = "ref long, id long, at timestamp, introduces boolean"


def test_streams(spark, tmp_path):
    """Introductions that come out of order release what waits for them; late rows are counted; the state is bounded."""
    first = [(1, 10, at(50), False), (2, 20, at(40), False), (3, 30, at(10), True), (3, 31, at(20), False), (4, 40, at(55), False)]
    second = [(1, 11, at(45), True), (2, 21, at(60), True), (None, 0, at(61), False)]
    third = [(9, 90, at(10_000), True)]
    late = [(5, 50, at(5), False), (5, 51, at(10_001), False), (9, 91, at(10_002), False)]
    source = str(tmp_path / "events")
    for k, rows in enumerate((first, second, third, late)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    out, dropped = Y.run_through(spark, source, schema, lambda s: Y.unknown_uses(s, "30 minutes"), 1)
    assert {(r.ref, r.id) for r in out.collect()} - {(None, 0)} == {(2, 20), (4, 40)} and dropped == 1
    out, dropped = Y.run_through(spark, source, schema, lambda s: Y.sessions(s, "12 minutes", "30 minutes"), 1)
    got = {(r.ref, r.n) for r in out.collect() if r.ref is not None}
    assert got == {(1, 2), (2, 1), (3, 2), (4, 1)} and dropped == 1


def test_links(spark):
    """Chains of every length, trees, circles, missing parents; and steps from a start."""
    rng = random.Random(5)
    parent = {i: i - 1 if i % 40 else None for i in range(120)} | {200 + i: 200 + (i + 1) % 5 for i in range(5)} | {300: 202, 301: 300, 400: 999, 401: 400, 500: 500}
    parent |= {1000 + i: rng.choice([None, *range(1000, 1000 + i)]) for i in range(60)}
    links = spark.createDataFrame(list(parent.items()), "node int, parent int")

    def plain(n):
        seen, depth = set(), 0
        while parent.get(n) in parent:
            if n in seen:
                return None, None
            seen.add(n)
            n, depth = parent[n], depth + 1
        return n, depth

    assert {r.node: (r.root, r.depth) for r in G.ancestors(links).collect()} == {n: plain(n) for n in parent}
    assert G.ancestors(links.filter("false")).count() == 0
    children = [p for p in parent.values() if p is not None]
    assert {r.parent: r.children for r in G.forks(links).collect()} == {p: children.count(p) for p in children if children.count(p) > 1}
    edges = spark.createDataFrame([(rng.randrange(40), rng.randrange(40)) for _ in range(50)], "source int, target int")
    steps, front = {0: 0, 7: 0}, {0, 7}
    pairs = [tuple(r) for r in edges.collect()]
    while front:
        front = {b for a, b in pairs if a in front} - set(steps)
        steps |= {b: max(steps.values()) + 1 for b in front}
    assert {r.node: r.steps for r in G.reached(edges, spark.createDataFrame([(0,), (7,), (7,)], "node int")).collect()} == steps


def test_merged_sketches(spark):
    df = spark.range(30_000).selectExpr("id % 3 AS k", "id % 7 AS day", "concat('v', id % 9000 + 1000 * (id % 3)) AS v")
    stored = K.states(df, ["k", "day"], "v")
    exact = {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    got = {r.k: (r.rows, r.distinct) for r in K.estimates(K.merged(stored, ["k"])).collect()}
    assert all(got[k][0] == 10_000 and abs(got[k][1] - n) <= K.ERROR * n for k, n in exact.items())
    sets = {k: {r.v for r in df.filter(F.col("k") == k).select("v").distinct().collect()} for k in (0, 1)}
    pair = K.common(K.merged(stored, ["k"]), "k", spark.createDataFrame([(0, 1)], "left long, right long")).first()
    assert abs(pair.common - len(sets[0] & sets[1])) <= K.ERROR * len(sets[0] | sets[1])
