"""Generic checks, the state protocol and the table queries on small data."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from chroniq.operators import checks as C
from chroniq.operators import state as S
from chroniq.plans import campaign, linked, rendered, streamed, tabular, timed

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def canon(values):
    return sorted((tuple(round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in values), key=repr)


@pytest.mark.parametrize("name", list(tabular.QUERIES))
def test_table_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(tabular.ORACLES[name])
    names = [d[0] for d in want.description]
    got = tabular.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert canon(map(tuple, got.select(*names).collect())) == canon(want.fetchall())


@pytest.fixture(scope="module")
def shared(spark):
    """One campaign for all queries over it, so that its documents are parsed once."""
    c = rendered.active(spark, DATA)
    yield c
    c.release()


@pytest.mark.parametrize("name", list(rendered.QUERIES))
def test_rendered_query(spark, shared, monkeypatch, name):
    monkeypatch.setattr(rendered, "active", lambda *_: shared)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(rendered.ORACLES[name])
    names = [d[0] for d in want.description]
    got = rendered.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert canon(map(tuple, got.select(*names).collect())) == canon(want.fetchall())


def test_rendered_rules_fire():
    """The oracles of the rendered campaigns name every rule."""
    told = set(re.findall(r"'([EW][0-9]+)'", " ".join(rendered.ORACLES.values())))
    source = set(re.findall(r'rule\("([EW][0-9]+)"|"(E[0-9]+)"', open(campaign.__file__).read()))
    assert {a or b for a, b in source} - told == set()


@pytest.mark.parametrize("name", [*timed.QUERIES, *linked.QUERIES, *streamed.QUERIES])
def test_query_of_time_links_and_streams(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute((timed.ORACLES | linked.ORACLES | streamed.ORACLES)[name])
    names = [d[0] for d in want.description]
    got = (timed.QUERIES | linked.QUERIES | streamed.QUERIES)[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert canon(map(tuple, got.select(*names).collect())) == canon(want.fetchall())


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, None, 1), (2, "a\n", 2)], "k int, v string, n int")
    assert rows(C.domain(df, "v", ["a"])) == rows(df.filter("v is null or v <> 'a'"))
    assert rows(C.format_of(df, "v", "a|b").select("k")) == [(2,), (2,)]
    assert rows(C.first_wins(df, [], "k", ["n"]).select("k", "n")) == [(1, 3), (2, 2)]
    assert rows(C.chain(df, ["k"], "n").filter("not continues").select("k", "n", "previous")) == [(1, 3, 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(C.foreign_key(df, parent, [("v", "id")]).select("v")) == [("a\n",), ("b",)]
    lists = spark.createDataFrame([(1, ["a", "z"]), (2, []), (3, None)], "k int, refs array<string>")
    assert rows(C.foreign_key_list(lists, "refs", parent, "id").select("k", "value")) == [(1, "z")]
    assert rows(C.unique_located(df.withColumnRenamed("n", "at"), F.col("k"), "at")) == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 1, 2)]


def test_fold_and_assertions(spark):
    changes = spark.createDataFrame(
        [("cp-1", 1, "set", "a", "x", "y", None, None), ("cp-2", 1, "move", "a", "y", "z", None, None), ("cp-2", 2, "set", "b", "n", "m", None, None), ("cp-1", 2, "add", "bag", None, None, "rope", 3), ("cp-3", 1, "remove", "bag", None, None, "rope", None)],
        "cp string, idx int, operation string, target string, `from` string, `to` string, value string, quantity int",
    )
    assert rows(S.fold(changes)) == [("a", "z", None), ("b", "m", None), ("bag", "rope", 2.0)]
    held = spark.createDataFrame([("a", "x"), ("b", "other")], "target string, value string")
    assert rows(S.failed_assertions(changes, held).select("target", "expected")) == [("b", "other")]
    assert S.apply(held, changes, held) is held
    assert rows(S.apply(held.filter("target = 'a'"), changes, held.filter("false")).select("target", "value")) == [("a", "z"), ("b", "m"), ("bag", "rope")]


def test_protocol(spark):
    f = spark.createDataFrame
    assert rows(S.stale(f([("p", "cp-1"), ("q", "cp-2"), ("r", None)], "id string, base string"), f([("cp-2",)], "id string")).select("id")) == [("p",), ("r",)]
    assert rows(S.coverage(f([(1,), (2,)], "anchor int"), f([(1, "covered")], "anchor int, status string"))) == [(1, "covered"), (2, "missing")]
    assert rows(S.superseded(f([("k", 1, "unknown"), ("k", 2, "known")], "k string, at int, v string"), "k", ["at"], ["v"])) == [("k", "known")]
    ladder = f([("rules", 1), ("module", 2)], "source string, rank int")
    assert rows(S.precedence(f([("hp", "module", "9", 1), ("hp", "rules", "7", 2), ("hp", "rumour", "1", 3)], "k string, source string, v string, n int"), ladder, "k", "source", "v", "n")) == [("hp", "rules", "7")]
    docs = f([("a.md", "x", "player-known"), ("gm/b.md", "x", "player-known"), ("c.md", "y", "gm-secret")], "path string, id string, knowledge_level string")
    assert rows(S.visible(docs, ["player-known"], hidden_paths=F.col("path").startswith("gm/")).select("path")) == [("a.md",)]
    assert rows(S.context(docs, f([("x",)], "id string"), ["c.md"], "gm/").select("path")) == [("a.md",), ("c.md",)]
    assert rows(S.increment(f([("e1",), ("e2",)], "e string"), f([("e1",)], "e string"), "e")) == [("e2",)]
    before = f([("1", "closed", "t"), ("2", "closed", "t"), ("3", "open", "t"), ("4", "open", "t"), ("5", "closed", "t")], "id string, status string, text string")
    after = f([("1", "t"), ("2", "u"), ("3", "t more"), ("4", "x")], "id string, text string")
    assert rows(S.broken_immutability(before, after).select("id")) == [("2",), ("4",), ("5",)]
    assert rows(S.reconcile(f([("a", 1), ("b", 2)], "k string, n int"), f([("a", 1), ("c", 3)], "k string, n int"), "k", "n")) == [("b", 2, None), ("c", None, 3)]
    assert rows(S.scene_lifecycle(f([("close", None), ("close", "s2"), ("continue", None)], "scene_status string, next_scene_id string")).select("missing")) == [(["next_scene_id"],)]
    ticks = f([("c", 1, 2), ("c", 2, 3), ("c", 3, 4)], "c string, at int, n int")
    assert rows(S.clocks(ticks, f([("c", 6)], "c string, `limit` int"), "c", ["at"], "n").select("at", "current", "struck")) == [(1, 2, False), (2, 5, False), (3, 6, True)]
    assert [r.at for r in S.timeline(ticks.orderBy(F.desc("at")), ["at"], ["at"]).collect()] == [1, 2, 3]
    assert rows(S.unresolved_sources(f([("chat-1",), ("TBD",), (None,), ("chat-9",)], "source string"), f([("chat-1",)], "source string"), ["TBD"])) == [("TBD",), ("chat-9",), (None,)]


def test_journal_stream(spark, tmp_path):
    import json

    from chroniq.streaming import journal

    rows_in = [("j", "event-001", "action", "s", "2024-01-01T00:00:00Z"), ("j", "event-001", "action", "s", "2024-01-01T00:10:00Z"), ("j", "bad", "talk", "", "2024-01-01T01:00:00Z"), ("k", "event-001", "action", "s", "2024-01-05T00:00:00Z"), ("k", "event-002", "action", "s", "2024-01-09T00:00:00Z")]
    (tmp_path / "in").mkdir()
    for n, r in enumerate(rows_in):
        (tmp_path / f"in/{n}.json").write_text(json.dumps(dict(zip(("journal_id", "id", "type", "summary", "at"), r, strict=True))) + "\n")

    def run(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp_{name}")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return rows(spark.table(name))

    events = journal.read_journal(spark, str(tmp_path / "in"))
    assert [r[1] for r in run(journal.malformed(events), "malformed")] == ["bad"]
    assert sorted((r[0], r[1]) for r in run(journal.once(events), "once")) == [("j", "bad"), ("j", "event-001"), ("k", "event-001"), ("k", "event-002")]
    assert ("action", 2) in [(r[1], r[2]) for r in run(journal.activity(events), "activity", "complete")]


def test_entity_templates_are_part_of_the_entities_query(spark):
    """Three templates, of which each lacks keys or its end, beside the suppliers' entities."""
    rows = rendered.rules_entities(spark, DATA).filter("path not like 'npcs/s%'").collect()
    assert sorted((r.rule, r.path) for r in rows) == [("E812", "locations/location-template.md"), ("E816", "npcs/npc-template.md"), ("E816", "party/character-template.md"), ("E840", "npcs/npc-template.md")]
