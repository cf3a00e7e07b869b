"""The rule catalogue on synthetic corpora: clean ones, and broken ones whose violations are listed by hand."""

import pytest

from chroniq.plans import campaign
from chroniq.plans import contract as K
from chroniq.sources.corpus import Documents
from chroniq.sources.reset import ResetError, reset


@pytest.fixture(autouse=True)
def nothing_cached(spark):
    yield
    spark.catalog.clearCache()


def base(status="preparation", cp="null", scene="null", journal="null"):
    files = {p: f"# {p}\n" for p in K.REQUIRED_FILES}
    front = lambda **kw: "---\n" + "".join(f"{k}: {v}\n" for k, v in kw.items()) + "---\n"
    files["CURRENT.md"] = front(checkpoint_id=cp, active_scene_id=scene, active_journal_id=journal, campaign_status=status, last_activity_at="null")
    for i, p in enumerate(K.ENTITY_TEMPLATES):
        files[p] = front(id=f"kind.t{i}", type="x", name="x", status="x", location="x", knowledge_level="x", last_updated="cp-0001")
    for p, names in K.SECTIONS.items():
        files[p] += "# T\n" + "".join(f"## {n}\nTODO\n" for n in names)
    files["templates/reset-paths.txt"] = "# list\n" + "\n".join(K.RESET_PATHS) + "\n"
    for p in K.RESET_PATHS:
        files[f"templates/{p}" if "." in p else f"templates/{p}/README.md"] = "# x\n"
    files[K.GUIDE] = "# Guide\n" + ", ".join(K.GUIDE_TERMS) + "\n"
    files["party/hero.md"] = "# Hero\nsee hero.one and old.fact, [link](../CURRENT.md#x) ![no](none.png) [web](https://a.b/c)\n"
    files["scripts/reset_campaign.sh"] = "true\n"
    return files


BASELINE = "checkpoint_id: cp-0001\nbase_checkpoint_id: null\nkind: baseline\nschema: campaign-checkpoint/v1\nnew_facts:\n  - id: fact.base\n"
SCENE = "current_scene:\n" + "".join(f"  {k}: x\n" for k in K.SCENE_KEYS)
CONTINUITY = "continuity:\n  journal_entry_id: journal.entry-0001\n  scene_id: scene-0001\n"
EVENTS = "journal_append:\n  events:\n    - id: event-001\n      type: action\n      fiction_time: day\n      summary: s\n"


def delta(n, body="", scene=SCENE, events=EVENTS, head=""):
    return f"checkpoint_id: cp-{n:04}\nbase_checkpoint_id: cp-{n - 1:04}\nkind: delta\nschema: campaign-checkpoint/v1\n{head}{CONTINUITY}{scene}{events}{body}"


def active():
    files = base("active", "cp-0003", "scene-0001", "journal.entry-0001")
    files["journal/entry-0001.md"] = "---\nid: journal.entry-0001\nstatus: open\nlast_checkpoint: cp-0003\n---\n# Entry\nscene-0001\n"
    files["checkpoints/cp-0001.yaml"] = BASELINE
    fact = "new_facts:\n  - id: fact.one\n    kind: rumor\n    content: c\n    truth_status: mixed\n    knowledge_level: l\n    source_event: event-001\n"
    thread = "open_thread_changes:\n  - operation: add\n    thread_id: thread.one\n    title: t\n    question: q\n    status: s\n    knowledge_level: l\n    source_event: event-001\n    related_facts:\n      - fact.one\n      - fact.base\n"
    files["checkpoints/cp-0002.yaml"] = delta(2, fact + thread)
    close = "open_thread_changes:\n  - operation: close\n    thread_id: thread.one\n    resolution: r\n    source_event: event-001\n    related_facts: []\n"
    know = "knowledge_changes:\n  - operation: add\n    subject: party\n    knowledge_ref: fact.one\n    summary: s\n    source_event: event-001\n"
    files["checkpoints/cp-0003.yaml"] = delta(3, close + know)
    return files


def found(spark, tmp_path, files):
    for p, text in files.items():
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(text if isinstance(text, bytes) else text.encode())
    v, report, status = campaign.validate(spark, str(tmp_path))
    rows = [(r.rule, r.path, r.line_no, r.item_no, r.detail) for r in campaign.in_order(v).collect()]
    assert status == any(r[0][0] == "E" for r in rows)
    assert f"Total: {sum(r[0][0] == 'E' for r in rows)} errors, {sum(r[0][0] == 'W' for r in rows)} warnings" in report
    return rows


def held(spark, files):
    """A campaign of files given as a table."""
    rows = [(p, t if isinstance(t, bytes) else t.encode()) for p, t in files.items()]
    return campaign.Campaign(Documents(spark, spark.createDataFrame(rows, "path string, content binary")))


def test_clean_preparation(spark, tmp_path):
    assert found(spark, tmp_path, base()) == []


def test_preparation_without_two_files(spark, tmp_path):
    """A campaign in preparation that lacks two required files, one of them the target of a link: three errors, nothing else."""
    files = base()
    del files[".gitignore"], files["gm/secrets.md"]
    files["MANIFEST.md"] += "\n" * 48 + "- [secrets](gm/secrets.md)\n"
    rows = found(spark, tmp_path, files)
    assert [(r[0], r[1], r[2]) for r in rows] == [("E191", ".gitignore", None), ("E191", "gm/secrets.md", None), ("E1197", "MANIFEST.md", 50)]


def test_state_and_checkpoints(spark, tmp_path):
    """Active without checkpoints, in preparation with some, an undecodable reset list."""
    files = active()
    for n in (1, 2, 3):
        del files[f"checkpoints/cp-000{n}.yaml"]
    assert [(r[0], r[1]) for r in found(spark, tmp_path / "a", files)] == [("E905", "CURRENT.md"), ("E957", "checkpoints/")]
    files = base()
    files["checkpoints/cp-0001.yaml"] = "not: checked\n"
    files[K.RESET_LIST] = b"gm\n\xff\n"
    assert [(r[0], r[1]) for r in found(spark, tmp_path / "b", files)] == [("E202", K.RESET_LIST), ("E960", "checkpoints/")]


@pytest.mark.parametrize("case", ["fence", "keys", "formats", "no journal", "journal"])
def test_broken_pointer(spark, case):
    files, current = active(), "CURRENT.md"
    entry = "journal/entry-0001.md"
    if case == "fence":
        files[current] = files[current].replace("---\n", "", 1)
        want = [("E855", current, "")]
    elif case == "keys":
        files[current] = files[current].replace("last_activity_at: null\n", "")
        want = [("E867", current, "last_activity_at")]
    elif case == "formats":
        files[current] = files[current].replace("cp-0003", "cp-3").replace("journal.entry-0001", "entry-1")
        want = [("E888", current, "cp-3"), ("E897", current, "entry-1")]
    elif case == "no journal":
        del files[entry]
        want = [("E915", current, entry)]
    else:
        files[entry] = files[entry].replace("---\n# Entry", "# Entry")
        want = [("E922", entry, "")]
    assert sorted((r.rule, r.path, r.detail) for r in held(spark, files).continuity().collect()) == want


def test_audit_compares_journals(spark):
    files = active()
    files["journal/entry-0000.md"] = "---\nid: journal.entry-0000\nstatus: closed\n---\n# Done\n"
    files["journal/entry-0002.md"] = "---\nid: journal.entry-0002\nstatus: open\n---\n# Open\n"
    before = held(spark, files)
    files["journal/entry-0000.md"] += "more\n"
    files["journal/entry-0001.md"] += "more\n"
    files["journal/entry-0002.md"] = files["journal/entry-0002.md"].replace("# Open", "# Opened")
    assert sorted((r.rule, r.path, r.detail) for r in held(spark, files).audit(before).collect()) == [("immutable", "journal/entry-0000.md", "closed"), ("immutable", "journal/entry-0002.md", "open")]


def test_long_reports_are_cut_but_written(spark, tmp_path):
    v = spark.createDataFrame([("E1", "error", f"p{i}", i, None, "", 1) for i in range(30)] + [("W1", "warning", "q", 1, None, "", 2)], "rule string, severity string, path string, line_no int, item_no int, detail string, check_no int")
    text = campaign.render(v, 5, most=10)
    assert text.count("[ERROR]") == 10 and "and 21 more" in text and "Total: 30 errors, 1 warnings" in text
    campaign.write_report(v, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report")).count() == 31


def test_clean_active(spark, tmp_path):
    assert found(spark, tmp_path, active()) == []


def test_broken_payload(spark, tmp_path):
    files = active()
    events = """journal_append:
  events:
    - id: event-1
      type: talk
    - id: event-002
      type: dialogue
      fiction_time: day
      summary: s
      speaker: Bad Name
      recipients: []
      knowledge_refs:
        - fact.nowhere
        - old.fact
    - id: event-002
      type: dialogue
      fiction_time: day
      summary: s
      recipients: [a]
    - just text
"""
    body = """changes:
  - operation: set
    target: t
    reason: r
    source_event: event-404
  - operation: drop
    target: t
  - plain
resource_changes:
  - id: res
    operation: transfer
    holder_before: null
    holder_after: unknown
  - id: item.one
    operation: consume
    name: n
    quantity_before: ~
    quantity_after: 1
  - id: item.one
    operation: burn
    source_event: event-009
  - text
new_facts:
  - id: fact.one
    kind: rumor
    content: c
    truth_status: mixed
    knowledge_level: l
    source_event: event-002
  - id: Bad
    kind: guess
    truth_status: maybe
    source_event: event-003
  - id: fact.two
    kind: rumor
    content: c
    truth_status: mixed
    knowledge_level: l
    source_event: event-002
  - id: fact.two
    kind: rumor
    content: c
    truth_status: mixed
    knowledge_level: l
    source_event: event-002
open_thread_changes:
  - operation: update
    thread_id: thread.new
    note: n
    source_event: event-002
  - operation: add
    thread_id: thread.new
    title: t
    question: q
    status: s
    knowledge_level: l
    source_event: event-002
    related_facts:
      - fact.two
      - fact.later
  - operation: add
    thread_id: thread.new
    source_event: event-002
  - operation: close
    thread_id: thread.none
    source_event: event-777
  - operation: fix
    thread_id: x
    related_facts: [fact.two]
knowledge_changes:
  - operation: learn
    subject: Nobody
    knowledge_ref: fact.later
    summary: s
    source_event: event-404
  - operation: add
    subject: hero.one
    knowledge_ref: thread.new
"""
    files["checkpoints/cp-0003.yaml"] = delta(3, body, scene="current_scene:\n  location: x\n", events=events)
    rows = found(spark, tmp_path, files)
    p = "checkpoints/cp-0003.yaml"
    assert {r[1] for r in rows} == {p}
    want = [
        ("E412", None, "active_threats, fiction_time, key_resources, pending_decisions, present, situation"), ("E429", None, ""),
        ("E438", 1, "event-1"), ("E449", 1, ""), ("E455", 1, "talk"), ("E460", 1, ""), ("E470", 2, "Bad Name"), ("E483", 2, "recipients"), ("E794", 2, "fact.nowhere"), ("E443", 3, "event-002"), ("E483", 3, "speaker"),
        ("E494", None, ""), ("E516", 1, "from, to"), ("E523", 1, "event-404"), ("E505", 2, "drop"), ("E516", 2, "reason, source_event"),
        ("E534", None, ""), ("E570", 1, "res"), ("E593", 1, "holder_before"), ("E600", 2, "quantity_before"), ("E575", 3, "item.one"), ("E584", 3, "burn"), ("E611", 3, "event-009"),
        ("E638", 1, "fact.one"), ("E638", 2, "Bad"), ("E645", 2, "guess"), ("E650", 2, "maybe"), ("E655", 2, "content, knowledge_level"), ("E661", 2, "event-003"), ("E638", 4, "fact.two"),
        ("E705", 1, "thread.new"), ("E737", 2, "fact.later"), ("E696", 3, "thread.new"), ("E716", 3, "knowledge_level, question, status, title"), ("E712", 4, "thread.none"), ("E716", 4, "resolution"), ("E722", 4, "event-777"),
        ("E680", 5, "fix"), ("E685", 5, "x"), ("E716", 5, "source_event"), ("E737", 5, "[fact.two]"),
        ("E759", 1, "learn"), ("E765", 1, "Nobody"), ("E771", 1, "fact.later"), ("E782", 1, "event-404"), ("E776", 2, "source_event, summary"),
    ]
    got = [(r[0], r[3], r[4]) for r in rows if r[0] != "E605"]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert [r[3] for r in rows if r[0] == "E605"] == [1, 2, 3]


def test_broken_pointer_and_chain(spark, tmp_path):
    files = active()
    files["CURRENT.md"] = files["CURRENT.md"].replace("cp-0003", "cp-0009").replace("scene-0001", "scene-1")
    files["journal/entry-0001.md"] = "---\nid: journal.entry-0002\nstatus: closed\n---\n# Entry\n"
    files["checkpoints/cp-0001.yaml"] = BASELINE.replace("null", "''").replace("baseline", "delta").replace("/v1", "/v2")
    files["checkpoints/cp-0003.yaml"] = files["checkpoints/cp-0003.yaml"].replace("checkpoint_id: cp-0003", "checkpoint_id: cp-0002", 1)
    files["checkpoints/cp-0004.yaml"] = delta(4).replace("kind: delta", "kind: baseline").replace("cp-0003", "cp-0001").replace("scene-0001", "scene-0002").replace("entry-0001", "entry-0007")
    files["checkpoints/cp-0005.yaml"] = "checkpoint_id: five\nnew_facts:\n  - id: hidden.fact\n"
    rows = {(r[0], r[1]) for r in found(spark, tmp_path, files)}
    cp = "checkpoints/cp-000"
    assert rows - {("E412", f"{cp}1.yaml"), ("E420", f"{cp}1.yaml"), ("E655", f"{cp}1.yaml"), ("E645", f"{cp}1.yaml"), ("E650", f"{cp}1.yaml")} == {
        ("E892", "CURRENT.md"), ("E905", "CURRENT.md"), ("E925", "journal/entry-0001.md"), ("E929", "journal/entry-0001.md"), ("E933", "journal/entry-0001.md"), ("E937", "journal/entry-0001.md"),
        ("E1010", f"{cp}5.yaml"), ("E1015", f"{cp}3.yaml"), ("E1019", f"{cp}3.yaml"), ("E1025", f"{cp}1.yaml"), ("E1031", f"{cp}1.yaml"), ("E1035", f"{cp}4.yaml"),
        ("E1061", f"{cp}1.yaml"), ("E1068", f"{cp}3.yaml"), ("E1068", f"{cp}4.yaml"), ("E1072", f"{cp}4.yaml"), ("E1079", "CURRENT.md"), ("E1088", f"{cp}4.yaml"), ("E1093", f"{cp}4.yaml"),
    }


def test_broken_structure(spark, tmp_path):
    files = base(cp="cp-0001")
    del files["gm/secrets.md"], files["templates/gm/README.md"]
    files["templates/reset-paths.txt"] = "CURRENT.md\nCURRENT.md\n  # c\n../x\n/abs\n" + "\n".join(K.RESET_PATHS[1:-1]) + "\nextra\n"
    files["bad.md"] = b"\xff\xfe"
    files["crlf.md"] = "# x\r\n"
    files["npcs/one.md"] = "---\nid: Kind.X\nlast_updated: soon\n---\nid: kind.t0 # again\n id :\ntext сЕССИя\n[a](gone.md) [b](<../CURRENT.md>) [c]( ) [d](/npcs) [e](../../up.md)\n"
    files["party/character-template.md"] = "---\nid: kind.t0\n"
    files["npcs/npc-template.md"] = files["npcs/npc-template.md"].replace("name: x\n", "").replace("## Роль\nTODO", "## Роль\n<!-- -->").replace("## Секреты\n", "## Other\n")
    files[K.GUIDE] = "# g\nPDF правил\n"
    got = [(r[0], r[1], r[2], r[4]) for r in found(spark, tmp_path, files)]
    t, one = K.RESET_LIST, "npcs/one.md"
    party = [("E1245", "party/character-template.md", None, n) for n in K.SECTIONS["party/character-template.md"]]
    assert sorted(got, key=repr) == sorted([
        ("E191", "gm/secrets.md", None, ""), ("E211", t, None, ""), ("E228", t, None, "rules"), ("E233", t, None, "../x, /abs, extra"), ("E244", t, None, "../x"), ("E244", t, None, "/abs"), ("E249", t, None, "gm"), ("E249", t, None, "extra"),
        ("E180", "bad.md", None, ""), ("E183", "crlf.md", None, ""), ("E812", "party/character-template.md", None, ""), ("E816", "npcs/npc-template.md", None, "name"), ("E840", one, None, "soon"), ("E881", "CURRENT.md", None, "checkpoint_id"),
        ("E1150", one, 6, ""), ("E1153", one, 2, "Kind.X"), ("E1161", one, 5, "kind.t0"), ("E1110", one, 7, ""), ("E1197", one, 8, "gone.md"), ("E1197", one, 8, ""), ("E1197", one, 8, "../../up.md"),
        ("E1245", "npcs/npc-template.md", None, "Секреты"), ("W1247", "npcs/npc-template.md", None, "Роль"), ("E1126", K.GUIDE, None, K.GUIDE_TERMS[1]), ("E1126", K.GUIDE, None, K.GUIDE_TERMS[2]), ("W1255", one, None, ""), ("W1255", "party/character-template.md", None, ""), *party,
    ], key=repr)


def test_reset(spark, tmp_path):
    files = base()
    for p, text in files.items():
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(text)
    (tmp_path / "gm/extra.md").write_text("x")
    with pytest.raises(ResetError):
        reset(spark, str(tmp_path))
    assert (tmp_path / "gm/extra.md").exists()
    (tmp_path / "templates/reset-paths.txt").write_text("gm\n../up\n")
    with pytest.raises(ResetError):
        reset(spark, str(tmp_path), confirm=True)
    assert (tmp_path / "gm/extra.md").exists()
    (tmp_path / "templates/reset-paths.txt").write_text("gm\nCURRENT.md\n")
    assert reset(spark, str(tmp_path), confirm=True) == ["gm", "CURRENT.md"]
    assert not (tmp_path / "gm/extra.md").exists() and (tmp_path / "gm/README.md").exists() and (tmp_path / "party/hero.md").exists()


def test_a_reset_that_fails_midway_changes_nothing(spark, tmp_path, monkeypatch):
    """The last path's parent is a file where its template is a folder's: what was moved before it is moved back."""
    files = base() | {"templates/MANIFEST.md/deep.md": "# new\n", "gm/extra.md": "x"}
    root = tmp_path / "root"
    for p, text in files.items():
        (root / p).parent.mkdir(parents=True, exist_ok=True)
        (root / p).write_text(text)
    (root / "templates/reset-paths.txt").write_text("gm\nCURRENT.md\nMANIFEST.md/deep.md\n")
    before = {p.relative_to(root): p.read_bytes() for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    with pytest.raises(Exception):
        reset(spark, str(root), confirm=True)
    assert {p.relative_to(root): p.read_bytes() for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc")} == before
    assert [p.name for p in tmp_path.iterdir()] == ["root"]


def test_digits_of_any_script(spark):
    """A checkpoint id whose digits are not ASCII's is a number, not a crash."""
    files = active()
    text = files.pop("checkpoints/cp-0001.yaml")
    files["checkpoints/cp-\u0660\u0660\u0660\u0661.yaml"] = text.replace("checkpoint_id: cp-0001", "checkpoint_id: cp-\u0660\u0660\u0660\u0661", 1)
    c = held(spark, files)
    assert {r.id: r.number for r in c.checkpoints.collect()} == {"cp-\u0660\u0660\u0660\u0661": 1, "cp-0002": 2, "cp-0003": 3}
    assert {r.rule for r in c.chain_rules().collect()} == {"E1035", "E1061", "E1072"}


def test_many_campaigns_in_one_corpus(spark):
    """Each root has its own chain, references, files and state."""
    one, two = active(), active()
    two["checkpoints/cp-0002.yaml"] = two["checkpoints/cp-0002.yaml"].replace("fact.base", "fact.strange")
    del two["gm/secrets.md"]
    files = {f"a/{p}": t for p, t in one.items()} | {f"b/{p}": t for p, t in two.items()} | {f"c/{p}": t for p, t in base().items()} | {"outside.md": "no heading"}
    rows = [(p, t.encode()) for p, t in files.items()]
    c = campaign.Campaign(Documents(spark, spark.createDataFrame(rows, "path string, content binary")), r"\A[abc]/")
    v = c.scratch.store(c.violations(), "violations")
    assert sorted((r.rule, r.path, r.detail) for r in v.collect()) == [("E191", "b/gm/secrets.md", ""), ("E737", "b/checkpoints/cp-0002.yaml", "fact.strange")]
    assert sorted(map(tuple, campaign.statuses(c, v).collect())) == [("a/", 0, 0, 0), ("b/", 2, 0, 1), ("c/", 0, 0, 0)]


def test_no_side_that_grows_is_broadcast(spark):
    """Files compress so well that many of them look small: their joins are told not to send them through the driver."""
    rows = [(f"{root}/{p}", t.encode()) for root in "ab" for p, t in active().items()]
    c = campaign.Campaign(Documents(spark, spark.createDataFrame(rows, "path string, content binary")), r"\A[ab]/")
    c.corpus.hold(c.scratch)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    parts = (c.required_files(), c.reset_list(), c.continuity(), c.ids(), c.links(), c.located_ids(), campaign.statuses(c, c.required_files()))
    assert [plan(df).count("BroadcastHashJoin") for df in parts] == [0] * len(parts)
    assert "SortMergeJoin" in plan(c.required_sections())  # the fixed names alone are broadcast
