"""The rule catalogue on documents that are rendered from the driver's tables, and what it has to find, in SQL.

A campaign is written from the tables: a checkpoint for each customer, its records from the customer's orders, a journal,
entities from suppliers, pages with links. The values of the fields are SQL expressions over keys; some break a rule. Spark renders
them as text, which the catalogue parses and checks; the oracle states each rule on the values themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions import parse as P
from chroniq.plans import contract as K
from chroniq.plans.campaign import Campaign, cube, report_lines, statuses, union
from chroniq.sources.corpus import Documents


def pick(number: str, values: list[str | None]) -> str:
    """The value of a list that a number's remainder names; None is no value."""
    return f"CASE ({number}) % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None) + " END"


def listing(*items: str) -> str:
    """A field's value that lists items, as the catalogue's parser gives it."""
    return "concat(" + ", ".join(f"chr(10), {x}" for x in items) + ")"


# Fields of a checkpoint by customer c, and of its records by order k; both engines evaluate them. A field that is NULL is left out.
NUMBER, BEFORE = (f"CASE WHEN {n} < 10000 THEN lpad(concat({n}, ''), 4, '0') ELSE concat({n}, '') END" for n in ("c", "(c - 1)"))
HEADER = {
    "checkpoint_id": f"CASE c % 29 WHEN 7 THEN 'five' WHEN 11 THEN concat('cp-', {BEFORE}) ELSE concat('cp-', {NUMBER}) END",
    "base_checkpoint_id": f"CASE WHEN c = 1 THEN 'null' WHEN c % 23 = 5 THEN 'cp-9999' ELSE concat('cp-', {BEFORE}) END",
    "kind": "CASE WHEN c = 1 OR c % 19 = 3 THEN 'baseline' ELSE 'delta' END",
    "schema": f"CASE WHEN c % 31 = 4 THEN 'campaign-checkpoint/v2' ELSE '{K.SCHEMA}' END",
}
EVENT_ID = "CASE k % 10 WHEN 3 THEN concat('event_', k) WHEN 7 THEN 'event-000' ELSE concat('event-', CASE WHEN k < 1000 THEN lpad(concat(k, ''), 3, '0') ELSE concat(k, '') END) END"
SOURCE = f"CASE WHEN k % 11 = 0 THEN 'event-404404404' WHEN k % 12 <> 5 THEN {EVENT_ID} END"
RECORDS = {
    "events": ("TRUE", {
        "id": EVENT_ID, "type": pick("k", ["action", "dialogue", "discovery", "talk", "dialogue"]), "fiction_time": "CASE WHEN k % 9 <> 0 THEN 'day' END", "summary": "CASE WHEN k % 8 = 1 THEN '' ELSE 's' END",
        "speaker": pick("k", [None, "Bad Name", "npc.one"]), "recipients": f"CASE k % 7 WHEN 2 THEN '[]' WHEN 3 THEN {listing(chr(39) + 'a' + chr(39))} WHEN 4 THEN NULL ELSE '[a]' END",
        "knowledge_refs": f"CASE k % 6 WHEN 0 THEN {listing('concat(' + chr(39) + 'fact.o' + chr(39) + ', k - 3)', chr(39) + 'fact.base' + chr(39))} WHEN 1 THEN {listing(chr(39) + 'fact.nowhere' + chr(39))} WHEN 2 THEN '[]' END",
    }),
    "changes": ("k % 2 = 0", {
        "operation": pick("k", ["set", "add", "remove", "move", "drop"]), "target": "CASE WHEN k % 7 <> 0 THEN 't' END", "reason": "CASE WHEN k % 13 <> 1 THEN 'r' ELSE '' END", "source_event": SOURCE,
        "from": "CASE WHEN k % 3 <> 0 THEN 'x' END", "to": "CASE WHEN k % 3 <> 1 THEN 'y' END", "value": "CASE WHEN k % 4 <> 0 THEN 'v' END",
    }),
    "resource_changes": ("k % 3 = 0", {
        "id": "CASE WHEN k % 10 = 1 THEN 'Res' ELSE concat('item.', k % 4) END", "operation": pick("k", ["add", "update", "transfer", "consume", "remove", "burn", "transfer", "consume"]), "name": "CASE WHEN k % 5 <> 0 THEN 'n' END",
        "quantity_before": pick("k", ["~", "1", "null"]), "quantity_after": pick("k", ["2", "unknown"]), "holder_before": pick("k", ["null", "hero"]), "holder_after": pick("k", ["unknown", "", "npc.one"]),
        "condition_before": "'x'", "condition_after": "'x'", "capabilities": "'x'", "limitations": "'x'", "maintenance": "'x'", "load_limit": "'x'", "noise": "CASE WHEN k % 7 <> 1 THEN 'x' END", "light": "CASE WHEN k % 7 <> 1 THEN 'x' END", "consumption": "'x'",
        "source_event": SOURCE,
    }),
    "new_facts": ("k % 4 = 1 OR k % 10 = 9", {
        "id": "CASE k % 10 WHEN 5 THEN 'Bad' WHEN 9 THEN concat('fact.o', k - k % 50) ELSE concat('fact.o', k) END", "kind": pick("k", ["established", "npc-claim", "rumor", "belief", "guess", "rumor", "belief"]),
        "content": "CASE WHEN k % 6 <> 1 THEN 'c' END", "truth_status": pick("k", ["confirmed", "unverified", "false", "mixed", "maybe", "mixed"]), "knowledge_level": "'l'", "source_event": SOURCE,
    }),
    "open_thread_changes": ("k % 5 = 2 OR k % 6 = 1", {
        "operation": pick("k", ["add", "update", "close", "add", "fix", "add", "close"]), "thread_id": "CASE WHEN k % 17 = 2 THEN 'x' ELSE concat('thread.t', k % 90) END", "title": "CASE WHEN k % 3 <> 0 THEN 't' END", "question": "'q'", "status": "'s'",
        "knowledge_level": "'l'", "note": "CASE WHEN k % 2 = 0 THEN 'n' END", "resolution": "CASE WHEN k % 2 = 1 THEN 'r' END", "source_event": SOURCE,
        "related_facts": f"CASE k % 3 WHEN 0 THEN {listing('concat(' + chr(39) + 'fact.o' + chr(39) + ', k)', 'concat(' + chr(39) + 'fact.o' + chr(39) + ', k - 8)')} WHEN 1 THEN '[fact.base]' END",
    }),
    "knowledge_changes": ("k % 6 = 4", {
        "operation": pick("k", ["add", "update", "remove", "learn"]), "subject": pick("k", ["party", "npc.one", "Nobody"]), "knowledge_ref": "CASE k % 4 WHEN 0 THEN concat('fact.o', k - 3) WHEN 2 THEN concat('thread.t', k % 90) END",
        "summary": "CASE WHEN k % 9 <> 4 THEN 's' ELSE '' END", "source_event": SOURCE,
    }),
}
#: Keys that the scene of a customer lacks, and whether its journal has no list of events or one with a plain item.
SCENE_KEY = [f"CASE WHEN c % 15 <> {i} THEN 'x' END" for i in range(len(K.SCENE_KEYS))]
NO_EVENTS, PLAIN = "c % 13 = 5", "c % 6 = 2"
KNOWN_TEXT = "# Hero\nhero.one knows fact.base, thread.t7 and npc.one\n"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Keys dealt to a set number of partitions: a small file of them is rendered, and stored, by as many tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def record(fields: dict[str, str], indent: int) -> str:
    """A record's lines, as SQL; the items of a list follow its key, a line each."""
    lead = [" " * indent + "- ", *[" " * (indent + 2)] * (len(fields) - 1)]
    child = "chr(10) || '" + " " * (indent + 4) + "- '"
    value = lambda e: f"replace({e}, chr(10), {child})" if "chr(10)" in e else e
    return "concat(" + ", ".join(f"coalesce(concat('{at}{n}: ', {value(e)}, chr(10)), '')" for at, (n, e) in zip(lead, fields.items(), strict=True)) + ")"


def checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """path, content of a checkpoint for each customer, with its orders in the order of their keys."""
    orders = _t(spark, d, "orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("k"))
    lists = [f"CASE WHEN {when} THEN {record(fields, 4 if name == 'events' else 2)} END AS {name}" for name, (when, fields) in RECORDS.items()]
    # the texts are long: a set number of partitions keeps them spread, and keys alone are joined and sorted before they are rendered
    keys = spread(_t(spark, d, "customer").select(F.col("c_custkey").alias("c")), "c").join(spread(orders, "c").hint("merge"), "c", "left")
    d_ = keys.selectExpr("c", "k", *lists).groupBy("c").agg(F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", *RECORDS)))).alias("all"))
    joined = lambda name: f"coalesce(array_join(all.{name}, ''), '')"  # nulls are left out
    plain = lambda indent: f"CASE WHEN {PLAIN} THEN '{' ' * indent}- just text' || chr(10) ELSE '' END"
    parts = [f"concat('{n}: ', {e}, chr(10))" for n, e in HEADER.items()]
    parts += ["concat('continuity:', chr(10), '  journal_entry_id: journal.entry-0001', chr(10), '  scene_id: scene-0002', chr(10), 'current_scene:', chr(10))"]
    parts += [f"coalesce(concat('  {n}: ', {e}, chr(10)), '')" for n, e in zip(K.SCENE_KEYS, SCENE_KEY, strict=True)]
    parts += [f"concat('journal_append:', chr(10), CASE WHEN {NO_EVENTS} THEN '  notes: none' || chr(10) ELSE concat('  events:', chr(10), {joined('events')}, {plain(4)}) END)"]
    parts += [f"concat('{n}:', chr(10), {joined(n)}, {plain(2) if n in ('changes', 'resource_changes') else chr(39) * 2})" for n in RECORDS if n != "events"]
    return d_.selectExpr(f"concat('checkpoints/cp-', {NUMBER}, '.yaml') AS path", f"cast(concat({', '.join(parts)}) AS binary) AS content")


def constant(spark: SparkSession, files: dict[str, str | bytes]) -> DataFrame:
    return spark.createDataFrame([(p, t if isinstance(t, bytes) else t.encode()) for p, t in files.items()], "path string, content binary")


CURRENT = "---\ncheckpoint_id: cp-0002\nactive_scene_id: scene-0001\nactive_journal_id: journal.entry-0001\ncampaign_status: active\nlast_activity_at: now\n---\n"


def active(spark: SparkSession, d: str) -> Campaign:
    """The campaign of the customers' checkpoints; its files are rendered once."""
    c = Campaign(Documents(spark, checkpoints(spark, d).unionByName(constant(spark, {"CURRENT.md": CURRENT, "party/hero.md": KNOWN_TEXT}))))
    c.corpus.hold(c.scratch)
    return c


def broken(v: DataFrame, *columns: str) -> DataFrame:
    return v.select("rule", "path", *columns)


def _section(method: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return broken(getattr(active(spark, d), method)("sound and kind = 'delta'"), "item_no", "detail")

    return query


rules_events, rules_changes, rules_resources, rules_facts, rules_threads, rules_knowledge, rules_references = (
    _section(f"_{n}_rules") for n in ("event", "change", "resource", "fact", "thread", "knowledge", "reference")
)


def rules_chain(spark, d):
    """The chain of checkpoints and the pointer at its end, and the rules of whole payloads."""
    single = ["E1010", "E1015", "E1019", "E1025", "E1031", "E1035", "E1061", "E1068", "E1072", "E1079", "E1088", "E1093"]
    return broken(active(spark, d).chain_rules(), "detail").filter(F.col("rule").isin(*single))


def rules_payload(spark, d):
    return broken(active(spark, d).payload_documents("sound and kind = 'delta'"), "detail")


# ---------------------------------------------------------------- pointers, a campaign for each supplier

POINTER = {
    "checkpoint_id": pick("s", ["cp-0001", "cp-0001", "cp-1", "null", "cp-0002", "cp-0001", "cp-0001"]), "active_scene_id": pick("s", ["scene-0001", "scene-1", "scene-0001", "null", "scene-0002"]),
    "active_journal_id": pick("s", ["journal.entry-0001", "journal.entry-0001", "journal.entry-0002", "null", "journal.entry-0001", "entry"]), "campaign_status": "CASE WHEN s % 4 = 3 THEN 'preparation' ELSE 'active' END",
    "last_activity_at": "CASE WHEN s % 17 <> 6 THEN 'x' END",
}
ENTRY = {"id": pick("s", ["journal.entry-0001", "journal.entry-0002"]), "status": pick("s", ["open", "open", "closed"]), "last_checkpoint": pick("s", ["cp-0001", "cp-0001", "cp-0001", None, "cp-0009"])}
POINTER_CLOSED, ENTRY_CLOSED, HAS_CHECKPOINT, HAS_ENTRY = "s % 19 <> 2", "s % 23 <> 3", "s % 9 <> 4", "s % 8 <> 1"


def front(fields: dict[str, str], closed: str) -> Column:
    lines = [F.coalesce(F.concat(F.lit(f"{n}: "), F.expr(e), F.lit("\n")), F.lit("")) for n, e in fields.items()]
    return F.concat(F.lit("---\n"), *lines, F.when(F.expr(closed), "---\n").otherwise(""))


def rules_pointer(spark, d):
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("s"))
    at = lambda name: F.concat(F.lit("s"), F.col("s").cast("string"), F.lit(f"/{name}")).alias("path")
    raw = lambda c: c.cast("binary").alias("content")
    files = s.select(at("CURRENT.md"), raw(front(POINTER, POINTER_CLOSED)))
    files = files.unionByName(s.filter(HAS_CHECKPOINT).select(at("checkpoints/cp-0001.yaml"), raw(F.lit("kind: baseline\n"))))
    files = files.unionByName(s.filter(HAS_ENTRY).select(at("journal/entry-0001.md"), raw(F.concat(front(ENTRY, ENTRY_CLOSED), F.lit("# Entry\nscene-0001\n")))))
    return broken(Campaign(Documents(spark, files), r"\As[0-9]+/").continuity(), "detail")


# ---------------------------------------------------------------- entities, ids, links, sections, words

ENTITY_ID = "CASE s % 12 WHEN 1 THEN '' WHEN 2 THEN 'Bad Id' WHEN 3 THEN 'npc.same' ELSE concat('npc.n', s) END"
UPDATED = pick("s", ["cp-0001", "soon", None, "cp-0002", "cp-12345", "cp-0003 "])


def suppliers(spark, d) -> DataFrame:
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("s"), F.col("s_name").alias("name"))
    text = F.concat(front({"id": ENTITY_ID, "last_updated": UPDATED}, "s % 10 <> 9"), F.when(F.expr("s % 6 <> 5"), "# NPC\n").otherwise("## NPC\n"), F.lit("name: "), "name", F.when(F.expr("s % 14 = 2"), "\nсм. СЕССИЯ-12").when(F.expr("s % 14 = 3"), "\nsessions/1").otherwise(""), F.lit("\n"))
    return s.select(F.concat(F.lit("npcs/s"), F.col("s").cast("string"), F.when(F.expr("s % 25 = 24"), ".txt").otherwise(".md")).alias("path"), text.cast("binary").alias("content"))


def rules_entities(spark, d):
    templates = {p: "---\n" + "".join(f"{k}: x\n" for j, k in enumerate(K.ENTITY_KEYS) if j % 3 != i) + "---\n" * (i < 2) for i, p in enumerate(K.ENTITY_TEMPLATES)}
    c = Campaign(Documents(spark, suppliers(spark, d).unionByName(constant(spark, templates))))
    return broken(c.entity_templates().unionByName(c.entity_checkpoints()), "detail")


def rules_ids(spark, d):
    return broken(Campaign(Documents(spark, suppliers(spark, d))).ids(), "line_no", "item_no", "detail")


def rules_words(spark, d):
    """Legacy words, and documents without a heading of level 1."""
    c = Campaign(Documents(spark, suppliers(spark, d)))
    return broken(c.legacy_words().unionByName(c.headings()), "line_no")


def rules_links(spark, d):
    """A document for each page, with links to suppliers, folders and other pages."""
    p = _t(spark, d, "pages").select(F.col("page_id").alias("p"))
    links = ["[a](../npcs/s", F.expr("p % 150"), ".md#part) ![no](none.png) [w](https://a.b/c)\n[p](<p", F.expr("p * 2"), ".md>) [f](/npcs) [u](", F.expr("CASE WHEN p % 3 = 0 THEN '../../up.md' ELSE './../pages/p1.md \"t\"' END"), ")\n[e](", F.expr("CASE WHEN p % 7 = 0 THEN 's%2Bx.md' ELSE '#here' END"), ")\n"]
    text = F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in links])
    docs = p.select(F.concat(F.lit("pages/p"), F.col("p").cast("string"), F.lit(".md")).alias("path"), text.cast("binary").alias("content"))
    return broken(Campaign(Documents(spark, docs.unionByName(suppliers(spark, d)))).links(), "line_no", "detail")


# ---------------------------------------------------------------- structure, a campaign for each supplier

ROOTS = r"\As[0-9]+/"
#: Which of a root's files, listed paths, templates, headings, terms and keys are left out or empty, by their number i.
NO_FILE, NO_PATH, NO_TEMPLATE, NO_TERM, NO_HEADING, NO_BODY, NO_KEY = "(s + i) % 7 = 3", "(s + i) % 5 = 0", "(s + i) % 8 = 2", "(s + i) % 3 = 1", "(s + i) % 4 = 1", "(s + i) % 4 = 2", "(s + i) % 6 = 2"
BAD_LIST, UNCLOSED, BAD_BYTES, RETURNS = "s % 11 = 5", "s % 9 = 4", "(s + i) % 60 = 11", "(s + i) % 50 = 7"
#: Lines of the list behind its paths: the line's number, the line and when it is there.
EXTRA = ((11, "twin", "s % 3 = 0"), (12, " twin ", "s % 3 = 0"), (13, "extra", "s % 4 = 1"), (14, " ../x ", "s % 4 = 2"), (15, "/abs", "s % 6 = 3"))
SPECIAL = (K.RESET_LIST, K.GUIDE, *K.SECTIONS)


def at(i: int, when: str) -> str:
    return when.replace("+ i)", f"+ {i})")


def chosen(name: str, texts: dict[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {name} = '{n}' THEN {t}" for n, t in texts.items()) + f" ELSE {other} END"


def structure_files(spark: SparkSession, d: str) -> DataFrame:
    """path, content: what a campaign's folder has to hold, for each supplier, less what its number leaves out."""
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("s"))
    here = lambda df, rel: df.select(F.expr(f"concat('s', s, '/', {rel})").alias("path"), "content")
    line = lambda text, when: f"CASE WHEN {when} THEN '{text}' || chr(10) ELSE chr(10) END"
    reset = "concat('# list', chr(10), " + ", ".join([line(p, f"NOT ({at(i, NO_PATH)})") for i, p in enumerate(K.RESET_PATHS)] + [line(t, when) for _, t, when in EXTRA]) + ")"
    guide = "concat('# Guide', chr(10), " + ", ".join(f"CASE WHEN {at(i, NO_TERM)} THEN '' ELSE '{t}, ' END" for i, t in enumerate(K.GUIDE_TERMS)) + ")"
    texts = {K.RESET_LIST: f"CASE WHEN {BAD_LIST} THEN unhex('ff0a') ELSE cast({reset} AS binary) END", K.GUIDE: f"cast({guide} AS binary)"}
    for p, names in K.SECTIONS.items():
        head = "'---' || chr(10), " + ", ".join(f"CASE WHEN {at(i, NO_KEY)} THEN '' ELSE '{k}: x' || chr(10) END" for i, k in enumerate(K.ENTITY_KEYS)) + f", CASE WHEN {UNCLOSED} THEN '' ELSE '---' || chr(10) END, " if p in K.ENTITY_TEMPLATES else ""
        body = ", ".join(f"CASE WHEN {at(i, NO_HEADING)} THEN '' WHEN {at(i, NO_BODY)} THEN '## {n}' || chr(10) ELSE '## {n}' || chr(10) || 'TODO' || chr(10) END" for i, n in enumerate(names))
        texts[p] = f"cast(concat({head}'# T' || chr(10), {body}) AS binary)"
    plain = f"CASE WHEN {BAD_BYTES} THEN unhex('fffe41') WHEN {RETURNS} THEN cast('# x' || chr(13) || chr(10) AS binary) ELSE cast('# x' || chr(10) AS binary) END"
    names = s.select("s", F.posexplode(F.array(*[F.lit(n) for n in K.REQUIRED_FILES])).alias("i", "name")).filter(f"NOT ({NO_FILE})").withColumn("content", F.expr(chosen("name", texts, plain)))
    paths = s.select("s", F.posexplode(F.array(*[F.lit(n) for n in K.RESET_PATHS])).alias("i", "name")).filter(f"i > 0 AND NOT ({NO_TEMPLATE})").withColumn("content", F.lit(b"# x"))
    return here(names, "name").unionByName(here(paths, "'templates/', name, '/README.md'"))


def rules_structure(spark, d):
    """Required files, the list of paths to reset, encodings, terms of the guide, entity templates and required sections of each supplier's campaign."""
    c = Campaign(Documents(spark, structure_files(spark, d)), ROOTS)
    c.corpus.hold(c.scratch)
    parts = [c.required_files(), c.reset_list(), c.encoding(), c.entity_templates(), c.guide_terms(), c.required_sections()]
    return broken(union(parts), "item_no", "detail")


# ---------------------------------------------------------------- states and chains, a campaign for each supplier

#: Checkpoints of a campaign; whether its pointer is there, closed and in preparation; what the pointer and its last checkpoint say.
COUNT, NO_POINTER, OPEN_POINTER, PREPARING = "s % 4", "s % 10 = 9", "s % 10 = 8", "s % 3 = 0"
POINTED, ITS_JOURNAL, ITS_SCENE = "concat('cp-000', s % 3 + 1)", "CASE WHEN s % 5 = 2 THEN 'journal.entry-0002' ELSE 'journal.entry-0001' END", "CASE WHEN s % 7 = 3 THEN 'scene-0002' ELSE 'scene-0001' END"


def state_files(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("s"))
    fence = "'---' || chr(10)"
    pointer = f"concat({fence}, 'checkpoint_id: ', {POINTED}, chr(10), 'active_scene_id: scene-0001', chr(10), 'active_journal_id: journal.entry-0001', chr(10), 'campaign_status: ', CASE WHEN {PREPARING} THEN 'preparation' ELSE 'active' END, chr(10), 'last_activity_at: x', chr(10), CASE WHEN {OPEN_POINTER} THEN '' ELSE {fence} END)"
    current = s.filter(f"NOT ({NO_POINTER})").selectExpr("concat('s', s, '/CURRENT.md') AS path", f"cast({pointer} AS binary) AS content")
    each = s.select("s", F.explode(F.sequence(F.lit(0), F.expr(f"cast({COUNT} AS int)"))).alias("k")).filter("k > 0")
    text = f"concat('checkpoint_id: cp-000', k, chr(10), 'base_checkpoint_id: ', CASE WHEN k = 1 THEN 'null' ELSE concat('cp-000', k - 1) END, chr(10), 'kind: ', CASE WHEN k = 1 THEN 'baseline' ELSE 'delta' END, chr(10), 'schema: {K.SCHEMA}', chr(10), 'continuity:', chr(10), '  journal_entry_id: ', {ITS_JOURNAL}, chr(10), '  scene_id: ', {ITS_SCENE}, chr(10))"
    files = each.selectExpr("concat('s', s, '/checkpoints/cp-000', k, '.yaml') AS path", f"cast({text} AS binary) AS content")
    other = s.filter("s % 4 = 0").selectExpr("concat('s', s, '/README.md') AS path", "cast('# x' AS binary) AS content")
    return current.unionByName(files).unionByName(other)


def rules_states(spark, d):
    """Campaigns that are active without checkpoints or in preparation with some; the chains of the others, and the pointers at their ends."""
    c = Campaign(Documents(spark, state_files(spark, d)), ROOTS)
    c.corpus.hold(c.scratch)
    return broken(c.presence().unionByName(c.chain_rules()), "detail")


# ---------------------------------------------------------------- whole campaigns, one for each supplier

#: What a campaign's number changes in one that is right: files (name and text; None: left out; a pair: what is replaced by what), and the violations that brings as
#: (check, rule, severity, path, line, item, detail).
PREPARED = "---\ncheckpoint_id: null\nactive_scene_id: null\nactive_journal_id: null\ncampaign_status: preparation\nlast_activity_at: null\n---\n"
CHANGED = (
    ({}, ()),
    ({"gm/secrets.md": None}, ((0, "E191", "error", "gm/secrets.md", None, 21, ""), (8, "E1197", "error", "MANIFEST.md", 2, None, "gm/secrets.md"))),
    ({K.RESET_LIST: "\n".join((*K.RESET_PATHS, "extra", ""))}, ((1, "E233", "error", K.RESET_LIST, None, None, "extra"), (1, "E249", "error", K.RESET_LIST, None, 10, "extra"))),
    ({"README.md": "# x\r\n"}, ((2, "E183", "error", "README.md", None, None, ""),)),
    ({"npcs/one.md": "---\nid: kind.t0\nlast_updated: soon\n---\n# One\n"}, ((4, "E840", "error", "npcs/one.md", None, None, "soon"), (7, "E1161", "error", "npcs/one.md", 2, 2, "kind.t0"))),
    ({"CURRENT.md": ("checkpoint_id: null", "checkpoint_id: cp-0001")}, ((5, "E881", "error", "CURRENT.md", None, None, "checkpoint_id"),)),
    ({"checkpoints/cp-0001.yaml": "kind: baseline\n"}, ((6, "E960", "error", "checkpoints/", None, None, ""),)),
    ({"rules/rulings.md": "no heading\nsession-001\n"}, ((10, "E1110", "error", "rules/rulings.md", 2, None, ""), (12, "W1255", "warning", "rules/rulings.md", None, None, ""))),
    ({"archive/README.md": "text\n"}, ((12, "W1255", "warning", "archive/README.md", None, None, ""),)),
)


def whole_files(spark: SparkSession, d: str) -> DataFrame:
    """path, content of a whole campaign in preparation for each supplier, with the change that its number names."""
    files = {p: f"# {p}\n" for p in K.REQUIRED_FILES}
    files["CURRENT.md"] = PREPARED
    for i, p in enumerate(K.ENTITY_TEMPLATES):
        files[p] = "---\n" + "".join(f"{k}: {dict(id=f'kind.t{i}', last_updated='cp-0001').get(k, 'x')}\n" for k in K.ENTITY_KEYS) + "---\n"
    for p, names in K.SECTIONS.items():
        files[p] += "# T\n" + "".join(f"## {n}\nTODO\n" for n in names)
    files[K.GUIDE] = "# Guide\n" + ", ".join(K.GUIDE_TERMS) + "\n"
    files["MANIFEST.md"] += "[secrets](gm/secrets.md)\n"
    files[K.RESET_LIST] = "\n".join((*K.RESET_PATHS, ""))
    files |= {f"templates/{p}/README.md": "# x\n" for p in K.RESET_PATHS[1:]}
    names = sorted({*files, *(n for change, _ in CHANGED for n in change)})
    text = lambda n, t: files[n].replace(*t) if isinstance(t, tuple) else t
    rows = [(m, n, t.encode()) for m, (change, _) in enumerate(CHANGED) for n in names if (t := text(n, change.get(n, files.get(n)))) is not None]
    table = spark.createDataFrame(rows, "m int, name string, content binary")
    s = spread(_t(spark, d, "supplier").selectExpr("s_suppkey AS s", f"cast(s_suppkey % {len(CHANGED)} AS int) AS m"), "s")
    return s.join(F.broadcast(table), "m").select(F.expr("concat('s', s, '/', name)").alias("path"), "content")


def _whole(spark, d) -> tuple[Campaign, DataFrame]:
    c = Campaign(Documents(spark, whole_files(spark, d)), ROOTS)
    return c, c.scratch.store(c.violations(), "violations")


def rules_all(spark, d):
    """The whole catalogue over many campaigns, as the report's numbered lines."""
    c, v = _whole(spark, d)
    return report_lines(v, c.scratch).withColumn("check_no", F.col("check_no").cast("int"))


def report_cube(spark, d):
    """How many violations there are at each level: severity, rule, depth."""
    return cube(_whole(spark, d)[1])


def exit_statuses(spark, d):
    """The exit status of each campaign."""
    return statuses(*_whole(spark, d))


def audit_of_states(spark, d):
    """The read-only audit of the suppliers' campaigns in their states, against what their journals were before."""
    entry = lambda more: _t(spark, d, "supplier").selectExpr("s_suppkey AS s").filter("s % 2 = 0").selectExpr("concat('s', s, '/journal/entry-0001.md') AS path", f"cast(concat('---', chr(10), 'id: x', chr(10), 'status: ', CASE WHEN s % 4 = 0 THEN 'closed' ELSE 'open' END, chr(10), '---', chr(10), 'a', chr(10){more}) AS binary) AS content")
    now, then = entry(", CASE s % 6 WHEN 0 THEN 'b' WHEN 2 THEN '' ELSE 'c' END"), entry(", CASE s % 6 WHEN 4 THEN 'd' ELSE '' END")
    c, before = (Campaign(Documents(spark, state_files(spark, d).filter("path not like '%CURRENT.md'").unionByName(x)), ROOTS) for x in (now, then))
    for x in (c, before):
        x.corpus.hold(x.scratch)
    return broken(c.audit(before), "detail").filter("rule in ('immutable', 'E957')")


# ---------------------------------------------------------------- the parsers alone


def parsed_records(spark, d):
    """Each field of each record of all lists."""
    return active(spark, d).records.select("path", "section", "idx", F.explode("fields").alias("key", "value"))


def parsed_headers(spark, d):
    """Top-level keys, a nested scalar, the keys of a mapping and the count of a list's items of each checkpoint."""
    fields = [F.coalesce(P.get("header", k), F.lit("")).alias(k) for k in HEADER]
    keys = F.array_join(F.array_sort("scene_keys"), ",").alias("scene_keys")
    return active(spark, d).checkpoints.select("path", *fields, "scene", keys, F.col("raw_changes").cast("long").alias("changes"))


def parsed_front_matter(spark, d):
    fronts = Campaign(Documents(spark, suppliers(spark, d))).fronts
    return fronts.select("path", F.col("entries").isNotNull().alias("closed"), P.get("entries", "id").alias("id"), P.get("entries", "last_updated").alias("last_updated"))


def corpus_scan(spark, d):
    """Which files are scanned, and the lines of each."""
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("s"))
    path = F.concat(F.expr(FOLDER), F.expr("concat('f', s)"), F.expr(SUFFIX))
    corpus = Documents(spark, s.select(path.alias("path"), F.expr("concat('a', chr(10), s, chr(13), chr(10), CASE WHEN s % 3 = 0 THEN 'tail' ELSE '' END)").cast("binary").alias("content")))
    return corpus.lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"), F.max("line_no").cast("long").alias("last"))


FOLDER = pick("s", ["", "a/b/", "templates/", "x/.git/", "x/templates/y/", "c/"])
SUFFIX = pick("s", [".md", ".MD", ".sh", ".txt", ".yaml", ".gitignore", ".json", ".parquet", ".py", ".yml", ""])

QUERIES = {
    "parsed_records": parsed_records, "parsed_headers": parsed_headers, "parsed_front_matter": parsed_front_matter, "corpus_scan": corpus_scan,
    "rules_events": rules_events, "rules_changes": rules_changes, "rules_resources": rules_resources, "rules_facts": rules_facts, "rules_threads": rules_threads, "rules_knowledge": rules_knowledge,
    "rules_references": rules_references, "rules_chain": rules_chain, "rules_payload": rules_payload, "rules_pointer": rules_pointer, "rules_entities": rules_entities, "rules_ids": rules_ids, "rules_words": rules_words,
    "rules_links": rules_links, "rules_structure": rules_structure, "rules_states": rules_states, "rules_all": rules_all, "report_cube": report_cube, "exit_statuses": exit_statuses, "audit_of_states": audit_of_states,
}

# ---------------------------------------------------------------- the same in SQL


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def empty(name: str) -> str:
    return f"coalesce({name}, '') = ''"


def missing(*when: tuple[str, str]) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in sorted(when)) + ")"


_PATH = f"concat('checkpoints/cp-', {NUMBER}, '.yaml')"


def _cte(name: str) -> str:
    """A section's records with their number in the document; idx counts the records of the section."""
    when, fields = RECORDS[name]
    rows = ", ".join(f'{e} AS "f_{n}"' for n, e in fields.items())
    none = f" AND NOT ({NO_EVENTS})" if name == "events" else ""
    return f"""{name} AS (SELECT d.path, d.pos, d.sound, d.kind, row_number() OVER (PARTITION BY d.path ORDER BY k)::INTEGER AS idx, r.* EXCLUDE (c, k) FROM
    (SELECT c, k, {rows} FROM (SELECT o_custkey AS c, o_orderkey AS k FROM orders) WHERE ({when}){none}) r JOIN docs d USING (c)),
"""


_BASE = f"""WITH docs AS (SELECT *, regexp_full_match(cid, 'cp-[0-9]{{4}}') AS sound, row_number() OVER (ORDER BY path) AS pos FROM
    (SELECT c, {_PATH} AS path, {HEADER['checkpoint_id']} AS cid, {HEADER['kind']} AS kind, {HEADER['schema']} AS tag, nullif({HEADER['base_checkpoint_id']}, 'null') AS base FROM (SELECT c_custkey AS c FROM customer))),
"""
_GOOD = "good AS (SELECT DISTINCT path, f_id AS id FROM events WHERE regexp_full_match(f_id, 'event-[0-9]{3,}')),\n"
_INTRO = """intro AS (SELECT path, pos, sound, f_id AS ref FROM new_facts UNION ALL SELECT path, pos, sound, f_thread_id FROM open_thread_changes WHERE f_operation = 'add'),
original AS (SELECT ref FROM (VALUES ('hero.one'), ('fact.base'), ('thread.t7'), ('npc.one')) v(ref) WHERE ref NOT IN (SELECT ref FROM intro)),
first AS (SELECT ref, min(pos) AS pos FROM intro WHERE sound GROUP BY ref),
"""
_OWN = f"own AS (SELECT DISTINCT path, f_id AS ref FROM new_facts WHERE regexp_full_match(f_id, '{K.ID}') UNION SELECT path, f_thread_id FROM open_thread_changes WHERE f_operation = 'add'),\n"


def known(ref: str) -> str:
    return f"({ref} IN (SELECT ref FROM original) OR coalesce((SELECT f.pos FROM first f WHERE f.ref = {ref}) < x.pos, FALSE))"


def available(ref: str) -> str:
    return f"({known(ref)} OR EXISTS (SELECT 1 FROM own WHERE own.path = x.path AND own.ref = {ref}))"


def found(name: str, when: str, detail: str, table: str, prefix: str = "f_") -> str:
    return f"SELECT '{name}' AS rule, path, idx AS item_no, {detail} AS detail FROM {table} x WHERE sound AND kind = 'delta' AND ({when})"


def stray(name: str, table: str) -> str:
    return found(name, "f_source_event <> '' AND NOT EXISTS (SELECT 1 FROM good g WHERE g.path = x.path AND g.id = f_source_event)", "f_source_event", table)


def nth(table: str, key: str = "f_id") -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY path, {key} ORDER BY idx) AS nth FROM {table})"


def no_id(column: str) -> str:
    return f"NOT regexp_full_match(coalesce({column}, ''), '{K.ID}')"


def query(tables: list[str], extra: str, parts: list[str]) -> str:
    return _BASE + "".join(_cte(t) for t in tables) + extra.rstrip().rstrip(",") + "\n" + "\nUNION ALL ".join(parts) if extra else (_BASE + "".join(_cte(t) for t in tables)).rstrip().rstrip(",") + "\n" + "\nUNION ALL ".join(parts)


_talk = "f_type = 'dialogue'"
_lack_events = missing(("speaker", f"{_talk} AND {empty('f_speaker')}"), ("recipients", f"{_talk} AND NOT starts_with(coalesce(f_recipients, ''), chr(10)) AND (f_recipients IS NULL OR f_recipients = '[]')"))
_lack_changes = missing(*[(n, empty(f"f_{n}")) for n in K.CHANGE_FIELDS], *[(n, f'f_operation IN (\'set\', \'move\') AND "f_{n}" IS NULL') for n in ("from", "to")], ("value", "f_operation IN ('add', 'remove') AND f_value IS NULL"))
_lack_resources = missing(*[(n, f"f_{n} IS NULL") for n in K.RESOURCE_FIELDS if n != "name"], ("name", empty("f_name")))
_lack_facts = missing(*[(n, empty(f"f_{n}")) for n in K.FACT_FIELDS])
_lack_threads = missing(*[(n, empty(f"f_{n}")) for n in K.THREAD_FIELDS], *[(n, f"f_operation = 'add' AND {empty(f'f_{n}')}") for n in K.THREAD_ADD], ("note", f"f_operation = 'update' AND {empty('f_note')}"), ("resolution", f"f_operation = 'close' AND {empty('f_resolution')}"))
_lack_knowledge = missing(*[(n, empty(f"f_{n}")) for n in K.KNOWLEDGE_FIELDS])
_there = f"({known('f_thread_id')} OR EXISTS (SELECT 1 FROM open_thread_changes a WHERE a.path = x.path AND a.f_operation = 'add' AND a.f_thread_id = x.f_thread_id AND a.idx < x.idx))"
_values = lambda column: f"(SELECT * FROM (SELECT *, unnest(string_split(CASE WHEN starts_with({column}, chr(10)) THEN substr({column}, 2) ELSE {column} END, chr(10))) AS ref FROM {{}}) WHERE ref NOT IN ('', '[]'))"

ORACLES = {
    "rules_events": query(["events"], "", [
        found("E438", "NOT regexp_full_match(f_id, 'event-[0-9]{3,}')", "f_id", "events"), found("E443", "nth > 1 AND regexp_full_match(f_id, 'event-[0-9]{3,}')", "f_id", nth("events")),
        found("E449", empty("f_summary"), "''", "events"), found("E455", f"coalesce(f_type, '') NOT IN ({quoted(K.EVENT_TYPES)})", "coalesce(f_type, '')", "events"), found("E460", empty("f_fiction_time"), "''", "events"),
        found("E470", f"{_talk} AND f_speaker <> '' AND {no_id('f_speaker')}", "f_speaker", "events"), found("E483", f"{_lack_events} <> ''", _lack_events, "events"),
    ]),
    "rules_changes": query(["events", "changes"], _GOOD, [
        found("E505", f"coalesce(f_operation, '') NOT IN ({quoted(K.CHANGE_OPERATIONS)})", "f_operation", "changes"), found("E516", f"{_lack_changes} <> ''", _lack_changes, "changes"), stray("E523", "changes"),
    ]),
    "rules_resources": query(["events", "resource_changes"], _GOOD, [
        found("E570", no_id("f_id"), "f_id", "resource_changes"), found("E575", f"nth > 1 AND NOT {no_id('f_id')}", "f_id", nth("resource_changes")), found("E584", f"f_operation NOT IN ({quoted(K.RESOURCE_OPERATIONS)})", "f_operation", "resource_changes"),
        *[found(r, f"f_operation = '{op}' AND coalesce(f_{k}, '') IN ('', 'null', '~')", f"'{k}'", "resource_changes") for r, op, ks in (("E593", "transfer", ("holder_before", "holder_after")), ("E600", "consume", ("quantity_before", "quantity_after"))) for k in ks],
        found("E605", f"{_lack_resources} <> ''", _lack_resources, "resource_changes"), stray("E611", "resource_changes"),
    ]),
    "rules_facts": query(["events", "new_facts", "open_thread_changes"], _GOOD + _INTRO, [
        found("E638", f"f_id <> '' AND ({no_id('f_id')} OR nth > 1 OR {known('f_id')})", "f_id", nth("new_facts")), found("E645", f"coalesce(f_kind, '') NOT IN ({quoted(K.FACT_KINDS)})", "f_kind", "new_facts"),
        found("E650", f"coalesce(f_truth_status, '') NOT IN ({quoted(K.TRUTH)})", "f_truth_status", "new_facts"), found("E655", f"{_lack_facts} <> ''", _lack_facts, "new_facts"), stray("E661", "new_facts"),
    ]),
    "rules_threads": query(["events", "new_facts", "open_thread_changes"], _GOOD + _INTRO, [
        found("E680", f"f_operation NOT IN ({quoted(K.THREAD_OPERATIONS)})", "f_operation", "open_thread_changes"), found("E685", no_id("f_thread_id"), "f_thread_id", "open_thread_changes"),
        found("E696", f"f_operation = 'add' AND {_there}", "f_thread_id", "open_thread_changes"), found("E705", f"f_operation = 'update' AND NOT {_there}", "f_thread_id", "open_thread_changes"),
        found("E712", f"f_operation = 'close' AND NOT {_there}", "f_thread_id", "open_thread_changes"), found("E716", f"{_lack_threads} <> ''", _lack_threads, "open_thread_changes"), stray("E722", "open_thread_changes"),
    ]),
    "rules_knowledge": query(["events", "new_facts", "open_thread_changes", "knowledge_changes"], _GOOD + _INTRO + _OWN, [
        found("E759", f"f_operation NOT IN ({quoted(K.KNOWLEDGE_OPERATIONS)})", "f_operation", "knowledge_changes"), found("E765", f"f_subject <> 'party' AND {no_id('f_subject')}", "f_subject", "knowledge_changes"),
        found("E771", f"f_knowledge_ref <> '' AND NOT {available('f_knowledge_ref')}", "f_knowledge_ref", "knowledge_changes"), found("E776", f"{_lack_knowledge} <> ''", _lack_knowledge, "knowledge_changes"), stray("E782", "knowledge_changes"),
    ]),
    "rules_references": query(["events", "new_facts", "open_thread_changes"], _INTRO + _OWN, [
        found("E737", f"NOT {available('x.ref')}", "x.ref", _values("f_related_facts").format("open_thread_changes")), found("E794", f"NOT {available('x.ref')}", "x.ref", _values("f_knowledge_refs").format("events")),
    ]),
    "rules_chain": _BASE + """linked AS (SELECT *, lag(cid) OVER w AS last_id, lag(number) OVER w AS last_number FROM (SELECT *, substr(cid, 4)::INTEGER AS number FROM docs WHERE sound) WINDOW w AS (ORDER BY number, path)),
        last AS (SELECT cid FROM linked ORDER BY number DESC, path DESC LIMIT 1), again AS (SELECT *, lag(path) OVER (PARTITION BY cid ORDER BY path) AS before FROM docs WHERE sound)
        SELECT 'E1010' AS rule, path, cid AS detail FROM docs WHERE NOT sound UNION ALL SELECT 'E1015', path, cid FROM docs WHERE sound AND path <> concat('checkpoints/', cid, '.yaml')
        UNION ALL SELECT 'E1019', path, concat(cid, ', ', before) FROM again WHERE before IS NOT NULL""" + f""" UNION ALL SELECT 'E1025', path, '' FROM docs WHERE sound AND tag <> '{K.SCHEMA}'
        UNION ALL SELECT 'E1031', path, '' FROM docs WHERE sound AND cid = 'cp-0001' AND kind <> 'baseline' UNION ALL SELECT 'E1035', path, '' FROM docs WHERE sound AND cid <> 'cp-0001' AND kind <> 'delta'
        UNION ALL SELECT 'E1061', path, '' FROM linked WHERE last_id IS NULL AND (cid <> 'cp-0001' OR base IS NOT NULL) UNION ALL SELECT 'E1068', path, last_id FROM linked WHERE number <> last_number + 1
        UNION ALL SELECT 'E1072', path, last_id FROM linked WHERE last_id IS NOT NULL AND base IS DISTINCT FROM last_id UNION ALL SELECT 'E1079', 'CURRENT.md', cid FROM last WHERE cid <> 'cp-0002'
        UNION ALL SELECT 'E1093', concat('checkpoints/', cid, '.yaml'), '' FROM last""",
    "rules_payload": (_BASE + "".join(_cte(t) for t in ("events", "changes", "resource_changes"))).rstrip().rstrip(",") + f"""
        , lack AS (SELECT *, {missing(*[(n, f'c % 15 = {i}') for i, n in enumerate(K.SCENE_KEYS)])} AS keys FROM docs WHERE sound AND kind = 'delta')
        SELECT 'E412' AS rule, path, keys AS detail FROM lack WHERE keys <> '' UNION ALL SELECT 'E420', path, '' FROM lack WHERE {NO_EVENTS}
        UNION ALL SELECT 'E429', path, '' FROM lack WHERE {PLAIN} AND NOT ({NO_EVENTS}) UNION ALL SELECT 'E494', path, '' FROM lack WHERE {PLAIN} UNION ALL SELECT 'E534', path, '' FROM lack WHERE {PLAIN}""",
    "rules_pointer": f"""WITH p AS (SELECT s, concat('s', s, '/') AS root, {', '.join(f'{e} AS {n}' for n, e in POINTER.items())}, {POINTER_CLOSED} AS closed, {HAS_CHECKPOINT} AS has_cp, {HAS_ENTRY} AS has_entry, {ENTRY_CLOSED} AS entry_closed,
        {', '.join(f'{e} AS j_{n}' for n, e in ENTRY.items())} FROM (SELECT s_suppkey AS s FROM supplier)),
        w AS (SELECT *, closed AND last_activity_at IS NOT NULL AS whole FROM p), a AS (SELECT *, regexp_full_match(active_journal_id, 'journal\\.entry-[0-9]{{4}}') AS named FROM w WHERE whole AND campaign_status <> 'preparation'),
        e AS (SELECT *, concat(root, 'journal/entry-', string_split(active_journal_id, '-')[-1], '.md') AS entry, active_journal_id = 'journal.entry-0001' AND has_entry AS there FROM a WHERE named)
        SELECT 'E855' AS rule, concat(root, 'CURRENT.md') AS path, '' AS detail FROM w WHERE NOT closed UNION ALL SELECT 'E867', concat(root, 'CURRENT.md'), 'last_activity_at' FROM w WHERE closed AND NOT whole
        """ + "".join(f"UNION ALL SELECT 'E881', concat(root, 'CURRENT.md'), '{k}' FROM w WHERE whole AND campaign_status = 'preparation' AND {k} <> 'null' " for k in ("checkpoint_id", "active_scene_id", "active_journal_id")) + """
        UNION ALL SELECT 'E888', concat(root, 'CURRENT.md'), checkpoint_id FROM a WHERE NOT regexp_full_match(checkpoint_id, 'cp-[0-9]{4}') UNION ALL SELECT 'E892', concat(root, 'CURRENT.md'), active_scene_id FROM a WHERE NOT regexp_full_match(active_scene_id, 'scene-[0-9]{4}')
        UNION ALL SELECT 'E897', concat(root, 'CURRENT.md'), active_journal_id FROM a WHERE NOT named UNION ALL SELECT 'E905', concat(root, 'CURRENT.md'), concat(root, 'checkpoints/', checkpoint_id, '.yaml') FROM a WHERE named AND NOT (has_cp AND checkpoint_id = 'cp-0001')
        UNION ALL SELECT 'E915', concat(root, 'CURRENT.md'), entry FROM e WHERE NOT there UNION ALL SELECT 'E922', entry, '' FROM e WHERE there AND NOT entry_closed
        UNION ALL SELECT 'E925', entry, '' FROM e WHERE there AND entry_closed AND j_id <> active_journal_id UNION ALL SELECT 'E929', entry, '' FROM e WHERE there AND entry_closed AND j_status <> 'open'
        UNION ALL SELECT 'E933', entry, checkpoint_id FROM e WHERE there AND entry_closed AND j_last_checkpoint IS DISTINCT FROM checkpoint_id UNION ALL SELECT 'E937', entry, active_scene_id FROM e WHERE there AND entry_closed AND active_scene_id NOT IN ('scene-0001')""",
    "rules_entities": "WITH t AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{p}', '{', '.join(sorted(k for j, k in enumerate(K.ENTITY_KEYS) if j % 3 == i))}')" for i, p in enumerate(K.ENTITY_TEMPLATES)) + f""") v(i, path, lacking)),
        s AS (SELECT concat('npcs/s', s, '.md') AS path, {UPDATED} AS updated FROM (SELECT s_suppkey AS s FROM supplier) WHERE s % 25 <> 24 AND s % 10 <> 9)
        SELECT 'E812' AS rule, path, '' AS detail FROM t WHERE i = 2 UNION ALL SELECT 'E816', path, lacking FROM t WHERE i < 2 UNION ALL SELECT 'E840', path, trim(updated) FROM s WHERE NOT regexp_full_match(trim(updated), 'cp-[0-9]{{4}}')
        UNION ALL SELECT 'E840', path, 'x' FROM t WHERE i < 2 AND lacking NOT LIKE '%last_updated%'""",
    "rules_ids": f"""WITH s AS (SELECT concat('npcs/s', s, CASE WHEN s % 25 = 24 THEN '.txt' ELSE '.md' END) AS path, {ENTITY_ID} AS id FROM (SELECT s_suppkey AS s FROM supplier))
        SELECT 'E1150' AS rule, path, 2 AS line_no, NULL::INTEGER AS item_no, '' AS detail FROM s WHERE id = '' UNION ALL SELECT 'E1153', path, 2, NULL, id FROM s WHERE id <> '' AND NOT regexp_full_match(id, '{K.ID}')
        UNION ALL SELECT 'E1161', min(path), 2, count(*)::INTEGER, id FROM s WHERE id <> '' GROUP BY id HAVING count(*) > 1""",
    "rules_words": """WITH s AS (SELECT s, concat('npcs/s', s, '.md') AS path, 5 + CASE WHEN s % 10 = 9 THEN -1 ELSE 0 END + CASE WHEN s % 6 = 2 THEN -1 ELSE 0 END + 2 AS last FROM (SELECT s_suppkey AS s FROM supplier) WHERE s % 25 <> 24)
        SELECT 'E1110' AS rule, path, last::INTEGER AS line_no FROM s WHERE s % 14 IN (2, 3) UNION ALL SELECT 'W1255', path, NULL FROM s WHERE s % 6 = 5""",
    "rules_links": """WITH p AS (SELECT page_id AS p, concat('pages/p', page_id, '.md') AS path FROM pages), s AS (SELECT s_suppkey AS s FROM supplier WHERE s_suppkey % 25 <> 24)
        SELECT 'E1197' AS rule, path, 1 AS line_no, concat('../npcs/s', p % 150, '.md') AS detail FROM p WHERE p % 150 NOT IN (SELECT s FROM s)
        UNION ALL SELECT 'E1197', path, 2, concat('p', p * 2, '.md') FROM p WHERE p * 2 NOT IN (SELECT p FROM p) UNION ALL SELECT 'E1197', path, 2, '../../up.md' FROM p WHERE p % 3 = 0
        UNION ALL SELECT 'E1197', path, 2, './../pages/p1.md' FROM p WHERE p % 3 <> 0 AND 1 NOT IN (SELECT p FROM p) UNION ALL SELECT 'E1197', path, 3, 's+x.md' FROM p WHERE p % 7 = 0""",
}


def values(rows, columns: str) -> str:
    text = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + f") v({columns})"


_PLAIN = [(i, n) for i, n in enumerate(K.REQUIRED_FILES) if n not in SPECIAL and not n.startswith("templates/") and not n.endswith(".sh")]
_ITEMS = [(i + 1, p, 1, f"templates/{p}") for i, p in enumerate(K.RESET_PATHS)]
_SUPPLIERS = "(SELECT s_suppkey AS s, concat('s', s_suppkey, '/') AS root FROM supplier)"
ORACLES |= {
    "rules_structure": f"""WITH x AS {_SUPPLIERS}, f AS (SELECT * FROM x, {values(enumerate(K.REQUIRED_FILES), 'i, name')}), there AS (SELECT * FROM f WHERE NOT ({NO_FILE})),
        l AS (SELECT s, root, concat(root, '{K.RESET_LIST}') AS path FROM there WHERE name = '{K.RESET_LIST}'), ok AS (SELECT * FROM l WHERE NOT ({BAD_LIST})), p AS (SELECT * FROM ok, {values(enumerate(K.RESET_PATHS), 'i, item')}),
        e AS ({' UNION ALL '.join(f"SELECT s, root, path, {n} AS n, trim('{t}') AS item FROM ok WHERE {when}" for n, t, when in EXTRA)}), h AS (SELECT * FROM there JOIN {values([(p, i, n) for p, ns in K.SECTIONS.items() for i, n in enumerate(ns)], 'name, k, heading')} USING (name))
        SELECT 'E191' AS rule, concat(root, name) AS path, i AS item_no, '' AS detail FROM f WHERE {NO_FILE} UNION ALL SELECT 'E202', path, NULL, '' FROM l WHERE {BAD_LIST}
        UNION ALL SELECT 'E211', path, NULL, '' FROM ok WHERE s % 3 = 0 UNION ALL SELECT 'E228', path, NULL, string_agg(item, ', ' ORDER BY item) FROM p WHERE {NO_PATH} GROUP BY path
        UNION ALL SELECT 'E233', path, NULL, string_agg(item, ', ' ORDER BY item) FROM (SELECT DISTINCT path, item FROM e) GROUP BY path UNION ALL SELECT 'E244', path, n, item FROM e WHERE item IN ('../x', '/abs')
        UNION ALL SELECT 'E249', path, n, item FROM e WHERE item IN ('twin', 'extra') UNION ALL SELECT 'E249', path, i + 1, item FROM p WHERE NOT ({NO_PATH}) AND CASE WHEN i = 0 THEN (s + {K.REQUIRED_FILES.index('templates/CURRENT.md')}) % 7 = 3 ELSE {NO_TEMPLATE} END
        UNION ALL SELECT CASE WHEN {BAD_BYTES} THEN 'E180' ELSE 'E183' END, concat(root, name), NULL, '' FROM there JOIN {values([(n,) for _, n in _PLAIN], 'name')} USING (name) WHERE {BAD_BYTES} OR {RETURNS}
        UNION ALL SELECT 'E1126', concat(root, name), NULL, term FROM (SELECT s, root, name FROM there WHERE name = '{K.GUIDE}'), {values(enumerate(K.GUIDE_TERMS), 'i, term')} WHERE {NO_TERM}
        UNION ALL SELECT 'E812', concat(root, name), NULL, '' FROM there WHERE name IN ({quoted(K.ENTITY_TEMPLATES)}) AND {UNCLOSED}
        UNION ALL SELECT 'E816', concat(root, name), NULL, string_agg(key, ', ' ORDER BY key) FROM (SELECT s, root, name FROM there WHERE name IN ({quoted(K.ENTITY_TEMPLATES)}) AND NOT ({UNCLOSED})), {values(enumerate(K.ENTITY_KEYS), 'i, key')} WHERE {NO_KEY} GROUP BY root, name
        UNION ALL SELECT CASE WHEN (s + k) % 4 = 1 THEN 'E1245' ELSE 'W1247' END, concat(root, name), k, heading FROM h WHERE (s + k) % 4 IN (1, 2)""",
    "rules_states": f"""WITH x AS (SELECT *, {COUNT} AS n, NOT ({NO_POINTER}) AND NOT ({OPEN_POINTER}) AS whole FROM {_SUPPLIERS} WHERE NOT ({NO_POINTER}) OR s % 4 IN (0, 1, 2, 3)), y AS (SELECT *, whole AND {PREPARING} AS preparing, concat('cp-000', n) AS last FROM x),
        z AS (SELECT * FROM y WHERE NOT preparing AND n > 0 AND whole)
        SELECT 'E957' AS rule, concat(root, 'checkpoints/') AS path, '' AS detail FROM y WHERE NOT preparing AND n = 0 UNION ALL SELECT 'E960', concat(root, 'checkpoints/'), '' FROM y WHERE preparing AND n > 0
        UNION ALL SELECT 'E1079', concat(root, 'CURRENT.md'), last FROM z WHERE {POINTED} <> last UNION ALL SELECT 'E1088', concat(root, 'checkpoints/', last, '.yaml'), '' FROM z WHERE {ITS_JOURNAL} <> 'journal.entry-0001'
        UNION ALL SELECT 'E1093', concat(root, 'checkpoints/', last, '.yaml'), '' FROM z WHERE {ITS_SCENE} <> 'scene-0001'""",
    "audit_of_states": f"""WITH x AS (SELECT * FROM {_SUPPLIERS}) SELECT 'E957' AS rule, concat(root, 'checkpoints/') AS path, '' AS detail FROM x WHERE {COUNT} = 0
        UNION ALL SELECT 'immutable', concat(root, 'journal/entry-0001.md'), CASE WHEN s % 4 = 0 THEN 'closed' ELSE 'open' END FROM x WHERE s % 2 = 0 AND CASE WHEN s % 4 = 0 THEN s % 6 <> 2 ELSE s % 6 = 4 END""",
}
_VIOLATIONS = f"""(SELECT rule, severity, concat(root, name) AS path, line_no, item_no, detail, check_no FROM {_SUPPLIERS} JOIN {values([(m, *v) for m, (_, vs) in enumerate(CHANGED) for v in vs], 'm, check_no, rule, severity, name, line_no, item_no, detail')} ON s % {len(CHANGED)} = m)"""
ORACLES |= {
    "rules_all": f"SELECT *, row_number() OVER (ORDER BY check_no, string_split(path, '/'), line_no NULLS FIRST, item_no NULLS FIRST, rule, detail) AS n FROM {_VIOLATIONS}",
    "report_cube": f"SELECT severity, rule, depth, grouping_id(severity, rule, depth)::BIGINT AS level, count(*) AS violations FROM (SELECT *, (len(string_split(path, '/')) - 1)::INTEGER AS depth FROM {_VIOLATIONS}) GROUP BY ROLLUP (severity, rule, depth)",
    "exit_statuses": f"""SELECT root, count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings, CASE WHEN count(*) FILTER (WHERE severity = 'error') > 0 THEN 1 ELSE 0 END AS status
        FROM {_SUPPLIERS} x LEFT JOIN {_VIOLATIONS} v ON starts_with(v.path, x.root) GROUP BY root""",
}
_SECTIONS = list(RECORDS)
ORACLES |= {
    "parsed_records": (_BASE + "".join(_cte(t) for t in _SECTIONS)).rstrip().rstrip(",") + "\n" + "\nUNION ALL ".join(
        f"""SELECT path, '{t}' AS section, idx, '{n}' AS key, "f_{n}" AS value FROM {t} WHERE "f_{n}" IS NOT NULL""" for t in _SECTIONS for n in RECORDS[t][1]
    ),
    "parsed_headers": (_BASE + _cte("changes")).rstrip().rstrip(",") + f"""
        SELECT path, {', '.join(f'{e} AS {n}' for n, e in HEADER.items())}, 'scene-0002' AS scene, concat_ws(',', {', '.join(f"CASE WHEN c % 15 <> {i} THEN '{n}' END" for n, i in sorted((n, i) for i, n in enumerate(K.SCENE_KEYS)))}) AS scene_keys,
        coalesce((SELECT count(*) FROM changes x WHERE x.path = docs.path), 0) + CASE WHEN {PLAIN} THEN 1 ELSE 0 END AS changes FROM docs""",
    "parsed_front_matter": f"""SELECT concat('npcs/s', s, CASE WHEN s % 25 = 24 THEN '.txt' ELSE '.md' END) AS path, s % 10 <> 9 AS closed, CASE WHEN s % 10 <> 9 THEN {ENTITY_ID} END AS id, CASE WHEN s % 10 <> 9 THEN trim({UPDATED}) END AS last_updated
        FROM (SELECT s_suppkey AS s FROM supplier)""",
    "corpus_scan": f"""SELECT concat(folder, 'f', s, suffix) AS path, CASE WHEN s % 3 = 0 THEN 3 ELSE 2 END::BIGINT AS lines, CASE WHEN s % 3 = 0 THEN 3 ELSE 2 END::BIGINT AS last FROM (SELECT s, {FOLDER} AS folder, {SUFFIX} AS suffix FROM (SELECT s_suppkey AS s FROM supplier))
        WHERE lower(suffix) IN ('.md', '.txt', '.yaml', '.json', '.py', '.yml') AND folder IN ('', 'a/b/', 'c/')""",
}
