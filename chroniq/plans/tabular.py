"""The checks of ``chroniq.operators.checks`` on the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions import text as T
from chroniq.operators import checks as C
from chroniq.operators import state as S


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def fk_orders_without_lines(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return C.foreign_key(o, _t(spark, d, "lineitem"), [("o_orderkey", "l_orderkey")])


def required_docs_without_label(spark, d):
    return C.required_set(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), ["doc_id"])


def unique_line_keys(spark, d):
    return C.unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def unique_located_text(spark, d):
    return C.unique_located(_t(spark, d, "documents"), F.col("text"), "doc_id")


def first_wins_line(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return C.first_wins(li, ["l_orderkey"], "l_linenumber", ["l_partkey", "l_suppkey", "l_extendedprice"])


def chain_line_gaps(spark, d):
    keys = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return C.chain(keys, ["l_orderkey"], "l_linenumber").filter("not continues").drop("continues")


def chain_turns_ok(spark, d):
    turns = C.chain(_t(spark, d, "conversations").select("conv_id", "turn"), ["conv_id"], "turn")
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("first_turn"), F.bool_and("continues").alias("unbroken"))


def visible_purchase_before_signup(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    uses = e.filter("event_type = 'purchase'").drop("event_type")
    return C.visible_before(uses, e.filter("event_type = 'signup'"), "user_id", "ts").select("event_id", "user_id")


def pointer_latest_event(spark, d):
    return C.pointer(_t(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


def domain_event_type(spark, d):
    return C.domain(_t(spark, d, "events").select("event_id", "event_type"), "event_type", ["click", "purchase", "signup", "view"])


def format_url(spark, d):
    return C.format_of(_t(spark, d, "pages").select("page_id", "url"), "url", r"http://[a-z0-9.-]+/[a-z]{2}/[0-9]+")


def line_match_email(spark, d):
    return C.line_match(_t(spark, d, "documents"), "doc_id", "text", "[a-z0-9.]+@[a-z0-9.]+")


def links_href_targets(spark, d):
    """Links of a page's HTML to a first path segment that is no language of any page's own address; ``rules_links`` checks Markdown."""
    p = _t(spark, d, "pages")
    targets = p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), 1)).alias("target"))
    known = p.select(F.concat(F.lit("/"), F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1)).alias("target")).distinct()
    return targets.join(known, "target", "left_anti").groupBy("page_id", "target").agg(F.count(F.lit(1)).alias("n"))


def sections_heading(spark, d):
    """Headings and paragraphs of HTML pages; ``rules_structure`` parses sections of Markdown."""
    return _t(spark, d, "pages").select("page_id", F.regexp_extract("html", r"<h1>([^<]*)</h1>", 1).alias("heading"), F.regexp_count("html", F.lit("<p>")).cast("long").alias("paragraphs"))


def conditional_required_order(spark, d):
    o = _t(spark, d, "orders")
    urgent, dear = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_totalprice") >= 1000
    rules = {"final_status": (urgent, F.col("o_orderstatus") != "P"), "known_priority": (dear, F.col("o_orderpriority") != "4-NOT SPECIFIED")}
    return C.conditional_required(o, rules).select("o_orderkey", F.array_join("missing", ",").alias("missing"))


def set_compare_keys(spark, d):
    o = _t(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    c = _t(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"))
    return C.set_compare(o, c, "custkey")


def front_matter_lines(spark, d):
    """The parser of flat ``key: value`` lines on the events' properties; ``parsed_front_matter`` parses whole texts."""
    e = _t(spark, d, "events").select("event_id", F.regexp_replace("props", r"[{}]", "").alias("line"))
    return e.select("event_id", T.key_of("line").alias("key"), T.value_of("line").alias("value"))


def fold_event_values(spark, d):
    """Purchases and errors as signed quantities, signups and views as settings of a user."""
    e = _t(spark, d, "events")
    op = F.when(F.col("event_type") == "purchase", "add").when(F.col("event_type") == "error", "remove").when(F.col("event_type") == "signup", "set")
    quantity = F.get_json_object("props", "$.k").cast("double")
    changes = e.select(F.col("ts").alias("cp"), F.col("event_id").alias("idx"), op.alias("operation"), F.col("user_id").alias("target"), F.col("event_id").cast("string").alias("to"), F.lit("k").alias("value"), quantity.alias("quantity"))
    return S.fold(changes.filter("operation is not null"))


def reconcile_order_status(spark, d):
    """Orders whose count of lines is not what their priority's first digit says."""
    o = _t(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("long").alias("n"))
    li = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return S.reconcile(o, li, "o_orderkey", "n")


def clocks_of_users(spark, d):
    """A clock of each user that an error drives by one, up to 12."""
    ticks = _t(spark, d, "events").filter("event_type = 'error'").select("user_id", "event_id", "ts", F.lit(1).cast("long").alias("tick"))
    limits = _t(spark, d, "events").select("user_id").distinct().withColumn("limit", F.lit(12).cast("long")).withColumn("effect", F.concat(F.lit("lock "), F.col("user_id").cast("string")))
    ran = S.clocks(ticks, limits, "user_id", ["ts", "event_id"], "tick")
    return ran.select("event_id", "user_id", "current", "struck", F.when(F.col("fires"), F.col("effect")).alias("effect"))


def precedence_event_value(spark, d):
    ladder = spark.createDataFrame([("purchase", 1), ("signup", 2), ("click", 3)], "event_type string, rank int")
    return S.precedence(_t(spark, d, "events"), ladder, "user_id", "event_type", "value", "event_id")


def coverage_of_documents(spark, d):
    ledger = _t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "covered").otherwise("immaterial").alias("status"))
    return S.coverage(_t(spark, d, "documents").select("doc_id", "lang"), ledger, "doc_id").groupBy("lang", "status").agg(F.count(F.lit(1)).alias("n"))


def fk_list_parts(spark, d):
    """Parts listed by an order that are none of the small ones."""
    orders = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return C.foreign_key_list(orders, "parts", _t(spark, d, "part").filter("p_size < 25"), "p_partkey").select("l_orderkey", F.col("value").alias("l_partkey"))


def assertions_of_events(spark, d):
    """Each event claims that its user's event before was of its own type; even users are held to start with a click."""
    e = _t(spark, d, "events")
    changes = e.select(F.col("ts").alias("cp"), F.col("event_id").alias("idx"), F.lit("set").alias("operation"), F.col("user_id").alias("target"), F.col("event_type").alias("from"), F.col("event_type").alias("to"))
    state = e.filter("user_id % 2 = 0").select(F.col("user_id").alias("target")).distinct().withColumn("value", F.lit("click"))
    return S.failed_assertions(changes, state).select(F.col("idx").alias("event_id"), "expected")


def stale_orders(spark, d):
    packages = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("base"))
    return S.stale(packages, spark.createDataFrame([("F",)], "id string")).select("o_orderkey")


def _segments(spark, d):
    state = _t(spark, d, "customer").select(F.col("c_custkey").alias("target"), F.col("c_mktsegment").alias("value"))
    o = _t(spark, d, "orders")
    changes = o.select(F.col("o_orderdate").alias("cp"), F.col("o_orderkey").alias("idx"), F.lit("set").alias("operation"), F.col("o_custkey").alias("target"), F.col("o_orderpriority").alias("to"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("double").alias("quantity"))
    return state, changes


def apply_orders(spark, d):
    """All or nothing: orders set their customers' value; a package with a violation changes nothing."""
    state, changes = _segments(spark, d)
    done = S.apply(state, changes, changes.filter("to is null")).select("target", "value", F.lit("applied").alias("package"))
    refused = S.apply(state, changes, changes.filter("to = '1-URGENT'")).select("target", "value", F.lit("refused").alias("package"))
    return done.unionByName(refused)


def superseded_events(spark, d):
    return S.superseded(_t(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_type"])


def visible_customers(spark, d):
    return S.visible(_t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), ["BUILDING", "MACHINERY"], "c_mktsegment", F.col("c_acctbal") < 0).select("c_custkey")


def context_of_parts(spark, d):
    """Parts as documents: some always, those of large lines, those of a type that is asked for, none of one brand."""
    p = _t(spark, d, "part").select(F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string")).alias("path"), F.col("p_partkey").alias("id"), F.col("p_type").alias("topic"), "p_brand")
    active = _t(spark, d, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("id"))
    topics = p.filter("id % 100 = 7").select("topic").distinct()
    return S.context(p, active, F.col("id") <= 3, "Brand#1", topics).select("id", "tier")


def increment_of_events(spark, d):
    e = _t(spark, d, "events").select("event_id", "event_type")
    return S.increment(e, e.filter("event_type = 'view'"), "event_id")


def immutable_documents(spark, d):
    """Documents of quality are closed, others open; some grow, some shrink, some are gone."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    before = docs.join(_t(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "closed").otherwise("open").alias("status")), "id")
    after = docs.filter("id % 7 <> 0").withColumn("text", F.when(F.col("id") % 5 == 0, F.concat("text", F.lit(" more"))).when(F.col("id") % 5 == 1, F.lit("less")).otherwise(F.col("text")))
    return S.broken_immutability(before, after)


def scenes_of_orders(spark, d):
    scenes = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "close").otherwise("continue").alias("scene_status"), F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("scene-"), F.col("o_custkey").cast("string"))).alias("next_scene_id"))
    return S.scene_lifecycle(scenes).select("o_orderkey", F.array_join("missing", ",").alias("missing"))


def timeline_of_errors(spark, d):
    return S.timeline(_t(spark, d, "events").filter("event_type = 'error'"), ["ts", "event_id"], ["ts", "event_id", "user_id"])


def unresolved_pages(spark, d):
    """Pages whose host is a placeholder or no host of an early page."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    p = _t(spark, d, "pages").select("page_id", host.alias("source"))
    return S.unresolved_sources(p, p.filter("page_id % 10 = 0").distinct(), ["example.com"]).select("page_id")


def blocking_documents(spark, d):
    """Documents that no label covers, or whose status is no class of a ledger."""
    ledger = _t(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "covered").otherwise("immaterial").alias("status"))
    return S.blocking(S.coverage(_t(spark, d, "documents").select("doc_id"), ledger, "doc_id"))


PARTS = (fk_orders_without_lines, required_docs_without_label, unique_line_keys, chain_line_gaps, visible_purchase_before_signup, domain_event_type, format_url, line_match_email)


def report_summary(spark, d):
    return C.report({f.__name__: f(spark, d) for f in PARTS})


QUERIES = {
    f.__name__: f
    for f in (
        fk_orders_without_lines, required_docs_without_label, unique_line_keys, unique_located_text, first_wins_line, chain_line_gaps, chain_turns_ok,
        visible_purchase_before_signup, pointer_latest_event, domain_event_type, format_url, line_match_email, links_href_targets, sections_heading,
        conditional_required_order, set_compare_keys, front_matter_lines, report_summary, fold_event_values, reconcile_order_status, clocks_of_users,
        precedence_event_value, coverage_of_documents, fk_list_parts, assertions_of_events, stale_orders, apply_orders, superseded_events, visible_customers,
        context_of_parts, increment_of_events, immutable_documents, scenes_of_orders, timeline_of_errors, unresolved_pages, blocking_documents,
    )
}

ORACLES = {
    "fk_orders_without_lines": "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "required_docs_without_label": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "unique_line_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "unique_located_text": "SELECT doc_id, first, n FROM (SELECT doc_id, min(doc_id) OVER w AS first, count(*) OVER w AS n FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY text)) WHERE n > 1",
    "first_wins_line": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r > 1",
    "chain_line_gaps": "SELECT * FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE l_linenumber <> previous + 1",
    "chain_turns_ok": "SELECT conv_id, count(*) AS turns, min(turn) AS first_turn, bool_and(p IS NULL OR turn = p + 1) AS unbroken FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) GROUP BY conv_id",
    "visible_purchase_before_signup": "SELECT event_id, user_id FROM events e WHERE event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND s.ts < e.ts)",
    "pointer_latest_event": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "domain_event_type": "SELECT event_id, event_type FROM events WHERE coalesce(event_type, '') NOT IN ('click', 'purchase', 'signup', 'view')",
    "format_url": "SELECT page_id, url FROM pages WHERE NOT regexp_full_match(coalesce(url, ''), 'http://[a-z0-9.-]+/[a-z]{2}/[0-9]+')",
    "line_match_email": "SELECT doc_id, line_no::INTEGER AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents) WHERE regexp_matches(line, '[a-z0-9.]+@[a-z0-9.]+')",
    "links_href_targets": """SELECT page_id, target, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS target FROM pages)
        WHERE target NOT IN (SELECT '/' || regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) FROM pages WHERE url IS NOT NULL) GROUP BY page_id, target""",
    "sections_heading": "SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading, len(regexp_extract_all(html, '<p>'))::BIGINT AS paragraphs FROM pages",
    "conditional_required_order": """SELECT * FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'P' THEN 'final_status' END,
        CASE WHEN o_totalprice >= 1000 AND o_orderpriority = '4-NOT SPECIFIED' THEN 'known_priority' END) AS missing FROM orders) WHERE missing <> ''""",
    "set_compare_keys": """WITH o AS (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'), c AS (SELECT c_custkey AS custkey FROM customer WHERE c_acctbal > 0)
        SELECT custkey, 'missing' AS side FROM o WHERE custkey NOT IN (SELECT custkey FROM c) UNION ALL SELECT custkey, 'unexpected' FROM c WHERE custkey NOT IN (SELECT custkey FROM o)""",
    "front_matter_lines": """SELECT event_id, trim(split_part(line, ':', 1)) AS key, trim(trim(substr(line, strpos(line, ':') + 1)), '"''') AS value FROM (SELECT event_id, regexp_replace(props, '[{}]', '', 'g') AS line FROM events)""",
}
ORACLES |= {
    "fold_event_values": """SELECT user_id AS target, max_by(event_id::VARCHAR, (ts, event_id)) AS value, NULL::DOUBLE AS quantity FROM events WHERE event_type = 'signup' GROUP BY user_id
        UNION ALL SELECT user_id, 'k', sum((props->>'$.k')::DOUBLE * CASE WHEN event_type = 'purchase' THEN 1 ELSE -1 END) FROM events WHERE event_type IN ('purchase', 'error') GROUP BY user_id""",
    "reconcile_order_status": """WITH o AS (SELECT o_orderkey, substr(o_orderpriority, 1, 1)::BIGINT AS n FROM orders), l AS (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT o_orderkey, o.n AS left_value, l.n AS right_value FROM o FULL JOIN l USING (o_orderkey) WHERE o.n IS DISTINCT FROM l.n""",
    "clocks_of_users": """SELECT event_id, user_id, least(r, 12) AS current, r >= 12 AS struck, CASE WHEN r = 12 THEN concat('lock ', user_id) END AS effect FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE event_type = 'error')""",
    "precedence_event_value": """SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END, event_id) AS r
        FROM events WHERE event_type IN ('purchase', 'signup', 'click')) WHERE r = 1""",
    "coverage_of_documents": """SELECT lang, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 1 THEN 'covered' ELSE 'immaterial' END AS status, count(*) AS n FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY ALL""",
}
_LATEST = "SELECT o_custkey AS target, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS value FROM orders GROUP BY o_custkey"
ORACLES |= {
    "fk_list_parts": "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)",
    "assertions_of_events": """SELECT event_id, expected FROM (SELECT event_id, event_type, coalesce(lag(event_type) OVER w, CASE WHEN user_id % 2 = 0 THEN 'click' END) AS expected FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE event_type IS DISTINCT FROM expected""",
    "stale_orders": "SELECT o_orderkey FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'",
    "apply_orders": f"""WITH l AS ({_LATEST}) SELECT target, value, 'applied' AS package FROM l UNION ALL SELECT c_custkey, c_mktsegment, 'applied' FROM customer WHERE c_custkey NOT IN (SELECT target FROM l)
        UNION ALL SELECT c_custkey, c_mktsegment, 'refused' FROM customer""",
    "superseded_events": "SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id",
    "visible_customers": "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT c_acctbal < 0",
    "context_of_parts": """WITH p AS (SELECT p_partkey AS id, p_type, CASE WHEN p_partkey <= 3 THEN 'always' WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) THEN 'resume'
        WHEN p_type IN (SELECT p_type FROM part WHERE p_partkey % 100 = 7) THEN 'relevant' END AS tier FROM part WHERE NOT starts_with(p_brand, 'Brand#1')) SELECT id, tier FROM p WHERE tier IS NOT NULL""",
    "increment_of_events": "SELECT event_id, event_type FROM events WHERE event_type IS DISTINCT FROM 'view'",
    "immutable_documents": """SELECT id, status FROM (SELECT d.doc_id AS id, text, CASE WHEN quality = 1 THEN 'closed' ELSE 'open' END AS status,
        CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.doc_id % 5 = 0 THEN text || ' more' WHEN d.doc_id % 5 = 1 THEN 'less' ELSE text END AS now FROM documents d JOIN labels l USING (doc_id))
        WHERE CASE WHEN status = 'open' THEN NOT coalesce(starts_with(now, text), FALSE) ELSE NOT coalesce(now = text, FALSE) END""",
    "scenes_of_orders": "SELECT o_orderkey, 'next_scene_id' AS missing FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0",
    "timeline_of_errors": "SELECT ts, event_id, user_id FROM events WHERE event_type = 'error'",
    "unresolved_pages": """WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS source FROM pages) SELECT page_id FROM p
        WHERE source IN ('', 'example.com') OR source NOT IN (SELECT source FROM p WHERE page_id % 10 = 0)""",
    "blocking_documents": """SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'rejected' END AS status FROM documents LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR toxic = 1""",
}
ORACLES["report_summary"] = " UNION ALL ".join(f"SELECT '{f.__name__}' AS rule, count(*) AS violations FROM ({ORACLES[f.__name__]})" for f in PARTS)
