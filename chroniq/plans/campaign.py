"""The rule catalogue over a corpus of campaign documents: one table of violations, a report and an exit status.

Rules are named by severity and number. The checks are those of ``chroniq.operators.checks``. Each reads the shared parsed tables
and unions its rules; those of one record list are evaluated in one pass over it. What depends on other documents comes by joins: references are known at a
checkpoint if the corpus holds them and no checkpoint introduces them, or if an earlier one does. A corpus may hold many campaigns, each
below a root of its own; all that is said of one is said by root, and no root's documents have to fit a task.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.functions import parse as P
from chroniq.functions import text as T
from chroniq.operators import checks as C
from chroniq.operators import ordered as O
from chroniq.operators import state as S
from chroniq.plans import contract as K
from chroniq.sources.corpus import Corpus, Documents
from chroniq.sources.stored import Scratch

COLUMNS = ["rule", "severity", "path", "line_no", "item_no", "detail", "check_no"]
#: The lists of a checkpoint: the indentation of their items. Events lie in ``journal_append``.
LISTS = {"events": 4, "changes": 2, "resource_changes": 2, "new_facts": 2, "open_thread_changes": 2, "knowledge_changes": 2}
PLACES = {name: ("journal_append", name) if name == "events" else (name,) for name in LISTS}
#: The root of a corpus of one campaign.
ONE_ROOT = r"\A"


def rule(name: str, when: Column, detail: Column | str = "") -> Column:
    """A rule's struct where it is broken."""
    d = F.lit(detail) if isinstance(detail, str) else F.coalesce(detail, F.lit(""))
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(name).alias("rule"), d.alias("detail")))


def emit(df: DataFrame, check: int, *rules: Column, path: Column | str = "path", line: Column | None = None, item: Column | None = None) -> DataFrame:
    """A violation for each rule that a row breaks."""
    none = F.lit(None).cast("int")
    broken = F.explode(F.filter(F.array(*rules), lambda r: r.isNotNull())).alias("r")
    rows = df.select(T.col(path).alias("path"), (none if line is None else line.cast("int")).alias("line_no"), (none if item is None else item.cast("int")).alias("item_no"), broken)
    return rows.select("r.rule", F.when(F.col("r.rule").startswith("W"), "warning").otherwise("error").alias("severity"), "path", "line_no", "item_no", "r.detail", F.lit(check).alias("check_no"))


def val(key: str) -> Column:
    """A record's value, empty if the key is missing."""
    return F.coalesce(F.element_at("fields", F.lit(key)), F.lit(""))


def sound(c: str) -> Column:
    """Whether a checkpoint's id is one."""
    return F.coalesce(T.full_match(c, K.CHECKPOINT), F.lit(False))


def has(key: str) -> Column:
    return F.map_contains_key("fields", F.lit(key))


def listed(a: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(a)), ", ")


def wide(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus: never broadcast, however small its compressed file makes it look."""
    return df.hint("merge")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class Campaign:
    """All checks of one corpus.

    ``roots`` is the pattern of the folders, each ending in a slash, that hold a campaign; for a corpus of one campaign its own. Documents
    outside any root are checked for their encoding only. What several rules read is stored in the shared folder until ``release``.
    """

    def __init__(self, corpus: Documents, roots: str = ONE_ROOT):
        self.spark, self.corpus, self.roots = corpus.spark, corpus, roots
        self.scratch = Scratch(corpus.spark)

    def release(self, *but: DataFrame) -> None:
        """Delete what is stored; call once the results are."""
        self.scratch.drop(*but)

    def below(self, df: DataFrame) -> DataFrame:
        """With ``root`` and ``rel``, the path below it, of the rows below a root."""
        root = F.regexp_extract("path", self.roots, 0)
        return df.filter(F.col("path").rlike(self.roots)).withColumn("root", root).withColumn("rel", F.expr("substring(path, length(root) + 1)"))

    @property
    def all_roots(self) -> DataFrame:
        if self.roots == ONE_ROOT:
            return self.spark.range(1).select(F.lit("").alias("root"))
        return self.below(self.corpus.paths).select("root").distinct()

    @property
    def docs(self) -> DataFrame:
        """root, rel, path, text of the readable documents."""
        return self.below(self.corpus.documents).select("root", "rel", "path", "text")

    @property
    def files(self) -> DataFrame:
        return self.corpus.inventory.filter("kind = 'file'").select("path")

    # ------------------------------------------------------------ structure

    def wanted(self, roots: DataFrame, values: tuple[str, ...], name: str = "rel") -> DataFrame:
        """root, n, value: fixed values at each root."""
        return roots.select("root", F.posexplode(F.array(*[F.lit(v) for v in values])).alias("n", name))

    def encoding(self) -> DataFrame:
        return emit(self.corpus.decoded, 2, rule("E180", F.col("text").isNull()), rule("E183", F.col("text").contains("\r")))

    def required_files(self) -> DataFrame:
        want = self.wanted(self.all_roots, K.REQUIRED_FILES).withColumn("path", F.concat("root", "rel"))
        return emit(C.required_set(want, wide(self.files), ["path"]), 0, rule("E191", F.lit(True)), item=F.col("n"))

    def reset_list(self) -> DataFrame:
        lists = self.below(self.corpus.named(K.RESET_LIST)).filter(F.col("rel") == K.RESET_LIST)
        sound = F.is_valid_utf8(F.col("content").cast("string"))
        lines = lists.filter(sound).select("root", F.posexplode(T.lines(F.col("content").cast("string"))).alias("pos", "line"))
        rows = lines.select("root", "pos", T.strip("line").alias("item")).filter("item <> '' and not startswith(item, '#')")
        again = C.unique(rows, ["root", "item"]).groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        sides = C.set_compare(wide(self.wanted(lists.filter(sound), K.RESET_PATHS, "item")), wide(rows), "item", ("root",)).groupBy("root", "side").agg(listed(F.collect_list("item")).alias("text"))
        unsafe = F.col("item").startswith("/") | F.col("item").isin(".", "..") | F.array_contains(F.split("item", "/"), "..")
        place = F.concat("root", F.lit("templates/"), T.folded(F.col("item")))
        safe = C.required_set(rows.filter(~unsafe).withColumn("path", place), wide(self.corpus.inventory), ["path"])
        at = F.concat("root", F.lit(K.RESET_LIST))
        return union([
            emit(lists, 1, rule("E202", ~sound), path=at), emit(again, 1, rule("E211", F.col("n") > 0), path=at),
            emit(sides, 1, rule("E228", F.col("side") == "missing", F.col("text")), rule("E233", F.col("side") == "unexpected", F.col("text")), path=at),
            emit(rows, 1, rule("E244", unsafe, F.col("item")), path=at, item=F.col("pos")),
            emit(safe, 1, rule("E249", F.lit(True), F.col("item")), path=at, item=F.col("pos")),
        ])

    # ------------------------------------------------------------ entities

    @cached_property
    def fronts(self) -> DataFrame:
        return self.docs.withColumn("entries", P.front_matter("text"))

    def entity_templates(self) -> DataFrame:
        d = self.fronts.filter(F.col("rel").isin(*K.ENTITY_TEMPLATES)).withColumn("missing", C.lacking(*[(k, ~P.has("entries", k)) for k in K.ENTITY_KEYS]))
        return emit(d, 3, rule("E812", F.col("entries").isNull()), rule("E816", F.col("entries").isNotNull() & (F.size("missing") > 0), listed(F.col("missing"))))

    def entity_checkpoints(self) -> DataFrame:
        v = P.get("entries", "last_updated")
        d = self.fronts.filter(F.col("rel").rlike(rf"\A(?:{K.ENTITY_FILES})\z") & F.col("entries").isNotNull())
        return emit(d, 4, rule("E840", v.isNotNull() & C.misformed(v, K.CHECKPOINT), v))

    # ------------------------------------------------------------ the pointer

    @cached_property
    def current(self) -> DataFrame:
        """CURRENT.md of each root and, if it is complete, what it points at."""
        d = self.fronts.filter(F.col("rel") == "CURRENT.md").withColumn("missing", C.lacking(*[(k, ~P.has("entries", k)) for k in K.CURRENT_KEYS]))
        for key, name in (("checkpoint_id", "cp"), ("active_scene_id", "scene"), ("active_journal_id", "journal"), ("campaign_status", "status")):
            d = d.withColumn(name, P.get("entries", key))
        d = d.withColumn("cp_path", F.concat("root", F.lit("checkpoints/"), "cp", F.lit(".yaml")))
        return d.withColumn("journal_path", F.concat("root", F.lit("journal/entry-"), F.element_at(F.split("journal", "-"), -1), F.lit(".md")))

    def continuity(self) -> DataFrame:
        files = self.files.select(F.col("path").alias("cp_path"), F.lit(True).alias("cp_there"))
        journal = self.fronts.select(F.col("path").alias("journal_path"), F.col("text").alias("jtext"), F.col("entries").alias("jentries"))
        d = self.current.join(wide(files), "cp_path", "left").join(wide(journal), "journal_path", "left")
        there = F.col("entries").isNotNull()
        whole = there & (F.size("missing") == 0)
        preparing, active = whole & (F.col("status") == "preparation"), whole & (F.col("status") != "preparation")
        named = active & T.full_match("journal", K.JOURNAL)
        found = named & F.col("jtext").isNotNull()
        parsed = found & F.col("jentries").isNotNull()
        jget = lambda k: P.get("jentries", k)
        pointers = [rule("E881", preparing & ~F.col(c).isin(*K.NULLS), k) for k, c in (("checkpoint_id", "cp"), ("active_scene_id", "scene"), ("active_journal_id", "journal"))]
        own = emit(
            d, 5, rule("E855", ~there), rule("E867", there & (F.size("missing") > 0), listed(F.col("missing"))), *pointers,
            rule("E888", active & C.misformed(F.col("cp"), K.CHECKPOINT), F.col("cp")), rule("E892", active & C.misformed(F.col("scene"), K.SCENE), F.col("scene")),
            rule("E897", active & C.misformed(F.col("journal"), K.JOURNAL), F.col("journal")), rule("E905", named & F.col("cp_there").isNull(), F.col("cp_path")),
            rule("E915", named & F.col("jtext").isNull(), F.col("journal_path")),
        )
        its = emit(
            d, 5, rule("E922", found & F.col("jentries").isNull()), rule("E925", parsed & ~jget("id").eqNullSafe(F.col("journal"))),
            rule("E929", parsed & ~jget("status").eqNullSafe(F.lit("open"))), rule("E933", parsed & ~jget("last_checkpoint").eqNullSafe(F.col("cp")), F.col("cp")),
            rule("E937", parsed & ~F.col("jtext").contains(F.col("scene")), F.col("scene")), path="journal_path",
        )
        return own.unionByName(its)

    # ------------------------------------------------------------ checkpoints

    @cached_property
    def states(self) -> DataFrame:
        """root, preparing and the number of checkpoint files."""
        preparing = self.current.filter("entries is not null and status = 'preparation'").select("root", F.lit(True).alias("preparing"))
        count = self.below(self.files).filter(F.col("rel").rlike(K.CHECKPOINT_FILES)).groupBy("root").agg(F.count(F.lit(1)).alias("checkpoints"))
        d = self.all_roots.join(wide(preparing), "root", "left").join(wide(count), "root", "left")
        d = d.select("root", F.coalesce("preparing", F.lit(False)).alias("preparing"), F.coalesce("checkpoints", F.lit(0).cast("long")).alias("checkpoints"))
        return self.scratch.store(d, "states")

    def presence(self) -> DataFrame:
        """Campaigns that are active without checkpoints, or in preparation with some."""
        some = F.col("checkpoints") > 0
        return emit(self.states, 6, rule("E957", ~F.col("preparing") & ~some), rule("E960", F.col("preparing") & some), path=F.concat("root", F.lit("checkpoints/")))

    @property
    def live(self) -> DataFrame:
        """The roots of campaigns whose checkpoints are looked into."""
        return self.states.filter("not preparing and checkpoints > 0").select("root")

    @property
    def texts(self) -> DataFrame:
        """root, path, text of the readable checkpoints of active campaigns."""
        d = self.docs.filter(F.col("rel").rlike(K.CHECKPOINT_FILES)).join(self.live, "root", "left_semi")
        return d.select("root", "path", "text")

    @cached_property
    def checkpoints(self) -> DataFrame:
        """A row for each readable checkpoint of an active campaign: its header, and what rules on whole payloads need."""
        counted = {name: indent for name, indent in LISTS.items() if name in ("events", "changes", "resource_changes")}
        places = {name: ((name,), 2, "[a-zA-Z0-9_]") for name in ("continuity", "current_scene", "journal_append")} | {name: (PLACES[name], n, "-") for name, n in counted.items()}
        d = P.parted(self.texts, ["root", "path"], "text", places)
        d = d.withColumns({name: P.get("header", k) for k, name in (("checkpoint_id", "id"), ("kind", "kind"), ("schema", "schema"), ("base_checkpoint_id", "base"))})
        d = d.withColumn("id", F.coalesce("id", F.lit(""))).withColumn("sound", sound("id")).withColumn("d", T.digits(F.substring("id", 4, 2**31 - 1)))
        raw = [P.raw_items(F.col(name), indent).alias(f"raw_{name}") for name, indent in counted.items()]
        d = d.select(
            "root", "path", "header", "id", "sound", "kind", "schema", F.when(~F.col("base").isin("null", "~"), F.col("base")).alias("base"), F.when(F.col("sound"), F.expr("try_cast(d as int)")).alias("number"),
            P.scalar_of(F.col("continuity"), "journal_entry_id").alias("journal"), P.scalar_of(F.col("continuity"), "scene_id").alias("scene"), P.mapping_keys(F.col("current_scene"), 2).alias("scene_keys"),
            F.array_contains(P.mapping_keys(F.col("journal_append"), 2), "events").alias("has_events"), *raw,
        )
        return self.scratch.store(d, "checkpoints")

    @cached_property
    def records(self) -> DataFrame:
        """root, path, sound, kind, section, idx, fields of every record of every list, parsed in one pass and stored in the order of sections."""
        d = P.record_lists(self.texts, ["root", "path"], "text", {name: (PLACES[name], indent) for name, indent in LISTS.items()}, ["checkpoint_id", "kind"])
        d = d.select("root", "path", sound("checkpoint_id").alias("sound"), "kind", "section", "idx", "fields")
        return self.scratch.store(d.sortWithinPartitions("section"), "records")  # row groups of one section each, about

    def section(self, name: str) -> DataFrame:
        return self.records.filter(F.col("section") == name).drop("section")

    @cached_property
    def events(self) -> DataFrame:
        d = self.section("events").withColumn("id", val("id")).withColumn("good", T.full_match("id", K.EVENT))
        return d.withColumn("again", F.col("good") & (C.nth(["path"], "id", ["idx"]) > 1))

    @cached_property
    def facts(self) -> DataFrame:
        d = self.section("new_facts").withColumn("id", val("id")).withColumn("good", T.full_match("id", K.ID))
        return d.withColumn("nth", C.nth(["path"], "id", ["idx"]))

    @cached_property
    def threads(self) -> DataFrame:
        d = self.section("open_thread_changes").withColumn("id", val("thread_id")).withColumn("op", val("operation"))
        first_add = F.min(F.when(F.col("op") == "add", F.col("idx"))).over(W.partitionBy("path", "id"))
        return d.withColumn("added_before", F.coalesce(first_add < F.col("idx"), F.lit(False)) & (F.col("id") != ""))

    @cached_property
    def knowledge(self) -> DataFrame:
        return self.section("knowledge_changes")

    @cached_property
    def changes(self) -> DataFrame:
        return self.section("changes")

    @cached_property
    def resources(self) -> DataFrame:
        return self.section("resource_changes")

    @cached_property
    def introductions(self) -> DataFrame:
        """root, path, sound, ref of each fact and each added thread."""
        f = self.section("new_facts").select("root", "path", "sound", val("id").alias("ref"))
        t = self.section("open_thread_changes").filter(val("operation") == "add").select("root", "path", "sound", val("thread_id").alias("ref"))
        return f.unionByName(t).filter("ref <> ''")

    def values_of(self, key: str) -> Column:
        """The values listed at ``key`` (an inline list is one value; empty and ``[]`` are none)."""
        return F.filter(T.lines(val(key)), lambda x: (x != "") & (x != "[]"))

    def lines_of(self, d: DataFrame, key: str) -> DataFrame:
        return d.select("root", "path", F.explode(self.values_of(key)).alias("ref"))

    @cached_property
    def known(self) -> DataFrame:
        """path, ref for each reference that a checkpoint names and that is known when it is applied: checkpoints are applied by path."""
        own = lambda name, key: self.section(name).select("root", "path", val(key).alias("ref"))
        asked = union([own("new_facts", "id"), own("open_thread_changes", "thread_id"), own("knowledge_changes", "knowledge_ref"),
                       self.lines_of(self.section("open_thread_changes"), "related_facts"), self.lines_of(self.section("events"), "knowledge_refs")]).distinct()
        outside = self.docs.filter(~F.array_contains(F.split("rel", "/"), "checkpoints"))
        held = outside.select("root", F.explode(F.regexp_extract_all("text", F.lit(K.REFERENCE), 1)).alias("ref")).distinct()
        original = C.required_set(held, wide(self.introductions), ["root", "ref"]).withColumn("original", F.lit(True))
        d = C.introduced(asked.join(wide(original), ["root", "ref"], "left"), wide(self.introductions.filter("sound")), ["root", "ref"], "path")
        return self.scratch.store(d.filter("original or introduced < path").select("path", "ref"), "known")

    @cached_property
    def available(self) -> DataFrame:
        """path, ref: known, or a sound fact or an added thread of the checkpoint itself."""
        f = self.section("new_facts").select("path", val("id").alias("ref")).filter(T.full_match("ref", K.ID))
        t = self.section("open_thread_changes").filter(val("operation") == "add").select("path", val("thread_id").alias("ref")).filter("ref <> ''")
        return self.known.unionByName(f).unionByName(t).distinct()

    def _stray(self, name: str, d: DataFrame) -> DataFrame:
        """A violation for each record that names a source event that is no sound event of the same document."""
        named = d.withColumn("source", F.when(val("source_event") != "", val("source_event")))
        good = self.section("events").select("path", val("id").alias("id")).filter(T.full_match("id", K.EVENT))
        gone = C.foreign_key(named, wide(good), [("path", "path"), ("source", "id")])
        return emit(gone, 6, rule(name, F.lit(True), F.col("source")), item=F.col("idx"))

    def _flag(self, d: DataFrame, refs: DataFrame, column: str, flag: str) -> DataFrame:
        return d.join(wide(refs.select("path", F.col("ref").alias(column), F.lit(True).alias(flag))), ["path", column], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))

    def chain(self) -> DataFrame:
        if not self.live.limit(1).count():  # no checkpoint to look into
            return self.presence()
        return union([self.presence(), self.chain_rules(), *self.payload()])

    @cached_property
    def linked(self) -> DataFrame:
        """The sound checkpoints of each root with the one before, by number and path, in the corpus's order of all."""
        c = self.checkpoints.filter("sound").select("root", "number", "path", "id", "base", "journal", "scene")
        d = O.neighbours(c, ["root", "number", "path"], ["root", "number", "id"], self.scratch)
        same = F.col("previous_root").eqNullSafe(F.col("root"))
        return d.select(*c.columns, F.when(same, F.col("previous_id")).alias("previous_id"), F.when(same, F.col("previous_number")).alias("previous"))

    def chain_rules(self) -> DataFrame:
        """What holds between an active campaign's checkpoints, and its pointer."""
        c = self.checkpoints
        sound = c.filter("sound").withColumn("before", F.lag("path").over(W.partitionBy("root", "id").orderBy("path")))
        own = emit(
            sound, 6, rule("E1015", F.element_at(F.split("path", "/"), -1) != F.concat("id", F.lit(".yaml")), F.col("id")),
            rule("E1019", F.col("before").isNotNull(), F.concat_ws(", ", "id", "before")), rule("E1025", ~F.col("schema").eqNullSafe(F.lit(K.SCHEMA))),
            rule("E1031", (F.col("id") == "cp-0001") & ~F.col("kind").eqNullSafe(F.lit("baseline"))), rule("E1035", (F.col("id") != "cp-0001") & ~F.col("kind").eqNullSafe(F.lit("delta"))),
        )
        linked = self.linked
        head, later = F.col("previous_id").isNull(), F.col("previous_id").isNotNull()
        links = emit(
            linked, 6, rule("E1061", head & ((F.col("id") != "cp-0001") | F.col("base").isNotNull())), rule("E1068", later & (F.col("number") != F.col("previous") + 1), F.col("previous_id")),
            rule("E1072", later & ~F.col("base").eqNullSafe(F.col("previous_id")), F.col("previous_id")),
        )
        latest = C.pointer(linked, "root", ["number", "path"], ["id", "journal", "scene"]).withColumnsRenamed({"journal": "j", "scene": "s"})
        pointed = latest.join(wide(self.current.filter("entries is not null").select("root", "cp", "scene", "journal")), "root")
        end = emit(pointed, 6, rule("E1079", ~F.col("cp").eqNullSafe(F.col("id")), F.col("id")), path=F.concat("root", F.lit("CURRENT.md")))
        its = emit(pointed, 6, rule("E1088", ~F.col("j").eqNullSafe(F.col("journal"))), rule("E1093", ~F.col("s").eqNullSafe(F.col("scene"))), path=F.concat("root", F.lit("checkpoints/"), "id", F.lit(".yaml")))
        return union([emit(c, 6, rule("E1010", ~F.col("sound"), F.col("id"))), own, links, end, its])

    # ------------------------------------------------------------ payloads of deltas

    def payload(self) -> list[DataFrame]:
        delta = "sound and kind = 'delta'"
        return [f(delta) for f in (self.payload_documents, self._event_rules, self._change_rules, self._resource_rules, self._fact_rules, self._thread_rules, self._knowledge_rules, self._reference_rules)]

    def payload_documents(self, delta: str) -> DataFrame:
        """Required keys, and lists whose items are not all records."""
        c = self.checkpoints.filter(delta).withColumn("scene_missing", C.lacking(*[(k, ~F.array_contains("scene_keys", k)) for k in K.SCENE_KEYS]))
        names = ("events", "changes", "resource_changes")
        counts = self.records.filter(F.col("section").isin(*names)).groupBy("path").agg(*[F.count(F.when(F.col("section") == n, 1)).alias(f"n_{n}") for n in names])
        odd = lambda n: F.col(f"raw_{n}") != F.coalesce(f"n_{n}", F.lit(0))
        return emit(
            c.join(wide(counts), "path", "left"), 6, rule("E412", F.size("scene_missing") > 0, listed(F.col("scene_missing"))), rule("E420", ~F.col("has_events")),
            rule("E429", odd("events")), rule("E494", odd("changes")), rule("E534", odd("resource_changes")),
        )

    def _event_rules(self, delta: str) -> DataFrame:
        speaker, to, talk = val("speaker"), val("recipients"), val("type") == "dialogue"
        inline = to.startswith("[") & to.endswith("]") & (to != "[]")
        lacking = C.lacking(("speaker", talk & (speaker == "")), ("recipients", talk & ~to.startswith("\n") & ~inline))
        return emit(
            self.events.filter(delta), 6, rule("E438", ~F.col("good"), F.col("id")), rule("E443", F.col("again"), F.col("id")), rule("E449", val("summary") == ""),
            rule("E455", C.outside(val("type"), K.EVENT_TYPES), val("type")), rule("E460", val("fiction_time") == ""), rule("E470", talk & (speaker != "") & C.misformed(speaker, K.ID), speaker),
            rule("E483", F.size(lacking) > 0, listed(lacking)), item=F.col("idx"),
        )

    def _change_rules(self, delta: str) -> DataFrame:
        op = val("operation")
        lacking = C.lacking(*[(k, val(k) == "") for k in K.CHANGE_FIELDS], *[(k, op.isin("set", "move") & ~has(k)) for k in ("from", "to")], ("value", op.isin("add", "remove") & ~has("value")))
        own = emit(
            self.changes.filter(delta), 6, rule("E505", C.outside(op, K.CHANGE_OPERATIONS), op), rule("E516", F.size(lacking) > 0, listed(lacking)), item=F.col("idx"),
        )
        return own.unionByName(self._stray("E523", self.changes.filter(delta)))

    def _resource_rules(self, delta: str) -> DataFrame:
        op, good = val("operation"), T.full_match(F.col("id"), K.ID)
        d = self.resources.filter(delta).withColumn("id", val("id"))
        d = d.withColumn("nth", C.nth(["path"], "id", ["idx"]))
        lacking = C.lacking(*[(k, ~has(k)) for k in K.RESOURCE_FIELDS if k != "name"], ("name", val("name") == ""))
        pairs = [rule(r, (op == which) & val(k).isin(*K.NULLS), k) for r, which, keys in (("E593", "transfer", ("holder_before", "holder_after")), ("E600", "consume", ("quantity_before", "quantity_after"))) for k in keys]
        own = emit(
            d, 6, rule("E570", ~good, F.col("id")), rule("E575", good & (F.col("nth") > 1), F.col("id")), rule("E584", C.outside(op, K.RESOURCE_OPERATIONS), op), *pairs,
            rule("E605", F.size(lacking) > 0, listed(lacking)), item=F.col("idx"),
        )
        return own.unionByName(self._stray("E611", self.resources.filter(delta)))

    def _fact_rules(self, delta: str) -> DataFrame:
        d = self._flag(self.facts.filter(delta), self.known, "id", "is_known")
        lacking = C.lacking(*[(k, val(k) == "") for k in K.FACT_FIELDS])
        own = emit(
            d, 6, rule("E638", (F.col("id") != "") & (~F.col("good") | (F.col("nth") > 1) | F.col("is_known")), F.col("id")), rule("E645", C.outside(val("kind"), K.FACT_KINDS), val("kind")),
            rule("E650", C.outside(val("truth_status"), K.TRUTH), val("truth_status")), rule("E655", F.size(lacking) > 0, listed(lacking)), item=F.col("idx"),
        )
        return own.unionByName(self._stray("E661", self.facts.filter(delta)))

    def _thread_rules(self, delta: str) -> DataFrame:
        d = self._flag(self.threads.filter(delta), self.known, "id", "is_known")
        op, there = F.col("op"), F.col("is_known") | F.col("added_before")
        lacking = C.lacking(*[(k, val(k) == "") for k in K.THREAD_FIELDS], *[(k, (op == "add") & (val(k) == "")) for k in K.THREAD_ADD], ("note", (op == "update") & (val("note") == "")), ("resolution", (op == "close") & (val("resolution") == "")))
        own = emit(
            d, 6, rule("E680", C.outside(op, K.THREAD_OPERATIONS), op), rule("E685", C.misformed(F.col("id"), K.ID), F.col("id")), rule("E696", (op == "add") & there, F.col("id")),
            rule("E705", (op == "update") & ~there, F.col("id")), rule("E712", (op == "close") & ~there, F.col("id")), rule("E716", F.size(lacking) > 0, listed(lacking)), item=F.col("idx"),
        )
        return own.unionByName(self._stray("E722", self.threads.filter(delta)))

    def _knowledge_rules(self, delta: str) -> DataFrame:
        d = self._flag(self.knowledge.filter(delta).withColumn("ref", val("knowledge_ref")), self.available, "ref", "is_there")
        lacking, subject, op = C.lacking(*[(k, val(k) == "") for k in K.KNOWLEDGE_FIELDS]), val("subject"), val("operation")
        own = emit(
            d, 6, rule("E759", C.outside(op, K.KNOWLEDGE_OPERATIONS), op), rule("E765", (subject != "party") & C.misformed(subject, K.ID), subject),
            rule("E771", (F.col("ref") != "") & ~F.col("is_there"), F.col("ref")), rule("E776", F.size(lacking) > 0, listed(lacking)), item=F.col("idx"),
        )
        return own.unionByName(self._stray("E782", self.knowledge.filter(delta)))

    def _reference_rules(self, delta: str) -> DataFrame:
        parts = []
        for name, d, key in (("E737", self.threads, "related_facts"), ("E794", self.events, "knowledge_refs")):
            strange = C.foreign_key_list(d.filter(delta).withColumn("refs", self.values_of(key)).select("path", "idx", "refs"), "refs", wide(self.available), "ref", ("path",))
            parts.append(emit(strange, 6, rule(name, F.lit(True), F.col("value")), item=F.col("idx")))
        return union(parts)

    # ------------------------------------------------------------ all documents

    @property
    def lines(self) -> DataFrame:
        """root, rel, path, line_no (from 1), line."""
        return self.docs.select("root", "rel", "path", F.posexplode(T.lines("text")).alias("_p", "line")).select("root", "rel", "path", (F.col("_p") + 1).alias("line_no"), "line")

    @cached_property
    def id_lines(self) -> DataFrame:
        d = self.lines.filter(F.col("line").rlike(K.ID_LINE))
        return d.select("root", "path", "line_no", T.normalized_id(F.regexp_extract("line", K.ID_LINE, 1)).alias("id"))

    def ids(self) -> DataFrame:
        d = self.id_lines
        own = emit(d, 7, rule("E1150", F.col("id") == ""), rule("E1153", (F.col("id") != "") & C.misformed(F.col("id"), K.ID), F.col("id")), line=F.col("line_no"))
        at = F.struct(F.split("path", "/").alias("parts"), "line_no", "path", "id")
        again = C.unique_located(wide(d.filter("id <> ''").withColumn("at", at)), F.concat_ws("\n", "root", "id"), "at").filter("at = first")
        return own.unionByName(emit(again, 7, rule("E1161", F.lit(True), F.col("at.id")), path=F.col("at.path"), line=F.col("at.line_no"), item=F.col("n")))

    def located_ids(self) -> DataFrame:
        """id, path, line_no of each id that occurs more than once in its campaign."""
        again = C.unique(self.id_lines.filter("id <> ''"), ["root", "id"])
        return self.id_lines.join(wide(again), ["root", "id"], "left_semi").select("id", "path", "line_no")

    def links(self) -> DataFrame:
        md = self.lines.filter(F.lower("path").endswith(".md"))
        d = md.select("root", "rel", "path", "line_no", F.explode(F.regexp_extract_all("line", F.lit(K.LINK), 1)).alias("raw")).withColumn("target", T.link_target("raw"))
        blank = T.strip("raw") == ""
        local = d.filter(blank | ((F.col("target") != "") & ~F.col("target").rlike(r"\A(?:https?://|mailto:|data:)")))
        folder = F.regexp_extract("rel", r"\A(.*/)[^/]*\z", 1)
        place = F.when(blank, F.lit(None)).when(F.col("target").startswith("/"), T.folded(F.col("target"))).otherwise(T.folded(F.concat(folder, "target")))
        named = local.withColumn("below", place).filter("below is null or below <> ''").withColumn("place", F.concat("root", "below"))
        gone = C.required_set(named, wide(self.corpus.inventory.select(F.col("path").alias("place"))), ["place"])
        return emit(gone, 8, rule("E1197", F.lit(True), F.col("target")), line=F.col("line_no"))

    def required_sections(self) -> DataFrame:
        want = self.spark.createDataFrame([(p, n, i) for p, ns in K.SECTIONS.items() for i, n in enumerate(ns)], "rel string, name string, n int")
        have = P.sections(self.lines.filter(F.col("rel").isin(*K.SECTIONS)))
        d = self.docs.select("rel", "path").join(F.broadcast(want), "rel").join(wide(have), ["path", "name"], "left")
        return emit(d, 9, rule("E1245", F.col("meaningful").isNull(), F.col("name")), rule("W1247", ~F.col("meaningful"), F.col("name")), item=F.col("n"))

    def legacy_words(self) -> DataFrame:
        d = self.docs.filter(F.lower("path").endswith(".md") & (F.col("rel") != K.LEGACY_EXEMPT))
        return emit(C.line_match(d, "path", "text", K.LEGACY, T.lines("text")), 10, rule("E1110", F.lit(True)), line=F.col("line_no"))

    def guide_terms(self) -> DataFrame:
        d = self.docs.filter(F.col("rel") == K.GUIDE)
        return emit(d, 11, *[rule("E1126", ~F.col("text").contains(t), t) for t in K.GUIDE_TERMS])

    def headings(self) -> DataFrame:
        top = F.exists(T.lines("text"), lambda x: x.rlike(r"(?U)\A#\s+\S"))
        return emit(self.docs.filter(F.lower("path").endswith(".md")), 12, rule("W1255", ~top))

    # ------------------------------------------------------------ the result

    def violations(self) -> DataFrame:
        """All violations: rule, severity, path, line_no, item_no, detail, check_no."""
        self.corpus.hold(self.scratch)  # every check reads the documents
        checks = (self.required_files, self.reset_list, self.encoding, self.entity_templates, self.entity_checkpoints, self.continuity, self.chain, self.ids, self.links, self.required_sections, self.legacy_words, self.guide_terms, self.headings)
        return union([c() for c in checks])

    def audit(self, before: Campaign | None = None) -> DataFrame:
        """The read-only continuity audit: pointer, chain, entities' checkpoints and legacy wording.

        With the corpus as it was ``before``, also the journal entries that were closed then and differ or are gone, or that
        were open and did not only grow, as rule ``immutable``.
        """
        parts = [self.entity_checkpoints(), self.continuity(), self.chain(), self.legacy_words()]
        if before is not None:
            entries = lambda c: c.fronts.filter(F.col("rel").rlike(K.JOURNAL_FILES) & F.col("entries").isNotNull()).select(F.col("path").alias("id"), P.get("entries", "status").alias("status"), "text")
            # what follows the front matter is the entry: its front matter says when it was closed
            body = lambda d: d.withColumn("text", F.regexp_replace("text", r"\A---\n(?s:.*?)\n---\n", ""))
            parts.append(emit(S.broken_immutability(body(entries(before)), wide(body(entries(self)))), 13, rule("immutable", F.lit(True), F.col("status")), path="id"))
        return union(parts)


def in_order(violations: DataFrame) -> DataFrame:
    """By check, then by path component, line and item."""
    return violations.orderBy("check_no", F.split("path", "/"), "line_no", "item_no", "rule", "detail")


def summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("violations"))


def cube(violations: DataFrame) -> DataFrame:
    """Violations by severity, rule and the number of folders above, with the totals of each level: severity, rule, depth, level, violations.

    ``level`` is 0 for the finest rows, 1 without the depth, 3 without the rule, 7 for the total. One pass expands a row to the four.
    """
    depth = (F.size(F.split("path", "/")) - 1).alias("depth")
    return violations.select("severity", "rule", depth).rollup("severity", "rule", "depth").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("violations"))


def statuses(campaign: Campaign, violations: DataFrame) -> DataFrame:
    """root, errors, warnings and the exit status of each campaign of a corpus, 0 also where nothing is violated."""
    n = lambda s: F.count(F.when(F.col("severity") == s, 1)).alias(f"{s}s")
    found = campaign.below(violations).groupBy("root").agg(n("error"), n("warning"))
    d = campaign.all_roots.join(wide(found), "root", "left").select("root", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("errors", "warnings")])
    return d.withColumn("status", F.when(F.col("errors") > 0, 1).otherwise(0))


def report_lines(violations: DataFrame, scratch: Scratch) -> DataFrame:
    """The report's rows with their number in its order, of which no task sees the whole."""
    keyed = violations.withColumn("_parts", F.split("path", "/"))
    return O.numbered(keyed, ["check_no", "_parts", "line_no", "item_no", "rule", "detail"], "n", scratch).drop("_parts")


def exit_status(violations: DataFrame) -> int:
    """1 if there is any error; warnings never count."""
    return int(bool(violations.filter("severity = 'error'").limit(1).count()))


def render(violations: DataFrame, scanned: int, most: int = 10_000) -> str:
    """The printed report: a line for each of the first ``most`` violations, and the totals of all. ``write_report`` writes all."""
    rows = in_order(violations).limit(most).collect()
    totals = {r.severity: r["count"] for r in violations.groupBy("severity").count().collect()}
    n_errors, n_warnings = totals.get("error", 0), totals.get("warning", 0)
    say = lambda r: f"{r.path}" + f":{r.line_no}" * (r.line_no is not None) + f": {r.rule}" + f" [{r.item_no}]" * (r.item_no is not None) + f" {r.detail}" * bool(r.detail)
    errors, warnings = ([say(r) for r in rows if r.severity == s] for s in ("error", "warning"))
    out = [f"Text files checked: {scanned}"]
    out += ["", "Errors:", *(f"  [ERROR] {x}" for x in errors)] if errors else []
    out += ["", "Warnings:", *(f"  [WARN] {x}" for x in warnings)] if warnings else []
    out += ["", f"and {n_errors + n_warnings - len(rows)} more"] if n_errors + n_warnings > len(rows) else []
    out += [] if n_errors else ["", "OK: no errors" + (" and no warnings." if not n_warnings else "; warnings don't change the exit status.")]
    return "\n".join([*out, "", f"Total: {n_errors} errors, {n_warnings} warnings"])


def write_report(violations: DataFrame, path: str) -> None:
    """All violations in their order, as Parquet: nothing is collected."""
    in_order(violations).write.mode("overwrite").parquet(path)


def validate(spark: SparkSession, root: str) -> tuple[DataFrame, str, int]:
    """The violations, the report and the exit status of the documents below ``root``."""
    c = Campaign(Corpus(spark, root))
    v = c.scratch.store(c.violations(), "violations")
    out = v, render(v, c.corpus.documents.count()), exit_status(v)
    c.release(v)  # the violations stay
    return out
