"""State protocol over event-sourced deltas: folding, preconditions, coverage, precedence, visibility, reconciliation.

These capabilities are specified in prose only by what this package is modelled on; the names follow that specification.
Every operator is keyed by what it folds, so its work spreads over the entities and a later record wins by an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.operators.checks import conditional_required, outside


def fold(changes: DataFrame) -> DataFrame:
    """(target, value, quantity) after all changes (cp, idx, operation, target, to, value, quantity).

    set and move: the latest ``to`` of a target is its value, quantity null. add and remove: the signed sum for each
    (target, value); a null quantity counts 1.
    """
    order = F.struct("cp", "idx")
    latest = changes.filter("operation in ('set', 'move')").groupBy("target").agg(F.max_by("to", order).alias("value")).withColumn("quantity", F.lit(None).cast("double"))
    signed = F.coalesce(F.col("quantity").cast("double"), F.lit(1.0)) * F.when(F.col("operation") == "add", 1.0).otherwise(-1.0)
    sums = changes.filter("operation in ('add', 'remove')").groupBy("target", "value").agg(F.sum(signed).alias("quantity"))
    return latest.unionByName(sums)


def failed_assertions(changes: DataFrame, state: DataFrame) -> DataFrame:
    """set and move changes whose ``from`` is not the value before them: of the change before, else of ``state`` (target, value)."""
    own = changes.filter("operation in ('set', 'move')").withColumn("before", F.lag("to").over(W.partitionBy("target").orderBy("cp", "idx"))).withColumn("nth", F.row_number().over(W.partitionBy("target").orderBy("cp", "idx")))
    held = own.join(state.select("target", F.col("value").alias("initial")), "target", "left")
    expected = F.when(F.col("nth") == 1, F.col("initial")).otherwise(F.col("before"))
    return held.withColumn("expected", expected).filter(~F.col("from").eqNullSafe(F.col("expected"))).drop("nth", "before", "initial")


def stale(packages: DataFrame, current: DataFrame) -> DataFrame:
    """Packages whose base is not the current id (a table of one row)."""
    return packages.join(F.broadcast(current.select(F.col("id").alias("_current"))), F.col("base").eqNullSafe(F.col("_current")), "left_anti")


def rebase(base: DataFrame, current: DataFrame, package: DataFrame) -> DataFrame:
    """A package (target, value) that was made on ``base``, carried over to the ``current`` state: target, value, outcome.

    Each is a table (target, value); a target that a state lacks has no value there, and a package's null takes it away. A target that the
    package sets is ``applied`` where the current state still has the base's value, ``agreed`` where it has the package's
    already, ``unchanged`` where the package repeats the base's, and else a ``conflict``, which keeps the current value until
    somebody decides. What the package doesn't name is ``current``. Each table has a target once.
    """
    of = lambda df, name: df.select("target", F.col("value").alias(name), F.lit(True).alias(f"has_{name}"))
    d = of(current, "now").join(of(package, "mine"), "target", "full_outer").join(of(base, "was"), "target", "left")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    outcome = F.when(F.col("has_mine").isNull(), "current").when(same("now", "mine"), "agreed").when(same("now", "was"), "applied").when(same("mine", "was"), "unchanged").otherwise("conflict")
    d = d.withColumn("outcome", outcome).withColumn("value", F.when(F.col("outcome") == "applied", F.col("mine")).otherwise(F.col("now")))
    return d.select("target", "value", "outcome")


def conflicts(base: DataFrame, current: DataFrame, package: DataFrame) -> DataFrame:
    """What has to be decided before a package is carried over: target, was, now, mine."""
    d = rebase(base, current, package).filter("outcome = 'conflict'").select("target")
    for df, name in ((base, "was"), (current, "now"), (package, "mine")):
        d = d.join(df.select("target", F.col("value").alias(name)), "target", "left")
    return d


def apply(state: DataFrame, changes: DataFrame, violations: DataFrame) -> DataFrame:
    """All or nothing: the folded state, or ``state`` as it is if anything is violated."""
    if violations.limit(1).count():
        return state
    folded = fold(changes)
    return folded.unionByName(state.join(folded.select("target").distinct(), "target", "left_anti"), allowMissingColumns=True)


#: Classes of a coverage ledger (fixed values).
COVERAGE = ("covered", "superseded", "noncanonical", "immaterial", "missing")


def coverage(details: DataFrame, ledger: DataFrame, anchor: str = "anchor") -> DataFrame:
    """Each detail with its status in the ledger; what the ledger does not name is ``missing``."""
    return details.join(ledger.select(anchor, "status"), anchor, "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def blocking(covered: DataFrame) -> DataFrame:
    """Details that keep a package from being applied: ``missing``, or of a status that is no class of the ledger."""
    return covered.filter((F.col("status") == "missing") | outside(F.col("status"), COVERAGE))


def superseded(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The latest resolution of each key."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_l")).select(key, *[F.col(f"_l.{c}") for c in columns])


def precedence(claims: DataFrame, ladder: DataFrame, key: str, source: str, value: str, tie: str) -> DataFrame:
    """For each key the value of the source that ranks first in ``ladder`` (source, rank); ties go to the smallest ``tie``."""
    ranked = claims.join(ladder.select(source, "rank"), source)
    return ranked.groupBy(key).agg(F.min(F.struct("rank", tie, value, source)).alias("_f")).select(key, F.col(f"_f.{source}").alias(source), F.col(f"_f.{value}").alias(value))


def visible(df: DataFrame, levels: list[str], column: str = "knowledge_level", hidden_paths: Column | None = None) -> DataFrame:
    """Rows of a level that may be seen, and of no hidden path."""
    keep = F.col(column).isin(*levels)
    return df.filter(keep if hidden_paths is None else keep & ~hidden_paths)


def context(documents: DataFrame, active: DataFrame, always: list[str] | Column, never: str, relevant: DataFrame | None = None) -> DataFrame:
    """Documents to load with their ``tier``: always, resume (of an active id) or relevant (of a ``topic`` that is asked for).

    Each document is of its first tier; none is loaded from below ``never``.
    """
    d = documents.filter(~F.col("path").startswith(never))
    fixed_ = always if isinstance(always, Column) else F.col("path").isin(*always)
    fixed, rest = d.filter(fixed_), d.filter(~fixed_)
    out = fixed.withColumn("tier", F.lit("always")).unionByName(rest.join(active.select("id"), "id", "left_semi").withColumn("tier", F.lit("resume")))
    if relevant is None:
        return out
    more = rest.join(active.select("id"), "id", "left_anti").join(relevant.select("topic"), "topic", "left_semi")
    return out.unionByName(more.withColumn("tier", F.lit("relevant")))


def increment(events: DataFrame, applied: DataFrame, key: str) -> DataFrame:
    """Events that are not applied yet."""
    return events.join(applied.select(key), key, "left_anti")


def broken_immutability(before: DataFrame, after: DataFrame) -> DataFrame:
    """Entries (id, status, text) that were closed and differ or are gone, or were open and did not only grow."""
    j = before.join(after.select("id", F.col("text").alias("now")), "id", "left")
    same = F.coalesce(F.sha2("text", 256) == F.sha2("now", 256), F.lit(False))
    grown = F.coalesce(F.col("now").startswith(F.col("text")), F.lit(False))
    return j.filter(F.when(F.col("status") == "open", ~grown).otherwise(~same)).select("id", "status")


def reconcile(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose values differ or that one side lacks: (key, left_value, right_value)."""
    a, b = left.select(key, F.col(value).alias("left_value")), right.select(key, F.col(value).alias("right_value"))
    return a.join(b, key, "full_outer").filter(~F.col("left_value").eqNullSafe(F.col("right_value")))


def scene_lifecycle(scenes: DataFrame) -> DataFrame:
    """Scenes (scene_status, next_scene_id) that close without a next one, with what is missing."""
    return conditional_required(scenes, {"next_scene_id": (F.col("scene_status") == "close", F.coalesce(F.col("next_scene_id"), F.lit("")) != "")})


def clocks(ticks: DataFrame, limits: DataFrame, key: str, order: list[str], amount: str) -> DataFrame:
    """Each tick with the clock's value so far, no higher than its limit, whether it has struck, and whether it strikes now (``fires``).

    Other columns of ``limits``, as a clock's trigger and effect, come along.
    """
    run = F.sum(amount).over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return ticks.withColumn("_run", run).join(limits, key).withColumn("current", F.least("_run", "limit")).withColumn("struck", F.col("_run") >= F.col("limit")).withColumn("fires", F.col("struck") & (F.col("_run") - F.col(amount) < F.col("limit"))).drop("_run")


def timeline(events: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    return events.select(*columns).orderBy(*order)


def unresolved_sources(packages: DataFrame, exports: DataFrame, placeholders: list[str]) -> DataFrame:
    """Packages whose source is empty, a placeholder or no known export."""
    empty = F.coalesce(F.col("source"), F.lit("")).isin("", *placeholders)
    return packages.filter(empty).unionByName(packages.filter(~empty).join(exports.select("source"), "source", "left_anti"))
