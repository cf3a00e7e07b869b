"""The generic integrity checks. Each takes DataFrames and returns the rows that break (or state) a rule.

All of them are declarative plans: membership is a semi or anti join, order is a window within an entity's
key, and what is counted is combined before it is exchanged. None holds a group in one row or collects to the driver.
The predicates ``outside``, ``misformed``, ``lacking`` and ``nth`` are what the checks filter by; the rule catalogue, which states
many rules in one pass over its records, uses them as columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.functions import text as T


def outside(value: Column, allowed) -> Column:
    """Whether a value is outside the domain; a null counts as the empty string."""
    return ~F.coalesce(value, F.lit("")).isin(*allowed)


def misformed(value: Column, pattern: str) -> Column:
    """Whether a value does not match as a whole; a null counts as the empty string."""
    return ~T.full_match(F.coalesce(value, F.lit("")), pattern)


def lacking(*when: tuple[str, Column]) -> Column:
    """The sorted names whose condition holds; a null does not."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in sorted(when, key=lambda x: x[0])]), lambda x: x.isNotNull())


def nth(scope: list[str], key: str, order: list[str]) -> Column:
    """Which occurrence of its key within its scope a row is, from 1."""
    return F.row_number().over(W.partitionBy(*scope, key).orderBy(*order))


def required_set(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Required rows that are not present."""
    return required.join(present.select(*keys), keys, "left_anti")


def set_compare(left: DataFrame, right: DataFrame, key: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """Distinct keys of one side only, of each ``scope``: (scope, key, side) with side missing (left only) or unexpected (right only)."""
    on = [*scope, key]
    a, b = left.select(*on).distinct(), right.select(*on).distinct()
    return a.join(b, on, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, on, "left_anti").withColumn("side", F.lit("unexpected")))


def domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose value is outside the domain."""
    return df.filter(outside(F.col(column), allowed))


def format_of(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose value does not match as a whole."""
    return df.filter(misformed(F.col(column), pattern))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count n."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_located(df: DataFrame, key: Column, location: str) -> DataFrame:
    """(location, first, n) for each row whose key occurs n > 1 times; ``first`` is the smallest location.

    Long rows, so a key that a third of all rows hold is never gathered. Keys are compared by SHA-256. A null is no key.
    """
    keyed = df.select(F.sha2(key.cast("string"), 256).alias("k"), F.col(location)).filter("k is not null")
    groups = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min(location).alias("first")).filter("n > 1")
    return keyed.join(groups, "k").select(location, "first", "n")


def first_wins(df: DataFrame, scope: list[str], key: str, order: list[str]) -> DataFrame:
    """All but the first row of each key within its scope."""
    return df.withColumn("_n", nth(scope, key, order)).filter("_n > 1").drop("_n")


def foreign_key(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Child rows whose reference is set but has no parent."""
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, (_, p) in enumerate(on)])
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c, _ in on])
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}") for i, (c, _) in enumerate(on)])
    return child.filter(filled).join(keys, cond, "left_anti")


def foreign_key_list(child: DataFrame, column: str, parent: DataFrame, key: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """Child rows exploded to the listed values that have no parent (of the same ``scope``), as column ``value``."""
    return child.withColumn("value", F.explode(column)).join(parent.select(*scope, F.col(key).alias("value")), [*scope, "value"], "left_anti")


def conditional_required(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rows that lack a field where its condition holds, with the sorted names in ``missing``.

    ``rules`` maps a name to (when it is required, whether it is there).
    """
    broken = [(name, F.coalesce(when, F.lit(False)) & ~F.coalesce(there, F.lit(False))) for name, (when, there) in rules.items()]
    return df.withColumn("missing", lacking(*broken)).filter(F.size("missing") > 0)


def chain(df: DataFrame, entity: list[str], number: str, tie: tuple[str, ...] = (), also: tuple[str, ...] = ()) -> DataFrame:
    """Each row with the number before it in its entity (``previous``) and whether it continues the chain.

    Equal numbers are in the order of ``tie``; of each column of ``also`` the row before's value is ``previous_`` and its name.
    """
    w = W.partitionBy(*entity).orderBy(number, *tie)
    out = df.withColumn("previous", F.lag(number).over(w))
    for c in also:
        out = out.withColumn(f"previous_{c}", F.lag(c).over(w))
    return out.withColumn("continues", F.coalesce(F.col(number) == F.col("previous") + 1, F.lit(True)))


def introduced(uses: DataFrame, introductions: DataFrame, entity: str | list[str], position: str) -> DataFrame:
    """Uses with the earliest place where their entity is introduced, null if nowhere."""
    key = [entity] if isinstance(entity, str) else entity
    return uses.join(introductions.groupBy(*key).agg(F.min(position).alias("introduced")), key, "left")


def visible_before(uses: DataFrame, introductions: DataFrame, entity: str, position: str) -> DataFrame:
    """Uses at a position by which nothing of their entity has been introduced; ``introduced`` is the earliest place."""
    return introduced(uses, introductions, entity, position).filter(F.col("introduced").isNull() | (F.col("introduced") >= F.col(position)))


def pointer(df: DataFrame, entity: str, order: list[str], columns: list[str]) -> DataFrame:
    """The latest row of each entity by ``order``."""
    latest = df.groupBy(entity).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_l"))
    return latest.select(entity, *[F.col(f"_l.{c}").alias(c) for c in columns])


def line_match(df: DataFrame, key: str, text: str, pattern: str, lines: Column | None = None) -> DataFrame:
    """(key, line_no, line) of each line that holds the pattern; lines are numbered from 1 and end at line feeds, unless given."""
    lines = df.select(key, F.posexplode(F.split(text, "\n") if lines is None else lines).alias("_p", "line"))
    return lines.filter(F.col("line").rlike(pattern)).select(key, (F.col("_p") + 1).alias("line_no"), "line")


def report(parts: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations), a row for each part, also where there are none."""
    one = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, one)
