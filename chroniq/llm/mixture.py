"""Mixing sources to target weights by Pareto order sampling (operator 2). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Rules, a row for each source and grade of size, are broadcast up to so many rows; beyond, the joins shuffle.
BROADCAST_RULES = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) that depends on the id alone: 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, max_repeat: int) -> DataFrame:
    """source, weight, source_size, target for each row (source, source_size, rows).

    All words are shared out by the weights 1, 2, 3, repeating over the sources by code point, null last. A target
    stops at ``max_repeat`` times its source's size and the excess is shared again: the fixed point is found in one
    pass over the sources by size per weight, as those that stop come first in that order.
    """
    s = sizes.withColumn("weight", F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(3)) + 1)
    s = s.withColumn("cap", F.lit(max_repeat) * F.col("source_size"))
    ratio = F.col("cap").cast("double") / F.col("weight")
    before = W.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("stopped", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("left_out", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    every = W.partitionBy()
    share = (F.sum("source_size").over(every) - F.col("stopped")).cast("double") / (F.sum("weight").over(every) - F.col("left_out")).cast("double")
    s = s.withColumn("share", share).withColumn("open", F.col("weight") * F.col("share") <= F.col("cap"))
    # the first open source in the order sets the share of all that follow
    level = F.first(F.when(F.col("open"), F.col("share")), ignorenulls=True).over(W.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    s = s.withColumn("target", F.when(level.isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("weight") * level, F.col("cap").cast("double"))))
    return s.select("source", "weight", "rows", "source_size", "target")


def grade(size: Column) -> Column:
    """The number of binary digits of a size, 0 for 0: what the inclusion probability of an extra copy is proportional to."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def inclusion(grades: DataFrame, t: DataFrame) -> DataFrame:
    """The rows of ``grades`` (skey, grade, words) with the columns of their source and ``pi``, each grade's inclusion probability.

    pi = min(1, rate * grade), with the rate at which the expected words are the source's rest. Grades that reach 1 are
    certain: from the largest down, the first grade whose rate (of what the ones above leave) keeps it at 1 at most
    sets the rate of the source.
    """
    down = W.partitionBy("skey").orderBy(F.desc("grade"))
    g = grades.join(t.drop("words", "grade"), "skey")
    above = F.coalesce(F.sum("words").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("grade") * F.col("words")).over(down.rowsBetween(0, W.unboundedFollowing))
    g = g.withColumn("rate", F.try_divide(F.col("rest") - above, below))
    level = F.first(F.when((F.col("rate") * F.col("grade") <= 1) & (F.col("words") > 0), F.col("rate")), ignorenulls=True)
    g = g.withColumn("level", level.over(down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return g.withColumn("pi", F.least(F.lit(1.0), F.coalesce("level", F.lit(0.0)) * F.col("grade"))).drop("rate", "level", "words")


def plan(docs: DataFrame, max_repeat: int = 3) -> tuple[DataFrame, DataFrame]:
    """The narrow table of documents and, for each source and grade of size, what decides over a document by its own row.

    Every document is taken ``base`` whole times for certain, base = floor(target / source_size). The rest of the
    target is an extra copy of some, by Pareto order sampling: a document's inclusion probability pi rises with its
    size (see ``inclusion``), and the order is by the random odds u / (1 - u) over the inclusion odds pi / (1 - pi). The
    longest head of that order within the rest is taken, then the one further document (``fill``) whose size
    comes nearest to what is still missing, if it brings the total nearer. To find the head without
    sorting a source in one task, the order is cut into as many slices as the square root of the rows: the sums of each
    slice are run through, and only the slice that holds the end is sorted.
    """
    narrow = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), uniform(F.col("doc_id")).alias("u")), "sizes")
    by_grade = materialize(narrow.groupBy("source", grade(F.col("size")).alias("grade")).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words")), "grades")
    t = targets(by_grade.groupBy("source").agg(F.sum("rows").alias("rows"), F.sum("words").alias("source_size")), max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = t.withColumn("base", F.floor(ratio).cast("long")).withColumn("mean", ratio - F.floor(ratio)).withColumn("rest", F.col("target") - F.col("base") * F.col("source_size")).withColumn("slices", F.ceil(F.sqrt("rows")).cast("long"))
    t = t.withColumn("skey", source_key(F.col("source"))).select("skey", F.col("source").alias("rule_source"), "source_size", "target", "base", "mean", "rest", "slices")
    t = materialize(inclusion(by_grade.select(source_key(F.col("source")).alias("skey"), "grade", "words"), t), "inclusion")
    hint = small(t)
    ranked = with_order(keyed(narrow).drop("source").join(hint(t.select("skey", "grade", "pi", "mean", "rest", "slices")), ["skey", "grade"]).filter("pi > 0 and size > 0"))
    heads = ranked.groupBy("skey", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    run = heads.withColumn("upto", F.sum("words").over(W.partitionBy("skey").orderBy("slice")))
    cut = materialize(run.filter("upto > rest").groupBy("skey").agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("sofar"))).alias("at")).select("skey", "at.slice", "at.sofar"), "cut")
    inside = ranked.join(hint(cut.withColumnRenamed("slice", "at_slice")), "skey").filter("slice = at_slice")
    inside = inside.groupBy("skey", "q", "doc_id").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("sofar").alias("sofar"))
    total = F.col("sofar") + F.sum("size").over(W.partitionBy("skey").orderBy("q", F.col("doc_id").asc_nulls_first()))
    ends = inside.withColumn("total", total)
    # the last of the head, by (q, doc_id); none of this slice may fit
    ends = ends.groupBy("skey").agg(F.max(F.when(F.col("total") <= F.col("rest"), F.struct("q", F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("id"), "total"))).alias("last"), F.first("rest").alias("rest"), F.first("sofar").alias("sofar"))
    ends = materialize(ends.select("skey", F.coalesce("last.q", F.lit(-1.0)).alias("last_q"), F.coalesce("last.id", F.lit(-(2**63))).alias("last_id"), (F.col("rest") - F.coalesce("last.total", F.col("sofar"))).alias("missing")).join(cut.select("skey", F.col("slice").alias("at_slice")), "skey"), "ends")
    outside = ranked.groupBy("skey", "q", "slice", "doc_id").agg(F.sum("size").alias("size")).join(hint(ends), "skey").filter(~taken_extra())
    gain = F.col("missing") - F.abs(F.col("missing") - F.col("size"))
    fill = outside.filter(gain > 0).groupBy("skey").agg(F.min(F.struct((-gain).alias("g"), F.col("doc_id"))).alias("f")).select("skey", F.col("f.doc_id").alias("fill_id"), F.lit(True).alias("filled"))
    rules = t.join(hint(ends.drop("missing").join(fill, "skey", "left")), "skey", "left")
    return narrow, materialize(rules, "rules")


def small(rules: DataFrame):
    """A hint to broadcast tables of no more rows than ``rules``, if these are counted to be few."""
    return F.broadcast if rules.count() <= BROADCAST_RULES else (lambda d: d)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("skey", source_key(F.col("source"))).withColumn("grade", grade(F.col("size")))


def with_order(docs: DataFrame) -> DataFrame:
    """Adds Pareto's ranking variable q (null where no extra copy is due) and its slice, which rises with q.

    What is certain (pi = 1, so q = 0) is slice -1. The others' slices are of about the same size, as q times the mean
    inclusion odds is about the odds of a uniform number.
    """
    q = F.col("u") / (1 - F.col("u")) * F.try_divide(1 - F.col("pi"), F.col("pi"))
    scaled = F.col("q") * F.try_divide(F.col("mean"), 1 - F.col("mean"))
    return docs.withColumn("q", q).withColumn("slice", F.when(F.col("q") == 0, F.lit(-1)).otherwise(F.floor((1 - 1 / (1 + scaled)) * F.col("slices"))).cast("long"))


def taken_extra() -> Column:
    """Whether a document of columns q, slice and doc_id lies in the head of its source's order; no end: all do."""
    low = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    inside = (F.col("q") < F.col("last_q")) | ((F.col("q") == F.col("last_q")) & (low <= F.col("last_id")))
    return F.col("at_slice").isNull() | (F.col("slice") < F.col("at_slice")) | ((F.col("slice") == F.col("at_slice")) & inside)


def copies(docs: DataFrame, rules: DataFrame) -> DataFrame:
    """``docs`` (with doc_id, source, size, u) plus the columns of the rules and ``copies``, the times each is taken."""
    j = with_order(keyed(docs).join(small(rules)(rules), ["skey", "grade"]))
    extra = (F.col("pi") > 0) & (F.col("size") > 0) & (taken_extra() | (F.coalesce(F.col("filled"), F.lit(False)) & F.col("doc_id").eqNullSafe(F.col("fill_id"))))
    return j.withColumn("copies", F.col("base") + extra.cast("long"))


def mix_table(docs: DataFrame, max_repeat: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of each row of ``docs`` (doc_id, text, source).

    A null or empty text has size 0 and is never worth an extra copy; a null source is a source of its own, a null
    doc_id ranks as the smallest id. Rows of one doc_id in one source share their fate. An empty table gives no rows;
    where all sizes are 0, so are all targets. ``taken`` is copies times size, so 3 times the size at most.
    """
    narrow, rules = plan(docs, max_repeat)
    out = copies(narrow, rules)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, max_repeat: int = 3) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as many times as ``mix_table`` takes it, with its own columns.

    Null and empty texts, null sources and ids, repeated rows and empty tables are treated as there; a text without words
    comes ``base`` times, as every document of its source does for certain.
    """
    _, rules = plan(docs, max_repeat)
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")
    narrow = docs.select(row, "doc_id", "source", word_count(F.col("text")).alias("size"), uniform(F.col("doc_id")).alias("u"))
    times = copies(narrow, rules).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return times.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])


SQL = r"""
WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size, CASE WHEN size > 0 THEN len(bin(size)) ELSE 0 END AS grade,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
s0 AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS stopped, coalesce(sum(weight) OVER b, 0) AS left_out, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
    FROM s1 WINDOW b AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, (total - stopped)::DOUBLE / (weights - left_out)::DOUBLE AS share FROM s2),
s4 AS (SELECT *, (SELECT min_by(share, cap::DOUBLE / weight) FROM s3 WHERE weight * share <= cap) AS level FROM s3),
s5 AS (SELECT *, CASE WHEN level IS NULL THEN cap::DOUBLE ELSE least(weight * level, cap::DOUBLE) END AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base, target - base * source_size AS rest FROM s5),
g0 AS (SELECT source, grade, sum(size)::BIGINT AS words FROM d GROUP BY source, grade),
g1 AS (SELECT g0.*, rest, coalesce(sum(words) OVER (PARTITION BY g0.source ORDER BY grade DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS above,
    (sum(grade * words) OVER (PARTITION BY g0.source ORDER BY grade DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS below
    FROM g0 JOIN s6 ON g0.source IS NOT DISTINCT FROM s6.source),
g2 AS (SELECT *, CASE WHEN below > 0 THEN (rest - above) / below END AS rate FROM g1),
g3 AS (SELECT source, max_by(rate, grade) FILTER (rate * grade <= 1 AND words > 0) AS level FROM g2 GROUP BY source),
j AS (SELECT d.*, s6.source_size, target, base, rest, least(1.0::DOUBLE, coalesce(g3.level, 0) * grade) AS pi, CASE WHEN pi > 0 THEN u / (1 - u) * ((1 - pi) / pi) END AS q
    FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source JOIN g3 ON d.source IS NOT DISTINCT FROM g3.source),
h AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id) AS upto FROM j WHERE pi > 0 AND size > 0),
m AS (SELECT source, max(rest) - coalesce(max(upto) FILTER (upto <= rest), 0) AS missing FROM h GROUP BY source),
f AS (SELECT h.source, min({'g': abs(missing - size) - missing, 'id': doc_id}).id AS fill FROM h JOIN m ON h.source IS NOT DISTINCT FROM m.source
    WHERE upto > rest AND missing - abs(missing - size) > 0 GROUP BY h.source)
SELECT j.doc_id, j.size, j.source_size::BIGINT AS source_size, j.target, ((j.base + CASE WHEN h.upto <= j.rest OR f.fill = j.doc_id THEN 1 ELSE 0 END) * j.size)::BIGINT AS taken,
    (j.base + CASE WHEN h.upto <= j.rest OR f.fill = j.doc_id THEN 1 ELSE 0 END)::BIGINT AS copies
FROM j LEFT JOIN h ON j.doc_id = h.doc_id LEFT JOIN f ON j.source IS NOT DISTINCT FROM f.source AND j.size > 0 AND j.pi > 0
"""
