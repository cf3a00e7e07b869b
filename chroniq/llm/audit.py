"""Interaction audit of filters by first-failure lookup (operator 12).

Which of the filters a document fails is a number below 2 ** 5. A table that is computed once tells, for each such number and
each order of the filters, the step at which a document goes (or that it stays); a task looks up its documents'
rows of that table and counts them by part, order, step and label. These arrays are then summed; what a
report needs besides follows from the sums, as a filter that comes first removes all that fail it and one that comes last only those
that fail nothing else.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import column_bytes, materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS) + 1  # the last one: never removed
#: Limits of the filters (fixed values): words, percent of distinct words, percent of capitals, marks.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 50, 65, 5, b"#$%&*|"
CAPITALS, INNER_BYTES = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
#: Parts that a task counts at a time.
PARTS = 1_000
#: Rows up to which labels and repeated texts are broadcast; beyond, the joins shuffle.
BROADCAST_LABELS, BROADCAST_TEXTS = 1_000_000, 250_000


def first_failures() -> np.ndarray:
    """The step, from 0, at which a document goes, by the set of filters it fails and the order of filters; 5: never."""
    table = np.full((1 << len(FILTERS), len(ORDERS)), len(FILTERS), np.int64)
    for pattern in range(1 << len(FILTERS)):
        for k, order in enumerate(ORDERS):
            steps = [s for s, f in enumerate(order) if pattern >> FILTERS.index(f) & 1]
            if steps:
                table[pattern, k] = steps[0]
    return table


def pattern_of(text: bytes) -> int:
    """Bits of the filters that a text fails on its own: A, B, C and D."""
    words = text.split()  # exactly at \x20 and \x09-\x0D
    n, distinct = len(words), len(set(words))
    capitals, points = len(text) - len(text.translate(None, CAPITALS)), len(text.translate(None, INNER_BYTES))
    marked = len(text.translate(None, MARKS)) < len(text)
    return (n < LEAST_WORDS) | (100 * distinct < DISTINCT_PERCENT * n) << 1 | (100 * capitals > CAPITAL_PERCENT * points) << 2 | marked << 3


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, pattern (of A to D) and 128 bits of a digest of the text, for each row."""

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            raw, at = data.tobytes(), offsets.tolist()
            texts = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            digest = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in texts), np.int64).reshape(-1, 2)
            pattern = np.array([pattern_of(x) for x in texts], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pattern), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())], names=["doc_id", "part", "pattern", "high", "low"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, part string, pattern int, high long, low long")


def removals(rows: DataFrame) -> DataFrame:
    """part, order_no, step (from 0), removed, good and toxic of rows (part, pattern, label), counted in each task."""

    def run(batches):
        table = first_failures()
        cells = len(ORDERS) * STEPS * 4
        base = np.arange(len(ORDERS)) * STEPS * 4

        def flush(number, counts):
            by = counts[: len(number)].reshape(-1, 4)
            parts = pa.array(list(number), pa.string())
            at = np.repeat(np.arange(len(number)), len(ORDERS) * STEPS)
            order, step = np.divmod(np.arange(len(at)) % (len(ORDERS) * STEPS), STEPS)
            return pa.RecordBatch.from_arrays(
                [parts.take(pa.array(at)), pa.array(order.astype(np.int32)), pa.array(step.astype(np.int32)), pa.array(by.sum(1)), pa.array(by[:, 1] + by[:, 3]), pa.array(by[:, 2] + by[:, 3])], names=["part", "order_no", "step", "removed", "good", "toxic"],
            )

        number, counts = {}, np.zeros((PARTS, cells), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                some = batch.slice(i, 4096)
                parts, pattern, label = some.column(0).dictionary_encode(), some.column(1).to_numpy(), some.column(2).to_numpy().astype(np.int64)
                names, code = parts.dictionary.to_pylist(), parts.indices.to_numpy()
                for k in range(0, len(names), PARTS):
                    if len(number.keys() | set(names[k : k + PARTS])) > PARTS:
                        yield flush(number, counts)
                        number, counts = {}, np.zeros((PARTS, cells), np.int64)
                    row = np.array([number.setdefault(x, len(number)) for x in names[k : k + PARTS]])
                    own = np.flatnonzero((code >= k) & (code < k + PARTS))
                    where, of = np.unique(row[code[own] - k], return_inverse=True)
                    step = table[pattern[own]]  # a row of 120 steps for each document
                    cell = of[:, None] * cells + base[None, :] + step * 4 + label[own][:, None]
                    counts[where] += np.bincount(cell.ravel(), minlength=len(where) * cells).reshape(-1, cells)
        if number:
            yield flush(number, counts)

    return rows.select("part", "pattern", "label").mapInArrow(run, "part string, order_no int, step int, removed long, good long, toxic long")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley, for each part, each of the 120
    orders of the filters A to E and each step.

    A: under 50 words. B: under 65 % of the words are distinct. C: over 5 % of the code points are of A to Z. D: one of ``#$%&*|``. E: the
    text is that of a smaller doc_id, anywhere in the table. A null text is empty, a null source the empty string.

    A row is a document, also where doc_ids repeat (rows of one doc_id are no copies of each other); a null doc_id is neither smaller than
    another nor labelled. A document is good (toxic) if any row of ``labels`` says so. Extra columns are ignored; no documents make no rows.
    """
    of = materialize(judged(docs), "judged")
    again = of.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = materialize(again, "repeated")
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = materialize(marks.filter("good = 1 or toxic = 1"), "marks")
    # stored tables on both sides: a text that very many documents have can be split
    few = again.count() <= BROADCAST_TEXTS
    d = of.join(F.broadcast(again) if few else again.hint("merge"), ["high", "low"], "left")
    d = d.select("doc_id", "part", F.when(F.col("doc_id") > F.col("first"), F.col("pattern") + 16).otherwise(F.col("pattern")).alias("pattern"))
    d = d.join(F.broadcast(marks) if marks.count() <= BROADCAST_LABELS else marks.hint("merge"), F.col("doc_id") == F.col("id"), "left")
    d = d.select("part", "pattern", (F.coalesce("good", F.lit(0)) + 2 * F.coalesce("toxic", F.lit(0))).alias("label"))
    return report(removals(d))


def report(counted: DataFrame) -> DataFrame:
    """The audit's rows from the sums of what ``removals`` counts; each window holds a part's 720 rows at most."""
    total = counted.groupBy("part", "order_no", "step").agg(*[F.sum(c).alias(c) for c in ("removed", "good", "toxic")])
    orders = F.array(*[F.lit(x) for x in ORDERS])
    total = total.repartition("part").withColumn("filter_order", F.get(orders, F.col("order_no"))).withColumn("filter", F.substring("filter_order", F.col("step") + 1, F.lit(1)))
    one, own = W.partitionBy("part", "order_no"), W.partitionBy("part", "filter")
    gone = F.sum("removed").over(one.orderBy("step"))
    out = total.select(
        "part", "filter_order", (F.col("step") + 1).alias("step"), (F.sum("removed").over(one) - gone).alias("kept"), "removed",
        (F.max(F.when(F.col("step") == 0, F.col("removed"))).over(own) - F.col("removed")).alias("redundant"), F.max(F.when(F.col("step") == len(FILTERS) - 1, F.col("removed"))).over(own).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("removed").over(own).alias("shapley"),
    )
    return out.filter(F.col("step") <= len(FILTERS))


SQL = r"""
WITH x AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM x),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b, 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first, FALSE) AS e FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, good, toxic, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails, count(*) AS n FROM d GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT concat(f1.f, f2.f, f3.f, f4.f, f5.f) AS filter_order FROM f f1 JOIN f f2 ON f2.f <> f1.f JOIN f f3 ON f3.f NOT IN (f1.f, f2.f) JOIN f f4 ON f4.f NOT IN (f1.f, f2.f, f3.f) JOIN f f5 ON f5.f NOT IN (f1.f, f2.f, f3.f, f4.f)),
s AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1 : step - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f, sum(n) FILTER (WHERE NOT early AND NOT own) AS kept, sum(n) FILTER (WHERE NOT early AND own) AS removed, sum(n) FILTER (WHERE early AND own) AS redundant, sum(n) FILTER (WHERE fails = f) AS unique_fails,
  sum(n) FILTER (WHERE NOT early AND own AND good = 1) AS good_lost, sum(n) FILTER (WHERE NOT early AND own AND toxic = 1) AS toxic_lost
  FROM (SELECT *, contains(fails, f) AS own, before <> '' AND regexp_matches(fails, concat('[', CASE WHEN before = '' THEN 'X' ELSE before END, ']')) AS early FROM g, s) GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, sum(coalesce(removed, 0)) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM r
"""
