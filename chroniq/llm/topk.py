"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation (operator 4).

A block of candidates becomes posting lists, one for each component that is not zero. Term by term, each query that has
the term scatters its weight times the term's postings into its dense array of scores; the k best of a block are
found by partition, and the blocks' best are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import materialize

#: Rows of a block of candidates and of a block of queries: what one task holds at a time.
CANDIDATES, QUERIES = 16_384, 2_048
#: Scores that are accumulated at a time.
SCORES = 2_000_000


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not finite; fails where that is no long."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    long = lambda v: F.when((v * scale >= -(2.0**63)) & (v * scale < 2.0**63), F.floor(v * scale).cast("long"))
    return F.when(good, F.transform(x, lambda v: F.coalesce(long(v), F.raise_error(F.lit("a component is too large for a long")).cast("long"))))


def sparse(column: pa.Array):
    """Row, term and weight of each component that is not zero, and the number of rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    on = flat != 0
    return row[on], term[on], flat[on], len(size)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ``ids`` rise."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores > bar)
        at = np.concatenate([over, np.flatnonzero(scores == bar)[: k - len(over)]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))]


def search_block(qid: np.ndarray, queries: pa.Array, cid: np.ndarray, candidates: pa.Array, k: int):
    """(query, candidate, score) of each query's k best candidates of this block."""
    order = np.argsort(cid, kind="stable")
    cid = cid[order]
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    row, term, weight, n = sparse(candidates)
    row = place[row]
    by = np.argsort(term, kind="stable")
    row, weight = row[by], weight[by]
    terms = int(term.max()) + 1 if len(term) else 0
    edge = np.searchsorted(term[by], np.arange(terms + 1))
    qrow, qterm, qweight, nq = sparse(queries)
    by = np.argsort(qterm, kind="stable")
    qrow, qweight = qrow[by], qweight[by]
    qedge = np.searchsorted(qterm[by], np.arange(terms + 1))
    # scores of ordinary vectors fit 32 bits, which are added faster; sums that could exceed a long are Python's integers
    largest = [max(int(w.max(initial=0)), -int(w.min(initial=0))) for w in (weight, qweight)]
    bound = largest[0] * largest[1] * max(terms, 1)
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object
    weight, qweight = weight.astype(kind), qweight.astype(kind)
    step = max(1, SCORES // max(n, 1))
    out = ([], [], [])
    for lo in range(0, nq, step):
        hi = min(nq, lo + step)
        score = np.zeros((hi - lo, n), kind)
        for t in range(terms):
            a, b = qedge[t] + np.searchsorted(qrow[qedge[t] : qedge[t + 1]], [lo, hi])
            at, value = row[edge[t] : edge[t + 1]], weight[edge[t] : edge[t + 1]]
            for r, w in zip((qrow[a:b] - lo).tolist(), qweight[a:b], strict=True):
                score[r][at] += w * value  # a candidate has one posting for each term at most
        for r in range(hi - lo):
            other = cid != qid[lo + r]
            s, c = (score[r], cid) if other.all() else (score[r][other], cid[other])
            s = s.astype(np.int64)  # fails where a score is no long; one with the query itself is none
            at = best(c, s, k)
            out[0].append(np.full(len(at), qid[lo + r])), out[1].append(c[at]), out[2].append(s[at])
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest inner product for each row that ``queries`` marks.

    Candidates are all rows but those of the query's own id; scores are exact integers, ties go to the smaller id.
    Vectors that are null or hold a null or a non-finite component take no part, nor do null ids. A score or a
    quantised component that does not fit a long is an error, as in SQL. Components are terms: a zero is no posting, and vectors of other lengths meet on the terms they share.
    Repeated ids give each their own rows; of a repeated query id all rows are one query's candidates' peers and
    their results are ranked together. Fewer candidates than k: all. Blocks of queries meet blocks of candidates by
    their numbers, so no side is broadcast or held whole.
    """
    base = vectors.select(F.col(id_column).cast("long").alias("id"), quantised(F.col(vector_column)).alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    base = materialize(base.filter("id is not null and v is not null"), "vectors")
    n, nq = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0))).first()
    parts = max(base.sparkSession.sparkContext.defaultParallelism * 5, n // CANDIDATES + 1)
    blocks = nq // QUERIES + 1
    number = F.xxhash64("id")
    c = base.select("id", "v", F.pmod(number, F.lit(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    q = base.filter("is_query").select("id", "v", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            got = search_block(left["id"].to_numpy(), left["v"].combine_chunks(), right["id"].to_numpy(), right["v"].combine_chunks(), k)
        else:
            got = [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got), strict=True)))

    part = q.groupBy("block", "part").cogroup(c.groupBy("block", "part")).applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return part.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
