"""Ranked lexical search by MaxScore over shards (operator 13).

A pass over the documents counts what the weights need: documents, terms, and the documents that hold each of the items' terms. A second
one scores. A task gathers the postings of the items' terms, of its documents, into shards; a posting holds the term's whole contribution to
the document's score, so the largest of a list bounds what the term can add. An item takes its lists in the order of these
bounds. As long as the bounds of the lists to come, together, reach the item's 10th best score so far, the list is essential: all
its postings are scored. From then on no document that is in no essential list can qualify, and the rest, the
non-essential lists, are only probed for the documents found, each as long as its score and the bounds of what is left can still
qualify. The best of the shards are then merged, in two steps. Terms are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import LOWER, NON_ALNUM, U, byte_sums, column_bytes, pieces, span_hash, word_spans
from chroniq.llm.decontaminate import item_blocks

#: Bytes of text of a shard, about.
SHARD_BYTES = 32 << 20
#: Groups of tasks whose results are merged first.
GROUPS = 256


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each term of the texts, in their order."""
    data = LOWER[data]
    starts, ends, doc = word_spans(data, offsets, NON_ALNUM)
    return doc, span_hash(byte_sums(data), starts, ends) if len(starts) else np.zeros(0, U)


def postings(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each document; and term, document and occurrences of each posting of the (rising) vocabulary, by term and document."""
    docs = len(offsets) - 1
    doc, h = terms(data, offsets)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    held = np.flatnonzero(vocabulary[at] == h)
    key, tf = np.unique(at[held] * docs + doc[held], return_counts=True)
    return np.bincount(doc, minlength=docs), key // max(docs, 1), key % max(docs, 1), tf


class Queries:
    """The items of a block: its vocabulary, and each item's terms as places in it."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.ids = [i for i, _ in items]
        found = [np.unique(terms(*column_bytes(pa.array([text or b""], pa.binary())))[1]) for _, text in items]
        self.vocabulary = np.unique(np.concatenate([*found, np.zeros(0, U)]))
        self.terms = [np.searchsorted(self.vocabulary, x) for x in found]


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.score, self.doc = [np.zeros(0, np.int64)] * items, [np.zeros(0, np.int64)] * items

    def least(self, item: int) -> int:
        """The score below which no document enters."""
        return int(self.score[item][-1]) if len(self.score[item]) == self.most else 1

    def add(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score[item], score]), np.concatenate([self.doc[item], doc])
        order = np.lexsort((doc, -score))[: self.most]
        self.score[item], self.doc[item] = score[order], doc[order]


class Shard:
    """Posting lists of some documents: ``doc`` and ``adds`` from ``edge[t]`` to ``edge[t + 1]``, and each list's bound."""

    def __init__(self, ids: np.ndarray, term: np.ndarray, doc: np.ndarray, adds: np.ndarray, vocabulary: int):
        self.ids, self.doc, self.adds = ids, doc, adds
        self.edge = np.searchsorted(term, np.arange(vocabulary + 1))
        self.bound = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.bound, term, adds)
        self.scores = np.zeros(len(ids), np.int64)
        self.probed = self.scored = 0

    def search(self, item: int, query: np.ndarray, best: Best) -> None:
        """Enter the documents of this shard among the item's best."""
        lists = query[self.bound[query] > 0]
        lists = lists[np.argsort(-self.bound[lists], kind="stable")]
        rest = np.append(np.cumsum(self.bound[lists][::-1])[::-1], 0)  # what the lists from here on can add
        least, scores, found = best.least(item), self.scores, [np.zeros(0, np.int64)]
        i = 0
        while i < len(lists) and rest[i] >= least:  # essential
            of = slice(self.edge[lists[i]], self.edge[lists[i] + 1])
            scores[self.doc[of]] += self.adds[of]
            found.append(self.doc[of])
            self.scored += of.stop - of.start
            i += 1
            if len(scores) >= best.most and i < len(lists) and int(scores[found[-1]].max()) > rest[i]:
                # so many documents reach this score already, whatever follows
                least = max(least, int(np.partition(scores, -best.most)[-best.most]))
        docs = np.unique(np.concatenate(found))
        have = scores[docs]
        scores[docs] = 0
        for k in range(i, len(lists)):
            stay = have + rest[k] >= least
            docs, have = docs[stay], have[stay]
            of = slice(self.edge[lists[k]], self.edge[lists[k] + 1])
            place = np.minimum(np.searchsorted(self.doc[of], docs), of.stop - of.start - 1)
            hit = self.doc[of][place] == docs
            have[hit] += self.adds[of][place[hit]]
            self.probed += len(docs)
        stay = have >= least
        best.add(item, have[stay], self.ids[docs[stay]])


def statistics(narrow: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the documents that hold each term of the vocabulary."""
    shared = narrow.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known, total, n = shared.value, np.zeros(2, np.int64), np.zeros(len(shared.value), np.int64)
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in pieces(offsets):
                count, term, _, _ = postings(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], known)
                total += [(count > 0).sum(), count.sum()]
                n += np.bincount(term, minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-2, -1], some)), pa.array(np.append(total, n[some]))], names=["term", "n"])

    # one row for each term of a block of items, whose bytes are bounded
    counts = {r.term: r.n for r in narrow.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return counts.get(-2, 0), counts.get(-1, 0), np.array([counts.get(t, 0) for t in range(len(vocabulary))], np.int64)


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)


def ranked(docs: DataFrame, items: DataFrame, most: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the ``most`` highest-scoring documents of each item, scores above 0, ties to the smaller doc_id.

    Terms are runs of letters and digits of ASCII and of all other characters, lower-cased in A-Z, of whole texts. A term counts once for an
    item. Null and empty texts have no terms; items without terms find nothing. Each row of ``items`` is an item and each row of
    ``docs`` a document, also where ids repeat; a document without a doc_id counts in the statistics but is never returned. Other columns are
    ignored; no documents or no items make no rows. Items are searched in blocks of bounded size; the documents are read twice for each.
    """
    spark, result = docs.sparkSession, None
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    for block in item_blocks(items, "item_id"):
        queries = Queries(block)
        known = queries.vocabulary
        documents, length, holding = statistics(narrow, known) if len(known) else (0, 0, np.zeros(0, np.int64))
        shared = spark.sparkContext.broadcast((queries, weights(documents, holding), documents, length))

        def run(batches, shared=shared):
            queries, weight, documents, length = shared.value
            best = Best(len(queries.ids), most)

            def search(held):
                ids, count, term, doc, tf = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.argsort(term, kind="stable")
                term, doc, tf = term[order], doc[order], tf[order]
                m = 10 + 90 * count * documents // max(length, 1)
                adds = weight[term] * (10**9 * tf // (1000 * tf + 8 * m[doc]))
                shard = Shard(ids, term, doc, adds, len(weight))
                for item, query in enumerate(queries.terms):
                    shard.search(item, query, best)

            held, bytes_held, at = [], 0, 0
            for batch in batches:
                valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                ids = batch.column(0).fill_null(0).to_numpy()
                data, offsets = column_bytes(batch.column(1))
                for i, j in pieces(offsets):
                    count, term, doc, tf = postings(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], queries.vocabulary)
                    own = valid[i:j][doc]
                    held.append((ids[i:j], count, term[own], doc[own] + at, tf[own]))
                    at, bytes_held = at + j - i, bytes_held + int(offsets[j] - offsets[i])
                    if bytes_held >= shard_bytes:
                        search(held)
                        held, bytes_held, at = [], 0, 0
            if held:
                search(held)
            number = np.repeat(np.arange(len(best.score)), [len(x) for x in best.score])
            if len(number):
                task = TaskContext.get().partitionId() % GROUPS
                names = pa.array(queries.ids, pa.int64()).take(pa.array(number))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(number), task)), pa.array(number), names, pa.array(np.concatenate(best.doc)), pa.array(np.concatenate(best.score))], names=["task", "number", "item_id", "doc_id", "score"])

        if len(known):
            found = narrow.mapInArrow(run, "task long, number long, item_id long, doc_id long, score long")
            order = [F.desc("score"), F.col("doc_id")]
            for scope in (["number", "task"], ["number"]):  # the best of some tasks, and of these
                found = found.withColumn("rank", F.row_number().over(W.partitionBy(*scope).orderBy(*order))).filter(F.col("rank") <= most)
            part = found.select("item_id", "rank", "doc_id", "score")
            result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if result is None else result


SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, w, len(w)::BIGINT AS n FROM t WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
x AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score FROM p JOIN q USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 10
"""
