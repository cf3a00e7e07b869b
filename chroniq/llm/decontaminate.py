"""Benchmark decontamination by size-partitioned MinHash containment search (operator 1).

A test item with q distinct shingles is held by a document that has at least ``need = ceil(threshold * q)`` of
them. Documents may be thousands of times longer than items, so the Jaccard similarity of the two is far below what
banded MinHash finds with certainty. Items are therefore put in partitions by their size q, a partition for each power of
two, and the items of a partition get a bottom-k MinHash sketch whose k the partition's sizes set: the largest
``q - need + 1`` of its items. Of any q - need + 1 of an item's shingles, a document that holds ``need`` of them
holds one at least, so a document that meets no value of an item's sketch does not hold the item. A
partition is only searched in documents that have as many shingles as its smallest ``need``. The pairs that meet in a
sketch are the candidates, and only they are verified, by the exact containment of shingles, text by text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import LOWER, NON_ALNUM, U, byte_sums, column_bytes, gram_hash, mix, pieces, span_hash, word_spans

#: Bytes of test items that are searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20


def shingle_table(data: np.ndarray, offsets: np.ndarray, k: int, short: tuple[int, ...] = ()):
    """Start byte, end byte, document and hash of each run of k tokens of lower-cased data, and of ``short`` numbers of tokens."""
    starts, ends, doc = word_spans(data, offsets, NON_ALNUM)
    words = span_hash(byte_sums(data), starts, ends) if len(starts) else np.zeros(0, U)
    s, e, d, h = [starts[:0]], [ends[:0]], [doc[:0]], [np.zeros(0, U)]
    for n in (k, *short):
        if len(starts) >= n:
            at = np.flatnonzero(doc[: len(starts) - n + 1] == doc[n - 1 :])
            run = gram_hash(words, n)[at]
            s.append(starts[at]), e.append(ends[at + n - 1]), d.append(doc[at]), h.append(run if n == k else mix(run + U(n)))
    return np.concatenate(s), np.concatenate(e), np.concatenate(d), np.concatenate(h)


def normal(raw: bytes) -> bytes:
    return b" ".join(bytes(32 if NON_ALNUM[c] else c for c in raw).split())


class Partition:
    """Sketches of the items whose sizes are of one power of two, as an inverted list: sorted values, and the item of each."""

    def __init__(self, members: list[tuple[int, np.ndarray]], threshold: float):
        sizes = [len(hashes) for _, hashes in members]
        self.need = min(needed(q, threshold) for q in sizes)
        self.keep = max(q - needed(q, threshold) + 1 for q in sizes)
        values = np.concatenate([hashes[: self.keep] for _, hashes in members])  # hashes rise: the bottom ones
        items = np.concatenate([np.full(min(self.keep, len(hashes)), i) for i, hashes in members])
        order = np.argsort(values, kind="stable")
        self.values, self.items = values[order], items[order]

    def meet(self, doc: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Distinct (document, item) of shingles that are a sketch's value."""
        low, high = np.searchsorted(self.values, h, "left"), np.searchsorted(self.values, h, "right")
        n = high - low
        item = self.items[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return np.unique(np.stack([np.repeat(doc, n), item], axis=1), axis=0)


def needed(q: int, threshold: float) -> int:
    return math.ceil(threshold * q - 1e-9)


class Index:
    """The partitions' sketches, and each item's shingles for the verification of candidates."""

    def __init__(self, items: list[tuple[int | None, bytes]], k: int, threshold: float):
        self.k, self.ids = k, [i for i, _ in items]
        self.size, self.need = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        self.held: dict[int, tuple[np.ndarray, list[bytes]]] = {}
        partitions: dict[int, list] = {}
        short = set()
        for i, (_, text) in enumerate(items):
            data, offsets = column_bytes(pa.array([text or b""], pa.binary()))
            data = LOWER[data]
            tokens = len(word_spans(data, offsets, NON_ALNUM)[0])
            if not tokens:
                continue
            if tokens < k:  # one shingle, of all its tokens
                short.add(tokens)
                s, e, _, h = shingle_table(data, offsets, k, (tokens,))
            else:
                s, e, _, h = shingle_table(data, offsets, k)
            hashes, at = np.unique(h, return_index=True)
            self.held[i] = hashes, [normal(data[s[x] : e[x]].tobytes()) for x in at.tolist()]
            self.size[i], self.need[i] = len(hashes), needed(len(hashes), threshold)
            partitions.setdefault(len(hashes).bit_length(), []).append((i, hashes))
        self.short = tuple(sorted(short))
        self.partitions = [Partition(members, threshold) for _, members in sorted(partitions.items())]
        # bit p of a slot: partition p has a value there
        self.seen = np.zeros(1 << 22, np.uint32)
        for p, part in enumerate(self.partitions):
            self.seen[(part.values >> U(42)).astype(np.int64)] |= np.uint32(1 << p)

    def candidates(self, d: np.ndarray, h: np.ndarray, docs: int) -> np.ndarray:
        """Distinct (document, item) that meet in the sketches of a partition, of documents that are large enough for it."""
        size = np.bincount(d, minlength=docs)  # runs with their repeats, at least as many as distinct ones
        slots = self.seen[(h >> U(42)).astype(np.int64)]
        some = np.flatnonzero(slots)
        d, h, slots = d[some], h[some], slots[some]
        pairs = [np.zeros((0, 2), np.int64)]
        for p, part in enumerate(self.partitions):
            at = np.flatnonzero((slots >> np.uint32(p)) & np.uint32(1) & (size[d] >= part.need))
            pairs.append(part.meet(d[at], h[at]))
        return np.concatenate(pairs)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(document, item, shingles held) for each pair that reaches the item's threshold."""
        if not self.partitions:
            return []
        data = LOWER[data]
        s, e, d, h = shingle_table(data, offsets, self.k, self.short)
        pairs = self.candidates(d, h, len(offsets) - 1)
        if not len(pairs):
            return []
        by = np.argsort(d, kind="stable")
        out, edge = [], np.searchsorted(d[by], np.arange(len(offsets)))
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        for doc, items in zip(*groups(pairs), strict=True):
            own = by[edge[doc] : edge[doc + 1]]
            hashes, first = np.unique(h[own], return_index=True)
            for i in items.tolist():
                values, texts = self.held[i]
                place = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
                equal = np.flatnonzero(hashes[place] == values)
                if len(equal) >= self.need[i]:
                    at = own[first[place[equal]]]
                    n = sum(normal(data[s[x] : e[x]].tobytes()) == texts[y] for x, y in zip(at.tolist(), equal.tolist(), strict=True))
                    if n >= self.need[i]:
                        out.append((doc, i, n))
        return out


def groups(pairs: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The distinct first members of sorted pairs, and the second members of each."""
    first, at = np.unique(pairs[:, 0], return_index=True)
    return first.tolist(), np.split(pairs[:, 1], at[1:])


def item_blocks(items: DataFrame, id_column: str):
    """Blocks of test items of bounded size; more items make more blocks, not larger ones."""
    keyed = items.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    for b in range(n):
        yield [(r.id, bytes(r.text or b"")) for r in keyed.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == b).collect()]


def contaminated(docs: DataFrame, items: DataFrame, shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_shingles, n_held, containment of each pair where the document holds the item.

    Tokens are runs of letters, digits and non-ASCII characters, lower-cased in A-Z; an item of fewer tokens than a
    shingle is one shingle of all its tokens, wherever a text has them in a row; items or texts that are null or have
    no token hold nothing. Repeated rows give repeated pairs; empty tables none. Items are broadcast in blocks of bounded size.
    """
    sc, result = docs.sparkSession.sparkContext, None
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    for block in item_blocks(items, "item_id"):
        shared = sc.broadcast(Index(block, shingle_words, threshold))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                data, offsets = column_bytes(batch.column(1))
                found = []
                for i, j in pieces(offsets):
                    found += [(i + d, m, c) for d, m, c in index.search(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
                at = pa.array([d for d, _, _ in found], pa.int64())
                q = [int(index.size[m]) for _, m, _ in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([index.ids[m] for _, m, _ in found], pa.int64()), pa.array(q, pa.int64()), pa.array([c for *_, c in found], pa.int64()), pa.array([c / n for (*_, c), n in zip(found, q, strict=True)], pa.float64())], names=["doc_id", "item_id", "n_shingles", "n_held", "containment"])

        part = narrow.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_held long, containment double")
        result = part if result is None else result.unionByName(part)
    return result


def clean_documents(docs: DataFrame, items: DataFrame, shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, in one pass for each block of items.

    What holds an item is said at ``contaminated``. Null and empty texts hold none and stay; of rows that repeat a doc_id each
    is judged by its own text. Empty tables of documents or items: all rows stay.
    """
    sc = docs.sparkSession.sparkContext
    for block in item_blocks(items, "item_id"):
        shared = sc.broadcast(Index(block, shingle_words, threshold))
        at = docs.columns.index("text")

        def run(batches, shared=shared, at=at):
            for batch in batches:
                data, offsets = column_bytes(batch.column(at).cast(pa.binary()))
                keep = np.ones(batch.num_rows, bool)
                for i, j in pieces(offsets):
                    keep[[i + d for d, *_ in shared.value.search(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS m, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
n AS (SELECT DISTINCT least(len(w), 5) AS n FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT r, doc_id, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT r, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM t JOIN n ON len(w) >= n)),
bs AS (SELECT DISTINCT m, item_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT m, item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
q AS (SELECT m, count(*) AS n FROM bs GROUP BY m)
SELECT doc_id, item_id, any_value(n)::BIGINT AS n_shingles, count(*)::BIGINT AS n_held, count(*)::DOUBLE / any_value(n) AS containment
FROM ds JOIN bs USING (s) JOIN q USING (m) GROUP BY r, doc_id, m, item_id HAVING count(*) >= ceil(0.8 * any_value(n) - 1e-9)
"""
