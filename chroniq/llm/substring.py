"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks (operator 3).

The corpus is its own reference. Its windows of ``window`` words are dealt to reference blocks: each window has one
seed, the smallest hash of the ``SEED`` words that start in it, and lies in the block that its seed's hash names. All
occurrences of a word sequence so meet in one block, and a document has to be factored against that block only: in
no other one could a factor of ``window`` words or more begin there. A document is cut where its
seed changes; these stretches, as the hashes of their windows, are what is dealt. A seed that very many windows
share (a phrase that many documents hold) is dealt by the windows' own hashes instead, so it fills no block.

In each block the stretches are indexed by a suffix array, and each is factored greedily from left to right: at the
cursor the longest match that starts earlier in the corpus is the next factor, and the cursor moves behind its last word; without
one it moves by a word. A factor of ``window`` words or more is a duplicate span, as a whole. A window may also lie across the boundary
of two factors: each that begins in the last words of a factor is checked against the index on its own, and nothing else is. Spans end
where a stretch ends, so they are joined again at those boundaries, document by document; all windows count.

Each piece of a task's input (``PIECE_BYTES_HERE`` bytes of text) is a reference block of its own first, and its documents are factored
against it in the same way. Only the first occurrence of a window in a piece is dealt out, so a passage that a third of all
documents hold reaches its block once for each piece.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import SPACE, U, byte_sums, column_bytes, gram_hash, pieces, signed, span_hash, word_spans

#: Words of a seed; a window of w words has w - SEED + 1 of them.
SEED = 6
#: Bytes of a piece, within which repeats are resolved before anything is dealt out.
PIECE_BYTES_HERE = 6 << 20
#: Bytes that are hashed at a time.
HASH_BYTES = 1 << 20
#: Bytes of text for each reference block, about.
BLOCK_TEXT = 6 << 20
#: Windows from which on a seed is dealt by window, counted on one of so many windows; and the most such seeds.
HOT_WINDOWS, SAMPLED, HOT_SEEDS = 1 << 16, 64, 1 << 17


def windows(data: np.ndarray, offsets: np.ndarray, window: int, sampled: int = 1):
    """Document, start word, hash and seed hash of each window, or of one of so many by the hash of its first words."""
    starts, ends, doc = word_spans(data, offsets, SPACE)
    n = len(starts) - window + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        return e, e, e.astype(U), e.astype(U)
    words = span_hash(byte_sums(data), starts, ends)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    pos = np.arange(len(starts)) - (np.cumsum(count) - count)[doc]
    full = np.flatnonzero(doc[:n] == doc[window - 1 :])
    seeds = gram_hash(words, SEED)
    span = window - SEED + 1
    low = seeds.copy()  # smallest of ever longer runs: of 2, 4, 8 and then of span
    size = 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(seeds) - span + 1], low[span - size : span - size + len(seeds) - span + 1])
    if sampled > 1:
        full = full[seeds[full] % U(sampled) == 0]
        return doc[full], pos[full], seeds[full], low[full]
    return doc[full], pos[full], gram_hash(words, window)[full], low[full]


def twins(*identity: np.ndarray) -> np.ndarray:
    """Marks each window whose identity occurs more than once."""
    by = np.argsort(identity[0], kind="stable")
    s = identity[0][by]
    out = np.zeros(len(s), bool)
    if len(s):
        same = s[1:] == s[:-1]
        out[by[1:][same]] = out[by[:-1][same]] = True
    rows = np.flatnonzero(out)
    if len(rows):
        rows = rows[np.lexsort([i[rows] for i in identity])]
        same = np.all([i[rows[1:]] == i[rows[:-1]] for i in identity], axis=0)
        out[rows] = np.append(same, False) | np.append(False, same)
    return out


def numbers(*identity: np.ndarray) -> np.ndarray:
    """The rank of each row's identity among the distinct ones."""
    order = np.lexsort(identity[::-1])
    new = np.zeros(len(order), bool)
    for x in identity:
        new[1:] |= x[order][1:] != x[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ... of n each."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def runs(doc: np.ndarray, pos: np.ndarray, *also: np.ndarray) -> np.ndarray:
    """Where a run of consecutive windows of one document begins."""
    new = np.ones(len(doc), bool)
    if len(doc):
        new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
        for x in also:
            new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


NAMES = ["block", "doc", "start", "count", "seed", "low", "high"]
SCHEMA = "block int, doc binary, start binary, count binary, seed binary, low binary, high binary"


def packed(ids: np.ndarray, pos: np.ndarray, h: np.ndarray, seed: np.ndarray, blocks: int, hot: np.ndarray) -> pa.RecordBatch:
    """A row for each block: its stretches (document, start, number of windows, 32 bits of the seed) and 48 bits of each window's hash.

    A window whose seed is among ``hot`` (which rises) is a stretch of its own, dealt by its own hash.
    """
    alone = hot[np.minimum(np.searchsorted(hot, seed), len(hot) - 1)] == seed if len(hot) else np.zeros(len(seed), bool)
    at = runs(ids, pos, seed, np.where(alone, np.arange(len(seed)), -1))
    n = np.diff(np.append(at, len(ids)))
    block = (np.where(alone[at], h[at], seed[at]) % U(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    at, n, block = at[order], n[order], block[order]
    which = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    low, high = (h[which] & U(0xFFFFFFFF)).astype(np.uint32), (h[which] >> U(48)).astype(np.uint16)
    d, s, c, e = ids[at], pos[at].astype(np.int32), n.astype(np.int32), (seed[at] >> U(32)).astype(np.uint32)
    present, first = np.unique(block, return_index=True)
    edge = np.append(first, len(block))
    wedge = np.concatenate([[0], np.cumsum(n)])[edge]
    cols = [pa.array(present.astype(np.int32))]
    cols += [pa.array([x[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()) for x in (d, s, c, e)]
    cols += [pa.array([x[a:b].tobytes() for a, b in zip(wedge[:-1], wedge[1:], strict=True)], pa.binary()) for x in (low, high)]
    return pa.RecordBatch.from_arrays(cols, names=NAMES)


def known(ids: np.ndarray, start: np.ndarray, n: np.ndarray, blocks: int) -> pa.RecordBatch:
    """Spans of windows that are duplicates already, as rows without hashes, dealt out by the document's id."""
    block = (np.abs(ids) % blocks).astype(np.int32)
    order = np.argsort(block, kind="stable")
    ids, start, n, block = ids[order], start[order].astype(np.int32), n[order].astype(np.int32), block[order]
    present, first = np.unique(block, return_index=True)
    edge = np.append(first, len(block))
    cols = [pa.array(present.astype(np.int32))]
    cols += [pa.array([x[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()) for x in (ids, start, n)]
    cols += [pa.nulls(len(present), pa.binary()) for _ in range(3)]
    return pa.RecordBatch.from_arrays(cols, names=NAMES)


def hot_seeds(narrow: DataFrame, window: int) -> np.ndarray:
    """The seeds that ``HOT_WINDOWS`` windows or more seem to have, rising, the most frequent ``HOT_SEEDS`` of them.

    Counted over all texts on a sample of windows by the hash of their first words. Which seeds are hot decides
    where windows meet, never whether they do.
    """

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in pieces(offsets, HASH_BYTES):
                seeds, n = np.unique(windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, SAMPLED)[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(seeds)), pa.array(n)], names=["seed", "n"])

    counts = narrow.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") * SAMPLED >= HOT_WINDOWS).orderBy(F.desc("n"), "seed").limit(HOT_SEEDS).select("seed").collect()
    return np.sort(np.array([r.seed for r in rows], np.int64).view(U))


def dealt(narrow: DataFrame, window: int) -> DataFrame:
    """The stretches of all documents, packed for their blocks, and the runs that are duplicates within a piece."""
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(64, size // BLOCK_TEXT)
    hot = narrow.sparkSession.sparkContext.broadcast(hot_seeds(narrow, window))

    def stretches(batches):
        def flush(got):
            ids, pos, h, seed, row = (np.concatenate(x) for x in zip(*got, strict=True))
            again = np.flatnonzero(twins(h, seed))  # only what occurs again can be part of a factor
            at, n = duplicates(parse(Index(row[again], pos[again], numbers(ids[again], pos[again]), numbers(h[again], seed[again])), window))
            dup = np.zeros(len(ids), bool)
            dup[again[spread(at, n)]] = True
            if len(at):
                yield known(ids[again[at]], pos[again[at]], n, blocks)
            if not dup.all():
                yield packed(ids[~dup], pos[~dup], h[~dup], seed[~dup], blocks, hot.value)

        held, bytes_held, rows = [], 0, 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in pieces(offsets, HASH_BYTES):
                d, pos, h, seed = windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window)
                held.append((doc_ids[i + d], pos, h, seed, rows + d))
                rows += j - i
                bytes_held += int(offsets[j] - offsets[i])
                if bytes_held >= PIECE_BYTES_HERE:
                    yield from flush(held)
                    held, bytes_held = [], 0
        if held:
            yield from flush(held)

    return narrow.mapInArrow(stretches, SCHEMA)


def nearest_smaller(v: np.ndarray) -> np.ndarray:
    """The nearest place before each that holds a smaller value, or -1."""
    low, at = [v], np.arange(len(v)) - 1
    while 1 << len(low) <= len(v):  # the least of the last 1, 2, 4, ... values
        step, x = 1 << (len(low) - 1), low[-1].copy()
        x[step:] = np.minimum(x[step:], low[-1][:-step])
        low.append(x)
    for k in range(len(low) - 1, -1, -1):
        some = np.flatnonzero(at >= 0)
        at[some[low[k][at[some]] >= v[some]]] -= 1 << k
    return np.maximum(at, -1)


class Index:
    """A suffix array over the stretches of a block, as strings of windows.

    ``of`` is the stretch, ``pos`` the start word and ``place`` the rank in the corpus (of document and start) of each window;
    windows of one stretch that follow each other in the text are adjacent, stretch after stretch, and ``window`` holds their identities.
    """

    def __init__(self, of: np.ndarray, pos: np.ndarray, place: np.ndarray, window: np.ndarray):
        n = len(of)
        self.of, self.pos, self.place = of, pos, place.astype(np.int32)
        ends = np.append((of[1:] != of[:-1]) | (pos[1:] != pos[:-1] + 1), True) if n else np.zeros(0, bool)
        self.left = np.repeat(np.flatnonzero(ends), np.diff(np.flatnonzero(ends), prepend=-1)) - np.arange(n) + 1
        # ranks of the next 1, 2, 4, ... windows, or fewer where the string ends
        self.ranks, step = [window.astype(np.int32)], 1
        while n and step < int(self.left.max()):
            rank = self.ranks[-1]
            more = np.flatnonzero(self.left > step)
            second = np.zeros(n, np.int64)
            second[more] = rank[more + step].astype(np.int64) + 1
            self.ranks.append(np.unique(rank * np.int64(n + 1) + second, return_inverse=True)[1].astype(np.int32))
            step *= 2
        self.order = np.lexsort((place, self.ranks[-1]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of windows that the strings from a and from b begin with alike."""
        out, a, b, open_ = np.zeros(len(a), np.int64), a.copy(), b.copy(), np.ones(len(a), bool)
        for k in range(len(self.ranks) - 1, -1, -1):
            at = np.flatnonzero(open_)
            at = at[self.ranks[k][a[at]] == self.ranks[k][b[at]]]
            n = np.minimum(1 << k, self.left[a[at]])
            out[at] += n
            open_[at] = (self.left[a[at]] > n) & (self.left[b[at]] > n)
            at = at[open_[at]]
            a[at] += 1 << k
            b[at] += 1 << k
        return out

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """Windows and source of each window's longest match that starts earlier in the corpus; no match: 0.

        The best source is one of the nearest in suffix order, to either side, that lie earlier.
        """
        best, source = np.zeros(len(self.of), np.int64), np.full(len(self.of), -1)
        for side in (self.order, self.order[::-1]):
            near = nearest_smaller(self.place[side])
            at, j = side[near >= 0], side[near[near >= 0]]
            m = self.common(at, j)
            more = m > best[at]
            best[at[more]], source[at[more]] = m[more], j[more]
        return best, source


def parse(index: Index, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and source of each factor of all stretches; and the duplicate windows across their boundaries.

    A factor of m windows has m + window - 1 words, and the next one begins behind them; the windows between, which lie
    across the boundary, are looked up one by one. All stretches are parsed side by side, a factor of each at a time.
    """
    best, source = index.longest()
    hits = np.flatnonzero(best)  # the cursor passes by where nothing matches
    of, pos, m = index.of[hits].astype(np.int64), index.pos[hits].astype(np.int64), best[hits]
    if not len(hits):
        return hits, m, hits, hits
    scale = int((pos + m).max()) + window
    lands = np.searchsorted(of * scale + pos, of * scale + pos + m + window - 1)
    lands[(lands < len(of)) & (of[np.minimum(lands, len(of) - 1)] != of)] = len(of)
    cursor, begun = np.flatnonzero(np.append(True, of[1:] != of[:-1])), []
    while len(cursor):
        begun.append(cursor)
        cursor = lands[cursor]
        cursor = cursor[cursor < len(of)]
    factor = np.sort(np.concatenate(begun))
    last = factor[np.searchsorted(factor, np.arange(len(of)), "right") - 1]  # a stretch begins with a factor
    across = hits[pos >= pos[last] + m[last]]
    return hits[factor], m[factor], source[hits[factor]], across


def duplicates(parsed: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each duplicate span: the factors, and the windows across their boundaries."""
    first, m, _, across = parsed
    return np.concatenate([first, across]), np.concatenate([m, np.ones(len(across), np.int64)])


def duplicate_runs(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, start, n: runs of n consecutive windows, from word ``start``, that start earlier in the corpus."""
    narrow = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def factor(t: pa.Table) -> pa.Table:
        def flat(rows: pa.Table, name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(x.as_py() for x in rows[name]), kind)

        done = t.filter(pc.is_null(t["low"]))
        out_ids, out_start, out_n = flat(done, "doc", np.int64), flat(done, "start", np.int32), flat(done, "count", np.int32)
        rest = t.filter(pc.is_valid(t["low"]))
        n = flat(rest, "count", np.int32).astype(np.int64)
        of = np.repeat(np.arange(len(n)), n)
        ids, start = np.repeat(flat(rest, "doc", np.int64), n), np.repeat(flat(rest, "start", np.int32), n)
        pos = (start + np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int64)
        seed = np.repeat(flat(rest, "seed", np.uint32), n)
        key = flat(rest, "low", np.uint32).astype(U) | (flat(rest, "high", np.uint16).astype(U) << U(32)) | (seed.astype(U) << U(48))
        # only what occurs again can be part of a factor
        again = np.flatnonzero(twins(key, seed))
        ids, pos, of = ids[again], pos[again], of[again]
        at, n = duplicates(parse(Index(of, pos, numbers(ids, pos), numbers(key[again], seed[again])), window))
        return pa.table({"doc_id": np.concatenate([out_ids, ids[at]]), "start": np.concatenate([out_start, pos[at]]).astype(np.int32), "n": np.concatenate([out_n, n]).astype(np.int32)})

    return dealt(narrow, window).groupBy("block").applyInArrow(factor, "doc_id long, start int, n int")


def dedup_substrings(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (binary) of each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged, of the whole text. Each word is removed that lies in a window of
    ``window`` words whose sequence also starts earlier: in a document of a smaller id, or in the same document further
    left. Windows are judged on the input. Null and empty texts have no words; texts shorter than a window, and rows
    whose doc_id is null, keep all of theirs and are no reference. Rows that repeat a doc_id are one document: equal
    ones get the same result, and what is removed at a place is removed there in all. Windows are told apart by 80
    bits of two hashes.
    """
    found = duplicate_runs(docs, window)
    spans = found.groupBy(F.col("doc_id").alias("span_id")).agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    joined = text.join(spans, text.doc_id == spans.span_id, "left").select("doc_id", "text", "spans.start", "spans.n")

    def cut(batches):
        for batch in batches:
            out = ([], [], [], [])
            for raw, start, n in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                words = (raw.as_py() or b"").split()
                total = len(words)
                if start.is_valid and len(start):
                    a, n = start.values.to_numpy(), n.values.to_numpy()
                    edge = np.zeros(total + 1, np.int64)
                    np.add.at(edge, np.minimum(a, total), 1)
                    np.add.at(edge, np.minimum(a + n + window - 1, total), -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                kept = b" ".join(words)
                out[0].append(total), out[1].append(total - len(words)), out[2].append(hashlib.sha256(kept).hexdigest()), out[3].append(kept)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.binary())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text binary")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM x),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM r WHERE n > 1),
k AS (SELECT d.doc_id, j, w[j] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d) d ANTI JOIN c USING (doc_id, j)),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM k GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id)
"""
