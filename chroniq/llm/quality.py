"""Quality by non-negative positive-unlabelled learning on the shape and the words of whole texts (operator 8).

A text's features are its measures, each in bins of one weight, and the hashed counts of its words and pairs of words, as
a vector of length 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm import pu
from chroniq.llm.common import LOWER, NON_ALNUM, SPACE, U, byte_sums, column_bytes, gram_hash, pieces, span_hash, word_spans

#: Equally filled bins of each measure, one weight each.
BINS = 16
#: Texts whose features are held at a time.
ROWS = 4_096
#: Columns of hashed words and pairs of words.
GRAMS = 512
#: Classes of bytes whose shares are measures (fixed values).
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".", "comma": b",", "bang": b"!?", "bar": b"|", "sign": b"#$%&*@^~+=<>/\\_{}[]", "dash": b"-:;()'\"", "feed": b"\n", "blank": b" \t"}


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of measures for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    per_byte = np.maximum(size, 1)
    of_byte = np.full(256, len(CLASSES), np.int64)
    for k, members in enumerate(CLASSES.values()):
        of_byte[list(members)] = k
    doc_of = np.repeat(np.arange(n), size)
    kinds = len(CLASSES) + 1
    shares = np.bincount(doc_of * kinds + of_byte[data], minlength=n * kinds).reshape(n, kinds) / per_byte[:, None]
    starts, ends, doc = word_spans(data, offsets, SPACE)
    words = np.bincount(doc, minlength=n)
    per_word = np.maximum(words, 1)
    length = ends - starts
    h = span_hash(byte_sums(data), starts, ends)
    same_doc = doc[1:] == doc[:-1]
    repeat = np.bincount(doc[1:][same_doc & (h[1:] == h[:-1])], minlength=n) / per_word
    order = np.lexsort((h, doc))
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (h[order][1:] != h[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=n)
    line_starts, line_ends, line_doc = word_spans(data, offsets, _FEED)
    lh = span_hash(byte_sums(data), line_starts, line_ends)
    lines = np.bincount(line_doc, minlength=n)
    order = np.lexsort((lh, line_doc))
    new = np.ones(len(order), bool)
    new[1:] = (line_doc[order][1:] != line_doc[order][:-1]) | (lh[order][1:] != lh[order][:-1])
    distinct_lines = np.bincount(line_doc[order][new], minlength=n)
    last = data[ends - 1] if len(ends) else data[:0]
    odd = _WORD_END[last]
    mean = np.bincount(doc, length, minlength=n) / per_word
    square = np.bincount(doc, length.astype(float) ** 2, minlength=n) / per_word
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    cols = [shares, np.log1p(words)[:, None], (distinct / per_word)[:, None], (np.log1p(distinct) / np.log1p(per_word))[:, None], repeat[:, None], mean[:, None], np.sqrt(np.maximum(square - mean**2, 0))[:, None], np.log1p(longest)[:, None], (np.bincount(doc, odd, minlength=n) / per_word)[:, None], (lines / per_word)[:, None], (distinct_lines / np.maximum(lines, 1))[:, None], (shares[:, 0] / np.maximum(shares[:, 0] + shares[:, 1], 1e-9))[:, None]]
    return np.hstack(cols)


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed counts of the words and the pairs of words of each text, lower-cased in A-Z, as vectors of length 1 (of no words: 0)."""
    n = len(offsets) - 1
    data = LOWER[data]
    starts, ends, doc = word_spans(data, offsets, NON_ALNUM)
    out = np.zeros(n * GRAMS)
    if len(starts):
        words = span_hash(byte_sums(data), starts, ends)
        inside = doc[1:] == doc[:-1]
        rows = np.concatenate([doc, doc[1:][inside]])
        out = np.bincount(rows * GRAMS + (np.concatenate([words, gram_hash(words, 2)[inside]]) % U(GRAMS)).astype(np.int64), minlength=n * GRAMS)
    x = out.reshape(n, GRAMS).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1)


_FEED = np.zeros(256, bool)
_FEED[10] = True
_WORD_END = np.zeros(256)
_WORD_END[list(b"!#$%&*|=+~^<>")] = 1


class Model:
    """An additive model: each measure's bin has a weight."""

    def __init__(self, positive: list[bytes], unlabelled: list[bytes], prior: float, threshold: float = 0.5):
        self.edges, self.weights, self.bias, self.prior = None, np.zeros(0, np.float32), 0.0, prior
        if not positive or not unlabelled:
            return
        mp, mu = self.of_texts(positive, measures), self.of_texts(unlabelled, measures)
        # half of the edges by each sample, so that what is rare in one has bins too
        cut = np.linspace(0, 1, BINS // 2 + 1)[1:-1]
        low = np.quantile(mp, [0.002, 0.01, 0.03, 0.97, 0.99, 0.998], axis=0)
        self.edges = np.sort(np.vstack([np.quantile(mu, cut, axis=0), low]), axis=0)
        xu = np.hstack([self.one_hot(mu), self.of_texts(unlabelled, grams)])
        self.weights, self.bias = pu.fit(np.hstack([self.one_hot(mp), self.of_texts(positive, grams)]), xu, prior)
        if len(xu) > 1 and prior < 1:
            self.bias += pu.shift(xu @ self.weights + self.bias, prior, threshold)

    @staticmethod
    def of_texts(texts: list[bytes], kind) -> np.ndarray:
        data, offsets = column_bytes(pa.array(texts, pa.binary()))
        return np.vstack([kind(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in pieces(offsets)])

    def one_hot(self, m: np.ndarray) -> np.ndarray:
        bins = len(self.edges) + 1
        x = np.zeros((len(m), m.shape[1] * bins), np.float32)
        for k in range(m.shape[1]):
            x[np.arange(len(m)), k * bins + np.searchsorted(self.edges[:, k], m[:, k], "left")] = 1
        return x

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.prior)
        if self.edges is None:
            return out
        for i, j in pieces(offsets):
            part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            for k in range(0, j - i, ROWS):
                edge = at[k : k + ROWS + 1]
                own = part[edge[0] : edge[-1]]
                z = self.one_hot(measures(own, edge - edge[0])) @ self.weights[:-GRAMS] + grams(own, edge - edge[0]) @ self.weights[-GRAMS:]
                out[i + k : i + k + len(edge) - 1] = pu.sigmoid(z + self.bias)
        return out


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``.

    Positives are trusted, everything else is unlabelled; the class prior is estimated from the labelled rows to learn
    from. Null and empty texts score as a text of no words; without labelled positives every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model(*pu.sample(docs, labels, label), threshold))

    def run(batches):
        for batch in batches:
            score = shared.value.score(*column_bytes(batch.column(2))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~pu.learnable(F.col("doc_id"))).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
