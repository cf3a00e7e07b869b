"""Toxicity by non-negative positive-unlabelled learning (operator 5)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm import pu
from chroniq.llm.common import LOWER, NON_ALNUM, U, byte_sums, column_bytes, mix, pieces, span_hash, word_spans

#: Bytes of the beginnings of words that are features, beside whole words, and the features that are kept.
STEMS, FEATURES = (3, 4, 5, 6, 7, 8, 10), 1024
#: A feature is kept if positives hold it so many times as often as unlabelled texts, corrected by the prior.
LEAST_RATIO = 4.0


def features(data: np.ndarray, offsets: np.ndarray):
    """Document and 64-bit hash of each word and each beginning of a word, of whole texts lower-cased in A-Z."""
    data = LOWER[data]
    starts, ends, doc = word_spans(data, offsets, NON_ALNUM)
    sums = byte_sums(data)
    ds, hs = [doc], [span_hash(sums, starts, ends)]
    for n in STEMS:
        long = np.flatnonzero(ends - starts >= n)
        ds.append(doc[long])
        hs.append(mix(span_hash(sums, starts[long], starts[long] + n) + U(n)))
    return np.concatenate(ds), np.concatenate(hs)


def per_text(texts: list[bytes], among: np.ndarray | None = None):
    """Distinct (document, hash) of a list of texts, of the sorted hashes ``among`` only if they are given."""
    data, offsets = column_bytes(pa.array(texts, pa.binary()))
    ds, hs = [], []
    for i, j in pieces(offsets):
        d, h = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        if among is not None:
            ok = among[np.minimum(np.searchsorted(among, h), len(among) - 1)] == h
            d, h = d[ok], h[ok]
        order = np.lexsort((h, d))
        d, h = d[order], h[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
        ds.append(d[new] + i), hs.append(h[new])
    return (np.concatenate(ds), np.concatenate(hs)) if ds else (np.zeros(0, np.int64), np.zeros(0, U))


class Model:
    """Weights of the presence of features."""

    def __init__(self, positive: list[bytes], unlabelled: list[bytes], prior: float, threshold: float = 0.7):
        self.hashes, self.weights, self.bias = np.zeros(0, U), np.zeros(0, np.float32), -5.0
        if not positive or not unlabelled:
            return
        known, cp = np.unique(per_text(positive)[1], return_counts=True)
        often = cp >= max(2, len(positive) * 0.002)
        known, cp = known[often], cp[often]
        if not len(known):
            return
        du, hu = per_text(unlabelled, known)
        place = np.searchsorted(known, hu)
        cu = np.bincount(place, minlength=len(known)) / len(unlabelled)
        share = cp / len(positive)
        clean = np.maximum(cu - prior * share, 0)  # the share among negatives, as the prior corrects it
        ratio = share / (clean + 0.5 / len(unlabelled))
        gain = np.where(ratio >= LEAST_RATIO, share * np.log(ratio), 0)
        best = np.flatnonzero(gain > 0)
        best = best[np.lexsort((known[best], -gain[best]))][:FEATURES]
        self.hashes = np.sort(known[best])
        if len(self.hashes):
            xu = self.matrix(du, hu, len(unlabelled))
            self.weights, self.bias = pu.fit(self.matrix(*per_text(positive, self.hashes), len(positive)), xu, prior)
            if len(xu) > 1 and prior < 1:
                self.bias += pu.shift(xu @ self.weights + self.bias, prior, threshold)

    def matrix(self, doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        x = np.zeros((n, len(self.hashes)), np.float32)
        doc, place = self.find(doc, h)
        x[doc, place] = 1
        return x

    def find(self, doc: np.ndarray, h: np.ndarray):
        if not len(self.hashes):
            return doc[:0], doc[:0]
        place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        ok = self.hashes[place] == h
        return doc[ok], place[ok]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        seen = np.zeros(1 << 16, bool)
        seen[(self.hashes >> U(48)).astype(np.int64)] = True
        out = np.zeros(len(offsets) - 1)
        for i, j in pieces(offsets):
            d, h = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            maybe = seen[(h >> U(48)).astype(np.int64)]
            d, place = self.find(d[maybe], h[maybe])
            pair = np.unique(d * np.int64(len(self.hashes) + 1) + place)
            d, place = np.divmod(pair, len(self.hashes) + 1)
            out[i:j] = np.bincount(d, self.weights[place], minlength=j - i)
        return pu.sigmoid(out + self.bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.7) -> Model:
    """Fit on a bounded sample, see pu.sample, for a decision at ``threshold``. No labelled positives: all scores are below 0.01."""
    return Model(*pu.sample(docs, labels, label), threshold)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of each row; null and empty texts score as a text without features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = shared.value.score(*column_bytes(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~pu.learnable(F.col("doc_id"))).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns.

    Null and empty texts score as a text without features; repeated rows are judged alike; an empty table stays empty.
    """
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(*column_bytes(batch.column(at).cast(pa.binary()))) < threshold))

    return docs.mapInArrow(run, docs.schema)
