"""Non-negative positive-unlabelled learning of additive models in numpy (operators 5 and 8)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample: positives, unlabelled texts, and bytes of a text that is taken for training.
POSITIVES, UNLABELLED, TEXT_BYTES = 2_000, 4_000, 24_000


def learnable(doc_id, of: int = 3, held_out: int = 1):
    """Rows to learn from: crc32 of the id as text, modulo ``of``, is not ``held_out``."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of)) != held_out, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, positives: int = POSITIVES, unlabelled: int = UNLABELLED, text_bytes: int = TEXT_BYTES):
    """Texts of positives, texts of unlabelled documents, and the class prior, from the rows to learn from.

    The prior is the share of positives among all labelled rows to learn from; contradicting rows of a document count
    as its larger label. Both text samples are the first by a hash of doc_id, up to their bounds, of texts of at most
    ``text_bytes`` bytes: scoring has no such bound. Without a positive's text there is nothing to learn: two empty lists
    and 0. An empty unlabelled sample beside positives would leave a model untrained, so it fails.
    """
    own = labels.filter(F.col(label).isin(0, 1) & learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("y"))
    n, n_positive = own.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not n_positive:
        return [], [], 0.0
    chosen = own.filter("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives + positives // 4).select("doc_id")
    texts = docs.filter(learnable(F.col("doc_id"))).select("doc_id", F.col("text").cast("binary").alias("text")).filter(F.octet_length("text") <= text_bytes)
    # the broadcast holds a quarter more ids than positives at most, and so do the texts that reach the driver
    p = [bytes(r.text) for r in texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(positives).collect()]
    if not p:
        return [], [], 0.0
    some = texts.filter(kept_by_hash(texts.count(), unlabelled))
    u = [bytes(r.text) for r in some.orderBy(F.xxhash64("doc_id", F.lit(8)), "text").limit(unlabelled).collect()]
    if not u:
        raise ValueError(f"no unlabelled text of at most {text_bytes} bytes to learn from, beside {len(p)} positives")
    return p, u, float(n_positive) / n


def kept_by_hash(rows: int, wanted: int) -> Column:
    """Keeps about a quarter more of ``rows`` than are wanted, by 53 bits of a hash of doc_id: all of few rows."""
    share = min(1.0, 1.25 * wanted / max(rows, 1))
    return F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 53)) < F.lit(math.ceil(share * (1 << 53)))


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two terms of the unbiased risk of margins with the logistic loss; the second may fall below 0 for a sample."""
    return prior * float(np.mean(np.logaddexp(0, -zp))), float(np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp)))


def slopes(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What the step descends, by margin: the gradient of the risk, or of its second term's negative where that is below 0."""
    sp, su = sigmoid(zp), sigmoid(zu)
    if risk(zp, zu, prior)[1] >= 0:
        gp, gu = prior * (sp - 1) - prior * sp, su
    else:
        gp, gu = prior * sp, -su
    return gp / len(zp), gu / len(zu)


def fit(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 1000, rate: float = 0.05, decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative unbiased risk with the logistic loss.

    The risk is prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)]). Where the second term is below 0 for the
    samples, the step descends its negative instead, which undoes overfitting. Full batches, Adam, fixed start: reruns agree.
    """
    w, b = np.zeros(xp.shape[1], np.float32), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        zp, zu = xp @ w + b, xu @ w + b
        gp, gu = slopes(zp, zu, prior)
        g = np.append(xp.T @ gp.astype(np.float32) + xu.T @ gu.astype(np.float32) + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - step[-1]
    return w, float(b)


def shift(z: np.ndarray, prior: float, threshold: float) -> float:
    """What to add to margins so that ``threshold`` cuts the unlabelled sample at the class prior.

    The cut is the widest gap between the sample's margins whose rank is within three standard errors of the prior.
    """
    z = np.sort(z)
    n = len(z)
    error = 3 * np.sqrt(prior * (1 - prior) / n)
    low, high = (int(np.clip((1 - prior + e) * n, 1, n - 1)) for e in (-error, error))
    gap = z[low : high + 1] - z[low - 1 : high]
    k = low + int(gap.argmax())
    return float(np.log(threshold / (1 - threshold)) - (z[k] + z[k - 1]) / 2)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
