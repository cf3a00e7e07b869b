"""Language identification by blended-spectrum string kernels (operator 9).

The kernel of two texts is the mean over n = 1..4 of the cosine of their sets of byte n-grams (presence, not counts;
A-Z lower-cased; 3- and 4-grams by hash). Some texts of the training sample are landmarks; kernel ridge regression, one language
against the rest, is solved in the Nyström space of the landmarks. Texts are scored in batches: a presence matrix times
the landmarks' matrix gives the kernels, and those times the dual weights give the languages' scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import LOWER, column_bytes, materialize, pieces
from chroniq.llm.pu import learnable

#: Columns of the presence matrix for each n.
WIDTHS = (256, 2048, 4096, 4096)
#: Texts to learn from (shared among the languages, one for each at least), their bytes, and the ridge.
TEXTS, TEXT_BYTES, RIDGE = 3_000, 12_000, 1e-2
#: Landmarks for each language, and of all languages together: of more languages, as many of them have one.
LANDMARKS, ALL_LANDMARKS = 40, 1_024
#: Languages that are learned at most, the most frequent ones: the sample has a text of each, 100 MB in all.
LANGUAGES = 8_192
#: Texts whose presence is held at a time.
ROWS = 512


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 / sqrt(n-grams of that n in the text * number of n), so that products are kernels."""
    n = len(offsets) - 1
    x = np.zeros((n, sum(WIDTHS)), np.float32)
    if not len(data):
        return x
    data = LOWER[data]
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    flat = x.ravel()
    at = 0
    for k, width in enumerate(WIDTHS, 1):
        m = len(data) - k + 1
        if m > 0:
            code = data[:m].astype(np.uint32)
            for i in range(1, k):
                code = (code << np.uint32(8)) | data[i : m + i]
            if k > 1:
                code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(np.log2(width)))
            inside = doc[:m] == doc[k - 1 :]
            flat[(doc[:m] * x.shape[1] + at + code)[inside]] = 1
        part = x[:, at : at + width]
        part /= np.sqrt(np.maximum(part.sum(1, keepdims=True), 1) * len(WIDTHS))
        at += width
    return x


class Model:
    """Landmarks and dual weights of each language."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        data, offsets = column_bytes(pa.array(texts, pa.binary()))
        number = {lang: k for k, lang in enumerate(self.langs)}
        y = np.array([number[x] for x in langs])
        each = max(1, min(LANDMARKS, ALL_LANDMARKS // len(self.langs)))
        marks = np.sort(np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(self.langs))]))
        marks = marks if len(marks) <= ALL_LANDMARKS else marks[np.linspace(0, len(marks) - 1, ALL_LANDMARKS).astype(np.int64)]
        self.landmarks = np.vstack([presence(data[offsets[i] : offsets[i + 1]], offsets[i : i + 2] - offsets[i]) for i in marks])
        kernel = np.vstack([presence(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) @ self.landmarks.T for i, j in self.blocks(offsets)]).astype(np.float64)
        values, vectors = np.linalg.eigh(kernel[marks])
        values = np.maximum(values, 1e-6)
        root = vectors / np.sqrt(values) @ vectors.T
        phi = np.hstack([kernel @ root, np.ones((len(y), 1))])
        target = np.where(y[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        # each language weighs the same, however many texts it has
        weight = 1 / np.bincount(y, minlength=len(self.langs))[y]
        a = (phi * weight[:, None]).T
        solved = np.linalg.solve(a @ phi + RIDGE * np.diag(np.append(np.ones(len(root)), 1e-6)), a @ target)
        self.dual = (root @ solved[:-1]).astype(np.float32)
        self.bias = solved[-1].astype(np.float32)

    @staticmethod
    def blocks(offsets: np.ndarray):
        for i, j in pieces(offsets):
            for k in range(i, j, ROWS):
                yield k, min(j, k + ROWS)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, score = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
        for i, j in self.blocks(offsets):
            margin = (presence(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) @ self.landmarks.T) @ self.dual + self.bias
            best[i:j] = margin.argmax(1)
            e = np.exp(3.0 * (margin - margin.max(1, keepdims=True)))
            score[i:j] = 1 / e.sum(1)
        return best, score


def sample(docs: DataFrame, texts: int = TEXTS, text_bytes: int = TEXT_BYTES) -> tuple[list[bytes], list[str]]:
    """The first texts of each language by a hash of doc_id and text, of rows to learn from, up to the bounds.

    One pass counts the languages' texts of 1 to ``text_bytes`` bytes, a second one picks of all languages at once. Every
    language of the ``LANGUAGES`` most frequent is learned that has a text that is not empty: its shortest one is always of the sample, also
    where all are longer than the bound or its rows repeat a few texts. What reaches the driver is bounded by these parameters.
    """
    own = docs.filter(learnable(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    size = F.octet_length("text")
    row = F.xxhash64("doc_id", "text")
    place = F.struct(size.alias("size"), row.alias("row"))
    own = own.filter(size > 0)
    every = own.groupBy("lang").agg(F.count(F.lit(1)).alias("all"), F.count(F.when(size <= text_bytes, 1)).alias("n"), F.min(place).alias("shortest"))
    seen = materialize(every.orderBy(F.desc("all"), "lang").limit(LANGUAGES), "languages")
    langs = seen.count()
    if not langs:
        return [], []
    each = max(1, texts // langs)
    number = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 53))
    drawn = (size <= text_bytes) & (number < F.lit(3.0 * each * (1 << 53)) / F.greatest("n", F.lit(1)))
    some = own.join(F.broadcast(seen), "lang").filter(drawn | (place == F.col("shortest")))
    # the shortest text first, cut where it is longer than the bound
    order = F.row_number().over(W.partitionBy("lang").orderBy(F.when(place == F.col("shortest"), 0).otherwise(1), row))
    rows = some.select("lang", F.substring("text", 1, text_bytes).alias("text"), order.alias("k")).filter(F.col("k") <= each).select("lang", "text").collect()
    rows.sort(key=lambda r: (r.lang, r.text))
    return [bytes(r.text) for r in rows], [r.lang for r in rows]


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of ``docs``.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text if no language can be
    learned. The score is the softmax of the regressions' margins. Of the rows to learn from the 8,192 most frequent languages are learned; a
    null lang, doc_id or text is nothing to learn from. Rows that repeat a doc_id are rows of their own.
    """
    model = Model(*sample(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            text = batch.column(2)
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if m.langs:
                best, score = m.predict(*column_bytes(text.cast(pa.binary())))
                lang = np.array(m.langs, object)[best]
            else:
                lang, score, letters = np.full(len(text), "und", object), np.zeros(len(text)), np.zeros(len(text), bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.where(letters, lang, "und"), pa.string()), pa.array(np.where(letters, score, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~learnable(F.col("doc_id"), 4, 2)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
