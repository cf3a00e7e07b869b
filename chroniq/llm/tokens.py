"""Token-ID output: Parquet list columns with controlled row groups and page indexes (operator 6)."""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import U, column_bytes, mix, pieces, scratch_path

#: Parquet settings: row groups of 16 MB, pages of at most 256 KB or 512 documents; version 2 pages bring delta encoding.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 256 << 10, 512
#: Files up to which the table of their sizes is broadcast; beyond, the join shuffles.
BROADCAST_FILES = 500_000
#: Bytes of text for each file.
FILE_TEXT = 32 << 20
#: Spans of bytes whose ids a worker remembers: the most that stay, and the largest that is kept by its bytes.
MEMORY, SPAN_BYTES = 1 << 19, 16
#: Bytes of new spans that the tokenizer encodes at a time.
NEW_BYTES = 1 << 13

#: Kinds of bytes (fixed values): blank and line feed; other controls; the leads of white space beyond ASCII; "<".
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(32), 127]] = 2
_KIND[[0x20, 0x0A]] = 1
_KIND[[0xC2, 0xE1, 0xE2, 0xE3, 0x3C]] = 4
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)

_encoders: dict[str, "Encoder"] = {}


class Known:
    """Ids of spans of up to 16 bytes that a worker has met, told apart by all their bytes.

    A span lies in one of two slots. When there are more than ``MEMORY`` spans, those that were used last stay.
    """

    def __init__(self, width: str):
        self.rows = {"head": np.zeros(0, U), "tail": np.zeros(0, U), "size": np.zeros(0, np.uint8), "at": np.zeros(0, np.int64), "n": np.zeros(0, np.int32), "used": np.zeros(0, np.int32)}
        self.ids, self.count, self.filled, self.clock = np.zeros(0, width), 0, 0, 0
        self.bits = (2 * MEMORY - 1).bit_length()
        self.slots = np.zeros(1 << self.bits, np.int32)
        self.reserve(1, 0)
        self.count = 1  # row 0 is no span

    def reserve(self, rows: int, ids: int) -> None:
        for name, x in self.rows.items():
            if len(x) < self.count + rows:
                self.rows[name] = np.concatenate([x, np.zeros(max(rows, len(x) // 2), x.dtype)])
        if len(self.ids) < self.filled + ids:
            self.ids = np.concatenate([self.ids, np.zeros(max(ids, len(self.ids) // 2), self.ids.dtype)])

    def places(self, head: np.ndarray, tail: np.ndarray, size: np.ndarray):
        h = mix(head ^ mix(tail + size.astype(U)))
        return h, (h >> U(64 - self.bits)).astype(np.int64), (h & U((1 << self.bits) - 1)).astype(np.int64)

    def find(self, head: np.ndarray, tail: np.ndarray, size: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The row of each span, 0 if it is not known."""
        r = self.rows
        row = self.slots[first]
        bad = np.flatnonzero((r["head"][row] != head) | (r["tail"][row] != tail) | (r["size"][row] != size))
        other = self.slots[second[bad]]
        other[(r["head"][other] != head[bad]) | (r["tail"][other] != tail[bad]) | (r["size"][other] != size[bad])] = 0
        row[bad] = other
        return row

    def add(self, head, tail, size, first, second, n: np.ndarray, ids: np.ndarray) -> None:
        self.reserve(len(n), len(ids))
        lo, hi = self.count, self.count + len(n)
        for name, x in (("head", head), ("tail", tail), ("size", size), ("n", n), ("at", self.filled + np.cumsum(n) - n), ("used", self.clock)):
            self.rows[name][lo:hi] = x
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.filled, self.count = self.filled + len(ids), hi
        row = np.arange(lo, hi, dtype=np.int32)
        free = self.slots[first] == 0
        self.slots[first[free]] = row[free]
        rest = self.slots[first] != row
        self.slots[second[rest]] = row[rest]

    def forget(self) -> None:
        """Keep the half of the memory that was used last."""
        if self.count <= MEMORY:
            return
        used = self.rows["used"][: self.count]
        stay = 1 + np.sort(np.argsort(-used[1:], kind="stable")[: MEMORY // 2])
        r = {name: x[stay] for name, x in self.rows.items()}
        ids = self.ids[spread(r["at"], r["n"])]
        clock = self.clock
        self.__init__(self.ids.dtype.str)
        self.clock = clock
        _, first, second = self.places(r["head"], r["tail"], r["size"])
        self.add(r["head"], r["tail"], r["size"], first, second, r["n"], ids)
        self.rows["used"][1 : self.count] = r["used"]


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ... of n values each."""
    n = n.astype(np.int64)
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Encoder:
    """Ids of whole texts, as the tokenizer gives them; byte-level BPE encodes a text span by span.

    A span is a blank or a line feed and the bytes up to the next one. The tokenizer's rule cuts before each single blank
    and around each single line feed, so where a text has no other white space, the ids of its spans are the ids
    of the text. Spans met before are looked up; the new ones of a piece are encoded once, one after the other as one text.
    Other texts (white space in a row, at an end or of other kinds, controls, "<|", broken UTF-8) are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        setting = json.loads(self.tokenizer.to_str())
        rule = setting["pre_tokenizer"] or {}
        self.by_span = rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule["add_prefix_space"] and setting["normalizer"] is None and len(self.whole("\n")) == 1
        vocabulary = self.tokenizer.get_vocab()
        self.letters = np.zeros(max(vocabulary.values()) + 1, np.int64)  # of byte-level BPE, a letter is a byte
        for token, i in vocabulary.items():
            self.letters[i] = len(token)
        self.known, self.long = Known(self.width), {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width)

    def new(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each span, and all ids."""
        n, ids, i = [], [], 0
        while i < len(spans):
            j, size = i + 1, len(spans[i])
            while j < len(spans) and size < NEW_BYTES and spans[j][:1] in (b" ", b"\n"):
                size += len(spans[j])
                j += 1
            got = np.array(self.tokenizer.encode_batch_fast([b"".join(spans[i:j]).decode()], add_special_tokens=False)[0].ids, self.width)
            ends = np.cumsum(self.letters[got])
            edge = np.searchsorted(ends, np.cumsum([len(x) for x in spans[i:j]])) + 1
            n.append(np.diff(edge, prepend=0)), ids.append(got)
            i = j
        return (np.concatenate(n), np.concatenate(ids)) if n else (np.zeros(0, np.int64), np.zeros(0, self.width))

    def odd(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Marks the texts that are encoded whole; ``data`` has 8 zeros more at its end."""
        n = len(offsets) - 1
        if not self.by_span:
            return np.diff(offsets) > 0
        blank = kind == 1
        some = offsets[1:] > offsets[:-1]
        lead = np.flatnonzero(kind == 4)
        a, b, c = data[lead], data[lead + 1], data[lead + 2]
        white = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((a == 0xE2) & (b == 0x80) & ((c < 0x90) | (c >= 0xA8) & (c < 0xB0)))
        white |= ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0x3C) & (b == 0x7C))
        at = np.concatenate([np.flatnonzero(kind == 2), np.flatnonzero(blank[1:] & blank[:-1]), lead[white]])
        out = np.zeros(n, bool)
        out[np.searchsorted(offsets, at, "right") - 1] = True
        out[some] |= blank[offsets[:-1][some]] | blank[offsets[1:][some] - 1]
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:
            for i in range(n):
                try:
                    data[offsets[i] : offsets[i + 1]].tobytes().decode()
                except UnicodeDecodeError:
                    out[i] = True
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, the end id included, and all ids."""
        known, docs = self.known, len(offsets) - 1
        known.forget()
        known.clock += 1
        size_all = int(offsets[-1])
        padded = np.zeros(size_all + 16, np.uint8)
        padded[8:-8] = data
        kind = _KIND[data]
        odd = self.odd(padded[8:], offsets, kind)
        begins = kind == 1
        begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], size_all)[: len(starts)]
        count = np.diff(np.searchsorted(starts, offsets))
        if odd.any():
            stay = ~np.repeat(odd, count)
            starts, ends, count = starts[stay], ends[stay], np.where(odd, 0, count)
        raw = data.tobytes()
        eight = np.ndarray(size_all + 9, "<u8", padded.data, strides=(1,))
        size = (ends - starts).astype(np.int64)
        row = np.zeros(len(starts), np.int64)
        short = np.flatnonzero(size <= SPAN_BYTES)
        s = size[short].astype(np.uint8)
        head = eight[starts[short] + 8] & _MASK[np.minimum(s, 8)]
        tail = np.where(s > 8, eight[ends[short]], U(0))
        h, first, second = known.places(head, tail, s)
        found = known.find(head, tail, s, first, second)
        while len(lost := np.flatnonzero(found == 0)):
            one = lost[np.unique(h[lost], return_index=True)[1]]
            known.add(head[one], tail[one], s[one], first[one], second[one], *self.new([raw[a:b] for a, b in zip(starts[short[one]].tolist(), ends[short[one]].tolist(), strict=True)]))
            found[lost] = known.find(head[lost], tail[lost], s[lost], first[lost], second[lost])
        row[short] = found
        known.rows["used"][found] = known.clock
        # spans that are long, texts that are odd, and the end: their ids lie behind those that are known
        others = np.flatnonzero(size > SPAN_BYTES)
        if len(self.long) > MEMORY // 16:
            self.long.clear()
        texts = []
        for a, b in zip(starts[others].tolist(), ends[others].tolist(), strict=True):
            span = raw[a:b]
            if span not in self.long:
                self.long[span] = self.whole(span.decode())
            texts.append(self.long[span])
        odds = np.flatnonzero(odd)
        texts += [self.whole(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")) for i in odds.tolist()]
        extra = np.concatenate([*texts, np.array([end], self.width)])
        known.reserve(0, len(extra))
        known.ids[known.filled : known.filled + len(extra)] = extra
        more = np.array([len(x) for x in texts], np.int64)
        place = known.filled + np.cumsum(more) - more
        at, n = known.rows["at"][row], known.rows["n"][row].astype(np.int64)
        at[others], n[others] = place[: len(others)], more[: len(others)]
        doc = np.concatenate([odds, np.arange(docs)])
        order = np.lexsort((np.arange(len(doc)) >= len(odds), doc))
        behind = np.cumsum(count)[doc[order]]
        at = np.insert(at, behind, np.concatenate([place[len(others) :], np.full(docs, known.filled + len(extra) - 1)])[order])
        n = np.insert(n, behind, np.concatenate([more[len(others) :], np.ones(docs, np.int64)])[order])
        sums = np.concatenate([[0], np.cumsum(n)])
        edge = np.concatenate([[0], np.cumsum(count + 1 + odd)])
        return np.diff(sums[edge]), known.ids[spread(at, n)]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write shard, at, doc_id, n_tokens and ids of each document, in ascending doc_id order over the files' shard numbers.

    A null or empty text is the end id alone; other columns are ignored; no rows make empty files.

    Texts are dealt to ranges of doc_id and sorted there (null ids first, one id's rows by a hash of their text) and
    only then encoded. The ids are a dictionary-encoded list column, the numbers delta-encoded where a dictionary doesn't pay.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(8, size // FILE_TEXT + 1)
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def run(batches):
        enc = encoder(tokenizer)
        at = 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for i, j in pieces(offsets):
                n, flat = enc.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.arange(at, at + j - i)), batch.column(1).slice(i, j - i), pa.array(n), lists], names=["shard", "at", "doc_id", "n_tokens", "ids"])
                at += j - i

    out = dealt.mapInArrow(run, "shard int, at long, doc_id long, n_tokens long, ids array<int>")
    options = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.page.row.count.limit": PAGE_ROWS, "parquet.writer.version": "v2", "parquet.enable.dictionary": "true", "compression": "snappy"}
    out.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, n_tokens and ids of files that ``write_tokens`` wrote; a condition on doc_id reads only the pages whose index admits it."""
    df = spark.read.parquet(path)
    return (df if where is None else df.filter(where)).select("doc_id", "n_tokens", "ids")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files.

    ``start`` is the sum of n_tokens over the shards before and, within the shard, over the rows before.
    """
    df = spark.read.parquet(path)
    shards = df.groupBy("shard").agg(F.sum("n_tokens").alias("ids_here"))
    base = shards.select(F.col("shard").alias("s"), (F.sum("ids_here").over(W.orderBy("shard")) - F.col("ids_here")).alias("base"))

    def sums(batches):
        for batch in batches:
            lists = batch.column(4)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], names=["shard", "at", "doc_id", "n_tokens", "ids_crc32"])

    rows = df.select("shard", "at", "doc_id", "n_tokens", "ids").mapInArrow(sums, "shard int, at long, doc_id long, n_tokens long, ids_crc32 long")
    inside = F.sum("n_tokens").over(W.partitionBy("shard").orderBy("at")) - F.col("n_tokens")
    hint = F.broadcast(base) if shards.count() <= BROADCAST_FILES else base  # one row for each file
    out = rows.withColumn("inside", inside).join(hint, F.col("shard") == F.col("s"))
    return out.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the tokens of ``docs`` to the shared folder, read them back: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is the end id alone. Rows that repeat an id follow each other. No rows: no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return token_index(spark, path)
