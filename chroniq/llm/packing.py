"""Best-fit packing by a plan over the histogram of lengths (operator 11).

Sequences are planned for counts of lengths, never for documents: the histogram has as many rows as a sequence has places, so
the plan is small whatever the corpus. Lengths are placed from the longest down, each where the least room is left that
holds it, many equal pieces and many equal sequences at a time; the plan is a list of slots, each of which says where
the pieces of one length whose rank is in a range go. A piece then needs no more than its rank among those of its length:
its rank within the task that encoded it, plus the number of pieces of that length in the tasks before. No length is gathered
anywhere, also if a third of all documents have it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import column_bytes, materialize, pieces
from chroniq.llm.tokens import encoder

#: Ids of a sequence at most.
SEQUENCE = 2048
#: Rows of the table of counts by task and length up to which it is broadcast; beyond, the join shuffles.
BROADCAST_COUNTS = 1_000_000


def plan(counts: np.ndarray, most: int) -> dict[str, np.ndarray]:
    """Slots of a best-fit packing of ``counts[n]`` pieces of each length n into sequences of ``most``.

    The pieces of ``length`` with ranks ``first`` to ``first + n - 1`` lie in the sequences from ``sequence`` on, ``per`` in each, from
    ``offset`` on; slots are sorted by length and first.

    This is best-fit decreasing, done for runs of sequences that have the same room left. A run's room at least halves when it is
    filled, so there are about 11 slots for each length and run, of which there are at most 3 for each length.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]  # by room left: runs (first sequence, number of sequences)
    slots, used = [], 0
    for length in range(most, 0, -1):
        left, first, room = int(counts[length]), 0, length
        while left:
            while room <= most and not free[room]:
                room += 1
            if room <= most:
                sequence, many = free[room].pop()
            else:
                room, sequence, many = most, used, -(-left // (most // length))
                used += many
            per = room // length
            whole = min(many, left // per)
            if whole:
                slots.append((length, first, whole * per, sequence, most - room, per))
                free[room - per * length].append((sequence, whole))
                first, left, sequence, many = first + whole * per, left - whole * per, sequence + whole, many - whole
            if many and left and left < per:  # the last ones, in one sequence
                slots.append((length, first, left, sequence, most - room, left))
                free[room - left * length].append((sequence, 1))
                left, sequence, many = 0, sequence + 1, many - 1
            if many:
                free[room].append((sequence, many))
    rows = np.array(sorted(slots), np.int64).reshape(-1, 6)
    return dict(zip(("length", "first", "n", "sequence", "offset", "per"), rows.T, strict=True)) | {"sequences": np.array(used)}


def places(slots: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by their length and their rank among those of that length."""
    # slots in order of (length, first): the last one that begins at or before the piece
    start = np.searchsorted(slots["length"], length)
    end = np.searchsorted(slots["length"], length, "right")
    while (open_ := np.flatnonzero(end - start > 1)).size:
        middle = (start[open_] + end[open_]) // 2
        below = slots["first"][middle] <= rank[open_]
        start[open_] = np.where(below, middle, start[open_])
        end[open_] = np.where(below, end[open_], middle)
    inside = rank - slots["first"][start]
    per = slots["per"][start]
    return slots["sequence"][start] + inside // per, slots["offset"][start] + inside % per * length


def ranks(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of equal lengths before each, those that ``seen`` counts included; adds to ``seen``."""
    order = np.argsort(length, kind="stable")
    s = length[order]
    head = np.searchsorted(s, s, "left")
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - head + seen[s]
    seen += np.bincount(length, minlength=len(seen))
    return out


PIECE = "shard int, rank long, doc_id long, piece int, start long, length int, ids binary"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, most: int) -> DataFrame:
    """The pieces of all documents: shard (the task), rank within shard and length, doc_id, piece, start, length and ids (4 bytes each, low first)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches):
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(most + 1, np.int64)
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in pieces(offsets):
                n, flat = enc.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                n = n.astype(np.int64)
                parts = -(-n // most)
                doc = np.repeat(np.arange(len(n)), parts)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                short = n - (parts - 1) * most  # of the first piece
                start = np.where(number > 0, short[doc] + (number - 1) * most, 0)
                length = np.where(number > 0, most, short[doc])
                edge = np.concatenate([[0], np.cumsum(length)]) * 4  # pieces follow each other as the ids do
                ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(flat.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), shard, np.int32)), pa.array(ranks(length, seen)), batch.column(0).slice(i, j - i).take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)), ids],
                    names=["shard", "rank", "doc_id", "piece", "start", "length", "ids"],
                )

    return narrow.mapInArrow(run, PIECE)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, most: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, sequence_id, offset and ids of each piece of each row of ``docs``.

    A document is its ids and the end id; a null or empty text is the end id alone. One of more than ``most`` ids is cut into pieces of
    ``most``, the first of which may be shorter; no other is cut. ``ids`` holds 4 bytes for each id, the lowest first. The pieces of a
    sequence fill it from 0 on without gaps. Rows that repeat a doc_id, or have none, are documents of their own. Other columns
    are ignored; no rows make no sequences.
    """
    spark = docs.sparkSession
    stored = materialize(encoded(docs, tokenizer, end_id, most), "pieces")
    here = materialize(stored.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = here.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row for each length, of which there are ``most``
    counts = np.zeros(most + 1, np.int64)
    for r in histogram:
        counts[r.length] = r.n
    slots = spark.sparkContext.broadcast(plan(counts, most))
    # by length, as many rows as there are tasks at most
    before = here.select("shard", "length", (F.sum("n").over(W.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    small = here.count() <= BROADCAST_COUNTS
    joined = stored.join(F.broadcast(before) if small else before.hint("merge"), ["shard", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids"]

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                sequence, offset = places(slots.value, batch.column(3).to_numpy().astype(np.int64), batch.column(5).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(3).cast(pa.int64()), pa.array(sequence), pa.array(offset), batch.column(4)], names=["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"])

    rows = joined.select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (4 bytes each) and the pieces (doc_id, piece, start, length) in their order, of what ``pack`` gives.

    A sequence has as many pieces as places at most, so no group is large.
    """
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids"))).alias("all"))
    pieces_ = F.transform("all", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["start"].alias("start"), p["length"].alias("length")))
    ids = F.aggregate(F.transform("all", lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return rows.select("sequence_id", ids.alias("ids"), pieces_.alias("pieces"))
