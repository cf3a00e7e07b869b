"""WARC files: writing with identical-payload revisits, reading by boundary-chain verification (operator 7).

Reading cuts the files at every occurrence of the magic, in parallel and wherever the splits fall. Each piece may begin a
record; a task parses its header and emits the offset where its successor would begin, and nothing else. Within a split
the chains are doubled at once, so that each candidate knows where its chain leaves the split; between splits they
are doubled by pointer jumping from the start of each file. Only reachable candidates are records; magic
inside payloads is not reachable, whatever header follows it. A second pass digests the reachable records.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.llm.common import materialize, scratch_path

#: What a record starts with, without the minor version (fixed values of the format).
MAGIC, END = "WARC/1.", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Tables of up to so many rows are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 8 groups of 20 bits, each 4 characters."""
    hexed, alphabet, out = F.sha1(payload), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), []
    for g in range(8):
        v = F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.substr(alphabet, F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def with_revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Adds digest, refers_to and is_revisit. Only digests that occur more than once are joined back to the pages."""
    d = pages.withColumn("payload", F.coalesce(F.col("html").cast("string"), F.lit(""))).drop("html")
    d = d.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    most = materialize(d.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("top")).filter("n > 1 and top is not null").select(F.col("digest").alias("again"), "top"), "repeated")
    hint = F.broadcast(most) if most.count() <= BROADCAST_ROWS else most
    j = d.join(hint, (d.digest == F.col("again")) & (d.bytes >= min_bytes), "left").drop("again")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return j.withColumn("is_revisit", revisit).withColumn("refers_to", F.when(revisit, F.col("top"))).drop("top")


def one_line(text: Column) -> Column:
    """A header value: no line ends, and the magic escaped."""
    return F.replace(F.regexp_replace(text, r"[\r\n\x00]", "%0D%0A"), F.lit("WARC/"), F.lit("WARC%2F"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """A record for each row of (page_id, url, html): a response with its payload, or a revisit of an equal one.

    The block is the HTTP response; a revisit's block has its headers alone. Of rows with equal payloads of at least
    ``min_bytes`` bytes those of the largest page_id are responses (all, if no id is known). Written by Spark's
    text writer, so to any store it can reach.
    """
    r = with_revisits(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), min_bytes)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(F.col("is_revisit"), http).otherwise(F.concat(http, F.col("payload")))
    uri = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), one_line(F.col("url")), F.lit("\r\n")), F.lit(""))
    head = F.concat(
        F.lit(f"{MAGIC}1\r\nWARC-Type: "), F.when(F.col("is_revisit"), "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\n"), uri, F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.when(F.col("is_revisit"), F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("refers_to")), F.lit("\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    r.select(F.concat(head, block).alias("value")).write.option("lineSep", END).text(path)


_HEAD = re.compile(rb"\d\r\n((?:[^\r\n:]+:[^\r\n]*\r\n)+)\r\n")
_ID = re.compile(rb"<urn:page:(-?\d+)>")


def parse(chunk):
    """(bytes up to the block, block length, fields) of what follows the magic, or None."""
    m = _HEAD.match(chunk)
    if not m:
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in m[1].split(b"\r\n")[:-1])}
    length = fields.get(b"content-length", b"")
    return (m.end(), int(length), fields) if re.fullmatch(rb"\d{1,15}", length) else None


class Block:
    """A record's block, fed piece by piece: what is kept of it is its HTTP header, a running digest and sizes."""

    def __init__(self, fields: dict, length: int):
        self.fields, self.missing, self.http, self.sha, self.size = fields, length, bytearray(), hashlib.sha1(), 0
        self.in_head = fields.get(b"content-type", b"").startswith(b"application/http")

    def feed(self, piece) -> None:
        piece = piece[: self.missing]
        self.missing -= len(piece)
        if self.in_head:
            seam = max(0, len(self.http) - 3)
            self.http += piece
            at = self.http.find(b"\r\n\r\n", seam)
            if at < 0:
                return
            self.in_head, piece, self.http = False, self.http[at + 4 :], self.http[:at]
        self.sha.update(piece)
        self.size += len(piece)

    def described(self) -> dict:
        """What is returned of a record whose block is complete."""
        number = lambda name: int(m[1]) if (m := _ID.search(self.fields.get(name, b""))) else None
        kind = self.fields.get(b"warc-type", b"").decode("latin-1")
        digest, size = base64.b32encode(self.sha.digest()).decode(), self.size
        method, _, told = self.fields.get(b"warc-payload-digest", b"").decode("latin-1").partition(":")
        told = told if method.lower() == "sha1" else ""
        if kind == "revisit":
            m = re.search(rb"(?i)^content-length:\s*(\d+)", self.http, re.M)
            digest, size = told or digest, int(m[1]) if m else size
        return {"page_id": number(b"warc-record-id"), "kind": kind, "refers_to": number(b"warc-refers-to"), "bytes": size, "digest": digest, "sound": not told or told == digest}


KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
CANDIDATE = "file string, split long, rel long, leaves long, covered long"
RECORD = "page_id long, kind string, refers_to long, bytes long, digest string, sound boolean"
FOUND = f"file string, split long, whole boolean, p0 long, p1 long, head binary, {RECORD}"
NAMES = [x.split()[0] for x in RECORD.split(", ")]


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, KINDS[k]) for n, k in (x.split() for x in ddl.split(", "))])


def chunks(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


def leaving(rel: np.ndarray, successor: np.ndarray, covered: int) -> np.ndarray:
    """Where the chain of each candidate of a split leaves it; -1 where it ends inside. Offsets rise; pointer jumping."""
    place = np.minimum(np.searchsorted(rel, successor), max(len(rel) - 1, 0))
    inside = rel[place] == successor
    to = np.where(inside, place, np.arange(len(rel)))
    while True:
        further = to[to]
        if (further == to).all():
            return np.where(successor[to] >= covered, successor[to], -1)
        to = further


def candidates(batches):
    """Offsets alone: a row for each candidate whose chain leaves its split, and one (rel null) with the bytes the split covers.

    Offsets are of what follows the magic, relative to the first byte that the split covers.
    """
    schema = arrow_schema(CANDIDATE)
    at, rel, starts, ends = None, 0, array("q"), array("q")

    def close():
        own = np.frombuffer(starts, np.int64)
        leaves = leaving(own, np.frombuffer(ends, np.int64), rel) if len(own) else own
        own, leaves = own[leaves >= 0], leaves[leaves >= 0]
        n = len(own)
        cols = [pa.array([at[0]] * (n + 1)), pa.array(np.full(n + 1, at[1])), pa.array([*own.tolist(), None], pa.int64()), pa.array([*leaves.tolist(), None], pa.int64()), pa.array([None] * n + [rel], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    for batch in batches:
        for file, split, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if (file, split) != at:
                if at:
                    yield close()
                at, rel, starts, ends = (file, split), 0, array("q"), array("q")
            chunk = memoryview(value.as_buffer())
            got = parse(chunk)
            if got:
                starts.append(rel)
                ends.append(rel + got[0] + got[1] + len(END) + len(MAGIC))
            rel += len(chunk) + len(MAGIC)
    if at:
        yield close()


def records(batches):
    """The records that the chain reaches in each split, digested as they stream by; ``enter`` is where the chain enters.

    A record whose block goes on in later splits is a row with ``whole`` false and its header.
    """
    schema = arrow_schema(FOUND)
    magic = MAGIC.encode()
    at, rel, due, block, own, rows = None, 0, None, None, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)

    def cut():
        return [{**own, "whole": False}] if block is not None else []

    for batch in batches:
        for file, split, enter, value in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
            if (file, split) != at:
                rows += cut()
                at, rel, due, block = (file, split), 0, enter, None
            chunk = memoryview(value.as_buffer())
            if block is not None:
                block.feed(magic)
                block.feed(chunk)
            elif rel == due:
                got = parse(chunk)
                if got:
                    size, length, fields = got
                    block, due = Block(fields, length), rel + size + length + len(END) + len(MAGIC)
                    own = {"file": file, "split": split, "p0": rel + size, "p1": rel + size + length, "head": bytes(chunk[:size])}
                    block.feed(chunk[size:])
            if block is not None and not block.missing:
                rows.append({"file": file, "split": split, "whole": True, **block.described()})
                block = None
            rel += len(chunk) + len(magic)
        if len(rows) > 10_000:
            yield batch_of(rows)
            rows = []
    rows += cut()
    if rows:
        yield batch_of(rows)


def small(df: DataFrame) -> DataFrame:
    """Broadcast a stored table only if it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def reachable(found: DataFrame, bases: DataFrame, splits_of_a_file: int) -> DataFrame:
    """(file, c): where the chain from the file's start enters its splits, as absolute offsets."""
    starts = bases.filter("base = 0").select("file", F.lit(len(MAGIC)).cast("long").alias("c"))
    if splits_of_a_file == 1:
        return starts
    ends = found.filter("rel is not null").join(small(bases), ["file", "split"]).select("file", (F.col("rel") + F.col("base")).alias("c"), (F.col("leaves") + F.col("base")).alias("to"))
    ends = materialize(ends, "chains")
    nodes = ends.select("file", F.col("to").alias("c")).union(starts).distinct()
    jump, reached = materialize(ends.join(nodes, ["file", "c"], "left_semi"), "jumps"), starts
    rounds = (splits_of_a_file - 1).bit_length()
    for i in range(rounds):
        reached = materialize(reached.union(reached.join(jump, ["file", "c"]).select("file", F.col("to").alias("c"))).distinct(), "reached")
        if i == rounds - 1:
            return reached
        next_ = jump.select("file", F.col("c").alias("to"), F.col("to").alias("further"))
        jump = materialize(jump.join(next_, ["file", "to"]).select("file", "c", F.col("further").alias("to")), "jumps")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, kind, refers_to, bytes, digest of each record that the chain of its file reaches.

    Two passes: the first finds offsets alone, the second digests the records that are reachable, as they stream by. So
    no payload of a false candidate is ever held. A record's successor begins 4 bytes after its block; a header without
    a sound Content-Length, or one that contains the magic, ends the chain. ``bytes`` and ``digest`` are of the whole payload,
    for a revisit as its headers tell. A record whose own ``sha1:`` payload digest differs from its payload's fails the
    query; digests of other kinds are not compared. ``page_id`` and ``refers_to`` are null where a record's id is no
    ``<urn:page:N>``. Files are read uncompressed. An empty folder gives no rows.
    """
    found = materialize(chunks(spark, path).mapInArrow(candidates, CANDIDATE), "candidates")
    covered = found.filter("rel is null").select("file", "split", "covered")
    # one row for each split; the sums run within a file
    base = F.sum("covered").over(W.partitionBy("file").orderBy("split")) - F.col("covered")
    bases = materialize(covered.select("file", "split", "covered", base.alias("base")), "bases")
    widest = bases.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    entered = reachable(found, bases, widest).join(small(bases), "file").filter("c >= base and c < base + covered").select("file", "split", (F.col("c") - F.col("base")).alias("enter"))
    entered = materialize(entered, "entered")  # one row for each split at most
    if entered.count() <= BROADCAST_ROWS:
        mine = chunks(spark, path).join(F.broadcast(entered), ["file", "split"])
    else:  # a join that deals out the rows of a split: they are put together again, in order
        mine = chunks(spark, path).mapInArrow(placed, "file string, split long, value binary, rel long").join(entered, ["file", "split"])
        mine = mine.repartition("file", "split").sortWithinPartitions("file", "split", "rel")
    true = materialize(mine.select("file", "split", "enter", "value").mapInArrow(records, FOUND), "records")
    out = true.filter("whole").select(*NAMES)
    if true.filter("not whole").limit(1).count():
        out = out.union(_across(spark, path, true, bases))
    unsound = F.raise_error(F.concat(F.lit("payload digest differs in record "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    return out.withColumn("digest", F.when(F.col("sound"), F.col("digest")).otherwise(unsound)).drop("sound")


def placed(batches):
    """Adds the offset of each chunk within its split."""
    at, rel = None, 0
    for batch in batches:
        offs = []
        for file, split, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if (file, split) != at:
                at, rel = (file, split), 0
            offs.append(rel)
            rel += len(value.as_buffer()) + len(MAGIC)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(offs, pa.int64())], names=["file", "split", "value", "rel"])


def _across(spark: SparkSession, path: str, true: DataFrame, bases: DataFrame) -> DataFrame:
    """Records whose block has magic inside and goes on in later splits; one for each split at most, each put together whole."""
    cut = true.filter("not whole").join(small(bases.select("file", "split", "base")), ["file", "split"])
    cut = materialize(cut.select("file", F.col("split").alias("home"), "head", (F.col("p0") + F.col("base")).alias("a"), (F.col("p1") + F.col("base")).alias("b")), "cut")
    need = materialize(cut.join(bases, "file").filter("base < b and base + covered > a").select("file", "split", "home", "head", "a", "b", "base"), "need")
    pieces = chunks(spark, path).mapInArrow(placed, "file string, split long, value binary, rel long").join(small(need), ["file", "split"])
    # the magic that ended the piece is part of it, but for the last of a file
    pieces = pieces.withColumn("c", F.col("rel") + F.col("base")).withColumn("full", F.concat(F.col("value"), F.lit(MAGIC).cast("binary")))
    pieces = pieces.filter("c < b and c + octet_length(full) > a").select("file", "home", "head", "a", "b", "c", "full")

    def whole(t: pa.Table) -> pa.Table:
        t = t.sort_by("c")
        a, c = t["a"][0].as_py(), t["c"][0].as_py()
        _, length, fields = parse(t["head"][0].as_py())
        block, skip = Block(fields, length), a - c
        for x in t["full"]:
            block.feed(memoryview(x.as_buffer())[skip:])
            skip = 0
        return pa.Table.from_pylist([block.described()], schema=arrow_schema(RECORD))

    return pieces.groupBy("file", "home", "a").applyInArrow(whole, RECORD)


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, read back from written archives.

    A null html is an empty payload; rows of one page_id are records of their own; a null page_id revisits if it can.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path, min_bytes)
    r = read_warc(spark, path)
    return r.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


_B32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INTEGER + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_B32} AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM t
"""
