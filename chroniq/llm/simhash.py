"""SimHash near-duplicate components by anchor points of a covering code (operator 10).

A fingerprint of 64 bits is cut into equal blocks. Two fingerprints that differ in at most ``max_distance``
bits differ in at most ``r = max_distance // blocks`` bits of some block (pigeonhole), and there the anchors
of a covering code decide which pairs meet: each block's home anchor is its nearest code word (within the
covering radius), and the fingerprint is also sent to each anchor within that radius plus ``r`` that can be
the home of a block ``r`` bits away. A pair of close fingerprints therefore meets at the home of either one.
Per anchor, homes are compared with all members; what is emitted are the stars of the group's components,
never its pairs. A large anchor's members are compared one by one with those not yet linked to another, so that a family
of near copies costs about one pass; a hot one is cut into parts, and each two parts meet in a task of their own. Codes: the perfect Golay code [23, 12] (radius 3) for blocks of 23 bits or more, else the
Hamming code [15, 11] (radius 1); bits of a block beyond the code's length belong to the anchor as they are.

Fingerprints of words lie far apart where a block of text is cut off or added. With ``sketch_words``, texts therefore
also meet by MinHash bands of their distinct shingles, whatever the kind of edit: 16 bands of 4 values, so a pair of
Jaccard similarity s shares a band with probability 1 - (1 - s^4)^16, 0.9998 at 0.8. These links are only candidates
where ``similarity`` is given: the texts of each of their components are then compared by their shingles themselves, those of a
large component with one of them first, and what isn't similar to it with all others in blocks.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import Scratch, U, column_bytes, materialize, mix, signed
from chroniq.llm.components import components, spanning_stars

#: Generator polynomials (fixed values): length, check bits, covering radius, polynomial.
GOLAY = (23, 11, 3, 0xC75)
HAMMING = (15, 4, 1, 0x13)
#: MinHash bands, and values of a band.
BANDS, BAND_VALUES = 16, 4
#: Entries of one group of anchors, about.
GROUP_ROWS = 125_000
#: Bytes of shingle hashes of a group of components, and of a block of a component that is larger.
VERIFY_BYTES = 1 << 20
#: Texts to verify up to which their keys are broadcast.
BROADCAST_ROWS = 250_000
#: Pairs compared at a time.
PAIRS = 400_000
#: Members from which on an anchor or band is large, and from which on it is hot: then no task gets many more of it.
LARGE_MEMBERS, HOT_MEMBERS = 1 << 11, 1 << 15
#: Hot ones are counted on one text of so many; and the most of them (of the rest, none has more than such a share of all entries).
SAMPLED, HOT_NAMES = 64, 1 << 17
#: Top bit of the name of a band; an anchor's name is without.
BAND = U(1 << 63)


class AnchorCode:
    """Home anchors, and the anchors that hold everything up to ``reach`` bits away, of blocks of ``width`` bits."""

    def __init__(self, width: int, reach: int):
        self.width, self.reach = width, reach
        self.length, self.checks, self.radius, poly = GOLAY if width >= GOLAY[0] else HAMMING
        if width < self.length:
            raise ValueError(f"blocks need {self.length} bits at least")
        bit = []
        for i in range(self.length):
            x = 1 << i
            for j in range(i, self.checks - 1, -1):
                if x >> j & 1:
                    x ^= poly << (j - self.checks)
            bit.append(x)
        leaders = np.zeros(1 << self.checks, U)
        for weight in range(1, self.radius + 1):
            for where in combinations(range(self.length), weight):
                s = 0
                for i in where:
                    s ^= bit[i]
                leaders[s] = sum(1 << i for i in where)
        self.leaders = leaders
        self.tables = [np.array([self._fold(bit, k, v) for v in range(256)], np.int64) for k in range(0, self.length, 8)]
        flips = [0, *(sum(1 << i for i in w) for n in range(1, reach + 1) for w in combinations(range(width), n))]
        self.flips = np.array(flips, U)

    @staticmethod
    def _fold(bit: list[int], k: int, v: int) -> int:
        s = 0
        for i in range(8):
            if v >> i & 1 and k + i < len(bit):
                s ^= bit[k + i]
        return s

    def home(self, block: np.ndarray) -> np.ndarray:
        syndrome = np.zeros(block.shape, np.int64)
        coded = block & U((1 << self.length) - 1)
        for k, t in enumerate(self.tables):
            syndrome ^= t[((coded >> U(8 * k)) & U(255)).astype(np.int64)]
        return block ^ self.leaders[syndrome]

    def members(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor, whether it is the row's home: distinct for each row."""
        home = self.home(block)
        all_ = np.sort(self.home(block[:, None] ^ self.flips[None, :]), axis=1)
        new = np.ones(all_.shape, bool)
        new[:, 1:] = all_[:, 1:] != all_[:, :-1]
        row, col = np.nonzero(new)
        anchor = all_[row, col]
        return row, anchor, anchor == home[row]


#: Bits of each byte value, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANES = [U(0), U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3)]


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits that are set in over half of each lane's 64-bit hashes (n x 8 bytes, highest first), as 8 bytes."""
    n = len(hashes)
    counts = np.bincount((hashes + np.arange(0, 2048, 256, dtype=np.int64)).ravel(), minlength=2048).reshape(8, 256)
    return np.packbits((counts @ _BITS) * 2 > n, axis=1).ravel()


def shingle_digests(words: list[bytes], k: int, distinct: bool) -> np.ndarray:
    """XXH64 (seed 42) of the k-word shingles, n x 8 bytes; fewer words are one shingle."""
    joined, size = b" ".join(words), [len(w) for w in words]
    k = min(k, len(words))
    ends = np.cumsum(np.array(size, np.int64) + 1) - 1
    starts = (ends - size)[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_digest
    out = [digest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]
    if distinct:
        out = list(set(out))
    return np.frombuffer(b"".join(out), np.uint8).reshape(-1, 8)


def fingerprint(text: bytes, k: int = 3, distinct: bool = False) -> int:
    """The SimHash of one text, unsigned; no words: 0."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the separators \x20 and \x09-\x0D
    return int.from_bytes(majority(shingle_digests(words, k, distinct)).tobytes(), "big") if words else 0


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Hashes of the distinct k-word shingles; no words: a 0."""
    words = text.lower().split()
    return shingle_digests(words, k, True).view(">u8").ravel().astype(U) if words else np.zeros(1, U)


def sketch(h: np.ndarray) -> bytes:
    """A SimHash of 256 bits of distinct hashes."""
    return b"".join(majority(mix(h ^ lane).astype(">u8").view(np.uint8).reshape(-1, 8)).tobytes() for lane in _LANES)


_FACTORS = mix(np.arange(1, BANDS * BAND_VALUES + 1, dtype=U)) | U(1)


def bands(h: np.ndarray) -> np.ndarray:
    """A hash for each MinHash band of distinct hashes."""
    low = np.full(len(_FACTORS), ~U(0))
    for i in range(0, len(h), 4096):
        low = np.minimum(low, (h[None, i : i + 4096] * _FACTORS[:, None]).min(axis=1))
    out = np.arange(BANDS, dtype=U)
    for values in low.reshape(BANDS, BAND_VALUES).T:
        out = mix(out ^ values)
    return out


def fingerprints(docs: DataFrame, shingle_words: int, distinct: bool, sketch_words: int = 0) -> DataFrame:
    """doc_id, fp (signed long) and, if asked for, key (a hash of the text), sketch, bands and number of shingles of each whole text."""

    def run(batches):
        for batch in (b.slice(i, 512) for b in batches for i in range(0, max(b.num_rows, 1), 512)):
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            fp = np.array([fingerprint(x, shingle_words, distinct) for x in texts], U)
            cols = [batch.column(0), pa.array(signed(fp))]
            if sketch_words:
                hashes = [shingle_hashes(x, sketch_words) for x in texts]
                cols += [batch.column(2), pa.array([sketch(h) for h in hashes], pa.binary()), pa.array([bands(h).tobytes() for h in hashes], pa.binary()), pa.array([len(h) for h in hashes], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["doc_id", "fp", "key", "sketch", "bands", "shingles"][: 6 if sketch_words else 2]
    schema = "doc_id long, fp long" + ", key long, sketch binary, bands binary, shingles long" * bool(sketch_words)
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")]
    return docs.select(*columns, *[text_key().alias("key")] * bool(sketch_words)).mapInArrow(run, schema)


def text_key() -> Column:
    """A 64-bit hash of the text; null is empty."""
    return F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))


def entries(code: AnchorCode, fp: np.ndarray, blocks: int, of: np.ndarray | None):
    """Row, name of the anchor or band, and whether the row is compared with all there, for each block and for the bands."""
    for b in range(blocks):
        row, anchor, home = code.members((fp >> U(b * code.width)) & U((1 << code.width) - 1))
        yield row, anchor | U(b << 56), home
    if of is not None:
        yield np.repeat(np.arange(len(fp)), BANDS), of | BAND, np.ones(len(fp) * BANDS, bool)


def hot_names(fps: DataFrame, max_distance: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and bands that ``HOT_MEMBERS`` texts or more seem to have, rising, and into how many parts each is cut.

    Counted on a sample of the texts by a hash of their keys. What is hot decides where texts meet, never whether they do.
    """
    columns = ["fp", "bands"] if "bands" in fps.columns else ["fp"]

    def run(batches):
        code = AnchorCode(64 // blocks, max_distance // blocks)
        for batch in batches:
            for lo in range(0, batch.num_rows, 20_000):
                some = batch.slice(lo, 20_000)
                fp = some.column(0).to_numpy(zero_copy_only=False).view(U)
                of = np.frombuffer(b"".join(some.column(1).to_pylist()), U) if len(columns) > 1 else None
                for _, name, _ in entries(code, fp, blocks, of):
                    name, n = np.unique(name, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(name)), pa.array(n)], names=["name", "n"])

    some = fps.filter(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(SAMPLED)) == 0).select(*columns)
    counts = some.mapInArrow(run, "name long, n long").groupBy("name").agg((F.sum("n") * SAMPLED).alias("n"))
    rows = counts.filter(F.col("n") >= HOT_MEMBERS).orderBy(F.desc("n"), "name").limit(HOT_NAMES).collect()
    name, n = np.array([r.name for r in rows], np.int64).view(U), np.array([r.n for r in rows], np.int64)
    order = np.argsort(name)
    return name[order], 2 * n[order] // HOT_MEMBERS + 1


def dealt(name: np.ndarray, key: np.ndarray, hot: np.ndarray, parts: np.ndarray, buckets: int):
    """Entries and the groups they go to, some at a time.

    An entry of a hot name goes to the groups of its part and each other part, so any two entries share a group.
    """
    n = np.ones(len(name), np.int64)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, name), len(hot) - 1)
        n = np.where(hot[at] == name, parts[at], n)
    cold = np.flatnonzero(n == 1)
    yield cold, (mix(name[cold]) % U(buckets)).astype(np.int64) + np.where(name[cold] >= BAND, buckets, 0)
    entry = np.flatnonzero(n > 1)
    n = n[entry]
    part = (mix(mix(key[entry].view(U)) ^ name[entry]) % n.astype(U)).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(n - 1)])
    i = 0
    while i < len(entry):
        j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, "right")) - 1)
        which = np.repeat(np.arange(i, j), n[i:j] - 1)
        other = np.arange(total[i], total[j]) - total[which]
        other += other >= part[which]
        x = mix(mix(name[entry[which]]) ^ np.minimum(part[which], other).astype(U))
        x = mix(x ^ np.maximum(part[which], other).astype(U))
        yield entry[which], (x >> U(2)).astype(np.int64) + 2 * buckets
        i = j


def stars(key: np.ndarray, fp: np.ndarray, marks: np.ndarray | None, most: int, sketch_distance: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Edges (key, a key of its component) that connect what all links between these texts connect.

    Each text found is compared only with those not yet found.
    """
    src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left, f, m = np.arange(len(key)), fp, marks
    while len(left) > 1:
        root, found = left[0], [left[0]]
        left, f, m = left[1:], f[1:], None if m is None else m[1:]
        while found and len(left):
            x = found.pop()
            hit = np.flatnonzero(np.bitwise_count(f ^ fp[x]) <= most)
            if m is not None:
                hit = hit[np.bitwise_count(m[hit] ^ marks[x]).sum(1, dtype=np.int64) <= sketch_distance]
            if len(hit):
                src.append(key[left[hit]])
                dst.append(np.full(len(hit), key[root]))
                found += left[hit].tolist()
                stay = np.ones(len(left), bool)
                stay[hit] = False
                left, f, m = left[stay], f[stay], None if m is None else m[stay]
    return np.concatenate(src), np.concatenate(dst)


def linked(fps: DataFrame, max_distance: int, blocks: int, sketch_distance: int | None) -> DataFrame:
    """Edges (src, dst) between keys whose fingerprints link; ``fps`` has distinct rows (key, fp[, sketch, bands]).

    With sketches, texts are candidates by their fingerprints or by a common band, and link by their sketches.

    The edges connect what all links connect, one star for each component of an anchor group.
    """
    spark = fps.sparkSession
    with_sketch = sketch_distance is not None
    names = ["bucket", "anchor", "key", "fp", "home"] + ["sketch"] * with_sketch
    rows = fps.count()
    per = (32 if blocks == 2 else 36) + BANDS * with_sketch
    buckets = max(96, rows * per // GROUP_ROWS)
    none = np.zeros(0, U), np.zeros(0, np.int64)
    hot = spark.sparkContext.broadcast(hot_names(fps, max_distance, blocks) if rows >= HOT_MEMBERS else none)
    large = LARGE_MEMBERS

    def expand(batches):
        code = AnchorCode(64 // blocks, max_distance // blocks)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fp), 20_000):
                f, k = fp[lo : lo + 20_000], key[lo : lo + 20_000]
                of = np.frombuffer(b"".join(batch.column(3).slice(lo, len(f)).to_pylist()), U) if with_sketch else None
                for row, anchor, home in entries(code, f.view(U), blocks, of):
                    for entry, bucket in dealt(anchor, k[row], *hot.value, buckets):
                        at = row[entry]
                        cols = [pa.array(bucket), pa.array(signed(anchor[entry])), pa.array(k[at]), pa.array(f[at]), pa.array(home[entry])]
                        if with_sketch:
                            cols.append(batch.column(2).take(pa.array(at + lo)))
                        yield pa.RecordBatch.from_arrays(cols, names=names)

    def compare(t: pa.Table) -> pa.Table:
        anchor = t["anchor"].to_numpy()
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        most = np.where(anchor < 0, 64, max_distance)  # a band is no bound of the fingerprints' distance
        key, fp, home = t["key"].to_numpy()[order], t["fp"].to_numpy()[order].view(U), t["home"].to_numpy(zero_copy_only=False)[order]
        first = np.searchsorted(anchor, anchor, "left")
        count = np.searchsorted(anchor, anchor, "right") - first
        marks = None
        if with_sketch:
            s = t["sketch"].combine_chunks()
            s = s.chunk(0) if isinstance(s, pa.ChunkedArray) else s
            marks = column_bytes(s)[0].view(U).reshape(-1, 4)[order]
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i in np.unique(first[count >= large]):
            of = slice(i, i + count[i])
            x, y = stars(key[of], fp[of], None if marks is None else marks[of], most[i], sketch_distance)
            a, b = spanning_stars(np.concatenate([a, x]), np.concatenate([b, y]))
        homes = np.flatnonzero(home & (count > 1) & (count < large))
        total = np.concatenate([[0], np.cumsum(count[homes])])
        i = 0
        while i < len(homes):
            j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, "right")) - 1)
            h, n = homes[i:j], count[homes[i:j]]
            x = np.repeat(h, n)
            y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[h], n)
            ok = (np.bitwise_count(fp[x] ^ fp[y]) <= most[x]) & (key[x] != key[y])
            x, y = x[ok], y[ok]
            if with_sketch and len(x):
                ok = np.bitwise_count(marks[x] ^ marks[y]).sum(1, dtype=np.int64) <= sketch_distance
                x, y = x[ok], y[ok]
            a, b = spanning_stars(np.concatenate([a, key[x]]), np.concatenate([b, key[y]]))
            i = j
        return pa.table({"src": pa.array(a, pa.int64()), "dst": pa.array(b, pa.int64())})

    schema = "bucket long, anchor long, key long, fp long, home boolean" + ", sketch binary" * with_sketch
    spread = fps.repartition(max(spark.sparkContext.defaultParallelism, rows // 20_000 + 1))
    return spread.mapInArrow(expand, schema).groupBy("bucket").applyInArrow(compare, "src long, dst long")


def similar(hashes: list[np.ndarray], similarity: float) -> np.ndarray:
    """The first text of the component of each text, linked by the exact Jaccard similarity of their distinct hashes.

    Each text found is compared only with those not yet found, so a cluster of copies costs about one pass.
    """
    least = Fraction(similarity).limit_denominator(10_000)
    up, down = least.numerator, least.denominator
    label, left = np.arange(len(hashes)), np.arange(len(hashes))
    size = np.array([len(h) for h in hashes])
    ids = np.unique(np.concatenate(hashes), return_inverse=True)[1]
    marked = np.zeros(int(ids.max()) + 1, bool)
    parts = np.split(ids, np.cumsum(size)[:-1])
    while len(left) > 1:
        root, left = left[0], left[1:]
        found, rest = [root], None
        while found and len(left):
            x = found.pop()
            if rest is None:
                rest = np.concatenate([parts[i] for i in left])
                heads = np.concatenate([[0], np.cumsum(size[left])[:-1]])
            marked[parts[x]] = True
            common = np.add.reduceat(marked[rest], heads, dtype=np.int64)
            marked[parts[x]] = False
            hit = common * down >= (size[left] + size[x] - common) * up
            if hit.any():
                label[left[hit]] = root
                found += left[hit].tolist()
                left, rest = left[~hit], None
    return label


def verified(docs: DataFrame, nodes: DataFrame, label: DataFrame, words: int, similarity: float, scratch: Scratch) -> DataFrame:
    """Edges (src, dst) that connect the keys of a component whose texts have the exact similarity.

    ``nodes`` has key, low (a doc_id of the key's text) and shingles, ``label`` has id and label; both are stored.

    A component of more than ``VERIFY_BYTES`` is first compared with one of its texts, the pivot, wherever its texts are.
    Only those that aren't similar to it are then compared with all others, block by block, so a family of copies of one text costs
    one pass, however large it is.
    """
    rows = label.count()
    member = scratch.store(nodes.join(label, nodes.key == label.id).select("key", "low", "shingles", "label"), "candidates", rows)
    sizes = member.groupBy("label").agg((F.sum("shingles") * 8 / VERIFY_BYTES).alias("share"), F.min("key").alias("pivot"))
    sizes = scratch.store(sizes.withColumn("parts", F.ceil("share").cast("int")), "shares", rows)
    total, most = sizes.agg(F.sum("share"), F.max("parts")).first()
    buckets = max(96, int(total or 0) + 1)
    member = scratch.store(member.join(sizes, "label").select("key", "low", "label", "parts"), "dealt", rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), text_key().alias("key"))

    def hashed(batches):
        for batch in batches:
            h = [shingle_hashes(x or b"", words).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(h, pa.binary())], names=["key", "label", "hashes"])

    def hashes_of(some: DataFrame) -> DataFrame:
        small = F.broadcast(some) if rows <= BROADCAST_ROWS else some.hint("merge")
        found = texts.join(small.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("low")))
        return found.select("key", "label", "text").mapInArrow(hashed, "key long, label long, hashes binary")

    def compare(t: pa.Table) -> pa.Table:
        key, label, column = t["key"].to_numpy(), t["label"].to_numpy(), t["hashes"]
        order = np.lexsort((key, label))
        src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for of in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
            root = similar([np.frombuffer(column[int(i)].as_buffer(), U) for i in of], similarity)
            other = np.flatnonzero(root != np.arange(len(of)))
            src.append(key[of[other]])
            dst.append(key[of[root[other]]])
        return pa.table({"src": pa.array(np.concatenate(src), pa.int64()), "dst": pa.array(np.concatenate(dst), pa.int64())})

    deal = ("label", "key", "hashes")
    sets = hashes_of(member.filter("parts <= 1")).select(F.pmod(F.xxhash64("label"), F.lit(buckets)).alias("part"), *deal)
    if (most or 0) <= 1:
        return sets.groupBy("part").applyInArrow(compare, "src long, dst long").filter("src <> dst")

    def against(batches):
        for batch in batches:
            near, size = [], []
            for h, p in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                near.append(bool(similar([np.frombuffer(p, U), np.frombuffer(h, U)], similarity)[1] == 0))
                size.append(len(h))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(near, pa.bool_()), pa.array(size, pa.int64())], names=["key", "label", "pivot", "near", "size"])

    large = scratch.store(hashes_of(member.filter("parts > 1")), "hashes")
    of = sizes.filter("parts > 1").select("label", "parts", "pivot")
    # the joins by label read stored tables on both sides: small ones are broadcast by their size, hot labels are split
    pivots = scratch.store(large.join(of, "label").filter("key = pivot").select("label", "pivot", F.col("hashes").alias("those")), "pivots")
    pairs = large.join(pivots, "label").select("key", "label", "pivot", "hashes", "those")
    near = scratch.store(pairs.mapInArrow(against, "key long, label long, pivot long, near boolean, size long"), "near", rows)
    rest = scratch.store(near.filter("not near").groupBy("label").agg(F.ceil(F.sum("size") / VERIFY_BYTES).cast("int").alias("strips")), "strips", rows)
    left = near.select("key", "label", "near").join(rest, "label").join(of, "label").select(F.col("key").alias("k"), "near", "strips", "parts")
    own, part = F.pmod(F.xxhash64("k", F.lit(2)), "strips").cast("int"), F.pmod(F.xxhash64("k", F.lit(1)), "parts").cast("int")
    left = large.join(left, F.col("key") == F.col("k")).select(*deal, "near", "strips", "parts", own.alias("own"), part.alias("part"))
    # a text that is left meets all parts in its strip; every text meets all strips in its part
    along = left.filter("not near").select(*deal, F.col("own").alias("strip"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    across = left.select(*deal, "near", "own", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("strip"), "part").filter("near or strip <> own")
    for some in (along, across.select(*deal, "strip", "part")):
        sets = sets.union(some.select(F.xxhash64("label", "strip", "part").alias("part"), *deal))
    found = sets.groupBy("part").applyInArrow(compare, "src long, dst long")
    return found.union(near.filter("near").select(F.col("key").alias("src"), F.col("pivot").alias("dst"))).filter("src <> dst")


def labelled(docs: DataFrame, scratch: Scratch, shingle_words: int, max_distance: int, distinct_shingles: bool, blocks: int, sketch_words: int, sketch_distance: int | None, similarity: float | None) -> tuple[DataFrame, DataFrame]:
    """Each row's (doc_id, fp, key), and each key's (key, component_id, stays); both read stored tables, and no other is left.

    ``component_id`` is the component's smallest doc_id and ``stays`` the smallest key of that doc_id's texts.
    """
    sketched = sketch_words > 0
    kept = fps = scratch.store(fingerprints(docs, shingle_words, distinct_shingles, sketch_words), "fingerprints")
    rows = fps.count()
    if sketched:
        nodes = scratch.store(fps.groupBy("key").agg(F.min("doc_id").alias("low"), *(F.first(c).alias(c) for c in ("fp", "sketch", "bands", "shingles"))), "nodes", rows)
        edges = linked(nodes.select("key", "fp", "sketch", "bands"), max_distance, blocks, sketch_distance)
    else:
        fps = fps.withColumn("key", F.col("fp"))
        nodes = scratch.store(fps.groupBy("key").agg(F.min("doc_id").alias("low")), "nodes", rows)
        edges = linked(nodes.select("key", F.col("key").alias("fp")), max_distance, blocks, None)
    label = components(scratch.store(edges.distinct(), "stars", rows))
    if sketched and similarity is not None:
        edges = verified(docs, nodes.select("key", "low", "shingles"), label, sketch_words, similarity, scratch)
        label = components(scratch.store(edges.distinct(), "verified", rows))
    member = scratch.store(nodes.select("key", "low").join(label, nodes.key == label.id).select("key", "low", "label"), "members", rows)
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "key")).alias("first")
    lowest = scratch.store(member.groupBy("label").agg(first).select("label", F.col("first.low").alias("lowest"), F.col("first.key").alias("stays")), "lowest", rows)
    joined = member.join(lowest, "label").select(F.col("key").alias("k"), "lowest", "stays")
    alone = F.col("k").isNull()
    final = nodes.select("key", "low").join(joined, F.col("key") == F.col("k"), "left")
    final = scratch.store(final.select("key", F.when(alone, F.col("low")).otherwise(F.col("lowest")).alias("component_id"), F.coalesce("stays", "key").alias("stays")), "final", rows)
    scratch.drop(kept, final)
    return fps.select("doc_id", "fp", "key"), final


def simhash_components(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3, distinct_shingles: bool = False, blocks: int = 2, sketch_words: int = 0, sketch_distance: int | None = None, similarity: float | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp (signed) and component_id, the smallest doc_id reachable by links.

    Words are lower-cased in A-Z and split at \\x20 and \\x09-\\x0D. Texts link if their fingerprints differ in at
    most ``max_distance`` bits. With ``sketch_words``, they link if their fingerprints do or they share a MinHash band of
    their distinct shingles of so many words, and the 256-bit SimHashes of these differ in at most ``sketch_distance``
    bits; with ``similarity``, these links only name candidates, and texts of a component of candidates link if the exact
    Jaccard similarity of their sets of distinct shingles is so much or more. Null and empty texts have fingerprint 0 and link to it. Rows of the same fingerprint (of the same text) are one node, so copies cost nothing; a null doc_id is kept and is never the
    smallest unless its component has no other. Other columns are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    fps, final = labelled(docs, scratch, shingle_words, max_distance, distinct_shingles, blocks, sketch_words, sketch_distance, similarity)
    return fps.join(final, "key").select("doc_id", "fp", "component_id")


def drop_copies(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3, distinct_shingles: bool = False, blocks: int = 2, sketch_words: int = 0, sketch_distance: int | None = None, similarity: float | None = None) -> DataFrame:
    """The rows of ``docs`` but those that another text of their component, see ``simhash_components``, stands for.

    Of each component the smallest doc_id's text stays, of that doc_id's texts the one of the smallest hash. A row is judged by its
    doc_id and text together: a doc_id that repeats with another text is another document. Rows that repeat both all
    stay or all go. A null doc_id comes last. All columns are kept; an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession)
    fps, final = labelled(docs, scratch, shingle_words, max_distance, distinct_shingles, blocks, sketch_words, sketch_distance, similarity)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("stays"))
    gone = fps.join(final, "key").filter(~stays).select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")).distinct()
    gone = scratch.store(gone, "gone")
    scratch.drop(gone)
    small = gone.count() <= BROADCAST_ROWS
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_gone_id")) & (text_key() == F.col("_gone_key"))
    return docs.join(F.broadcast(gone) if small else gone.hint("merge"), same, "left_anti")
