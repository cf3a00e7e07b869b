"""Shared helpers: tables, scratch storage on the cluster's shared folder, and vectorised text hashing."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chroniq.sources.stored import Scratch, delete, materialize, scratch_path, scratch_root

__all__ = ["Scratch", "delete", "materialize", "scratch_path", "scratch_root"]

#: Bytes of text that the vectorised scanners handle at a time (a longer document is one piece).
PIECE_BYTES = 1 << 20

#: Bytes of an Arrow batch.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each session, so that workers can import it wherever they run.

    Also lower the size of Arrow batches, where it is at its default: texts of any length then come in small batches.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_chroniq_shipped", False):
        root = Path(__file__).resolve().parents[1]
        path = f"{tempfile.mkdtemp()}/chroniq.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(path)  # served by the driver to every executor
        sc._chroniq_shipped = True
    if spark.conf.get(BATCH_SETTING) == "67108864b":  # nobody has chosen another size
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


# ---------------------------------------------------------------- vectorised text


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary Arrow column and the n + 1 offsets of its values; a null is an empty value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    n, at = len(column), column.offset
    _, offs, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES):
    """Ranges [i, j) of whole documents of about ``most`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


#: Bytes that separate words: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes outside tokens: every ASCII byte but letters and digits.
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[0x80:] = False
for _r in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
    NON_ALNUM[list(_r)] = False
#: ASCII lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray):
    """Start, end and document of each maximal run of bytes that are not separators."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = ~separator[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    tails = offsets[1:]
    after[tails[tails > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


U = np.uint64
_P, _Q = U(0x9E3779B97F4A7C15 | 1), U(0xC2B2AE3D27D4EB4F | 1)


def _inverse(p: np.uint64) -> np.uint64:
    return U(pow(int(p), -1, 1 << 64))


_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: np.uint64, n: int, inverse: bool = False) -> np.ndarray:
    """base ** i mod 2**64 for i up to n at least."""
    key = (int(base), inverse)
    if key not in _powers or len(_powers[key]) <= n:
        out = np.full(max(n + 1, PIECE_BYTES + 1), _inverse(base) if inverse else base, U)
        out[0] = 1
        with np.errstate(over="ignore"):
            _powers[key] = np.cumprod(out, dtype=U)
    return _powers[key]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x = x * U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x = x * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash of the bytes; see span_hash."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(_P, len(data))[: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] that depends only on those bytes."""
    with np.errstate(over="ignore"):
        inverse = powers(_P, len(sums), True)
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U) * _Q)


def gram_hash(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of words[i:i+k] for each i (also across documents; the caller masks those)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, U)
        np.cumsum(words * powers(_Q, len(words))[: len(words)], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * powers(_Q, len(words), True)[:n])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def binary_list(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
