"""Vectorised helpers over the bytes of Arrow text columns (used inside tasks).

A batch's texts are handled as one UTF-8 byte array plus offsets.  Words are byte runs between
separator bytes; a word's hash is a polynomial over random byte codes modulo 2**64, taken from
prefix sums, so that no Python object is made per word.  Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_CHUNK = 1 << 18

#: The 256 bytes with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Rows of an Arrow batch between the JVM and a Python worker, where the session leaves Spark's
#: default: documents may be long.
BATCH_ROWS = 1000


def map_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_ROWS`` rows."""
    name, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, and the n + 1 offsets of its texts."""
    arr = texts.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = _CHUNK) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of about ``max_bytes`` of text each, one row at least."""
    _, offsets = flat(batch.column(column))
    begin, n = 0, batch.num_rows
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + max_bytes, side="right")) - 1
        end = min(max(end, begin + 1), n)
        yield batch.slice(begin, end - begin)
        begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class WordHasher:
    """Word boundaries and word hashes of byte arrays.

    ``separator``: 256 booleans, true for bytes that end a word; ``fold``: 256 bytes that a byte
    is replaced with before hashing (lower-casing, say).
    """

    def __init__(self, separator: np.ndarray, fold: np.ndarray = LOWER):
        codes = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
        self.inside = ~separator
        self.codes = codes[fold]
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) <= n:
            size = max(n + 1, _CHUNK)
            step = np.full(size, _BASE, np.uint64)
            back = np.full(size, pow(_BASE, -1, 2**64), np.uint64)
            step[0] = back[0] = 1
            self.power, self.inverse = np.cumprod(step), np.cumprod(back)

    def bounds(self, buf: np.ndarray, offsets: np.ndarray):
        """Start and end of each word, and the n + 1 offsets of each text's words."""
        inside = self.inside[buf]
        if not len(buf):
            none = np.empty(0, np.int64)
            return none, none, np.zeros(len(offsets), np.int64)
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        before = np.empty(len(buf), bool)
        before[0] = False
        before[1:] = inside[:-1]
        before[offsets[full]] = False
        after = np.empty(len(buf), bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[offsets[full + 1] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One 64-bit hash per byte range; equal folded bytes give equal hashes."""
        self._grow(len(buf))
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.codes[buf] * self.power[:len(buf)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts] + U64(len(self.codes)))

    def words(self, texts: pa.Array):
        """Hashes of all words, and the n + 1 offsets of each text's words."""
        buf, offsets = flat(texts)
        starts, ends, per_text = self.bounds(buf, offsets)
        return self.hashes(buf, starts, ends), per_text


def separators(chars: bytes) -> np.ndarray:
    """256 booleans, true for the given bytes."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table
