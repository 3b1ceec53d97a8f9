"""Improbable-feature digests of texts, and the likeness of two digests.

Every window of ``WIDTH`` bytes has an entropy.  Windows are ranked by how far it lies from what
prose usually has: the farther, the rarer (runs of few bytes are never taken).  Each run of
``SPREAD`` neighbouring windows votes for its rarest one (ties: the leftmost); windows with
``VOTES`` votes or more are the text's features.  Features are hashed into a chain of Bloom
filters, ``PER_FILTER`` distinct features each, in the order of their first occurrence.  Two
digests are compared filter by filter: shared bits beyond those expected by chance, as a share of
the most that could be shared; each filter of the shorter digest takes its best partner, and the
mean of these is the likeness (0 to 1).

Entropies are sums of whole numbers (scaled logarithms), so a digest depends on nothing but the
text's bytes.  A text of fewer than ``WIDTH`` bytes is one feature, and so is a longer one whose windows are all
trivial; a null or empty text has none.
Two digests without features are alike (1), one without and one with are not (0).  Repeated rows
have equal digests, and an empty table gives no rows.

``with_successors`` orders documents without a global sort: by id, and rows that share an id by a
hash of the text, so that an id with very many texts is dealt like any others (repeated rows stay
together: they follow each other anyway).  Documents are dealt to buckets of neighbours, bounded by quantiles of a
sample (``PER_BUCKET`` rows for each of at most ``MAX_BUCKETS`` buckets), and the first document of
each bucket is copied to the bucket before it.  A bucket streams through its task; no task holds
one.  Null ids count as the lowest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textnum import U64, WordHasher, flat, map_batches

WIDTH = 64
SPREAD = 64
VOTES = 16
FILTER_BYTES = 256
HASHES = 5
PER_FILTER = 160
TYPICAL = 680  # entropy of prose, in thousandths of the most that a window can have
TRIVIAL = 100  # windows of less entropy are never features
BUCKET_ROWS = 1000
MAX_BUCKETS = 50_000
PER_BUCKET = 20

_SCALE = 1 << 10
_COUNTS = np.arange(WIDTH + 2, dtype=float)
_SUMS = np.rint(_SCALE * _COUNTS * np.log2(np.maximum(_COUNTS, 1))).astype(np.int32)
_STEPS = np.diff(_SUMS)  # what one more equal byte adds to the sum of c * log2(c)
_BLOCK = 1 << 15


def entropies(buf: np.ndarray) -> np.ndarray:
    """Entropy of each window of ``WIDTH`` bytes, in thousandths (whole numbers).

    A window slides by one byte: the sum over byte values of c * log2(c) loses the step of the
    byte that leaves and gains that of the byte that comes; both follow from how many of the
    ``WIDTH - 1`` bytes after, or before, a byte equal it.
    """
    n = len(buf) - WIDTH + 1
    out = np.empty(max(n, 0), np.int16)
    most = int(WIDTH * np.log2(WIDTH) * _SCALE)
    for begin in range(0, n, _BLOCK):
        b = buf[begin:begin + _BLOCK + WIDTH - 1]
        later, earlier = np.zeros(len(b), np.uint8), np.zeros(len(b), np.uint8)
        for d in range(1, WIDTH):
            same = (b[d:] == b[:-d]).view(np.uint8)
            later[:-d] += same
            earlier[d:] += same
        come = np.cumsum(_STEPS[earlier], dtype=np.int32)[WIDTH - 1:]
        gone = np.cumsum(_STEPS[later], dtype=np.int32)[:len(come)]
        total = come.copy()
        total[1:] -= gone[:-1]
        out[begin:begin + len(total)] = (most - total).astype(np.int64) * 1000 // most
    return out


def rarities(buf: np.ndarray) -> np.ndarray:
    """0 for trivial windows, else 1 + the distance from the typical entropy."""
    e = entropies(buf)
    return np.where(e < TRIVIAL, 0, np.abs(e - TYPICAL) + 1)


class Digester:
    """Digests of the texts of Arrow arrays."""

    def __init__(self):
        self.hasher = WordHasher(np.zeros(256, bool), np.arange(256, dtype=np.uint8))

    def selected(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each feature, in the order of the texts."""
        size = np.diff(offsets)
        short = np.flatnonzero((size > 0) & (size < WIDTH))
        n = len(buf) - WIDTH + 1
        if n <= 0:
            return offsets[short], offsets[short + 1]
        text_of = np.repeat(np.arange(len(size)), size)[:n]
        inside = np.arange(n) + WIDTH <= offsets[1:][text_of]
        rare = np.where(inside, rarities(buf), 0).astype(np.int64)
        top = 1 << 40
        key = rare * top + (top - 1 - np.arange(n))  # the largest: rarest, then leftmost
        reach = 1
        while reach < SPREAD:
            step = min(reach, SPREAD - reach)
            if len(key) <= step:
                break
            key = np.maximum(key[:-step], key[step:])
            reach += step
        votes = np.zeros(n, np.int64)
        windows = size - WIDTH + 1
        runs = np.maximum(windows - SPREAD + 1, (windows > 0).astype(np.int64))
        if reach == SPREAD and len(key):
            at = np.arange(len(key))
            whole = at + SPREAD + WIDTH - 1 <= offsets[1:][text_of[:len(key)]]
            np.add.at(votes, top - 1 - (key[whole] & (top - 1)), 1)
        for k in np.flatnonzero((windows > 0) & (windows < SPREAD)):
            begin = offsets[k]
            votes[begin + rare[begin:begin + windows[k]].argmax()] += 1
        chosen = np.flatnonzero((votes > 0) & (votes >= np.minimum(VOTES, runs)[text_of]) & (rare > 0))
        starts = np.concatenate([chosen, offsets[short]])
        ends = np.concatenate([chosen + WIDTH, offsets[short + 1]])
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order]

    def digests(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text its filters, (number of filters, FILTER_BYTES / 8) 64-bit words."""
        buf, offsets = flat(texts)
        starts, ends = self.selected(buf, offsets)
        bare = np.diff(offsets) > 0
        bare[np.searchsorted(offsets, starts, side="right") - 1] = False
        starts, ends = np.concatenate([starts, offsets[:-1][bare]]), np.concatenate([ends, offsets[1:][bare]])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        hashes = self.hasher.hashes(buf, starts, ends)
        text_of = np.searchsorted(offsets, starts, side="right") - 1
        order = np.lexsort((starts, hashes, text_of))
        t, h = text_of[order], hashes[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        keep = np.sort(order[first])
        hashes, text_of = hashes[keep], text_of[keep]
        count = np.bincount(text_of, minlength=len(texts))
        number = np.arange(len(keep)) - np.repeat(np.cumsum(count) - count, count)
        filters = -(-count // PER_FILTER)
        base = np.concatenate([[0], np.cumsum(filters)])
        bits = np.zeros((base[-1], FILTER_BYTES * 8), bool)
        row = base[text_of] + number // PER_FILTER
        for k in range(HASHES):
            bits[row, (hashes >> U64(11 * k)) & U64(FILTER_BYTES * 8 - 1)] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        return [words[base[i]:base[i + 1]] for i in range(len(texts))]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two digests, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    n_a = np.bitwise_count(a).sum(1, dtype=np.int64)
    n_b = np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for filter_, n in zip(a, n_a):
        shared = np.bitwise_count(b & filter_).sum(1, dtype=np.int64)
        chance = n * n_b / (FILTER_BYTES * 8)
        most = np.minimum(n, n_b)
        total += float(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    return total / len(a)


def written(digest: np.ndarray) -> str:
    """A digest as text: number of filters, and their bytes in base64."""
    return f"{len(digest)}:{base64.b64encode(digest.tobytes()).decode()}"


def sortable(*columns: np.ndarray) -> np.ndarray:
    """Rows of 64-bit whole numbers as byte strings in the same order."""
    rows = np.stack([np.asarray(c, np.int64) for c in columns], 1)
    return (rows ^ np.int64(-(1 << 63))).view(np.uint64).astype(">u8").view(f"S{8 * rows.shape[1]}").ravel()


def with_successors(documents: DataFrame) -> DataFrame:
    """Rows ``bucket, doc_id, text, copied``: within a bucket by descending id, each row is followed
    by its successor; the last row of a bucket is a copy from the next bucket (of the first
    document, in the end)."""
    lowest = -(1 << 63)
    order = ["place", "by_text"]
    rows = documents.select("doc_id", "text").select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("place"),
        F.xxhash64("text").alias("by_text"))
    told = rows.agg(F.count("*").alias("n"), F.max(F.struct(*order)).alias("top")).first()
    n, buckets = told["n"], min(max(told["n"] // BUCKET_ROWS, 1), MAX_BUCKETS)
    share = min(1.0, PER_BUCKET * buckets / max(n, 1))
    drawn = rows.filter(F.xxhash64(F.lit("sample"), *order).bitwiseAND((1 << 62) - 1) < F.lit(int(share * (1 << 62))))
    sample = drawn.select(*order).toArrow()  # about PER_BUCKET rows of two numbers for each bucket
    keys = np.unique(sortable(*(sample.column(c).to_numpy() for c in order)))
    some = keys[np.arange(1, buckets) * len(keys) // buckets] if len(keys) else keys
    bounds = np.unique(np.concatenate([some, sortable(*([x] for x in told["top"]))])) if n else some

    @F.pandas_udf("bucket int, next int")
    def dealt(place, by_text):
        import pandas as pd

        key = sortable(place, by_text)
        at = np.searchsorted(bounds, key)
        return pd.DataFrame({"bucket": at, "next": np.where(bounds[at] == key, (at + 1) % len(bounds), -1)})

    # bucket k holds the rows in (bounds[k - 1], bounds[k]]; bounds are rows that occur, and a row that
    # occurs repeatedly is copied as often: the first copy follows the bucket's last row
    return (rows.withColumn("at", dealt(*order))
            .select("doc_id", "text", *order, F.inline(F.filter(F.array(
                F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("copied")),
                F.struct(F.col("at.next").alias("bucket"), F.lit(True).alias("copied"))),
                lambda x: x["bucket"] >= 0)))
            .repartition("bucket").sortWithinPartitions("bucket", "copied", *map(F.desc, order), "text")
            .select("bucket", "doc_id", "text", "copied"))


def edited(text: str, successor: str) -> str:
    """The last half (rounded down) of ``text`` replaced by as much of ``successor``'s beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + successor[:half]


def fingerprints(documents: DataFrame) -> DataFrame:
    """Digest of every document and of its edited text, and their likenesses."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copied"))):
                held.append(row)
                size += len(row[1] or "")
                if size >= 1 << 19 and len(held) > 1:
                    yield held
                    held, size = held[-1:], len(held[-1][1] or "")
        if len(held) > 1:
            yield held

    def run(batches):
        digester = Digester()
        for rows in parts(batches):
            texts = [r[1] or "" for r in rows]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            own = digester.digests(pa.array(texts, pa.large_string()))
            other = digester.digests(pa.array(changed, pa.large_string()))
            at = [i for i in range(len(changed)) if not rows[i][2]]
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in at], pa.int64()),
                pa.array([len(texts[i]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(changed[i].encode()).hexdigest() for i in at], pa.string()),
                pa.array([written(own[i]) for i in at], pa.string()),
                pa.array([written(other[i]) for i in at], pa.string()),
                pa.array([likeness(own[i], other[i]) for i in at], pa.float64()),
                pa.array([likeness(own[i], own[i + 1]) for i in at], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return map_batches(
        with_successors(documents), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
