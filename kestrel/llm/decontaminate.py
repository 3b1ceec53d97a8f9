"""Benchmark decontamination by suffix arrays over the training documents.

Each task turns its documents into shards of about ``SHARD_WORDS`` words and sorts the shard's
suffixes (word positions) into a suffix array.  Every suffix of every benchmark item is then
binary-searched in it: its longest verbatim match follows from its neighbours, and those that
match a whole window are located by the range of suffixes that begin with the window.  No row is
shuffled and nothing depends on how often a passage repeats.

The benchmark's distinct rows are dealt to blocks of about ``BLOCK_BYTES`` of text by a hash of the whole
row.  All blocks travel with the one Python stage of the plan, compressed, and a task unpacks one at
a time: a shard is sorted once and searched block by block, and what the blocks find is merged.  The
benchmark is a stated set of queries that goes through the driver; one of more than
``max_bytes`` of text fails the job, and can be given in several calls.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.  A window is
``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window.
Documents without words (null, empty) match nothing and are kept; items without words match
nothing.  An item without an id has the id ''.  Rows that share an item_id are one item; repeated
documents are judged one by one.  Empty tables: no documents give no rows, no items leave every
document clean.  A column that
has the name of a new one is replaced; ``prefix`` keeps them apart.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.textnum import WordHasher, map_batches, separators, slices

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_BYTES = 4 << 20
MAX_BYTES = 1 << 30
SEPARATORS = separators(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]) )
SEPARATORS[65:91] = False  # lower-cased before words are cut

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
#: What ``match`` adds: words of the text, hit word ranges, ids of items with a window in the
#: text, and the longest verbatim match (words, its first word in the text, its item).
MATCHES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("hit_spans", _SPANS),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest_words", T.LongType()),
    T.StructField("longest_start", T.LongType()), T.StructField("longest_item", T.StringType())])


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``words`` (whole numbers, 0: a text's end) ordered by their first ``depth`` words.

    Prefix multiplication: ranks by the first s words are packed, as many as fit in 63 bits, into
    one key that ranks the first k * s words.
    """
    n = len(words)
    bits = max(int(max(words.max(initial=0), n)).bit_length(), 1)
    per_key = max(63 // bits, 2)
    rank, step = words.astype(np.uint64), 1
    order = np.argsort(rank, kind="stable") if depth <= 1 or not n else None
    while order is None or step < depth:
        key = rank << np.uint64(bits * (per_key - 1))
        for j in range(1, per_key):
            shift = j * step
            if shift < n:
                key[:n - shift] |= rank[shift:] << np.uint64(bits * (per_key - 1 - j))
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.ones(n, np.uint64)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new)
        step *= per_key
        if not n or rank.max() == n:
            break
    return order


def find(array: np.ndarray, words: np.ndarray, pattern: np.ndarray, starts: np.ndarray, limits: np.ndarray,
         after: bool) -> np.ndarray:
    """Where each pattern stands in the suffix array: before, or ``after``, the suffixes that begin
    with it.  Pattern i is ``pattern[starts[i]:starts[i] + limits[i]]``; ``words`` ends in a 0."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        at, from_, limit = array[middle], starts[open_], limits[open_]
        right = np.zeros(open_.size, bool)
        live = np.arange(open_.size)
        d = 0
        while live.size:
            done = limit[live] <= d
            if done.any():
                right[live[done]] = after
                live = live[~done]
            a = words[np.minimum(at[live] + d, len(words) - 1)]
            b = pattern[from_[live] + d]
            right[live[a < b]] = True
            live = live[a == b]
            d += 1
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
    return low


def common(words: np.ndarray, at: np.ndarray, pattern: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Number of leading words that suffix ``at[i]`` shares with pattern i; -1 in ``at``: none."""
    out = np.zeros(len(starts), np.int64)
    live = np.flatnonzero(at >= 0)
    d = 0
    while live.size:
        live = live[limits[live] > d]
        same = words[np.minimum(at[live] + d, len(words) - 1)] == pattern[starts[live] + d]
        live = live[same]
        d += 1
        out[live] = d
    return out


class Tests:
    """The suffixes of a block of items, ready to be searched for."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        hasher = WordHasher(SEPARATORS)
        hashes, offsets = hasher.words(pa.array(texts, pa.string()))
        self.ids = np.array(ids, dtype=object)
        self.words = hashes
        n = np.diff(offsets)
        self.item = np.repeat(np.arange(len(ids)), n)
        self.starts = np.arange(len(hashes))
        self.lengths = np.repeat(offsets[1:], n) - self.starts
        width = np.repeat(np.minimum(n, window), n)
        self.width = np.where(self.lengths >= width, width, 0)  # 0: too near the end for a window
        self.depth = int(self.lengths.max(initial=0))

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """The items' own suffix array, for the longest match of a document position."""
        known, rank = np.unique(self.words, return_inverse=True)
        # a 0 after each item keeps matches inside it
        place = self.starts + self.item
        words = np.zeros(len(self.words) + len(self.ids) + 1, np.int64)
        words[place] = rank + 1
        array = suffix_array(words, self.depth + 1)
        return known, words, array[words[array] > 0], place


class Shard:
    """Documents of a task as one array of words, and its suffixes in order by ``depth`` words."""

    def __init__(self, parts: list[pa.Array], hasher: WordHasher, depth: int):
        hashed = [hasher.words(p) for p in parts]
        self.counts = np.concatenate([np.diff(o) for _, o in hashed])
        self.first = np.concatenate([[0], np.cumsum(self.counts + 1)])  # with a text's end after each text
        self.text_of = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(len(self.text_of)) + self.text_of
        self.hashes = np.concatenate([h for h, _ in hashed])
        if len(self.hashes) and depth:
            self.known, rank = np.unique(self.hashes, return_inverse=True)
            self.words = np.zeros(self.first[-1] + 1, np.int64)
            self.words[self.place] = 2 * (rank + 1)
            self.array = suffix_array(self.words >> 1, depth)

    def matches(self) -> list[dict]:
        """A row for each text, without matches as yet."""
        return [{"n_words": int(c), "hit_spans": [], "items": [], "longest_words": 0, "longest_start": None,
                 "longest_item": None} for c in self.counts]


class Matcher:
    """Searches shards for one block of items."""

    def __init__(self, tests: Tests):
        self.tests = tests
        if len(tests.words):
            self.known, self.test_words, self.test_array, place = tests.order()
            self.owner = np.zeros(len(self.test_words), np.int64)
            self.owner[place] = tests.item

    def search(self, shard: Shard) -> list[dict]:
        """Matches of each text of the shard."""
        t, out = self.tests, shard.matches()
        if not len(shard.hashes) or not len(t.words):
            return out
        known, words, array, first = shard.known, shard.words, shard.array, shard.first
        near = np.searchsorted(known, t.words)
        seen = known[np.minimum(near, len(known) - 1)] == t.words
        pattern = 2 * (near + 1) - ~seen  # odd: stands between the shard's words

        low = find(array, words, pattern, t.starts, t.lengths, after=False)
        before, behind = np.where(low > 0, array[np.maximum(low - 1, 0)], -1), \
            np.where(low < len(array), array[np.minimum(low, len(array) - 1)], -1)
        longest = np.maximum(common(words, before, pattern, t.starts, t.lengths),
                             common(words, behind, pattern, t.starts, t.lengths))
        hit = np.flatnonzero((t.width > 0) & (longest >= t.width))
        if not hit.size:
            return out
        begin = find(array, words, pattern, t.starts[hit], t.width[hit], after=False)
        end = find(array, words, pattern, t.starts[hit], t.width[hit], after=True)
        # equal windows have equal ranges: each range is laid out once
        _, one, same = np.unique(np.stack([begin, t.width[hit]]), axis=1, return_index=True, return_inverse=True)
        size = (end - begin)[one]
        window = np.repeat(np.arange(len(one)), size)
        at = array[np.repeat(begin[one] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        width = t.width[hit][one][window]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + width, -1)
        covered = (np.cumsum(cover) > 0).astype(np.int8)
        edge = np.diff(covered, prepend=0)
        for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)):
            k = int(np.searchsorted(first, a, side="right")) - 1
            out[k]["hit_spans"].append({"start": int(a - first[k]), "end": int(b - first[k])})

        by_window = np.argsort(same.ravel(), kind="stable")
        cut = np.searchsorted(same.ravel()[by_window], np.arange(len(one) + 1))
        owners = [np.unique(t.item[hit][by_window[cut[w]:cut[w + 1]]]) for w in range(len(one))]
        text_at = np.searchsorted(first, at, side="right") - 1
        pairs = np.unique(np.stack([text_at, window]), axis=1)
        for k in np.unique(pairs[0]):
            mine = np.unique(np.concatenate([owners[w] for w in pairs[1][pairs[0] == k]]))
            out[k]["items"] = sorted(set(t.ids[mine]))
        self._extend(out, np.unique(at), shard.hashes, shard.place, shard.text_of, first)
        return out

    def _extend(self, out, at, hashes, place, text_of, first) -> None:
        """The longest verbatim match that begins at each hit position, per text."""
        index = np.searchsorted(place, at)
        near = np.searchsorted(self.known, hashes)
        seen = self.known[np.minimum(near, len(self.known) - 1)] == hashes
        pattern = 2 * (near + 1) - ~seen
        tests = self.test_words * 2
        limits = np.minimum(np.searchsorted(text_of, text_of[index], side="right") - index, self.tests.depth)
        low = find(self.test_array, tests, pattern, index, limits, after=False)
        last = len(self.test_array) - 1
        before = np.where(low > 0, self.test_array[np.maximum(low - 1, 0)], -1)
        behind = np.where(low <= last, self.test_array[np.minimum(low, last)], -1)
        a, b = (common(tests, x, pattern, index, limits) for x in (before, behind))
        for i in range(len(at)):
            row = out[text_of[index[i]]]
            if max(a[i], b[i]) > row["longest_words"]:
                row["longest_words"] = int(max(a[i], b[i]))
                row["longest_start"] = int(at[i] - first[text_of[index[i]]])
                row["longest_item"] = self.tests.ids[self.owner[(before if a[i] >= b[i] else behind)[i]]]


def merge(old: dict, new: dict) -> dict:
    """Matches of two blocks of items in one text."""
    spans = []
    for s in sorted(old["hit_spans"] + new["hit_spans"], key=lambda s: (s["start"], s["end"])):
        if spans and s["start"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], s["end"])
        else:
            spans.append(dict(s))
    best = new if new["longest_words"] > old["longest_words"] else old
    return {**best, "n_words": new["n_words"], "hit_spans": spans,
            "items": sorted({*old["items"], *new["items"]})}


def _block(packed: bytes, window: int) -> Tests:
    ids, texts = pickle.loads(zlib.decompress(packed))
    return Tests(ids, texts, window)


def match(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, prefix: str = "",
          block_bytes: int = BLOCK_BYTES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``documents`` with the columns of ``MATCHES``, their names behind ``prefix``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    if total > max_bytes:
        raise ValueError(f"the benchmark has {total} bytes of text: give it in parts, or set max_bytes")
    blocks = max(1, math.ceil(total / block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))).orderBy("block", "id", "text")
    held: dict[int, tuple[list, list]] = {}
    for r in dealt.toLocalIterator():
        ids, texts = held.setdefault(r["block"], ([], []))
        ids.append(r["id"])
        texts.append(r["text"])
    packed = [zlib.compress(pickle.dumps(x), 1) for x in held.values()]
    depth = max((_block(p, window).depth for p in packed), default=0)

    fields = MATCHES.fieldNames()
    names = [prefix + c for c in fields]
    rest = [c for c in documents.columns if c not in names]
    schema = T.StructType([*(documents.schema[c] for c in rest), *(T.StructField(prefix + f.name, f.dataType) for f in MATCHES)])
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = dict(zip(fields, [pa.int64(), pa.list_(span), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEPARATORS)
        only = Matcher(_block(packed[0], window)) if len(packed) == 1 else None

        def flush(held):
            shard, rows = Shard([b.column("text") for b in held], hasher, depth), None
            for p in packed:  # one block is unpacked at a time
                found = (only or Matcher(_block(p, window))).search(shard)
                rows = found if rows is None else [merge(a, b) for a, b in zip(rows, found)]
            rows = rows or shard.matches()
            for b in held:
                mine, rows = rows[:b.num_rows], rows[b.num_rows:]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in rest), *(pa.array([m[c] for m in mine], types[c]) for c in fields)],
                    [*rest, *names])

        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                held.append(part)
                size += part.column("text").nbytes
                if size >= 6 * SHARD_WORDS:  # a word takes about six bytes
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return map_batches(documents.select(*rest), run, schema)


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a window of the benchmark."""
    return match(documents, benchmark, prefix="__").filter(F.size("__hit_spans") == 0).select(*documents.columns)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items with windows in it, and whether it is contaminated."""
    found = match(documents.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"))


REPORT_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), test_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM (SELECT *, least(10, len(w)) AS n FROM items WHERE len(w) > 0))
), hits AS (
  SELECT d.row_id, d.p, t.n, t.item_id
  FROM (SELECT row_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS win
        FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
              FROM words, (SELECT DISTINCT n FROM test_windows) WHERE len(w) >= n)) d
  JOIN test_windows t ON t.win = d.win AND t.n = d.n
), hit_words AS (
  SELECT row_id, count(DISTINCT q) AS n_hit FROM (SELECT row_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY row_id
), hit_items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row_id, item_id FROM hits) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)
"""
