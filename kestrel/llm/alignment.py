"""Alignment of two tokenizers over the same text: overlaps, common ends and linked ids.

Tokenizer A is a byte-level BPE of the ``tokenizers`` library and reads a space and the text;
tokenizer B is a ``sentencepiece`` model, which puts that space in front by itself.  Either side's
tokens tile the same bytes.  Inside a task the tokens of a batch become two pandas frames, keyed by
their byte among the batch's texts; ``merge_asof`` finds for each token start the token of the other side that covers it,
in both directions.  The union of the two is all overlaps.  Overlapping tokens that end at the same
byte are linked, and cut the text into groups.

Neither tokenizer joins bytes across a single space between words, so most texts' ids are those of
their words, which both libraries encode once and a task keeps for a while (``Aligner.by_words``).

Corpus-wide counts of linked id pairs are one aggregation over each document's distinct pairs.
Two linked tokens end with the same bytes, so one is the end of the other: the two vocabularies
alone bound the number of pairs (``linkable_pairs``), whatever the corpus's size.

Defined results: a text that is null or empty, or whose tokens don't give its bytes back on either
side (U+2581 in the text, say), has no tokens, groups or links.  Repeated rows are rows of their
own.  Long texts are aligned whole, one at a time.  Columns of the input that are named like a
result are replaced; an empty input gives no rows.
"""

from __future__ import annotations

import codecs
import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.bpe import byte_characters
from kestrel.llm.textnum import map_batches, slices
from kestrel.plans.materialize import RunTables, write_and_reload

#: Bytes of text that are tokenised at a time (one text at least).
CHUNK = 1 << 18
#: Words that are encoded as one row.
ROW = 500
#: Words (and half as many matches) that a task keeps the ids of.  Beyond it a cache starts anew, and those
#: needed again come from the one before (bounds memory, not results).
CACHE_SIZE = 150_000
CACHE_CHARS = 64
#: Pairs that are broadcast at most: a row of two ids and two counts.
MAX_BROADCAST_PAIRS = 4_000_000

ALIGNED = {"n_a": "long", "n_b": "long", "n_groups": "long", "groups": "string",
           "links": "array<struct<a:int,b:int,n:long>>"}
OVERLAPS = {"a_token": "int", "b_token": "int", "a_id": "int", "b_id": "int", "first": "int", "end": "int",
            "linked": "boolean"}


@dataclass(frozen=True)
class Tokenizers:
    """Both tokenizers as values that travel to the tasks, and the bytes of their ids."""

    a_spec: str
    a_pattern: str
    b_model: bytes
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    b_by_words: bool = False


def by_words(model: bytes) -> bool:
    """Is a text of words between single spaces encoded word by word: merges of pairs that know no
    piece across a space (but runs of spaces), on the text as it is."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    normal, kinds = spec.normalizer_spec, spec.trainer_spec
    return (kinds.model_type == kinds.BPE and not kinds.treat_whitespace_as_suffix and not kinds.user_defined_symbols
            and not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
            and not any("▁" in p.piece[1:] and p.piece.strip("▁") for p in spec.pieces))


def read_tokenizers(a_path: str, b_path: str, a_pattern: str) -> Tokenizers:
    """A's JSON file and B's model file; ``a_pattern``: what A's byte-level pre-tokenizer splits by."""
    import sentencepiece
    from tokenizers import Tokenizer

    with open(a_path, encoding="utf-8") as f:
        spec = f.read()
    with open(b_path, "rb") as f:
        model = f.read()
    table = byte_characters()
    back = {c: b for b, c in enumerate(table)}
    vocabulary = Tokenizer.from_str(spec).get_vocab(with_added_tokens=True)
    a_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        # an added token isn't written in the byte table's characters
        a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
               for i in range(pieces.get_piece_size()) for p in [pieces.id_to_piece(i)]]
    return Tokenizers(spec, a_pattern, model, a_bytes, b_bytes, by_words(model))


def linkable_pairs(a_bytes: list[bytes], b_bytes: list[bytes]) -> int:
    """Id pairs of which one's bytes end with the other's: the most that can ever be linked."""
    def ends(of: list[bytes], among: list[bytes], whole: bool) -> int:
        known: dict[bytes, int] = {}
        for t in among:
            known[t] = known.get(t, 0) + 1
        return sum(known.get(t[k:], 0) for t in of for k in range(0 if whole else 1, len(t)))

    return ends(a_bytes, b_bytes, True) + ends(b_bytes, a_bytes, False)


@dataclass
class Batch:
    """Tokens of some texts: frames by position, and what was found between them.

    ``a``, ``b``: columns ``at`` (first byte among the batch's texts), ``doc`` (number of the text),
    ``id``, ``end``.  ``pairs``: overlapping (row of a, row of b).  ``a_ends``, ``b_ends``: does the
    token end a group.  ``linked``: which pairs end together.
    """

    a: pd.DataFrame
    b: pd.DataFrame
    pairs: np.ndarray
    linked: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    base: np.ndarray


class ByteLevel:
    """Ids of a byte-level tokenizer, match by match of its splitting pattern.

    The tokenizer encodes each match on its own, so a text's ids are those of its matches, and the
    ids of matches are kept for a while.  The pattern is the library's own for this pre-tokenizer; the
    ``regex`` module cuts alike as long as both know a character's class alike.  Texts with characters
    that are newer than Unicode 3.2, or whose class changed since, go to the library whole.
    """

    def __init__(self, spec: str, pattern: str, sizes: np.ndarray):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split, self.sizes = regex.compile(pattern).findall, sizes
        self.known: dict[str, bool] = {c: c.isprintable() or c in "\t\n\r" for c in map(chr, range(128))}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        said = json.loads(spec)
        cuts = said["pre_tokenizer"] or {}
        self.bare = None
        if (cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts.get("add_prefix_space")
                and not said["normalizer"] and all(t["special"] for t in said["added_tokens"])):
            # matches are what it would cut, so the model alone reads them, a line each, in the byte table's characters
            self.bare, self.table = Tokenizer.from_str(spec), "".join(byte_characters())
            self.bare.encode_special_tokens, self.bare.pre_tokenizer = True, pre_tokenizers.CharDelimiterSplit("\n")

    def knows(self, text: str) -> bool:
        """Are all characters' classes known alike."""
        chars = set(text)
        for c in chars.difference(self.known):
            kind = unicodedata.category(c)
            self.known[c] = kind == unicodedata.ucd_3_2_0.category(c) and kind[0] != "C"
        return all(map(self.known.__getitem__, chars))

    def known_of(self, texts: list[str]) -> list[str]:
        return texts if self.knows("".join(texts)) else list(filter(self.knows, texts))

    def cut(self, text: str) -> list[str]:
        """Matches of a text, or the text."""
        return self.split(text) if self.knows(text) else [text]

    def library(self, texts: list[str], by=None) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in (by or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def row(self, matches: list[str]) -> str:
        if not self.bare:
            return "".join(matches)
        return "\n".join(codecs.charmap_decode(m.encode(), "strict", self.table)[0] for m in matches)

    def fresh(self, matches: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each match and its ids.  Many are encoded as one row, and the bytes of the tokens tell which
        are whose: those of known characters, or the words behind a space, before which the library cuts."""
        words = self.known_of(matches) if self.bare else [m for m in matches if m[0] == " " and m[1:].isalpha()]
        rest = list(set(matches).difference(words))
        rows = [words[i:i + ROW] for i in range(0, len(words), ROW)]
        for row, ids in zip(rows, self.library(list(map(self.row, rows)), self.bare)):
            want, ends = np.cumsum([len(w.encode()) for w in row]), np.cumsum(self.sizes[ids])
            at = np.searchsorted(ends, want)
            if len(ids) <= at[-1] or (ends[at] != want).any():
                rest += row
                continue
            raw, begin = ids.tobytes(), 0
            for word, end in zip(row, ((at + 1) * 4).tolist()):
                yield word, raw[begin:end]
                begin = end
        yield from ((m, ids.tobytes()) for m, ids in zip(rest, self.library(rest)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.cache) > CACHE_SIZE // 2:
            self.older, self.cache = self.cache, {}
        cut = [self.cut(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.cache)
        again = {m for m in new if m in self.older}
        new = {m: self.older[m] for m in again} | dict(self.fresh(list(new - again)))
        self.cache.update(new)
        out = [np.frombuffer(b"".join(map(self.cache.__getitem__, matches)), np.int32) for matches in cut]
        for m in new:  # long ones are encoded each time, so that the cache stays small
            if len(m) > CACHE_CHARS:
                del self.cache[m]
        return out


class Aligner:
    """Tokenises and aligns texts; made once in each task."""

    def __init__(self, with_: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece

        self.bytes = with_.a_bytes, with_.b_bytes
        self.sizes = tuple(np.array([len(t) for t in of], np.int64) for of in self.bytes)
        self.a = ByteLevel(with_.a_spec, with_.a_pattern, self.sizes[0])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=with_.b_model)
        a, b = len(with_.a_bytes), len(with_.b_bytes)
        self.ids = a, b
        # the text of a token: its id, and "," inside a run or what ends the run, or nothing at a text's end
        self.words = pa.array([f"{i}{c}" for n, stops in ((a, (",", "|")), (b, (",", ";", ""))) for c in stops for i in range(n)])
        self.by_words = with_.b_by_words
        # ids of words behind a space: A's, and B's counted on from A's
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids by both sides of a space and each text; None if either side's don't give the bytes back."""
        out, behind = [], [" " + t for t in texts]
        a, b = self.a.encode(behind), self.b.encode(texts, num_threads=1) if texts else []
        for text, x, y in zip(behind, a, b):
            raw = text.encode()
            told = all(b"".join(map(of.__getitem__, ids)) == raw for of, ids in zip(self.bytes, (x.tolist(), y)))
            out.append((x, np.array(y, np.int32)) if told else None)
        return out

    def learn(self, words: list[str], row: int = ROW) -> None:
        """Keep the ids of words.  Many are encoded as one text, and the bytes of the tokens tell which
        are whose; of a text that doesn't give its bytes back each word is encoded alone."""
        rows = [words[i:i + row] for i in range(0, len(words), row)]
        for some, ids in zip(rows, self.whole([" ".join(r) for r in rows])):
            want = np.cumsum([len(w.encode()) + 1 for w in some])
            ends = [np.cumsum(of[x]) for of, x in zip(self.sizes, ids)] if ids else []
            at = [np.searchsorted(e, want) for e in ends]
            if ids and all((e[k] == want).all() for e, k in zip(ends, at)):
                parts = []
                for x, k, first in zip(ids, at, (0, self.ids[0])):
                    raw, stops = (x + np.int32(first)).tobytes(), ((k + 1) * 4).tolist()
                    parts.append([raw[i:j] for i, j in zip([0, *stops], stops)])
                self.known.update(zip(some, map(add, *parts)))
            elif len(some) > 1:
                self.learn(some, 1)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids as of ``whole``: those of a text's words, if each is known and has neither a space nor
        other white space beside the spaces around it."""
        if len(self.known) > CACHE_SIZE:
            self.older, self.known = self.known, {}
        cut = [t.split(" ") if self.by_words and not ("  " in t or "\n " in t or " \n" in t) else [] for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.known)
        again = {w for w in new if w in self.older}
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        self.learn(self.a.known_of([w for w in new - again if w and w == w.strip() and "▁" not in w]))
        out: list = []
        for words in cut:
            try:
                ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)
                by_b = ids >= self.ids[0]
                out.append((ids[~by_b], ids[by_b] - np.int32(self.ids[0])) if words else None)
            except KeyError:
                out.append(None)
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = ids
        for w in new:  # long ones are encoded each time, so that the cache stays small
            if len(w) > CACHE_CHARS:
                self.known.pop(w, None)
        return out

    def frame(self, side: int, ids: list[np.ndarray]) -> pd.DataFrame:
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        # tokens tile each text that has any, and the texts follow each other
        end = np.cumsum(self.sizes[side][flat])
        return pd.DataFrame({"at": end - self.sizes[side][flat], "doc": doc, "id": flat, "end": end})

    def align(self, texts: list[str | None]) -> Batch:
        """All overlaps of the texts' tokens."""
        told = [i for i, t in enumerate(texts) if t]
        none = np.zeros(0, np.int32)
        a_ids, b_ids, sizes = [none] * len(texts), [none] * len(texts), np.zeros(len(texts) + 1, np.int64)
        for i, ids in zip(told, self.encode([texts[i] for i in told])):
            if ids:
                (a_ids[i], b_ids[i]), sizes[i + 1] = ids, self.sizes[0][ids[0]].sum()
        base = np.cumsum(sizes)
        left, right = self.frame(0, a_ids), self.frame(1, b_ids)
        if not len(left):
            none = np.zeros(0, bool)
            return Batch(left, right, np.zeros((0, 2), np.int64), none, none, none, base)
        # both sides tile the same bytes, text behind text: a position tells its text, too
        covering = [pd.merge_asof(x[["at"]], y[["at"]].assign(token=np.arange(len(y))), on="at")["token"].to_numpy()
                    for x, y in ((left, right), (right, left))]
        a_in, b_in = covering  # of each A token's start: the B token; of each B token's start: the A token
        more = np.flatnonzero(a_in[b_in] != np.arange(len(right)))  # not found from the other side already
        pairs = np.concatenate([np.stack([np.arange(len(left)), a_in], 1), np.stack([b_in[more], more], 1)])
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        linked = left["end"].to_numpy()[pairs[:, 0]] == right["end"].to_numpy()[pairs[:, 1]]
        a_ends, b_ends = np.zeros(len(left), bool), np.zeros(len(right), bool)
        a_ends[pairs[linked, 0]] = True
        b_ends[pairs[linked, 1]] = True
        return Batch(left, right, pairs, linked, a_ends, b_ends, base)

    def group_texts(self, found: Batch, texts: int) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each text: ids of A and of B by group."""
        (a, b), marks = self.ids, (found.a_ends, found.b_ends)
        group = [np.cumsum(m) - m for m in marks]
        # tokens of a side before each group's end
        before = [np.concatenate([[0], np.flatnonzero(m) + 1]) for m in marks]
        word = np.empty(len(found.a) + len(found.b), np.int64)
        word[np.arange(len(found.a)) + before[1][group[0]]] = found.a["id"].to_numpy() + a * marks[0]
        word[np.arange(len(found.b)) + before[0][group[1] + 1]] = 2 * a + found.b["id"].to_numpy() + b * marks[1]
        counts = [np.bincount(x["doc"].to_numpy().astype(np.int64), minlength=texts) for x in (found.a, found.b)]
        stop = np.cumsum(counts[0] + counts[1])
        word[stop[counts[1] > 0] - 1] += b
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]).astype(np.int32)), self.words.take(pa.array(word)))
        return pc.binary_join(lists, "")

    def groups(self, found: Batch, texts: int) -> list[str]:
        return self.group_texts(found, texts).to_pylist()

    def links(self, found: Batch) -> tuple[np.ndarray, ...]:
        """Distinct linked id pairs of each text: (text, A id, B id, times)."""
        at = found.pairs[found.linked]
        a, b = found.a["id"].to_numpy()[at[:, 0]], found.b["id"].to_numpy()[at[:, 1]]
        doc = found.a["doc"].to_numpy()[at[:, 0]]
        key, n = np.unique((doc * self.ids[0] + a) * self.ids[1] + b, return_counts=True)
        return key // self.ids[1] // self.ids[0], key // self.ids[1] % self.ids[0], key % self.ids[1], n


def _run(df: DataFrame, text: str, into: dict[str, str], drop: tuple[str, ...], make) -> DataFrame:
    """``df`` with columns ``into``: ``make()`` gives a function from a chunk of rows to
    (row numbers or None, arrays of ``into``)."""
    rest = [c for c in df.columns if c not in (*drop, *into)]
    schema = T.StructType([*(df.schema[c] for c in rest),
                           *T._parse_datatype_string(", ".join(f"{c} {kind}" for c, kind in into.items())).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for rows in slices(batch, text, CHUNK):
                take, arrays = f(rows.column(text).to_pylist())
                kept = rows if take is None else rows.take(pa.array(take))
                yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in rest), *arrays], [*rest, *into])

    return map_batches(df.select(*dict.fromkeys([*rest, text])), run, schema)


def align(df: DataFrame, tokenizers: Tokenizers, text: str = "text") -> DataFrame:
    """``df`` without ``text`` and with the columns of ``ALIGNED``.

    ``groups``: ids of A, ``|``, ids of B for each group, ``;`` between groups.  ``links``: distinct
    linked (A id, B id) of the text and how many times they are linked there.
    """
    def make():
        aligner = Aligner(tokenizers)

        def chunk(texts):
            found, n = aligner.align(texts), len(texts)
            doc, a, b, times = aligner.links(found)
            count = lambda x: pa.array(np.bincount(x, minlength=n).astype(np.int64))
            links = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                                                pa.array(times.astype(np.int64))], ["a", "b", "n"])
            return None, [count(found.a["doc"].to_numpy().astype(np.int64)), count(found.b["doc"].to_numpy().astype(np.int64)),
                          count(found.a["doc"].to_numpy()[found.a_ends].astype(np.int64)),
                          aligner.group_texts(found, n),
                          pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), links)]

        return chunk

    return _run(df, text, ALIGNED, (text,), make)


def overlaps(df: DataFrame, tokenizers: Tokenizers, text: str = "text") -> DataFrame:
    """One row for each overlapping token pair of each text: ``df`` without ``text``, the tokens'
    numbers and ids, the bytes they share (``first`` to ``end``, of a space and the text), and
    whether they end together."""
    def make():
        aligner = Aligner(tokenizers)

        def chunk(texts):
            found = aligner.align(texts)
            at, a, b = found.pairs, found.a.iloc[found.pairs[:, 0]], found.b.iloc[found.pairs[:, 1]]
            doc = a["doc"].to_numpy().astype(np.int64)
            number = [at[:, k] - np.searchsorted(x["doc"].to_numpy(), doc) for k, x in enumerate((found.a, found.b))]
            first = np.maximum(a["at"].to_numpy(), b["at"].to_numpy()) - found.base[doc]
            end = np.minimum(a["end"].to_numpy(), b["end"].to_numpy()) - found.base[doc]
            columns = [*number, a["id"].to_numpy(), b["id"].to_numpy(), first, end]
            return doc, [*(pa.array(x.astype(np.int32)) for x in columns), pa.array(found.linked)]

        return chunk

    return _run(df, text, OVERLAPS, (text,), make)


def pair_counts(links: DataFrame) -> DataFrame:
    """``(a, b, count, best)`` of ``links(a, b, n)``: how many links hold the pair, and whether no
    other pair with that ``b`` has more."""
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def digests(df: DataFrame, a_path: str, b_path: str, a_pattern: str) -> DataFrame:
    """Per document: numbers of tokens, groups and links, how its links stand in the corpus, and a
    digest of the groups."""
    spark, tokenizers = df.sparkSession, read_tokenizers(a_path, b_path, a_pattern)
    bounded = linkable_pairs(tokenizers.a_bytes, tokenizers.b_bytes) <= MAX_BROADCAST_PAIRS
    with RunTables(spark, "alignment") as tables:
        # written once: the texts are tokenised once, and row numbers stay
        rows = tables.write(align(df.select("doc_id", "text"), tokenizers).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "links",
            F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")), "aligned")
        counts = tables.write(pair_counts(rows.select(F.inline("links"))), "counts")
        # a scan task holds a document's links, so they are summed before the shuffle
        told = (rows.select("row", F.inline("links")).join(F.broadcast(counts) if bounded else counts, ["a", "b"])
                .groupBy("row").agg(F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"),
                                    F.sum(F.col("n") * F.col("count")).alias("count_sum")))
        whole = rows.drop("links").join(told, "row", "left")
        return write_and_reload(whole.select(
            F.col("doc_id").cast("long"), "n_a", "n_b", "n_groups",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")),
            "groups_sha256"), "alignment")
