"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file (base64 token, rank per line) becomes a BPE model of the ``tokenizers`` library: each
of the 256 bytes is written as one printable character, a token is the string of its bytes'
characters, and every way to cut a token into two tokens is a merge at that token's rank.  Texts
are cut by the splitting pattern; each match is encoded on its own.  Inside a task the distinct
matches of an Arrow batch go through ``Tokenizer.encode_batch_fast`` once; a bounded cache serves
repeats.  Decoding maps ids to their characters and reverses the byte table; bytes of a character
that was cut between tokens meet again, since whole id sequences are joined as bytes first.

Nulls and empty texts give no ids and decode to no bytes.  Repeated rows are encoded one by one.
Columns other than the text are passed through untouched.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from kestrel.llm.textnum import map_batches, slices

#: Matches kept in a task's cache; beyond it the cache starts anew (bounds memory, not results).
CACHE_SIZE = 150_000
#: Longer matches are encoded each time, so that the cache stays small.
CACHE_CHARS = 64


def byte_characters() -> str:
    """256 characters, one for each byte: printable Latin-1 bytes stand for themselves, the
    others for characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {b: chr(b) for b in own}, 0x100
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return "".join(table[b] for b in range(256))


def to_characters(raw: bytes, table: str) -> str:
    """Bytes as characters of the byte table."""
    return raw.decode("latin-1").translate(table)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The rank file as a tokenizer of the ``tokenizers`` library, serialised."""
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    table = byte_characters()
    text = {token: to_characters(token, table) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token))
                if token[:i] in ranks and token[i:] in ranks]
        cuts.sort(key=lambda c: (ranks[c[0]], ranks[c[1]]))
        merges += [(text[a], text[b]) for a, b in cuts]
    model = BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    return Tokenizer(model).to_str()


class Encoder:
    """Encodes texts match by match; made once in each task."""

    def __init__(self, spec: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import regex
        from tokenizers import Tokenizer

        self.split = regex.compile(pattern).findall
        self.tokenizer = Tokenizer.from_str(spec)
        self.table = byte_characters()
        self.cache: dict[str, bytes] = {}

    def _add(self, matches: list[str]) -> dict[str, bytes]:
        mapped = [to_characters(m.encode(), self.table) for m in matches]
        found = self.tokenizer.encode_batch_fast(mapped, add_special_tokens=False)
        return {m: np.asarray(e.ids, "<u4").tobytes() for m, e in zip(matches, found)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_SIZE:
            self.cache = {}
        cut = [self.split(t) if t else [] for t in texts]
        cache = self.cache
        new = {m for matches in cut for m in matches if m not in cache}
        if new:
            got = self._add(sorted(new))
            once = {m: v for m, v in got.items() if len(m) > CACHE_CHARS}
            cache.update((m, v) for m, v in got.items() if len(m) <= CACHE_CHARS)
            if once:
                return [b"".join([once[m] if m in once else cache[m] for m in matches]) for matches in cut]
        return [b"".join([cache[m] for m in matches]) for matches in cut]

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, end byte) of each token: a character of the mapped text is a byte."""
        out, at = [], 0
        for match in self.split(text):
            mapped = to_characters(match.encode(), self.table)
            e = self.tokenizer.encode(mapped, add_special_tokens=False)
            out += [(i, at + a, at + b) for i, (a, b) in zip(e.ids, e.offsets)]
            at += len(mapped)
        return out


class SpanEncoder(Encoder):
    """Ids and byte offsets of whole texts: the library's offsets of each match, behind those before it."""

    def _add(self, matches: list[str]) -> dict[str, bytes]:
        mapped = [to_characters(m.encode(), self.table) for m in matches]
        # a character of a mapped match is a byte, so its offsets are bytes
        return {m: np.array([(i, *span) for i, span in zip(e.ids, e.offsets)], "<u4").tobytes()
                for m, e in zip(matches, self.tokenizer.encode_batch(mapped, add_special_tokens=False))}

    def spans(self, text: str | None) -> np.ndarray:
        """(tokens, 3): id, first byte and end byte of each token."""
        matches = self.split(text) if text else []
        parts = [np.frombuffer(self.encode([m])[0] if m not in self.cache else self.cache[m], "<u4").reshape(-1, 3).astype(np.int64)
                 for m in matches]
        at = 0
        for m, part in zip(matches, parts):
            part[:, 1:] += at
            at += len(m.encode())
        return np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)


def token_bytes(ranks: dict[bytes, int]) -> dict[int, bytes]:
    """Id -> bytes, by way of the tokenizer's characters: the byte table reversed."""
    table = byte_characters()
    back = {c: b for b, c in enumerate(table)}
    return {i: bytes(back[c] for c in to_characters(t, table)) for t, i in ranks.items()}


class Decoder:
    """Joins the bytes of ids; ``tokens``: id -> bytes."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens

    def decode(self, ids: bytes | None) -> bytes:
        """Bytes of little-endian unsigned 32-bit ids; a KeyError for an id that has no token."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _mapped(df: DataFrame, column: str, drop: tuple[str, ...], into: list[str], make) -> DataFrame:
    """``df`` with binary columns ``into``: in each task ``make()`` gives a function from a list of
    values of ``column`` to a list of values for each of ``into``."""
    rest = [c for c in df.columns if c not in (*drop, *into)]
    schema = T.StructType([*(df.schema[c] for c in rest), *(T.StructField(c, T.BinaryType()) for c in into)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # about 256 kB of values at a time, one row at least
                values, size = [], 0
                while at + len(values) < batch.num_rows and size < 1 << 18:
                    values.append(batch.column(column)[at + len(values)].as_py())
                    size += len(values[-1] or "")
                rows = batch.slice(at, len(values))
                at += len(values)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in rest), *(pa.array(x, pa.binary()) for x in f(values))],
                    [*rest, *into])

    return map_batches(df.select(*dict.fromkeys([*rest, column])), run, schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` without ``text`` and with ``into``: ids as little-endian unsigned 32-bit integers.

    A column already named ``into`` is replaced.
    """
    spec = tokenizer_json(read_ranks(path))

    def make():
        encoder = Encoder(spec, pattern)
        return lambda texts: [encoder.encode(texts)]

    return _mapped(df, text, (text,), [into], make)


def encode_spans(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "tokens") -> DataFrame:
    """``df`` with ``into``: an array of ``(id, first, end)`` for each text, the bytes of its UTF-8 that
    a token covers; null and empty texts have none.  A column already named ``into`` is replaced."""
    spec = tokenizer_json(read_ranks(path))
    rest = [c for c in df.columns if c != into]
    kind = "array<struct<id:int,first:int,end:int>>"
    schema = T.StructType([*(df.schema[c] for c in rest), *T._parse_datatype_string(f"`{into}` {kind}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SpanEncoder(spec, pattern)
        for batch in batches:
            for rows in slices(batch, text):
                found = [encoder.spans(t) for t in rows.column(text).to_pylist()]
                flat = np.concatenate([np.zeros((0, 3), np.int64), *found]).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                tokens = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["id", "first", "end"])
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in rest), pa.ListArray.from_arrays(pa.array(ends), tokens)],
                                                 [*rest, into])

    return map_batches(df.select(*rest), run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with ``into``: the bytes that the ids in ``ids`` stand for.

    An id that the vocabulary lacks fails the job.  A null ``ids`` decodes to no bytes.
    """
    tokens = token_bytes(read_ranks(path))

    def make():
        decoder = Decoder(tokens)
        return lambda values: [[decoder.decode(v) for v in values]]

    return _mapped(df, ids, (), [into], make)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text`` and with ``ids`` and ``decoded``, by one worker in each task."""
    ranks = read_ranks(path)
    spec, tokens = tokenizer_json(ranks), token_bytes(ranks)

    def make():
        encoder, decoder = Encoder(spec, pattern), Decoder(tokens)

        def both(texts):
            ids = encoder.encode(texts)
            return [ids, [decoder.decode(v) for v in ids]]

        return both

    return _mapped(df, text, (text,), ["ids", "decoded"], make)


def streamed_text(chunks: Iterator[bytes]) -> Iterator[str]:
    """Text of token bytes as they come; a character cut between tokens waits for its rest."""
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for chunk in chunks:
        if part := decoder.decode(chunk):
            yield part
    if rest := decoder.decode(b"", final=True):
        yield rest


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the bytes decoded from them."""
    return round_trip(df.select("doc_id", "text"), path, pattern).select(
        "doc_id",
        F.expr("bigint(octet_length(ids) / 4)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
