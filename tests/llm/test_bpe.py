"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from kestrel.llm import bpe, queries

PATH = public_tokenizers.path(queries.RANKS)
TEXTS = [None, "", " ", "a", "Straße für Ärzte", "x" * 5000, "日本語 テスト 🙂🙂", "<|endoftext|> 's 'LL\r\n\t  end  ", "é́ ½ ²³",
         "aaaaabaaaab" * 50, " " * 300 + "\n" * 40]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def spec():
    return bpe.tokenizer_json(bpe.read_ranks(PATH))


def packed(ids):
    return np.asarray(ids, "<u4").tobytes()


def test_documents_equal_tiktoken(spark, reference):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op10_bpe(spark, SF_SMALL).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(packed(ids)).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert len(got) == docs.count()


def test_awkward_rows(spark, reference):
    rows = [(i if i else None, t, "kept") for i, t in enumerate(TEXTS)] + [(3, "a", "kept")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    coded = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "ids"]
    got = bpe.decode(coded, PATH).collect()
    assert sorted(bytes(r["decoded"]) for r in got) == sorted((t or "").encode() for _, t, _ in rows)
    assert sorted(bytes(r["ids"]) for r in got) == sorted(packed(reference.encode_ordinary(t or "")) for _, t, _ in rows)
    assert bpe.digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_decode_null_ids(spark):
    df = spark.createDataFrame([(None,)], "ids binary")
    assert [bytes(r["decoded"]) for r in bpe.decode(df, PATH).collect()] == [b""]


@pytest.fixture(scope="module")
def encoder(spec):
    return bpe.Encoder(spec, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(encoder, reference, text):
    assert encoder.encode([text])[0] == packed(reference.encode_ordinary(text))


def test_cache_restarts(spec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SIZE", 5)
    encoder = bpe.Encoder(spec, public_tokenizers.PATTERN)
    for text in ("one two three four five six seven", "eight nine one two", "x" * 100):
        assert encoder.encode([text, text])[1] == packed(reference.encode_ordinary(text))


def test_offsets_cover_the_bytes(spec):
    text = "Ärzte 🙂 'll"
    found = bpe.Encoder(spec, public_tokenizers.PATTERN).offsets(text)
    assert found[0][1] == 0 and found[-1][2] == len(text.encode())
    assert all(a[2] == b[1] for a, b in zip(found, found[1:]))
    decoder = bpe.Decoder(bpe.token_bytes(bpe.read_ranks(PATH)))
    assert all(decoder.decode(packed([i])) == text.encode()[a:b] for i, a, b in found)


def test_spans_over_a_table_hold_the_tokens_bytes(spark, reference):
    rows = [(i if i else None, t, "old") for i, t in enumerate(TEXTS)] + [(3, "a", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(3)
    got = bpe.encode_spans(df, PATH, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "text", "tokens"] and bpe.encode_spans(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    tokens = bpe.token_bytes(bpe.read_ranks(PATH))
    found = got.collect()
    assert len(found) == len(rows)
    for r in [*found, *bpe.encode_spans(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), PATH, public_tokenizers.PATTERN).collect()]:
        raw, at = (r["text"] or "").encode(), 0
        for i, first, end in r["tokens"]:
            assert first == at and raw[first:end] == tokens[i]
            at = end
        assert at == len(raw) and [i for i, _, _ in r["tokens"]] == reference.encode_ordinary(r["text"] or "")


def test_streamed_text_waits_for_split_characters(spec):
    text = "🙂é"
    assert "".join(bpe.streamed_text(bytes([b]) for b in text.encode())) == text


def test_byte_characters_are_distinct():
    table = bpe.byte_characters()
    assert len(set(table)) == 256 and table[ord("a")] == "a" and table[32] == "Ġ"
