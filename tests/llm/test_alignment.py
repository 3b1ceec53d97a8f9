"""Alignment of two tokenizers against a brute force over all token pairs."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from kestrel.llm import alignment, queries

A, B = map(public_tokenizers.path, queries.ALIGNED)
PATTERN = public_tokenizers.PATTERN
TEXTS = [None, "", " ", "\n", "a", " lead", "trail ", "Straße für Ärzte", "日本語 テスト 🙂🙂", "<|endoftext|> <s> <0x41>", "a▁b", "\x00x",
         "x" * 4000, "word " * 3000, "é ½ ²³", "tab\tand\r\nline", "same text", "same text"]


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text by each side as (id, bytes), straight from the two libraries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    # the byte table, read from the vocabulary itself: its 256 single characters in order of their bytes
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(x for x in range(256) if x not in own)}
    back = {c: b for b, c in chars.items()}

    def tokens(text):
        left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
        raw = (" " + text).encode()
        return (left, right) if text and all(b"".join(t for _, t in x) == raw for x in (left, right)) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(text, plain):
    """(A spans, B spans, overlapping pairs, groups text, linked id pairs)."""
    a, b = map(spans, plain(text or ""))
    pairs = [(x, y) for x, (_, f, e) in enumerate(a) for y, (_, g, h) in enumerate(b) if f < h and g < e] if len(a) * len(b) < 1e6 else None
    common = sorted({e for *_, e in a} & {e for *_, e in b})
    groups, first = [], 0
    for end in common:
        groups.append("|".join(",".join(str(i) for i, f, e in x if first <= f and e <= end) for x in (a, b)))
        first = end
    at = {e: i for i, _, e in b}
    return a, b, pairs, ";".join(groups), [(i, at[e]) for i, _, e in a if e in at]


def expected(rows, plain):
    """What the query gives for (doc_id, text) rows."""
    found = [(i, *brute(t, plain)) for i, t in rows]
    counts = Counter(p for *_, links in found for p in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((i, len(a), len(b), len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                   hashlib.sha256(groups.encode()).hexdigest() if a else "") for i, a, b, _, groups, links in found)


def test_whole_table_equals_brute_force(spark, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 3000]
    df = spark.createDataFrame(short, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, alignment.digests(df, A, B, PATTERN).collect())) == expected(short, plain)
    whole = queries.op11_alignment(spark, SF_SMALL)
    assert whole.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(i for i, _ in docs)


def test_awkward_rows_and_clashing_columns(spark, plain):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, links string, row string").repartition(3)
    got = alignment.digests(df, A, B, PATTERN)
    assert sorted(map(tuple, got.collect())) == expected(rows, plain)
    zero = {r["doc_id"]: r for r in got.collect()}
    for i in (0, 1, TEXTS.index("a▁b")):
        assert tuple(zero[i])[1:] == (0, 0, 0, 0, 0, 0, "")


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (7, "one two"), (7, None)], "doc_id long, text string")
    got = alignment.digests(df, A, B, PATTERN).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["7", "7", "None", "None"]
    said = [r for r in got if r["n_a"]]
    assert len({tuple(r)[1:] for r in said}) == 1 and len(said) == 3
    # each of the links is in three rows, and is the only one of its B id
    assert said[0]["count_sum"] == 3 * said[0]["n_links"] and said[0]["n_best"] == said[0]["n_links"]
    assert alignment.digests(df.limit(0), A, B, PATTERN).count() == 0


def test_overlaps_are_all_pairs_that_share_bytes(spark, plain):
    texts = [t for t in TEXTS if len(t or "") < 200]
    df = spark.createDataFrame([(k, t, "kept") for k, t in enumerate(texts)], "doc_id long, text string, first string").repartition(2)
    got = alignment.overlaps(df, alignment.read_tokenizers(A, B, PATTERN))
    assert got.columns == ["doc_id", *alignment.OVERLAPS]
    found = {}
    for r in got.collect():
        found.setdefault(r["doc_id"], set()).add(tuple(r)[1:])
    for k, t in enumerate(texts):
        a, b, pairs, _, _ = brute(t, plain)
        assert found.get(k, set()) == {(x, y, a[x][0], b[y][0], max(a[x][1], b[y][1]), min(a[x][2], b[y][2]), a[x][2] == b[y][2]) for x, y in pairs}


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment.read_tokenizers(A, B, PATTERN))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40)), max_size=4))
def test_any_texts(aligner, plain, texts):
    found = aligner.align(texts)
    assert aligner.groups(found, len(texts)) == [brute(t, plain)[3] for t in texts]
    links = [(k, *p) for k, t in enumerate(texts) for p in brute(t, plain)[4]]
    assert sorted(zip(*(x.tolist() for x in aligner.links(found)))) == sorted((*k, n) for k, n in Counter(links).items())


ANY = st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\r\x0b\x1c\x85\u00a0\u2028\u180e\u200b'sabc1½▁")))


@settings(max_examples=400, deadline=None)
@given(ANY)
def test_matches_equal_the_library(aligner, library, text):
    assert aligner.a.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t


def test_documents_equal_the_library(spark, aligner, library):
    texts = [" " + r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if r["text"]]
    for ids, t in zip(aligner.a.encode(texts), texts):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def test_cache_restarts(aligner, library, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_SIZE", 3)
    for text in ("one two three four five", "six one " + "x" * 200, "\u0001 \U0001f9ff one  "):
        assert [x.tolist() for x in aligner.a.encode([text, text])] == [library.encode(text, add_special_tokens=False).ids] * 2


def test_linkable_pairs_bound_what_is_linked():
    a, b = [b"the", b"he", b"x"], [b"e", b"he", b"xthe"]
    ends = {(x, y) for x in a for y in b if x.endswith(y) or y.endswith(x)}
    assert alignment.linkable_pairs(a, b) == len(ends)


def test_vocabularies():
    with open(A, encoding="utf-8") as f:
        spec = json.load(f)
    told = alignment.read_tokenizers(A, B, PATTERN)
    assert len(told.a_bytes) == len(spec["model"]["vocab"]) + len(spec["added_tokens"])
    assert told.b_bytes[3] == b"\0" and b" " in told.b_bytes


def test_positions_alone_join_the_tokens_of_a_batch(plain, monkeypatch):
    joins, plainly = [], alignment.pd.merge_asof
    monkeypatch.setattr(alignment.pd, "merge_asof", lambda *x, **how: joins.append(how) or plainly(*x, **how))
    texts = [t for t in TEXTS if t is None or len(t) < 1000]
    aligner = alignment.Aligner(alignment.read_tokenizers(A, B, PATTERN))
    assert aligner.groups(aligner.align(texts), len(texts)) == [brute(t, plain)[3] for t in texts]
    assert [how.get("by") for how in joins] == [None, None]  # a key besides the position costs a hash table each


def test_words_are_encoded_once(aligner, plain, monkeypatch):
    fresh, given_, pieces = alignment.Aligner(alignment.read_tokenizers(A, B, PATTERN)), [], aligner.b
    monkeypatch.setattr(fresh, "b", type("Counting", (), {
        "encode": staticmethod(lambda texts, **how: given_.extend(texts) or pieces.encode(texts, **how))}))
    texts = ["neither joins, nor splits;\nany word", "any word joins neither,\nnor splits; any"] * 50
    assert fresh.groups(fresh.align(texts), len(texts)) == [brute(t, plain)[3] for t in texts]
    assert sum(map(len, given_)) < 100  # not 50 times the words


SPACED = st.lists(st.sampled_from([" ", " ", " ", "\n", "\t", " ", "　", "word", "it's", "x1½", "▁", "'", "é,", "᠎", "\x1c", "🙂", "<s>", "\x00"]), max_size=14)


@settings(max_examples=300, deadline=None)
@given(st.lists(SPACED.map("".join), max_size=5))
def test_spaces_of_all_kinds(aligner, plain, texts):
    assert aligner.groups(aligner.align(texts), len(texts)) == [brute(t, plain)[3] for t in texts]


def test_words_of_the_cache_before(plain, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_SIZE", 3)
    aligner = alignment.Aligner(alignment.read_tokenizers(A, B, PATTERN))
    for text in ("one two three four five", "six one seven", "two six, " + "y" * 200, "seven five one", "four"):
        assert aligner.groups(aligner.align([text]), 1) == [brute(text, plain)[3]]
