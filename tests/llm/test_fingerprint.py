"""Digests against brute force, succession of documents, likeness."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kestrel.llm import fingerprint as FP
from kestrel.llm import queries

RNG = np.random.default_rng(8)
PROSE = ["".join(RNG.choice(list("etaoin shrdlu  é"), n)) for n in (0, 1, 63, 64, 65, 79, 126, 127, 128, 300, 3000, 40_000)]
TEXTS = [*PROSE, "a" * 500, ("the same line again\n" * 300), "x" * 200 + PROSE[9]]


def brute_features(raw: bytes):
    """(start, end) of the features, window by window."""
    n = len(raw) - FP.WIDTH + 1
    if n <= 0:
        return [(0, len(raw))] if raw else []
    most = int(FP.WIDTH * np.log2(FP.WIDTH) * 1024)
    rare = []
    for i in range(n):
        total = sum(int(FP._SUMS[c]) for c in Counter(raw[i:i + FP.WIDTH]).values())
        e = (most - total) * 1000 // most
        rare.append(0 if e < FP.TRIVIAL else abs(e - FP.TYPICAL) + 1)
    runs = max(n - FP.SPREAD + 1, 1)
    votes = Counter()
    for i in range(runs):
        part = rare[i:i + FP.SPREAD]
        votes[i + part.index(max(part))] += 1
    return sorted((i, i + FP.WIDTH) for i, v in votes.items() if v >= min(FP.VOTES, runs) and rare[i] > 0)


def test_features_against_brute_force():
    d = FP.Digester()
    buf = "".join(TEXTS).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in TEXTS])])
    starts, ends = d.selected(np.frombuffer(buf, np.uint8), offsets)
    want = [(o + a, o + b) for t, o in zip(TEXTS, offsets) for a, b in brute_features(t.encode())]
    assert list(zip(starts.tolist(), ends.tolist())) == want


def test_digests_do_not_depend_on_neighbours():
    d = FP.Digester()
    together = [FP.written(x) for x in d.digests(pa.array([*TEXTS, None, *TEXTS], pa.string()))]
    alone = [FP.written(FP.Digester().digests(pa.array([t]))[0]) for t in TEXTS]
    assert together == [*alone, "0:", *alone]


def test_texts_of_trivial_windows_differ():
    a, b, none, again, longer = FP.Digester().digests(pa.array(["a" * 500, "-" * 500, None, "a" * 500, "a" * 501]))
    assert len(a) == len(b) == 1 and FP.likeness(a, again) == 1
    assert FP.likeness(a, b) < 0.1 and FP.likeness(a, longer) < 0.1 and FP.likeness(a, none) == 0


def test_filters_chain():
    x = FP.Digester().digests(pa.array([PROSE[-1]]))[0]
    distinct = {PROSE[-1].encode()[a:b] for a, b in brute_features(PROSE[-1].encode())}
    assert len(x) == -(-len(distinct) // FP.PER_FILTER) > 1
    assert (np.bitwise_count(x).sum(1) <= FP.PER_FILTER * FP.HASHES).all()


def test_likeness():
    a, b, c = FP.Digester().digests(pa.array([PROSE[-2], PROSE[-2][:1500] + PROSE[-1][:1500], PROSE[-1][1500:9000]]))
    none = a[:0]
    assert FP.likeness(a, a) == 1 and FP.likeness(none, none) == 1 and FP.likeness(a, none) == 0
    assert 0.3 < FP.likeness(a, b) < 0.8 and FP.likeness(a, c) < 0.15
    assert FP.likeness(a, b) == FP.likeness(b, a)


@pytest.mark.parametrize("bucket_rows", [1000, 2])
def test_awkward_rows(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(FP, "BUCKET_ROWS", bucket_rows)
    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (5, None), (5, "z"), (5, "z"), (-4, "é" * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bucket", "'x' AS copied").repartition(3)
    got = FP.fingerprints(df).collect()
    hashed = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "k int, t string").select("k", F.xxhash64("t").alias("h"))
    by_text = {rows[r["k"]][1]: r["h"] for r in hashed.collect()}
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), -by_text[r[1]]))
    want, d = [], FP.Digester()
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        own, other, next_ = d.digests(pa.array([text, changed, after]))
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), FP.written(own), FP.written(other),
                     FP.likeness(own, other), FP.likeness(own, next_)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_id_with_a_third_of_all_rows_is_dealt(spark, monkeypatch):
    """Buckets are even, whatever the ids are, and each row is followed by its successor."""
    monkeypatch.setattr(FP, "BUCKET_ROWS", 50)
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 1, None).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 600 == 0, "the same").otherwise(F.concat(F.lit("text "), "id")).alias("text")).repartition(5)
    rows = FP.with_successors(df).collect()
    sizes = Counter(r["bucket"] for r in rows if not r["copied"])
    assert sum(sizes.values()) == n and len(sizes) >= 100
    assert max(sizes.values()) <= 3 * n / len(sizes)
    assert {r["bucket"] for r in rows if r["copied"]} == set(sizes)
    rows = [r for k, r in enumerate(rows) if not (r["copied"] and rows[k - 1]["copied"] and rows[k - 1]["bucket"] == r["bucket"])]
    ids = [[r["doc_id"] if r["doc_id"] is not None else -1 for r in rows if r["bucket"] == k] for k in sorted(sizes)]
    assert all(x[:-1] == sorted(x[:-1], reverse=True) for x in ids)
    # a bucket ends with the first row of the one below it
    assert all(ids[k][-1] == ids[k - 1][0] for k in range(1, len(ids))) and ids[0][-1] == ids[-1][0]


def test_keys_sort_as_their_numbers():
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (500, 3)) * rng.choice([1, 256, 1 << 61], (500, 3))
    assert [tuple(r) for r in x[np.argsort(FP.sortable(*x.T), kind="stable")]] == sorted(map(tuple, x))


def test_empty_and_single(spark):
    df = spark.createDataFrame([(1, "only one document, with some words in it to be cut in half")], "doc_id long, text string")
    assert FP.fingerprints(df.limit(0)).count() == 0
    assert [r["near_next"] for r in FP.fingerprints(df).collect()] == [1.0]


def test_query(spark):
    got = queries.op7_fingerprint(spark, SF_SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]]))
    assert len(got) == len(docs)
    same = {}
    for r in got:
        text, n = docs[r["doc_id"]], len(docs[r["doc_id"]])
        changed = text[:n - n // 2] + docs[after[r["doc_id"]]][:n // 2]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert same.setdefault(text, r["fingerprint"]) == r["fingerprint"]
