"""Posting lists against all pairs: recall, exact scores, and small tables whole."""

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from kestrel.llm import postings, queries


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k=20, every=20):
    """{(query id, vector): [(vec_id, score)]}: all pairs, sums in the order of the components."""
    kept = [(i, tuple(v)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for i, q in kept:
        if i % every:
            continue
        best = {}
        for j, x in kept:
            if j != i:
                score = 0.0
                for a, b in zip(q, x):
                    score += a * b
                best[j] = max(best.get(j, -math.inf), score)
        out[i, q] = sorted(best.items(), key=lambda r: (-r[1], r[0]))[:k]
    return out


def recall(got, expected, k=20):
    """Share of true neighbours found; every row's score must be exact and every list in order."""
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for (i, _), nearest in expected.items():
        mine = sorted(found.pop(i, []))
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(nearest)
        assert mine == sorted(mine, key=lambda r: (-r[2], r[1]))
        hit += len({j for _, j, _ in mine} & {j for j, _ in nearest})
        total += len(nearest)
    assert not found
    return hit / max(total, 1)


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = queries.op13_neighbours(spark, SF_SMALL)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got, expected = got.collect(), brute(rows)
    assert recall(got, expected) >= 0.95
    score = {(i, j): s for (i, _), nearest in expected.items() for j, s in nearest}
    same = [(r["score"], score[r["query_id"], r["vec_id"]]) for r in got if (r["query_id"], r["vec_id"]) in score]
    assert same and all(a == b for a, b in same)


@pytest.mark.parametrize("shape", ["noise", "clusters", "lengths"])
def test_recall_over_many_lists(spark, shape, monkeypatch):
    monkeypatch.setattr(postings, "LIST", 32)
    monkeypatch.setattr(postings, "SAMPLE", 1500)
    monkeypatch.setattr(postings, "PART_VECTORS", 200)
    monkeypatch.setattr(postings, "PART_QUERIES", 30)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 12))
    if shape == "clusters":
        x = rng.normal(size=(40, 12))[rng.integers(0, 40, 4000)] * 3 + x * 0.4
    if shape == "lengths":
        x *= rng.lognormal(0, 1, (4000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    expected = {(i, tuple(v)): None for i, v in rows if i % 20 == 0}
    for i, v in expected:
        score = x @ np.array(v)
        score[i] = -np.inf
        order = np.lexsort((np.arange(len(x)), -score))[:20]
        expected[i, v] = [(int(j), float(score[j])) for j in order]
    got = postings.neighbours(df).collect()
    assert recall(got, expected) >= 0.9


AWKWARD = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (40, None), (60, []), (80, [0.0, -0.0]), (100, [float("nan"), 1.0]), (120, [None, 1.0]),
           (140, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, -2.0]), (4, [3.0]),
           (5, [1.0, 1.0, 9.0]), (0, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [5.0, 5.0]), (160, [-1.0]), (8, None)]


def test_awkward_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in AWKWARD], "vec_id long, embedding array<double>, list string, query int")
    for k in (2, 20):
        expected = brute(AWKWARD, k)
        got = postings.neighbours(df.repartition(3), k=k).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(
            (i, n + 1, j, s) for (i, _), nearest in expected.items() for n, (j, s) in enumerate(nearest))


def test_queries_that_share_an_id(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0])]
    got = postings.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 1, 2.0), (20, 1, 2, 3.0), (20, 2, 1, 0.0), (20, 2, 2, 0.0)]


def test_hot_copies_give_the_smallest_ids(spark):
    rows = [(i, [1.0, 1.0]) for i in range(500)] + [(i, [0.5, 0.25 + i / 1e4]) for i in range(500, 900)]
    got = postings.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)).collect()
    for i in range(0, 500, 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == i)
        assert mine == [(n + 1, j, 2.0) for n, j in enumerate([j for j in range(21) if j != i][:20])]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert postings.neighbours(df).columns == ["query_id", "rank", "vec_id", "score"]
    assert postings.neighbours(df).count() == 0


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 16)) + rng.normal(size=(30, 16))[rng.integers(0, 30, 6000)] * 4
    index = postings.fit(x, 200_000, float(np.abs(x).max()), float(np.sqrt(postings.squares(x / np.abs(x).max()).max())), 20)
    assert len(index.centroids) > 300
    points = index.points(x[:400])
    ids, away = index.near(points, 16)
    true = np.argsort(postings.distances(points, index.centroids), 1)
    assert np.mean([len(set(a[:8]) & set(b[:8])) / 8 for a, b in zip(ids.tolist(), true.tolist())]) > 0.97
    assert (np.diff(away, axis=1) >= -1e-5).all()


def test_leaves_are_balanced_even_of_copies():
    for x in (np.random.default_rng(1).normal(size=(1000, 5)), np.ones((1000, 5))):
        leaves = postings.halves(x, 50)
        assert sorted(np.concatenate(leaves).tolist()) == list(range(1000))
        assert min(map(len, leaves)) >= 25 and max(map(len, leaves)) <= 50
