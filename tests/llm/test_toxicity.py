"""Toxicity: trees and calibration against brute force, held-out quality, awkward rows."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import boosting, queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op5_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in got if crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if r["held_out"]}
    known = [(labels[r["doc_id"]], r["predicted"]) for r in held if r["doc_id"] in labels]
    toxic = [p for t, p in known if t == 1]
    clean = [p for t, p in known if t == 0]
    # about a tenth of this table's toxic labels are noise: those texts hold nothing toxic
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_awkward_rows(spark):
    bad, good = "you are a stupid idiot and a worthless loser ", "this is a friendly note about the garden "
    # texts of their own: copies are learned from once
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(f"word{k}" for k in rng.integers(0, 500, 20 + i % 17)) + " " + (bad if i % 6 == 0 else good)) for i in range(300)]
    docs += [(900, None), (901, ""), (902, bad * 5000), (None, bad), (903, "St.u.p1d 1d10t, you w0rthless m0ron!!"), (3, bad)]
    labels = [(i, 1, int(i % 6 == 0)) for i in range(300)] + [(1, 1, None), (1, 0, 7), (None, 1, 1), (4, 1, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 AS toxic", "'mine' AS score")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text")
    got = toxicity.toxicity(df, marks).collect()
    assert len(got) == len(docs)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[902]["predicted"] == by_id[None]["predicted"] == by_id[0]["predicted"] == 1
    assert by_id[1]["predicted"] == by_id[900]["predicted"] == by_id[901]["predicted"] == 0
    assert {r["score"] for r in toxicity.score(df, toxicity.fit(df, marks), "__").collect()} == {"mine"}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "stupid")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.toxicity(docs, labels.limit(0)).collect()] == [(0.0, 0)]
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_rare_toxic_class(spark):
    """One document in a thousand is toxic."""
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(20_000):
        words = [f"word{k}" for k in rng.integers(0, 3000, 20)]
        toxic = i % 1000 == 0
        docs.append((i, " ".join(words + ["you", "stupid", "worthless", "idiot"] * toxic)))
        labels.append((i, 1, int(toxic)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = toxicity.toxicity(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    found = {r["doc_id"] for r in got if r["predicted"]}
    toxic = {i for i, _, t in labels if t}
    assert len(found & toxic) >= 0.9 * len(toxic) and len(found - toxic) <= 20


def test_one_row_of_each_id_is_learned_from(spark, monkeypatch):
    sizes, boost = [], toxicity.boost
    monkeypatch.setattr(toxicity, "boost", lambda x, y, **more: (sizes.append(len(y)), boost(x, y, **more))[1])
    docs = [(i, f"text{i} word{i * 7} " + "stupid idiot " * (i % 3 == 0)) for i in range(90)]
    docs += [(1, f"many{k} texts{k * 3} of{k * 5}") for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(df, labels).count() == len(docs)
    assert max(sizes) <= 90


SEED_WORDS = ["stupid", "idiot", "clown"]


def features(*texts):
    none = np.empty(0, np.uint64)
    lexicon = toxicity.Lexicon(toxicity._hash(SEED_WORDS), toxicity._hash(toxicity.SECOND_PERSON), none, np.empty(0))
    return toxicity.Featurizer(lexicon).features(pa.array(texts, pa.string()))


def test_features():
    x = features("You STUPID cat", "", None, "5tup1d", "a stupid " + "word " * 20 + "you", "calm")
    assert x.shape == (6, toxicity.Featurizer.N) and not np.isnan(x).any()
    assert x[0, 0] == pytest.approx(1 / 3) and x[0, 8] == pytest.approx(1 / 3) and x[0, 9] == pytest.approx(1 / 3)
    assert x[0, 10] == pytest.approx(7 / 12) and x[0, 11] == pytest.approx(1 / 3)
    assert x[3, 7] > 0 and x[0, 7] == 0 and x[4, 8] == 0 and x[4, 0] > 0 and not x[1].any() and not x[2].any()


def test_features_do_not_depend_on_neighbours():
    texts = ["You idiot!", "the", "", "clown you", "x" * 5000]
    assert np.array_equal(features(*texts), np.concatenate([features(t) for t in texts]))


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(4)
    score = rng.integers(0, 30, 200).astype(float)
    y = (rng.random(200) < score / 30).astype(float)
    xs, ys = boosting.isotonic(score, y)
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) >= 0).all()
    values = np.unique(score)
    mean = np.array([y[score == v].mean() for v in values])
    weight = np.array([(score == v).sum() for v in values])
    for k, v in enumerate(values):  # max over lower sets of the min over upper sets
        want = max(min((mean[i:j + 1] * weight[i:j + 1]).sum() / weight[i:j + 1].sum() for j in range(k, len(values)))
                   for i in range(k + 1))
        assert np.interp(v, xs, ys) == pytest.approx(want)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.3)).astype(float)
    model = boosting.boost(x, y)
    assert ((model.raw(x) > 0) == y).mean() > 0.97


def test_splits_against_brute_force():
    """The first tree's splits have the most gain among all features and cuts."""
    rng = np.random.default_rng(7)
    for _ in range(5):
        x = rng.integers(0, 12, (300, 3)).astype(float)
        y = (rng.random(300) < 0.1 + 0.7 * ((x[:, 1] > 5) ^ (x[:, 2] < 3))).astype(float)
        weight = rng.integers(1, 4, 300).astype(float)
        trees = boosting.boost(x, y, trees=1, depth=2, weight=weight)
        p = np.average(y, weights=weight)
        g, h = weight * (y - p), weight * p * (1 - p)

        def gain(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + 1.0)

        def best(rows):
            found = (0.0, None)
            for j in range(3):
                for c in trees.edges[j]:
                    left, right = rows & (x[:, j] <= c), rows & (x[:, j] > c)
                    if min(h[left].sum(), h[right].sum()) >= 1.0:
                        found = max(found, (gain(left) + gain(right) - gain(rows), (j, c)), key=lambda f: f[0])
            return found

        def taken(node, rows):
            j, c = trees.feature[0, node], trees.cut[0, node]
            if c >= len(trees.edges[j]):
                return 0.0, rows, rows & False
            left, right = rows & (x[:, j] <= trees.edges[j][c]), rows & (x[:, j] > trees.edges[j][c])
            return gain(left) + gain(right) - gain(rows), left, right

        rows = np.ones(300, bool)
        got, left, right = taken(0, rows)
        assert got == pytest.approx(best(rows)[0])
        for node, part in ((1, left), (2, right)):
            value, want = taken(node, part)[0], best(part)[0]
            assert value == pytest.approx(want if want >= 1.0 else 0.0)
        # leaves are Newton steps
        raw = trees.raw(x) - trees.base
        for step in np.unique(raw):
            leaf = raw == step
            assert step == pytest.approx(0.15 * g[leaf].sum() / (h[leaf].sum() + 1.0))
