"""Near-duplicates against all pairs, and against SQL."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from kestrel.llm import neardup as N
from kestrel.llm import queries
from kestrel.llm.textnum import WordHasher

RNG = random.Random(12)
VOCABULARY = [f"word{i}" for i in range(400)]


def edit(words, n):
    words = list(words)
    for _ in range(n):
        words[RNG.randrange(len(words))] = RNG.choice(VOCABULARY)
    return words


def group(size, length, most):
    base = [RNG.choice(VOCABULARY) for _ in range(length)]
    return [" ".join(edit(base, RNG.randrange(most + 1))) for _ in range(size)]


def set_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    """All pairs, and a walk over the links."""
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and root[i] != root[j] and 100 * len(a & b) >= 80 * len(a | b):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    out = []
    for (doc_id, _), s, r in zip(rows, sets, root):
        ids = [d for (d, _), x in zip(rows, root) if x == r and d is not None]
        least = doc_id if not s else min(ids, default=None)
        out.append((doc_id, len(s), least, doc_id == least))
    return sorted(map(repr, out))


def rows_of(texts, spare=()):
    ids = list(range(10, 10 + len(texts)))
    RNG.shuffle(ids)
    return list(zip(ids, texts)) + list(spare)


AWKWARD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "two one"), (8, "é x É x"),
           (9, "a a a a"), (9, "a a"), (None, "one two"), (None, "lonely without id"), (None, None), (4, "one"),
           (500, " ".join(VOCABULARY) * 40), (501, " ".join(VOCABULARY) * 40 + " end")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS set_id", "'x' AS key").repartition(4)


@pytest.mark.parametrize("leaf, steps", [(N.LEAF, N.MAX_STEPS), (4, 2), (4, 0)])
def test_all_pairs(spark, monkeypatch, leaf, steps):
    """With tiny leaves the leaders, further branching and the blocks all take part."""
    monkeypatch.setattr(N, "TINY", 4)
    monkeypatch.setattr(N, "BLOCK", 7)
    texts = [t for k in range(12) for t in group(1 + k % 5, 20 + 10 * k, 3)]
    texts += group(40, 80, 6) + group(25, 30, 5) + [" ".join(RNG.choice(VOCABULARY) for _ in range(50)) for _ in range(40)]
    rows = rows_of(texts + texts[:10], AWKWARD)
    got = N.near_duplicates(frame(spark, rows), leaf, steps).collect()
    assert sorted(map(repr, map(tuple, got))) == brute(rows)


def test_few_documents(spark):
    df = frame(spark, [(2, "a b c"), (1, "a b c")])
    assert sorted(map(tuple, N.near_duplicates(df).collect())) == [(1, 2, 1, True), (2, 2, 1, False)]
    assert N.near_duplicates(df.limit(0)).count() == 0
    assert [tuple(r) for r in N.near_duplicates(frame(spark, [(7, None)])).collect()] == [(7, 0, 7, True)]


def test_sets_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(N, "MAX_BROADCAST", 0)
    rows = rows_of(group(12, 40, 3))
    assert sorted(map(repr, map(tuple, N.near_duplicates(frame(spark, rows)).collect()))) == brute(rows)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cur = con.execute(queries.oracle_sql()["op3_near_duplicates"])
    columns = [d[0] for d in cur.description]
    got = queries.op3_near_duplicates(spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())


def test_survival_is_what_trees_do():
    """The share of trees in which two documents meet is the one that sets the number of trees."""
    rng = np.random.default_rng(3)
    met, trees = 0, 4000
    a = rng.integers(0, 2**32, (1, N.TOKENS)).astype(np.uint32)
    b = np.where(rng.random((1, N.TOKENS)) < 0.999, a, a + np.uint32(1))
    for similarity in (0.8,):
        for k in range(trees):
            b = np.where(rng.random((1, N.TOKENS)) < similarity, a, a + np.uint32(1))
            start = np.array([k * 7919 + 1], np.uint64)
            p, _ = N.descend(start, np.zeros(1, np.int64), a, 4, 0.8)
            q, _ = N.descend(start, np.zeros(1, np.int64), b, 4, 0.8)
            met += bool(set(p.tolist()) & set(q.tolist()))
    assert abs(met / trees - N.survival(0.8, 4)) < 0.04
    assert N.trees_needed(0.8, 4, 0.9999) == int(np.ceil(np.log(1 - 0.9999) / np.log(1 - N.survival(0.8, 4))))


@pytest.mark.parametrize("similarity", [0.8, 0.82])
@pytest.mark.parametrize("step", [0, 3, N.MAX_STEPS])
def test_recall_on_rows_that_branch_on(similarity, step):
    """Pairs of a templated source meet at every depth that its tree nodes may be taken to."""
    rng, pairs, missed = np.random.default_rng(step), 2000, 0
    levels, trees = 4 + N.STEP * step, N.trees_at(4, step)
    missed += int((rng.binomial(N.TOKENS, similarity, 100_000) < N.least_agreement()).sum())
    start = np.tile(N.mix(np.arange(1, trees + 1).astype(np.uint64)), pairs)
    row = np.arange(pairs * trees)
    a = rng.integers(0, 2**16, (pairs * trees, N.TREE_TOKENS)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < similarity, a, a + np.uint16(1))
    (p, i), (q, j) = (N.descend(start, row, t, levels, 0.8) for t in (a, b))
    met = np.intersect1d(p * np.uint64(31) + (i // trees).astype(np.uint64), q * np.uint64(31) + (j // trees).astype(np.uint64))
    owner = dict(zip((p * np.uint64(31) + (i // trees).astype(np.uint64)).tolist(), (i // trees).tolist()))
    missed += pairs - len({owner[x] for x in met.tolist()})
    assert missed <= 2


def test_trees_share_no_token():
    factors = N.tree_multipliers(40)
    assert len(set(factors.tolist())) == 40 * N.TREE_TOKENS
    assert np.array_equal(N.tree_multipliers(7), factors[:7 * N.TREE_TOKENS])


def test_templated_source(spark, monkeypatch):
    """Documents alike in two thirds, none a copy but in pairs: their tree nodes branch on."""
    monkeypatch.setattr(N, "TINY", 4)
    template = [RNG.choice(VOCABULARY) for _ in range(80)]
    texts = []
    for k in range(60):
        own = template + [f"own{k}x{i}" for i in range(25)]
        texts += [" ".join(own), " ".join(own[:-10] + [f"other{k}x{i}" for i in range(10)])]
    rows = rows_of(texts)
    assert sorted(map(repr, map(tuple, N.near_duplicates(frame(spark, rows), 8, 3).collect()))) == brute(rows)


def test_tokens_agree_as_sets_do():
    hasher, factors = WordHasher(N.SPACE), N.multipliers()
    shares = []
    for _ in range(200):
        a, b = group(2, 120, 12)
        x, y = N.shingles(pa.array([a, b]), hasher)
        shares.append((np.mean(N.tokens(x, factors) == N.tokens(y, factors)), len(np.intersect1d(x, y)) / len(np.union1d(x, y))))
    got, want = np.array(shares).T
    assert abs((got - want).mean()) < 0.015 and np.abs(got - want).max() < 0.3


def test_shingles_are_distinct_word_pairs():
    texts = ["a b a b", "A b", "", None, "x", "b a", "a  b"]
    sets = N.shingles(pa.array(texts, pa.string()), WordHasher(N.SPACE))
    assert [len(s) for s in sets] == [2, 1, 0, 0, 1, 1, 1]
    assert sets[1][0] == sets[6][0] != sets[5][0] and sets[1][0] in sets[0]
