"""Exact uniform sharding: sizes, slots and the law of the communication matrix."""

import random
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest

from conftest import SF_SMALL
from kestrel.llm import queries, sharding


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op9_sharding(spark, SF_SMALL).collect()
    want = {(r["doc_id"], len((r["text"] or "").encode()) + 1, crc32((r["text"] or "").encode())) for r in docs}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == want and len(got) == len(docs)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


@pytest.mark.parametrize("n", [0, 1, 5, 37])
def test_awkward_rows(spark, n):
    rows = [(None if i % 3 == 0 else 7, None if i % 2 else "", i % 2, "x") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string").repartition(4)
    got = sharding.shard_documents(df, 4).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    slots = Counter(r["shard"] for r in got)
    assert sum(slots.values()) == n and max(slots.values(), default=0) - min((slots[k] for k in range(4)), default=0) <= 1
    assert len({(r["shard"], r["slot"]) for r in got}) == n


def test_other_columns_stay(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS slot", "'a' AS word")
    got = sharding.exact_shuffle(df, 3)
    assert got.columns == ["id", "word", "shard", "slot"]
    assert sorted(r["id"] for r in got.collect()) == list(range(10))


def test_matrix_sums():
    rows, shards = [5, 0, 17, 1, 30], [14, 13, 13, 13]
    for seed in range(50):
        m = sharding.communication_matrix(rows, shards, seed)
        assert [sum(r) for r in m] == rows and [sum(c) for c in zip(*m)] == shards
        assert all(k >= 0 for r in m for k in r)


def test_hypergeometric_law():
    # against all ways to take 4 of 9, 5 of them good
    ways = Counter(sum(i < 5 for i in c) for c in combinations(range(9), 4))
    rng, n = random.Random(3), 20_000
    got = Counter(sharding.hypergeometric(rng, 5, 4, 4) for _ in range(n))
    total = sum(ways.values())
    assert sum((got[k] - n * w / total) ** 2 / (n * w / total) for k, w in ways.items()) < 20
    assert set(got) <= set(ways)
    big = [sharding.hypergeometric(rng, 3_000_000_000, 7_000_000_000, 1_000_000) for _ in range(200)]
    assert abs(sum(big) / 200 - 300_000) < 200


def test_every_row_is_as_likely_in_every_shard(spark):
    df = spark.range(8, numPartitions=2)
    seen = Counter()
    for seed in range(40):
        seen.update((r["id"], r["shard"]) for r in sharding.exact_shuffle(df, 2, seed * 10).collect())
    assert all(6 <= seen[i, s] <= 34 for i in range(8) for s in range(2))


def test_rows_of_other_partitions_tell_nothing(spark):
    """Where row k of one partition goes says nothing of where row k of another lies."""
    n, parts = 1000, 4
    df = spark.range(n * parts, numPartitions=parts)
    for seed in (0, 7):
        at = {r["id"]: (r["shard"], r["slot"]) for r in sharding.exact_shuffle(df, 2, seed).collect()}
        size = n * parts / 2
        for a in range(parts):
            for b in range(parts):
                if a == b:
                    continue
                slots = {s: [at[a * n + k][1] for k in range(n) if at[b * n + k][0] == s] for s in (0, 1)}
                mean = {s: sum(x) / len(x) for s, x in slots.items()}
                spread = size / 12**0.5 * (1 / len(slots[0]) + 1 / len(slots[1])) ** 0.5
                assert abs(mean[0] - mean[1]) < 5 * spread, (seed, a, b, mean)
                same = sum(at[a * n + k][0] == at[b * n + k][0] for k in range(n))
                assert abs(same - n / 2) < 5 * (n / 4) ** 0.5


def test_streams_do_not_meet(spark):
    df = spark.range(4000, numPartitions=4).select(
        *(sharding.uniform(seed, name).alias(f"{name}{seed}") for seed in (7, 8) for name in ("first", "second")))
    rows = df.collect()
    values = [v for r in rows for v in r]
    assert len(set(values)) == len(values) and 0 <= min(values) and max(values) < 1
    for k in range(4):
        column = [r[k] for r in rows]
        assert abs(sum(column) / len(column) - 0.5) < 0.025
        assert abs(sum(v * v for v in column) / len(column) - 1 / 3) < 0.025


def test_probability_is_precise():
    from fractions import Fraction
    from math import comb, pi, sqrt

    for good, bad, draws in ((5, 4, 4), (300, 20, 111), (40, 4000, 77), (1, 1, 1), (500, 500, 999)):
        for k in range(max(0, draws - bad), min(good, draws) + 1):
            exact = float(Fraction(comb(good, k) * comb(bad, draws - k), comb(good + bad, draws)))
            if exact > 1e-250:
                assert abs(sharding.probability(k, good, bad, draws) / exact - 1) < 1e-11
    # at 10**12 rows the peak is that of the normal law
    n, good, draws = 10**12, 10**12 // 16, 10**12 // 4096
    mode = (draws + 1) * (good + 1) // (n + 2)
    variance = draws * (good / n) * (1 - good / n) * (n - draws) / (n - 1)
    assert abs(sharding.probability(mode, good, n - good, draws) * sqrt(2 * pi * variance) - 1) < 1e-7
