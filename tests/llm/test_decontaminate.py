"""Suffix arrays and the decontamination report against brute force and SQL."""

import hashlib
import re

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from kestrel.llm import decontaminate as D
from kestrel.llm import queries


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    w, hit, found, longest = words(text), set(), set(), 0
    for item, said in items:
        q = words(said)
        n = min(10, len(q))
        for i in range(len(q) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == q[i:i + n]:
                    hit |= set(range(p, p + n))
                    found.add("" if item is None else str(item))
                    k = n
                    while p + k < len(w) and i + k < len(q) and w[p + k] == q[i + k]:
                        k += 1
                    longest = max(longest, k)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), longest


def long_words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


ITEMS = [(1, long_words(25)), (2, "Short ITEM"), (2, long_words(12, 100)), (3, None), (4, "... !"), (5, long_words(10, 5)),
         (None, "no id here"), (10, long_words(25)), (11, "a a a a a a a a a a a a")]
DOCS = [(1, None), (2, ""), (3, "nothing here"), (4, "x " + long_words(25) + " y"), (5, long_words(9)), (6, "a short, item!"),
        (None, "no ID: here"), (7, "a " * 40), (8, long_words(30, 3) * 3), (8, long_words(30, 3) * 3), (9, "Ä-w0 " + long_words(11)),
        (10, (long_words(400, 1000) + " ") * 20 + long_words(12, 100)), (11, "w4 " + long_words(10, 5) + " w5")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_brute_force(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "'mine' AS items", "1 AS n_words").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS id")
    found = D.match(docs, items, prefix="__", block_bytes=block_bytes).collect()
    assert all(r["items"] == "mine" for r in found) and len(found) == len(DOCS)
    for r in found:
        want = brute(r["text"], ITEMS)
        hit = sum(s["end"] - s["start"] for s in r["__hit_spans"])
        sha = hashlib.sha256(",".join(r["__items"]).encode()).hexdigest()
        assert (r["__n_words"], hit, len(r["__items"]), sha, hit > 0, r["__longest_words"]) == want, r["text"]


def test_one_python_stage_for_many_blocks(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = D.match(docs, items, block_bytes=20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    with pytest.raises(ValueError, match="give it in parts"):
        D.match(docs, items, max_bytes=10)


def test_items_without_ids_lie_in_all_blocks(spark, monkeypatch):
    sizes, block = [], D._block
    monkeypatch.setattr(D, "_block", lambda packed, window: (lambda t: (sizes.append(len(t.ids)), t)[1])(block(packed, window)))
    items = [(None, long_words(12, 40 * k)) for k in range(60)]
    df = spark.createDataFrame(items * 3, "item_id long, text string")
    docs = spark.createDataFrame([(k, "x " + long_words(11, 40 * k)) for k in range(60)], "doc_id long, text string")
    got = D.report(docs, df).collect()
    assert all((r["n_hit"], r["n_items"], r["contaminated"]) == (11, 1, True) for r in got)
    sizes.clear()
    D.match(docs, df, block_bytes=500)
    assert sum(sizes) == 60 and len(sizes) >= 6 and max(sizes) <= 20


def test_report_and_clean(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted((repr(d),) + brute(t, ITEMS)[:5] for d, t in DOCS)
    assert sorted((repr(r[0]),) + tuple(r)[1:] for r in D.report(docs, items).collect()) == want
    assert D.clean(docs, items).count() == sum(not brute(t, ITEMS)[4] for _, t in DOCS)
    assert D.clean(docs, items.limit(0)).count() == len(DOCS)
    assert D.report(docs.limit(0), items).count() == 0


def test_small_shards_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_WORDS", 1)
    test_brute_force(spark, 1 << 20)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(queries.oracle_sql()["op6_decontamination"])
    columns = [d[0] for d in cur.description]
    assert sorted(map(tuple, queries.op6_decontamination(spark, SF_SMALL).select(*columns).collect())) == sorted(cur.fetchall())


def test_suffix_array_order():
    rng = np.random.default_rng(2)
    for n, k in ((0, 3), (1, 3), (50, 2), (300, 4), (300, 400)):
        w = rng.integers(0, k, n)
        got = [tuple(w[i:i + 40]) for i in D.suffix_array(w, 40)]
        assert got == sorted(got)
