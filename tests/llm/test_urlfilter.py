"""URL filters as of the capture's day against brute force and SQL."""

import random
from collections import Counter
from datetime import date, timedelta

import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kestrel.llm import queries, urlfilter

START = date(2024, 1, 1)
CAPTURES = "id long, url string, day date"
ENTRIES = "list string, scope string, key string, day date, action string"


def brute(url_host, page, day, entries):
    keys = set()
    if url_host:
        parts = url_host.split(".")
        keys = {("domain", ".".join(parts[i:])) for i in range(max(len(parts) - 1, 1))}
        keys |= {("host", url_host), ("url", page)}
    states = {}
    for list_, scope, key, when, action in entries:
        if None in (list_, scope, key, when) or action not in ("add", "remove") or day is None:
            continue
        if (scope, key) in keys and when <= day:
            k = (list_, scope, key)
            states.setdefault(k, {})
            states[k][when] = max(states[k].get(when, ""), action)
    lists, since = [], []
    for (list_, _, _), days in states.items():
        order = sorted(days)
        if days[order[-1]] == "add":
            lists.append(list_)
            begin = order[-1]
            for d in reversed(order):
                if days[d] != "add":
                    break
                begin = d
            since.append(begin)
    return len(lists), ",".join(sorted(set(lists))), max(since, default=None), bool(lists)


def test_random_histories(spark):
    rng = random.Random(6)
    hosts = ["a.example.com", "b.example.com", "www.b.example.com", "example.net", "single"]
    keys = [("domain", "example.com"), ("domain", "b.example.com"), ("host", "b.example.com"), ("url", "a.example.com/x"),
            ("domain", "single"), ("host", "example.net")]
    entries = [(f"l{rng.randrange(2)}", *rng.choice(keys), START + timedelta(rng.randrange(40)), rng.choice(["add", "remove"]))
               for _ in range(80)]
    entries += entries[:5] + [(None, "host", "single", START, "add"), ("l0", "host", None, START, "add"),
                              ("l0", "host", "single", None, "add"), ("l0", "host", "single", START, "what"),
                              ("l0", "what", "single", START, "add"), ("l0", "host", "single", START, None)]
    rows = []
    for i in range(150):
        host, path = rng.choice(hosts), rng.choice(["", "/x", "/x/", "/y?q=1", "/x#top"])
        day = START + timedelta(rng.randrange(-3, 45))
        rows.append((i, f"https://user@{host.upper()}.:8080{path}" if i % 7 == 0 else f"http://{host}{path}", day,
                     host, (host + path.split("?")[0].split("#")[0]).rstrip("/")))
    rows += [(None, None, START, None, None), (900, "no url", START, None, None), (901, "", START, None, None),
             (902, "http://single/", None, "single", "single"), (3, "http://single/", START, "single", "single"),
             (3, "http://single/", START, "single", "single"), (903, "http:///x", START, None, None)]
    df = spark.createDataFrame([r[:3] for r in rows], CAPTURES).selectExpr("*", "'mine' AS host", "1 AS n").repartition(3)
    listed = spark.createDataFrame(entries, ENTRIES).selectExpr("*", "1 AS week")
    got = urlfilter.evaluate(df, listed, "id").collect()
    want = Counter((r[0], r[3], r[2], *brute(r[3], r[4], r[2], entries)) for r in rows)
    assert Counter(map(tuple, got)) == want


def test_one_label_domains_and_keys_as_typed(spark):
    urls = ["http://a.xyz/p", "http://b.c.xyz", "http://xyz.org/", "http://d.Example.com/Path/", "http://e.net"]
    captures = spark.createDataFrame([(i, u, START) for i, u in enumerate(urls)], CAPTURES)
    entries = spark.createDataFrame([
        ("l0", "domain", "xyz", START, "add"), ("l1", "domain", "EXAMPLE.com.", START, "add"), ("l2", "host", "E.net.", START, "add"),
        ("l3", "url", "D.example.COM./Path/", START, "add"), ("l4", "url", "d.example.com/path", START, "add"),
        ("l5", "domain", ".", START, "add")], ENTRIES)
    got = {r["id"]: r["lists"] for r in urlfilter.evaluate(captures, entries, "id").collect()}
    assert got == {0: "l0", 1: "l0", 2: "", 3: "l1,l3", 4: "l2"}


def test_a_far_off_day_makes_no_more_rows(spark):
    """What the as-of join makes follows the days asked and the intervals, not the time between them."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    far = spark.createDataFrame([(-1, "http://far.example.org/", date(9999, 12, 31)), (-2, "http://far.example.org/", date(1, 1, 1))],
                                "page_id long, url string, day date")
    captures, entries = urlfilter.derived_captures(pages), urlfilter.derived_entries(pages)
    valid = urlfilter.intervals(entries)

    def ordered(rows):
        asked = rows.select(F.lit("host").alias("scope"), urlfilter.host_of(F.col("url")).alias("key"),
                            urlfilter.day_number(F.col("day")).alias("day")).distinct()
        plan = urlfilter.as_of(asked, valid)
        return plan.count(), asked.join(valid.select("scope", "key", "list").distinct(), ["scope", "key"]).count() + valid.count()

    held, made = ordered(captures)
    held_far, made_far = ordered(captures.unionByName(far))
    assert made_far <= made + 2 * 3 and held_far >= held
    plain = urlfilter.evaluate(captures, entries, "page_id").collect()
    more = urlfilter.evaluate(captures.unionByName(far), entries, "page_id").collect()
    assert set(map(tuple, plain)) == {tuple(r) for r in more if r["page_id"] >= 0}
    text = queries.op4_url_filter(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "sequence(floor" not in text


def test_a_hot_host_and_open_intervals(spark):
    captures = spark.range(3000).selectExpr("id", "concat('http://h', id % 900, '.big.xyz/') AS url",
                                            "date_add(DATE '2024-01-01', cast(id % 50 as int)) AS day")
    entries = [("l0", "domain", "big.xyz", START + timedelta(10), "add"), ("l1", "domain", "xyz", START, "add"),
               ("l1", "domain", "xyz", START + timedelta(20), "remove"), ("l1", "domain", "xyz", START + timedelta(45), "add")]
    got = urlfilter.evaluate(captures, spark.createDataFrame(entries, ENTRIES), "id").collect()
    for r in got:
        d = r["id"] % 50
        assert r["lists"] == ",".join(["l0"] * (d >= 10) + ["l1"] * (d < 20 or d >= 45)), r


def test_hosts_in_brackets(spark):
    urls = ["http://[2001:db8::1]/a", "http://[2001:db8::2]:8080/a", "http://user@[::ffff:1.2.3.4]", "http://[broken/a"]
    captures = spark.createDataFrame([(i, u, START) for i, u in enumerate(urls)], CAPTURES)
    entries = spark.createDataFrame([("l0", "host", "[2001:DB8::1]", START, "add"), ("l1", "url", "[2001:db8::2]/a/", START, "add"),
                                     ("l2", "domain", "4]", START, "add"), ("l3", "domain", "[::ffff:1.2.3.4]", START, "add")], ENTRIES)
    got = {r["id"]: (r["host"], r["lists"]) for r in urlfilter.evaluate(captures, entries, "id").collect()}
    assert got == {0: ("[2001:db8::1]", "l0"), 1: ("[2001:db8::2]", "l1"), 2: ("[::ffff:1.2.3.4]", "l3"), 3: ("[broken", "")}


def test_empty_tables(spark):
    captures, entries = spark.createDataFrame([(1, "http://a.b/c", START)], CAPTURES), spark.createDataFrame([], ENTRIES)
    assert [r["blocked"] for r in urlfilter.evaluate(captures, entries, "id").collect()] == [False]
    assert urlfilter.evaluate(captures.limit(0), entries, "id").count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op4_url_filter(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    cur = con.execute(queries.oracle_sql()["op4_url_filter"])
    columns = [d[0] for d in cur.description]
    got = queries.op4_url_filter(spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cur.fetchall()))
    assert any(r["blocked"] for r in got) and not all(r["blocked"] for r in got)
