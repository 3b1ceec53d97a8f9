from kestrel.operators import component_sizes, propagate_min
from kestrel.sources import graph_from_edges, read_adjacency

FIXTURE = ["3,2,1", "2,4,3", "1,3,4,6", "5,6", "6,5,7,1", "0,8,9", "4,2,1", "8,0", "9,0", "7,6"]


def _sizes(labels):
    return {r["grp"]: r["n"] for r in component_sizes(labels).collect()}


def _labels(labels):
    return {r["id"]: r["grp"] for r in labels.collect()}


def test_propagate_five_rounds_golden(spark, lines):
    labels = propagate_min(read_adjacency(lines(FIXTURE)), rounds=5)
    assert _sizes(labels) == {0: 3, 1: 7}


def test_stable_after_two_rounds(spark, lines):
    g = read_adjacency(lines(FIXTURE))
    two, five = _labels(propagate_min(g, rounds=2)), _labels(propagate_min(g, rounds=5))
    assert two == five


def test_hot_source_path_gives_same_labels(spark, lines):
    g = read_adjacency(lines(FIXTURE))
    plain = _labels(propagate_min(g, rounds=5))
    split = _labels(propagate_min(g, rounds=5, min_hot_degree=2, max_hot_sources=100))
    assert plain == split


def test_implicit_vertices(spark, lines):
    g = read_adjacency(lines(["1,2"]))
    assert _sizes(propagate_min(g, 5, implicit_vertices=True)) == {1: 2}
    assert _sizes(propagate_min(g, 5, implicit_vertices=False)) == {1: 1}


def test_implicit_vertex_has_no_label_of_its_own(spark, lines):
    # vertex 1 only appears as a neighbour of 2: it takes 2's label
    g = read_adjacency(lines(["2,1"]))
    assert _labels(propagate_min(g, 5)) == {2: 2, 1: 2}


def test_directed(spark, lines):
    g = read_adjacency(lines(["1", "2,1"]))
    assert _labels(propagate_min(g, 5)) == {1: 1, 2: 2}


def test_zero_rounds_and_edges_api(spark):
    e = spark.createDataFrame([(5, 6), (6, 5)], "src long, dst long")
    v = spark.createDataFrame([(9,)], "id long")
    g = graph_from_edges(e, vertices=v)
    assert _labels(propagate_min(g, 0)) == {5: 5, 6: 6, 9: 9}
    assert _labels(propagate_min(g, 3)) == {5: 5, 6: 5, 9: 9}


def test_labels_never_increase(spark, lines):
    g = read_adjacency(lines(FIXTURE))
    prev = _labels(propagate_min(g, 1))
    for k in (2, 3):
        cur = _labels(propagate_min(g, k))
        assert all(cur[v] <= prev.get(v, cur[v]) for v in cur)
        prev = cur


def test_bucket_count_scales_with_edges(spark):
    from kestrel.operators import bucket_count
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count(spark, 10) == parts
    big = bucket_count(spark, 10**11)
    assert big % parts == 0 and 10**11 / big <= 16_000_000


def test_bucket_count_stays_legal(spark):
    from kestrel.operators import bucket_count
    assert bucket_count(spark, 10**13) == 100_000


def test_nothing_of_a_run_remains_but_the_labels(spark, lines):
    import os
    import re

    from kestrel.session import checkpoint_dir
    folder = re.sub("^file:/*", "/", checkpoint_dir(spark))
    before = set(os.listdir(folder))
    databases = {d.name for d in spark.catalog.listDatabases()}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    labels = propagate_min(read_adjacency(lines(FIXTURE)), rounds=4, min_hot_degree=2)
    left = {f for f in set(os.listdir(folder)) - before if os.listdir(f"{folder}/{f}")}
    assert len(left) == 1 and next(iter(left)).startswith("kestrel-labels")
    assert {d.name for d in spark.catalog.listDatabases()} == databases
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert labels.count() == 10


def test_labels_enter_no_exchange(spark, lines):
    plans = {}

    def look(r, df):
        plans[r] = df._jdf.queryExecution().executedPlan().toString()

    propagate_min(read_adjacency(lines(FIXTURE)), rounds=3, on_round=look)
    # one exchange, of messages that were reduced on their side
    assert plans[2].count("Exchange") == 1 and "partial_min" in plans[2]


def test_hot_sources_without_edges_and_repeats(spark, lines):
    text = ["1,2,3,4,2", "1,5", "7", "7", "2,1,1", "9,7"]
    for implicit in (True, False):
        a = _labels(propagate_min(read_adjacency(lines(text)), 3, implicit))
        b = _labels(propagate_min(read_adjacency(lines(text)), 3, implicit, min_hot_degree=2))
        assert a == b and (set(a) == {1, 2, 3, 4, 5, 7, 9} if implicit else set(a) == {1, 2, 7, 9})


def test_hot_sources_are_those_of_the_threshold_whatever_their_cells(spark):
    from kestrel.operators.graph import hot_sources
    from kestrel.plans.materialize import RunTables
    pairs = spark.createDataFrame([(s, d) for s in range(40) for d in range(s)] + [(99, None), (None, None)], "src long, dst long")
    for cells in (1, 2, 64, 1 << 16):
        for least in (1, 20, 38, 39, 40):
            with RunTables(spark, "hot") as tables:
                ids, total = hot_sources(pairs, least, 100, tables, cells)
                assert total == 780
                # 100 sources at most: a hot one has 8 of the 780 edges at least
                hot = set() if ids is None else {r["src"] for r in ids.collect()}
                assert hot == set(range(max(least, 8), 40)), (cells, least)


def test_first_round_sends_along_the_edges_without_a_join(spark, lines):
    for hot in (2, 100):
        plans = {}
        propagate_min(read_adjacency(lines(FIXTURE)), rounds=2, min_hot_degree=hot,
                      on_round=lambda r, df: plans.update({r: df._jdf.queryExecution().executedPlan().toString()}))  # noqa: B023
        assert plans[1].count("Join ") == 1 < plans[2].count("Join "), "the labels are met, no more"


def test_an_edge_without_a_source_sends_nothing(spark):
    e = spark.createDataFrame([(5, 6), (None, 7), (None, 5)], "src long, dst long")
    for hot in (1, 100):
        labels = _labels(propagate_min(graph_from_edges(e), 3, min_hot_degree=hot))
        assert {k: v for k, v in labels.items() if k is not None} == {5: 5, 6: 5}


def test_lines_are_parsed_without_lambdas(spark, lines):
    pairs = read_adjacency(lines(["1,2, 3", "4", "5,,", None])).pairs
    assert "lambda" not in pairs._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r["src"], r["dst"]) for r in pairs.collect()), key=str)
    assert got == [(1, 2), (1, 3), (4, None), (5, None), (None, None)]


def test_a_bucket_is_written_as_its_rows_come(spark):
    from kestrel.plans.materialize import RunTables
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with RunTables(spark, "come") as tables:
        # one task, all of the buckets, and a task for each of them
        for k, df in enumerate((spark.range(0, 1000, 1, 1), spark.range(1000).repartition(4, "id"))):
            table = tables.write_bucketed(df, f"b{k}", 4, "id")
            assert sorted(r["id"] for r in table.collect()) == list(range(1000))
            assert "Exchange" not in table.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(key) == before
