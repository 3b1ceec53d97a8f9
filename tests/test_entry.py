"""The driver contract, and Spark vs DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from kestrel.sources.tables import TABLES

from conftest import SF_SMALL

FAST = ["bucket_mean", "bucket_mean_floor6", "bucket_mean_signed", "bucket_mean_float",
        "fmt_kv", "simple_mean", "parse_drop", "parse_null", "header_rule_b", "trip_pig",
        "bucket_mean_rare", "sql_size_classes", "trip_mapreduce_extreme", "trip_pig_dirty", "trip_sql_dirty",
        "trip_sql_rare", "join_two_layouts", "block_order", "block_add_inner_partial", "block_add_outer_partial",
        "blocks_dense_cells", "block_add_max", "propagate_5_hot",
        "trip_sql", "equi_join_keyed", "union_all_tagged", "block_add_inner", "block_pick",
        "propagate_5_directed", "component_sizes", "csv_quoted", "csv_bad_records", "csv_trip_pruned", "trip_pig_script",
        "adjacency_long_lines", "join_two_layouts_one_scan", "join_hot_both", "bucket_mean_states", "committed_output",
        "sorted_lines", "sql_session_views"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["distance", "mean"]
    assert len(df.collect()) > 0


def test_every_query_has_an_oracle():
    from kestrel.plans import workloads
    assert set(workloads.queries()) == set(workloads.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(cur.fetchall(), dcols)


def test_hot_source_path_on_driver_tables(spark, duck):
    # Suppliers have ~600 out-edges at sf0.001: with a threshold of 100 they
    # all take the broadcast path; the labels must not change.
    from kestrel.operators import propagate_min
    from kestrel.plans import workloads as W
    from kestrel.sources import read_adjacency
    labels = propagate_min(read_adjacency(W.symmetric_lines(spark, SF_SMALL)), rounds=5,
                           min_hot_degree=100)
    cur = duck.execute(E.oracle_sql()["propagate_5"])
    assert _norm([tuple(r) for r in labels.collect()], labels.columns) == \
        _norm(cur.fetchall(), [d[0] for d in cur.description])


def test_wrong_variants_are_seen(spark):
    """Each oracle below tells its query from the nearest wrong one."""
    from kestrel.plans import workloads as W
    sf = SF_SMALL.replace("0.001", "0.01")  # the smallest has one block only
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")

    def same(df, name):
        cur = duck.execute(E.oracle_sql()[name])
        return _norm([tuple(r) for r in df.collect()], df.columns) == _norm(cur.fetchall(), [d[0] for d in cur.description])

    orders = W.table(spark, sf, "orders")
    value = W.F.when(W.F.col("o_orderkey") % 2 == 0, W.F.col("o_totalprice")).cast("decimal(12,2)")
    assert not same(W.bucket_mean(orders, W.F.col("o_totalprice") / 10, value, min_count=1, count_name="n"), "bucket_mean_rare")
    m, n = W._partial(spark, sf, "O", 0), W._partial(spark, sf, "F", 1)
    inner = W.add_matrices_text(m, n, W.BLOCK_ROWS, W.BLOCK_COLS, "inner", "\t%.3f")
    assert not same(inner, "block_add_outer_partial")
    dense = W.coo_to_blocks(W._whole_matrix(spark, sf), W.BLOCK_ROWS, W.BLOCK_COLS, duplicates="max").select(
        "bi", "bj", W.F.posexplode(W.F.reverse("data")).alias("place", "v")).where("v <> 0")
    assert not same(dense, "blocks_dense_cells")
    placed = W.q_block_order(spark, sf)
    assert not same(placed.withColumn("place", W.F.max("place").over(W.Window.partitionBy()) + 1 - W.F.col("place")), "block_order")
    lines = W.q_sorted_lines(spark, sf)
    assert not same(lines.withColumn("place", W.F.lit(1) + W.F.max("place").over(W.Window.partitionBy()) - W.F.col("place")), "sorted_lines")
    assert same(W.q_block_tuple_text(spark, sf), "block_tuple_text")
    assert not same(W.keyed_block_text(W.q_block_pick(spark, sf)), "block_tuple_text")
    kept = W.q_committed_output(spark, sf)
    assert not same(kept.withColumn("refused", ~W.F.col("refused")), "committed_output")
    plain = W.bucket_mean(W.table(spark, sf, "lineitem").where("l_orderkey % 2 = 0"), W.F.col("l_extendedprice") / 500, W._revenue(),
                          min_key=0, max_key=200)
    assert not same(plain, "bucket_mean_states")


def test_session_views_are_not_left_behind(spark):
    from kestrel.plans import workloads
    assert workloads.q_sql_session_views(spark, SF_SMALL).count() > 0
    assert "per_nation" not in {t.name for t in spark.catalog.listTables()}
