"""The registered queries over the driver's tables, each with its DuckDB SQL.

Every query reads whole tables (or text lines Spark renders from them) and
returns a DataFrame.  Graph queries and ``materialise_roundtrip`` run and
write while they are called; the others are lazy.  The SQL next to each one computes the same
result in DuckDB over the same parquet files; column names match.

Exactness: money columns are summed as decimals, so a mean is
``double(exact sum) / count`` in both engines and does not depend on the
order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions.scalar import block_index, format_key_value, full_match, pair_text, round_half_up, tab_line
from kestrel.operators.graph import component_sizes, propagate_min
from kestrel.operators.grouping import bucket_mean, count_by_key, mean_by_key
from kestrel.operators.joins import equi_join_pairs, join_tagged
from kestrel.operators.matrix import (
    add_cells,
    add_matrices,
    add_matrices_text,
    block_coords,
    cells,
    cells_of_block,
    coo_to_block_text,
    coo_to_blocks,
    dedupe_cells,
    keyed_block_text,
    tuple_block_text,
)
from kestrel.operators.setops import union_tagged
from kestrel.operators.skew import equi_join_hot
from kestrel.plans.committed import read_committed, write_committed
from kestrel.plans.materialize import write_and_reload, write_text_and_reload
from kestrel.plans.script import trip_means_script
from kestrel.plans.sql import run_sql
from kestrel.plans.states import StateFolder, mean_states, means_of
from kestrel.plans.trip import trip_means_mapreduce, trip_means_pig, trip_means_sql
from kestrel.session import scratch_path
from kestrel.sources.adjacency import adjacency_rows, read_adjacency, read_long_adjacency
from kestrel.sources.coo import read_coo
from kestrel.sources.csv import CORRUPT, bad_records, read_csv, write_csv
from kestrel.sources.delimited import HeaderRule, parse_delimited
from kestrel.sources.layouts import Layout, read_layouts
from kestrel.sources.tables import fact_table, register_views, table
from kestrel.sources.text import render_lines, write_lines

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco


# --------------------------------------------------------------------------
# Shared SQL fragments (DuckDB)

def _rhu(x: str) -> str:
    """Round half toward +infinity, as int, in DuckDB."""
    return f"CAST(floor({x}) + CASE WHEN ({x}) - floor({x}) >= 0.5 THEN 1 ELSE 0 END AS INTEGER)"


def _floor6(x: str) -> str:
    return (f"(CAST(floor(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)) * 1000000) AS BIGINT)"
            f"::DOUBLE / 1000000.0::DOUBLE)")


def _mean(v: str) -> str:
    return f"(CAST(sum({v}) AS DOUBLE) / CAST(count({v}) AS DOUBLE))"


REVENUE_SQL = "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"


def _revenue():
    return (F.col("l_extendedprice").cast("decimal(12,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))


# --------------------------------------------------------------------------
# Keyed means on typed columns

@register("bucket_mean", "PRJ-4 FIL-1 AGG-1 AGG-10 ORD-1", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_bucket_mean(spark, sf):
    li = table(spark, sf, "lineitem")
    return bucket_mean(li, F.col("l_extendedprice") / 500, _revenue(),
                       min_key=0, max_key=200)


@register("bucket_mean_floor6", "PRJ-6 PRJ-4 FIL-1 AGG-1", f"""
SELECT distance, {_floor6(_mean('v'))} AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_bucket_mean_floor6(spark, sf):
    li = table(spark, sf, "lineitem")
    return bucket_mean(li, F.col("l_extendedprice") / 500, _revenue(),
                       min_key=0, max_key=200, finish="floor6")


@register("bucket_mean_signed", "PRJ-4 FIL-2 AGG-1 (negative half keys)", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('l_quantity / 2 - 13')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance < 10
GROUP BY distance
""")
def q_bucket_mean_signed(spark, sf):
    li = table(spark, sf, "lineitem")
    return bucket_mean(li, F.col("l_quantity") / 2 - 13, _revenue(), min_key=None, max_key=10)


@register("bucket_mean_float", "AGG-3 PRJ-11", f"""
SELECT distance, avg(v) AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance,
             CAST(CAST(l_extendedprice AS VARCHAR) AS FLOAT) AS v FROM lineitem)
WHERE distance < 200
GROUP BY distance
""")
def q_bucket_mean_float(spark, sf):
    li = table(spark, sf, "lineitem")
    return bucket_mean(li, F.col("l_extendedprice") / 500,
                       F.col("l_extendedprice").cast("string"), value_type="float",
                       min_key=None, max_key=200)


@register("bucket_mean_min_count", "FIL-7 AGG-1", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('o_totalprice / 1000')} AS distance,
             CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders)
GROUP BY distance
HAVING count(*) >= 3
""")
def q_bucket_mean_min_count(spark, sf):
    o = table(spark, sf, "orders")
    return bucket_mean(o, F.col("o_totalprice") / 1000, F.col("o_totalprice").cast("decimal(12,2)"),
                       min_count=3)


@register("bucket_mean_rare", "FIL-7 PRJ-22 AGG-1 (most groups are too small)", f"""
SELECT distance, {_mean('v')} AS mean, count(*) AS n
FROM (SELECT {_rhu('o_totalprice / 10')} AS distance,
             CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS DECIMAL(12,2)) AS v FROM orders)
GROUP BY distance
HAVING count(*) >= 2
""")
def q_bucket_mean_rare(spark, sf):
    # a group may hold nulls only: its mean is null
    value = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).cast("decimal(12,2)")
    return bucket_mean(table(spark, sf, "orders"), F.col("o_totalprice") / 10, value, min_count=2, count_name="n")


@register("fmt_kv", "PRJ-7 SNK-8", f"""
SELECT distance, printf('%3d\t%3.3f', distance,
       round(CAST(CAST(mean AS VARCHAR) AS DECIMAL(38,18)), 3)) AS line
FROM (SELECT distance, {_mean('v')} AS mean
      FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
      WHERE distance >= 0 AND distance < 200
      GROUP BY distance)
""")
def q_fmt_kv(spark, sf):
    means = q_bucket_mean(spark, sf)
    return means.select("distance", format_key_value("distance", "mean").alias("line"))


@register("top20", "LIM-1 ORD-1", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
ORDER BY distance
LIMIT 20
""")
def q_top20(spark, sf):
    return q_bucket_mean(spark, sf).limit(20)


@register("sql_bucket_mean", "SQL-1 SQL-2 SQL-3 SQL-4 SRC-13 PRJ-5", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_sql_bucket_mean(spark, sf):
    li = table(spark, sf, "lineitem")
    keyed = li.select(round_half_up(F.col("l_extendedprice") / 500).alias("distance"),
                      _revenue().alias("v"))
    return run_sql(spark, """
        WITH kept AS (SELECT * FROM {rows} WHERE distance BETWEEN :first AND :last)
        SELECT distance, TRY_DIVIDE(CAST(SUM(v) AS DOUBLE), COUNT(v)) AS mean
        FROM kept GROUP BY ALL ORDER BY 1""", args={"first": 0, "last": 199}, rows=keyed)


@register("sql_size_classes", "SQL-1 SQL-2 SQL-4 PRJ-5 (ROUND of a whole number)", """
SELECT CAST(round(n, -1) AS BIGINT) AS size_class, count(*) AS customers, max(n) AS largest
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
GROUP BY 1 HAVING count(*) >= 2
""")
def q_sql_size_classes(spark, sf):
    return run_sql(spark, """
        WITH per_customer AS (SELECT o_custkey, COUNT(*) AS n FROM {placed} GROUP BY o_custkey)
        SELECT ROUND(n, -1) AS size_class, COUNT(*) AS customers, MAX(n) AS largest
        FROM per_customer GROUP BY 1 HAVING customers >= :least""",
                   args={"least": 2}, placed=table(spark, sf, "orders"))


@register("sql_session_views", "SQL-1 SQL-2 SQL-3 JOI-1 (views that outlive a call, read by later statements)", """
SELECT n_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def q_sql_session_views(spark, sf):
    register_views(spark, sf, ["customer", "nation"])
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW per_nation AS SELECT c_nationkey, count(*) AS customers, "
              "sum(CAST(c_acctbal AS DECIMAL(12,2))) AS balance FROM customer GROUP BY c_nationkey")
    result = spark.sql("SELECT n_name, customers, CAST(balance AS DOUBLE) AS balance "
                       "FROM per_nation JOIN nation ON c_nationkey = n_nationkey")
    for view in ("per_nation", "customer", "nation"):  # the plan holds what it read
        spark.catalog.dropTempView(view)
    return result


@register("simple_mean", "AGG-1 SRC-5 PRJ-12", f"""
SELECT CAST(user_id AS BIGINT) AS key, {_mean('CAST(value AS DECIMAL(12,2))')} AS mean
FROM events GROUP BY 1
""")
def q_simple_mean(spark, sf):
    parsed = parse_delimited(_event_lines(spark, sf), "k bigint, v decimal(12,2)", on_error="fail")
    return mean_by_key(parsed, "k", "v", key_name="key", mean_name="mean")


@register("materialise_roundtrip", "SNK-1 SNK-3 SNK-4 SRC-1 SRC-3", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_materialise_roundtrip(spark, sf):
    means = write_and_reload(q_bucket_mean(spark, sf), "bucket-mean")
    text = means.select(F.concat_ws("\t", F.col("distance").cast("string"),
                                    F.col("mean").cast("string")).alias("value"))
    back = write_text_and_reload(text, "bucket-mean-text")
    return parse_delimited(back, "distance int, mean double", sep="\t", on_error="fail")


# --------------------------------------------------------------------------
# Text parsing: events rendered as delimited lines

def _event_lines(spark, sf, corrupt: bool = False, header: str | None = None) -> DataFrame:
    """``user_id,value`` per event.

    With ``corrupt``, 'error' events carry ``n/a`` as value and 'signup'
    events lack the value field, so every parse policy has work to do.
    """
    ev = table(spark, sf, "events")
    if corrupt:
        value = (F.when(F.col("event_type") == "error", F.lit("n/a"))
                  .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
                  .otherwise(F.col("value").cast("string")))
    else:
        value = F.col("value").cast("string")
    lines = ev.select(F.concat_ws(",", F.col("user_id").cast("string"), value).alias("value"))
    if header is not None:
        head = spark.range(1).select(F.lit(header).alias("value"))
        lines = head.unionByName(lines)
    return lines


_PARSED_CLEAN = "SELECT CAST(user_id AS BIGINT) AS k, value AS v FROM events"


@register("parse_fail_fast", "SRC-5 PRJ-11 PRJ-12", _PARSED_CLEAN)
def q_parse_fail_fast(spark, sf):
    return parse_delimited(_event_lines(spark, sf), "k bigint, v double", on_error="fail")


@register("parse_drop", "SRC-6 PRJ-2", """
SELECT CAST(user_id AS BIGINT) AS k, value AS v FROM events
WHERE event_type NOT IN ('error', 'signup')
""")
def q_parse_drop(spark, sf):
    return parse_delimited(_event_lines(spark, sf, corrupt=True), "k bigint, v double",
                           on_error="drop")


@register("parse_null", "SRC-7 SRC-2", """
SELECT CAST(user_id AS BIGINT) AS k,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS v
FROM events
""")
def q_parse_null(spark, sf):
    return parse_delimited(_event_lines(spark, sf, corrupt=True), "k bigint, v double",
                           on_error="null")


@register("sum_count_ratio", "AGG-2 SRC-7 FIL-5", f"""
SELECT CAST(user_id AS BIGINT) AS key,
       {_mean("CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE CAST(value AS DECIMAL(12,2)) END")} AS mean
FROM events GROUP BY 1
""")
def q_sum_count_ratio(spark, sf):
    parsed = parse_delimited(_event_lines(spark, sf, corrupt=True), "k bigint, v decimal(12,2)",
                             on_error="null")
    return mean_by_key(parsed, "k", "v", key_name="key", mean_name="mean")


_HEADER_MEANS = f"""
SELECT CAST(user_id AS BIGINT) AS key, {_mean('CAST(value AS DECIMAL(12,2))')} AS mean
FROM events GROUP BY 1
"""


def _header_means(spark, sf, rule: HeaderRule, header: str):
    parsed = parse_delimited(_event_lines(spark, sf, header=header), "k bigint, v decimal(12,2)",
                             header=rule, on_error="fail")
    return mean_by_key(parsed, "k", "v", key_name="key", mean_name="mean")


@register("header_rule_a", "SRC-8 FIL-6", _HEADER_MEANS)
def q_header_rule_a(spark, sf):
    return _header_means(spark, sf, HeaderRule("alphabetic", 0), "user_id,value")


@register("header_rule_b", "SRC-9 FIL-6", _HEADER_MEANS)
def q_header_rule_b(spark, sf):
    return _header_means(spark, sf, HeaderRule("letter", 1), "0,value")


@register("header_rule_c", "SRC-10 FIL-3", _HEADER_MEANS)
def q_header_rule_c(spark, sf):
    return _header_means(spark, sf, HeaderRule("regex", 0, ".*user_id.*"), "user_id,value")


# --------------------------------------------------------------------------
# Whole trip dialects over lineitem rendered as trip-like text

TRIP_HEADER = "orderkey,partkey,suppkey,linenumber,distance,returnflag,linestatus,shipdate,discount,amount"


def trip_lines(spark, sf) -> DataFrame:
    """Ten-field lines: distance in field 4, amount last (field 9), one header."""
    li = fact_table(spark, sf, "lineitem")
    fields = [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"),
              (F.col("l_quantity") - 10) * 2.5, F.col("l_returnflag"), F.col("l_linestatus"),
              F.col("l_shipdate").cast("string"), F.col("l_discount"),
              F.col("l_extendedprice")]
    body = render_lines(li, fields)
    head = spark.range(1).select(F.lit(TRIP_HEADER).alias("value"))
    return head.unionByName(body)


_TRIP_DIST = _rhu("(l_quantity - 10) * 2.5")


@register("trip_mapreduce", "SRC-1 SRC-8 SRC-5 PRJ-12 PRJ-14 PRJ-4 FIL-1 AGG-1 PRJ-6", f"""
SELECT distance, {_floor6(_mean('v'))} AS mean
FROM (SELECT {_TRIP_DIST} AS distance, CAST(l_extendedprice AS DECIMAL(12,2)) AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_trip_mapreduce(spark, sf):
    return trip_means_mapreduce(trip_lines(spark, sf), amount_type="decimal(12,2)")


@register("trip_pig", "SRC-2 SRC-10 SRC-7 FIL-2 FIL-3 FIL-5 AGG-2 PRJ-1 PRJ-20", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_TRIP_DIST} AS distance, CAST(l_extendedprice AS DECIMAL(12,2)) AS v FROM lineitem)
WHERE distance < 200
GROUP BY distance
""")
def q_trip_pig(spark, sf):
    return trip_means_pig(trip_lines(spark, sf), amount_field=9, amount_type="decimal(12,2)",
                          header_pattern=".*orderkey.*")


@register("trip_sql", "SRC-6 SRC-9 AGG-3 SQL-1..4 ORD-1 PRJ-7", f"""
SELECT distance, avg AS avg, printf('%3d\t%3.3f', distance,
       round(CAST(CAST(avg AS VARCHAR) AS DECIMAL(38,18)), 3)) AS line
FROM (SELECT distance, avg(v) AS avg
      FROM (SELECT {_TRIP_DIST} AS distance,
                   CAST(CAST(l_extendedprice AS VARCHAR) AS FLOAT) AS v FROM lineitem)
      WHERE distance < 200
      GROUP BY distance)
""")
def q_trip_sql(spark, sf):
    return trip_means_sql(trip_lines(spark, sf), with_line=True)


@register("trip_sql_min_count", "FIL-7 SRC-6 SRC-9 AGG-3 SQL-3", f"""
SELECT distance, avg AS avg
FROM (SELECT distance, avg(v) AS avg, count(*) AS n
      FROM (SELECT {_TRIP_DIST} AS distance,
                   CAST(CAST(l_extendedprice AS VARCHAR) AS FLOAT) AS v FROM lineitem)
      WHERE distance < 200
      GROUP BY distance)
WHERE n >= 3
""")
def q_trip_sql_min_count(spark, sf):
    return trip_means_sql(trip_lines(spark, sf), min_count=3)


# The same lines with damage, by a rule on the order key.

_EXTREME = {0: "NaN", 1: "3e9", 2: "-3e9", 3: "Infinity", 4: "-Infinity", 5: "9.999999999999997e-7", 6: "2147483646.5"}
_RULE = 23


def trip_lines_extreme(spark, sf) -> DataFrame:
    """``trip_lines`` with distances at the ends of what a number can be."""
    distance = ((F.col("l_quantity") - 10) * 2.5).cast("string")
    for k, text in _EXTREME.items():
        distance = F.when(F.col("l_orderkey") % _RULE == k, F.lit(text)).otherwise(distance)
    return _trip_text(spark, sf, distance, F.col("l_extendedprice").cast("string"), F.col("l_orderkey").cast("string"))


def trip_lines_dirty(spark, sf) -> DataFrame:
    """``trip_lines_extreme`` with broken numbers, missing fields, an empty
    first field and rows that end after the distance."""
    k = F.col("l_orderkey") % _RULE
    distance = ((F.col("l_quantity") - 10) * 2.5).cast("string")
    for n, text in _EXTREME.items():
        distance = F.when(k == n, F.lit(text)).otherwise(distance)
    distance = F.when(k == 7, F.lit("1.2.3")).when(k == 8, F.lit("")).otherwise(distance)
    amount = F.when(k == 9, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
    first = F.when(k == 10, F.lit("")).otherwise(F.col("l_orderkey").cast("string"))
    lines = _trip_text(spark, sf, distance, amount, first, short=k == 11)
    return lines


def _trip_text(spark, sf, distance, amount, first, short=None) -> DataFrame:
    li = fact_table(spark, sf, "lineitem")
    start = [first, F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), distance]
    rest = [F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_shipdate").cast("string"), F.col("l_discount"), amount]

    def joined(cols):
        return F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))

    line = joined([*start, *rest])
    if short is not None:
        line = F.when(short, joined(start)).otherwise(line)
    head = spark.range(1).select(F.lit(TRIP_HEADER).alias("value"))
    return head.unionByName(li.select(line.alias("value")))


# What the damaged distances are as int keys: NaN is 0, the rest is clamped.
_KEY = f"""CASE l_orderkey % {_RULE} WHEN 0 THEN 0 WHEN 1 THEN 2147483647 WHEN 2 THEN -2147483648
     WHEN 3 THEN 2147483647 WHEN 4 THEN -2147483648 WHEN 5 THEN 0 WHEN 6 THEN 2147483647 ELSE {_TRIP_DIST} END"""
_CENTS = "CAST(l_extendedprice AS DECIMAL(12,2))"


@register("trip_mapreduce_extreme", "PRJ-4 PRJ-6 FIL-1 SRC-5 (NaN, infinities, values beyond int)", f"""
SELECT distance, {_floor6(_mean('v'))} AS mean
FROM (SELECT {_KEY} AS distance, {_CENTS} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_trip_mapreduce_extreme(spark, sf):
    return trip_means_mapreduce(trip_lines_extreme(spark, sf), amount_type="decimal(12,2)")


@register("trip_pig_dirty", "SRC-2 SRC-7 SRC-10 FIL-2 FIL-3 FIL-5 AGG-2 (broken lines)", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_KEY} AS distance, CASE WHEN l_orderkey % {_RULE} IN (9, 11) THEN NULL ELSE {_CENTS} END AS v
      FROM lineitem WHERE l_orderkey % {_RULE} NOT IN (7, 8, 10))
WHERE distance < 200
GROUP BY distance
""")
def q_trip_pig_dirty(spark, sf):
    return trip_means_pig(trip_lines_dirty(spark, sf), amount_field=9, amount_type="decimal(12,2)",
                          header_pattern=".*orderkey.*")


@register("trip_sql_dirty", "SRC-6 SRC-9 AGG-3 FIL-2 (broken lines)", f"""
SELECT distance, avg(v) AS avg
FROM (SELECT {_KEY} AS distance,
             CAST(CASE WHEN l_orderkey % {_RULE} = 11 THEN CAST((l_quantity - 10) * 2.5 AS VARCHAR)
                       ELSE CAST(l_extendedprice AS VARCHAR) END AS FLOAT) AS v
      FROM lineitem WHERE l_orderkey % {_RULE} NOT IN (0, 3, 7, 8, 9))
WHERE distance < 200
GROUP BY distance
""")
def q_trip_sql_dirty(spark, sf):
    # a row that ends after the distance has it as its last field; "NaN" and
    # "Infinity" begin with a letter, as a header does
    return trip_means_sql(trip_lines_dirty(spark, sf))


@register("trip_sql_rare", "FIL-7 SRC-6 AGG-3 (rare distances go)", f"""
SELECT distance, avg(v) AS avg
FROM (SELECT {_rhu('(l_quantity - 10) * 2.5 - l_orderkey % 997 * 100')} AS distance,
             CAST(CAST(l_extendedprice AS VARCHAR) AS FLOAT) AS v FROM lineitem)
WHERE distance < 200
GROUP BY distance
HAVING count(*) >= 3
""")
def q_trip_sql_rare(spark, sf):
    distance = ((F.col("l_quantity") - 10) * 2.5 - F.col("l_orderkey") % 997 * 100).cast("string")
    lines = _trip_text(spark, sf, distance, F.col("l_extendedprice").cast("string"), F.col("l_orderkey").cast("string"))
    return trip_means_sql(lines, min_count=3)


# --------------------------------------------------------------------------
# Joins

@register("equi_join_keyed", "JOI-1 PRJ-16 SNK-1", """
SELECT c_nationkey AS dno, c_name || ' ' || n_name AS pair
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_equi_join_keyed(spark, sf):
    return equi_join_pairs(table(spark, sf, "customer"), table(spark, sf, "nation"),
                           left_key="c_nationkey", right_key="n_nationkey",
                           left_value="c_name", right_value="n_name", keep_key=True)


@register("equi_join_names", "JOI-2 PRJ-16 SNK-2", """
SELECT s_name || ' ' || n_name AS pair
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_equi_join_names(spark, sf):
    return equi_join_pairs(table(spark, sf, "supplier"), table(spark, sf, "nation"),
                           left_key="s_nationkey", right_key="n_nationkey",
                           left_value="s_name", right_value="n_name", keep_key=False)


@register("equi_join_large", "JOI-1 (both sides large: shuffle join, AQE skew split)", """
SELECT o_custkey AS dno, CAST(o_orderkey AS VARCHAR) || ' ' || c_name AS pair
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_equi_join_large(spark, sf):
    return equi_join_pairs(table(spark, sf, "orders"), table(spark, sf, "customer"),
                           left_key="o_custkey", right_key="c_custkey",
                           left_value=F.col("o_orderkey").cast("string"), right_value="c_name",
                           keep_key=True)


@register("join_two_layouts", "SRC-4 JOI-1 SRC-2 SRC-5 (a parser for each input)", """
SELECT c_nationkey AS dno, c_name || ' ' || n_name AS pair
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0
""")
def q_join_two_layouts(spark, sf):
    # customers: name;nation, some without a nation; nations: header, then key|name|region
    c = table(spark, sf, "customer")
    people = parse_delimited(
        c.select(F.concat(F.col("c_name"), F.lit(";"), F.when(F.col("c_custkey") % 7 == 0, F.lit("?"))
                          .otherwise(F.col("c_nationkey").cast("string"))).alias("value")),
        "name string, dno bigint", sep=";", on_error="drop")
    n = render_lines(table(spark, sf, "nation"), ["n_nationkey", "n_name", "n_regionkey"], sep="|")
    head = spark.range(1).select(F.lit("key|name|region").alias("value"))
    places = parse_delimited(head.unionByName(n), "dno bigint, name string", sep="|", on_error="fail",
                             header=HeaderRule("letter", 0))
    return equi_join_pairs(people, places, left_key="dno", right_key="dno", left_value="name", right_value="name")


@register("union_all_tagged", "SRC-4 SET-1", """
SELECT c_nationkey AS key, c_name AS name, 0 AS tag FROM customer
UNION ALL
SELECT s_nationkey AS key, s_name AS name, 1 AS tag FROM supplier
""")
def q_union_all_tagged(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("key"),
                                            F.col("c_name").alias("name"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"),
                                            F.col("s_name").alias("name"))
    return union_tagged([(0, c), (1, s)])


# --------------------------------------------------------------------------
# Block matrices over the whole lineitem table: M = open line items, N =
# filled ones (l_linestatus 'O' / 'F'); cell (partkey, suppkey) = quantity,
# repeated cells summed.

BLOCK_ROWS = 300
BLOCK_COLS = 40


def _matrix(spark, sf, status: str) -> DataFrame:
    li = table(spark, sf, "lineitem").where(F.col("l_linestatus") == status)
    return cells(li, "l_partkey", "l_suppkey", "l_quantity")


def _whole_matrix(spark, sf) -> DataFrame:
    return cells(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey", "l_quantity")


def _cells_sql(status: str) -> str:
    return (f"SELECT CAST(l_partkey AS BIGINT) AS i, CAST(l_suppkey AS BIGINT) AS j, "
            f"CAST(l_quantity AS DOUBLE) AS v FROM lineitem WHERE l_linestatus = '{status}'")


def _block_text_sql(cells_sql: str, keys_sql: str, cell_fmt: str, rows=BLOCK_ROWS,
                    cols=BLOCK_COLS, lead: str = "chr(10)") -> str:
    """Dense block text in DuckDB: grid of every cell of every kept block."""
    return f"""
WITH c AS (SELECT i, j, sum(v) AS v FROM ({cells_sql}) GROUP BY i, j),
cb AS (SELECT i // {rows} AS bi, j // {cols} AS bj, i % {rows} AS r, j % {cols} AS c, v FROM c),
k AS ({keys_sql}),
grid AS (SELECT k.bi, k.bj, r.r, cc.c FROM k, range({rows}) r(r), range({cols}) cc(c)),
filled AS (SELECT g.bi, g.bj, g.r, g.c, coalesce(cb.v, 0.0) AS v
           FROM grid g LEFT JOIN cb ON g.bi = cb.bi AND g.bj = cb.bj AND g.r = cb.r AND g.c = cb.c),
rowtext AS (SELECT bi, bj, r, string_agg(printf('{cell_fmt}', v), '' ORDER BY c) || chr(10) AS t
            FROM filled GROUP BY bi, bj, r)
SELECT CAST(bi AS BIGINT) AS bi, CAST(bj AS BIGINT) AS bj, {lead} || string_agg(t, '' ORDER BY r) AS text
FROM rowtext GROUP BY bi, bj
"""


def _keys_sql(cells_sql: str, rows=BLOCK_ROWS, cols=BLOCK_COLS) -> str:
    return f"SELECT DISTINCT i // {rows} AS bi, j // {cols} AS bj FROM ({cells_sql})"


_M, _N = _cells_sql("O"), _cells_sql("F")
_UNION = f"{_M} UNION ALL {_N}"
_KEYS_OUTER = _keys_sql(_UNION)
_KEYS_INNER = f"{_keys_sql(_M)} INTERSECT {_keys_sql(_N)}"


@register("coo_parse", "SRC-12 PRJ-13 SRC-5", """
SELECT CAST(l_partkey AS BIGINT) AS i, CAST(l_suppkey AS BIGINT) AS j, l_quantity AS v
FROM lineitem
""")
def q_coo_parse(spark, sf):
    li = fact_table(spark, sf, "lineitem")
    lines = li.select(F.concat_ws(", ", F.col("l_partkey").cast("string"),
                                  F.col("l_suppkey").cast("string"),
                                  F.col("l_quantity").cast("string")).alias("value"))
    return read_coo(lines)


@register("coo_block_coords", "SRC-12 PRJ-10 PRJ-18 AGG-8 (long form)", f"""
SELECT CAST(i // {BLOCK_ROWS} AS BIGINT) AS bi, CAST(j // {BLOCK_COLS} AS BIGINT) AS bj,
       CAST(i % {BLOCK_ROWS} AS INTEGER) AS r, CAST(j % {BLOCK_COLS} AS INTEGER) AS c, i, j, v
FROM (SELECT i, j, sum(v) AS v FROM ({_UNION}) GROUP BY i, j)
""")
def q_coo_block_coords(spark, sf):
    return block_coords(dedupe_cells(_whole_matrix(spark, sf), "sum"), BLOCK_ROWS, BLOCK_COLS)


@register("coo_to_blocks", "AGG-7 PRJ-17 PRJ-8", _block_text_sql(_UNION, _KEYS_OUTER, "\t%.3f"))
def q_coo_to_blocks(spark, sf):
    return coo_to_block_text(_whole_matrix(spark, sf), BLOCK_ROWS, BLOCK_COLS, "\t%.3f",
                             duplicates="sum")


@register("block_add_outer", "JOI-4 AGG-8 SET-1 PRJ-8", _block_text_sql(_UNION, _KEYS_OUTER, "\t%.3f"))
def q_block_add_outer(spark, sf):
    return add_matrices_text(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"),
                             BLOCK_ROWS, BLOCK_COLS, "outer", "\t%.3f")


@register("block_add_inner", "JOI-3 PRJ-19 PRJ-9", _block_text_sql(_UNION, _KEYS_INNER, " %.2f"))
def q_block_add_inner(spark, sf):
    return add_matrices_text(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"),
                             BLOCK_ROWS, BLOCK_COLS, "inner", " %.2f")


@register("block_pick", "FIL-4 JOI-3", _block_text_sql(
    _UNION, f"SELECT * FROM ({_KEYS_INNER}) WHERE bi = 1 AND bj = 2", " %.2f"))
def q_block_pick(spark, sf):
    # the block's index ranges reach the scan
    li = cells_of_block(table(spark, sf, "lineitem"), 1, 2, BLOCK_ROWS, BLOCK_COLS, "l_partkey", "l_suppkey")
    m, n = (cells(li.where(F.col("l_linestatus") == status), "l_partkey", "l_suppkey", "l_quantity") for status in "OF")
    return add_matrices_text(m, n, BLOCK_ROWS, BLOCK_COLS, "inner", " %.2f")


@register("block_tuple_text", "SNK-2 PRJ-9 FIL-4 (one block as tuple text)", f"""
SELECT '((' || bi || ',' || bj || '),' || text || ')' AS value
FROM ({_block_text_sql(_UNION, f"SELECT * FROM ({_KEYS_INNER}) WHERE bi = 1 AND bj = 2", " %.2f")})
""")
def q_block_tuple_text(spark, sf):
    return tuple_block_text(q_block_pick(spark, sf))


@register("block_lines", "SNK-1 ORD-3 PRJ-8", f"""
SELECT CAST(bi AS VARCHAR) || chr(9) || CAST(bj AS VARCHAR) || chr(9) || text AS value
FROM ({_block_text_sql(_UNION, _KEYS_OUTER, chr(9) + '%.3f')})
""")
def q_block_lines(spark, sf):
    s = add_matrices_text(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"),
                          BLOCK_ROWS, BLOCK_COLS, "outer", "\t%.3f", ordered=True)
    return keyed_block_text(s)


@register("block_order", "ORD-3 (places of the blocks in the sorted output)", f"""
SELECT bi, bj, row_number() OVER (ORDER BY bi, bj) AS place FROM ({_KEYS_OUTER})
""")
def q_block_order(spark, sf):
    """Each block's place among the lines as they come out: partitions of a
    sort are in order, and so are their rows."""
    s = add_matrices_text(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"),
                          BLOCK_ROWS, BLOCK_COLS, "outer", "\t%.3f", ordered=True)
    told = write_and_reload(s.select(
        F.struct("bi", "bj").alias("block"), F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row")), "block-order")
    before = told.groupBy("part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    starts = before.select("part", "first", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return told.join(starts, "part").select(
        "block.bi", "block.bj", (F.col("start") + F.col("row") - F.col("first") + 1).alias("place"))


# M and N with blocks that only one of them has, by rows of blocks.

def _partial(spark, sf, status: str, missing: int) -> DataFrame:
    return _matrix(spark, sf, status).where(block_index("i", BLOCK_ROWS) % 3 != missing)


_PM = f"SELECT * FROM ({_M}) WHERE i // {BLOCK_ROWS} % 3 <> 0"
_PN = f"SELECT * FROM ({_N}) WHERE i // {BLOCK_ROWS} % 3 <> 1"


@register("block_add_outer_partial", "JOI-4 AGG-8 (blocks of one side)", _block_text_sql(
    f"{_PM} UNION ALL {_PN}", _keys_sql(f"{_PM} UNION ALL {_PN}"), "\t%.3f"))
def q_block_add_outer_partial(spark, sf):
    return add_matrices_text(_partial(spark, sf, "O", 0), _partial(spark, sf, "F", 1),
                             BLOCK_ROWS, BLOCK_COLS, "outer", "\t%.3f")


@register("block_add_inner_partial", "JOI-3 PRJ-19 (blocks of one side go)", _block_text_sql(
    f"{_PM} UNION ALL {_PN}", f"{_keys_sql(_PM)} INTERSECT {_keys_sql(_PN)}", " %.2f"))
def q_block_add_inner_partial(spark, sf):
    return add_matrices_text(_partial(spark, sf, "O", 0), _partial(spark, sf, "F", 1),
                             BLOCK_ROWS, BLOCK_COLS, "inner", " %.2f")


@register("blocks_dense_cells", "AGG-7 PRJ-17 (every place of the dense arrays)", f"""
SELECT i // {BLOCK_ROWS} AS bi, j // {BLOCK_COLS} AS bj,
       CAST(i % {BLOCK_ROWS} * {BLOCK_COLS} + j % {BLOCK_COLS} AS INTEGER) AS place, v
FROM (SELECT i, j, max(v) AS v FROM ({_UNION}) GROUP BY i, j)
WHERE v <> 0
""")
def q_blocks_dense_cells(spark, sf):
    dense = coo_to_blocks(_whole_matrix(spark, sf), BLOCK_ROWS, BLOCK_COLS, duplicates="max")
    # a plain posexplode would be given a filter on the arrays' size, which builds each array twice
    return dense.select("bi", "bj", F.posexplode_outer("data").alias("place", "v")).where("v <> 0")


@register("block_add_max", "JOI-4 AGG-8 (the larger of repeated cells, one shuffle)", f"""
SELECT i // {BLOCK_ROWS} AS bi, j // {BLOCK_COLS} AS bj, CAST(i % {BLOCK_ROWS} AS INTEGER) AS r,
       CAST(j % {BLOCK_COLS} AS INTEGER) AS c, i, j, sum(v) AS v
FROM (SELECT i, j, max(v) AS v FROM ({_M}) GROUP BY i, j
      UNION ALL SELECT i, j, max(v) AS v FROM ({_N}) GROUP BY i, j)
GROUP BY i, j
""")
def q_block_add_max(spark, sf):
    return add_cells(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"), BLOCK_ROWS, BLOCK_COLS, "outer", duplicates="max")


@register("block_add_dense", "AGG-7 AGG-8 PRJ-17 PRJ-19 (dense arrays)", f"""
SELECT CAST(i // {BLOCK_ROWS} AS BIGINT) AS bi, CAST(j // {BLOCK_COLS} AS BIGINT) AS bj,
       {BLOCK_ROWS * BLOCK_COLS} AS n_cells, count(*) AS n_nonzero, sum(v) AS total
FROM (SELECT i, j, sum(v) AS v FROM ({_UNION}) GROUP BY i, j)
WHERE v <> 0
GROUP BY 1, 2
""")
def q_block_add_dense(spark, sf):
    s = add_matrices(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"), BLOCK_ROWS, BLOCK_COLS, "outer")
    # the places of the dense arrays are gone over by a compiled loop, not by lambdas; zeros add nothing
    return s.select("bi", "bj", F.size("data").alias("n_cells"), F.array_remove("data", 0.0).alias("rest")).select(
        "bi", "bj", "n_cells", F.size(F.filter("rest", lambda x: x != 0)).cast("bigint").alias("n_nonzero"),
        F.aggregate("rest", F.lit(0.0), lambda acc, x: acc + x).alias("total"))


@register("block_sum_cells", "JOI-4 AGG-8 (long form, outer)", f"""
SELECT CAST(i // {BLOCK_ROWS} AS BIGINT) AS bi, CAST(j // {BLOCK_COLS} AS BIGINT) AS bj,
       CAST(i % {BLOCK_ROWS} AS INTEGER) AS r, CAST(j % {BLOCK_COLS} AS INTEGER) AS c, i, j, v
FROM (SELECT i, j, sum(v) AS v FROM ({_UNION}) GROUP BY i, j)
""")
def q_block_sum_cells(spark, sf):
    return add_cells(_matrix(spark, sf, "O"), _matrix(spark, sf, "F"), BLOCK_ROWS, BLOCK_COLS, "outer")


# --------------------------------------------------------------------------
# Graphs from lineitem.  Vertex id = key * 4 + kind (0 part, 1 supplier,
# 2 order), so ids of different kinds never collide at any scale.

def _vid(col: str, kind: int):
    return F.col(col) * 4 + kind


def _line(*ids):
    return F.concat_ws(",", *(i.cast("string") for i in ids))


def directed_lines(spark, sf) -> DataFrame:
    """Two lines per line item: ``part,supplier`` and ``supplier,order``.

    Parts and suppliers head lines; orders only appear as neighbours.
    """
    p, s, o = _vid("l_partkey", 0), _vid("l_suppkey", 1), _vid("l_orderkey", 2)
    return fact_table(spark, sf, "lineitem").select(F.explode(F.array(_line(p, s), _line(s, o))).alias("value"))


def symmetric_lines(spark, sf) -> DataFrame:
    """Three lines per line item: ``part,supplier,order``, ``supplier,part``
    and ``order,part``: an undirected part-supplier / part-order graph."""
    p, s, o = _vid("l_partkey", 0), _vid("l_suppkey", 1), _vid("l_orderkey", 2)
    return fact_table(spark, sf, "lineitem").select(F.explode(F.array(
        _line(p, s, o), _line(s, p), _line(o, p))).alias("value"))


_SYM_EDGES = """
SELECT l_partkey * 4 AS src, l_suppkey * 4 + 1 AS dst FROM lineitem
UNION ALL SELECT l_partkey * 4, l_orderkey * 4 + 2 FROM lineitem
UNION ALL SELECT l_suppkey * 4 + 1, l_partkey * 4 FROM lineitem
UNION ALL SELECT l_orderkey * 4 + 2, l_partkey * 4 FROM lineitem
"""
_DIR_EDGES = """
SELECT l_partkey * 4 AS src, l_suppkey * 4 + 1 AS dst FROM lineitem
UNION ALL SELECT l_suppkey * 4 + 1, l_orderkey * 4 + 2 FROM lineitem
"""


def _propagate_sql(edges_sql: str, rounds: int, implicit: bool) -> str:
    """Unrolled label propagation in DuckDB; ends with CTE ``l{rounds}``."""
    parts = [f"e0 AS (SELECT DISTINCT CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst FROM ({edges_sql}))",
             "h AS (SELECT DISTINCT src AS id FROM e0)"]
    if implicit:
        parts.append("e AS (SELECT * FROM e0)")
    else:
        parts.append("e AS (SELECT * FROM e0 WHERE dst IN (SELECT id FROM h))")
    parts.append("l0 AS (SELECT id, id AS grp FROM h)")
    for r in range(1, rounds + 1):
        parts.append(
            f"l{r} AS (SELECT id, min(grp) AS grp FROM ("
            f"SELECT id, grp FROM l{r-1} UNION ALL "
            f"SELECT e.dst AS id, l{r-1}.grp FROM e JOIN l{r-1} ON e.src = l{r-1}.id) GROUP BY id)")
    return "WITH " + ",\n".join(parts) + "\n"


@register("adjacency_parse", "SRC-11 PRJ-3 PRJ-15 ARR-1", """
SELECT id, n, s FROM (
  SELECT l_partkey * 4 AS id, 2 AS n, l_suppkey * 4 + 1 + l_orderkey * 4 + 2 AS s FROM lineitem
  UNION ALL SELECT l_suppkey * 4 + 1, 1, l_partkey * 4 FROM lineitem
  UNION ALL SELECT l_orderkey * 4 + 2, 1, l_partkey * 4 FROM lineitem)
""")
def q_adjacency_parse(spark, sf):
    rows = adjacency_rows(symmetric_lines(spark, sf))
    return rows.select("id", F.size("adj").cast("int").alias("n"),
                       F.aggregate("adj", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("s"))


def _labels(spark, sf, lines_fn, rounds, implicit):
    return propagate_min(read_adjacency(lines_fn(spark, sf)), rounds=rounds,
                         implicit_vertices=implicit)


@register("propagate_round_1", "GRA-1 GRA-2 SET-2 ARR-1 AGG-4 JOI-6",
          _propagate_sql(_SYM_EDGES, 1, True) + "SELECT id, grp FROM l1")
def q_propagate_round_1(spark, sf):
    return _labels(spark, sf, symmetric_lines, 1, True)


@register("propagate_5", "GRA-3 GRA-2 AGG-4",
          _propagate_sql(_SYM_EDGES, 5, True) + "SELECT id, grp FROM l5")
def q_propagate_5(spark, sf):
    return _labels(spark, sf, symmetric_lines, 5, True)


@register("propagate_5_directed", "GRA-3 JOI-6 AGG-9 (implicit vertices)",
          _propagate_sql(_DIR_EDGES, 5, True) + "SELECT id, grp FROM l5")
def q_propagate_5_directed(spark, sf):
    return _labels(spark, sf, directed_lines, 5, True)


@register("propagate_5_explicit_only", "GRA-3 JOI-5 (line heads only)",
          _propagate_sql(_DIR_EDGES, 5, False) + "SELECT id, grp FROM l5")
def q_propagate_5_explicit_only(spark, sf):
    return _labels(spark, sf, directed_lines, 5, False)


@register("propagate_5_hot", "GRA-3 GRA-2 AGG-4 (sources of 50 edges or more are broadcast)",
          _propagate_sql(_SYM_EDGES, 5, True) + "SELECT id, grp FROM l5")
def q_propagate_5_hot(spark, sf):
    return propagate_min(read_adjacency(symmetric_lines(spark, sf)), rounds=5, min_hot_degree=50)


@register("component_sizes", "GRA-4 AGG-5 PRJ-21",
          _propagate_sql(_SYM_EDGES, 5, True) + "SELECT grp, count(*) AS n FROM l5 GROUP BY grp")
def q_component_sizes(spark, sf):
    return component_sizes(_labels(spark, sf, symmetric_lines, 5, True))


@register("component_sizes_directed", "GRA-4 AGG-5 (implicit vertices counted)",
          _propagate_sql(_DIR_EDGES, 5, True) + "SELECT grp, count(*) AS n FROM l5 GROUP BY grp")
def q_component_sizes_directed(spark, sf):
    return component_sizes(_labels(spark, sf, directed_lines, 5, True))


# --------------------------------------------------------------------------
# Files: typed loads, layouts, long lines, committed output, stored states

@register("csv_quoted", "SRC-2 SRC-7 PRJ-20 (quoted separators and quotes, bad records kept)", """
SELECT c_custkey AS id, c_name || ', "' || c_mktsegment || '", ' || c_nationkey AS name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance,
       CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey AS VARCHAR) || ',"' || c_name || ', ""' || c_mktsegment || '"", '
            || c_nationkey || '",n/a' END AS bad
FROM customer
""")
def q_csv_quoted(spark, sf):
    c = table(spark, sf, "customer")
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('", '), F.col("c_nationkey").cast("string"))
    balance = F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    path = scratch_path(spark, "csv-quoted")
    write_csv(c.select("c_custkey", name, balance), path)
    back = read_csv(spark, path, "id bigint, name string, balance double", corrupt=True)
    return back.select("id", "name", "balance", F.col(CORRUPT).alias("bad"))


@register("csv_bad_records", "SRC-2 SRC-6 (records that do not fit a declared schema)", """
SELECT CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus || CASE WHEN o_custkey % 11 = 0 THEN '' ELSE ',x' END AS value
FROM orders WHERE o_custkey % 11 = 0 OR o_orderkey % 13 = 0
""")
def q_csv_bad_records(spark, sf):
    # short records, and records with a number that is none
    o = table(spark, sf, "orders")
    last = F.when(F.col("o_custkey") % 11 == 0, "").when(F.col("o_orderkey") % 13 == 0, ",x").otherwise(",1.5")
    lines = o.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(","), "o_orderstatus", last).alias("value"))
    path = scratch_path(spark, "csv-bad")
    write_lines(lines, path)
    return bad_records(read_csv(spark, path, "k bigint, status string, x double", corrupt=True))


@register("csv_trip_pruned", "SRC-2 SRC-10 FIL-2 AGG-2 PRJ-1 (typed load of a whole record, three columns read)", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_TRIP_DIST} AS distance, CAST(l_extendedprice AS DECIMAL(12,2)) AS v FROM lineitem)
WHERE distance < 200
GROUP BY distance
""")
def q_csv_trip_pruned(spark, sf):
    path = scratch_path(spark, "csv-trip")
    write_lines(trip_lines(spark, sf), path)
    record = read_csv(spark, path, "key string, " + ", ".join(f"s{k} string" for k in range(3))
                      + ", distance double, " + ", ".join(f"t{k} string" for k in range(4)) + ", amount decimal(12,2)")
    kept = record.where(~full_match("key", ".*orderkey.*"))
    return bucket_mean(kept, "distance", "amount", min_key=None, max_key=200)


@register("trip_pig_script", "SRC-13 SQL-1 SQL-2 UDX-1 SRC-2 FIL-3 (one SQL script, its path a parameter)", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_TRIP_DIST} AS distance, CAST(l_extendedprice AS DECIMAL(12,2)) AS v FROM lineitem)
WHERE distance < 200
GROUP BY distance
""")
def q_trip_pig_script(spark, sf):
    path = scratch_path(spark, "trip-script")
    write_lines(trip_lines(spark, sf), path)
    return trip_means_script(spark, path, amount_field=9, amount_type="decimal(12,2)", header_pattern=".*orderkey.*")


@register("adjacency_long_lines", "SRC-11 PRJ-15 ARR-1 (lines that no task holds)", """
SELECT l_suppkey * 4 + 1 AS src, l_partkey * 4 AS dst FROM lineitem
UNION ALL SELECT s_suppkey * 4 + 1, NULL FROM supplier
""")
def q_adjacency_long_lines(spark, sf):
    # a line for each supplier and sixteenth of its orders, written number by number: its neighbours add up
    li, s = fact_table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    line = Window.partitionBy("l_suppkey", F.col("l_orderkey") % 16).orderBy("l_orderkey", "l_linenumber")
    head = F.concat(F.lit("\n"), _vid("l_suppkey", 1).cast("string"), F.lit(","))
    number = F.concat(F.when(F.row_number().over(line) == 1, head).otherwise(""), _vid("l_partkey", 0).cast("string"))
    lonely = s.select(F.concat(F.lit("\n"), _vid("s_suppkey", 1).cast("string")).alias("value"))
    path = scratch_path(spark, "long-lines")
    li.select(number.alias("value")).write.option("lineSep", ",").text(f"{path}/lines")
    lonely.write.option("lineSep", ",").text(f"{path}/heads")
    pairs = read_long_adjacency(spark, [f"{path}/lines", f"{path}/heads"]).pairs
    alone = pairs.where("dst IS NULL").distinct()  # each line tells its head
    return pairs.where("dst IS NOT NULL").unionByName(alone)


@register("join_two_layouts_one_scan", "SRC-4 SRC-3 JOI-1 SRC-5 (the parser chosen by the file, one scan)", """
SELECT c_nationkey AS dno, c_name || ' ' || n_name AS pair
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0
""")
def q_join_two_layouts_one_scan(spark, sf):
    c = table(spark, sf, "customer")
    people = c.select(F.concat(F.col("c_name"), F.lit(";"), F.when(F.col("c_custkey") % 7 == 0, F.lit("?"))
                               .otherwise(F.col("c_nationkey").cast("string"))).alias("value"))
    n = render_lines(table(spark, sf, "nation"), ["n_nationkey", "n_name", "n_regionkey"], sep="|")
    head = spark.range(1).select(F.lit("key|name|region").alias("value"))
    path = scratch_path(spark, "layouts")
    write_lines(people, f"{path}/people")
    write_lines(head.unionByName(n), f"{path}/places")
    rows = read_layouts(spark, f"{path}/*", {
        "people": Layout("/people/", "name string, dno bigint", sep=";", on_error="drop"),
        "places": Layout("/places/", "dno bigint, name string", sep="|", header=HeaderRule("letter", 0))})
    return join_tagged(rows, "dno", "people", "places")


@register("join_hot_both", "JOI-1 (a key with a third of both sides)", """
SELECT dno, name || ' ' || place AS pair
FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE c_nationkey END AS dno, c_name AS name FROM customer)
JOIN (SELECT CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE s_nationkey END AS dno, s_name AS place FROM supplier) USING (dno)
""")
def q_join_hot_both(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    left = c.select(F.when(F.col("c_custkey") % 3 == 0, -1).otherwise(F.col("c_nationkey")).alias("dno"), F.col("c_name").alias("name"))
    right = s.select(F.when(F.col("s_suppkey") % 3 == 0, -1).otherwise(F.col("s_nationkey")).alias("dno"), F.col("s_name").alias("place"))
    return equi_join_hot(left, right, "dno").select("dno", pair_text("name", "place").alias("pair"))


@register("bucket_mean_states", "AGG-10 AGG-1 SNK-3 (stored states of two halves, merged)", f"""
SELECT distance, {_mean('v')} AS mean
FROM (SELECT {_rhu('l_extendedprice / 500')} AS distance, {REVENUE_SQL} AS v FROM lineitem)
WHERE distance >= 0 AND distance < 200
GROUP BY distance
""")
def q_bucket_mean_states(spark, sf):
    li = table(spark, sf, "lineitem")
    folder = StateFolder(spark, scratch_path(spark, "states"))
    for half in (0, 1):
        rows = li.where(F.col("l_orderkey") % 2 == half)
        folder.add(f"half-{half}", mean_states(rows, F.col("l_extendedprice") / 500, _revenue()))
    return means_of(folder.states(), min_key=0, max_key=200)


@register("committed_output", "SNK-4 SNK-1 SNK-3 (read back through a manifest; a second write is refused)", f"""
SELECT distance, {_mean('v')} AS mean, TRUE AS refused
FROM (SELECT {_rhu('o_totalprice / 1000')} AS distance, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders)
GROUP BY distance
""")
def q_committed_output(spark, sf):
    o, path = table(spark, sf, "orders"), scratch_path(spark, "committed")
    write_committed(bucket_mean(o, F.col("o_totalprice") / 1000, F.col("o_totalprice").cast("decimal(12,2)")), path)
    try:
        write_committed(o.select("o_orderkey"), path)
        refused = False
    except AnalysisException as error:
        refused = "PATH_ALREADY_EXISTS" in str(error)
    return read_committed(spark, path, verify="rows").withColumn("refused", F.lit(refused))


@register("sorted_lines", "ORD-2 SNK-1 SRC-3 (lines of a job in the order of their keys)", f"""
SELECT CAST(user_id AS BIGINT) || chr(9) || n AS value, row_number() OVER (ORDER BY user_id) AS place
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
""")
def q_sorted_lines(spark, sf):
    """Each line's place in the written files: files are in the order of their names, lines in that of a file."""
    counts = count_by_key(table(spark, sf, "events"), "user_id", key_name="key").orderBy("key")
    path = scratch_path(spark, "sorted")
    write_lines(counts.select(tab_line("key", "n").alias("value")), path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("row"))
    told = write_and_reload(lines, "sorted-places")
    pieces = told.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file split
    starts = pieces.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return told.join(starts, ["file", "block"]).select("value", (F.col("start") + F.col("row") - F.col("first") + 1).alias("place"))


def queries() -> dict[str, QueryFn]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
