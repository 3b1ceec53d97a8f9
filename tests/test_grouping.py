from pyspark.sql import functions as F

from kestrel.operators import bucket_mean, count_by_key, mean_by_key
from kestrel.sources import parse_delimited, table

from conftest import SF_SMALL, rows


def test_simple_mean_golden(spark, lines):
    parsed = parse_delimited(lines(["1,2.3", "2,3.4", "1,4.5", "3,6.6", "2,3.0"]), "k int, v double")
    got = {r["key"]: r["mean"] for r in mean_by_key(parsed, "k", "v").collect()}
    assert got == {1: 3.4, 2: 3.2, 3: 6.6}


def test_bounds(spark):
    df = spark.createDataFrame([(float(k), 1.0) for k in (-1, 0, 199, 200)], "k double, v double")
    two = bucket_mean(df, "k", "v", min_key=0, max_key=200)
    upper = bucket_mean(df, "k", "v", min_key=None, max_key=200)
    assert [r[0] for r in two.collect()] == [0, 199]
    assert [r[0] for r in upper.collect()] == [-1, 0, 199]


def test_min_count(spark):
    df = spark.createDataFrame([(1, 1.0)] * 3 + [(2, 1.0)] * 2 + [(3, 1.0)], "k int, v double")
    out = bucket_mean(df, "k", "v", round_key=False, min_count=3, count_name="n")
    assert rows(out) == [(1, 1.0, 3)]


def test_null_values_ignored(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "k int, v double")
    got = {r[0]: r[1] for r in bucket_mean(df, "k", "v", round_key=False).collect()}
    assert got == {1: 2.0, 2: None}


def test_float_average(spark):
    df = spark.createDataFrame([(0.0, 4.3)], "k double, v double")
    got = bucket_mean(df, "k", "v", value_type="float").first()["mean"]
    assert got == 4.300000190734863


def test_partitioning_does_not_change_result(spark):
    li = table(spark, SF_SMALL, "lineitem")
    value = F.col("l_extendedprice").cast("decimal(12,2)")
    base = rows(bucket_mean(li, F.col("l_extendedprice") / 500, value, min_key=0, max_key=200))
    for n in (1, 3, 17):
        again = rows(bucket_mean(li.repartition(n), F.col("l_extendedprice") / 500, value,
                                 min_key=0, max_key=200))
        assert again == base
    assert sum(r["n"] for r in count_by_key(li, "l_returnflag").collect()) == li.count()


def test_scans_are_spread_only_when_asked(spark):
    from conftest import SF_SMALL
    from kestrel.sources import fact_table

    def plan():
        return fact_table(spark, SF_SMALL, "lineitem")._jdf.queryExecution().executedPlan().toString()

    assert "RoundRobin" not in plan()
    spark.conf.set("kestrel.scan.partitions", "5")
    try:
        assert "RoundRobinPartitioning(5)" in plan()
    finally:
        spark.conf.unset("kestrel.scan.partitions")
