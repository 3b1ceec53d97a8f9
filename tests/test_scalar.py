import math
import random

import pytest
from pyspark.sql import functions as F

from kestrel.functions import (block_index, block_offset, floor_to, format_key_value,
                               render_block, round_half_up)
from kestrel.functions.scalar import format_fixed


def _one(spark, values, fn, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_round_half_up_golden(spark):
    # ties toward +infinity, like Math.round / Pig ROUND / Float.round
    got = _one(spark, [2.5, -2.5, 0.5, -0.5, 1.49, 0.49999999999999994, -1.5, 3.0], round_half_up)
    assert got == [3, -2, 1, 0, 1, 0, -1, 3]


def test_round_half_up_float(spark):
    got = _one(spark, [2.5, -2.5, 1.49], round_half_up, "float")
    assert got == [3, -2, 1]


def test_round_half_up_matches_exact_rule(spark):
    rnd = random.Random(7)
    vals = [rnd.uniform(-1e6, 1e6) for _ in range(500)] + [k / 2 for k in range(-40, 40)]
    got = _one(spark, vals, round_half_up)
    assert got == [math.floor(v + 0.5) if (v - math.floor(v)) != 0.5 else math.floor(v) + 1
                   for v in vals]


def test_floor6_golden(spark):
    got = _one(spark, [13.549999999999997, 8.9525, -0.48666666666666697, 0.49999999999999994, 2.0],
               lambda c: floor_to(c, 6))
    assert got == [13.549999, 8.9525, -0.486667, 0.499999, 2.0]


def test_format_key_value_half_up(spark):
    df = spark.createDataFrame([(1, 8.9525), (0, 13.549999999999997)], "k int, v double")
    got = [r[0] for r in df.select(format_key_value("k", "v")).collect()]
    assert got == ["  1\t8.953", "  0\t13.550"]


@pytest.mark.parametrize("digits", [0, 2, 3, 6])
def test_format_fixed_equals_formatter(spark, digits):
    rnd = random.Random(digits)
    vals = [8.9525, -8.9525, 0.0005, -0.0005, -0.0004, -0.0, 0.0, 1e19, 1e21, -1e21,
            float("nan"), float("inf"), float("-inf"), 0.30000000000000004, 99999.9995, 4.345]
    vals += [rnd.uniform(-1e4, 1e4) for _ in range(300)] + [round(rnd.uniform(-9, 9), 4) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    bad = df.where(format_fixed("x", digits) != F.format_string(f"%.{digits}f", "x")).count()
    assert bad == 0


def test_block_index_offset(spark):
    df = spark.createDataFrame([(0,), (7,), (8,), (17,)], "i int")
    got = df.select(block_index("i", 8).alias("b"), block_offset("i", 8).alias("o")).collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 7), (1, 0), (2, 1)]


def test_render_block_layouts(spark):
    df = spark.createDataFrame([([1.0, 2.5, 8.9525, 0.0, -0.0004, 3.0],)], "d array<double>")
    tab = df.select(render_block("d", 2, 3, "\t%.3f")).first()[0]
    assert tab == "\n\t1.000\t2.500\t8.953\n\t0.000\t-0.000\t3.000\n"
    space = df.select(render_block("d", 2, 3, " %.2f")).first()[0]
    assert space == "\n 1.00 2.50 8.95\n 0.00 -0.00 3.00\n"


EXTREMES = [(float("nan"), 0), (float("inf"), 2147483647), (float("-inf"), -2147483648), (3e9, 2147483647),
            (-3e9, -2147483648), (2147483646.5, 2147483647), (-2147483647.5, -2147483647), (0.49999999999999994, 0)]


def test_round_half_up_at_the_ends(spark):
    df = spark.createDataFrame([(float(x),) for x, _ in EXTREMES], "x double")
    assert [r[0] for r in df.select(round_half_up("x")).collect()] == [want for _, want in EXTREMES]
    assert [r[0] for r in df.select(round_half_up(F.col("x").cast("float"))).limit(3).collect()] == [0, 2147483647, -2147483648]


def test_floor_to_never_rounds_up(spark):
    values = [9.999999999999997e-7, -9.999999999999997e-7, 1e-6, 1e-300, -1e-300, 0.0, 1e15, 2.5e-7]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = [r[0] for r in df.select(floor_to("x")).collect()]
    assert got == [0.0, -1e-6, 1e-6, 0.0, -1e-6, 0.0, 1e15, 0.0]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double").select(floor_to("x")).collect()
    assert odd[0][0] != odd[0][0] and odd[1][0] == float("inf")


def test_block_index_beyond_int(spark):
    df = spark.createDataFrame([(3_000_000_007, )], "i long")
    assert tuple(df.select(block_index("i", 10), block_offset("i", 10)).first()) == (300_000_000, 7)
