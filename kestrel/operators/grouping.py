"""Keyed means: rounded-key buckets, bounds, minimum support, finishing.

Each is one ``groupBy().agg()``: Spark aggregates partially inside every
scan task (map-side combine), so only one small partial row per key and
task crosses the shuffle, even when one key holds most of the rows.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.fence import evaluate_once
from kestrel.functions.scalar import floor_to, round_half_up

ValueType = Literal["double", "float", "as_is"]
Finish = Literal["none", "floor6"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean_expr(value: Column) -> Column:
    """``sum(v) / count(v)`` as a double, nulls ignored by both.

    A decimal value is summed exactly and only the final sum becomes a
    double, so the result does not depend on the order of the rows.  A
    group whose values are all null gets a null mean.
    """
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def mean_by_key(df: DataFrame, key: Column | str, value: Column | str,
                key_name: str = "key", mean_name: str = "mean") -> DataFrame:
    """Average of ``value`` per ``key`` (nulls ignored)."""
    return (df.select(_col(key).alias(key_name), _col(value).alias("_v"))
              .groupBy(key_name)
              .agg(mean_expr(F.col("_v")).alias(mean_name)))


def bucket_mean(df: DataFrame, key: Column | str, value: Column | str, *,
                round_key: bool = True,
                min_key: int | None = None,
                max_key: int | None = None,
                min_count: int | None = None,
                value_type: ValueType = "as_is",
                finish: Finish = "none",
                key_name: str = "distance",
                mean_name: str = "mean",
                count_name: str | None = None,
                order: bool = True) -> DataFrame:
    """Mean of ``value`` per integer bucket of ``key``.

    round_key   bucket = ``key`` rounded half toward +infinity (2.5 -> 3,
                -2.5 -> -2); otherwise ``key`` is cast to int.
    min_key     keep buckets ``>= min_key`` (None: no lower bound).
    max_key     keep buckets ``< max_key`` (None: no upper bound).
    min_count   keep buckets with at least this many rows.
    value_type  ``float`` averages single-precision values (result double);
                ``double`` casts to double; ``as_is`` keeps the column type
                (decimals are then summed exactly).
    finish      ``floor6`` floors the mean to 6 decimals.
    Rows whose bucket is null (unparsed key) are dropped by the bounds.
    """
    k = round_half_up(_col(key)) if round_key else _col(key).cast("int")
    v = _col(value)
    if value_type == "float":
        v = v.cast("float")
    elif value_type == "double":
        v = v.cast("double")

    # The key is computed once: the bounds below test its value.
    rows = evaluate_once(df.select(k.alias(key_name), v.alias("_v")))
    if min_key is not None:
        rows = rows.where(F.col(key_name) >= F.lit(min_key))
    if max_key is not None:
        rows = rows.where(F.col(key_name) < F.lit(max_key))
    if min_key is None and max_key is None:
        rows = rows.where(F.col(key_name).isNotNull())

    aggs = [mean_expr(F.col("_v")).alias(mean_name)]
    if min_count is not None or count_name:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    out = rows.groupBy(key_name).agg(*aggs)
    if min_count is not None:
        out = out.where(F.col("_n") >= F.lit(min_count))
    if finish == "floor6":
        out = out.withColumn(mean_name, floor_to(F.col(mean_name), 6))
    elif finish != "none":
        raise ValueError(f"unknown finish {finish!r}")
    cols = [key_name, mean_name] + ([F.col("_n").alias(count_name)] if count_name else [])
    out = out.select(*cols)
    return out.orderBy(key_name) if order else out


def count_by_key(df: DataFrame, key: Column | str, key_name: str = "grp",
                 count_name: str = "n") -> DataFrame:
    """Number of rows per key (a sum of ones), as a bigint.

    A 32-bit count would overflow once one key holds 2^31 rows.
    """
    return (df.select(_col(key).alias(key_name))
              .groupBy(key_name)
              .agg(F.count(F.lit(1)).alias(count_name)))
