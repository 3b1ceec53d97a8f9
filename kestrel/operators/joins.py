"""Equi-joins of keyed record sets.

Strategy: let Catalyst choose by size.  A side whose scan statistics lie
below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, and the other
side never moves.  Beyond it Spark shuffles both sides on the key, and AQE
turns the join into a broadcast join at runtime when a side is measured
small, or splits a skewed key's partition over several tasks
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.fence import evaluate_once
from kestrel.functions.scalar import pair_text


def equi_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join on equal key columns (N x M rows within a key)."""
    return left.join(right, on=on, how=how)


def equi_join_pairs(left: DataFrame, right: DataFrame, *,
                    left_key: str, right_key: str,
                    left_value: Column | str, right_value: Column | str,
                    keep_key: bool = True, sep: str = " ",
                    key_name: str = "dno", pair_name: str = "pair") -> DataFrame:
    """Inner join that emits ``"<left value><sep><right value>"`` per match.

    With ``keep_key`` the join key is kept as a first column (keyed text
    output); otherwise only the pair text is returned.  Rows with a null
    key never match.
    """
    lv = F.col(left_value) if isinstance(left_value, str) else left_value
    rv = F.col(right_value) if isinstance(right_value, str) else right_value
    l_side = left.select(F.col(left_key).alias(key_name), lv.alias("_l"))
    r_side = right.select(F.col(right_key).alias(key_name), rv.alias("_r"))
    joined = equi_join(l_side, r_side, key_name, "inner")
    cols = ([F.col(key_name)] if keep_key else []) + [pair_text("_l", "_r", sep).alias(pair_name)]
    return joined.select(*cols)


def join_tagged(stream: DataFrame, key: str, left_tag, right_tag, *, tag: str = "layout",
                left_value: str = "name", right_value: str = "name", sep: str = " ",
                pair_name: str = "pair") -> DataFrame:
    """``(key, "<left value><sep><right value>")`` of the rows of ``stream`` tagged ``left_tag`` and
    ``right_tag`` that share a key.

    The stream is made and dealt by key once; both sides of the join read that one exchange.
    """
    dealt = evaluate_once(stream.where(F.col(tag).isin(left_tag, right_tag) & F.col(key).isNotNull())
                          .select(key, tag, *dict.fromkeys([left_value, right_value])).repartition(key))
    left = dealt.where(F.col(tag) == left_tag).select(key, F.col(left_value).alias("_l"))
    right = dealt.where(F.col(tag) == right_tag).select(key, F.col(right_value).alias("_r"))
    return left.join(right.hint("merge"), key).select(key, pair_text("_l", "_r", sep).alias(pair_name))
