"""Connected components of an edge table by alternating star contraction.

Every round relinks each node to the smallest node it sees, first for larger neighbours, then for
smaller ones; it ends when no link changes, after about log(size) rounds.  Rounds are written to
the checkpoint folder.  Groups are reduced by a minimum before they are joined back, so that a node
with very many links is never gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.plans.materialize import write_and_reload


def _relink(edges: DataFrame) -> DataFrame:
    """``edges``: u, v with u the node that sees v.  Adds ``m``: the smallest of u and what it sees."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = write_and_reload) -> DataFrame:
    """``edges``: a, b (longs).  One row ``node, root`` for each node with a link; ``root`` is the
    smallest node of its component.  ``keep`` writes a round's table and reads it back."""
    links = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                             .filter("u <> v").distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _relink(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        seen = _relink(large)
        small = (seen.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(seen.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        links, before = keep(small, "links"), state
        state = _state(links)
        if state == before:
            break
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
