"""Minimum-label propagation over a directed graph, and group sizes.

Each round: every vertex sends its label along its out-edges, and every
vertex takes the minimum of its own label and the labels it received.

Distributed plan of one round:

* light edges (source out-degree below the hot threshold) join the labels
  on ``src``; both are stored bucketed on the join key, so neither moves;
* hot edges (sources with a huge out-degree) join a broadcast copy of the
  hot sources' labels, so a hot source's edges are never funnelled into
  one task.  A source is hot once it outweighs a bucket, so there are at
  most ``MAX_BUCKETS`` of them: the proven bound on what is broadcast;
* in the first round every head sends its own id, which its edges tell:
  nothing is joined; the messages of later rounds meet the frontier;
* messages alone are reduced with ``min`` per target, combined map-side
  first, so a target with a huge in-degree sends one row per task to the
  shuffle.  The reduction has as many partitions as there are buckets, and
  its result meets the bucketed labels where they lie: labels never move;
* the labels are a log (``LayeredTable``): a round writes those that
  dropped, as a layer in the same buckets, and the next round sends that
  layer alone.  What a round writes and sends follows its changes.

The edges and the log are tables of a database of the run, in the
checkpoint folder (``spark.checkpoint.dir``): that cuts the lineage, so a
lost executor costs at most one round's recomputation.  The database is
dropped once the result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.grouping import count_by_key
from kestrel.plans.layers import LayeredTable
from kestrel.plans.materialize import RunTables, setting, write_and_reload
from kestrel.sources.adjacency import Graph

# A source whose out-degree reaches this many edges is treated as hot
# regardless of the graph size.
DEFAULT_MIN_HOT_DEGREE = 100_000
# Spark writes no table of more buckets than this.
MAX_BUCKETS = 100_000
# At most this many sources are ever treated as hot (and broadcast).
DEFAULT_MAX_HOT_SOURCES = MAX_BUCKETS
# Cells that sources are hashed to, to tell which of them may be hot: more than hot sources, so that
# an average cell stays below the threshold.
DEGREE_CELLS = 1 << 18
# Target size of one bucket of the written edge table (two longs per edge).
EDGES_PER_BUCKET = 16_000_000
# Layers of the label log before those below the newest are merged.
MERGE_DEPTH = 8


def hot_sources(pairs: DataFrame, min_hot_degree: int, max_hot_sources: int,
                tables: RunTables, cells: int = DEGREE_CELLS) -> tuple[DataFrame | None, int]:
    """(ids of the hot sources, |E|) of ``pairs(src, dst)``.

    The threshold is ``max(min_hot_degree, ceil(|E| / max_hot_sources))``;
    since out-degrees add up to ``|E|``, at most ``max_hot_sources`` sources
    can reach it.  The edges are first counted by ``cells`` hashes of their
    sources, which gives |E| and, as no source has more edges than its
    cell, which sources can be hot.  Only these have their degrees counted;
    where there are none, nothing more is computed and the ids are ``None``.
    """
    cell = F.pmod(F.xxhash64("src"), F.lit(cells))
    counted = pairs.groupBy(cell.alias("_cell")).agg(F.count("dst").alias("_deg"))
    total, largest = counted.agg(F.sum("_deg"), F.max("_deg")).first()
    total, largest = total or 0, largest or 0
    threshold = max(min_hot_degree, -(-total // max_hot_sources), 1)
    if largest < threshold:
        return None, total
    some = pairs
    if threshold * cells > total:  # else most cells reach the threshold
        full = counted.where(F.col("_deg") >= F.lit(threshold)).select("_cell")
        some = pairs.withColumn("_cell", cell).join(F.broadcast(full), "_cell", "left_semi")
    degrees = some.groupBy("src").agg(F.count("dst").alias("_deg"))
    hot = tables.write(degrees.where(F.col("_deg") >= F.lit(threshold)).select("src"), "hot_src")
    return (None if hot.isEmpty() else hot), total


def bucket_count(spark: SparkSession, edges: int, per_bucket: int = EDGES_PER_BUCKET) -> int:
    """Buckets for the edge and label tables: about ``per_bucket`` edges
    each, a multiple of the shuffle partitions, at most ``MAX_BUCKETS``."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(parts * max(1, -(-edges // (per_bucket * parts))), MAX_BUCKETS)


def propagate_min(graph: Graph, rounds: int = 5, implicit_vertices: bool = True, *,
                  min_hot_degree: int = DEFAULT_MIN_HOT_DEGREE,
                  max_hot_sources: int = DEFAULT_MAX_HOT_SOURCES,
                  merge_depth: int = MERGE_DEPTH,
                  on_round=None) -> DataFrame:
    """Labels ``(id bigint, grp bigint)`` after ``rounds`` propagation rounds.

    Initially each line head has its own id as label.  ``rounds`` is fixed;
    there is no convergence test, so small groups may still be unmerged.
    Repeated edges are sent once.

    implicit_vertices  a vertex that only appears as a neighbour joins the
        result from round 1 on, labelled with the minimum it received (it
        has no label of its own before that), and keeps no out-edges.
        Without it only line heads are kept.
    merge_depth  layers of the label log before they are merged.
    on_round  optional callback ``(round, DataFrame)`` seeing each round's
        plan, the labels that drop, before it is written (for inspection).

    Layout: the light edges are written once as a table bucketed by
    ``src``; the layers of the labels are bucketed by ``id`` with the same
    bucket count.  Each round's joins read them where they lie: edges and
    labels never move again, and only the (map-side combined) messages are
    shuffled.

    Rounds run when this function is called; the labels returned are read
    from a written table.
    """
    if rounds < 0:
        raise ValueError("rounds must be >= 0")
    spark = graph.pairs.sparkSession
    with RunTables(spark, "graph") as tables:
        # One pass over the input: heads and edges both come from ``pairs``.
        pairs = tables.write(graph.pairs.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint")), "pairs")
        if not implicit_vertices:
            heads = pairs.select(F.col("src").alias("dst")).distinct()
            known = pairs.where(F.col("dst").isNotNull()).join(heads, "dst", "left_semi").select("src", "dst")
            pairs = tables.write(known.unionByName(heads.select(
                F.col("dst").alias("src"), F.lit(None).cast("bigint").alias("dst"))), "known")
        hot_ids, total = hot_sources(pairs, min_hot_degree, max_hot_sources, tables)
        buckets = bucket_count(spark, total)
        # A row with a null ``dst`` makes its source a head; a hot source
        # leaves just that in the bucketed table.  No source there outweighs
        # a bucket, so bucketing by src is balanced; repeated edges are
        # dropped on the way, in the shuffle that deals out the buckets.
        light, hot = pairs, None
        if hot_ids is not None:
            light = (pairs.join(F.broadcast(hot_ids), "src", "left_anti")
                     .unionByName(hot_ids.select("src", F.lit(None).cast("bigint").alias("dst"))))
            hot = tables.write(pairs.where(F.col("dst").isNotNull()).join(F.broadcast(hot_ids), "src", "left_semi")
                               .dropDuplicates(["src", "dst"]), "hot_edges")
        light = tables.write_bucketed(light.repartition(buckets, "src").dropDuplicates(["src", "dst"]),
                                      "light_edges", buckets, "src")
        tables.drop("pairs", "known")

        # Semi-naive rounds: only labels that dropped in the previous round
        # (the log's newest layer) are sent along the edges.  Min-labels never
        # rise, so a vertex whose in-neighbours kept their labels cannot change.
        # Round 1 starts from the distinct heads (own id as label), which lie
        # in the buckets of the edges.
        log = LayeredTable(tables, "labels", "id", buckets, merge_depth)
        with setting(spark, "spark.sql.shuffle.partitions", buckets):
            log.append(light.select(F.col("src").alias("id")).distinct().select("id", F.col("id").alias("grp")))
            for r in range(1, rounds + 1):
                dropped = _dropped(log, _messages(log, light, hot, hot_ids, r), implicit_vertices)
                if on_round is not None:
                    on_round(r, dropped)
                log.append(dropped)
            return write_and_reload(log.current(), "labels")


def _messages(log: LayeredTable, light: DataFrame, hot: DataFrame | None, hot_ids: DataFrame | None,
              r: int) -> DataFrame:
    """``(id, grp)`` sent in round ``r`` along the edges of the vertices whose label dropped before."""
    light = light.where(F.col("dst").isNotNull())
    if r == 1:  # every head sends its own id, which its edges tell
        sent = light if hot is None else light.unionByName(hot)
        return sent.where(F.col("src").isNotNull()).select(F.col("dst").alias("id"), F.col("src").alias("grp"))
    frontier = log.newest().select(F.col("id").alias("src"), F.col("grp"))
    msgs = light.join(frontier.hint("shuffle_hash"), "src").select(F.col("dst").alias("id"), "grp")
    if hot_ids is not None:
        hot_frontier = frontier.join(F.broadcast(hot_ids), "src", "left_semi")
        msgs = msgs.unionByName(hot.join(F.broadcast(hot_frontier), "src").select(F.col("dst").alias("id"), "grp"))
    return msgs


def _dropped(log: LayeredTable, msgs: DataFrame, implicit_vertices: bool) -> DataFrame:
    """``(id, grp)`` of the vertices whose label drops in one more round, by the messages of the round."""
    best = msgs.groupBy("id").agg(F.min("grp").alias("_best"))
    met = log.current().join(best.hint("shuffle_hash"), "id", "right" if implicit_vertices else "inner")
    return met.where(F.col("grp").isNull() | (F.col("_best") < F.col("grp"))).select("id", F.col("_best").alias("grp"))


def component_sizes(labels: DataFrame) -> DataFrame:
    """``(grp, n)``: number of vertices per label."""
    return count_by_key(labels, "grp", key_name="grp", count_name="n")
