"""Adjacency-list text (``id,n1,n2,...``) -> vertex and edge DataFrames.

The graph is kept in edge form: one row per (src, dst).  A vertex's
neighbour list is never gathered into one row, so a vertex with a huge
out-degree is spread over many tasks like any other rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.sources.delimited import split_fields


@dataclass(frozen=True)
class Graph:
    """A directed graph in edge form.

    ``pairs``: one row per (head, neighbour) (``src: bigint, dst: bigint``);
    a head with no neighbour has one row with a null ``dst``.
    """

    pairs: DataFrame

    @property
    def vertices(self) -> DataFrame:
        """Ids that head a line (``id``; may repeat)."""
        return self.pairs.select(F.col("src").alias("id"))

    @property
    def edges(self) -> DataFrame:
        """Directed edges ``(src, dst)``, head -> neighbour."""
        return self.pairs.where(F.col("dst").isNotNull())


def adjacency_rows(lines: DataFrame, sep: str = ",", line_col: str = "value") -> DataFrame:
    """``(id, adj)`` per line, ``adj`` the listed neighbours in order.

    Ids are parsed like ``Long.parseLong``: a bad id fails the job, whatever
    the ANSI setting.  Trailing separators are ignored, so ``"1,"`` is
    vertex 1 with no neighbours.
    """
    fields = split_fields(F.col(line_col), sep, java_split=True)
    return lines.select(F.transform(fields, _parsed_id).alias("_v")).select(
        F.col("_v")[0].alias("id"),
        F.slice("_v", 2, F.size("_v") - 1).alias("adj"))


def _parsed_id(x):
    return F.coalesce(x.try_cast("bigint"), F.raise_error(F.concat(
        F.lit("cannot parse id '"), x, F.lit("' in an adjacency line"))).cast("bigint"))


def read_adjacency(lines: DataFrame, sep: str = ",", line_col: str = "value") -> Graph:
    """Parse adjacency lines straight into edge form, in one pass.

    Several lines may head the same vertex; their neighbours add up.  A
    line with no neighbour still makes its head a vertex.
    """
    # the same ids as ``adjacency_rows`` gives; a head once for each line, a neighbour once for each
    # row, both by compiled code, which a lambda over the fields is not
    fields = lines.select(split_fields(F.col(line_col), sep, java_split=True).alias("_f"))
    rows = fields.select(F.when(F.col("_f").isNotNull(), _parsed_id(F.col("_f")[0])).alias("src"),
                         F.explode_outer(F.slice("_f", 2, F.size("_f") - 1)).alias("_d"))
    return Graph(rows.select("src", F.when(F.col("_d").isNotNull(), _parsed_id(F.col("_d"))).alias("dst")))


def graph_from_edges(edges: DataFrame, src: str = "src", dst: str = "dst",
                     vertices: DataFrame | None = None) -> Graph:
    """Graph from an edge DataFrame; the heads default to the edge sources.

    ``vertices`` (first column = id) adds heads with no out-edge.
    """
    e = edges.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst"))
    if vertices is not None:
        v = vertices.select(F.col(vertices.columns[0]).cast("bigint").alias("src"),
                            F.lit(None).cast("bigint").alias("dst"))
        e = e.unionByName(v)
    return Graph(e)


def read_long_adjacency(spark: SparkSession, path: str | list[str], sep: str = ",") -> Graph:
    """Edge form of adjacency files whose lines may be of any length.

    No task holds a line: the files are read as records that end at ``sep``, so a line that is
    longer than a file split is read by as many tasks as it has splits.  Most records are one
    neighbour; a record with a line end also heads the next line.  (Lines without any separator that
    follow each other are one record: where very many do, end them with a separator.)

    * A first pass over the records keeps, for each file split, the last head in it: a row for each
      split, which the driver lists anyway to plan a scan, so that these rows can be broadcast.
    * A second pass walks each split in order and writes the head beside each neighbour.  Neighbours
      before a split's first line end take the last head of the splits before it.

    The same ids as ``read_adjacency`` gives: spaces around ids don't count, a bad id fails the job,
    as does a line that begins with a separator and goes on.  Unlike there, empty fields and blank
    lines are skipped, and every line has a row with a null ``dst``, not only lines without
    neighbours.  Were the second pass split elsewhere than the first, which a change of the
    cluster's size between the two can do, the job fails instead of taking a wrong head.
    """
    records = spark.read.option("lineSep", sep).text([path] if isinstance(path, str) else list(path)).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return Graph(_with_heads(records))


def _with_heads(records: DataFrame) -> DataFrame:
    """``(src, dst)`` from ``(value, file, block)`` records in the order of their files."""
    at = records.withColumn("at", F.monotonically_increasing_id())  # in a split, the order of the records
    ends = F.when(F.col("value").contains("\n"), F.col("at"))
    blocks = at.groupBy("file", "block").agg(F.max_by("value", ends).alias("end"), F.min_by("value", "at").alias("start"))
    # a record without a line end is a head only as a file's first
    last = F.coalesce(F.regexp_extract(F.regexp_replace("end", r"\n\s*$", "\n"), r"\n([^\n]*)$", 1),
                      F.when(F.col("block") == 0, F.trim("start")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select("file", "block", F.last(last, ignorenulls=True).over(before).alias("carried"))

    def walk(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split, head = None, None  # of the split at hand: its name, and the head as of now (None: not seen yet)
        for batch in batches:
            value, files, starts = batch.column("value"), batch.column("file").to_numpy(), batch.column("block").to_numpy()
            changed = np.ones(len(value), bool)
            changed[1:] = (files[1:] != files[:-1]) | (starts[1:] != starts[:-1])
            changed[0] = split != (files[0], starts[0])
            split = files[-1], starts[-1]
            special = np.flatnonzero(changed | pc.match_substring(value, "\n").to_numpy(zero_copy_only=False))
            heads_after, out = [head], []  # out: (row, src, dst)
            for row in special.tolist():
                pieces = value[row].as_py().split("\n")
                if changed[row]:
                    head = None
                    if starts[row] == 0:  # a file begins as if after a line end
                        pieces = ["", *pieces]
                if first := pieces[0].strip():
                    out.append((row, head, first))
                for piece in pieces[1:]:
                    head = piece.strip()
                    if head:
                        out.append((row, head, None))
                heads_after.append(head)
            text = pc.utf8_trim_whitespace(value)
            plain = np.ones(len(value), bool)
            plain[special] = False
            plain &= pc.not_equal(text, "").to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(plain)
            under = pa.array(heads_after, pa.string()).take(pa.array(np.searchsorted(special, rows)))
            src = pa.concat_arrays([under, pa.array([s for _, s, _ in out], pa.string())])
            dst = pa.concat_arrays([text.take(pa.array(rows)).cast(pa.string()), pa.array([d for *_, d in out], pa.string())])
            place = np.concatenate([rows, np.array([r for r, *_ in out], np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(files[place]), pa.array(starts[place]), src, dst],
                                             ["file", "block", "src", "dst"])

    pairs = records.mapInArrow(walk, "file long, block long, src string, dst string")
    met = pairs.join(F.broadcast(heads.withColumn("known", F.lit(True))), ["file", "block"], "left")

    src = F.coalesce("src", F.when(F.col("known"), F.coalesce("carried", F.lit(""))).otherwise(
        F.raise_error(F.lit("the files were split anew between two passes; run the job again"))))
    return met.select(_parsed_id(src).alias("src"), F.when(F.col("dst").isNotNull(), _parsed_id(F.col("dst"))).alias("dst"))
