"""Centroid clustering of whole-number vectors by scalar lookup tables.

Vectors become whole numbers once and are packed into blocks, written to the checkpoint folder: for
each dimension the values that occur in the block, and for each vector the place of its value among
them.  A round tabulates, for each dimension, the squared difference of every occurring value and
every centroid; a vector's distances are table gathers and sums in NumPy, all in 64-bit integers.
Each task sums its vectors by cluster before anything is shuffled, so a round moves a row for each
task and cluster, and the driver gets clusters x dimensions numbers whatever the input's size.
A round reads the written blocks alone: a lost executor costs its tasks of that round.

Defined results: vectors that are null, of another length, or that hold a null or a non-finite
component aren't kept.  Ties go to the smaller cluster number.  Repeated rows are rows of their own;
among rows that share an id (or have none, which counts as an empty one) the smaller vector is the
earlier seed.  With fewer vectors than clusters there are as many clusters as vectors; an empty
input gives no rows.  A whole number so large that a squared distance could pass 64 bits fails the
job and is named.  Other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textnum import map_batches
from kestrel.plans.materialize import RunTables, write_and_reload

#: Vectors of a block: places in it are 16-bit numbers.
BLOCK = 2048


def whole_vectors(df: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``(id, ints array<bigint>)`` of the kept rows: ``floor(scale * component)``."""
    limit = isqrt((1 << 63) // dims) // 2
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = df.filter((F.size(vector) == dims) & finite)

    def whole(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < limit, F.floor(y)).otherwise(
            F.raise_error(F.concat(F.lit("component too large: "), x.cast("string"))).cast("bigint"))

    return kept.select(F.col(id).alias("id"), F.transform(vector, whole).alias("ints"))


def seeds(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``seed:id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [r["ints"] for r in vectors.select(name.alias("name"), "ints").orderBy("name", "ints").limit(k).collect()]


@dataclass
class Block:
    """``values``: occurring values of all dimensions in a row; dimension d has ``values[starts[d]:
    starts[d + 1]]``.  ``codes``: (dims, rows) places among those."""

    values: np.ndarray
    starts: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, ints: np.ndarray) -> Block:
        """Block of a (rows, dims) matrix."""
        found = [np.unique(column, return_inverse=True) for column in ints.T]
        starts = np.concatenate([[0], np.cumsum([len(v) for v, _ in found])])
        return cls(np.concatenate([v for v, _ in found]), starts, np.stack([c for _, c in found]).astype("<u2"))

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """(rows, clusters) squared distances to the (clusters, dims) centroids."""
        out = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        for d, codes in enumerate(self.codes):
            table = np.square(self.values[self.starts[d]:self.starts[d + 1], None] - centroids[None, :, d])
            out += table[codes]
        return out

    def sums(self, nearest: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each cluster, and the sums of their components."""
        ints = np.stack([self.values[a:b][codes] for a, b, codes in zip(self.starts, self.starts[1:], self.codes)])
        return np.bincount(nearest, minlength=clusters), np.stack([ints[:, nearest == c].sum(1) for c in range(clusters)])


def pack(vectors: DataFrame, dims: int) -> DataFrame:
    """Rows ``(ids, values, starts, codes)``, ``BLOCK`` vectors each at most."""
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                ints = rows.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, dims)
                block = Block.of(ints)
                ids = rows.column("id")
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([block.values], pa.list_(pa.int64())), pa.array([block.starts], pa.list_(pa.int32())),
                    pa.array([block.codes.tobytes()], pa.binary())], ["ids", "values", "starts", "codes"])

    return map_batches(vectors, run, f"ids array<{kind}>, values array<long>, starts array<int>, codes binary")


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, Block]]:
    for batch in batches:
        for k in range(batch.num_rows):
            values, starts = (batch.column(c)[k].values.to_numpy() for c in ("values", "starts"))
            codes = np.frombuffer(batch.column("codes")[k].as_buffer(), "<u2").reshape(dims, -1)
            yield batch.column("ids")[k].values, Block(values, starts, codes)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one more round: floors of the means of their vectors, exactly."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, block in _blocks(batches, dims):
            more, summed = block.sums(block.distances(centroids).argmin(1), k)
            rows += more
            sums += summed
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([
            pa.array(full, pa.int32()), pa.array(rows[full], pa.int64()),
            pa.array(list(sums[full]), pa.list_(pa.int64()))], ["cluster", "rows", "sums"])

    parts = map_batches(blocks, run, "cluster int, rows long, sums array<long>")
    told = (parts.select("cluster", "rows", F.posexplode("sums").alias("dim", "sum"))
            .groupBy("cluster", "dim").agg(F.sum("sum").alias("sum"), F.sum("rows").alias("rows")).collect())
    out = centroids.copy()
    for r in told:  # clusters x dimensions numbers
        out[r["cluster"], r["dim"]] = r["sum"] // r["rows"]
    return out


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""
    kind, dims = blocks.schema["ids"].dataType.elementType.simpleString(), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _blocks(batches, dims):
            distances = block.distances(centroids)
            nearest = distances.argmin(1)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(nearest, pa.int32()), pa.array(distances[np.arange(len(nearest)), nearest])],
                ["id", "cluster", "distance"])

    return map_batches(blocks, run, f"id {kind}, cluster int, distance long")


def cluster(df: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10,
            dims: int = 64, scale: int = 1024, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` of every kept vector, and the (clusters, dims) centroids.

    The rows are read back from a written table.
    """
    vectors = whole_vectors(df, id, vector, dims, scale)
    centroids = np.array(seeds(vectors, k, seed), np.int64).reshape(-1, dims)
    if not len(centroids):
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    with RunTables(df.sparkSession, "clusters") as tables:
        blocks = tables.write(pack(vectors, dims), "blocks")
        for _ in range(rounds):
            centroids = moved(blocks, centroids)
        return write_and_reload(assigned(blocks, centroids), "clusters"), centroids


def clusters_of(embeddings: DataFrame) -> DataFrame:
    """Per vector its cluster and squared distance, the sums of those, and a digest of the centroid."""
    rows, centroids = cluster(embeddings)
    inertia = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
             for c, x in enumerate(centroids.tolist())]  # a row for each cluster
    told = embeddings.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(told), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """``clusters_of`` in DuckDB, its rounds unrolled over (vector, dimension, value) rows."""
    parts = [f"""
v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""", f"""
l AS MATERIALIZED (SELECT vec_id, unnest(range({dims})) AS d, unnest(x) AS x FROM v)""", f"""
c0 AS MATERIALIZED (
  SELECT CAST(s.k AS INTEGER) AS k, l.d, l.x FROM l JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), x) - 1 AS k FROM v
    QUALIFY k < {k}) s USING (vec_id))"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(k, (far, k)) AS k, min(far) AS far FROM (
    SELECT l.vec_id, c.k, sum((l.x - c.x) * (l.x - c.x)) AS far FROM l JOIN c{r} c USING (d) GROUP BY l.vec_id, c.k)
  GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.k, c.d, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT k, d, CAST((s - (s % n + n) % n) // n AS BIGINT) AS x FROM (
      SELECT a.k, l.d, sum(l.x) AS s, count(*) AS n FROM a{r} a JOIN l USING (vec_id) GROUP BY a.k, l.d)) m
  USING (k, d))""")
    return f"""WITH {','.join(parts)}
SELECT a.vec_id, a.k AS cluster, CAST(a.far AS BIGINT) AS distance,
       CAST(sum(a.far) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.far) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
                       FROM c{rounds} GROUP BY k) h USING (k)
"""


CLUSTERS_SQL = _sql()
