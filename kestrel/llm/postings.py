"""Approximate nearest neighbours by inner product over balanced posting lists.

Inner products become distances: vectors are scaled and get one more component that puts all of
them on one sphere, where the nearest by distance is the largest by inner product.

* **Fit**, on the driver, from about ``SAMPLE`` distinct vectors picked by hash: the sample is halved
  at medians until a half stands for ``LIST`` vectors of the table (or holds ``MIN_LEAF`` sampled
  ones), so lists are balanced; their means are the centroids, at most ``SAMPLE / MIN_LEAF``.  A
  graph joins each centroid to its nearest ones and to its neighbours in the tree's order; a beam
  search over it finds the centroids next to a vector.
* **Index**: every vector goes to its nearest list, and a vector near a boundary to up to ``COPIES``
  lists: those nearly as near, unless a list it already has lies closer to them than it does.
* **Search**: a query reads the lists whose centroid is at most ``ratio`` times as far as the nearest
  one, and more where those hold fewer than ``k`` others.  The ratio is fitted: a quarter of the
  sample stays out of the halving, and the ratio is that at which ``TARGET`` of its true neighbours
  lie in lists that are read.

Equal vectors are one entry with the ``k + 1`` smallest ids: no more of them can be among ``k``
nearest, and what they give up is cut before the shuffle.  Lists travel in groups of ``GROUP``
neighbouring ones.  A group of many vectors or many queries is a grid of parts, each part of vectors
against each part of queries, so that no task holds more than a part of either.  Scores are sums in
the order of the components, in double precision, on the original vectors.

Defined results: a vector that is null, empty, zero, or that holds a null or a non-finite component
takes no part, nor does a row without an id.  A vector with fewer components than another counts as
zero in those it lacks.  Repeated rows are one; rows that share an id are told from each other as
queries by their vectors, and as candidates are one, with the larger score.  Ties go to the smaller
id.  With ``k`` candidates or fewer, all are found.  An empty input gives no rows.  Other columns of
the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.textnum import map_batches
from kestrel.plans.materialize import RunTables, write_and_reload

#: Distinct vectors that the index is fitted on (about so many, by hash).
SAMPLE = 32_768
#: Vectors of a list, as long as the sample can tell that many lists apart.
LIST = 512
MIN_LEAF = 8
#: Lists of a boundary vector at most, and how much farther than the nearest one they may be.
COPIES = 4
BOUNDARY = 1.1
#: Share of true neighbours that the lists read should hold.
TARGET = 0.98
#: Sampled queries that the ratio is fitted on at most.
CALIBRATION = 512
#: Graph neighbours of a centroid.
DEGREE = 24
#: Neighbouring lists that travel together, and the vectors and queries of a part of such a group.
GROUP = 16
PART_VECTORS = 8192
PART_QUERIES = 4096
#: Vectors handled at a time in the graph search, queries in scoring.
STEP = 256


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """(rows, dims) doubles of a list array; components a vector lacks are 0."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(rows of x, rows of y) Euclidean distances."""
    return np.sqrt(np.maximum(squares(x)[:, None] + squares(y)[None] - 2 * (x @ y.T), 0))


def halves(x: np.ndarray, limit: float) -> list[np.ndarray]:
    """Row numbers of ``x`` in leaves of at most ``limit`` rows, in the tree's order.

    A node is cut at the median of its rows' places between two centres.
    """
    done, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= max(limit, 1):
            done.append(rows)
            continue
        of = x[rows]
        far = of[squares(of - of[0]).argmax()]
        centres = np.stack([far, of[squares(of - far).argmax()]])
        for _ in range(4):
            near = distances(of, centres).argmin(1)
            centres = np.stack([of[near == c].mean(0) if (near == c).any() else centres[c] for c in (0, 1)])
        order = np.argsort(of @ (centres[1] - centres[0]), kind="stable")
        todo += [rows[order[len(rows) // 2:]], rows[order[:len(rows) // 2]]]
    return done


@dataclass
class Index:
    """Centroids on the sphere, their graph, and how far a query reads.

    ``unit``: what components are divided by; ``radius``: of the sphere, in those units.
    """

    centroids: np.ndarray
    graph: np.ndarray
    dims: int
    unit: float
    radius: float
    ratio: float = 1.0
    beam: int = 2 * COPIES
    #: vectors whose nearest list it is, by list
    sizes: np.ndarray | None = None

    def points(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors on the sphere."""
        x = vectors / self.unit
        return np.column_stack([x, np.sqrt(np.maximum(self.radius**2 - squares(x), 0))])

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        """Queries on the sphere: their lengths don't change the order of inner products."""
        x = vectors / np.abs(vectors).max(1, keepdims=True)
        return np.column_stack([x * (self.radius / np.sqrt(squares(x)))[:, None], np.zeros(len(x))])

    def near(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, beam) nearest centroids by the graph, nearest first, and their distances.

        All rows walk at once: each step opens the nearest four of a row's beam that aren't open,
        and merges their neighbours into it, until all of the beam is open.
        """
        lists = len(self.centroids)
        beam = min(max(beam, COPIES), lists)
        rows = np.arange(len(points))[:, None]
        whole = points.astype(np.float32)
        centroids = self.centroids.astype(np.float32)

        def far(ids):
            return np.square(centroids[ids] - whole[:, None]).sum(2)

        starts = np.unique(np.linspace(0, lists - 1, min(lists, max(beam, 32))).astype(int))
        ids = np.broadcast_to(starts, (len(points), len(starts)))
        seen = np.zeros((len(points), lists), bool)
        seen[:, starts] = True
        away, opened = far(ids), np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(away, 1, kind="stable")[:, :beam]
            ids, away, opened = (np.take_along_axis(x, order, 1) for x in (ids, away, opened))
            closed = ~opened & np.isfinite(away)
            if not closed.any():
                exact = np.sqrt(np.square(self.centroids[ids] - points[:, None]).sum(2))
                return ids, np.where(np.isfinite(away), exact, np.inf)
            chosen = closed & (np.cumsum(closed, 1) <= 4)
            opened |= chosen
            pick = np.argsort(~chosen, 1, kind="stable")[:, :4]
            more = self.graph[np.take_along_axis(ids, pick, 1)].reshape(len(points), -1)
            valid = np.repeat(np.take_along_axis(chosen, pick, 1), self.graph.shape[1], 1)
            more = np.sort(np.where(valid & ~seen[rows, more], more, -1), 1)
            fresh = more >= 0
            fresh[:, 1:] &= more[:, 1:] != more[:, :-1]
            seen[np.broadcast_to(rows, more.shape)[fresh], more[fresh]] = True
            used = max(int(fresh.sum(1).max()), 1)
            keep = np.argsort(~fresh, 1, kind="stable")[:, :used]
            more, fresh = np.take_along_axis(more, keep, 1), np.take_along_axis(fresh, keep, 1)
            ids = np.concatenate([ids, np.where(fresh, more, 0)], 1)
            away = np.concatenate([away, np.where(fresh, far(np.where(fresh, more, 0)), np.inf)], 1)
            opened = np.concatenate([opened, ~fresh], 1)

    def lists(self, points: np.ndarray) -> np.ndarray:
        """(rows, COPIES) lists of each point, -1 where it has fewer: the nearest, and those nearly
        as near that no list taken before lies closer to than the point."""
        ids, away = self.near(points, 2 * COPIES)
        out = np.full((len(points), COPIES), -1)
        out[:, 0], taken = ids[:, 0], np.ones(len(points), int)
        for c in range(1, ids.shape[1]):
            between = np.sqrt(np.square(self.centroids[out] - self.centroids[ids[:, c]][:, None]).sum(2))
            hidden = ((out >= 0) & (between < away[:, c, None])).any(1)
            take = np.flatnonzero((away[:, c] <= BOUNDARY * away[:, 0]) & ~hidden & (taken < COPIES))
            out[take, taken[take]] = ids[take, c]
            taken[take] += 1
        return out

    def reads(self, points: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) pairs: the lists each query reads, with ``least`` vectors if there are so many."""
        out, todo, beam = [], np.arange(len(points)), self.beam
        while len(todo):
            ids, away = self.near(points[todo], beam)
            before = np.cumsum(self.sizes[ids], 1) - self.sizes[ids]
            read = (away <= self.ratio * away.min(1, keepdims=True)) | (before < least)
            # a beam that ends before its query has enough is walked again, wider
            short = (before[:, -1] + self.sizes[ids[:, -1]] < least) & (beam < len(self.centroids))
            query, place = np.nonzero(read & np.isfinite(away) & ~short[:, None])
            out.append((todo[query], ids[query, place]))
            todo, beam = todo[short], 4 * beam
        return tuple(np.concatenate(c) for c in zip(*out))


def fit(sample: np.ndarray, rows: int, unit: float, radius: float, k: int) -> Index:
    """Index for a table of ``rows`` distinct vectors, from (sampled rows, dims) of them."""
    index = Index(np.zeros((1, sample.shape[1] + 1)), np.zeros((1, 1), np.int64), sample.shape[1], unit, radius)
    points = index.points(sample)
    out = np.arange(len(points)) % 4 == 3
    fitted, held = points[~out], points[out]
    leaves = halves(fitted, max(MIN_LEAF, len(fitted) * LIST / max(rows, 1)))
    index.centroids = centroids = np.stack([fitted[leaf].mean(0) for leaf in leaves])
    n, near = len(centroids), []
    for at in range(0, n, STEP):
        away = distances(centroids[at:at + STEP], centroids)
        near.append(np.argsort(away, 1, kind="stable")[:, 1:DEGREE + 1])
    order = np.arange(n)
    index.graph = np.column_stack([(order + 1) % n, (order - 1) % n, np.concatenate(near)])
    if not len(held) or n == 1:
        return index
    # the k nearest of the table are the nearest few of the sample's quarter
    asked = index.asked(sample[out][:CALIBRATION])
    few = min(max(1, -(-k * len(held) // rows)), len(held) - 1)
    score = asked @ held.T
    score[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest = np.argpartition(-score, few - 1, 1)[:, :few] if few else np.zeros((len(asked), 0), int)
    lists, away = index.lists(held), distances(asked, centroids)
    least = np.maximum(away.min(1), np.finfo(float).tiny)
    there = lists[nearest]  # (queries, few, COPIES)
    needed = np.where(there >= 0, away[np.arange(len(asked))[:, None, None], there], np.inf).min(2) / least[:, None]
    if needed.size:
        index.ratio = float(np.quantile(needed, TARGET))
    read = int((away <= index.ratio * least[:, None]).sum(1).max())
    index.beam = min(n, max(2 * COPIES, read + read // 4))
    return index


def usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (df.filter(F.col(id).isNotNull() & finite).filter(F.exists(vector, lambda x: x != 0))
            .select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector")))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """``(vector, ids)``: each distinct vector with its ``k + 1`` smallest ids."""
    window = Window.partitionBy("vector").orderBy("id")
    few = rows.dropDuplicates(["id", "vector"]).withColumn("n", F.row_number().over(window)).filter(F.col("n") <= k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def placed(vectors: DataFrame, index: Index) -> DataFrame:
    """``(list, nearest, vector, ids)``: every entry in its lists, and which of them is the nearest."""
    kind = vectors.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                rows = batch.slice(at, STEP)
                lists = index.lists(index.points(matrix(rows.column("vector"), index.dims)))
                row, place = np.nonzero(lists >= 0)
                taken = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([
                    pa.array(lists[row, place], pa.int32()), pa.array(place == 0), taken.column("vector"),
                    taken.column("ids")], ["list", "nearest", "vector", "ids"])

    return map_batches(vectors.select("vector", "ids"), run, f"list int, nearest boolean, vector {kind}, ids array<long>")


def asks(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """``(group, query, id, vector, lists)``: each query once for each group of lists that it reads."""
    kind = queries.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                rows = batch.slice(at, STEP)
                query, lists = index.reads(index.asked(matrix(rows.column("vector"), index.dims)), k + 1)
                order = np.lexsort((lists, query))
                query, lists = query[order], lists[order]
                first = np.flatnonzero(np.diff(query * len(index.centroids) + lists // GROUP * GROUP, prepend=-1))
                taken = rows.take(pa.array(query[first]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(lists[first] // GROUP, pa.int32()), *(taken.column(c) for c in ("query", "id", "vector")),
                    pa.ListArray.from_arrays(pa.array([*first, len(lists)], pa.int32()), pa.array(lists, pa.int32()))],
                    ["group", "query", "id", "vector", "lists"])

    return map_batches(queries.select("query", "id", "vector"), run,
                       f"group int, query long, id long, vector {kind}, lists array<int>")


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` nearest, an id once: larger scores first, then smaller ids."""
    order = np.lexsort((ids, -score, query))
    pairs = np.stack([query[order], ids[order]], 1)
    _, first = np.unique(pairs, axis=0, return_index=True)
    order = order[np.sort(first)]
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    return order[place < k]


def scored(vectors: pa.Table, queries: pa.Table, dims: int, k: int) -> tuple[np.ndarray, ...]:
    """(query, id, score) of each query's ``k`` nearest among the lists it reads here."""
    x, asked = (matrix(t.column("vector").combine_chunks(), dims) for t in (vectors, queries))
    ids, held = vectors.column("ids").combine_chunks(), vectors.column("list").to_numpy()
    starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    own, key = queries.column("id").to_numpy(), queries.column("query").to_numpy()
    reads = queries.column("lists").combine_chunks()
    reader = np.repeat(np.arange(len(own)), reads.value_lengths().to_numpy())
    read = reads.flatten().to_numpy()
    slack = 1e-12 * np.sqrt(squares(asked) * squares(x).max())
    out = [np.zeros((3, 0))]
    for at in range(0, len(asked), STEP):
        pairs = []
        for name in np.unique(held):
            members = np.flatnonzero(held == name)
            who = np.unique(reader[(read == name) & (reader >= at) & (reader < at + STEP)])
            score = asked[who] @ x[members].T
            enough = min(k + 1, len(members))  # one may be the query's own
            least = np.partition(score, len(members) - enough, 1)[:, len(members) - enough]
            a, b = np.nonzero(score >= (least - slack[who])[:, None])
            pairs.append((who[a], members[b]))
        q, row = (np.concatenate(c) if pairs else np.zeros(0, int) for c in (zip(*pairs) if pairs else ((), ())))
        exact = np.zeros(len(q))
        for d in range(dims):
            exact += asked[q, d] * x[row, d]
        sizes = starts[row + 1] - starts[row]
        entry = np.repeat(np.arange(len(row)), sizes)
        id_ = flat[starts[row][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        q, exact = q[entry], exact[entry]
        other = id_ != own[q]
        q, id_, exact = q[other], id_[other], exact[other]
        keep = best(q, id_, exact, k)
        out.append((key[q[keep]], id_[keep], exact[keep]))
    return tuple(np.concatenate(c) for c in zip(*out))


def search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` nearest found for each of ``queries``.

    ``rows`` and ``queries``: as from ``usable``.  The result is read back from a written table.
    """
    spark = rows.sparkSession
    with RunTables(spark, "postings") as tables:
        vectors = tables.write(entries(rows, k), "entries")
        length = F.size("vector")
        facts = vectors.agg(F.count("*").alias("rows"), F.max(length).alias("dims"), F.max(F.array_max(F.transform(
            "vector", lambda x: F.abs(x.cast("double"))))).alias("unit")).first()
        result = "query_id long, rank int, vec_id long, score double"
        if not facts["rows"]:
            return spark.createDataFrame([], result)
        dims, unit = facts["dims"], facts["unit"]
        sums = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / unit) * (x / unit))
        radius = float(np.sqrt(vectors.agg(F.max(sums)).first()[0]))
        share = min(1.0, SAMPLE / facts["rows"])
        sampled = vectors.filter(F.xxhash64("vector").bitwiseAND((1 << 62) - 1) < F.lit(int(share * (1 << 62))))
        drawn = sampled.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").toArrow()  # about SAMPLE rows
        index = fit(matrix(drawn.column("vector").combine_chunks(), dims), facts["rows"], unit, radius, k)

        lists = tables.write(placed(vectors, index), "lists")
        index.sizes = np.zeros(len(index.centroids), np.int64)
        for r in lists.filter("nearest").groupBy("list").count().collect():  # a row for each list
            index.sizes[r["list"]] = r["count"]
        numbered = tables.write(queries.dropDuplicates(["id", "vector"]).withColumn(
            "query", F.monotonically_increasing_id()), "queries")
        asked = tables.write(asks(numbered, index, k), "asks")
        group = F.floor(F.col("list") / GROUP).cast("int")
        # a row for each group of lists: at most SAMPLE / MIN_LEAF / GROUP
        sizes = (lists.groupBy(group.alias("group")).agg(F.ceil(F.count("*") / PART_VECTORS).alias("parts"))
                 .join(asked.groupBy("group").agg(F.ceil(F.count("*") / PART_QUERIES).alias("q_parts")), "group"))
        sizes = F.broadcast(tables.write(sizes, "sizes"))

        def dealt(df: DataFrame, by: str, mine: str, others: str):
            """Rows of ``df`` by the parts of their group: in one of their own side, in all of the other."""
            cells = df.join(sizes, "group").withColumn(mine, F.pmod(F.xxhash64(by), F.col(f"{mine}s")).cast("int"))
            return cells.withColumn(others, F.explode(F.sequence(F.lit(0), (F.col(f"{others}s") - 1).cast("int")))).drop(
                "parts", "q_parts").groupBy("group", "part", "q_part")

        a = dealt(lists.withColumn("group", group), "vector", "part", "q_part")
        b = dealt(asked, "query", "q_part", "part")

        def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
            found = scored(vectors, queries, dims, k) if len(vectors) and len(queries) else [[]] * 3
            return pa.table([pa.array(c, kind) for c, kind in zip(found, (pa.int64(), pa.int64(), pa.float64()))],
                            ["query", "vec_id", "score"])

        found = a.cogroup(b).applyInArrow(run, "query long, vec_id long, score double")
        # one exchange serves the aggregation by (query, vec_id) and the ranking by query
        once = found.repartition("query").groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
        ranked = once.withColumn("rank", rank).filter(F.col("rank") <= k)
        named = ranked.join(numbered.select("query", F.col("id").alias("query_id")), "query")
        return write_and_reload(named.select("query_id", "rank", "vec_id", "score"), "neighbours")


def neighbours(df: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20) -> DataFrame:
    """The ``k`` nearest of each row whose id is divisible by ``every``, among all other rows."""
    rows = usable(df, id, vector)
    return search(rows, rows.filter(F.col("id") % every == 0), k)
