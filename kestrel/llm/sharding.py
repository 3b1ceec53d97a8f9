"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in source partitions.  How many rows of partition i belong to shard j is drawn exactly
as in a uniform random permutation: the matrix of counts has the partitions' sizes as row sums and
the shards' sizes as column sums (multivariate hypergeometric).  Each partition is permuted
locally and cut by its row of the matrix, rows are exchanged, and each shard is permuted again.
With ideal random numbers every permutation of the rows over the shard slots is equally likely.

The numbers of the two permutations are 64-bit hashes of the seed, the permutation's name, the source
partition and the row's place in it.  (Two calls of ``rand`` would not do: Spark adds the partition's
number to the seed, so one partition's second numbers are another's first ones.)

Only DataFrame functions run on the rows.  The driver draws the matrix, at most
``MAX_GROUPS`` x shards numbers whatever the input's size (source partitions are joined into that
many groups).  Random numbers are written once, with the source partition, to the checkpoint
folder, so that a task that runs again sees the same ones.  A shard is permuted in blocks of its
random keys, about ``BLOCK_ROWS`` rows each, so no task holds a whole shard.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.plans.materialize import RunTables, write_and_reload

MAX_GROUPS = 4096
BLOCK_ROWS = 100_000
MIN_BLOCKS = 64


def _deviance(x: float, mean: float) -> float:
    """``x log(x / mean) + mean - x``, without the cancellation where x is near the mean."""
    if x == 0:
        return mean
    if abs(x - mean) < 0.1 * (x + mean):
        v = (x - mean) / (x + mean)
        total, term, k = (x - mean) * v, 2 * x * v, 1
        while True:
            term *= v * v
            more = total + term / (2 * k + 1)
            if more == total:
                return total
            total, k = more, k + 1
    return x * math.log(x / mean) + mean - x


def _stirling(n: int) -> float:
    """What Stirling's formula leaves out of log n!."""
    if n <= 15:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi)
    x = 1 / (n * n)
    return (1 / 12 - x * (1 / 360 - x * (1 / 1260 - x * (1 / 1680 - x / 1188)))) / n


def _binomial(k: int, n: int, p: float, q: float) -> float:
    """Log of the probability of ``k`` successes among ``n``, at full precision for any ``n``."""
    if k in (0, n):
        return n * (math.log1p(-p) if p < 0.5 else math.log(q)) if k == 0 else n * (math.log1p(-q) if q < 0.5 else math.log(p))
    rest = _stirling(n) - _stirling(k) - _stirling(n - k) - _deviance(k, n * p) - _deviance(n - k, n * q)
    return rest + 0.5 * (math.log(n) - math.log(2 * math.pi) - math.log(k) - math.log(n - k))


def probability(k: int, good: int, bad: int, draws: int) -> float:
    """Of ``k`` good ones among ``draws`` from ``good + bad``: a quotient of binomial probabilities
    near their modes, as differences of log-factorials lose their digits for large numbers."""
    if draws in (0, good + bad):
        return 1.0
    p, q = draws / (good + bad), (good + bad - draws) / (good + bad)
    log = lambda k, n: _binomial(k, n, p, q) if n else 0.0
    return math.exp(log(k, good) + log(draws - k, bad) - log(draws, good + bad))


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` taken without return from ``good + bad``.

    Inversion that starts at the mode and goes outwards by ratios of neighbouring probabilities:
    expected steps are of the order of the standard deviation.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    peak = probability(mode, good, bad, draws)
    left = rng.random() - peak
    down, up, at_down, at_up = mode, mode, peak, peak
    while left > 0 and (down > low or up < high):
        if up < high:
            at_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= at_up
            if left <= 0:
                return up
        if down > low:
            at_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= at_down
            if left <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Counts from each partition to each shard; ``sum(rows) == sum(shards)``."""
    rng, room, matrix = random.Random(seed), list(shards), []
    for n in rows:
        counts, rest = [], sum(room)
        for j, m in enumerate(room):
            rest -= m
            k = hypergeometric(rng, m, rest, n)
            counts.append(k)
            n -= k
        room = [m - k for m, k in zip(room, counts)]
        matrix.append(counts)
    return matrix


def uniform(seed: int, name: str) -> Column:
    """A number from 0 to 1 for each row, of a stream of its own for each seed and name."""
    bits = F.xxhash64(F.lit(f"{seed}:{name}"), F.monotonically_increasing_id())
    return F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))


def exact_shuffle(df: DataFrame, n_shards: int, seed: int = 7) -> DataFrame:
    """``df`` with ``shard`` (0 .. n_shards - 1) and ``slot`` (0 .. size - 1 inside the shard).

    Shard sizes differ by one row at most; the first shards are the larger ones.  Nulls, ties and
    repeated rows are rows like any others; an empty input gives no rows.  Columns of ``df`` that
    are named ``shard`` or ``slot`` are replaced.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    row = F.struct(*keep) if keep else F.struct(F.lit(0).alias("none"))
    with RunTables(spark, "shuffle") as tables:
        held = tables.write(df.select(
            row.alias("row"), F.spark_partition_id().alias("source"),
            uniform(seed, "first").alias("first"), uniform(seed, "second").alias("second")), "rows")
        sources = held.agg((F.max("source") + 1).alias("n")).first()["n"] or 1
        groups = min(sources, MAX_GROUPS)
        grouped = held.withColumn("part", F.floor(F.col("source") * F.lit(groups) / F.lit(sources)).cast("int"))
        sizes = {r["part"]: r["count"] for r in grouped.groupBy("part").count().collect()}
        rows = [sizes.get(i, 0) for i in range(groups)]
        total = sum(rows)
        shards = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
        ends = []
        for counts in communication_matrix(rows, shards, seed):
            ends.append([sum(counts[:j + 1]) for j in range(n_shards)])
        table = spark.range(1).select(F.posexplode(
            F.from_json(F.lit(json.dumps(ends)), "array<array<bigint>>")).alias("part", "ends"))

        local = Window.partitionBy("part").orderBy("first", "second")
        sent = (grouped.withColumn("rank", F.row_number().over(local) - 1)
                .join(F.broadcast(table), "part")  # MAX_GROUPS rows at most
                .select("row", "second", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")))
        blocks = max(MIN_BLOCKS, math.ceil(total / n_shards / BLOCK_ROWS))
        sent = write_and_reload(sent.withColumn("block", F.floor(F.col("second") * blocks).cast("int")), "shuffle-sent")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = (sent.groupBy("shard", "block").count()
             .select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("shard", "block").orderBy("second", F.xxhash64("row"))
    return (sent.withColumn("rank", F.row_number().over(inside) - 1).join(start, ["shard", "block"])
            .select(*(F.col("row")[c].alias(c) for c in keep), "shard",
                    (F.col("start") + F.col("rank")).cast("long").alias("slot")))


def shard_documents(documents: DataFrame, n_shards: int = 16, seed: int = 7) -> DataFrame:
    """Documents in shards of equal row counts, without their texts.

    ``size``: UTF-8 bytes of the text (null: none) plus 1; ``text_crc32``: of the text (null: as
    if empty).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return exact_shuffle(narrow, n_shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
