"""Means kept as partial states: what was read once is never read again.

A state is ``(key, sum, n)``: sums are added up and counts are too, so states of any split of the
rows merge into those of the whole.  Each batch of new rows leaves its states as a committed folder
of its own under one path; reading merges them.  A batch that did not end isn't seen, one that is
there is refused, so that no row counts twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.fence import evaluate_once
from kestrel.functions.scalar import round_half_up
from kestrel.plans.committed import MANIFEST, read_committed, write_committed

#: Decimal sums of states have this type, so that those of all batches fit together.
SUM_TYPE = "decimal(38,6)"


def mean_states(df: DataFrame, key: Column | str, value: Column | str, *, round_key: bool = True) -> DataFrame:
    """``(key int, sum, n)`` of the rows: one row per key, combined map-side.

    ``round_key``: the key rounded half toward +infinity, as in ``bucket_mean``.  ``sum`` and ``n``
    are of the values that aren't null; a decimal value is summed exactly.  Rows without a key go.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    rows = evaluate_once(df.select((round_half_up(col(key)) if round_key else col(key)).alias("key"), col(value).alias("v")))
    exact = rows.schema["v"].dataType.typeName() == "decimal"
    total = F.sum("v").cast(SUM_TYPE) if exact else F.sum(F.col("v").cast("double"))
    return rows.where(F.col("key").isNotNull()).groupBy("key").agg(total.alias("sum"), F.count("v").alias("n"))


def merged(states: DataFrame) -> DataFrame:
    """One state per key, from any number of them."""
    kind = states.schema["sum"].dataType.simpleString()
    return states.groupBy("key").agg(F.sum("sum").cast(kind).alias("sum"), F.sum("n").alias("n"))


def means_of(states: DataFrame, min_key: int | None = None, max_key: int | None = None,
             key_name: str = "distance", mean_name: str = "mean") -> DataFrame:
    """``(key, mean)`` of merged states, by key; keys from ``min_key`` and below ``max_key``."""
    kept = states
    if min_key is not None:
        kept = kept.where(F.col("key") >= min_key)
    if max_key is not None:
        kept = kept.where(F.col("key") < max_key)
    mean = F.try_divide(F.col("sum").cast("double"), F.col("n").cast("double"))
    return merged(kept).select(F.col("key").alias(key_name), mean.alias(mean_name)).orderBy(key_name)


class StateFolder:
    """Batches of states under ``path``, one committed folder each.

    A batch may be a merge of earlier ones: those it names no longer count.  The files a batch was made
    from, if told, are a committed folder beside it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, batch: str, states: DataFrame, sources: DataFrame | None = None) -> None:
        """Commit the states of a new batch; ``sources(file)``: the files it was made from."""
        self._check(batch)
        if sources is not None:  # first: a batch that is there has told all of them
            write_committed(sources.select("file"), f"{self.path}/sources/{batch}")
        write_committed(states.select("key", "sum", "n"), f"{self.path}/states/{batch}")

    def _check(self, batch: str) -> None:
        if not batch or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"{batch!r} is no name of a batch")

    def _committed(self, kind: str) -> set[str]:
        """Names of the committed folders of a kind."""
        try:
            found = self.spark.read.format("binaryFile").load(f"{self.path}/{kind}/*/{MANIFEST}/*.parquet")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return set()
        return {r[0] for r in found.select(F.element_at(F.split("path", "/"), -3)).distinct().collect()}

    def batches(self) -> list[str]:
        """Names of the committed batches that count."""
        names = self._committed("states")
        merges = [n for n in names if n.startswith("merge-")]
        gone = {r["file"] for m in merges for r in read_committed(self.spark, f"{self.path}/sources/{m}").collect()
                if r["file"].startswith("batch:")}
        return sorted(n for n in names if f"batch:{n}" not in gone)

    def states(self) -> DataFrame:
        """States of all batches that count (several rows per key)."""
        out = None
        for batch in self.batches():
            one = read_committed(self.spark, f"{self.path}/states/{batch}")
            out = one if out is None else out.unionByName(one)
        if out is None:
            raise ValueError(f"{self.path} holds no batch")
        return out

    def new_files(self, path: str | list[str]) -> DataFrame:
        """``(file)`` at ``path`` that no batch was made from yet."""
        there = self.spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))
        for batch in self._with_sources():
            there = there.join(read_committed(self.spark, f"{self.path}/sources/{batch}"), "file", "left_anti")
        return there

    def _with_sources(self) -> list[str]:
        told = self._committed("sources")
        return [b for b in self.batches() if b in told]

    def merge(self, name: str) -> str:
        """All batches as one, which counts in their place; gives its name.  Their sources stay known."""
        self._check(name)
        old = self.batches()
        told = self.spark.createDataFrame([(f"batch:{b}",) for b in old], "file string")
        for batch in self._with_sources():
            known = read_committed(self.spark, f"{self.path}/sources/{batch}")
            told = told.unionByName(known.where(~F.col("file").startswith("batch:")))
        self.add(f"merge-{name}", merged(self.states()), told)
        return f"merge-{name}"
