"""A keyed table kept as a log: a write adds a layer of the rows that changed.

All layers are partitions of one table, bucketed by the key alike, so that a task finds all rows of
its keys in the bucket it reads, whatever layer they are in: the newest row of each key comes out
of an aggregation that moves nothing.  What a write costs follows the rows that changed.  A log of
more than ``depth`` layers is merged: the layers below the newest become one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.plans.materialize import RunTables, buckets_as_they_come

LAYER = "_layer"


class LayeredTable:
    """Rows ``(key, values...)`` of which a key's newest counts; ``tables`` holds the files.

    Rows of one ``append`` must have distinct keys.  ``depth``: layers kept before they are merged.
    """

    def __init__(self, tables: RunTables, name: str, key: str, buckets: int, depth: int = 8):
        if depth < 2:
            raise ValueError("a log keeps two layers at least: the newest, and what lies below")
        self.tables, self.key, self.buckets, self.depth = tables, key, buckets, depth
        self.name, self.generation = name, 0
        self.layers = 0
        self._values: list[str] = []

    @property
    def table(self) -> str:
        """Name of the table of this generation (a merge starts a new one)."""
        return f"{self.name}_{self.generation}"

    def append(self, df: DataFrame) -> None:
        """Write ``df`` as the newest layer; it may read from this table."""
        self._values = [c for c in df.columns if c != self.key]
        if self.layers >= self.depth:
            self._merge(df)
        else:
            self._write(df, self.layers)
        self.layers += 1

    def _write(self, df: DataFrame, layer: int) -> None:
        with buckets_as_they_come(self.tables.spark):
            (df.withColumn(LAYER, F.lit(layer)).write.mode("append").format("parquet").partitionBy(LAYER)
             .bucketBy(self.buckets, self.key).saveAsTable(f"{self.tables.database}.{self.table}"))

    def _merge(self, newest: DataFrame) -> None:
        """A new generation: all that there is as its first layer, and ``newest`` above it."""
        old, below = self.table, self.current()
        self.generation += 1
        self._write(below, 0)
        self._write(newest, 1)
        self.layers = 1  # ``append`` counts the one above
        self.tables.drop(old)

    def _rows(self) -> DataFrame:
        if not self.layers:
            raise ValueError("nothing was written yet")
        return self.tables.spark.read.table(f"{self.tables.database}.{self.table}")

    def newest(self) -> DataFrame:
        """The rows of the last ``append``: the scan reads their files alone."""
        return self._rows().where(F.col(LAYER) == self.layers - 1).select(self.key, *self._values)

    def current(self) -> DataFrame:
        """The newest row of each key, in the buckets of the key."""
        if self.layers == 1:
            return self._rows().select(self.key, *self._values)
        return self._rows().groupBy(self.key).agg(*(F.max_by(c, LAYER).alias(c) for c in self._values))
