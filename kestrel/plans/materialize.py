"""Written tables in the shared checkpoint folder.

Writing a result and reading it back cuts the lineage: later jobs start
from the files, and a lost executor never forces a recomputation of what
came before.  The folder comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import scratch_path


def write_and_reload(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def write_text_and_reload(lines: DataFrame, name: str = "text") -> DataFrame:
    """Write a one-string-column DataFrame as text files and read the lines back."""
    spark = lines.sparkSession
    path = scratch_path(spark, name)
    lines.write.mode("errorifexists").text(path)
    return spark.read.text(path)


@contextmanager
def setting(spark: SparkSession, key: str, value):
    """While inside, setting ``key`` of this session is ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def buckets_as_they_come(spark: SparkSession):
    """While inside, a task that writes one bucket writes its rows as they come, instead of sorting
    them by their bucket first; a task of more buckets than one still sorts those after the first."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", 1)


class RunTables:
    """Tables of one run, in a database of its own under the checkpoint folder.

    Tables are managed, so dropping one removes its files; leaving the
    ``with`` block drops the database.  A bucketed table is read
    hash-partitioned by its key: two tables bucketed alike on their join
    keys are joined without moving either side.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        path = scratch_path(spark, name)
        self.database = "kestrel_" + path.rsplit("-", 1)[-1]
        self.path = path

    def __enter__(self) -> RunTables:
        self.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.path}'")
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def add(self, df: DataFrame, name: str) -> DataFrame:
        """``write`` under a name of its own that begins with ``name``."""
        return self.write(df, f"{name}_{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as table ``name`` and read it back."""
        df.write.mode("errorifexists").format("parquet").saveAsTable(f"{self.database}.{name}")
        return self.spark.read.table(f"{self.database}.{name}")

    def write_bucketed(self, df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
        """``write`` in ``buckets`` buckets of ``key``."""
        with buckets_as_they_come(self.spark):
            (df.write.mode("errorifexists").format("parquet").bucketBy(buckets, key)
             .saveAsTable(f"{self.database}.{name}"))
        return self.spark.read.table(f"{self.database}.{name}")

    def drop(self, *names: str) -> None:
        """Drop those of the tables that exist."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{name}")
