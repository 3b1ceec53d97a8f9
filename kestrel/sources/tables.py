"""Parquet tables of the driver's data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; filters and projections applied later reach the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose tables as temporary views for ``spark.sql``."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Deal ``df`` round-robin over ``partitions`` tasks.

    Only for an input whose row groups are too few for the cluster's cores
    and whose rows are costly to process: it shuffles the whole input.
    """
    return df.repartition(partitions)


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A large table for per-row heavy work: the scan as it is, or spread
    over as many tasks as the session setting ``kestrel.scan.partitions``
    says (unset by default: nothing is shuffled)."""
    df = table(spark, sf_dir, name)
    partitions = spark.conf.get("kestrel.scan.partitions", None)
    return spread(df, int(partitions)) if partitions else df
