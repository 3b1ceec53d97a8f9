"""SQL entry point: DataFrames as scoped views, values as named parameters."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, query: str, args: dict[str, Any] | None = None,
            **frames: DataFrame) -> DataFrame:
    """Run ``query`` with ``{name}`` placeholders bound to DataFrames and
    ``:name`` markers bound to literal parameters.

    DataFrames passed as keywords are visible to this query only (no
    session-wide temp view is left behind); parameters are bound as
    literals, never spliced into the text.  The result is an ordinary lazy
    DataFrame: Catalyst optimises it like the DataFrame API.
    """
    if frames:
        return spark.sql(query, args=args, **frames)
    return spark.sql(query, args=args)
