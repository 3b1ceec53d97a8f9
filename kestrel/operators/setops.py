"""Unions of several keyed inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(inputs: list[tuple[int, DataFrame]], tag_name: str = "tag") -> DataFrame:
    """UNION ALL of inputs, each row marked with its input's tag.

    Columns are matched by name; a column missing from one input is null
    there.  This is the many-inputs-one-keyed-stream pattern: the tagged
    rows can then be grouped or joined on a shared key.
    """
    if not inputs:
        raise ValueError("union_tagged needs at least one input")
    out = None
    for tag, df in inputs:
        tagged = df.withColumn(tag_name, F.lit(tag))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
