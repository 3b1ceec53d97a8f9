"""Evaluate-once points in a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    """Return ``df`` with its columns computed exactly once per row.

    Catalyst pushes a filter below the projection that defines the columns
    it tests, substituting the defining expression into the filter: a
    bound on a parsed, rounded value would then re-run the parse inside
    the filter, once per reference.  Predicates are never pushed below a
    generator's output, so re-emitting the row through ``inline`` of a
    one-element array stops that substitution.  The generator runs inside
    whole-stage codegen and adds no shuffle.
    """
    cols = df.columns
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))))
