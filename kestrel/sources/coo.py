"""Sparse matrix text (``i,j,v`` per line) -> cell rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kestrel.sources.delimited import parse_delimited

COO_SCHEMA = "i bigint, j bigint, v double"


def read_coo(lines: DataFrame, sep: str = ",", line_col: str = "value",
             strict_arity: bool = True) -> DataFrame:
    """``(i bigint, j bigint, v double)`` per line; fields are trimmed.

    Malformed numbers fail the job.  With ``strict_arity`` a line must have
    exactly three fields; otherwise extra fields are ignored.
    """
    return parse_delimited(lines, COO_SCHEMA, sep=sep, on_error="fail", trim=True,
                           exact_fields=3 if strict_arity else None,
                           line_col=line_col)
