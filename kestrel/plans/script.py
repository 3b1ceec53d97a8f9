"""SQL scripts with parameters: several statements, the last one's rows as a DataFrame.

A script may declare variables, define temporary functions and name its input by a parameter
(``IDENTIFIER(:t)``).  Scalar and table functions written in SQL are inlined into the plan: Catalyst
sees the columns they use, and nothing runs row by row outside the generated code.
"""

from __future__ import annotations

from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from kestrel.plans.trip import HEADER_PATTERN, MAX_DISTANCE, trip_schema


def run_script(spark: SparkSession, script: str, **params: Any) -> DataFrame:
    """Run ``BEGIN ... END`` with ``:name`` markers bound to values.

    A value is bound as a literal and can't change the script; where the script says
    ``IDENTIFIER(:name)`` it must be the name of one relation, such as ``files_named(...)`` gives.
    """
    return spark.sql(script, args=params)


def files_named(path: str, format: str = "text") -> str:
    """Files at ``path`` as the name of a relation."""
    if "`" in path or not format.isidentifier():
        raise ValueError(f"no name for {format} files at {path!r}")
    return f"{format}.`{path if '://' in path or ':/' in path else PurePosixPath(path)}`"


def trip_script(amount_field: int, amount_type: str, distance_field: int) -> str:
    """Mean amount per rounded trip distance, from files to rows in one script.

    Parameters: ``t`` the input, ``header`` a pattern of its header's first field, ``below`` the
    bound on the distance.  The whole record is declared; a field that does not convert is null.
    """
    record = trip_schema({distance_field: "double", amount_field: amount_type})
    return f"""
BEGIN
  CREATE OR REPLACE TEMPORARY FUNCTION half_up(x DOUBLE) RETURNS INT
    RETURN CASE WHEN x IS NOT NULL THEN
      CAST(least(greatest(floor(nanvl(x, 0D)) + IF(nanvl(x, 0D) - floor(nanvl(x, 0D)) >= 0.5, 1, 0), -2147483648), 2147483647) AS INT) END;
  CREATE OR REPLACE TEMPORARY FUNCTION mean_of(total DOUBLE, n BIGINT) RETURNS DOUBLE
    RETURN try_divide(total, n);

  WITH record AS (SELECT from_csv(value, '{record}', map('mode', 'PERMISSIVE')) AS r FROM IDENTIFIER(:t)),
  trip AS (SELECT half_up(r.f{distance_field}) AS distance, r.f{amount_field} AS amount FROM record
           WHERE NOT (nullif(r.f0, '') RLIKE concat('^(?:', :header, ')$')))
  SELECT distance, mean_of(CAST(sum(amount) AS DOUBLE), count(amount)) AS mean
  FROM trip WHERE distance < :below GROUP BY distance ORDER BY distance;
END"""


def trip_means_script(spark: SparkSession, path: str, *, amount_field: int = 18, amount_type: str = "double",
                      distance_field: int = 4, header_pattern: str = HEADER_PATTERN,
                      below: int = MAX_DISTANCE) -> DataFrame:
    """``(distance int, mean double)`` of the trip files at ``path``, by ``trip_script``."""
    return run_script(spark, trip_script(amount_field, amount_type, distance_field),
                      t=files_named(path), header=header_pattern, below=below)
