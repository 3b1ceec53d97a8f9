"""Mean amount per rounded trip distance, in the three input dialects.

All three read delimited text lines, skip a header, round the distance
half toward +infinity and average the amount per distance.  They differ
only in parse policy, bounds, precision and finishing, which are all
parameters of the shared operators.

=========  ===============  ==========  ===========  =========  ========
dialect    header rule      bad field   bounds       amount     finish
=========  ===============  ==========  ===========  =========  ========
mapreduce  field 0 alpha    fail job    0 <= d <200  last fld   floor 6
pig        field 0 regex    null        d < 200      field 18   none
sql        field 4 letter   drop row    d < 200      last fld   none
=========  ===============  ==========  ===========  =========  ========
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from kestrel.functions.scalar import format_key_value
from kestrel.operators.grouping import bucket_mean
from kestrel.sources.delimited import HeaderRule, parse_delimited

# Fixed values of the trip input layout.
TRIP_FIELDS = 19
DISTANCE_FIELD = 4
AMOUNT_FIELD = 18
HEADER_PATTERN = ".*VendorID.*"
MAX_DISTANCE = 200


def trip_schema(types: dict[int, str]) -> str:
    """The whole record, ``f0 .. f18``: strings unless ``types`` (by position) says otherwise."""
    return ", ".join(f"f{k} {types.get(k, 'string')}" for k in range(TRIP_FIELDS))


def trip_means_mapreduce(lines: DataFrame, *, distance_field: int = DISTANCE_FIELD,
                         amount_type: str = "double", min_key: int | None = 0,
                         max_key: int | None = MAX_DISTANCE) -> DataFrame:
    """``(distance int, mean double)``, mean floored to 6 decimals.

    Header: first character of field 0 alphabetic.  Amount: last field
    after trailing empty fields are dropped.  A bad number fails the job.
    """
    parsed = parse_delimited(
        lines, f"distance double, amount {amount_type}",
        header=HeaderRule("alphabetic", 0),
        positions={"distance": distance_field, "amount": -1},
        java_split=True, on_error="fail")
    return bucket_mean(parsed, "distance", "amount", min_key=min_key, max_key=max_key,
                       finish="floor6", key_name="distance", mean_name="mean")


def trip_means_pig(lines: DataFrame, *, distance_field: int = DISTANCE_FIELD,
                   amount_field: int = AMOUNT_FIELD, amount_type: str = "double",
                   header_pattern: str = HEADER_PATTERN,
                   max_key: int | None = MAX_DISTANCE) -> DataFrame:
    """``(distance int, mean double)`` as ``SUM(amount) / COUNT(amount)``.

    Header: field 0 fully matches ``header_pattern``.  Fields that do not
    convert, or are missing, become null; a null distance is dropped by the
    bound, a null amount is ignored by both SUM and COUNT.
    """
    # The whole record is declared; only the two fields used are converted.
    record = parse_delimited(
        lines, trip_schema({distance_field: "double", amount_field: amount_type}),
        header=HeaderRule("regex", 0, header_pattern), on_error="null")
    return bucket_mean(record, f"f{distance_field}", f"f{amount_field}", min_key=None, max_key=max_key,
                       key_name="distance", mean_name="mean")


def trip_means_sql(lines: DataFrame, *, distance_field: int = DISTANCE_FIELD, amount_type: str = "float",
                   max_key: int = MAX_DISTANCE, min_count: int = 1, with_line: bool = False) -> DataFrame:
    """``(distance int, avg double[, line string])``, single-precision input.

    Header: first character of the distance field is a letter.  A row whose
    numbers do not convert is dropped; a row too short to have a distance
    field fails the job.  ``min_count`` keeps only distances with at least
    that many rows (1 keeps all).  ``with_line`` adds the ``%3d\\t%3.3f``
    text of each row.
    """
    parsed = parse_delimited(
        lines, f"distance float, amount {amount_type}",
        header=HeaderRule("letter", distance_field),
        positions={"distance": distance_field, "amount": -1},
        java_split=True, on_error="drop", on_short="fail")
    out = bucket_mean(parsed, "distance", "amount", max_key=max_key, min_count=min_count,
                      key_name="distance", mean_name="avg")
    if with_line:
        out = out.withColumn("line", format_key_value("distance", "avg"))
    return out
