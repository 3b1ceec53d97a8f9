"""Delimited files with quoting, loaded by Spark's CSV source under a declared schema.

The line parser (``parse_delimited``) takes a separator wherever it stands.  Here a quoted field may
hold separators and quotes, the reader converts to the declared types, and only the columns that a
query uses are parsed: unused ones never leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.sources.delimited import Policy

#: Column of the whole line of a record that doesn't fit the schema.
CORRUPT = "_corrupt_record"

_MODES = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "null": "PERMISSIVE"}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, *, sep: str = ",",
             quote: str = '"', escape: str = '"', header: bool = False, on_error: Policy = "null",
             corrupt: bool = False, trim: bool = False, multi_line: bool = False) -> DataFrame:
    """Records of the files at ``path`` as the columns of ``schema``.

    on_error   a field that does not convert, or a missing field: ``null`` makes it null, ``drop``
               drops the record, ``fail`` fails the job.  Fields beyond the schema count as well.
               Columns that a query leaves out aren't looked at, so with ``drop`` and ``fail`` the
               whole schema is parsed whatever is selected.
    corrupt    (with ``null``) adds ``CORRUPT``: the line of a record that does not fit, else null.
    escape     what makes a quote inside a quoted field ordinary; by default a doubled quote.
    header     skip the first line of each file.
    multi_line quoted fields may hold line ends; such files can't be split.
    An empty field is null, quoted or not.
    """
    if on_error not in _MODES:
        raise ValueError(f"on_error must be one of {tuple(_MODES)}")
    if corrupt and on_error != "null":
        raise ValueError("the line of a bad record is kept only where on_error='null'")
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if CORRUPT in struct.names:
        raise ValueError(f"{CORRUPT} is the column of bad records")
    declared = T.StructType([*struct.fields, T.StructField(CORRUPT, T.StringType())]) if corrupt else struct
    reader = (spark.read.schema(declared).option("mode", _MODES[on_error]).option("sep", sep)
              .option("quote", quote).option("escape", escape).option("header", header)
              .option("enforceSchema", True).option("multiLine", multi_line)
              .option("ignoreLeadingWhiteSpace", trim)
              .option("ignoreTrailingWhiteSpace", trim).option("columnNameOfCorruptRecord", CORRUPT))
    df = reader.csv([path] if isinstance(path, str) else path)
    # a record is judged by all of its fields, whatever is selected
    return df if on_error == "null" else df.where(_whole(struct.names))


def _whole(columns: list[str]) -> Column:
    """Always true, and makes the scan parse all of the columns."""
    return F.hash(*(F.col(f"`{c}`") for c in columns)) >= F.lit(-2**31)


def write_csv(df: DataFrame, path: str, *, sep: str = ",", quote: str = '"', header: bool = False,
              mode: str = "errorifexists") -> None:
    """Write ``df`` so that ``read_csv`` gives it back: fields are quoted where they have to be,
    quotes inside are doubled, nulls and empty texts are empty fields."""
    (df.write.mode(mode).option("sep", sep).option("quote", quote).option("escape", quote)
     .option("header", header).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def bad_records(df: DataFrame) -> DataFrame:
    """``(value)``: lines of the records that did not fit the schema (``read_csv(corrupt=True)``)."""
    # Spark gives that line only beside the columns it was parsed into
    return df.where(F.col(CORRUPT).isNotNull() & _whole([c for c in df.columns if c != CORRUPT])).select(
        F.col(CORRUPT).alias("value"))
