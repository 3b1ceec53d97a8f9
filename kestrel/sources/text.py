"""Line-oriented text input and output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line (``value: string``) from a file, folder or glob.

    Several paths are read as one data set, like a directory input with
    many files.  Uncompressed text is split into many tasks by
    ``spark.sql.files.maxPartitionBytes``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def render_lines(df: DataFrame, cols: list[Column | str], sep: str = ",") -> DataFrame:
    """Render columns as delimited text lines (``value: string``).

    Nulls become empty fields, so positions are kept.
    """
    fields = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
              for c in cols]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists",
                single_file: bool = False) -> None:
    """Write a one-string-column DataFrame as text.

    ``mode='errorifexists'`` refuses an existing output folder.  With
    ``single_file`` the parts are merged into one file by ``coalesce(1)``;
    use it only for results known to be small.
    """
    if len(df.columns) != 1:
        raise ValueError("write_lines takes exactly one string column")
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).text(path)
