"""Output folders that count once they are whole: a manifest, written last, names what is in them.

``write_committed`` refuses a folder that is there, writes the rows as part files, reads each part
back for its rows and a checksum of them, and only then writes the manifest.  ``read_committed``
refuses a folder without a manifest, reads the files it names and no others, and holds their sizes
(or, if asked, their rows and checksums) against it.  A job that is stopped half-way, or one of which
a task wrote parts twice, leaves nothing that can be read by mistake.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = "parts"
MANIFEST = "manifest"
#: A manifest's own last row: it counts the others.
TOTAL = "*"
_MANIFEST_SCHEMA = "file string, bytes long, rows long, checksum string, layout string"


class NotCommitted(ValueError):
    """The folder has no manifest, or holds something else than its manifest says."""


def _checksum(df: DataFrame) -> DataFrame:
    """``(file, rows, checksum)`` of the part files of ``df``: the sum of the rows' hashes, so that
    neither the order of rows nor how a file is split matters."""
    row = F.xxhash64(*(F.to_json(F.struct(c)) if kind.startswith("map") else F.col(c) for c, kind in df.dtypes)).cast("decimal(38,0)")
    named = df.select(F.col("_metadata.file_name").alias("file"), row.alias("h"))
    return named.groupBy("file").agg(F.count("*").alias("rows"), F.sum("h").cast("string").alias("checksum"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, bytes)`` of what lies in the parts folder; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*part-*").load(f"{folder}/{PARTS}")
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes")))


def _parts(spark: SparkSession, folder: str, layout: dict) -> DataFrame:
    reader = spark.read.format(layout["format"]).options(**layout["options"])
    return reader.schema(layout["schema"]).load(f"{folder}/{PARTS}")


def write_committed(df: DataFrame, folder: str, format: str = "parquet", **options: str) -> None:
    """Write ``df`` to ``folder``, which must not exist, and commit it with a manifest.

    ``format``: any of Spark's file formats; ``options`` are used for writing and for reading back.
    A failed or stopped job leaves a folder without a manifest, which no later job writes into.
    """
    spark = df.sparkSession
    # an existing folder, committed or not, is refused before anything is written
    spark.createDataFrame([(format,)], "format string").write.mode("errorifexists").json(folder + "/layout")
    df.write.format(format).options(**options).mode("errorifexists").save(f"{folder}/{PARTS}")
    layout = {"format": format, "options": options,
              "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)}
    told = _files(spark, folder).join(_checksum(_parts(spark, folder, layout)), "file", "left").select(
        "file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("checksum", F.lit("0")).alias("checksum"),
        F.lit(None).cast("string").alias("layout")).persist()  # a row for each file; made anew if it gets lost
    total = told.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.count("*").cast("string").alias("checksum"))
    whole = told.unionByName(total.select(F.lit(TOTAL).alias("file"), F.coalesce("bytes", F.lit(0)).alias("bytes"),
                                          F.coalesce("rows", F.lit(0)).alias("rows"), "checksum",
                                          F.lit(json.dumps(layout)).alias("layout")))
    # the rename of a finished write is the commit: files of a write that stops lie in _temporary
    whole.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/{MANIFEST}")
    told.unpersist()


def manifest(spark: SparkSession, folder: str) -> tuple[DataFrame, dict, int]:
    """``(file, bytes, rows, checksum)`` of the committed parts, their layout, and their total rows."""
    told = spark.read.schema(_MANIFEST_SCHEMA)
    is_total = F.col("file") == TOTAL
    try:
        told = told.parquet(f"{folder}/{MANIFEST}")
        total = told.agg(F.max(F.when(is_total, F.struct("checksum", "layout", "rows"))).alias("t"),
                         F.count(F.when(is_total, 1)).alias("totals"), F.count("*").alias("n")).first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise NotCommitted(f"{folder} has no manifest: its job did not end") from None
    if total["totals"] != 1 or total["n"] - 1 != int(total["t"]["checksum"]):
        raise NotCommitted(f"the manifest of {folder} isn't whole")
    return told.where(~is_total).drop("layout"), json.loads(total["t"]["layout"]), total["t"]["rows"]


def read_committed(spark: SparkSession, folder: str, verify: str = "files") -> DataFrame:
    """The committed rows of ``folder``.

    verify  ``files``: every part of the manifest must be there, with its size (a listing alone);
            ``rows``: its rows and their checksum must match as well (reads everything once more).
    Files that the manifest doesn't name are left out by the scan.
    """
    if verify not in ("files", "rows"):
        raise ValueError("verify must be 'files' or 'rows'")
    files, layout, _ = manifest(spark, folder)
    met = files.select("file", F.col("bytes").alias("told")).join(_files(spark, folder), "file", "full").agg(
        F.array_agg(F.when(F.col("told").isNotNull() & ~F.col("told").eqNullSafe(F.col("bytes")), F.col("file"))).alias("lost"),
        F.count(F.when(F.col("told").isNull(), 1)).alias("strays")).first()
    parts, lost = _parts(spark, folder, layout), met["lost"]
    if met["strays"]:  # as many names as the driver lists for the scan
        parts = parts.where(F.col("_metadata.file_name").isin(*(r["file"] for r in files.select("file").collect())))
    if verify == "rows" and not lost:
        wrong = files.where("rows > 0").join(_checksum(parts), ["file", "rows", "checksum"], "left_anti")
        lost = [r["file"] for r in wrong.select("file").limit(3).collect()]
    if lost:
        raise NotCommitted(f"{folder} differs from its manifest in {', '.join(sorted(lost)[:3])}")
    return parts
