"""Files of several layouts read by one scan, each line parsed by its file's layout.

The layout is chosen by the file's path, which Spark gives with every line in the hidden
``_metadata`` column.  Files that no layout claims, or whose layout isn't asked for, are pruned when
the scan is planned: they are never opened.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.fence import evaluate_once
from kestrel.sources.delimited import HeaderRule, Policy, field_at, split_fields


@dataclass(frozen=True)
class Layout:
    """How the lines of some files are read.

    files     regular expression that a file's path must hold.
    schema    columns of the layout; other layouts' columns are null in its rows.
    positions field of a column (negative: from the end); by default the schema's order.
    on_error  a field that is missing or does not convert: ``fail`` the job, ``drop`` the row, or
              leave a ``null``.
    """

    files: str
    schema: str
    sep: str = ","
    on_error: Policy = "fail"
    header: HeaderRule | None = None
    positions: dict[str, int] = field(default_factory=dict)

    @property
    def fields(self) -> list[T.StructField]:
        return T._parse_datatype_string(self.schema).fields

    def values(self, line: Column, fields: Column) -> tuple[dict[str, Column], Column]:
        """Column name -> value, and whether the row stays."""
        out, keep = {}, F.lit(True) if self.header is None else ~self.header.skips(fields)
        for k, f in enumerate(self.fields):
            value = field_at(fields, self.positions.get(f.name, k)).try_cast(f.dataType)
            if self.on_error == "fail":
                value = F.when(keep & value.isNull(), F.raise_error(F.concat(
                    F.lit(f"cannot parse field '{f.name}' in line: "), line))).otherwise(value).cast(f.dataType)
            out[f.name] = value
        if self.on_error == "drop":
            for value in out.values():
                keep = keep & value.isNotNull()
        return out, keep


def read_layouts(spark: SparkSession, path: str | list[str], layouts: dict[str, Layout], *,
                 only: Iterable[str] | None = None, tag: str = "layout") -> DataFrame:
    """One row per line: ``tag`` (the layout's name) and the columns of all layouts, by name.

    The first layout whose ``files`` matches a file's path counts.  A column that several layouts
    have must have one type.  ``only``: names of the layouts to read; the other files aren't opened.
    """
    wanted = set(layouts if only is None else only)
    if unknown := wanted - set(layouts):
        raise ValueError(f"no layout is named {sorted(unknown)}")
    types: dict[str, T.DataType] = {}
    for layout in layouts.values():
        for f in layout.fields:
            if types.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"column {f.name!r} has several types")
    if tag in types:
        raise ValueError(f"{tag!r} is a column of a layout")
    file = F.col("_metadata.file_path")
    name = None
    for n, layout in layouts.items():
        name = F.when(file.rlike(layout.files), n) if name is None else name.when(file.rlike(layout.files), n)
    # the filter reads the file's metadata alone, so it prunes files
    lines = (spark.read.text([path] if isinstance(path, str) else list(path))
             .where(name.isin(*sorted(wanted)) if wanted else F.lit(False)).select("value", name.alias(tag)))
    row = None
    for n, layout in layouts.items():
        if n not in wanted:
            continue
        values, keep = layout.values(F.col("value"), split_fields(F.col("value"), layout.sep))
        struct = F.struct(keep.alias("_keep"), *(values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in types.items()))
        row = F.when(F.col(tag) == n, struct) if row is None else row.when(F.col(tag) == n, struct)
    if row is None:
        return lines.select(tag, *(F.lit(None).cast(kind).alias(c) for c, kind in types.items()))
    parsed = evaluate_once(lines.select(tag, row.alias("_row")))
    return parsed.where("_row._keep").select(tag, *(F.col("_row")[c].alias(c) for c in types))
