"""Whole jobs: text input paths -> text output folders.

Each job reads delimited text (a file, a folder or a glob), runs the
operators, and writes tab-separated text lines.  An existing output folder
is refused, as a plain text sink does.  The same functions return the
result DataFrame when no output path is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.scalar import pair_text, tab_line
from kestrel.operators.graph import component_sizes, propagate_min
from kestrel.operators.grouping import mean_by_key
from kestrel.operators.joins import equi_join_pairs
from kestrel.operators.matrix import (
    Duplicates,
    add_matrices_text,
    cells_of_block,
    keyed_block_text,
    tuple_block_text,
)
from kestrel.plans.trip import trip_means_mapreduce, trip_means_pig, trip_means_sql
from kestrel.sources.adjacency import read_adjacency
from kestrel.sources.coo import read_coo
from kestrel.sources.delimited import parse_delimited
from kestrel.sources.text import read_lines, write_lines


def _emit(lines: DataFrame, output: str | None) -> DataFrame:
    if output:
        write_lines(lines, output)
    return lines


def trip_job(spark: SparkSession, inputs: str | list[str], output: str | None = None,
             dialect: str = "mapreduce", min_count: int = 1) -> DataFrame:
    """Mean amount per rounded trip distance, ordered by distance.

    ``mapreduce``: ``distance \\t mean`` (floored to 6 decimals);
    ``pig``: ``distance \\t mean``; ``sql``: ``%3d\\t%3.3f`` lines.
    """
    lines = read_lines(spark, inputs)
    if dialect == "mapreduce":
        out = trip_means_mapreduce(lines).select(tab_line("distance", "mean").alias("value"))
    elif dialect == "pig":
        out = trip_means_pig(lines).select(tab_line("distance", "mean").alias("value"))
    elif dialect == "sql":
        out = trip_means_sql(lines, min_count=min_count, with_line=True).select(
            F.col("line").alias("value"))
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    return _emit(out, output)


def simple_mean_job(spark: SparkSession, inputs: str | list[str],
                    output: str | None = None) -> DataFrame:
    """``key \\t mean`` of ``bigint,double`` lines (fail-fast parse)."""
    parsed = parse_delimited(read_lines(spark, inputs), "k bigint, v double", on_error="fail")
    means = mean_by_key(parsed, "k", "v").orderBy("key")
    return _emit(means.select(tab_line("key", "mean").alias("value")), output)


def join_job(spark: SparkSession, employees: str, departments: str, output: str | None = None,
             keyed: bool = True) -> DataFrame:
    """Employees ``name,dno,address`` joined with departments ``name,dno``.

    ``keyed``: ``dno \\t ename dname`` lines; otherwise ``ename dname``.
    """
    emp = parse_delimited(read_lines(spark, employees), "name string, dno bigint, address string",
                          on_error="fail")
    dept = parse_delimited(read_lines(spark, departments), "name string, dno bigint", on_error="fail")
    pairs = equi_join_pairs(emp, dept, left_key="dno", right_key="dno", left_value="name",
                            right_value="name", keep_key=keyed)
    out = (pairs.select(tab_line("dno", "pair").alias("value")) if keyed
           else pairs.select(F.col("pair").alias("value")))
    return _emit(out, output)


def add_job(spark: SparkSession, m_path: str, n_path: str, rows: int, cols: int,
            output: str | None = None, how: str = "outer", cell_fmt: str = "\t%.3f",
            only_block: tuple[int, int] | None = None, duplicates: Duplicates = "error",
            tuple_text: bool = False) -> DataFrame:
    """Block sum of two ``i,j,v`` matrices: ``bi \\t bj \\t <block text>``
    per block, ordered by (bi, bj).

    only_block  keep one block: cells of others are left out as they are read.
    duplicates  what a cell given twice in one matrix does (``error``, ``sum``
                or ``max``).
    tuple_text  ``((bi,bj),<block text>)`` instead of tab-separated text.
    """
    m, n = read_coo(read_lines(spark, m_path)), read_coo(read_lines(spark, n_path))
    if only_block is not None:
        m, n = (cells_of_block(x, *only_block, rows, cols) for x in (m, n))
    text = add_matrices_text(m, n, rows, cols, how, cell_fmt, duplicates=duplicates, ordered=True)
    return _emit(tuple_block_text(text) if tuple_text else keyed_block_text(text), output)


def graph_job(spark: SparkSession, inputs: str | list[str], output: str | None = None,
              rounds: int = 5, implicit_vertices: bool = True, sep: str = "\t") -> DataFrame:
    """Group sizes after ``rounds`` of min-label propagation: ``grp <sep> n``."""
    labels = propagate_min(read_adjacency(read_lines(spark, inputs)), rounds=rounds,
                           implicit_vertices=implicit_vertices)
    sizes = component_sizes(labels).orderBy("grp")
    return _emit(sizes.select(pair_text(F.col("grp").cast("string"), F.col("n").cast("string"),
                                        sep).alias("value")), output)
