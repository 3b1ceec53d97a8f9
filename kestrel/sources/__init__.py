"""Sources and sinks: parquet tables, text lines, delimited records,
adjacency lists and sparse-matrix triples."""

from kestrel.sources.adjacency import Graph, adjacency_rows, graph_from_edges, read_adjacency, read_long_adjacency
from kestrel.sources.coo import read_coo
from kestrel.sources.delimited import HeaderRule, field_at, parse_delimited, split_fields
from kestrel.sources.tables import TABLES, fact_table, register_views, spread, table
from kestrel.sources.text import read_lines, render_lines, write_lines

__all__ = [
    "Graph", "HeaderRule", "TABLES", "fact_table", "spread", "adjacency_rows", "field_at", "graph_from_edges",
    "parse_delimited", "read_adjacency", "read_coo", "read_lines", "read_long_adjacency", "register_views",
    "render_lines", "split_fields", "table", "write_lines",
]
