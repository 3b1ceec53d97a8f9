"""DataFrame -> DataFrame operators: keyed means, joins, block matrices,
label propagation, tagged unions."""

from kestrel.operators.graph import bucket_count, component_sizes, propagate_min
from kestrel.operators.grouping import bucket_mean, count_by_key, mean_by_key, mean_expr
from kestrel.operators.joins import equi_join, equi_join_pairs
from kestrel.operators.matrix import (
    add_cells,
    add_matrices,
    add_matrices_text,
    block_coords,
    block_lines,
    cells,
    cells_of_block,
    coo_to_block_text,
    coo_to_blocks,
    keyed_block_text,
    dedupe_cells,
    pick_block,
    render_blocks,
    tuple_block_text,
)
from kestrel.operators.setops import union_tagged

__all__ = [
    "add_cells", "add_matrices", "add_matrices_text", "block_coords", "block_lines",
    "bucket_mean", "cells", "cells_of_block", "component_sizes", "coo_to_blocks", "count_by_key",
    "coo_to_block_text", "dedupe_cells", "keyed_block_text", "equi_join", "equi_join_pairs", "mean_by_key", "mean_expr",
    "pick_block", "propagate_min", "render_blocks",
    "tuple_block_text", "union_tagged", "bucket_count",
]
