"""Column -> Column helpers (rounding, flooring, formatting, block text)."""

from kestrel.functions.fence import evaluate_once
from kestrel.functions.scalar import (
    block_index,
    block_offset,
    floor_to,
    format_key_value,
    full_match,
    pair_text,
    render_block,
    round_half_up,
    starts_alphabetic,
    starts_letter,
    tab_line,
)

__all__ = [
    "block_index", "block_offset", "evaluate_once", "floor_to", "format_key_value", "full_match",
    "pair_text", "render_block", "round_half_up", "starts_alphabetic",
    "starts_letter", "tab_line",
]
