"""Scalar Column -> Column helpers.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName) -> Column:
    """Round to the nearest integer, ties toward +infinity, as an int.

    This is the rounding of ``Math.round``, Pig ``ROUND`` and Scala
    ``Float.round``: 2.5 -> 3, -2.5 -> -2, 0.5 -> 1, -0.5 -> 0.  Spark's
    ``round`` rounds ties away from zero (-2.5 -> -3), so it is not used.
    ``floor(x) + (x - floor(x) >= 0.5)`` is exact for every double, unlike
    ``floor(x + 0.5)``, which turns 0.49999999999999994 into 1.  NaN gives 0;
    values beyond the int range, infinities too, give its nearest end.
    """
    x = _col(c)
    wide = x.cast("double")
    base = F.floor(x)
    rounded = base + F.when(x - base >= F.lit(0.5), F.lit(1)).otherwise(F.lit(0))
    return (F.when(F.isnan(wide), F.lit(0))
             .when(wide >= F.lit(2147483647.0), F.lit(2147483647))
             .when(wide <= F.lit(-2147483648.0), F.lit(-2147483648))
             .otherwise(rounded).cast("int"))


def floor_to(c: ColumnOrName, digits: int = 6) -> Column:
    """Floor a double to ``digits`` decimals of its shortest decimal form.

    Mirrors ``DecimalFormat("###.######")`` with ``RoundingMode.FLOOR``
    followed by ``Double.parseDouble``: 13.549999999999997 -> 13.549999,
    -0.48666666666666697 -> -0.486667.  The double's shortest decimal string
    is floored exactly as a decimal, so no binary noise is added.  Spark's
    ``floor(x, d)`` would first round the double to 15 decimals, which turns
    0.49999999999999994 into 0.5.  Magnitudes of 1e15 and above carry no
    fractional digits a double could floor, and are returned unchanged.
    """
    x = _col(c)
    exact = F.floor(x.cast("string").cast("decimal(38,18)"), digits)
    # More than 18 decimals are rounded by the cast, perhaps up past a step.
    lower = (exact - F.lit(Decimal(1).scaleb(-digits))).cast("double")
    exact = exact.cast("double")
    return (F.when(F.isnan(x) | (F.abs(x) >= F.lit(1e15)), x)
             .when(exact > x, lower).otherwise(exact))


def format_key_value(key: ColumnOrName, value: ColumnOrName,
                     fmt: str = "%3d\t%3.3f") -> Column:
    """``printf``-style line for a (key, value) pair.

    ``format_string`` uses ``java.util.Formatter``, so ``%.3f`` rounds the
    shortest decimal form half-up: 8.9525 -> 8.953.
    """
    return F.format_string(fmt, _col(key), _col(value))


def tab_line(*cols: ColumnOrName) -> Column:
    """``key \\t value`` text, the layout of a plain text sink."""
    return F.concat_ws("\t", *[_col(c).cast("string") for c in cols])


def pair_text(left: ColumnOrName, right: ColumnOrName, sep: str = " ") -> Column:
    """Two values joined by a separator (``ename + " " + dname``)."""
    return F.concat_ws(sep, _col(left), _col(right))


def starts_alphabetic(c: ColumnOrName) -> Column:
    """First character is alphabetic (``Character.isAlphabetic``)."""
    return F.coalesce(_col(c).rlike(r"^\p{IsAlphabetic}"), F.lit(False))


def starts_letter(c: ColumnOrName) -> Column:
    """First character is a letter (``Char.isLetter``)."""
    return F.coalesce(_col(c).rlike(r"^\p{L}"), F.lit(False))


def full_match(c: ColumnOrName, pattern: str) -> Column:
    """Whole-string regular-expression match (Pig ``MATCHES``); null for null."""
    return _col(c).rlike(f"^(?:{pattern})$")


def block_index(i: ColumnOrName, size: int) -> Column:
    """Block number of a cell index: truncating integer division."""
    x = _col(i)
    return F.call_function("div", x.cast("bigint"), F.lit(size).cast("bigint"))


def block_offset(i: ColumnOrName, size: int) -> Column:
    """Offset of a cell index inside its block: truncating remainder."""
    return (_col(i) % F.lit(size)).cast("int")


_FIXED = re.compile(r"^([^%]*)%\.(\d+)f$")


def format_fixed(c: ColumnOrName, digits: int) -> Column:
    """``String.format("%.<digits>f", x)`` without ``java.util.Formatter``.

    Zeros (most cells of a dense block) become a constant string, keeping
    the sign of -0.0 as the formatter does.  Other finite values below 1e20
    in magnitude go through an exact decimal cast, which rounds the
    shortest decimal form half-up exactly as the formatter does (8.9525 ->
    8.953); a negative value that rounds to zero prints as "-0.000".  NaN,
    infinities and huge values use ``format_string`` itself.
    """
    x = _col(c)
    zero = "0." + "0" * digits if digits > 0 else "0"
    dec = x.cast(f"decimal(38,{digits})")
    # Sign of a zero without formatting it: 1/(-0.0) is -Infinity.
    negative_zero = F.pow(x, F.lit(-1.0)) < F.lit(0.0)
    return (F.when(x == F.lit(0.0), F.when(negative_zero, F.lit("-" + zero)).otherwise(F.lit(zero)))
             .when(F.isnan(x) | (F.abs(x) >= F.lit(1e20)), F.format_string(f"%.{digits}f", x))
             .when((x < F.lit(0.0)) & (dec == F.lit(0)), F.lit("-" + zero))
             .otherwise(dec.cast("string")))


def format_cell(c: ColumnOrName, cell_fmt: str) -> Column:
    """Format one value with a printf pattern; ``<text>%.<n>f`` takes the
    fast exact path of ``format_fixed``."""
    m = _FIXED.match(cell_fmt)
    if m and "%" not in m.group(1):
        body = format_fixed(c, int(m.group(2)))
        return F.concat(F.lit(m.group(1)), body) if m.group(1) else body
    return F.format_string(cell_fmt, _col(c))


def render_block(data: ColumnOrName, rows: int, cols: int,
                 cell_fmt: str = "\t%.3f", lead: str = "\n") -> Column:
    """Text of one dense row-major block of ``rows * cols`` cells.

    ``lead`` first, then every cell formatted with ``cell_fmt``, with a
    newline after the last cell of each block row.  ``cell_fmt="\\t%.3f"``
    gives the tab layout, ``cell_fmt=" %.2f"`` the space layout.  One pass
    over the array: each cell is read and formatted exactly once.
    """
    del rows  # the row count is implied by the array length
    cells = F.transform(
        _col(data),
        lambda x, k: F.concat(
            format_cell(x, cell_fmt),
            F.when((k + F.lit(1)) % F.lit(cols) == F.lit(0), F.lit("\n")).otherwise(F.lit(""))))
    return F.concat(F.lit(lead), F.array_join(cells, ""))
