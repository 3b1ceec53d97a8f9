"""Delimited text -> typed rows, with explicit error and header policies.

The parse is a projection of ``split`` + ``try_cast`` expressions over the
line column, so it runs inside whole-stage codegen, in every scan task.  The
split happens once per line; a column that a query never uses is not
converted, unless the parse policy has to look at it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.fence import evaluate_once
from kestrel.functions.scalar import full_match, starts_alphabetic, starts_letter

Policy = Literal["fail", "drop", "null"]
_POLICIES = ("fail", "drop", "null")


@dataclass(frozen=True)
class HeaderRule:
    """How a header line is recognised (and skipped).

    kind ``alphabetic``: the first character of field ``field`` is alphabetic
    (``Character.isAlphabetic``); ``letter``: it is a letter
    (``Char.isLetter``); ``regex``: field ``field`` fully matches ``pattern``.

    ``on_null``: what happens to a row whose field is missing or, for
    ``regex``, empty (a typed load reads it as null, and a negated match of
    null is not true): ``keep`` or ``drop``.  Default: ``drop`` for
    ``regex``, ``keep`` for the others.
    """

    kind: Literal["alphabetic", "letter", "regex"]
    field: int = 0
    pattern: str | None = None
    on_null: Literal["keep", "drop"] | None = None

    def skips(self, fields: Column) -> Column:
        """True for rows to skip; never null."""
        null = (self.on_null or ("drop" if self.kind == "regex" else "keep")) == "drop"
        raw = field_at(fields, self.field)
        if self.kind == "regex":
            raw = F.nullif(raw, F.lit(""))
        return F.coalesce(self._matches(raw), F.lit(null)) if self.kind == "regex" else (
            F.when(raw.isNull(), F.lit(null)).otherwise(self._matches(raw)))

    def _matches(self, raw: Column) -> Column:
        if self.kind == "alphabetic":
            return starts_alphabetic(raw)
        if self.kind == "letter":
            return starts_letter(raw)
        if self.kind == "regex":
            if not self.pattern:
                raise ValueError("a regex header rule needs a pattern")
            return full_match(raw, self.pattern)
        raise ValueError(f"unknown header rule {self.kind!r}")


def separator_regex(sep: str) -> str:
    """Java-regex form of a literal separator."""
    if len(sep) == 1 and sep not in r".$|()[]{}^?*+\\":
        return sep
    return "\\Q" + sep + "\\E"


def split_fields(line: Column, sep: str = ",", java_split: bool = False) -> Column:
    """Split a line into string fields.

    With ``java_split`` trailing empty fields are removed first, as
    ``String.split`` does ("a,b,," has two fields, not four).
    """
    sep_re = separator_regex(sep)
    if java_split:
        # A one-character separator is stripped with rtrim (no regex).
        text = (F.rtrim(line, F.lit(sep)) if len(sep) == 1
                else F.regexp_replace(line, f"(?:{sep_re})+$", ""))
    else:
        text = line
    return F.split(text, sep_re, -1)


def field_at(fields: Column, pos: int) -> Column:
    """Field ``pos`` (negative counts from the end); null when absent."""
    if pos >= 0:
        return F.get(fields, F.lit(pos))
    return F.get(fields, F.size(fields) + F.lit(pos))


def _as_struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    parsed = T._parse_datatype_string(schema)
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"schema must describe a struct: {schema!r}")
    return parsed


def parse_delimited(lines: DataFrame, schema: T.StructType | str, *,
                    sep: str = ",",
                    on_error: Policy = "fail",
                    on_short: Policy | None = None,
                    header: HeaderRule | None = None,
                    trim: bool = False,
                    positions: dict[str, int] | None = None,
                    java_split: bool = False,
                    exact_fields: int | None = None,
                    line_col: str = "value") -> DataFrame:
    """Parse delimited lines into the columns of ``schema``.

    on_error  what a field that does not convert does:
              ``fail``  the job fails, naming the line (fail-fast parsers);
              ``drop``  the row is dropped (``try``/``catch`` -> ``None``);
              ``null``  the field becomes NULL (typed load).
    on_short  the same choice for a row that lacks a field (default:
              ``on_error``).
    header    rows matching the rule are skipped before any conversion.
    positions field index per column name; negative counts from the end
              (``-1`` is the last field).  Default: schema order.
    java_split  drop trailing empty fields before indexing.
    exact_fields  rows with another field count are treated as short.
    """
    if on_error not in _POLICIES:
        raise ValueError(f"on_error must be one of {_POLICIES}")
    on_short = on_short or on_error
    if on_short not in _POLICIES:
        raise ValueError(f"on_short must be one of {_POLICIES}")
    struct = _as_struct(schema)
    positions = positions or {}

    # Split once; the header test and every field below read the array.
    parts = evaluate_once(lines.select(
        F.col(line_col).alias("_line"),
        split_fields(F.col(line_col), sep, java_split).alias("_f")))
    if header is not None:
        parts = parts.where(~header.skips(F.col("_f")))

    fields = F.col("_f")
    line = F.col("_line")
    count_ok = (F.size(fields) == F.lit(exact_fields)) if exact_fields else F.lit(True)

    typed, missing, bad = [], [], []
    for idx, fld in enumerate(struct.fields):
        raw = field_at(fields, positions.get(fld.name, idx))
        if trim:
            raw = F.trim(raw)
        absent = raw.isNull() | ~count_ok
        value = raw.try_cast(fld.dataType)
        broken = ~absent & value.isNull()
        if on_error == "fail" or on_short == "fail":
            checks = []
            if on_short == "fail":
                checks.append((absent, F.concat(F.lit(f"missing field '{fld.name}' in line: "), line)))
            if on_error == "fail":
                checks.append((broken, F.concat(F.lit(f"cannot parse field '{fld.name}' in line: "), line)))
            expr = None
            for cond, msg in checks:
                expr = (F.when(cond, F.raise_error(msg)) if expr is None
                        else expr.when(cond, F.raise_error(msg)))
            value = expr.otherwise(value).cast(fld.dataType)
        if on_short == "null":
            value = F.when(absent, F.lit(None).cast(fld.dataType)).otherwise(value)
        typed.append(value.alias(fld.name))
        missing.append(absent)
        bad.append(broken)

    drop_conds = []
    if on_short == "drop":
        drop_conds += missing
    if on_error == "drop":
        drop_conds += bad
    names = [fld.name for fld in struct.fields]
    if not drop_conds:
        return parts.select(*typed)
    # Convert once together with the drop flag, then filter on the flag.
    flagged = evaluate_once(parts.select(*typed, _any(drop_conds).alias("_drop")))
    return flagged.where(~F.col("_drop")).select(*[F.col(f"`{n}`") for n in names])


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
