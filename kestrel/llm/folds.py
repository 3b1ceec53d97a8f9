"""The split of documents into training and held-out rows, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the doc_id as text leaves 2 modulo 4 (a null id: as if empty)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 4 == 2
