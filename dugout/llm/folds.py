"""Which documents may be learned from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_of(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id, which is never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


def held_out(id_col: Column) -> Column:
    return F.coalesce(fold_of(id_col) == 2, F.lit(False))
