"""Splits of a table by the checksum of its ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(id_col: str, n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n
