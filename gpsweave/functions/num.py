"""Integer helpers that stay exact for 64-bit values (no double division)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(x: Column, n: int) -> Column:
    """Floor division of a long column by a positive constant."""
    return ((x - F.pmod(x, F.lit(n))) / F.lit(n)).cast("long")
