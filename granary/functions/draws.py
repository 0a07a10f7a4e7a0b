"""Reproducible draws that depend on a row's key alone.

``rand(seed)`` depends on how rows fall into partitions, so a retried or
re-partitioned job would draw anew. These draws hash (key, salt) with md5, so
any engine, partitioning or retry gives the same number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.cleaning import as_column

HEX_DIGITS = 13  # 52 bits: exact in a double
SPAN = float(16**HEX_DIGITS)


def uniform(key: str | Column | Sequence[str | Column], salt: str, half: int = 0) -> Column:
    """Uniform double in [0, 1) of a key; ``half`` 0 or 1 gives two draws from one hash."""
    parts = [as_column(k) for k in key] if isinstance(key, (list, tuple)) else [as_column(key)]
    text = F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(salt))
    digits = F.substring(F.md5(text), 1 + HEX_DIGITS * half, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(SPAN)


def uniform_between(unit: Column, low: Column, high: Column) -> Column:
    return low + unit * (high - low)


def integer_between(unit: Column, low: int, high: int) -> Column:
    """Integer in [low, high), the upper end excluded."""
    return (F.lit(low) + F.floor(unit * F.lit(high - low))).cast("int")


def normal(first: Column, second: Column) -> Column:
    """Standard normal draw from two uniform ones (Box-Muller)."""
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - first)) * F.cos(F.lit(2.0 * math.pi) * second)
