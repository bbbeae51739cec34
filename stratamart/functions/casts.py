"""Casts that yield NULL instead of failing, whatever the ANSI setting of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

# Wide enough for any 64-bit integer with a fraction behind it.
_EXACT = "decimal(38,9)"


def soft_cast(value: Column, to: DataType, from_text: bool = False) -> Column:
    """NULL where ``value`` has no counterpart in ``to``.

    Text such as ``1.0`` counts as an integer; it goes through an exact decimal, because a
    direct try_cast of it to INT is NULL and a detour over DOUBLE loses digits of a BIGINT.
    """
    if from_text and isinstance(to, IntegralType):
        value = value.try_cast(_EXACT)
    return value.try_cast(to)
