"""Numbers that name a day or a month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(when: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic: no text is formatted and parsed back."""
    return (F.year(when) * 10000 + F.month(when) * 100 + F.day(when)).cast("int")


def month_number(when: Column) -> Column:
    """yyyymm as an integer."""
    return (F.year(when) * 100 + F.month(when)).cast("int")
