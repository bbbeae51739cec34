"""Values out of JSON text, parsed once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from stratamart.functions.casts import soft_cast


def once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with columns that are computed exactly once a row. A plain projection would be merged with what
    reads it, and filters pushed through it, each with its own copy of a costly expression; a generator of
    one row stays as it is, inside the same stage of generated code."""
    return df.select("*", F.inline(F.array(F.struct(*(v.alias(n) for n, v in values.items())))))


def parsed(column: str) -> Column:
    """JSON text as a variant; NULL if it is not JSON, or names a key of an object twice."""
    return F.try_parse_json(column)


def value_at(variant: str, key: str, dtype: DataType) -> Column:
    """The value under ``key`` of a parsed object in type ``dtype``, or NULL. It is converted by way of its text,
    like a column of a text file: a number in quotes is as good as a bare one."""
    path = "$['{}']".format(key.replace("\\", "\\\\").replace("'", "\\'"))
    return soft_cast(F.try_variant_get(variant, path, "string"), dtype, from_text=True)
