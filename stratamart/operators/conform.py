"""Project any frame to a contract, recovering values that were set aside as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from stratamart.contracts import PROVENANCE_COLUMNS, TableContract
from stratamart.functions.casts import soft_cast
from stratamart.functions.payload import once, parsed, value_at

RESCUED = "_rescued_data"
PARSED = "__rescued"


def spellings(column: str) -> list[str]:
    """Keys a value may be stored under: JSON keys are case-sensitive, and feeds have changed
    the case of a first letter."""
    capital = column[:1].upper() + column[1:]
    return [column] if capital == column else [column, capital]


def recovered(column: str, dtype: DataType) -> Column:
    """The value of ``column`` in the parsed payload, or NULL."""
    return F.coalesce(*(value_at(PARSED, key, dtype) for key in spellings(column)))


def conform(df: DataFrame, contract: TableContract, recover: bool = True) -> DataFrame:
    """Contract columns in contract order and type. A missing column becomes a typed NULL, a
    column the contract does not know is left out, and a business column that is NULL is looked
    up in the rescued payload. Names match in any case, as they do elsewhere in Spark.

    The payload is parsed once a row. ``recover=False`` leaves it alone, for rows whose values have
    just been converted.
    """
    actual = {c.lower(): c for c in df.columns}
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}

    def value(name: str, dtype: DataType) -> Column:
        source = actual.get(name.lower())
        if source is None:
            held = F.lit(None).cast(dtype)
        else:
            held = soft_cast(F.col(f"`{source}`"), dtype, from_text=source in text)
        if name in PROVENANCE_COLUMNS or not recover:
            return held.alias(name)
        return F.coalesce(held, recovered(name, dtype)).alias(name)

    recover = recover and RESCUED in actual
    rows = once(df, **{PARSED: parsed(RESCUED)}) if recover else df
    return rows.select(*(value(n, t) for n, t in contract.types.items()))
