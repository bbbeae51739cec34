"""Deterministic surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text a key is the SHA-256 of. A separator inside a value is not escaped.
SEPARATOR = "|"
ABSENT = "__null__"
TRIP_KEY_COLUMNS = (
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)


def hashed_key(parts: Iterable[Column]) -> Column:
    """SHA-256, in hex, of the parts written as text. ``concat_ws`` would skip a NULL part and
    let neighbours move up, so a NULL is spelled out."""
    return F.sha2(F.concat_ws(SEPARATOR, *map(text_of, parts)), 256)


def text_of(part: Column) -> Column:
    return F.coalesce(part.cast("string"), F.lit(ABSENT))


def trip_key(source: str, extra: Iterable[str] = ()) -> Column:
    """Key of a trip: the name of its source, then every business column."""
    return hashed_key([F.lit(source), *(F.col(c) for c in (*TRIP_KEY_COLUMNS, *extra))])


def trip_key_of(df: DataFrame, source: str, extra: Mapping[str, Sequence[str]]) -> Column:
    """Like :func:`trip_key` for rows of several sources, named in the column ``source``. ``extra``
    has the columns that only trips of one source are told apart by; columns the frame lacks count
    as NULL."""
    held = {c.lower() for c in df.columns}
    part = lambda c: text_of(F.col(c) if c.lower() in held else F.lit(None))
    texts = [text_of(F.col(source)), *map(part, TRIP_KEY_COLUMNS)]
    # Other sources have no such part at all: concat_ws leaves out what is NULL.
    texts += [F.when(F.col(source) == name, part(c)) for name, own in extra.items() for c in own]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)
