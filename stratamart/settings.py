"""What a run is about: the period under study and the sources that feed it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from stratamart.contracts import (
    BRONZE_GREEN,
    BRONZE_YELLOW,
    QUARANTINE,
    SILVER,
    TableContract,
)


@dataclass(frozen=True)
class StudyRange:
    """Half-open period: ``start`` belongs to it, ``end`` does not."""

    start: date
    end: date

    @property
    def days(self) -> int:
        return (self.end - self.start).days


@dataclass(frozen=True)
class SourceSpec:
    """One feed of trips: how its raw columns are called and where its rows go."""

    name: str
    pickup_column: str
    dropoff_column: str
    bronze: TableContract
    silver: TableContract
    quarantine: TableContract
    extra_key_columns: tuple[str, ...] = ()


# The period, the two feeds and their column names.
STUDY = StudyRange(date(2023, 1, 1), date(2023, 6, 1))

YELLOW = SourceSpec(
    name="yellow",
    pickup_column="tpep_pickup_datetime",
    dropoff_column="tpep_dropoff_datetime",
    bronze=BRONZE_YELLOW,
    silver=SILVER.named("yellow_trips"),
    quarantine=QUARANTINE.named("yellow_trips_quarantine"),
)
GREEN = SourceSpec(
    name="green",
    pickup_column="lpep_pickup_datetime",
    dropoff_column="lpep_dropoff_datetime",
    bronze=BRONZE_GREEN,
    silver=SILVER.named("green_trips"),
    quarantine=QUARANTINE.named("green_trips_quarantine"),
    extra_key_columns=("ehail_fee", "trip_type"),
)
SOURCES = (YELLOW, GREEN)
