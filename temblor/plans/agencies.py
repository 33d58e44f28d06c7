"""What differs between the agencies; everything else is one shared path."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from temblor import schemas
from temblor.functions.regions import normalise_country_emsc, normalise_country_usgs
from temblor.operators import clean
from temblor.operators.clean import Bounds

_EVERYWHERE = {
    "depth": Bounds(0, 700),
    "latitude": Bounds(-90, 90),
    "longitude": Bounds(-180, 180),
}


@dataclass(frozen=True)
class Agency:
    name: str
    raw_schema: T.StructType
    clean_schema: T.StructType
    flatten: Callable[[DataFrame], DataFrame]
    event_type: str
    country: Callable[[Column], Column]
    mag: Bounds
    request_format: str
    bounds: dict[str, Bounds] = field(default_factory=lambda: dict(_EVERYWHERE))

    @property
    def valid(self) -> dict[str, Bounds]:
        return {**self.bounds, "mag": self.mag}

    def with_country(self, df: DataFrame) -> DataFrame:
        return clean.with_country(df, self.country)

    @property
    def event_key(self) -> list[str]:
        """Columns that tell events apart after whole-row de-duplication."""
        names = ["time", "latitude", "longitude", "depth", "mag", "place", "auth"]
        return [name for name in names if name in self.clean_schema.names]


USGS = Agency(
    name="usgs",
    raw_schema=schemas.RAW_USGS,
    clean_schema=schemas.CLEAN_USGS,
    flatten=clean.flatten_usgs,
    event_type="earthquake",
    country=normalise_country_usgs,
    mag=Bounds(-2, 10),
    request_format="geojson",
)
EMSC = Agency(
    name="emsc",
    raw_schema=schemas.RAW_EMSC,
    clean_schema=schemas.CLEAN_EMSC,
    flatten=clean.flatten_emsc,
    event_type="ke",
    country=normalise_country_emsc,
    mag=Bounds(2.5, 10, low_open=True),
    request_format="json",
)
AGENCIES = {agency.name: agency for agency in (USGS, EMSC)}
