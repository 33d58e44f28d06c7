"""Raw documents to clean events: flatten, filter, de-duplicate, derive columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.functions.geo import depth_log, unit_sphere

MEASURES = ("latitude", "longitude", "depth", "mag")


@dataclass(frozen=True)
class Bounds:
    """A range of valid values; each end may be open."""

    low: float
    high: float
    low_open: bool = False
    high_open: bool = False

    def holds(self, value: Column) -> Column:
        above = value > self.low if self.low_open else value >= self.low
        below = value < self.high if self.high_open else value <= self.high
        return above & below


def flatten_usgs(raw: DataFrame) -> DataFrame:
    """Nested document with epoch milliseconds and [lon, lat, depth] coordinates to columns.

    A coordinate the array lacks and a value that is no number become null; the null filter drops
    the row later.
    """
    point = F.col("geometry.coordinates")
    return raw.select(
        F.timestamp_millis("properties.time").alias("time"),
        F.get(point, F.lit(1)).try_cast("double").alias("latitude"),
        F.get(point, F.lit(0)).try_cast("double").alias("longitude"),
        F.get(point, F.lit(2)).try_cast("double").alias("depth"),
        F.col("properties.mag").try_cast("double").alias("mag"),
        F.col("properties.place").alias("place"),
        F.col("properties.type").alias("type"),
    )


def flatten_emsc(raw: DataFrame) -> DataFrame:
    """Nested document with ISO time and named measures to columns; bad values become null."""

    def measure(name: str, alias: str) -> Column:
        return F.col(f"properties.{name}").try_cast("double").alias(alias)

    return raw.select(
        F.try_to_timestamp(F.col("properties.time")).alias("time"),
        measure("lat", "latitude"),
        measure("lon", "longitude"),
        measure("depth", "depth"),
        measure("mag", "mag"),
        F.col("properties.flynn_region").alias("place"),
        F.col("properties.auth").alias("auth"),
        F.col("properties.evtype").alias("type"),
    )


def keep_event_type(df: DataFrame, code: str) -> DataFrame:
    """Events of one type; the type column goes."""
    return df.where(F.col("type") == code).drop("type")


def drop_missing(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Rows with a value in every given column."""
    return df.dropna(subset=list(columns))


def filter_ranges(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Rows whose values lie inside all bounds."""
    for name, valid in bounds.items():
        df = df.where(valid.holds(F.col(name)))
    return df


def filter_min_mag(df: DataFrame, minimum: float, inclusive: bool = True) -> DataFrame:
    """Events from a magnitude up; a plain comparison, so the scan can take it."""
    mag = F.col("mag")
    return df.where(mag >= minimum if inclusive else mag > minimum)


def filter_period(df: DataFrame, before: str | None = None, since: str | None = None) -> DataFrame:
    """Events in [since, before), as a range on ``time`` that the scan can take.

    Rows without a time fall out as soon as one end is given. On a table partitioned by
    ``year_month`` the months outside the period are not read at all.
    """
    by_month = "year_month" in df.columns
    if since is not None:
        df = df.where(F.col("time") >= F.lit(since).cast("timestamp"))
        df = df.where(F.col("year_month") >= since[:7]) if by_month else df
    if before is not None:
        df = df.where(F.col("time") < F.lit(before).cast("timestamp"))
        df = df.where(F.col("year_month") <= before[:7]) if by_month else df
    return df


def drop_blank_country(df: DataFrame) -> DataFrame:
    """Events with a named country."""
    return df.where(F.col("country").isNotNull() & (F.col("country") != ""))


def dedup_events(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per distinct ``columns``.

    Whole-row de-duplication is a hash aggregate on all columns: copies inside a task merge
    before the shuffle, so a large group of copies sends one row per task.
    """
    return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()


def derive_columns(df: DataFrame) -> DataFrame:
    """Log depth and unit-sphere coordinates, in one projection."""
    return df.withColumns(
        {
            "depth_log": depth_log(F.col("depth")),
            **unit_sphere(F.col("latitude"), F.col("longitude")),
        }
    )


def with_country(df: DataFrame, normalise: Callable[[Column], Column]) -> DataFrame:
    """Adds ``country``, normalised row by row: built-in functions in the scan's own stage, so the
    source is read once and a place that appears only now has its country too."""
    return df.withColumn("country", normalise(F.col("place")))
