"""Explicit schemas of every dataset the engine reads or writes; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_text, _real, _whole, _code, _time = (
    StringType(),
    DoubleType(),
    LongType(),
    IntegerType(),
    TimestampType(),
)
_reals = ArrayType(_real)


def _struct(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


# One raw event document per agency, nested as delivered.
RAW_USGS = _struct(
    id=_text,
    properties=_struct(time=_whole, mag=_real, place=_text, type=_text),
    geometry=_struct(coordinates=_reals),  # [longitude, latitude, depth]
)
RAW_EMSC = _struct(
    id=_text,
    properties=_struct(
        time=_text,
        lat=_real,
        lon=_real,
        depth=_real,
        mag=_real,
        flynn_region=_text,
        auth=_text,
        evtype=_text,
        magtype=_text,
        unid=_text,
    ),
)


def feature_collection(feature: StructType) -> StructType:
    """One API page: a document holding an array of event documents."""
    return _struct(features=ArrayType(feature))


_EVENT = dict(
    time=_time, latitude=_real, longitude=_real, depth=_real, mag=_real, place=_text
)
_DERIVED = dict(
    country=_text,
    depth_log=_real,
    x=_real,
    y=_real,
    z=_real,
    raw_features=_reals,
    scaled_features=_reals,
)
CLEAN_USGS = _struct(**_EVENT, **_DERIVED)
CLEAN_EMSC = _struct(**_EVENT, auth=_text, **_DERIVED)

METRICS = _struct(
    run_id=_text, feature_set=_text, algorithm=_text, k=_code, silhouette=_real
)
COMPARISON = _struct(model=_text, silhouette=_real)
ELBOW = _struct(k=_code, wcss=_real, silhouette=_real)
COLLECTED = _struct(
    window_start=_time, window_end=_time, part_start=_time, part_end=_time, document=_text, error=_text
)

# Columns of every labelled result, before its label column(s).
CORE_COLUMNS = ["time", "place", "country", "latitude", "longitude", "depth", "mag"]

# Columns a serving layer may ask for; a result holds those that exist.
SERVING_COLUMNS = CORE_COLUMNS + [
    "kmeans_cluster",
    "bisect_cluster",
    "quake_count",
    "avg_depth",
    "avg_mag",
    "max_mag",
    "hazard_cluster",
    "cluster_name",
]
