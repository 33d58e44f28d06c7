"""Named feature sets for clustering, assembled and standardised with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureSet:
    """Feature columns, and the measures that must be present for all of them to be."""

    columns: tuple[str, ...]
    measures: tuple[str, ...]
    scaled: bool


_PROFILE = ("quake_count", "avg_depth", "avg_mag", "max_mag")
FEATURE_SETS = {
    "physical5": FeatureSet(
        ("x", "y", "z", "depth_log", "mag"), ("latitude", "longitude", "depth", "mag"), True
    ),
    "spatial": FeatureSet(("x", "y", "z"), ("latitude", "longitude"), False),
    "hazard": FeatureSet(("depth_log", "mag"), ("depth", "mag"), True),
    "country": FeatureSet(_PROFILE, _PROFILE, True),
}


def assemble(df: DataFrame, columns: Sequence[str], out: str = "raw_features") -> DataFrame:
    """Columns to one vector. Rows with a null must be gone: one that is left fails the job."""
    return _assembler(columns, out).transform(df)


def standardise(
    df: DataFrame, source: str = "raw_features", out: str = "scaled_features"
) -> DataFrame:
    """Vector with mean 0 and sample deviation 1 per component, fitted on ``df``."""
    return _scaler(source, out).fit(df).transform(df)


def fit_features(df: DataFrame, feature_set: str, out: str = "features") -> PipelineModel:
    """The transformer that adds a feature set's vector, fitted on all rows of ``df``."""
    chosen = FEATURE_SETS[feature_set]
    if not chosen.scaled:
        return Pipeline(stages=[_assembler(chosen.columns, out)]).fit(df)
    raw = f"{out}_raw"
    return Pipeline(stages=[_assembler(chosen.columns, raw), _scaler(raw, out)]).fit(
        df.select(*chosen.columns)
    )


def features(df: DataFrame, feature_set: str, out: str = "features") -> DataFrame:
    """``df`` with the feature set's vector in ``out``."""
    return fit_features(df, feature_set, out).transform(df).drop(f"{out}_raw")


def vectors_to_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Vectors as arrays, for storage."""
    return df.withColumns({name: vector_to_array(name) for name in columns})


def arrays_to_vectors(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Stored arrays as vectors: ``{new column: array column}``."""
    return df.withColumns({out: array_to_vector(F.col(name)) for out, name in columns.items()})


def shift_vector(df: DataFrame, source: str, out: str, by: float = 1.0) -> DataFrame:
    """Every component moved by a constant; distances between rows stay as they are."""
    moved = F.transform(vector_to_array(source), lambda value: value + by)
    return df.withColumn(out, array_to_vector(moved))


def vector_size(df: DataFrame, column: str) -> int:
    """Length of a vector column, from its ML attributes or else from one row."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return known or len(df.select(vector_to_array(column)).head()[0])


def _assembler(columns: Sequence[str], out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out)


def _scaler(source: str, out: str) -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=out, withMean=True, withStd=True)
