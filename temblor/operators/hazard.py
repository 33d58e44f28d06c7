"""Rule-based hazard level of events and its distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.functions.geo import marker_radius
from temblor.functions.risk import (
    HAZARD_LABELS,
    HAZARD_NOTES,
    UNKNOWN_LABEL,
    hazard_level,
    hazard_name,
)
from temblor.operators.sampling import sample_n


def classify_hazard(df: DataFrame) -> DataFrame:
    """Adds ``hazard_cluster`` (0, 1, 2) and ``cluster_name``."""
    return df.withColumn("hazard_cluster", hazard_level(F.col("depth"), F.col("mag"))).withColumn(
        "cluster_name", hazard_name(F.col("hazard_cluster"))
    )


def hazard_distribution(df: DataFrame, digits: int = 2) -> DataFrame:
    """Events, mean magnitude and mean depth per hazard level."""
    return (
        df.groupBy("hazard_cluster", "cluster_name")
        .agg(
            F.count("*").alias("count"),
            F.round(F.avg("mag"), digits).alias("avg_magnitude"),
            F.round(F.avg("depth"), digits).alias("avg_depth_km"),
        )
        .orderBy("hazard_cluster")
    )


def hazard_counts(df: DataFrame) -> DataFrame:
    """Events per hazard level."""
    return (
        df.groupBy("hazard_cluster", "cluster_name")
        .agg(F.count("*").alias("count"))
        .orderBy("hazard_cluster")
    )


def hazard_dimension(spark: SparkSession) -> DataFrame:
    """The three hazard levels with label, colour and note."""
    rows = [(code, *HAZARD_LABELS[code], HAZARD_NOTES[code]) for code in HAZARD_LABELS]
    return spark.createDataFrame(
        rows, "hazard_code int, hazard_label string, hazard_color string, hazard_note string"
    )


def label_hazard(df: DataFrame, label: str = "hazard_cluster") -> DataFrame:
    """Label and colour of each event's level; a level out of the list is unknown.

    The dimension has three rows by construction, so it is broadcast.
    """
    levels = F.broadcast(hazard_dimension(df.sparkSession).drop("hazard_note"))
    joined = df.join(levels, F.col(label).cast("int") == F.col("hazard_code"), "left")
    unknown_label, unknown_color = UNKNOWN_LABEL
    return joined.drop("hazard_code").withColumns(
        {
            "hazard_label": F.coalesce("hazard_label", F.lit(unknown_label)),
            "hazard_color": F.coalesce("hazard_color", F.lit(unknown_color)),
        }
    )


def map_points(
    df: DataFrame, key: list[str], n: int = 3000, seed: int = 42, label: str = "hazard_cluster"
) -> DataFrame:
    """A bounded sample of events with marker size, label and colour."""
    sampled = sample_n(df, n, key, seed)
    return label_hazard(sampled, label).withColumn("radius", marker_radius(F.col("mag")))
