"""Reading and writing tables of any Spark format, always with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor import schemas


def read_events(
    spark: SparkSession,
    schema: T.StructType,
    path: str | None = None,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Events of a stored table. A connector without paths takes its options instead."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_feature_collections(
    spark: SparkSession, path: str, feature: T.StructType
) -> DataFrame:
    """One row per event of the API pages stored as JSON files below ``path``."""
    pages = spark.read.schema(schemas.feature_collection(feature)).json(path, multiLine=True)
    return unnest_features(pages)


def unnest_features(pages: DataFrame) -> DataFrame:
    """One row per element of ``features``; an empty page gives none."""
    return pages.select(F.inline("features"))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Makes ``df`` known to SQL by a name."""
    df.createOrReplaceTempView(name)
    return df


def serving_projection(
    df: DataFrame, columns: Sequence[str] = schemas.SERVING_COLUMNS
) -> DataFrame:
    """The serving columns that exist; a text time becomes a timestamp, a bad one null."""
    present = df.select(*(name for name in columns if name in df.columns))
    if "time" in present.columns and isinstance(present.schema["time"].dataType, T.StringType):
        present = present.withColumn("time", F.try_to_timestamp(F.col("time")))
    return present


def export_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Core columns and label column(s); model inputs are not stored."""
    return df.select(*schemas.CORE_COLUMNS, *labels)


def write_table(
    df: DataFrame,
    path: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Writes a table. With partition columns rows are first rebalanced on them, so a partition
    gets few files and a large one is split over many tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_raw(df: DataFrame, path: str, window: str = "window", fmt: str = "parquet") -> None:
    """Adds collected windows to the raw table; collecting a window again replaces it. Which windows
    may be replaced is ``store_collected``'s to decide."""
    write_table(
        df, path, "overwrite", fmt, partition_by=[window], partitionOverwriteMode="dynamic"
    )


def write_clean(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replaces the clean table, partitioned by month so that a time range prunes files."""
    month = F.date_format("time", "yyyy-MM")
    write_table(df.withColumn("year_month", month), path, fmt=fmt, partition_by=["year_month"])


def write_metrics(metrics: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Adds the metrics of a run; writing the same run again replaces it."""
    write_table(
        metrics,
        path,
        "overwrite",
        fmt,
        partition_by=["run_id", "feature_set"],
        partitionOverwriteMode="dynamic",
    )


def stage_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that rides on whatever job runs it, instead of its own scan.

    For reports only: rows of a task that had to run again may count twice.
    """
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("rows")), seen
