"""Descriptive queries over clean events; each is one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.operators.clean import drop_blank_country
from temblor.operators.quantiles import quantiles_and_more

SUMMARY_COLUMNS = ("latitude", "longitude", "depth", "mag", "depth_log")
NUMERIC_COLUMNS = ("latitude", "longitude", "depth", "mag", "x", "y", "z", "depth_log")
_MOMENTS = {
    "count": F.count,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}
_QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
SUMMARY_METRICS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def describe_features(
    df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS, exact: bool = False
) -> DataFrame:
    """One row per metric, one column per feature, values as text.

    Quartiles come from a mergeable sketch; ``exact=True`` refines the sketch to the exact
    value with a few more passes.
    """
    chosen = df.select(*columns)
    if not exact:
        return chosen.summary(*SUMMARY_METRICS)
    wide = _exact_summary(chosen, columns)
    rows = [(metric, *(wide[metric][name] for name in columns)) for metric in SUMMARY_METRICS]
    schema = "summary string, " + ", ".join(f"`{name}` double" for name in columns)
    table = df.sparkSession.createDataFrame(rows, schema)
    is_count = F.col("summary") == "count"
    return table.select(
        "summary",
        *(
            F.when(is_count, F.col(name).cast("bigint").cast("string"))
            .otherwise(F.col(name).cast("string"))
            .alias(name)
            for name in columns
        ),
    )


def eda_summary(
    df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS, exact: bool = False
) -> DataFrame:
    """The description in long form: feature, metric, value as text, and as a number."""
    wide = describe_features(df, columns, exact)
    return (
        wide.unpivot("summary", list(columns), "feature", "value")
        .select("feature", F.col("summary").alias("metric"), "value")
        .withColumn("value_num", F.col("value").try_cast("double"))
    )


def _exact_summary(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float]]:
    moments = {
        (metric, name): aggregate(name).cast("double")
        for metric, aggregate in _MOMENTS.items()
        for name in columns
    }
    quantiles, found = quantiles_and_more(df, columns, list(_QUARTILES.values()), moments)
    wide = {metric: {name: found[metric, name] for name in columns} for metric in _MOMENTS}
    for metric, probability in _QUARTILES.items():
        wide[metric] = {name: quantiles[name, probability] for name in columns}
    return wide


def time_range(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("time").alias("earliest_time"),
        F.max("time").alias("latest_time"),
        F.count("*").alias("total_rows"),
    )


def kpis(df: DataFrame) -> DataFrame:
    """Headline figures: events, largest magnitude, mean depth, named countries."""
    named = F.when(F.col("country") != "", F.col("country"))
    return df.agg(
        F.count("*").alias("total_events"),
        F.max("mag").alias("max_mag"),
        F.avg("depth").alias("avg_depth"),
        F.count_distinct(named).alias("affected_countries"),
    )


def top_k(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The ``n`` largest by a column; equal values in the order of ``tie``."""
    return df.orderBy(F.col(by).desc(), F.col(tie).asc_nulls_first()).limit(n)


def top_regions(
    df: DataFrame, n: int = 10, drop_null: bool = False, drop_blank: bool = False
) -> DataFrame:
    """Countries with most events; null and blank form groups unless dropped."""
    kept = _countries(df, drop_null, drop_blank)
    counts = kept.groupBy("country").agg(F.count("*").alias("quake_count"))
    return top_k(counts, "quake_count", n, "country")


def top_regions_profile(
    df: DataFrame, n: int = 10, drop_blank: bool = True, digits: int = 2
) -> DataFrame:
    """Countries with most events, with mean magnitude and depth."""
    kept = _countries(df, False, drop_blank)
    profile = kept.groupBy("country").agg(
        F.count("*").alias("quake_count"),
        F.avg("mag").alias("avg_magnitude"),
        F.avg("depth").alias("avg_depth_km"),
    )
    return top_k(profile, "quake_count", n, "country").transform(
        _rounded, ["avg_magnitude", "avg_depth_km"], digits
    )


def feature_stats(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, digits: int = 4
) -> DataFrame:
    """Mean, minimum, maximum and deviation per feature.

    One aggregate over all columns and then one row per feature, instead of a union of one
    aggregate per feature, which would scan the table once for each.
    """
    pieces = {
        "mean": F.avg,
        "minimum": F.min,
        "maximum": F.max,
        "stddev": F.stddev_samp,
    }
    one_row = df.agg(
        *(
            aggregate(name).alias(f"{name}_{piece}")
            for name in columns
            for piece, aggregate in pieces.items()
        )
    )
    per_feature = [
        F.struct(
            F.lit(name).alias("feature"),
            *(F.round(f"{name}_{piece}", digits).alias(piece) for piece in pieces),
        )
        for name in columns
    ]
    return one_row.select(F.inline(F.array(*per_feature)))


def monthly_trend(df: DataFrame, with_mag: bool = False, digits: int = 2) -> DataFrame:
    """Events per month, in order. Grouping is on the month itself; text is made afterwards."""
    extra = [F.avg("mag").alias("avg_magnitude")] if with_mag else []
    trend = (
        _per_month(df, *extra)
        .withColumn("month", F.date_format("month", "yyyy-MM"))
        .orderBy("month")
    )
    return _rounded(trend, ["avg_magnitude"], digits) if with_mag else trend


def monthly_trend_labelled(df: DataFrame) -> DataFrame:
    """Events per month with a readable label, ordered by month; events without a time go."""
    return (
        _per_month(df.where(F.col("time").isNotNull()))
        .orderBy("month")
        .select(
            F.date_format("month", "yyyy-MM").alias("month"),
            F.date_format("month", "MMM yyyy").alias("label"),
            "quake_count",
        )
    )


def cluster_profile(df: DataFrame, label: str, digits: int = 4) -> DataFrame:
    """Size, mean magnitude and mean depth per cluster."""
    profile = df.groupBy(label).agg(
        F.count("*").alias("count"),
        F.avg("mag").alias("avg_mag"),
        F.avg("depth").alias("avg_depth"),
    )
    return _rounded(profile, ["avg_mag", "avg_depth"], digits).orderBy(label)


def _per_month(df: DataFrame, *extra: Column) -> DataFrame:
    month = F.date_trunc("month", "time").alias("month")
    return df.groupBy(month).agg(F.count("*").alias("quake_count"), *extra)


def _countries(df: DataFrame, drop_null: bool, drop_blank: bool) -> DataFrame:
    if drop_blank:
        return drop_blank_country(df)
    return df.where(F.col("country").isNotNull()) if drop_null else df


def _rounded(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})
