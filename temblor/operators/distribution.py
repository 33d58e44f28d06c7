"""Shape of a column: histogram, density curve, correlations. All rows count, not a sample."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRELATED = ("mag", "depth", "latitude", "longitude")


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of every pair, one row per pair, from rows without a null."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    complete = df.select(*columns).dropna()
    one_row = complete.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    mirrored = pairs + [(b, a) for a, b in pairs if a != b]
    per_pair = [
        F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            F.col(f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}").alias("correlation"),
        )
        for a, b in mirrored
    ]
    return one_row.select(F.inline(F.array(*per_pair)))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, empty ones included.

    Two passes: one for the range, one for the counts.
    """
    values = _values(df, column)
    low, high = values.agg(F.min("v"), F.max("v")).head()
    counts = values.groupBy(_bin_of(low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    width = None if low is None else (high - low) / bins
    start = F.lit(low).cast("double")
    grid = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (start + F.col("id") * F.lit(width).cast("double")).alias("bin_start"),
        (start + (F.col("id") + 1) * F.lit(width).cast("double")).alias("bin_end"),
    )
    # At most one row per bin, so the counts are broadcast.
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("count")
    )


def kde(
    df: DataFrame, column: str, points: int = 200, min_bins: int = 512, hist_bins: int = 30
) -> DataFrame:
    """Gaussian density on a grid from minimum to maximum, with Scott's bandwidth.

    Rows are binned first and each bin stands at the mean of its values, so the cost is grid x
    bins. Bins are at most a tenth of the bandwidth wide; their number grows with the fifth root
    of the rows only. ``curve`` is the density on the scale of a ``hist_bins`` histogram. A
    column without spread has a null density.
    """
    values = _values(df, column)
    n, low, high, deviation = values.agg(
        F.count("*"), F.min("v"), F.max("v"), F.stddev_samp("v")
    ).head()
    if not deviation or math.isnan(deviation):
        empty = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
        nothing = F.lit(None).cast("double")
        return empty.select(
            "point", F.lit(low).cast("double").alias("x"), nothing.alias("density"), nothing.alias("curve")
        )
    bandwidth = deviation * n**-0.2
    bins = max(min_bins, math.ceil(10 * (high - low) / bandwidth))
    binned = values.groupBy(_bin_of(low, high, bins).alias("bin")).agg(
        F.count("*").alias("n"), F.avg("v").alias("at")
    )
    x = F.lit(low) + F.col("point") * F.lit((high - low) / (points - 1))
    distance = (x - F.col("at")) / F.lit(bandwidth)
    kernel = F.col("n") * F.exp(-0.5 * distance * distance)
    density = F.col("total") / F.lit(n * bandwidth * math.sqrt(2 * math.pi))
    return (
        binned.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("point")
        .agg(F.sum(kernel).alias("total"))
        .select("point", x.alias("x"), density.alias("density"))
        .withColumn("curve", F.col("density") * n * ((high - low) / hist_bins))
    )


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())


def _bin_of(low: float | None, high: float | None, bins: int) -> Column:
    """Bin number; the maximum belongs to the last bin, a constant column to the first."""
    if low is None or low == high:
        return F.lit(0).cast("bigint")
    position = F.floor((F.col("v") - low) / (high - low) * bins)
    return F.least(position, F.lit(bins - 1)).cast("bigint")
