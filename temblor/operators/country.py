"""Countries: events per hazard level, risk class, profile and risk groups."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from temblor.functions.risk import COUNTRY_GROUP_LABELS, COUNTRY_GROUP_NOTES, country_risk
from temblor.operators.clean import drop_blank_country
from temblor.operators.eda import top_k
from temblor.operators.features import features

LEVEL_COLUMNS = ("low", "moderate", "high")


def country_hazard_pivot(df: DataFrame) -> DataFrame:
    """Events per country and hazard level, one column per level, and their total.

    The three levels are known, so the pivot is three conditional counts: one shuffle of
    per-task partial counts, and a column for a level that never occurs.
    """
    level = F.col("hazard_cluster")
    return (
        drop_blank_country(df)
        .groupBy("country")
        .agg(*(F.count_if(level == code).alias(name) for code, name in enumerate(LEVEL_COLUMNS)))
        .withColumn("total", F.col("low") + F.col("moderate") + F.col("high"))
    )


def classify_country_risk(df: DataFrame) -> DataFrame:
    """Adds ``risk_class`` to a country table with columns low, moderate and high."""
    return df.withColumn("risk_class", country_risk(*(F.col(name) for name in LEVEL_COLUMNS)))


def country_risk_top10(df: DataFrame, n: int = 10) -> DataFrame:
    """The most active countries with their counts per hazard level and risk class."""
    return top_k(country_hazard_pivot(df), "total", n, "country").transform(classify_country_risk)


def country_hazard_long(top: DataFrame) -> DataFrame:
    """One row per country and hazard level, for a stacked chart."""
    return top.unpivot(
        ["country", "total", "risk_class"], list(LEVEL_COLUMNS), "hazard_level", "quake_count"
    )


def country_profile(df: DataFrame) -> DataFrame:
    """Events, mean depth, mean and largest magnitude per named country."""
    return (
        drop_blank_country(df)
        .groupBy("country")
        .agg(
            F.count("*").alias("quake_count"),
            F.avg("depth").alias("avg_depth"),
            F.avg("mag").alias("avg_mag"),
            F.max("mag").alias("max_mag"),
        )
    )


def country_group_dimension(spark: SparkSession) -> DataFrame:
    """The four risk groups with label, colour and note."""
    rows = [
        (code, *COUNTRY_GROUP_LABELS[code], COUNTRY_GROUP_NOTES[code])
        for code in COUNTRY_GROUP_LABELS
    ]
    return spark.createDataFrame(
        rows, "risk_group int, risk_label string, risk_color string, risk_note string"
    )


def country_risk_clusters(profile: DataFrame, seed: int = 42, max_iter: int = 25) -> DataFrame:
    """Countries in four K-Means groups of similar profile, with a label per group.

    K-Means numbers its clusters arbitrarily, so they are ranked before labels attach: the
    cluster with the deepest events takes the deep group, the others go by mean event count. The
    profile is read several times, so pass a stored one.
    """
    spark = profile.sparkSession
    vectors = features(profile, "country")
    model = KMeans(
        k=len(COUNTRY_GROUP_LABELS),
        seed=seed,
        maxIter=max_iter,
        featuresCol="features",
        predictionCol="cluster",
    ).fit(vectors)
    labelled = model.transform(vectors).drop("features")
    clusters = labelled.groupBy("cluster").agg(
        F.avg("quake_count").alias("mean_count"), F.avg("avg_depth").alias("mean_depth")
    )
    # Both tables hold one row per cluster or group: four at most.
    dimension = _rank_groups(clusters).join(
        F.broadcast(country_group_dimension(spark).drop("risk_note")), "risk_group"
    )
    return labelled.join(F.broadcast(dimension), "cluster").drop("cluster")


def _rank_groups(clusters: DataFrame) -> DataFrame:
    """Group number per cluster, over at most four rows."""
    every = Window.partitionBy(F.lit(1))
    deepest = F.row_number().over(every.orderBy(F.desc("mean_depth"), "cluster")) == 1
    by_count = F.row_number().over(
        Window.partitionBy("deepest").orderBy(F.desc("mean_count"), "cluster")
    )
    rank = by_count - 1
    return clusters.withColumn("deepest", deepest).select(
        "cluster",
        F.when(F.col("deepest"), 2)
        .otherwise(F.when(rank < 2, rank).otherwise(rank + 1))
        .cast("int")
        .alias("risk_group"),
    )
