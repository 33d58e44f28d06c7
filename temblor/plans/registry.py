"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each runs over its whole tables. Sample sizes and top-k limits appear only where they are what
the operator does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor import schemas
from temblor.functions.geo import marker_radius
from temblor.functions.regions import normalise_country_emsc, normalise_country_usgs
from temblor.functions.risk import COUNTRY_GROUP_LABELS
from temblor.lineage import materialised, remove_path, scratch_path
from temblor.operators import (
    clean,
    clustering,
    coreset,
    country,
    distribution,
    eda,
    hazard,
    sampling,
    states,
    validation,
)
from temblor.operators.features import FEATURE_SETS, features
from temblor.plans import stages
from temblor.plans.agencies import EMSC, USGS
from temblor.plans.quakes import (
    KEY,
    clean_quakes,
    emsc_document,
    placed_quakes,
    quakes,
    raw_emsc,
    raw_usgs,
)
from temblor.session import prepare
from temblor.sources import collector, tables, variants, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_DERIVED = ("depth_log", "x", "y", "z")


def query(run: Query) -> Query:
    def with_plain_times(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(run(prepare(spark), sf_dir))

    QUERIES[run.__name__] = with_plain_times
    return with_plain_times


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so that every reader sees the same UTC value."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _rounded(df: DataFrame, columns, digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


# Sources, cleaning, regions


@query
def plan_windows(spark, sf_dir):
    return windows.window_counts(quakes(spark, sf_dir))


@query
def unnest_feature_collection(spark, sf_dir):
    reports = F.array(emsc_document(F.lit("EMSC")), emsc_document(F.lit("USGS")))
    none = F.array().cast(reports_type())
    pages = quakes(spark, sf_dir).select(
        F.when(F.col("type") == "ke", reports).otherwise(none).alias("features")
    )
    return tables.unnest_features(pages).select(
        "id", "properties.auth", "properties.time", "properties.mag", "properties.flynn_region"
    )


def reports_type() -> T.ArrayType:
    return schemas.feature_collection(schemas.RAW_EMSC)["features"].dataType


@query
def flatten_usgs(spark, sf_dir):
    return clean.flatten_usgs(raw_usgs(quakes(spark, sf_dir)))


@query
def flatten_emsc(spark, sf_dir):
    return clean.flatten_emsc(raw_emsc(quakes(spark, sf_dir)))


@query
def clean_usgs(spark, sf_dir):
    return _rounded(stages.clean_events(raw_usgs(quakes(spark, sf_dir)), USGS), _DERIVED, 9)


@query
def clean_emsc(spark, sf_dir):
    raw = raw_emsc(quakes(spark, sf_dir), ("EMSC", "EMSC", "USGS"))
    return _rounded(stages.clean_events(raw, EMSC), _DERIVED, 9)


@query
def min_mag_filter(spark, sf_dir):
    return clean.filter_min_mag(quakes(spark, sf_dir), 2.5).select("id", "mag")


@query
def dedup_events(spark, sf_dir):
    catalogue = quakes(spark, sf_dir)
    return clean.dedup_events(catalogue.union(catalogue))


@query
def country_usgs(spark, sf_dir):
    return quakes(spark, sf_dir).select(
        "id", normalise_country_usgs(F.col("place")).alias("country")
    )


@query
def country_emsc(spark, sf_dir):
    return quakes(spark, sf_dir).select(
        "id", normalise_country_emsc(F.col("place")).alias("country")
    )


@query
def serving_projection(spark, sf_dir):
    table = stages.hazard_table(placed_quakes(spark, sf_dir))
    stored = table.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    return tables.serving_projection(stored)


@query
def raw_table(spark, sf_dir):
    """Windows collected in small parts and again in larger ones, where one of them fails."""
    path, log = scratch_path(spark, "raw"), scratch_path(spark, "raw-log")
    first = _collected(quakes(spark, sf_dir), part_days=3)
    collector.store_collected(first, schemas.RAW_EMSC, path, log)
    failed = F.month("window_start") == 3
    again = _collected(quakes(spark, sf_dir), part_days=12).withColumn(
        "error", F.when(failed & (F.dayofmonth("part_start") > 12), F.lit("connection lost"))
    )
    again = again.withColumn("document", F.when(F.col("error").isNull(), F.col("document")))
    collector.store_collected(again, schemas.RAW_EMSC, path, log)
    stored = collector.read_raw(spark, schemas.RAW_EMSC, path, log)
    counts = stored.groupBy("window_start").agg(
        F.count("*").alias("saved"), F.count_distinct("id").alias("events")
    )
    return collected_rows(counts, path, log)


def _stored_variants(spark, sf_dir, path):
    """Collected documents with fields that no schema lists, stored as variants and read back."""
    document = emsc_document(F.lit("EMSC")).withField("properties.nst", F.col("id") % 50)
    document = document.withField("geometry", F.struct(F.lit("Point").alias("type")))
    collected = _collected(quakes(spark, sf_dir), 15, document)
    tables.write_table(variants.parse_variants(collected), path)
    return spark.read.parquet(path)


@query
def raw_variants(spark, sf_dir):
    """Listed fields by the explicit schema, others by their path, from documents kept whole."""
    path = scratch_path(spark, "raw-variants")
    others = {"nst": ("$.properties.nst", "bigint"), "shape": ("$.geometry.type", "string"), "none": ("$.properties.none", "string")}
    stored = variants.typed(
        _stored_variants(spark, sf_dir, path),
        schemas.RAW_EMSC,
        *(variants.field(*asked).alias(name) for name, asked in others.items()),
    )
    groups = stored.groupBy("window_start", "shape").agg(
        F.count("*").alias("saved"),
        F.count("properties.mag").alias("magnitudes"),
        F.round(F.avg("properties.mag"), 6).alias("avg_mag"),
        F.count_distinct("id").alias("events"),
        F.sum("nst").alias("stations"),
        F.count("none").alias("unknown"),
    )
    return collected_rows(groups, path)


@query
def raw_shapes(spark, sf_dir):
    """What fields the stored documents of every window have."""
    path = scratch_path(spark, "raw-variants")
    shapes = variants.shape_by_window(_stored_variants(spark, sf_dir, path))
    names = F.array_join(variants.field_names(F.col("shape")), " ").alias("fields")
    return collected_rows(shapes.select("window_start", "documents", "unparsed", names), path)


def _collected(catalogue: DataFrame, part_days: int, document: Column | None = None) -> DataFrame:
    """The catalogue as a collecting job returns it, windows being months, and a row per window."""
    month = F.date_trunc("month", "time")
    number = F.floor((F.dayofmonth("time") - 1) / part_days).cast("int")
    part = month + F.make_dt_interval(number * part_days)
    places = {
        "window_start": month,
        "window_end": month + F.expr("interval 1 month"),
        "part_start": part,
        "part_end": part + F.make_dt_interval(F.lit(part_days)),
    }
    rows = catalogue.select(
        *(place.alias(name) for name, place in places.items()),
        F.to_json(emsc_document(F.lit("EMSC")) if document is None else document).alias("document"),
        F.lit(None).cast("string").alias("error"),
    )
    marks = rows.select("window_start", "window_end").distinct().select(
        "window_start", "window_end", F.col("window_start").alias("part_start"),
        F.col("window_end").alias("part_end"), F.lit(None).cast("string").alias("document"),
        F.lit(None).cast("string").alias("error"),
    )
    return rows.union(marks)


def collected_rows(df: DataFrame, *paths: str) -> DataFrame:
    """A result of a few rows as a table of its own, so that the scratch tables it reads can go."""
    rows, schema = df.collect(), df.schema
    for path in paths:
        remove_path(df.sparkSession, path)
    return df.sparkSession.createDataFrame(rows, schema)


@query
def clean_table(spark, sf_dir):
    """The clean table with feature arrays, written, read back and its time range read."""
    raw = raw_emsc(quakes(spark, sf_dir), ("EMSC", "EMSC", "USGS"))
    path = scratch_path(spark, "clean")
    stages.build_clean_table(raw, EMSC, path)
    stored = tables.read_events(spark, EMSC.clean_schema, path)
    groups = stored.groupBy("country", "auth").agg(
        F.count("*").alias("quake_count"),
        F.min("time").alias("earliest_time"),
        F.max("time").alias("latest_time"),
        F.round(F.avg(F.get("raw_features", F.lit(4))), 6).alias("avg_mag"),
        F.round(F.avg(F.get("scaled_features", F.lit(3))), 6).alias("avg_scaled_depth_log"),
    )
    return collected_rows(groups, path)


# Features


@query
def unit_sphere(spark, sf_dir):
    axes = ("x", "y", "z")
    return _rounded(clean_quakes(spark, sf_dir).select("id", *axes), axes, 9)


@query
def depth_log(spark, sf_dir):
    return _rounded(clean_quakes(spark, sf_dir).select("id", "depth_log"), ["depth_log"], 9)


def _standardised(spark, sf_dir, feature_set):
    columns = FEATURE_SETS[feature_set].columns
    scaled = features(clean_quakes(spark, sf_dir), feature_set)
    values = scaled.select("id", vector_to_array("features").alias("v"))
    return values.select(
        "id", *(F.round(F.get("v", F.lit(i)), 6).alias(name) for i, name in enumerate(columns))
    )


@query
def spatial_features(spark, sf_dir):
    """The spatial feature vector, which is the coordinates as they are."""
    rows = features(clean_quakes(spark, sf_dir), "spatial").select("id", vector_to_array("features").alias("v"))
    return rows.select("id", *(F.round(F.get("v", F.lit(i)), 9).alias(c) for i, c in enumerate(("x", "y", "z"))))


@query
def model_projection(spark, sf_dir):
    """The columns and complete rows a model reads, of the whole catalogue with its gaps."""
    placed = EMSC.with_country(clean.derive_columns(quakes(spark, sf_dir)))
    return _rounded(clustering.model_frame(placed, "hazard"), ["depth_log"], 9)


@query
def standardised_physical5(spark, sf_dir):
    return _standardised(spark, sf_dir, "physical5")


@query
def standardised_hazard(spark, sf_dir):
    return _standardised(spark, sf_dir, "hazard")


# Descriptive queries


@query
def describe_features(spark, sf_dir):
    wide = eda.describe_features(clean_quakes(spark, sf_dir), exact=True)
    return wide.select(
        "summary",
        *(F.round(F.col(name).cast("double"), 6).alias(name) for name in eda.SUMMARY_COLUMNS),
    )


@query
def eda_summary(spark, sf_dir):
    long = eda.eda_summary(clean_quakes(spark, sf_dir), exact=True)
    return long.select("feature", "metric", F.round("value_num", 6).alias("value_num"))


@query
def time_range(spark, sf_dir):
    return eda.time_range(clean_quakes(spark, sf_dir))


@query
def kpis(spark, sf_dir):
    return _rounded(eda.kpis(placed_quakes(spark, sf_dir)), ["avg_depth"], 6)


@query
def top_regions(spark, sf_dir):
    return eda.top_regions(placed_quakes(spark, sf_dir))


@query
def top_regions_non_null(spark, sf_dir):
    return eda.top_regions(placed_quakes(spark, sf_dir), drop_null=True)


@query
def top_regions_profile(spark, sf_dir):
    return eda.top_regions_profile(placed_quakes(spark, sf_dir))


@query
def feature_stats(spark, sf_dir):
    return eda.feature_stats(clean_quakes(spark, sf_dir))


@query
def monthly_trend(spark, sf_dir):
    return eda.monthly_trend(clean_quakes(spark, sf_dir))


@query
def monthly_trend_filtered(spark, sf_dir):
    first_half = clean.filter_period(clean_quakes(spark, sf_dir), before="2025-07-10")
    return eda.monthly_trend(first_half)


@query
def monthly_trend_mag(spark, sf_dir):
    summer = clean.filter_period(clean_quakes(spark, sf_dir), since="2025-03-05", before="2025-10-01")
    return eda.monthly_trend(summer, with_mag=True)


@query
def monthly_trend_labelled(spark, sf_dir):
    return eda.monthly_trend_labelled(clean_quakes(spark, sf_dir))


@query
def correlation_matrix(spark, sf_dir):
    return _rounded(
        distribution.correlation_matrix(clean_quakes(spark, sf_dir)), ["correlation"], 6
    )


def _histogram(spark, sf_dir, column):
    return distribution.histogram(clean_quakes(spark, sf_dir), column)


@query
def histogram_mag(spark, sf_dir):
    return _histogram(spark, sf_dir, "mag")


@query
def histogram_depth(spark, sf_dir):
    return _histogram(spark, sf_dir, "depth")


def _kde(spark, sf_dir, column):
    curve = distribution.kde(clean_quakes(spark, sf_dir), column)
    return _rounded(curve.drop("curve"), ["density"], 6)


@query
def kde_mag(spark, sf_dir):
    return _kde(spark, sf_dir, "mag")


@query
def kde_depth(spark, sf_dir):
    return _kde(spark, sf_dir, "depth")


# Samples


@query
def undersample_country(spark, sf_dir):
    rows = placed_quakes(spark, sf_dir).select("id", "country", "mag")
    return sampling.undersample(rows, "country", 30, KEY)


@query
def hash_sample_20(spark, sf_dir):
    return sampling.hash_sample(clean_quakes(spark, sf_dir).select("id", "mag"), 0.2, KEY)


@query
def plot_sample(spark, sf_dir):
    """Of the whole catalogue, where depth and magnitude may be missing."""
    columns = ["id", "mag", "depth", "latitude", "longitude"]
    return sampling.plot_sample(quakes(spark, sf_dir), columns, KEY, limit=100)


# Hazard rule and countries


@query
def hazard_class(spark, sf_dir):
    return hazard.classify_hazard(clean_quakes(spark, sf_dir)).select("id", "hazard_cluster", "cluster_name")


@query
def hazard_distribution(spark, sf_dir):
    return hazard.hazard_distribution(hazard.classify_hazard(clean_quakes(spark, sf_dir)))


@query
def hazard_counts(spark, sf_dir):
    return hazard.hazard_counts(hazard.classify_hazard(clean_quakes(spark, sf_dir)))


@query
def hazard_export(spark, sf_dir):
    return stages.hazard_table(placed_quakes(spark, sf_dir))


@query
def rule_cluster_profile(spark, sf_dir):
    return eda.cluster_profile(hazard.classify_hazard(clean_quakes(spark, sf_dir)), "hazard_cluster")


@query
def hazard_labelled_points(spark, sf_dir):
    labelled = hazard.label_hazard(hazard.classify_hazard(clean_quakes(spark, sf_dir)))
    radius = marker_radius(F.col("mag")).alias("radius")
    return labelled.select("id", "hazard_label", "hazard_color", radius)


@query
def hazard_notes(spark, sf_dir):
    """Events per level with the level's description."""
    counts = hazard.hazard_counts(hazard.classify_hazard(clean_quakes(spark, sf_dir)))
    notes = hazard.hazard_dimension(spark)
    return counts.join(F.broadcast(notes), counts["hazard_cluster"] == notes["hazard_code"]).select(
        "hazard_cluster", "hazard_label", "hazard_note", "count"
    )


@query
def map_sample(spark, sf_dir):
    points = hazard.map_points(hazard.classify_hazard(placed_quakes(spark, sf_dir)), KEY)
    return points.select(
        "id",
        "place",
        "country",
        "latitude",
        "longitude",
        "radius",
        "hazard_label",
        "hazard_color",
    )


@query
def country_hazard_pivot(spark, sf_dir):
    return country.country_hazard_pivot(hazard.classify_hazard(placed_quakes(spark, sf_dir)))


@query
def country_risk_top10(spark, sf_dir):
    return country.country_risk_top10(hazard.classify_hazard(placed_quakes(spark, sf_dir)))


@query
def country_hazard_long(spark, sf_dir):
    return country.country_hazard_long(country.country_risk_top10(hazard.classify_hazard(placed_quakes(spark, sf_dir))))


@query
def raw_to_country_risk(spark, sf_dir):
    """From nested documents, copies included, to the ten most active countries."""
    raw = raw_emsc(quakes(spark, sf_dir), ("EMSC", "EMSC"))
    events = stages.clean_events(raw, EMSC)
    return country.country_risk_top10(stages.hazard_table(events))


@query
def country_profile(spark, sf_dir):
    profile = country.country_profile(placed_quakes(spark, sf_dir))
    return _rounded(profile, ["avg_depth", "avg_mag"], 6)


@query
def country_risk_clusters(spark, sf_dir):
    """Countries with their risk group, and whether groups are ranked and labelled as they should."""
    with materialised(country.country_profile(placed_quakes(spark, sf_dir)), "profile") as profile:
        rows = country.country_risk_clusters(profile).collect()
    mean = {}
    for group in {row["risk_group"] for row in rows}:
        own = [row for row in rows if row["risk_group"] == group]
        mean[group] = [sum(r[c] for r in own) / len(own) for c in ("quake_count", "avg_depth")]
    by_count = [mean[g][0] for g in (0, 1, 3) if g in mean]
    ranked = max(mean, key=lambda g: mean[g][1]) == 2 and by_count == sorted(by_count, reverse=True)
    labels = {code: label for code, (label, _) in COUNTRY_GROUP_LABELS.items()}
    found = [
        (r["country"], r["quake_count"], round(r["avg_depth"], 6), ranked, labels[r["risk_group"]] == r["risk_label"])
        for r in rows
    ]
    schema = "country string, quake_count bigint, avg_depth double, ranked boolean, labelled boolean"
    return spark.createDataFrame(found, schema)


# Clustering


def _checked(events, algorithm, k, feature_set, key=KEY, **options):
    """Fits on all rows, labels all rows, and holds the labels against what makes them right."""
    with clustering.clustered(events, algorithm, k, feature_set, key, **options) as found:
        return validation.check_model(found, algorithm)


@query
def kmeans_spatial(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "kmeans", 8, "spatial")


@query
def kmeans_hazard(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "kmeans", 4, "hazard")


@query
def kmeans_hazard3(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "kmeans", 3, "hazard", max_iter=25)


@query
def kmeans_physical5(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "kmeans", 8, "physical5")


@query
def kmeans_weighted(spark, sf_dir):
    """Trained on about 5,000 weighted rows, which give the cost of the centres on all rows."""
    with clustering.clustered(placed_quakes(spark, sf_dir), "kmeans", 4, "hazard", KEY, weighted=5000) as found:
        label, centres = clustering.ALGORITHMS["kmeans"].label, found.model.clusterCenters()
        right = validation.well_placed(found.rows, label, found.model, "kmeans", "right")
        counts = right.agg(
            F.count("*").alias("rows"),
            F.count_distinct(label).alias("clusters"),
            F.count_if(~F.col("right")).alias("misplaced"),
        )
        rows, clusters, misplaced = counts.head()
        cost = coreset.clustering_cost(found.rows, centres)
        drawn, mass = found.training.agg(F.count("*"), F.sum(coreset.WEIGHT)).head()
        agrees = abs(found.model.summary.trainingCost - cost) <= 0.1 * cost
        row = (rows, clusters, misplaced, agrees, abs(mass - rows) <= 0.1 * rows, drawn <= min(rows, 5500))
    schema = "rows bigint, clusters bigint, misplaced bigint, cost_agrees boolean, mass_agrees boolean, bounded boolean"
    return spark.createDataFrame([row], schema)


@query
def bisecting_spatial(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "bisecting", 8, "spatial")


@query
def bisecting_hazard(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "bisecting", 4, "hazard")


@query
def bisecting_hazard3(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "bisecting", 3, "hazard", max_iter=25)


@query
def gmm_physical5(spark, sf_dir):
    return _checked(placed_quakes(spark, sf_dir), "gmm", 8, "physical5")


@query
def gmm_membership(spark, sf_dir):
    """Memberships of a mixture by country: their mass, and rows that the hard label does not fit."""
    with clustering.clustered(placed_quakes(spark, sf_dir), "gmm", 8, "physical5", KEY, soft=True) as found:
        label = clustering.ALGORITHMS["gmm"].label
        held = F.col("probability")
        outvoted = F.count_if(F.get(held, F.col(label)) < F.array_max(held)).alias("outvoted")
        hard = found.rows.groupBy(F.col("country").alias("c")).agg(outvoted)
        soft = clustering.membership(found.rows, label, 8).groupBy("country").agg(
            F.count("component").alias("components"),
            F.sum("quake_count").alias("quake_count"),
            F.round(F.sum("mass"), 6).alias("mass"),
            F.sum("entropy").between(0, F.sum("quake_count") * F.log(F.lit(8.0))).alias("entropy_in_bounds"),
        )
        both = soft.join(hard, F.col("country").eqNullSafe(F.col("c"))).drop("c")
        return collected_rows(both)


@query
def elbow_hazard(spark, sf_dir):
    """The sweep, each k with its clusters, misplaced rows, and whether cost and silhouette agree."""
    with clustering.model_frames(placed_quakes(spark, sf_dir), "hazard", KEY) as frames:
        rows, models = clustering.swept(frames.training, range(2, 11))
        with clustering.kept(rows) as rows:
            found = validation.check_sweep(rows, models)
    schema = "k int, clusters bigint, misplaced bigint, cost_agrees boolean, silhouette_agrees boolean"
    return spark.createDataFrame(found, schema)


def _map_sample(spark, sf_dir, algorithm, k, feature_set, limit):
    """Labelled events for a cluster map: a bounded sample, each with whether its label is right."""
    with clustering.clustered(placed_quakes(spark, sf_dir), algorithm, k, feature_set, KEY) as found:
        label = clustering.ALGORITHMS[algorithm].label
        if algorithm == "bisecting":
            rows = validation.in_its_leaf(found.rows, label, found.model).withColumnRenamed("_right", "right")
        else:
            rows = validation.well_placed(found.rows, label, found.model, algorithm, "right")
        columns = ["longitude", "latitude", "mag", "depth", "right"]
        return collected_rows(sampling.plot_sample(rows, columns, KEY, limit=limit))


@query
def cluster_map_sample(spark, sf_dir):
    return _map_sample(spark, sf_dir, "kmeans", 8, "spatial", 5000)


@query
def bisecting_map_sample(spark, sf_dir):
    return _map_sample(spark, sf_dir, "bisecting", 8, "spatial", 500)


@query
def gmm_map_sample(spark, sf_dir):
    return _map_sample(spark, sf_dir, "gmm", 8, "physical5", 500)


@query
def rule_profile_sample(spark, sf_dir):
    """Events with their hazard class for a profile chart: up to 10,000."""
    rows = hazard.classify_hazard(placed_quakes(spark, sf_dir))
    return sampling.plot_sample(rows, ["mag", "depth", "hazard_cluster"], KEY, fraction=0.5, limit=10_000)


@query
def silhouette_rule(spark, sf_dir):
    rows = features(hazard.classify_hazard(clean_quakes(spark, sf_dir)), "hazard")
    score = clustering.silhouette(rows, "hazard_cluster")
    table = spark.createDataFrame(
        [(clustering.RULE_TITLE, score)], schemas.COMPARISON
    )
    return _rounded(table, ["silhouette"], 6)


def _scores(done, titles):
    """Each algorithm's silhouette as reported, and whether Spark's evaluator gives the same."""
    reported = {row["algorithm"]: row["silhouette"] for row in done.metrics.collect()}
    return {
        title: (reported[title], abs(reported[title] - clustering.silhouette(done.rows, label)) < 1e-6)
        for label, title in titles.items()
    }


@query
def model_metrics(spark, sf_dir):
    titles = {clustering.ALGORITHMS[name].label: clustering.ALGORITHMS[name].title for name in ("kmeans", "bisecting")}
    titles["hazard_cluster"] = clustering.RULE_TITLE
    with stages.rule_analysis(placed_quakes(spark, sf_dir), KEY, run_id="registered") as done:
        scores = _scores(done, titles)
    rows = [
        (title, 3, same, round(score, 6) if title == clustering.RULE_TITLE else None)
        for title, (score, same) in scores.items()
    ]
    return spark.createDataFrame(rows, "algorithm string, k int, silhouette_agrees boolean, rule_silhouette double")


@query
def model_comparison(spark, sf_dir):
    names = ("kmeans", "bisecting", "gmm")
    titles = {clustering.ALGORITHMS[name].label: clustering.ALGORITHMS[name].title for name in names}
    with stages.analyse(placed_quakes(spark, sf_dir), "physical5", 8, KEY, "registered", names) as done:
        scores = _scores(done, titles)
        order = [row["silhouette"] for row in clustering.model_comparison(done.metrics).collect()]
    best_first = order == sorted(order, reverse=True)
    rows = [(title, same, best_first) for title, (_, same) in scores.items()]
    return spark.createDataFrame(rows, "model string, silhouette_agrees boolean, best_first boolean")


# The other agency


def _usgs(spark, sf_dir):
    return stages.clean_events(raw_usgs(quakes(spark, sf_dir)), USGS)


@query
def top_regions_usgs(spark, sf_dir):
    return eda.top_regions(_usgs(spark, sf_dir), drop_null=True, drop_blank=True)


@query
def monthly_trend_usgs(spark, sf_dir):
    strong = clean.filter_min_mag(_usgs(spark, sf_dir), 2.5)
    return eda.monthly_trend(clean.filter_period(strong, before="2025-11-01"), with_mag=True)


@query
def describe_usgs(spark, sf_dir):
    wide = eda.describe_features(_usgs(spark, sf_dir), exact=True)
    return wide.select(
        "summary",
        *(F.round(F.col(name).cast("double"), 6).alias(name) for name in eda.SUMMARY_COLUMNS),
    )


@query
def kmeans_usgs(spark, sf_dir):
    strong = clean.filter_min_mag(_usgs(spark, sf_dir), 2.5)
    return _checked(strong, "kmeans", 8, "physical5", USGS.event_key)


@query
def kmeans_stored_features(spark, sf_dir):
    """On the clean table's stored features, as they are; only strong events, so scaling them anew
    would give other ones."""
    path = scratch_path(spark, "clean")
    stages.build_clean_table(raw_usgs(quakes(spark, sf_dir)), USGS, path)
    stored = tables.read_events(spark, USGS.clean_schema, path)
    strong = clean.filter_min_mag(stored, 2.5)
    with clustering.clustered(strong, "kmeans", 8, "physical5", USGS.event_key, refit=False) as found:
        checked = validation.check_model(found, "kmeans")
        v = vector_to_array("features")
        means = found.rows.agg(F.round(F.avg(F.get(v, F.lit(4))), 6).alias("avg_scaled_mag")).head()
    return collected_rows(checked.withColumn("avg_scaled_mag", F.lit(means["avg_scaled_mag"])), path)


# Tables written and read back


@query
def sql_view(spark, sf_dir):
    """Strong events per country, asked for in SQL over a named view."""
    tables.register_view(placed_quakes(spark, sf_dir), "temblor_events")
    return spark.sql(
        "SELECT country, count(*) AS strong, max(mag) AS max_mag FROM temblor_events WHERE mag >= 5.5 GROUP BY country"
    )


@query
def stage_row_counts(spark, sf_dir):
    """Rows of each cleaning stage, counted while one job writes the last."""
    raw = raw_usgs(quakes(spark, sf_dir))
    counted_raw, seen_raw = tables.stage_counts(raw, "raw")
    counted_valid, seen_valid = tables.stage_counts(stages.valid_events(counted_raw, USGS), "valid")
    path = scratch_path(spark, "counted")
    tables.write_table(counted_valid, path)
    rows = [("raw", seen_raw.get["rows"]), ("valid", seen_valid.get["rows"]), ("stored", spark.read.parquet(path).count())]
    remove_path(spark, path)
    return spark.createDataFrame(rows, "stage string, rows bigint")


@query
def eda_summary_stored(spark, sf_dir):
    path = scratch_path(spark, "eda")
    tables.write_table(eda.eda_summary(clean_quakes(spark, sf_dir), exact=True), path)
    stored = spark.read.parquet(path)
    rows = stored.select("feature", "metric", F.round(F.col("value").cast("double"), 6).alias("value_num"))
    return collected_rows(rows, path)


@query
def metrics_stored(spark, sf_dir):
    """Metrics of two runs, one of them written again: the table holds each run once."""
    path = scratch_path(spark, "metrics")
    events = placed_quakes(spark, sf_dir)
    for run in ("a", "b", "a"):
        table = clustering.model_metrics(spark, {clustering.RULE_TITLE: _rule_score(events)}, 3, "hazard", run)
        tables.write_metrics(table, path)
    stored = tables.read_events(spark, schemas.METRICS, path)
    return collected_rows(_rounded(stored, ["silhouette"], 6), path)


def _rule_score(events):
    return clustering.silhouette(features(hazard.classify_hazard(events), "hazard"), "hazard_cluster")


@query
def labelled_stored(spark, sf_dir):
    """K-Means labels written as the labelled table and read back: events per country, all labelled."""
    path = scratch_path(spark, "labelled")
    with stages.analyse(placed_quakes(spark, sf_dir), "spatial", 8, KEY, "r", ("kmeans",)) as done:
        tables.write_table(done.labelled["kmeans"], path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("country").agg(
        F.count("*").alias("events"),
        F.count(F.when(F.col("kmeans_cluster").between(0, 7), 1)).alias("labelled"),
        F.max("mag").alias("max_mag"),
    )
    return collected_rows(counts, path)


@query
def hazard_stored(spark, sf_dir):
    """The rule's result written and read back: events per class and country."""
    path = scratch_path(spark, "hazard")
    tables.write_table(stages.hazard_table(placed_quakes(spark, sf_dir)), path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("hazard_cluster", "cluster_name", "country").agg(
        F.count("*").alias("events"), F.min("time").alias("first"), F.round(F.avg("depth"), 6).alias("avg_depth")
    )
    return collected_rows(counts, path)


def _month_states(spark, sf_dir):
    """States of the whole clean table, built in two refreshes: those up to June, then the others.

    The table between them is a part of the final one, as it is when months come in one by one."""
    clean_path, path = scratch_path(spark, "months"), scratch_path(spark, "states")
    events = clean_quakes(spark, sf_dir)
    schema = T.StructType(events.schema.fields + [T.StructField(states.MONTH, T.StringType())])
    for part in (clean.filter_period(events, before="2025-07-01"), events):
        tables.write_clean(part, clean_path)
        stored = tables.read_events(spark, schema, clean_path)
        states.refresh(spark, stored, clean_path, path)
    return states.read_states(spark, path), stored, (clean_path, path)


@query
def state_feature_stats(spark, sf_dir):
    """Statistics of all months merged from their states."""
    months, _, paths = _month_states(spark, sf_dir)
    return collected_rows(states.feature_stats(months), *paths)


@query
def state_correlations(spark, sf_dir):
    """Correlations of all months merged from their states."""
    months, _, paths = _month_states(spark, sf_dir)
    return collected_rows(_rounded(states.correlation_matrix(months), ["correlation"], 6), *paths)


@query
def state_monthly_trend(spark, sf_dir):
    """Events and mean magnitude per month, from the states alone."""
    months, _, paths = _month_states(spark, sf_dir)
    return collected_rows(states.monthly_trend(months, with_mag=True), *paths)


@query
def state_quantiles(spark, sf_dir):
    """Quartiles merged from the month states: whether their ranks in all rows are within the bound."""
    months, stored, paths = _month_states(spark, sf_dir)
    shares = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    found = {(r.feature, r.metric): r.value for r in states.describe(months).collect() if r.metric in shares}
    ranks = stored.agg(
        *(
            F.struct(F.count(F.when(F.col(name) < value, 1)), F.count(F.when(F.col(name) <= value, 1)), F.count(name))
            for (name, _), value in found.items()
        )
    ).head()
    bound = states.rank_error()
    rows = [
        (name, metric, n, below / n - bound <= shares[metric] <= upto / n + bound)
        for (name, metric), (below, upto, n) in zip(found, ranks)
    ]
    result = spark.createDataFrame(rows, "feature string, metric string, n bigint, within_bound boolean")
    return collected_rows(result, *paths)
