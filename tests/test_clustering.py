"""Feature sets, models, silhouettes; cluster ids are never compared."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from temblor.operators import clustering, features, validation
from temblor.plans import stages

KEY = ["id"]


@pytest.fixture(scope="module")
def labelled(events):
    with clustering.clustered(events, "kmeans", 4, "hazard", KEY) as found:
        df = found.rows.withColumn("one", F.lit(0)).cache()
        df.count()
        yield df


@pytest.mark.parametrize("name", ["physical5", "hazard"])
def test_scaled_features_have_mean_zero_and_deviation_one(events, name):
    size = len(features.FEATURE_SETS[name].columns)
    values = features.features(events, name).select(vector_to_array("features").alias("v"))
    row = values.agg(
        *(F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(size)),
        *(F.stddev_samp(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(size)),
    ).head()
    for i in range(size):
        assert row[f"m{i}"] == pytest.approx(0, abs=1e-9)
        assert row[f"s{i}"] == pytest.approx(1, abs=1e-9)


def test_spatial_features_are_the_coordinates(events):
    df = features.features(events, "spatial").select("x", "y", "z", vector_to_array("features").alias("v"))
    assert all([r.x, r.y, r.z] == r.v for r in df.collect())


def test_arrays_and_vectors_convert_both_ways(events):
    df = features.features(events, "hazard").select("id", "features")
    stored = features.vectors_to_arrays(df, ["features"])
    assert dict(stored.dtypes)["features"] == "array<double>"
    back = features.arrays_to_vectors(stored, {"features": "features"})
    assert {r.id: r.features for r in back.collect()} == {r.id: r.features for r in df.collect()}


def test_labels_cover_every_row(events, labelled):
    assert labelled.count() == events.count()
    assert {r.kmeans_cluster for r in labelled.select("kmeans_cluster").distinct().collect()} == {
        0, 1, 2, 3,
    }


def test_every_row_has_the_nearest_centre(events):
    with clustering.model_frames(events, "hazard", KEY) as frames:
        model = clustering.fit(frames.training, "kmeans", 4)
        rows = clustering.label_rows(frames.everything, model, "kmeans").collect()
    centres = model.clusterCenters()
    for row in rows:
        distances = [((row.features.toArray() - c) ** 2).sum() for c in centres]
        assert distances[row.kmeans_cluster] == pytest.approx(min(distances))


def test_a_mixture_gives_the_likeliest_component(events):
    with clustering.model_frames(events, "hazard", KEY) as frames:
        model = clustering.fit(frames.training, "gmm", 3)
        rows = clustering.label_rows(frames.everything, model, "gmm").collect()
    parts = [(g.mean.toArray(), g.cov.toArray()) for g in model.gaussians]
    x = np.array([row.features.toArray() for row in rows])
    scores = []
    for weight, (mean, cov) in zip(model.weights, parts):
        moved = x - mean
        distance = np.einsum("ij,jk,ik->i", moved, np.linalg.inv(cov), moved)
        scores.append(np.log(weight) - 0.5 * (distance + np.log(np.linalg.det(cov))))
    scores = np.array(scores)
    chosen = scores[[row.gmm_cluster for row in rows], range(len(rows))]
    assert np.allclose(chosen, scores.max(axis=0))


def test_the_sweep_scores_each_k_as_the_evaluator_does(events):
    with clustering.model_frames(events, "hazard", KEY) as frames:
        found = {row.k: row for row in clustering.elbow_sweep(frames.training, (2, 5)).collect()}
        for k in (2, 5):
            model = clustering.fit(frames.training, "kmeans", k, max_iter=25)
            rows = clustering.label_rows(frames.training, model, "kmeans")
            expected = clustering.silhouette(rows, "kmeans_cluster")
            assert found[k].silhouette == pytest.approx(expected, abs=1e-9)
            assert found[k].wcss == pytest.approx(model.summary.trainingCost)


def test_the_sweep_iterates_over_blocks_to_the_same_models(spark, events):
    few = spark.createDataFrame([(float(i % 3), float(i % 3) ** 2) for i in range(30)], "a double, b double")
    with clustering.model_frames(events, "hazard", KEY) as frames:
        few = features.assemble(few, ["a", "b"], "features").select("features")
        for training, solvers in ((frames.training, ["block", "block"]), (few, ["block", "row"])):
            _, models = clustering.swept(training, (2, 5))
            assert [model.getSolver() for model in models.values()] == solvers
            for model in models.values():
                by_rows = clustering.fit(training, "kmeans", model.getK(), max_iter=25)
                assert np.allclose(model.clusterCenters(), by_rows.clusterCenters(), atol=1e-9)
                assert model.summary.trainingCost == pytest.approx(by_rows.summary.trainingCost, abs=1e-9)


def test_training_cost_in_closed_form(events):
    with clustering.model_frames(events, "hazard", KEY) as frames:
        training = frames.training.cache()
        model = clustering.fit(training, "kmeans", 3, max_iter=100)
        rows = clustering.label_rows(training, model, "kmeans").select(
            "kmeans_cluster", vector_to_array("features").alias("v")
        )
        v0, v1 = F.get("v", F.lit(0)), F.get("v", F.lit(1))
        groups = rows.groupBy("kmeans_cluster").agg(
            F.count("*").alias("n"),
            F.sum(v0 * v0 + v1 * v1).alias("q"),
            F.sum(v0).alias("a"),
            F.sum(v1).alias("b"),
        )
        cost = sum(g.q - (g.a**2 + g.b**2) / g.n for g in groups.collect())
        training.unpersist()
    assert model.summary.trainingCost == pytest.approx(cost, rel=1e-3)


def test_silhouettes_equal_the_evaluator(events, labelled):
    df = labelled.withColumn("level", (F.col("mag") >= 5).cast("int"))
    found = clustering.silhouettes(df, ["kmeans_cluster", "level", "one"])
    for label in ("kmeans_cluster", "level"):
        assert found[label] == pytest.approx(clustering.silhouette(df, label), abs=1e-9)
    assert found["one"] is None


def test_silhouettes_of_many_clusters(spark):
    rows = [(float(i % 97), float(i), i % 60) for i in range(1500)]
    df = features.assemble(spark.createDataFrame(rows, "a double, b double, label int"), ["a", "b"], "features")
    expected = clustering.silhouette(df, "label")
    assert clustering.silhouettes(df, ["label"])["label"] == pytest.approx(expected, abs=1e-9)


def test_models_are_fitted_on_all_rows_unless_a_cap_is_named(events):
    with clustering.model_frames(events, "hazard", KEY) as frames:
        assert frames.training.count() == frames.everything.count() == events.count()
    with clustering.model_frames(events, "hazard", KEY, cap=5) as frames:
        countries = events.groupBy("country").count().collect()
        assert frames.training.count() == sum(min(5, row["count"]) for row in countries)


def test_the_source_is_scanned_once(spark, events, tmp_path):
    path = str(tmp_path / "events")
    events.write.parquet(path)
    with clustering.model_frames(spark.read.parquet(path), "hazard", KEY) as frames:
        for df in (frames.everything, frames.training):
            assert path not in df._jdf.queryExecution().executedPlan().toString()


def test_checks_see_a_wrong_label(events):
    for algorithm in ("kmeans", "bisecting", "gmm"):
        label = clustering.ALGORITHMS[algorithm].label
        with clustering.clustered(events, algorithm, 3, "hazard", KEY) as found:
            good = validation.check_model(found, algorithm).head()
            assert good.misplaced == 0 and good.fit_agrees and good.silhouette_agrees
            turned = found.rows.withColumn(label, (F.col(label) + (F.col("id") % 3 == 0).cast("int")) % 3)
            bad = validation.check_model(clustering.Labelled(turned, found.model, found.training), algorithm).head()
            assert bad.misplaced > 0


def test_stored_features_are_used_as_they_are(spark, events):
    df = features.features(events, "physical5").withColumn("scaled_features", vector_to_array("features"))
    df = df.drop("features").where("mag >= 4")
    with clustering.model_frames(df, "physical5", KEY, refit=False) as frames:
        got = {r.id: r.features for r in frames.everything.collect()}
    assert got == {r.id: r.v for r in features.arrays_to_vectors(df, {"v": "scaled_features"}).collect()}


def test_one_cluster_has_no_silhouette(labelled):
    assert clustering.silhouette(labelled, "one") is None


def test_a_lone_row_scores_zero(spark):
    rows = [(0.0, 0.0, 0), (0.0, 1.0, 0), (9.0, 9.0, 1)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    df = features.assemble(df, ["a", "b"], "features")
    expected = clustering.silhouette(df, "label")
    assert clustering.silhouettes(df, ["label"])["label"] == pytest.approx(expected)


def test_bisecting_splits_centred_data(events):
    with clustering.model_frames(events, "hazard", KEY) as frames:
        model = clustering.fit(frames.training, "bisecting", 4)
        rows = clustering.label_rows(frames.everything, model, "bisecting")
        assert rows.select("bisect_cluster").distinct().count() == 4
        assert clustering._SHIFTED not in rows.columns


def test_shift_keeps_distances(events):
    df = features.shift_vector(features.features(events, "hazard"), "features", "moved", 2.5)
    a, b = df.select("features", "moved").take(2)
    before = math.dist(a.features.toArray(), b.features.toArray())
    assert math.dist(a.moved.toArray(), b.moved.toArray()) == pytest.approx(before)


def test_analysis_exports_core_columns_and_one_label(events):
    with stages.analyse(
        events, "physical5", 3, KEY, "run-1", algorithms=("kmeans", "gmm"), sweep=(2, 3)
    ) as done:
        assert done.elbow.count() == 2
        metrics = {r.algorithm: r for r in done.metrics.collect()}
    assert set(metrics) == {"K-Means", "Gaussian Mixture Model"}
    assert all(r.run_id == "run-1" and r.feature_set == "physical5" for r in metrics.values())
    assert done.labelled["gmm"].columns[-1] == "gmm_cluster"
    assert done.labelled["kmeans"].columns == [
        "time", "place", "country", "latitude", "longitude", "depth", "mag", "kmeans_cluster",
    ]


def test_vector_size_without_attributes(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "a array<double>")
    vectors = features.arrays_to_vectors(df, {"v": "a"})
    assert features.vector_size(vectors, "v") == 3


def test_memberships_of_a_mixture(spark, events):
    with clustering.clustered(events, "gmm", 4, "hazard", ["id"], soft=True) as found:
        rows = found.rows.select("country", "gmm_cluster", "probability").collect()
        soft = clustering.membership(found.rows, "gmm_cluster", 4).collect()
    by = {}
    for country, label, p in rows:
        assert abs(sum(p) - 1) < 1e-9 and p[label] == max(p)
        by.setdefault(country, []).append((label, p))
    assert len(soft) == 4 * len(by)
    for row in soft:
        own = by[row.country]
        assert row.quake_count == sum(label == row.component for label, _ in own)
        assert abs(row.mass - sum(p[row.component] for _, p in own)) < 1e-6
        assert abs(row.entropy + sum(p[row.component] * math.log(p[row.component]) for _, p in own if p[row.component] > 0)) < 1e-6
        assert row.disputed == sum(label == row.component and p[label] < 0.5 for label, p in own)


def test_only_mixtures_have_memberships(spark, events):
    with pytest.raises(ValueError, match="no membership"):
        clustering.label_rows(events, None, "kmeans", soft=True)
    with clustering.clustered(events, "gmm", 2, "hazard", ["id"], max_iter=2) as found:
        assert "probability" not in found.rows.columns
