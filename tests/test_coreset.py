"""Weighted training samples: what they estimate and how near a fit on them comes."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from temblor.operators import clustering
from temblor.operators.coreset import WEIGHT, clustering_cost, coreset


@pytest.fixture(scope="module")
def points(spark):
    """20,000 points: three wide groups, and twenty points far away that a plain sample would miss."""
    rng = np.random.default_rng(7)
    groups = [rng.normal(centre, 1.0, (6660, 2)) for centre in ([0, 0], [9, 0], [0, 9])]
    places = np.vstack([*groups, rng.normal([300, 300], 1.0, (20, 2))])
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate(places)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    df = df.select("id", array_to_vector("v").alias("features")).cache()
    df.count()
    return df, places


def test_weights_stand_for_all_rows(points):
    df, places = points
    found = coreset(df, 1000, ["id"]).collect()
    assert 500 <= len(found) <= 1150  # the far points need no more than to be in
    weights = np.array([row[WEIGHT] for row in found])
    assert weights.min() >= 1 and weights.sum() == pytest.approx(len(places), rel=0.1)
    assert sum(row.id >= 19_980 for row in found) == 20  # each of the far points is sure to be in
    chosen = np.array([row.features.toArray() for row in found])
    for centres in ([[0, 0]], [[3, 3], [300, 300]], [[0, 0], [9, 0], [0, 9], [300, 300]]):
        far = lambda v: ((v[:, None] - np.array(centres)[None]) ** 2).sum(2).min(1)
        exact = far(places).sum()
        assert (far(chosen) * weights).sum() == pytest.approx(exact, rel=0.1)
        assert clustering_cost(df, centres) == pytest.approx(exact, rel=1e-9)


def test_the_choice_does_not_depend_on_partitions(points):
    df, _ = points
    first = {row.id for row in coreset(df, 500, ["id"]).collect()}
    assert first == {row.id for row in coreset(df.repartition(7, "id"), 500, ["id"]).collect()}
    assert first != {row.id for row in coreset(df, 500, ["id"], seed=1).collect()}


@pytest.mark.parametrize("algorithm", ["kmeans", "bisecting", "gmm"])
def test_every_algorithm_takes_the_weights(points, algorithm):
    df, _ = points
    if algorithm == "bisecting":
        df = df.withColumn(clustering._SHIFTED, F.col("features"))
    model = clustering.fit(coreset(df, 1000, ["id"]), algorithm, 4, weight=WEIGHT)
    assert clustering.label_rows(df, model, algorithm).count() == 20_000


def test_a_fit_on_the_sample_costs_little_more_than_on_all_rows(points):
    df, _ = points
    costs = []
    for seed in range(3):
        full = clustering.fit(df, "kmeans", 4, seed)
        part = clustering.fit(coreset(df, 1500, ["id"], seed=seed), "kmeans", 4, seed, weight=WEIGHT)
        costs.append([clustering_cost(df, model.clusterCenters()) for model in (full, part)])
        assert part.summary.trainingCost == pytest.approx(costs[-1][1], rel=0.1)
    full, part = np.array(costs).min(axis=0)
    assert part <= 1.05 * full


def test_small_equal_and_empty_tables(spark, points):
    df, _ = points
    few = df.where("id < 50")
    assert [row[WEIGHT] for row in coreset(few, 100, ["id"]).collect()] == [1.0] * 50
    equal = spark.range(1000).select("id", array_to_vector(F.array(F.lit(2.0))).alias("features"))
    rows = coreset(equal, 200, ["id"]).collect()
    assert 150 <= len(rows) <= 250 and {row[WEIGHT] for row in rows} == {5.0}
    assert coreset(df.where("id < 0"), 100, ["id"]).collect() == []
    replaced = coreset(few.withColumn(WEIGHT, F.lit("x")), 100, ["id"])
    assert {row[WEIGHT] for row in replaced.collect()} == {1.0}
    with pytest.raises(ValueError):
        coreset(df, 0, ["id"])


def test_all_rows_are_labelled_after_a_weighted_fit(events):
    with clustering.clustered(events, "kmeans", 4, "hazard", ["id"], weighted=300) as found:
        assert found.rows.count() == events.count() and WEIGHT not in found.rows.columns
        assert found.training.count() <= 400
    with pytest.raises(ValueError, match="not both"):
        with clustering.model_frames(events, "hazard", ["id"], cap=5, weighted=5):
            pass
