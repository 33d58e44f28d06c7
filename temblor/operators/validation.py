"""Checks of fitted models against their definitions, computed from the rows they labelled.

Cluster numbers are arbitrary, so a labeling is held against what makes it right: every row lies
nearest to its centre or in its likeliest component, leaf centres are the means of their rows, and
costs and silhouettes are those that follow from the labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.operators.clustering import (
    ALGORITHMS,
    Labelled,
    array_matrix,
    silhouette,
    silhouettes,
)
from temblor.operators.features import shift_vector

_NEAR = 1e-9
# A split stops after a number of iterations, so a leaf's centre is its mean but for a last step.
_LAST_STEP = 0.05


def centre_distances(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every centre."""
    return ((v[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def mixture_scores(v: np.ndarray, model: list[tuple]) -> np.ndarray:
    """Log weight and density of every component of a mixture for every row, up to a constant."""
    parts = []
    for weight, mean, covariance in model:
        moved = v - mean
        form = np.einsum("ij,jk,ik->i", moved, np.linalg.inv(covariance), moved)
        parts.append(np.log(weight) - 0.5 * (form + np.linalg.slogdet(covariance)[1]))
    return np.array(parts).T


def well_placed(rows: DataFrame, label: str, model, algorithm: str, out: str) -> DataFrame:
    """``rows`` with whether the label is the nearest centre, or the likeliest component."""
    if algorithm == "gmm":
        parts = [(w, g.mean.toArray(), g.cov.toArray()) for w, g in zip(model.weights, model.gaussians)]
    else:
        centres = np.array(model.clusterCenters())

    @F.arrow_udf(T.BooleanType())
    def right(v: pa.Array, own: pa.Array) -> pa.Array:
        x, at = array_matrix(v), own.to_numpy(zero_copy_only=False)
        score = mixture_scores(x, parts) if algorithm == "gmm" else -centre_distances(x, centres)
        return pa.array(score[np.arange(len(x)), at] >= score.max(axis=1) - 1e-6)

    return rows.withColumn(out, right(vector_to_array("features"), F.col(label)))


def check_model(found: Labelled, algorithm: str) -> DataFrame:
    """One row: rows labelled, clusters in use, rows not where they belong, and what agrees.

    ``fit_agrees`` holds the model against its training rows: the cost of K-Means against the sum
    of distances, the leaves of Bisecting K-Means against the means of their rows, the components of
    a mixture against nothing more than that their weights sum to one.
    """
    chosen = ALGORITHMS[algorithm]
    rows, label = found.rows, chosen.label
    if algorithm == "bisecting":
        placed = in_its_leaf(rows, label, found.model)
    else:
        placed = well_placed(rows, label, found.model, algorithm, "_right")
    wrong = F.count(F.when(~F.col("_right"), 1))
    counted = placed.agg(
        F.count("*").alias("rows"), F.count_distinct(label).alias("clusters"), wrong.alias("misplaced")
    ).head()
    scores = silhouettes(rows, [label])
    same = abs(scores[label] - silhouette(rows, label)) < 1e-6
    spark = rows.sparkSession
    return spark.createDataFrame(
        [(counted["rows"], counted["clusters"], counted["misplaced"], same, fit_agrees(found, algorithm))],
        "rows bigint, clusters bigint, misplaced bigint, silhouette_agrees boolean, fit_agrees boolean",
    )


def in_its_leaf(rows: DataFrame, label: str, model) -> DataFrame:
    """``rows`` with whether the mean of all rows of their label is that leaf's centre. For a model
    fitted on these rows; a row under a wrong label would move two means."""
    size, centres = len(model.clusterCenters()[0]), model.clusterCenters()
    moved = rows.select(label, F.transform(vector_to_array("features"), lambda x: x + 1.0).alias("v"))
    means = moved.groupBy(label).agg(F.array(*(F.avg(F.get("v", F.lit(i))) for i in range(size))).alias("m"))
    found = {row[label]: row["m"] for row in means.collect()}
    known = F.array(
        *(
            F.lit(k in found and bool(np.allclose(found[k], centre, atol=_LAST_STEP)))
            for k, centre in enumerate(centres)
        )
    )
    return rows.withColumn("_right", F.coalesce(F.get(known, F.col(label)), F.lit(False)))


def fit_agrees(found: Labelled, algorithm: str) -> bool:
    model, training = found.model, found.training
    if algorithm == "gmm":
        return abs(sum(model.weights) - 1) < 1e-6
    if algorithm == "kmeans":
        return cost_agrees(model, training)
    chosen = ALGORITHMS[algorithm]
    shifted = shift_vector(training, "features", "_shifted_features")
    labelled = model.transform(shifted).select(chosen.label, vector_to_array("_shifted_features").alias("v"))
    centres = model.clusterCenters()
    means = labelled.groupBy(chosen.label).agg(
        F.array(*(F.avg(F.get("v", F.lit(i))) for i in range(len(centres[0])))).alias("mean")
    )
    return all(
        np.allclose(row["mean"], centres[row[chosen.label]], atol=_LAST_STEP) for row in means.collect()
    )


def cost_agrees(model, training: DataFrame) -> bool:
    """Whether the sum of squared distances to the centres is the cost the model reports."""
    rows = training.select(vector_to_array("features").alias("v"))
    [(_, _, _, cost)] = _sweep_counts(rows, {"": model})
    return _same_cost(cost, model.summary.trainingCost)


def _same_cost(cost: float, reported: float) -> bool:
    """Spark reports the cost of its last step before the centres move once more, so it is not
    below that of the final centres, and not much above."""
    return cost <= reported * (1 + 1e-9) and cost >= reported * 0.98


def _sweep_counts(rows: DataFrame, models: dict) -> list[tuple]:
    """(name, set of labels as bits, rows not nearest to their centre, cost) per model, in a pass."""
    centres = {name: np.array(model.clusterCenters()) for name, model in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, found = array_matrix(batch.column("v")), []
            for name, own in centres.items():
                far = centre_distances(v, own)
                nearest, wrong, used = far.min(axis=1), 0, 0
                if name:
                    at = batch.column(name).to_numpy(zero_copy_only=False)
                    wrong = int((far[np.arange(len(v)), at] > nearest + _NEAR).sum())
                    used = int(sum(1 << int(k) for k in np.unique(at)))
                found.append({"name": name, "used": used, "wrong": wrong, "cost": float(nearest.sum())})
            yield pa.RecordBatch.from_pylist(found)

    sums = rows.mapInArrow(run, "name string, used bigint, wrong bigint, cost double").groupBy("name")
    counts = sums.agg(F.bit_or("used"), F.sum("wrong"), F.sum("cost")).collect()
    return [tuple(row) for row in counts]


def check_sweep(rows: DataFrame, models: dict) -> list[tuple]:
    """Per K-Means model, whose label column has its name: k, clusters in use, rows not nearest to
    their centre, whether the cost and whether the silhouette agree. One pass counts for all
    models; the evaluator's runs are chains of short jobs and go side by side."""
    points = rows.select(*models, vector_to_array("features").alias("v"))
    counts = {name: rest for name, *rest in _sweep_counts(points, models)}
    scores = silhouettes(rows, list(models))
    with ThreadPool(len(models)) as pool:
        run = inheritable_thread_target(rows.sparkSession)(lambda name: silhouette(rows, name))
        evaluated = dict(zip(models, pool.map(run, models)))
    return [
        (
            model.getK(),
            counts[name][0].bit_count(),
            counts[name][1],
            _same_cost(counts[name][2], model.summary.trainingCost),
            abs(scores[name] - evaluated[name]) < 1e-6,
        )
        for name, model in models.items()
    ]
