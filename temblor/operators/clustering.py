"""Clustering with Spark ML: train, label every row, evaluate.

Models are fitted on all rows unless the caller names a cap per stratum. The columns a feature set
needs are written to the shared folder once; scaling, sampling, fits, labels and silhouettes read
that narrow table, so the source is scanned once whatever is done with it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors.exceptions.base import PySparkException
from pyspark.ml import Model
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor import schemas
from temblor.lineage import materialised
from temblor.operators.coreset import WEIGHT, coreset
from temblor.operators.features import (
    FEATURE_SETS,
    arrays_to_vectors,
    fit_features,
    shift_vector,
    vector_size,
)
from temblor.operators.sampling import undersample

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Algorithm:
    title: str
    estimator: type
    label: str
    max_iter: int
    shifted: bool = False
    soft: bool = False


# Titles, label columns and iterations, as the metrics table names them.
ALGORITHMS = {
    "kmeans": Algorithm("K-Means", KMeans, "kmeans_cluster", 25),
    # Bisecting splits a centre by a share of its norm; around mean zero that share is nothing
    # and no split happens. Moving all rows by a constant keeps their distances.
    "bisecting": Algorithm("Bisecting K-Means", BisectingKMeans, "bisect_cluster", 20, True),
    "gmm": Algorithm("Gaussian Mixture Model", GaussianMixture, "gmm_cluster", 20, soft=True),
}
RULE_TITLE = "Custom Hazard (Rule-Based)"
_SHIFTED = "_shifted_features"
_STORED = "scaled_features"
#: Fits of a sweep at a time. Each holds its own blocks, norms and costs of all rows, about 50 bytes a row.
_SWEPT_AT_ONCE = 3


@dataclass(frozen=True)
class ModelFrames:
    """All rows with features, and the rows to train on; both live as long as their block."""

    everything: DataFrame
    training: DataFrame


def model_frame(df: DataFrame, feature_set: str) -> DataFrame:
    """Core columns and the feature set's inputs, without rows that lack an input.

    A derived input is null just when its measure is, and the test on the measure neither
    computes the input twice nor bloats the generated filter.
    """
    chosen = FEATURE_SETS[feature_set]
    names = dict.fromkeys([*schemas.CORE_COLUMNS, *chosen.columns])
    extra = [name for name in df.columns if name not in names and name in ("id", "auth", _STORED)]
    return df.select(*extra, *names).dropna(subset=list(chosen.measures))


@contextmanager
def model_frames(
    df: DataFrame,
    feature_set: str,
    key: Sequence[str],
    strata: str = "country",
    cap: int | None = None,
    seed: int = 42,
    refit: bool = True,
    weighted: int | None = None,
) -> Iterator[ModelFrames]:
    """Frames for one feature set, over one stored narrow table.

    Scaling is fitted on all rows, before any undersampling to ``cap`` rows per stratum. With
    ``refit=False`` the rows' stored ``scaled_features`` are the features as they are. ``weighted``
    asks for about that many training rows with weights, which stand for all rows, in place of a cap.
    """
    if cap is not None and weighted is not None:
        raise ValueError("training rows are capped or weighted, not both")
    with materialised(model_frame(df, feature_set), f"model-{feature_set}") as rows:
        if refit:
            transformer = fit_features(rows, feature_set)
            everything = transformer.transform(rows).drop("features_raw")
        else:
            everything = arrays_to_vectors(rows, {"features": _STORED})
        if weighted is not None:
            training = coreset(everything, weighted, key, seed=seed)
        elif cap is None:
            training = everything
        else:
            training = undersample(rows, strata, cap, key, seed)
            training = (
                transformer.transform(training)
                if refit
                else arrays_to_vectors(training, {"features": _STORED})
            )
        weight = [] if weighted is None else [WEIGHT]
        yield ModelFrames(everything=everything, training=training.select("features", *weight))


def fit(
    training: DataFrame,
    algorithm: str,
    k: int,
    seed: int = 42,
    max_iter: int | None = None,
    weight: str | None = None,
    solver: str | None = None,
):
    """A fitted model of one algorithm on the ``features`` column, its rows weighted by ``weight``.

    ``solver`` is how K-Means holds its rows while it iterates; the model is the same but for rounding.
    By blocks, Spark fails on a table with fewer distinct starting points than ``k``; such a table is
    fitted by rows, which gives fewer clusters.
    """
    chosen = ALGORITHMS[algorithm]
    source = _SHIFTED if chosen.shifted else "features"
    weights = {} if weight is None else {"weightCol": weight}
    solvers = {} if solver is None else {"solver": solver}
    estimator = chosen.estimator(
        **weights,
        **solvers,
        k=k,
        seed=seed,
        featuresCol=source,
        predictionCol=chosen.label,
        maxIter=max_iter or chosen.max_iter,
    )
    rows = _prepared(training, chosen)
    try:
        return estimator.fit(rows)
    except (Py4JJavaError, PySparkException) as error:
        if solver != "block" or "ArrayIndexOutOfBoundsException" not in str(error):
            raise
        return estimator.setSolver("row").fit(rows)


@dataclass(frozen=True)
class Fit:
    algorithm: str
    k: int
    max_iter: int | None = None
    solver: str | None = None


def fit_many(
    training: DataFrame, jobs: dict[str, Fit], seed: int = 42, parallelism: int = 10
) -> dict:
    """Fitted models by name. Training tables are small and a fit is a chain of short jobs that
    leaves most of a cluster idle, so several run at a time."""

    def one(job: Fit):
        return fit(training, job.algorithm, job.k, seed, job.max_iter, solver=job.solver)

    with ThreadPool(min(parallelism, len(jobs))) as pool:
        models = pool.map(inheritable_thread_target(training.sparkSession)(one), jobs.values())
    return dict(zip(jobs, models))


def label_rows(df: DataFrame, model, algorithm: str, soft: bool = False) -> DataFrame:
    """``df`` with the cluster of every row; a mixture gives its likeliest component, and with ``soft``
    also ``probability``, an array of the row's membership in every component."""
    chosen = ALGORITHMS[algorithm]
    if soft and not chosen.soft:
        raise ValueError(f"{algorithm} has no membership probabilities")
    rows = model.transform(_prepared(df, chosen)).drop(_SHIFTED)
    return rows.withColumn("probability", vector_to_array("probability")) if soft else rows.drop("probability")


def membership(rows: DataFrame, label: str, components: int, by: str = "country") -> DataFrame:
    """How much of each group every mixture component holds: one row per group and component.

    ``quake_count`` rows have the component as their hard label; ``mass`` is the sum of memberships, so
    the masses of a group sum to its rows; ``entropy`` is the component's part of the rows' summed
    entropy, in nats, zero where labels are certain. ``disputed`` counts rows of the hard label whose
    membership is below one half. One aggregate over all rows, one column per measure and component,
    so rows are not multiplied; groups then unfold into components.
    """
    measures = []
    for c in range(components):
        p, own = F.get("probability", F.lit(c)), F.col(label) == c
        measures.append(
            F.struct(
                F.lit(c).alias("component"),
                F.count_if(own).alias("quake_count"),
                F.sum(p).alias("mass"),
                F.sum(F.when(p > 0, -p * F.log(p)).otherwise(0.0)).alias("entropy"),
                F.count_if(own & (p < 0.5)).alias("disputed"),
            )
        )
    return rows.groupBy(by).agg(F.array(*measures).alias("all")).select(by, F.inline("all"))


@dataclass(frozen=True)
class Labelled:
    rows: DataFrame
    model: Model
    training: DataFrame


@contextmanager
def clustered(
    df: DataFrame,
    algorithm: str,
    k: int,
    feature_set: str,
    key: Sequence[str],
    strata: str = "country",
    cap: int | None = None,
    seed: int = 42,
    max_iter: int | None = None,
    refit: bool = True,
    soft: bool = False,
    weighted: int | None = None,
) -> Iterator[Labelled]:
    """All rows with their cluster, the model, and what it was trained on, within a block: the rows
    read a stored table that goes with it. ``soft`` keeps the memberships of a mixture, ``weighted``
    trains on about that many weighted rows."""
    with model_frames(df, feature_set, key, strata, cap, seed, refit, weighted) as frames:
        weight = None if weighted is None else WEIGHT
        model = fit(frames.training, algorithm, k, seed, max_iter, weight)
        yield Labelled(label_rows(frames.everything, model, algorithm, soft), model, frames.training)


def silhouette(df: DataFrame, label: str, features: str = "features") -> float | None:
    """Mean silhouette with squared Euclidean distance; None below two clusters."""
    evaluator = ClusteringEvaluator(
        featuresCol=features,
        predictionCol=label,
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    )
    try:
        return float(evaluator.evaluate(df))
    except (Py4JJavaError, PySparkException) as error:
        if "Number of clusters must be greater than one" not in str(error):
            raise
        log.warning("no silhouette: %s has fewer than two clusters", label)
        return None


def silhouettes(
    df: DataFrame, labels: Sequence[str], features: str = "features"
) -> dict[str, float | None]:
    """The silhouette of several labelings of the same rows, in two passes for all of them.

    The mean squared distance of a row to a cluster follows from the cluster's size, mean and mean
    squared norm. One pass gathers these, one row per cluster, as many as the caller chose; a second
    scores every row against an array of them. A row alone in its cluster scores 0.
    """
    width = vector_size(df, features)
    values = [F.get("v", F.lit(i)) for i in range(width)]
    norm = sum((value * value for value in values), F.lit(0.0))
    points = df.select(*labels, vector_to_array(features).alias("v"))
    named = [
        F.struct(F.lit(label).alias("label"), F.col(label).cast("int").alias("cluster"))
        for label in labels
    ]
    groups = (
        points.withColumn("norm", norm)
        .withColumn("of", F.explode(F.array(*named)))
        .groupBy("of.label", "of.cluster")
        .agg(
            F.count("*").alias("n"),
            F.avg("norm").alias("norm"),
            F.array(*(F.avg(value) for value in values)).alias("mean"),
        )
        .orderBy("label", "cluster")
        .collect()
    )
    clusters = {label: [g for g in groups if g["label"] == label] for label in labels}
    scored = {label: found for label, found in clusters.items() if len(found) > 1}
    for label in set(clusters) - set(scored):
        log.warning("no silhouette: %s has fewer than two clusters", label)
    if not scored:
        return {label: None for label in labels}
    totals = points.mapInArrow(_score_sums(scored), "label string, total double, n bigint")
    means = totals.groupBy("label").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    found = {row["label"]: row["mean"] for row in means}
    return {label: found.get(label) for label in labels}


def array_matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of arrays of one length as a matrix, without a copy per row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _score_sums(scored: dict[str, list]):
    """Sums of row scores per labeling and batch, as matrix products of rows and cluster means.

    As Spark expressions these are either a method too long to be compiled or an interpreted loop
    per row and cluster; fifty clusters took twenty times as long.
    """
    known = {
        label: (
            np.array([c["cluster"] for c in found]),
            np.array([c["n"] for c in found], dtype=float),
            np.array([c["norm"] for c in found]),
            np.array([c["mean"] for c in found]),
        )
        for label, found in scored.items()
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = array_matrix(batch.column("v"))
            norm, rows = (v * v).sum(axis=1), np.arange(len(v))
            sums = []
            for label, (ids, sizes, norms, means) in known.items():
                own = np.searchsorted(ids, batch.column(label).to_numpy(zero_copy_only=False))
                far = norm[:, None] + norms[None, :] - 2 * v @ means.T
                size = sizes[own]
                within = far[rows, own] * size / np.maximum(size - 1, 1)
                far[rows, own] = np.inf
                nearest, most = far.min(axis=1), np.empty(len(v))
                np.maximum(within, nearest, out=most)
                score = np.divide(nearest - within, most, out=np.zeros(len(v)), where=most > 0)
                sums.append((label, float(score[size > 1].sum()), len(v)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("label", "total", "n"), row)) for row in sums],
                schema=pa.schema([("label", pa.string()), ("total", pa.float64()), ("n", pa.int64())]),
            )

    return run


def elbow_sweep(
    training: DataFrame,
    ks: Sequence[int] = tuple(range(2, 11)),
    seed: int = 42,
    max_iter: int = 25,
) -> DataFrame:
    """Within-cluster cost and silhouette per k, for the caller to choose k."""
    labelled, models = swept(training, ks, seed, max_iter)
    scores = silhouettes(labelled, list(models))
    rows = [
        (model.getK(), float(model.summary.trainingCost), scores[name])
        for name, model in models.items()
    ]
    return training.sparkSession.createDataFrame(rows, schemas.ELBOW)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` held by the executors while a block reads it again and again; what is lost is computed
    anew from the stored table below it."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def swept(
    training: DataFrame, ks: Sequence[int], seed: int = 42, max_iter: int = 25
) -> tuple[DataFrame, dict]:
    """``training`` with a label column per k, and the models by that column's name.

    The fits share one kept copy of the features, which goes once they are done. Each stacks it into
    blocks of plain numbers and iterates over these: by rows, as Spark chooses for a table that is
    kept, every iteration would decode every vector anew.
    """
    jobs = {f"k{k}": Fit("kmeans", k, max_iter, solver="block") for k in ks}
    with kept(training) as features:
        models = fit_many(features, jobs, seed, _SWEPT_AT_ONCE)
    labelled = training
    for name, model in models.items():
        labelled = label_rows(labelled, model.setPredictionCol(name), "kmeans")
    return labelled, models


def model_metrics(
    spark: SparkSession,
    scores: dict[str, float | None],
    k: int,
    feature_set: str,
    run_id: str,
) -> DataFrame:
    """One row per algorithm, once each, keyed by run and feature set."""
    rows = [(run_id, feature_set, title, k, score) for title, score in scores.items()]
    return spark.createDataFrame(rows, schemas.METRICS)


def model_comparison(metrics: DataFrame) -> DataFrame:
    """The metrics as a two-column table, best model first."""
    return metrics.select(F.col("algorithm").alias("model"), "silhouette").orderBy(
        F.col("silhouette").desc_nulls_last(), "model"
    )


def _prepared(df: DataFrame, chosen: Algorithm) -> DataFrame:
    return shift_vector(df, "features", _SHIFTED) if chosen.shifted else df
