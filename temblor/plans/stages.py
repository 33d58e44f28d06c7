"""Stage plans: raw to clean, clean to clusters, clean to hazard report."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame

from temblor.functions.risk import HAZARD_NAMES
from temblor.lineage import materialise, materialised
from temblor.operators import clean, clustering, country, eda, hazard
from temblor.operators.features import FEATURE_SETS, assemble, standardise, vectors_to_arrays
from temblor.plans.agencies import Agency
from temblor.sources.tables import export_labels, write_clean


def valid_events(raw: DataFrame, agency: Agency) -> DataFrame:
    """Flat events of the agency's own type with complete, valid measures; copies are still in.

    Every step works on single rows, so filters reach the scan and nothing shuffles.
    """
    rows = clean.keep_event_type(agency.flatten(raw), agency.event_type)
    return clean.filter_ranges(clean.drop_missing(rows), agency.valid)


def clean_events(raw: DataFrame, agency: Agency) -> DataFrame:
    """Valid, distinct events with derived columns.

    Filters come before de-duplication and computed columns after it: fewer and narrower rows
    shuffle, and the result is the same.
    """
    distinct = clean.dedup_events(valid_events(raw, agency))
    return clean.derive_columns(agency.with_country(distinct))


def preprocess(raw: DataFrame, agency: Agency) -> DataFrame:
    """The clean table of an agency: clean events with raw and standardised feature arrays.

    Standardising needs the distinct events twice, to fit and to transform. They are written to
    the shared folder once, so the shuffle behind them runs once and fitting reads only the
    columns it needs. The result reads that table; ``build_clean_table`` clears it away.
    """
    distinct = clean.dedup_events(valid_events(raw, agency))
    return _with_features(materialise(distinct, "distinct-events"), agency)


def build_clean_table(raw: DataFrame, agency: Agency, path: str, fmt: str = "parquet") -> None:
    """Raw documents to the stored clean table, in one go."""
    distinct = clean.dedup_events(valid_events(raw, agency))
    with materialised(distinct, "distinct-events") as events:
        write_clean(_with_features(events, agency), path, fmt)


def _with_features(distinct: DataFrame, agency: Agency) -> DataFrame:
    events = clean.derive_columns(agency.with_country(distinct))
    vectors = standardise(assemble(events, FEATURE_SETS["physical5"].columns))
    stored = vectors_to_arrays(vectors, ["raw_features", "scaled_features"])
    return stored.select(*agency.clean_schema.names)


@dataclass(frozen=True)
class Analysis:
    """Labelled rows per algorithm, the elbow table and the metrics of one feature set, and all
    rows with features and every label. Readable within the block of ``analyse``."""

    labelled: dict[str, DataFrame]
    elbow: DataFrame | None
    metrics: DataFrame
    rows: DataFrame


@contextmanager
def analyse(
    events: DataFrame,
    feature_set: str,
    k: int,
    key: Sequence[str],
    run_id: str,
    algorithms: Sequence[str] = ("kmeans", "bisecting"),
    sweep: Sequence[int] = (),
    cap: int | None = None,
    seed: int = 42,
    max_iter: int | None = None,
    refit: bool = True,
) -> Iterator[Analysis]:
    """Fit several algorithms on one table, label all rows, score the labels.

    ``events`` is read once; everything else reads the stored model frame, which goes when the
    block ends. Without ``cap`` the fits use all rows.
    """
    with clustering.model_frames(events, feature_set, key, cap=cap, seed=seed, refit=refit) as frames:
        elbow = clustering.elbow_sweep(frames.training, sweep, seed) if sweep else None
        rows = _label_all(frames, algorithms, k, seed, max_iter)
        used = {name: clustering.ALGORITHMS[name] for name in algorithms}
        found = clustering.silhouettes(rows, [chosen.label for chosen in used.values()])
        scores = {chosen.title: found[chosen.label] for chosen in used.values()}
        labelled = {name: export_labels(rows, [chosen.label]) for name, chosen in used.items()}
        metrics = clustering.model_metrics(events.sparkSession, scores, k, feature_set, run_id)
        yield Analysis(labelled, elbow, metrics, rows)


def _label_all(
    frames: clustering.ModelFrames,
    algorithms: Sequence[str],
    k: int,
    seed: int,
    max_iter: int | None,
) -> DataFrame:
    """All rows with one label column per algorithm."""
    jobs = {name: clustering.Fit(name, k, max_iter) for name in algorithms}
    rows = frames.everything
    for name, model in clustering.fit_many(frames.training, jobs, seed).items():
        rows = clustering.label_rows(rows, model, name)
    return rows


@contextmanager
def rule_analysis(
    events: DataFrame, key: Sequence[str], run_id: str, cap: int | None = None, seed: int = 42
) -> Iterator[Analysis]:
    """K-Means, Bisecting K-Means and the hazard rule on the same features, with silhouettes."""
    k = len(HAZARD_NAMES)
    algorithms = ("kmeans", "bisecting")
    with clustering.model_frames(events, "hazard", key, cap=cap, seed=seed) as frames:
        rows = hazard.classify_hazard(_label_all(frames, algorithms, k, seed, max_iter=25))
        used = {name: clustering.ALGORITHMS[name] for name in algorithms}
        titles = {chosen.label: chosen.title for chosen in used.values()}
        titles["hazard_cluster"] = clustering.RULE_TITLE
        found = clustering.silhouettes(rows, list(titles))
        scores = {title: found[label] for label, title in titles.items()}
        metrics = clustering.model_metrics(events.sparkSession, scores, k, "hazard", run_id)
        labelled = {name: export_labels(rows, [chosen.label]) for name, chosen in used.items()}
        yield Analysis(labelled, None, metrics, rows)


def rule_metrics(
    events: DataFrame, key: Sequence[str], run_id: str, cap: int | None = None, seed: int = 42
) -> DataFrame:
    """Silhouettes of K-Means, Bisecting K-Means and the hazard rule on the same features."""
    with rule_analysis(events, key, run_id, cap, seed) as done:
        return done.metrics


def hazard_table(events: DataFrame) -> DataFrame:
    """The labelled table the dashboard queries read."""
    return export_labels(hazard.classify_hazard(events), ["hazard_cluster", "cluster_name"])


@dataclass(frozen=True)
class HazardReport:
    distribution: DataFrame
    kpis: DataFrame
    trend: DataFrame
    top_regions: DataFrame
    risk_top10: DataFrame
    risk_long: DataFrame


def hazard_report(table: DataFrame) -> HazardReport:
    """Everything the dashboard shows, as bounded results over the labelled table."""
    top = country.country_risk_top10(table)
    return HazardReport(
        distribution=hazard.hazard_distribution(table),
        kpis=eda.kpis(table),
        trend=eda.monthly_trend_labelled(table),
        top_regions=eda.top_regions(table, drop_null=True),
        risk_top10=top,
        risk_long=country.country_hazard_long(top),
    )
