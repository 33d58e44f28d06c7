"""The stages one after another, on stored tables, for both agencies."""

import pytest

from temblor.operators import clean, eda
from temblor.plans import stages
from temblor.plans.agencies import AGENCIES
from temblor.plans.quakes import quakes, raw_emsc, raw_usgs
from temblor.sources import tables

PACK = {"emsc": raw_emsc, "usgs": raw_usgs}


@pytest.mark.parametrize("name", ["emsc", "usgs"])
def test_from_raw_files_to_reports_and_labels(spark, sf_dir, tmp_path, name):
    agency = AGENCIES[name]
    raw_path, clean_path = str(tmp_path / "raw"), str(tmp_path / "clean")
    pack = PACK[name](quakes(spark, sf_dir))
    tables.write_table(pack.union(pack), raw_path, fmt="json")
    raw = tables.read_events(spark, agency.raw_schema, raw_path, "json")
    stages.build_clean_table(raw, agency, clean_path)
    table = tables.read_events(spark, agency.clean_schema, clean_path)
    events = stages.clean_events(raw, agency)
    assert table.count() == events.count() > 0

    report = stages.hazard_report(stages.hazard_table(table))
    assert report.kpis.head().total_events == table.count()
    assert report.risk_top10.count() <= 10

    strong = clean.filter_min_mag(table, 2.5)
    with stages.analyse(
        strong, "spatial", 3, agency.event_key, "r", algorithms=("kmeans", "bisecting"), cap=40
    ) as done:
        assert done.metrics.count() == 2
        sizes = eda.cluster_profile(done.labelled["kmeans"], "kmeans_cluster").collect()
        assert sum(row["count"] for row in sizes) == strong.count()
        tables.write_table(done.labelled["bisecting"], str(tmp_path / "bisecting"))
    assert spark.read.parquet(str(tmp_path / "bisecting")).count() == strong.count()


def test_rule_metrics_on_a_stored_table(spark, events):
    rows = stages.rule_metrics(events, ["id"], "r", cap=50).collect()
    assert {row.feature_set for row in rows} == {"hazard"} and len(rows) == 3
    assert all(-1 <= row.silhouette <= 1 for row in rows)
