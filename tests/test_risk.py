"""Hazard rule and country classes at their boundaries."""

import pytest
from pyspark.sql import functions as F

from temblor.functions import risk
from temblor.operators import country, hazard
from temblor.plans.stages import hazard_report, hazard_table

LEVELS = [
    (69.9, 5.5, 2),
    (70.0, 5.5, 1),
    (300.0, 4.0, 1),
    (300.1, 4.0, 0),
    (300.1, 5.49, 0),
    (600.0, 5.5, 1),
    (10.0, 3.99, 0),
]


def test_hazard_levels(spark):
    df = spark.createDataFrame([row[:2] for row in LEVELS], "depth double, mag double")
    rows = hazard.classify_hazard(df).collect()
    assert [row.hazard_cluster for row in rows] == [row[2] for row in LEVELS]
    assert [row.cluster_name for row in rows] == [risk.HAZARD_NAMES[row[2]] for row in LEVELS]


def test_every_clean_event_has_a_level(events):
    assert events.where(~F.col("hazard_cluster").isin(0, 1, 2)).count() == 0
    assert events.where(F.col("hazard_cluster").isNull()).count() == 0


@pytest.mark.parametrize(
    "low, moderate, high, expected",
    [
        (0, 0, 5, "RISIKO RAWAN"),
        (0, 400, 0, "RISIKO RAWAN"),
        (5000, 0, 0, "RISIKO RAWAN"),
        (0, 0, 1, "RISIKO SEDANG"),
        (0, 50, 0, "RISIKO SEDANG"),
        (1000, 0, 0, "RISIKO SEDANG"),
        (949, 49, 0, "RISIKO RENDAH"),
        (950, 49, 0, "RISIKO RENDAH"),
    ],
)
def test_country_classes(spark, low, moderate, high, expected):
    df = spark.createDataFrame([(low, moderate, high)], "low long, moderate long, high long")
    assert country.classify_country_risk(df).head().risk_class == expected


def test_pivot_totals_equal_group_counts(events):
    pivot = {r.country: r.total for r in country.country_hazard_pivot(events).collect()}
    counts = {r.country: r["count"] for r in events.groupBy("country").count().collect()}
    assert pivot == {name: n for name, n in counts.items() if name}


def test_levels_that_never_occur_keep_their_column(spark):
    df = spark.createDataFrame([("A", 0), ("A", 0)], "country string, hazard_cluster int")
    assert country.country_hazard_pivot(df).head().asDict() == {
        "country": "A",
        "low": 2,
        "moderate": 0,
        "high": 0,
        "total": 2,
    }


def test_unknown_levels_have_a_default_label(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "hazard_cluster int")
    rows = {r.hazard_cluster: (r.hazard_label, r.hazard_color) for r in hazard.label_hazard(df).collect()}
    assert rows == {
        1: ("Risiko Sedang", "#f97316"),
        9: ("Unknown", "#718096"),
        None: ("Unknown", "#718096"),
    }


def test_map_points_have_a_minimum_size(events):
    points = hazard.map_points(events, ["id"], n=50).collect()
    assert len(points) == 50
    assert all(p.radius == max(2.5, p.mag * 0.7) for p in points)


def test_long_form_holds_the_same_counts(events):
    top = country.country_risk_top10(events)
    long = country.country_hazard_long(top)
    assert long.count() == 3 * top.count()
    assert long.groupBy().sum("quake_count").head()[0] == top.groupBy().sum("total").head()[0]


def test_report_reads_the_stored_table(events):
    report = hazard_report(hazard_table(events))
    assert report.kpis.head().total_events == events.count()
    assert report.distribution.groupBy().sum("count").head()[0] == events.count()
    assert report.risk_top10.count() == 10 and report.risk_long.count() == 30
    assert report.trend.count() == 12 and report.top_regions.count() == 10
