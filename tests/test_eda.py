"""Descriptive queries: quantiles, distributions, summaries."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from temblor.operators import distribution, eda
from temblor.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def brute(values, share):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(share * len(ordered))) - 1]


def check(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    present = [v for v in values if v is not None]
    found = exact_quantiles(df, ["v"], SHARES, **options)
    assert found == {("v", share): brute(present, share) for share in SHARES}


@pytest.mark.parametrize("accuracy, gather", [(10_000, 20_000), (20, 10), (10, 0)])
def test_quantiles_of_distinct_values(spark, accuracy, gather):
    rng = np.random.default_rng(1)
    check(spark, rng.normal(size=3000).tolist(), accuracy=accuracy, gather_rows=gather)


@pytest.mark.parametrize("accuracy, gather", [(20, 10), (10, 0)])
def test_quantiles_with_a_value_in_a_third_of_all_rows(spark, accuracy, gather):
    rng = np.random.default_rng(2)
    values = rng.normal(size=1000).tolist() + [0.1] * 500 + [None] * 50
    check(spark, values, accuracy=accuracy, gather_rows=gather)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5).map(float), min_size=1, max_size=60))
def test_quantiles_of_many_ties(spark, values):
    check(spark, values, accuracy=5, gather_rows=0)


def test_a_source_that_shrinks_between_passes_raises(spark, tmp_path):
    path = str(tmp_path / "values")
    spark.range(5000).selectExpr("CAST(id AS DOUBLE) AS v").write.parquet(path)

    class Shrinking:
        """Answers the first pass from the whole table and the others from none of it."""

        def __init__(self, df):
            self.df = df

        def agg(self, *columns):
            whole, self.df = self.df, self.df.where("v < 0")
            return whole.agg(*columns)

        def where(self, *conditions):
            return self.df.where(*conditions)

    with pytest.raises(RuntimeError, match="changed between passes"):
        exact_quantiles(Shrinking(spark.read.parquet(path)), ["v"], [0.5], accuracy=100, gather_rows=10)


def test_a_description_takes_three_passes_at_any_size(spark):
    for rows in (50, 30_000):
        df = spark.range(rows).selectExpr("CAST((id * 7919) % 100003 AS DOUBLE) AS v")
        passes = []

        class Counted:
            def agg(self, *columns):
                passes.append("agg")
                return df.agg(*columns)

            def where(self, *conditions):
                passes.append("gather")
                return df.where(*conditions)

        exact_quantiles(Counted(), ["v"], [0.3, 0.5])
        assert passes in (["agg", "agg", "gather"], ["agg", "agg"])


def test_the_sketch_is_within_its_error(spark):
    df = spark.range(40_000).selectExpr("CAST((id * 7919) % 40000 AS DOUBLE) AS v")
    wide = {r.summary: float(r.v) for r in eda.describe_features(df, ["v"]).collect()}
    for metric, share in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        assert abs(wide[metric] - share * 40_000) <= 40_000 / 10_000 + 1


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {("v", 0.5): None}


def test_description_has_eight_text_rows_per_feature(events):
    wide = eda.describe_features(events)
    assert [row.summary for row in wide.collect()] == list(eda.SUMMARY_METRICS)
    assert dict(wide.dtypes)["mag"] == "string"
    exact = eda.describe_features(events, exact=True).collect()
    by_metric = {row.summary: row for row in exact}
    assert by_metric["count"].mag == str(events.count())
    for row in wide.collect():
        if row.summary in ("min", "max", "mean", "stddev"):
            assert float(row.mag) == pytest.approx(float(by_metric[row.summary].mag))
    long = eda.eda_summary(events)
    assert long.columns == ["feature", "metric", "value", "value_num"] and long.count() == 40


def test_histogram_counts_every_row(spark, events):
    rows = distribution.histogram(events, "mag").orderBy("bin").collect()
    assert [row.bin for row in rows] == list(range(30))
    assert sum(row["count"] for row in rows) == events.count()
    counts, edges = np.histogram([row.mag for row in events.select("mag").collect()], bins=30)
    assert abs(np.array([row["count"] for row in rows]) - counts).max() <= 2
    assert rows[0].bin_start == edges[0] and rows[-1].bin_end == pytest.approx(edges[-1])
    flat = spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double")
    rows = distribution.histogram(flat, "v", 4).orderBy("bin").collect()
    assert [row["count"] for row in rows] == [2, 0, 0, 0]
    assert {row.density for row in distribution.kde(flat, "v").collect()} == {None}
    nothing = distribution.histogram(flat.where("v > 1"), "v", 4).collect()
    assert [(row["count"], row.bin_start) for row in nothing] == [(0, None)] * 4


@pytest.mark.parametrize("column", ["mag", "depth"])
def test_density_against_the_sum_over_all_rows(events, column):
    values = np.array([row[0] for row in events.select(column).collect()])
    width = values.std(ddof=1) * len(values) ** -0.2
    rows = distribution.kde(events, column).orderBy("point").collect()
    x = np.array([row.x for row in rows])
    exact = np.exp(-0.5 * ((x[:, None] - values) / width) ** 2).sum(axis=1)
    exact /= len(values) * width * math.sqrt(2 * math.pi)
    found = np.array([row.density for row in rows])
    assert len(rows) == 200 and np.abs(found - exact).max() < 1e-3 * exact.max()


def test_correlations_are_symmetric_and_complete(events):
    rows = distribution.correlation_matrix(events).collect()
    found = {(row.feature_a, row.feature_b): row.correlation for row in rows}
    names = distribution.CORRELATED
    pdf = events.select(*names).toPandas().corr()
    assert len(rows) == 16
    for a in names:
        for b in names:
            assert found[a, b] == pytest.approx(pdf.loc[a, b])


def test_stats_scan_the_table_once(events, spark, tmp_path):
    path = str(tmp_path / "t")
    events.write.parquet(path)
    plan = eda.feature_stats(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_blank_and_null_countries(spark):
    rows = [(None, 1.0, 1.0)] * 3 + [("", 1.0, 1.0)] * 2 + [("A", 4.0, 2.0)]
    df = spark.createDataFrame(rows, "country string, mag double, depth double")
    assert [r.country for r in eda.top_regions(df).collect()] == [None, "", "A"]
    assert [r.country for r in eda.top_regions(df, drop_null=True).collect()] == ["", "A"]
    assert [r.country for r in eda.top_regions_profile(df).collect()] == ["A"]
    assert eda.kpis(df).head().affected_countries == 1


def test_equal_counts_go_by_name(spark):
    df = spark.createDataFrame([(c,) for c in "cabdbacd"], "country string")
    assert [r.country for r in eda.top_regions(df, n=3).collect()] == ["a", "b", "c"]


def test_months_are_ordered_by_time_not_by_label(spark):
    df = spark.sql(
        "SELECT timestamp(d) AS time, 1.0D AS mag FROM VALUES"
        " ('2025-04-01'), ('2025-01-31 23:59:59'), ('2024-12-05'), (NULL) AS t(d)"
    )
    labelled = eda.monthly_trend_labelled(df).collect()
    assert [r.label for r in labelled] == ["Dec 2024", "Jan 2025", "Apr 2025"]
    assert [r.month for r in eda.monthly_trend(df).collect()][0] is None
