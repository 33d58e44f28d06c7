"""Descriptions merged from month states against full scans, and which months a refresh reads."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from temblor.operators import distribution, eda, states
from temblor.sources import tables

COLUMNS, PAIR = ["mag", "depth"], ["mag", "depth"]
SCHEMA = "id int, time timestamp, mag double, depth double"


def clean_table(spark, df, path):
    tables.write_clean(df, path)
    return spark.read.schema(f"{SCHEMA}, {states.MONTH} string").parquet(path)


def refreshed(spark, clean, clean_path, path, **more):
    return states.refresh(spark, clean, clean_path, path, columns=COLUMNS, correlated=PAIR, **more)


@pytest.fixture(scope="module")
def quakes(spark):
    """Forty months with unlike distributions; far from zero, so that plain sums of squares lose digits."""
    rng = np.random.default_rng(3)
    rows = []
    for month in range(40):
        for _ in range(150 + 20 * month):
            time = dt.datetime(2020 + month // 12, month % 12 + 1, int(rng.integers(1, 28)))
            mag = float(1e7 + month + rng.normal())
            rows.append((len(rows), time, mag, float(-mag + rng.exponential(5))))
    rows[5] = (5, rows[5][1], None, 1.0)
    rows[6] = (6, rows[6][1], 1e7, None)
    rows += [(len(rows) + i, None, 1e7 + 50.0, -1e7) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).cache()
    df.count()
    return df, rows


@pytest.fixture(scope="module")
def stored(spark, quakes, tmp_path_factory):
    """The states after three refreshes, as months come in."""
    df, _ = quakes
    folder = tmp_path_factory.mktemp("states")
    clean_path, path = str(folder / "clean"), str(folder / "states")
    reads = []
    for until in ("2021-01-01", "2022-06-15"):
        part = clean_table(spark, df.where(F.col("time") < until), clean_path)
        reads.append(refreshed(spark, part, clean_path, path))
    reads.append(refreshed(spark, clean_table(spark, df, clean_path), clean_path, path))
    return path, reads


def months(first, last):
    names = [f"{year}-{month:02d}" for year in range(2020, 2024) for month in range(1, 13)]
    return set(names[names.index(first) : names.index(last) + 1])


def test_a_refresh_reads_new_months_and_the_latest_again(stored):
    _, reads = stored
    assert reads == [
        months("2020-01", "2020-12"),
        months("2020-12", "2022-06"),
        months("2022-06", "2023-04") | {None},
    ]


def test_moments_equal_a_full_scan(spark, quakes, stored):
    df, rows = quakes
    merged = states.read_states(spark, stored[0])
    found = {(r.feature, r.metric): r.value for r in states.describe(merged).collect()}
    for i, name in enumerate(COLUMNS):
        values = np.array([row[2 + i] for row in rows if row[2 + i] is not None])
        assert found[name, "count"] == len(values)
        assert found[name, "mean"] == pytest.approx(values.mean(), rel=1e-14)
        assert found[name, "stddev"] == pytest.approx(values.std(ddof=1), rel=1e-9)
        assert (found[name, "min"], found[name, "max"]) == (values.min(), values.max())
    full = {r.feature: r[1:] for r in eda.feature_stats(df, COLUMNS).collect()}
    part = {r.feature: r[1:] for r in states.feature_stats(merged).collect()}
    assert set(part) == set(full)
    for name in COLUMNS:
        assert part[name] == pytest.approx(full[name], rel=1e-9)


def test_correlations_equal_a_full_scan(spark, quakes, stored):
    df, _ = quakes
    full = {tuple(r)[:2]: r.correlation for r in distribution.correlation_matrix(df, PAIR).collect()}
    merged = states.correlation_matrix(states.read_states(spark, stored[0]))
    assert {tuple(r)[:2]: r.correlation for r in merged.collect()} == pytest.approx(full, rel=1e-9)


def test_quantiles_are_within_the_bound(spark, quakes, stored):
    _, rows = quakes
    shares = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    described = states.describe(states.read_states(spark, stored[0]), shares)
    found = {(r.feature, r.metric): r.value for r in described.collect()}
    for i, name in enumerate(COLUMNS):
        values = np.array([row[2 + i] for row in rows if row[2 + i] is not None])
        for share in shares:
            value = found[name, f"{100 * share:g}%"]
            below, upto = (values < value).mean(), (values <= value).mean()
            assert below - states.rank_error() <= share <= upto + states.rank_error()


def test_months_counts_and_times(spark, quakes, stored):
    df, _ = quakes
    merged = states.read_states(spark, stored[0])
    trend = states.monthly_trend(merged, with_mag=True).collect()
    assert trend == eda.monthly_trend(df, with_mag=True).collect()
    assert states.time_range(merged).collect() == eda.time_range(df).collect()
    summer = states.read_states(spark, stored[0], "2021-06", "2021-09")
    assert [r.month for r in states.monthly_trend(summer).collect()] == ["2021-06", "2021-07", "2021-08"]


def test_files_of_known_months_are_not_opened(spark, quakes, tmp_path):
    df, _ = quakes
    clean_path, path = str(tmp_path / "clean"), str(tmp_path / "states")
    first = df.where("time < '2020-04-01'")
    clean = clean_table(spark, first, clean_path)
    refreshed(spark, clean, clean_path, path)
    before = states.read_states(spark, path).where("year_month = '2020-01'").collect()
    folder = f"{clean_path}/year_month=2020-01"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"not parquet")
        else:
            os.remove(f"{folder}/{name}")
    assert refreshed(spark, clean, clean_path, path) == {"2020-03"}
    assert states.read_states(spark, path).where("year_month = '2020-01'").collect() == before
    with pytest.raises(Exception):
        refreshed(spark, clean, clean_path, path, again=["2020-01"])
    assert states.read_states(spark, path).count() == 3


def test_changed_and_lost_months(spark, quakes, tmp_path):
    df, _ = quakes
    clean_path, path = str(tmp_path / "clean"), str(tmp_path / "states")
    refreshed(spark, clean_table(spark, df.where("time < '2020-05-01'"), clean_path), clean_path, path)
    changed = df.where("time >= '2020-02-01' and time < '2020-05-01' and (month(time) > 2 or id % 2 = 0)")
    clean = clean_table(spark, changed, clean_path)
    assert refreshed(spark, clean, clean_path, path, again=["2020-02", "2019-01"]) == {"2020-02", "2020-04"}
    merged = states.read_states(spark, path)
    assert states.monthly_trend(merged).collect() == eda.monthly_trend(changed).collect()
    assert states.time_range(merged).collect() == eda.time_range(changed).collect()


def test_single_rows_nulls_and_nothing(spark, tmp_path):
    one = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(1, one, 4.0, None)], SCHEMA)
    found = states.month_states(df, COLUMNS, PAIR)
    assert [(r.feature, r.metric, r.value) for r in states.describe(found, [0.5]).collect()] == [
        ("mag", "count", 1.0),
        ("mag", "mean", 4.0),
        ("mag", "stddev", None),
        ("mag", "min", 4.0),
        ("mag", "50%", 4.0),
        ("mag", "max", 4.0),
    ]
    assert states.correlation_matrix(found).collect() == []
    constant = spark.createDataFrame([(i, one, 2.0, float(i)) for i in range(4)], SCHEMA)
    pairs = states.correlation_matrix(states.month_states(constant, COLUMNS, PAIR)).collect()
    assert {tuple(r) for r in pairs if r.correlation is not None} == {("depth", "depth", 1.0)}
    nothing = df.where("id < 0")
    assert states.describe(states.month_states(nothing, COLUMNS, PAIR)).collect() == []
    clean_path, path = str(tmp_path / "clean"), str(tmp_path / "states")
    assert refreshed(spark, clean_table(spark, nothing, clean_path), clean_path, path) == set()
    empty = states.read_states(spark, path)
    assert states.feature_stats(empty).collect() == []
    assert states.time_range(empty).collect() == [(None, None, 0)]


def test_columns_of_the_states_own_names(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), 1.0, 2.0, 3.0)], "time timestamp, n double, rows double, v0 double")
    found = states.month_states(df, ["n", "rows", "v0"], ["n", "v0"])
    assert {r.feature: r.mean for r in states.feature_stats(found).collect()} == {"n": 1.0, "rows": 2.0, "v0": 3.0}
    assert math.isclose(states.rank_error(800), 0.00345, rel_tol=0.01)
