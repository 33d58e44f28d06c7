"""Flattening, filtering, de-duplication, regions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from temblor import schemas
from temblor.functions.regions import (
    RegionRules,
    last_token,
    normalise_country_emsc,
    normalise_country_usgs,
)
from temblor.operators import clean
from temblor.operators.clean import Bounds
from temblor.plans.agencies import EMSC, USGS
from temblor.plans.stages import clean_events, preprocess, valid_events

JANUARY_END = 1738367999000  # 2025-01-31 23:59:59 UTC


def usgs(coordinates, mag=3.0, place="10 km W of Town, CA", kind="earthquake", time=JANUARY_END):
    return ("a", (time, mag, place, kind), (coordinates,))


def emsc(mag=3.0, depth=10.0, auth="EMSC", kind="ke", time="2025-01-31T23:59:59.5Z", lat=1.0):
    return ("a", (time, lat, 2.0, depth, mag, "FIJI REGION", auth, kind, "mw", "u"))


def flat_usgs(spark, rows):
    return clean.flatten_usgs(spark.createDataFrame(rows, schemas.RAW_USGS))


def test_flatten_usgs(spark):
    rows = [usgs([120.0, -5.0, 33.0]), usgs([120.0, -5.0])]
    full, short = flat_usgs(spark, rows).collect()
    assert (full.longitude, full.latitude, full.depth) == (120.0, -5.0, 33.0)
    assert short.depth is None and short.latitude == -5.0


def test_epoch_milliseconds_stay_in_their_utc_month(spark):
    df = flat_usgs(spark, [usgs([1.0, 2.0, 3.0])])
    assert df.select(F.date_format("time", "yyyy-MM")).head()[0] == "2025-01"


def test_flatten_emsc_turns_bad_values_into_null(spark):
    rows = [emsc(), emsc(time="2025-13-45T00:00:00Z"), emsc(time="no time")]
    df = clean.flatten_emsc(spark.createDataFrame(rows, schemas.RAW_EMSC))
    assert df.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss")).toPandas().iloc[:, 0].tolist() == [
        "2025-01-31 23:59:59",
        None,
        None,
    ]


@pytest.mark.parametrize(
    "mag, kept", [(-2.1, 0), (-2.0, 1), (10.0, 1), (10.1, 0), (None, 0)]
)
def test_usgs_magnitude_bounds(spark, mag, kept):
    raw = spark.createDataFrame([usgs([1.0, 2.0, 3.0], mag=mag)], schemas.RAW_USGS)
    assert valid_events(raw, USGS).count() == kept


@pytest.mark.parametrize("mag, kept", [(2.5, 0), (2.51, 1), (10.0, 1), (10.01, 0)])
def test_emsc_lower_magnitude_bound_is_open(spark, mag, kept):
    raw = spark.createDataFrame([emsc(mag=mag)], schemas.RAW_EMSC)
    assert valid_events(raw, EMSC).count() == kept


@pytest.mark.parametrize("depth, kept", [(-0.1, 0), (0.0, 1), (700.0, 1), (700.1, 0)])
def test_depth_bounds(spark, depth, kept):
    raw = spark.createDataFrame([usgs([1.0, 2.0, depth])], schemas.RAW_USGS)
    assert valid_events(raw, USGS).count() == kept


def test_position_bounds_and_event_type(spark):
    rows = [
        usgs([180.0, 90.0, 1.0]),
        usgs([180.1, 0.0, 1.0]),
        usgs([0.0, -90.1, 1.0]),
        usgs([0.0, 0.0, 1.0], kind="quarry blast"),
        usgs([0.0, 0.0, 1.0], kind=None),
    ]
    df = valid_events(spark.createDataFrame(rows, schemas.RAW_USGS), USGS)
    assert df.count() == 1 and "type" not in df.columns


def test_copies_merge_but_two_reporters_stay(spark):
    rows = [emsc(), emsc(), emsc(auth="USGS")]
    df = clean_events(spark.createDataFrame(rows, schemas.RAW_EMSC), EMSC)
    assert sorted(row.auth for row in df.collect()) == ["EMSC", "USGS"]
    by_position = clean.dedup_events(df, ["latitude", "longitude"])
    assert by_position.count() == 1


def test_half_of_all_rows_are_copies_of_one_event(spark):
    rows = [emsc(lat=float(i % 80)) for i in range(400)] + [emsc(lat=80.5)] * 400
    df = clean_events(spark.createDataFrame(rows, schemas.RAW_EMSC).repartition(7), EMSC)
    assert df.count() == 81


def test_open_and_closed_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)], "v double")
    kept = clean.filter_ranges(df, {"v": Bounds(1, 3, low_open=True, high_open=True)})
    assert [row.v for row in kept.collect()] == [2.0]


def test_min_magnitude(spark):
    df = spark.createDataFrame([(2.4,), (2.5,), (2.6,), (None,)], "mag double")
    assert clean.filter_min_mag(df, 2.5).count() == 2
    assert clean.filter_min_mag(df, 2.5, inclusive=False).count() == 1


EMSC_PLACES = {
    "VIRGIN ISLANDS": "VIRGIN",
    "VIRGIN ISLANDS REGION": "United States",
    "OFF COAST OF NORTHERN CHILE": "NORTHERN CHILE",
    "SOUTH OF FIJI ISLANDS": "FIJI",
    "GULF OF CALIFORNIA": "United States",
    "BAJA CALIFORNIA, MEXICO": "MEXICO",
    "EASTERN NEW GUINEA REG., P.N.G.": "PAPUA NEW GUINEA",
    "TIMOR REGION": "Indonesia",
    "ARKANSAS": "United States",
    "banda sea": "Indonesia",
    "KURIL ISLANDS": "Russia",
    "P.N.G": "P.N.G",
    "two\nlines of URAL": "Russia",
    "": "",
    None: None,
}


def _countries(df, column):
    return {row.place: row.country for row in df.select("place", column.alias("country")).collect()}


def test_emsc_countries(spark):
    df = spark.createDataFrame([(place,) for place in EMSC_PLACES], "place string")
    assert _countries(df, normalise_country_emsc(F.col("place"))) == EMSC_PLACES


def test_country_needs_one_scan_and_no_join(spark):
    df = spark.createDataFrame([(place,) for place in [*EMSC_PLACES] * 3], "place string")
    found = clean.with_country(df, normalise_country_emsc)
    assert {row.place: row.country for row in found.collect()} == EMSC_PLACES
    assert "Join" not in found._jdf.queryExecution().toString()


def test_a_place_that_appears_between_reads_has_its_country(spark, tmp_path):
    path = str(tmp_path / "places")
    spark.createDataFrame([("JAVA, INDONESIA",)], "place string").write.json(path)
    placed = clean.with_country(spark.read.schema("place string").json(path), normalise_country_emsc)
    assert placed.count() == 1
    spark.createDataFrame([("KURIL ISLANDS",)], "place string").write.mode("append").json(path)
    again = clean.with_country(spark.read.schema("place string").json(path), normalise_country_emsc)
    assert {row.country for row in again.collect()} == {"Indonesia", "Russia"}


def test_a_text_magnitude_becomes_null(spark):
    raw = spark.createDataFrame(
        [(("0", "strong", "x, CA", "earthquake"), (["1", "2", "deep"],))],
        "properties struct<time:string,mag:string,place:string,type:string>, geometry struct<coordinates:array<string>>",
    ).withColumn("properties", F.col("properties").withField("time", F.lit(0).cast("bigint")))
    assert clean.flatten_usgs(raw).select("mag", "depth", "latitude").head() == (None, None, 2.0)


def test_usgs_countries(spark):
    expected = {
        "10 km W of Ridgecrest, CA": "United States",
        "5 km N of Volcano, Hawaii": "United States",
        "3 km S of Place, U.S. Virgin Islands": "United States",
        "12 km E of Jakarta, Indonesia": "Indonesia",
        "south of the Fiji Islands": "south of the Fiji Islands",
        "Off Oregon": "Off Oregon",
        "a, b, ": "",
        None: None,
    }
    df = spark.createDataFrame([(place,) for place in expected], "place string")
    assert _countries(df, normalise_country_usgs(F.col("place"))) == expected
    assert _countries(df, last_token(F.col("place")))["a, b, "] == ""


def test_a_country_name_must_not_match_a_later_rule():
    with pytest.raises(ValueError):
        RegionRules((), (), (), (("X LAND", ("A",)), ("Y", ("LAND",))))


def test_preprocess_gives_the_clean_schema(spark):
    rows = [emsc(lat=float(i), mag=3.0 + i / 10) for i in range(20)] * 2
    df = preprocess(spark.createDataFrame(rows, schemas.RAW_EMSC), EMSC)
    assert df.dtypes == spark.createDataFrame([], EMSC.clean_schema).dtypes
    out = df.collect()
    assert len(out) == 20
    scaled = [row.scaled_features[4] for row in out]
    assert abs(sum(scaled)) < 1e-9
    assert abs(sum(value**2 for value in scaled) / 19 - 1) < 1e-9
    assert all(abs(row.x**2 + row.y**2 + row.z**2 - 1) < 1e-12 for row in out)


def test_period_filter(spark):
    rows = [(datetime(2025, 12, 31, 23, 59, 59),), (datetime(2026, 1, 1),), (None,)]
    df = spark.createDataFrame(rows, "time timestamp_ntz")
    df = df.select(F.col("time").cast("timestamp"))
    assert clean.filter_period(df, before="2026-01-01").count() == 1
    assert clean.filter_period(df, since="2026-01-01").count() == 1
    assert clean.filter_period(df).count() == 3
