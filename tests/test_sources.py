"""Windows, collecting, tables, streaming."""

import io
import json
import urllib.error
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from file_fetch import FileFetch, MagnitudeFetch, event_mag, event_time
from temblor import schemas
from temblor.operators import clean
from temblor.plans.agencies import EMSC, USGS
from temblor.plans.quakes import quakes, raw_emsc, raw_usgs
from temblor.sources import collector, tables, variants, windows
from temblor.streaming import ingest

START, END = datetime(2025, 1, 1), datetime(2026, 1, 1)


def test_windows_tile_the_year(spark):
    period = spark.createDataFrame([(START, END)], "start timestamp, end timestamp")
    rows = windows.plan_windows(period).orderBy("window_id").collect()
    found = [(row.window_start, row.window_end) for row in rows]
    assert found == windows.request_windows(START, END)
    assert len(found) == 25 and found[0][0] == START and found[-1][1] == END
    assert all(a[1] == b[0] for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("days", [1, 15, 365, 400])
def test_any_width_covers_the_period(days):
    found = windows.request_windows(START, END, days)
    assert sum((b - a for a, b in found), timedelta()) == END - START


def test_empty_period_has_no_window(spark):
    period = spark.createDataFrame([(START, START)], "start timestamp, end timestamp")
    assert windows.plan_windows(period).count() == 0
    assert windows.request_windows(START, START) == []


def test_no_event_with_a_time_means_no_window(spark):
    df = spark.sql("SELECT CAST(NULL AS timestamp) AS time")
    assert windows.window_counts(df).count() == 0


FAST = collector.RetryPolicy(attempts=3, pause_seconds=0.0)


def collect(spark, fetch, name, end=datetime(2025, 2, 1), policy=FAST):
    source = collector.windowed_event_source(fetch, START, end, policy=policy, name=name)
    return collector.collect_windows(spark, source)


def test_a_window_over_the_cap_is_split_and_nothing_is_lost(spark, tmp_path):
    collected = collect(spark, FileFetch(tmp_path, cap=100), "capped").cache()
    df = collector.parse_documents(collected, schemas.RAW_EMSC)
    assert df.count() == 31 * 24
    assert df.select("id").distinct().count() == 31 * 24
    assert df.where("part_start > timestamp(properties.time)").count() == 0
    assert df.where("part_end <= timestamp(properties.time)").count() == 0
    log = collector.load_log(collected)
    assert log.count() == len(windows.request_windows(START, datetime(2025, 2, 1)))
    assert log.groupBy().sum("saved").head()[0] == 31 * 24
    assert log.where("parts > 1").count() > 0 and log.where("error IS NOT NULL").count() == 0


def test_lost_connections_are_tried_again(spark, tmp_path):
    df = collect(spark, FileFetch(tmp_path, cap=1000, failures=2), "flaky")
    assert df.select("document").where("document IS NOT NULL").distinct().count() == 31 * 24


def test_a_lasting_failure_fails_the_job(spark, tmp_path):
    with pytest.raises(Exception, match="connection lost"):
        collect(spark, FileFetch(tmp_path, cap=1000, failures=99), "broken").count()


def test_a_lasting_failure_can_be_recorded_instead(spark, tmp_path):
    policy = collector.RetryPolicy(attempts=2, pause_seconds=0.0, record_failures=True)
    df = collect(spark, FileFetch(tmp_path, cap=1000, failures=99), "recorded", policy=policy)
    log = collector.load_log(df).collect()
    assert len(log) == 3 and all(row.saved == 0 and "lost" in row.error for row in log)


class Reply(io.BytesIO):
    """What ``urlopen`` returns, as a context manager."""


def test_http_fetch(monkeypatch):
    seen = []

    def answer(url, timeout):
        seen.append((url, timeout))
        if len(seen) == 1:
            return Reply(b'{"features": [{"id": "a"}]}')
        if len(seen) == 2:
            return Reply(b"")
        code, text = [(400, b"25000 matching events exceeds search limit of 20000"), (413, b""), (400, b"bad parameter"), (404, b""), (503, b"")][len(seen) - 3]
        raise urllib.error.HTTPError(url, code, "no", {}, io.BytesIO(text))

    monkeypatch.setattr("urllib.request.urlopen", answer)
    fetch = collector.HttpFetch("http://agency.example/query", EMSC.request_format)
    assert fetch(START, END) == [{"id": "a"}]
    assert fetch(START, END) == []
    for error in (collector.WindowTooLarge,) * 2 + (collector.RequestRefused,) * 2 + (urllib.error.HTTPError,):
        with pytest.raises(error):
            fetch(START, END)
    url, timeout = seen[0]
    assert timeout == 30.0 and "format=json" in url
    assert "starttime=2025-01-01T00%3A00%3A00" in url and "endtime=2026-01-01" in url


@pytest.mark.parametrize("record", [False, True])
def test_a_wrong_request_is_asked_once(record):
    calls = []

    def refuse(start, end):
        calls.append((start, end))
        raise collector.RequestRefused("400: bad parameter")

    policy = collector.RetryPolicy(attempts=3, pause_seconds=0.0, record_failures=record)
    if record:
        [(_, _, document, error)] = collector.fetch_window(refuse, START, END, policy)
        assert document is None and "bad parameter" in error
    else:
        with pytest.raises(collector.RequestRefused):
            list(collector.fetch_window(refuse, START, END, policy))
    assert len(calls) == 1


def test_the_raw_table_neither_loses_nor_doubles(spark, tmp_path):
    path, log_path = str(tmp_path / "raw"), str(tmp_path / "log")
    week = [START + timedelta(days=7 * i) for i in range(4)]

    def run(rows):
        """(window, part, id or None, error) of one collecting run; every window leaves a mark."""
        marks = {(w, w, None, None) for w, *_ in rows}
        found = [(w, w + timedelta(days=7), p, p + timedelta(days=1), i and json.dumps({"id": i}), e) for w, p, i, e in [*rows, *marks]]
        log = collector.store_collected(spark.createDataFrame(found, schemas.COLLECTED), schemas.RAW_EMSC, path, log_path)
        stored = sorted(r.id for r in collector.read_raw(spark, schemas.RAW_EMSC, path, log_path).collect())
        return stored, {r.window_start: (r.saved, r.error) for r in log.collect()}

    split = [(week[0], week[0], "a", None), (week[0], week[0] + timedelta(days=3), "b", None)]
    other = [(week[1], week[1], "c", None)]
    assert run(split + other) == (["a", "b", "c"], {week[0]: (2, None), week[1]: (1, None)})
    whole = [(week[0], week[0], "a", None), (week[0], week[0], "b", None)]
    assert run(whole)[0] == ["a", "b", "c"]  # split, then whole
    assert run(split)[0] == ["a", "b", "c"]  # whole, then split
    failed = [(week[0], week[0], "a", None), (week[0], week[0] + timedelta(days=3), None, "lost")]
    assert run(failed) == (["a", "b", "c"], {week[0]: (1, "lost")})  # what was stored stays
    assert run([(week[1], week[1], None, None), (week[2], week[2], "d", None)])[0] == ["a", "b", "d"]
    log = {r.window_start: r.error for r in collector.read_log(spark, log_path).collect()}
    assert log == {week[0]: "lost", week[1]: None, week[2]: None}


def one_window(spark, ids):
    """A collecting run over one window that brings ``ids``."""
    rows = [(START, START + timedelta(days=7), START, START + timedelta(days=7), i and json.dumps({"id": i}), None) for i in (None, *ids)]
    return spark.createDataFrame(rows, schemas.COLLECTED)


@pytest.mark.parametrize("step", ["write_table", "load_log", "commit_log", "move_new"])
def test_a_run_that_fails_at_any_step_changes_nothing(spark, tmp_path, monkeypatch, step):
    path, log_path = str(tmp_path / "raw"), str(tmp_path / "log")

    def state():
        rows = collector.read_raw(spark, schemas.RAW_EMSC, path, log_path).collect()
        return sorted(r.id for r in rows), [r.saved for r in collector.read_log(spark, log_path).collect()]

    collector.store_collected(one_window(spark, ["a", "b"]), schemas.RAW_EMSC, path, log_path)
    before = state()
    assert before == (["a", "b"], [2])

    def lost(*args, **kwargs):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(collector.tables if step == "write_table" else collector, step, lost)
        with pytest.raises(OSError):
            collector.store_collected(one_window(spark, ["c"]), schemas.RAW_EMSC, path, log_path)
    assert state() == before
    collector.store_collected(one_window(spark, ["d"]), schemas.RAW_EMSC, path, log_path)
    assert state() == (["d"], [1])
    gone = collector.remove_unused_runs(spark, path, log_path)
    assert len(gone) == (1 if step == "write_table" else 2) and state() == (["d"], [1])


def test_runs_that_commit_at_once_get_numbers_of_their_own(spark, tmp_path):
    log_path = str(tmp_path / "log")
    log = spark.range(1).selectExpr("'w' AS window")
    assert [collector.commit_log(log, log_path) for _ in range(2)] == [1, 2]
    tables.write_table(log, f"{log_path}/_pending-x")
    assert not collector.move_new(spark, f"{log_path}/_pending-x", f"{log_path}/commit=2")
    assert sorted(collector.child_folders(spark, log_path)) == ["_pending-x", "commit=1", "commit=2"]


MARCH, JUNE = datetime(2025, 3, 1), datetime(2025, 6, 1)


def test_filters_reach_the_request(spark, tmp_path):
    columns = collector.EventColumns(event_time, event_mag)

    def source(name):
        (tmp_path / name).mkdir()
        fetch = MagnitudeFetch(tmp_path / name)
        made = collector.windowed_event_source(fetch, MARCH, JUNE, policy=FAST, name=name, columns=columns)
        return collector.collect_windows(spark, made)

    everything = source("unpushed").select("time", "mag").cache()
    assert everything.count() == 92 * 4 + 7
    for i, (where, windows_asked, least) in enumerate(
        [
            ("time >= '2025-03-05' AND time < '2025-03-20'", 2, None),
            ("time = '2025-03-05'", 1, None),
            ("mag >= 4.5", 7, 4.5),
            ("mag > 4.5 AND mag >= 3", 7, 4.5),
            ("time < '2025-03-02' AND mag >= 5", 1, 5.0),
            ("mag <= 4 OR time > '2025-05-01'", 7, None),
            ("time > '2025-07-01'", 0, None),
        ]
    ):
        found = source(f"pushed{i}").where(where).select("time", "mag")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, everything.where(where).collect()))
        asked = [name.name.split("_") for name in (tmp_path / f"pushed{i}").iterdir()]
        assert len(asked) == windows_asked and {name[1] for name in asked} <= {str(least)}, where


def test_a_least_magnitude_goes_into_the_url(monkeypatch):
    seen = []
    monkeypatch.setattr("urllib.request.urlopen", lambda url, timeout: seen.append(url) or Reply(b""))
    fetch = collector.CappedFetch(collector.HttpFetch("http://agency.example/query", EMSC.request_format))
    collector.at_least(fetch, 4.5)(START, END)
    collector.at_least(fetch, None)(START, END)
    assert "minmagnitude=4.5" in seen[0] and "minmagnitude" not in seen[1]
    assert collector.at_least(max, 3.0) is max


def test_a_window_that_cannot_be_split_further_fails():
    def refuse(start, end):
        raise collector.WindowTooLarge("still too large")

    with pytest.raises(collector.WindowTooLarge):
        list(collector.fetch_window(refuse, START, START + timedelta(minutes=3), FAST))


def test_a_service_that_cuts_its_reply_counts_as_too_large():
    fetch = collector.CappedFetch(lambda start, end: [{}] * 5, cap=5)
    with pytest.raises(collector.WindowTooLarge):
        fetch(START, END)


def test_feature_collections(spark, tmp_path):
    feature = {
        "id": "a",
        "properties": {"time": 0, "mag": 1.5, "place": "x, CA", "type": "earthquake"},
        "geometry": {"coordinates": [1.0, 2.0, 3.0]},
    }
    pages = [[feature, {**feature, "id": "b"}], [], [{**feature, "id": "c"}]]
    for i, page in enumerate(pages):
        text = json.dumps({"type": "FeatureCollection", "features": page}, indent=1)
        (tmp_path / f"{i}.json").write_text(text)
    df = tables.read_feature_collections(spark, str(tmp_path), schemas.RAW_USGS)
    assert df.schema == schemas.RAW_USGS
    assert sorted(row.id for row in df.collect()) == ["a", "b", "c"]
    assert clean.flatten_usgs(df).head().depth == 3.0


@pytest.mark.parametrize("agency, pack", [(USGS, raw_usgs), (EMSC, raw_emsc)])
@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_flattened_documents_equal_the_flat_catalogue(spark, sf_dir, tmp_path, agency, pack, fmt):
    catalogue = quakes(spark, sf_dir)
    path = str(tmp_path / "raw")
    tables.write_table(pack(catalogue), path, fmt=fmt)
    flat = agency.flatten(tables.read_events(spark, agency.raw_schema, path, fmt))
    names = ["time", "latitude", "longitude", "depth", "mag", "place"]
    assert flat.select(*names).exceptAll(catalogue.select(*names)).count() == 0
    assert flat.count() == catalogue.count()


def test_raw_windows_are_replaced_not_added(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    catalogue = quakes(spark, sf_dir).withColumn("window", F.date_format("time", "yyyyMM"))
    tables.write_raw(catalogue, path)
    january = catalogue.where("month(time) = 1")
    tables.write_raw(january, path)
    stored = tables.read_events(spark, catalogue.schema, path)
    assert stored.count() == catalogue.count()


def test_metrics_of_a_run_are_replaced_and_other_runs_stay(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for run, score in [("a", 0.1), ("b", 0.2), ("a", 0.3)]:
        rows = [(run, "hazard", "K-Means", 4, score)]
        tables.write_metrics(spark.createDataFrame(rows, schemas.METRICS), path)
    stored = tables.read_events(spark, schemas.METRICS, path)
    assert {row.run_id: row.silhouette for row in stored.collect()} == {"a": 0.3, "b": 0.2}


def test_filters_reach_the_scan_and_months_are_pruned(spark, events, tmp_path):
    path = str(tmp_path / "clean")
    tables.write_clean(events, path)
    stored = spark.read.parquet(path)
    strong = clean.filter_min_mag(stored, 2.5).select("mag")
    plan = strong._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(mag,2.5)" in plan and "ReadSchema: struct<mag:double>" in plan
    spring = clean.filter_period(stored, since="2025-03-01", before="2025-04-01")
    plan = spring._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert spring.count() == events.where("month(time) = 3").count()


def test_view_and_counts_and_projection(spark, events):
    tables.register_view(events, "earthquake_clean")
    assert spark.sql("SELECT count(*) FROM earthquake_clean").head()[0] == events.count()
    counted, seen = tables.stage_counts(events, "clean")
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == events.count()
    text = events.withColumn("time", F.lit("not a time"))
    served = tables.serving_projection(text)
    assert served.columns == [
        "time", "place", "country", "latitude", "longitude", "depth", "mag",
        "hazard_cluster", "cluster_name",
    ]
    assert served.where("time IS NOT NULL").count() == 0


def test_a_stream_of_batches_in_any_order_equals_the_batch_path(spark, sf_dir, tmp_path):
    landed, path = str(tmp_path / "landed"), str(tmp_path / "valid")
    raw = raw_emsc(quakes(spark, sf_dir), ("EMSC", "EMSC"))
    moment = F.to_timestamp("properties.time")
    timeless = raw.limit(40).withColumn("properties", F.col("properties").withField("time", F.lit("x")))
    batches = [raw.where(F.month(moment) >= 10), raw.where(F.month(moment) < 10), timeless]
    for batch in batches:  # the older events land second, and copies of them in both
        batch.write.mode("append").json(landed)
        stream = ingest.valid_stream(ingest.read_landed(spark, landed, EMSC), EMSC)
        query = ingest.write_valid_stream(stream, path, str(tmp_path / "checkpoint"))
        assert query.awaitTermination(120)
    from temblor.plans.stages import clean_events

    expected = clean_events(raw.union(timeless), EMSC)
    stored = ingest.distinct_events(spark.read.parquet(path)).select(*expected.columns)
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()
    assert stored.where("time IS NULL").count() > 0


def test_unknown_fields_survive_as_variants(spark, tmp_path):
    texts = ['{"id": "a", "properties": {"mag": 4.5, "nst": 7}, "new": {"deep": [1, 2]}}', '{"id": "b", "properties": {"mag": "much", "lat": 1}}', "no json", "null", None]
    rows = [(START, START + timedelta(days=7), START, START, text, None) for text in texts]
    path = str(tmp_path / "variants")
    tables.write_table(variants.parse_variants(spark.createDataFrame(rows, schemas.COLLECTED)), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and [r.unparsed for r in stored.where("unparsed IS NOT NULL").collect()] == ["no json"]
    typed = variants.typed(stored, schemas.RAW_EMSC, variants.field("$.new.deep[1]", "int").alias("deep"), variants.field("$.properties.nst", "int").alias("nst"))
    found = sorted(((r.id, r.properties.mag, r.properties.lat, r.deep, r.nst) for r in typed.collect()), key=str)
    assert found == [("a", 4.5, None, 2, 7), ("b", None, 1.0, None, None), (None,) * 5, (None,) * 5]
    same = collector.parse_documents(spark.createDataFrame(rows, schemas.COLLECTED), schemas.RAW_EMSC)
    assert typed.drop("deep", "nst").dtypes == same.dtypes
    [shape] = variants.shape_by_window(stored).select("documents", "unparsed", variants.field_names(F.col("shape")).alias("names")).collect()
    assert (shape.documents, shape.unparsed) == (4, 1) and {"id", "nst", "deep", "new"} <= set(shape.names)
