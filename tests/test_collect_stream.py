"""Windows collected as they become due, with stops in between."""

from datetime import datetime, timedelta, timezone

import pytest

from file_fetch import FileFetch, OutageFetch
from temblor import schemas
from temblor.sources import collector
from temblor.streaming import collect

START, END = datetime(2025, 1, 1), datetime(2025, 2, 1)
PLAN = collect.WindowPlan(START, END, days=4)  # seven of four days and one of three
ONCE = collector.RetryPolicy(attempts=1, pause_seconds=0.0)


def places(tmp_path):
    for name in ("asked", "checkpoint"):
        (tmp_path / name).mkdir(exist_ok=True)
    return tmp_path / "asked", [str(tmp_path / name) for name in ("raw", "log", "checkpoint")]


def run(spark, tmp_path, now, fetch=None, plan=PLAN, at_once=3, policy=ONCE):
    asked, paths = places(tmp_path)
    fetch = fetch or FileFetch(asked, cap=10_000)
    return collect.collect_due(spark, fetch, plan, schemas.RAW_EMSC, *paths, at_once, policy, lambda: now)


def requests(tmp_path):
    """How often each window was answered."""
    return [len(found.read_text()) for found in sorted((tmp_path / "asked").glob("*.tries"))]


def stored(spark, tmp_path):
    rows = collector.read_raw(spark, schemas.RAW_EMSC, str(tmp_path / "raw"), str(tmp_path / "log"))
    return sorted(rows.collect())


def batch_run(spark, folder):
    folder.mkdir()
    source = collector.windowed_event_source(FileFetch(folder, 10_000), START, END, 4, ONCE, "all_at_once")
    paths = str(folder / "raw"), str(folder / "log")
    collector.store_collected(collector.collect_windows(spark, source), schemas.RAW_EMSC, *paths)
    return sorted(collector.read_raw(spark, schemas.RAW_EMSC, *paths).collect())


def test_windows_become_due_one_by_one():
    day = timedelta(days=1)
    assert [PLAN.due(START + n * day) for n in (-9, 0, 3, 4, 30, 31, 400)] == [0, 0, 0, 1, 7, 8, 8]
    assert PLAN.due(datetime(2025, 1, 5, tzinfo=timezone(timedelta(hours=5)))) == 0
    assert PLAN.window(7)[1] - PLAN.window(7)[0] == 3 * day
    late = collect.WindowPlan(START, END, 4, settle=2 * day)
    assert [late.due(START + n * day) for n in (5, 6, 32, 33)] == [0, 1, 7, 8]
    endless = collect.WindowPlan(START, days=4)
    assert [endless.due(START + n * day) for n in (3, 31, 400)] == [0, 7, 100]
    assert collect.WindowPlan(END, START).due(END) == 0


def test_two_runs_ask_once_for_each_window_and_equal_one_batch_run(spark, tmp_path):
    assert run(spark, tmp_path, START) == 0 and not (tmp_path / "raw").exists()
    assert run(spark, tmp_path, datetime(2025, 1, 20)) == 4
    assert requests(tmp_path) == [1] * 4
    assert run(spark, tmp_path, datetime(2025, 1, 20)) == 0
    assert run(spark, tmp_path, datetime(2025, 3, 1)) == 4
    assert requests(tmp_path) == [1] * 8
    found = stored(spark, tmp_path)
    assert len(found) == 31 * 24 and found == batch_run(spark, tmp_path / "batch")
    log = collector.read_log(spark, str(tmp_path / "log"))
    assert log.groupBy().sum("saved").head()[0] == 31 * 24 and log.count() == 8


def test_a_lost_service_costs_at_most_the_batch_it_stopped(spark, tmp_path):
    asked, _ = places(tmp_path)
    fetch = OutageFetch(asked, START + timedelta(days=20))  # the sixth window, the last of the second batch
    (asked / "down").touch()
    with pytest.raises(Exception, match="no answer"):
        run(spark, tmp_path, END, fetch)
    assert len(stored(spark, tmp_path)) == 3 * 4 * 24
    (asked / "down").unlink()
    assert run(spark, tmp_path, END, fetch) == 5
    times = requests(tmp_path)
    assert times[:3] == [1] * 3 and max(times[3:5]) <= 2 and times[5:] == [1] * 3
    assert stored(spark, tmp_path) == batch_run(spark, tmp_path / "batch")


def test_a_batch_stored_but_not_noted_by_the_stream_is_replaced(spark, tmp_path, monkeypatch):
    store = collector.store_collected

    def stopped(*given):
        store(*given)
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(collector, "store_collected", stopped)
        with pytest.raises(Exception, match="driver lost"):
            run(spark, tmp_path, END)
    assert len(stored(spark, tmp_path)) == 3 * 4 * 24
    assert run(spark, tmp_path, END) == 5
    assert stored(spark, tmp_path) == batch_run(spark, tmp_path / "batch")


def test_a_refused_window_is_logged_and_does_not_hold_the_others(spark, tmp_path):
    asked, _ = places(tmp_path)
    (asked / "down").touch()
    policy = collector.RetryPolicy(attempts=1, pause_seconds=0.0, record_failures=True)
    assert run(spark, tmp_path, END, OutageFetch(asked, START + timedelta(days=28)), policy=policy) == 8
    assert collector.read_log(spark, str(tmp_path / "log")).where("error IS NOT NULL").count() == 1
    assert len(stored(spark, tmp_path)) == 28 * 24


def test_a_log_that_is_not_the_streams_own_is_noticed(spark, tmp_path):
    assert run(spark, tmp_path, datetime(2025, 1, 20)) == 4
    asked, (_, _, checkpoint) = places(tmp_path)
    others = str(tmp_path / "raw2"), str(tmp_path / "log2")
    with pytest.raises(RuntimeError, match="not of one stream"):
        collect.collect_due(
            spark, FileFetch(asked, 10_000), PLAN, schemas.RAW_EMSC, *others, checkpoint, 4, ONCE, lambda: END
        )
