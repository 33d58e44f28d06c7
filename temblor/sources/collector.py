"""Collecting event documents from an agency, one Spark task per request window.

``fetch`` gets a window and returns its documents. A window the agency refuses as too large is
split in two until it fits, so no event goes missing. A request it calls wrong fails at once; other
failures are tried again a few times and then fail the job, or leave a row with the error if the
policy says so. ``store_collected`` then replaces the windows that came back whole and no others,
by one commit.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from temblor.lineage import child_folders, move_new, remove_path
from temblor.schemas import COLLECTED
from temblor.sources import tables
from temblor.sources.windows import WINDOW_DAYS, request_windows

Fetch = Callable[[datetime, datetime], Iterable[dict]]


class WindowTooLarge(Exception):
    """The agency has more events in the window than one request may return."""


class RequestRefused(Exception):
    """The agency calls the request wrong; asking again or for less does not help."""


@dataclass(frozen=True)
class RetryPolicy:
    attempts: int = 3
    pause_seconds: float = 1.0
    smallest_window: timedelta = timedelta(minutes=1)
    record_failures: bool = False


@dataclass(frozen=True)
class HttpFetch:
    """GET of one window. It is too large if status 413 says so, or a status 400 whose text
    matches ``limit_text``; any other status from 400 to 499 but 408 and 429 refuses the request.

    A service that counts the end as inside gives an event on a boundary twice; whole-row
    de-duplication merges the two.
    """

    url: str
    request_format: str
    timeout_seconds: float = 30.0
    limit_text: str = r"exceed\w*\b.*\blimit|too many|too large"
    least_magnitude: float | None = None

    def at_least(self, magnitude: float) -> HttpFetch:
        """The same request for events of this magnitude or more."""
        return replace(self, least_magnitude=magnitude)

    def __call__(self, start: datetime, end: datetime) -> Iterable[dict]:
        asked = {
            "format": self.request_format,
            "starttime": start.isoformat(),
            "endtime": end.isoformat(),
        }
        if self.least_magnitude is not None:
            asked["minmagnitude"] = self.least_magnitude
        query = urllib.parse.urlencode(asked)
        try:
            with urllib.request.urlopen(
                f"{self.url}?{query}", timeout=self.timeout_seconds
            ) as reply:
                body = reply.read()
        except urllib.error.HTTPError as error:
            text = error.read().decode("utf-8", "replace") if error.fp else ""
            over = re.search(self.limit_text, text, re.IGNORECASE | re.DOTALL)
            if error.code == 413 or error.code == 400 and over:
                raise WindowTooLarge(f"{start} to {end}") from error
            if 400 <= error.code < 500 and error.code not in (408, 429):
                raise RequestRefused(f"{error.code}: {text[:500]}") from error
            raise
        return json.loads(body).get("features", []) if body else []


@dataclass(frozen=True)
class CappedFetch:
    """Wraps a fetch whose service cuts its reply at ``cap`` documents instead of refusing."""

    fetch: Fetch
    cap: int = 20_000

    def at_least(self, magnitude: float) -> CappedFetch:
        return replace(self, fetch=at_least(self.fetch, magnitude))

    def __call__(self, start: datetime, end: datetime) -> Iterable[dict]:
        documents = list(self.fetch(start, end))
        if len(documents) >= self.cap:
            raise WindowTooLarge(f"{start} to {end}")
        return documents


def at_least(fetch: Fetch, magnitude: float | None) -> Fetch:
    """``fetch`` asking for a least magnitude, if it can; else as it is."""
    asked = getattr(fetch, "at_least", None)
    return fetch if magnitude is None or asked is None else asked(magnitude)


def fetch_window(
    fetch: Fetch, start: datetime, end: datetime, policy: RetryPolicy
) -> Iterator[tuple[datetime, datetime, dict | None, str | None]]:
    """Documents of a window with the (sub)window each came in; or that window and its error."""
    try:
        documents = _with_retries(fetch, start, end, policy)
    except WindowTooLarge as error:
        if end - start > policy.smallest_window:
            middle = start + (end - start) / 2
            yield from fetch_window(fetch, start, middle, policy)
            yield from fetch_window(fetch, middle, end, policy)
            return
        if not policy.record_failures:
            raise
        yield start, end, None, repr(error)
    except Exception as error:
        if not policy.record_failures:
            raise
        yield start, end, None, repr(error)
    else:
        yield from ((start, end, document, None) for document in documents)


def _with_retries(
    fetch: Fetch, start: datetime, end: datetime, policy: RetryPolicy
) -> list[dict]:
    for attempt in range(1, policy.attempts):
        try:
            return list(fetch(start, end))
        except (WindowTooLarge, RequestRefused):
            raise
        except Exception:
            time.sleep(policy.pause_seconds * attempt)
    return list(fetch(start, end))


@dataclass
class _Window(InputPartition):
    start: datetime
    end: datetime


@dataclass(frozen=True)
class EventColumns:
    """How a document tells its time and magnitude, for a source that has them as columns ``time``
    and ``mag`` and passes filters on them to the agency. Both give null where there is none."""

    time: Callable[[dict], datetime | None]
    mag: Callable[[dict], float | None]


_PUSHED = T.StructType(
    [*COLLECTED.fields, T.StructField("time", T.TimestampType()), T.StructField("mag", T.DoubleType())]
)


def window_rows(
    fetch: Fetch, start: datetime, end: datetime, policy: RetryPolicy, columns: EventColumns | None = None
) -> Iterator[tuple]:
    """What a collecting source returns for a planned window."""
    window = (_utc(start), _utc(end))
    blank = () if columns is None else (None, None)
    yield (*window, *window, None, None, *blank)  # so that an empty window leaves a row too
    for since, until, document, error in fetch_window(fetch, start, end, policy):
        text = None if document is None else json.dumps(document)
        more = blank
        if columns is not None and document is not None:
            moment = columns.time(document)
            more = (None if moment is None else _utc(moment), columns.mag(document))
        yield (*window, _utc(since), _utc(until), text, error, *more)


@dataclass
class Asked:
    """What the pushed filters leave of a period: times in [since, until] and a least magnitude."""

    since: datetime | None = None
    until: datetime | None = None
    least: float | None = None

    def narrow(self, pushed: Filter) -> None:
        """Takes in one filter; one it cannot use changes nothing."""
        name, value = getattr(pushed, "attribute", None), getattr(pushed, "value", None)
        above = isinstance(pushed, (EqualTo, GreaterThan, GreaterThanOrEqual))
        below = isinstance(pushed, (EqualTo, LessThan, LessThanOrEqual))
        if name == ("time",) and isinstance(value, datetime):
            value = _utc(value)
            if above:
                self.since = value if self.since is None else max(self.since, value)
            if below:
                self.until = value if self.until is None else min(self.until, value)
        elif name == ("mag",) and above and value is not None:
            self.least = float(value) if self.least is None else max(self.least, float(value))

    def wants(self, start: datetime, end: datetime) -> bool:
        """Whether the half-open window may hold an event that is asked for."""
        after = self.since is None or _utc(end) > self.since
        return after and (self.until is None or _utc(start) <= self.until)


def windowed_event_source(
    fetch: Fetch,
    start: datetime,
    end: datetime,
    days: int = WINDOW_DAYS,
    policy: RetryPolicy = RetryPolicy(),
    name: str = "windowed_events",
    columns: EventColumns | None = None,
) -> type[DataSource]:
    """A data source over [start, end); register it, then ``spark.read.format(name)``.

    With ``columns`` it also has ``time`` and ``mag``. Filters on ``time`` then drop planned windows
    before anything is asked, and a lower bound on ``mag`` goes into each request if ``fetch`` has
    ``at_least``. Spark applies the filters again, so rows are those of an unpushed filter.
    """
    windows = request_windows(start, end, days)

    class Reader(DataSourceReader):
        def __init__(self):
            self.asked = Asked()

        def partitions(self) -> list[InputPartition]:
            return [_Window(*window) for window in windows if self.asked.wants(*window)]

        def read(self, partition: _Window | None) -> Iterator[tuple]:
            if partition is None:  # Spark's stand-in for no partition at all
                return
            narrowed = at_least(fetch, self.asked.least)
            yield from window_rows(narrowed, partition.start, partition.end, policy, columns)

    class PushingReader(Reader):
        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            for pushed in filters:
                self.asked.narrow(pushed)
            return filters

    class WindowedEventSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return COLLECTED if columns is None else _PUSHED

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader() if columns is None else PushingReader()

    return WindowedEventSource


def collect_windows(spark: SparkSession, source: type[DataSource]) -> DataFrame:
    """Documents as text, each with its planned window and the part of it that it came in. Every
    read asks the agency again, so store the result (``store_collected``) before using it twice.
    Lets Spark push filters to sources written in Python, which others but this one ignore."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()


def parse_documents(collected: DataFrame, raw_schema: T.StructType) -> DataFrame:
    """Raw documents by the explicit schema, with the window and part each came in."""
    documents = collected.where(F.col("document").isNotNull())
    return documents.select(*_PLACES, F.from_json("document", raw_schema).alias("event")).select(
        *_PLACES, "event.*"
    )


_PLACES = ("window_start", "window_end", "part_start", "part_end")


def load_log(collected: DataFrame) -> DataFrame:
    """Documents, parts and errors per planned window; an empty window has a row of zeros."""
    part = F.when(F.col("document").isNotNull(), F.col("part_start"))
    return collected.groupBy("window_start", "window_end").agg(
        F.count("document").alias("saved"),
        F.count_distinct(part).alias("parts"),
        F.max("error").alias("error"),
    )


def store_collected(
    collected: DataFrame, raw_schema: T.StructType, path: str, log_path: str, fmt: str = "parquet"
) -> DataFrame:
    """Collect once into a folder of this run's own, then make it part of the table by one commit.

    The commit is the run's log, moved into place whole: per planned window the documents, parts and
    error, and this run. ``read_raw`` takes every window from the last run that had it whole, so a
    window with an error keeps what was stored of it before, and one that is empty now loses its old
    documents. A run that fails before its commit changes nothing that a reader sees. Returns the log.
    """
    spark, run = collected.sparkSession, uuid.uuid4().hex
    documents = collected.select(
        F.lit(run).alias("run"),
        window_name(F.col("window_start")).alias("window"),
        *_PLACES,
        F.col("document").isNotNull().alias("saved"),
        "error",
        F.from_json("document", raw_schema).alias("event"),
    )
    tables.write_table(documents, path, "append", fmt, partition_by=["run", "window"])
    own = spark.read.format(fmt).schema(documents.schema).load(path).where(F.col("run") == run)
    log = load_log(own.withColumn("document", F.when(F.col("saved"), F.lit(1))))
    log = log.select("*", window_name(F.col("window_start")).alias("window"), F.lit(run).alias("run"))
    rows = log.collect()  # the planned windows, a list the driver made
    log = spark.createDataFrame(rows, log.schema)
    commit_log(log, log_path, fmt)
    return log


def commit_log(log: DataFrame, log_path: str, fmt: str = "parquet") -> int:
    """Moves a run's log into place as the next commit and gives its number. Of two runs that commit
    at once, the second finds the number taken and takes the next."""
    spark = log.sparkSession
    pending = f"{log_path.rstrip('/')}/_pending-{uuid.uuid4().hex}"
    tables.write_table(log.coalesce(1), pending, fmt=fmt)
    number = max(_commits(spark, log_path), default=0) + 1
    while not move_new(spark, pending, f"{log_path.rstrip('/')}/commit={number}"):
        number += 1
    return number


def _commits(spark: SparkSession, log_path: str) -> list[int]:
    names = [name for name in child_folders(spark, log_path) if name.startswith("commit=")]
    return [int(name.removeprefix("commit=")) for name in names]


def read_log(spark: SparkSession, log_path: str, whole: bool = False, fmt: str = "parquet") -> DataFrame:
    """The last row of every window over all commits; with ``whole`` the last without an error."""
    log = spark.read.format(fmt).load(log_path)
    rows = log.where("error IS NULL") if whole else log
    columns = [name for name in log.columns if name not in ("window", "commit")]
    last = rows.groupBy("window").agg(F.max_by(F.struct(*columns), "commit").alias("last"))
    return last.select("window", "last.*")


def read_raw(
    spark: SparkSession, raw_schema: T.StructType, path: str, log_path: str, fmt: str = "parquet"
) -> DataFrame:
    """The committed documents with their window and part, as ``parse_documents`` gives them. Folders
    of runs that no window comes from any more are pruned, not read."""
    places = T.StructType([field for field in COLLECTED if field.name in _PLACES])
    stored = T.StructType(
        [
            *places.fields,
            T.StructField("saved", T.BooleanType()),
            T.StructField("event", raw_schema),
            T.StructField("run", T.StringType()),
            T.StructField("window", T.StringType()),
        ]
    )
    current = read_log(spark, log_path, whole=True, fmt=fmt).where("saved > 0").select("run", "window")
    rows = spark.read.format(fmt).schema(stored).load(path).where("saved")
    return rows.join(current, ["run", "window"], "left_semi").select(*_PLACES, "event.*")


def remove_unused_runs(spark: SparkSession, path: str, log_path: str, fmt: str = "parquet") -> list[str]:
    """Deletes the folders of runs that no window comes from: replaced ones, and ones that failed
    before their commit. Not while a run is collecting, whose folder is not committed yet."""
    current = read_log(spark, log_path, whole=True, fmt=fmt).select("run").distinct()
    used = {f"run={row['run']}" for row in current.collect()}  # at most one run per planned window
    unused = [name for name in child_folders(spark, path) if name.startswith("run=") and name not in used]
    for name in unused:
        remove_path(spark, f"{path.rstrip('/')}/{name}")
    return unused


def window_name(start: Column) -> Column:
    """A window's name as a partition value: its start in UTC."""
    return F.date_format(start, "yyyyMMdd'T'HHmmss")


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
