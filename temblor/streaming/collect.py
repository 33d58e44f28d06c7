"""Collecting request windows as they become due, going on where the last run stopped.

The stream's offset is a number of planned windows, so its checkpoint says which were asked for. Each
micro-batch is stored by ``store_collected``, which replaces windows by one commit: a batch that Spark
runs again after a failure takes the place of its first try and doubles nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from temblor.schemas import COLLECTED
from temblor.sources import collector
from temblor.sources.windows import WINDOW_DAYS


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class WindowPlan:
    """Windows of ``days`` from ``start`` on, up to ``end`` or without one. A window is due once it is
    over for ``settle``, the time in which the agency still adds events. Naive times are in UTC."""

    start: datetime
    end: datetime | None = None
    days: int = WINDOW_DAYS
    settle: timedelta = timedelta(0)

    def window(self, number: int) -> tuple[datetime, datetime]:
        step = timedelta(days=self.days)
        since = collector._utc(self.start) + number * step
        return since, since + step if self.end is None else min(since + step, collector._utc(self.end))

    def due(self, now: datetime) -> int:
        """How many windows are due; all come before those that are not."""
        step, over = timedelta(days=self.days), collector._utc(now) - self.settle
        whole = max((over - collector._utc(self.start)) // step, 0)
        if self.end is None:
            return whole
        period = collector._utc(self.end) - collector._utc(self.start)
        planned = max(-(-period // step), 0)
        return planned if over >= collector._utc(self.end) else min(whole, planned)


def window_stream_source(
    fetch: collector.Fetch,
    plan: WindowPlan,
    reached: int = 0,
    at_once: int | None = None,
    policy: collector.RetryPolicy = collector.RetryPolicy(),
    name: str = "due_windows",
    now: Callable[[], datetime] = utc_now,
) -> type[DataSource]:
    """A streaming source of the due windows with the columns of the batch one, a task per window.

    A micro-batch takes all windows that are due, or ``at_once`` beyond the ``reached`` ones, since
    Spark asks a source for its latest offset without saying where the stream is. Offsets below the
    checkpoint's give an empty batch and then those windows again, which changes no result.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self):
            self.reached = reached

        def initialOffset(self) -> dict:
            return {"windows": 0}

        def latestOffset(self) -> dict:
            due = plan.due(now())
            taken = due if at_once is None else min(due, self.reached + at_once)
            return {"windows": max(taken, self.reached)}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            self.reached = max(self.reached, end["windows"])
            numbers = range(start["windows"], end["windows"])
            return [collector._Window(*plan.window(number)) for number in numbers]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            return collector.window_rows(fetch, partition.start, partition.end, policy)

        def commit(self, end: dict) -> None:
            """Nothing to forget: the agency keeps its events."""

    class DueWindowSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return COLLECTED

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return Reader()

    return DueWindowSource


def windows_reached(spark: SparkSession, plan: WindowPlan, log_path: str) -> int:
    """How many windows from the plan's first on are in the raw table's log, with an error or whole."""
    if not collector._commits(spark, log_path):
        return 0
    starts = collector.read_log(spark, log_path).select(F.unix_micros("window_start").alias("at"))
    logged = {row["at"] for row in starts.collect()}  # a row per planned window
    number, epoch = 0, datetime.fromtimestamp(0, timezone.utc)
    while (plan.window(number)[0] - epoch) // timedelta(microseconds=1) in logged:
        number += 1
    return number


def collect_due(
    spark: SparkSession,
    fetch: collector.Fetch,
    plan: WindowPlan,
    raw_schema: T.StructType,
    path: str,
    log_path: str,
    checkpoint: str,
    at_once: int = 100,
    policy: collector.RetryPolicy = collector.RetryPolicy(),
    now: Callable[[], datetime] = utc_now,
) -> int:
    """Collects the windows that are due and not yet stored, ``at_once`` a batch, and returns how many.

    Each batch is a commit of the raw table, so a stop loses at most one batch of requests; the next
    call goes on from ``checkpoint``. A window that failed for good and was logged counts as collected;
    ask for it again with the batch source. Calls must not overlap, and keep ``at_once`` while a batch
    is unfinished: with a lower one its windows may be asked for twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        collector.store_collected(batch, raw_schema, path, log_path)

    first = reached = windows_reached(spark, plan, log_path)
    stalled = 0
    while reached < plan.due(now()):
        source = window_stream_source(fetch, plan, reached, at_once, policy, now=now)
        spark.dataSource.register(source)
        rows = spark.readStream.format(source.name()).load()
        writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        before, reached = reached, windows_reached(spark, plan, log_path)
        stalled = 0 if reached > before else stalled + 1
        if stalled == 2:  # one run may do no more than end a batch whose windows were stored already
            raise RuntimeError(f"no window collected after the first {before}: {log_path} and {checkpoint} are not of one stream")
    return reached - first
