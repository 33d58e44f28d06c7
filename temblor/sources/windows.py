"""Request windows: half-open, gap-free slices of a period."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_DAYS = 15


def plan_windows(period: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Windows of ``days`` that tile [start, end) of each row of ``period``; the last is cut.

    ``period`` has timestamp columns ``start`` and ``end``.
    """
    step = F.make_interval(days=F.lit(days))
    starts = F.sequence("start", F.col("end") - F.expr("interval 1 microsecond"), step)
    return (
        period.where(F.col("start") < F.col("end"))
        .select("end", F.posexplode(starts).alias("window_id", "window_start"))
        .select(
            "window_id",
            "window_start",
            F.least(F.col("window_start") + step, F.col("end")).alias("window_end"),
        )
    )


def years_of(df: DataFrame) -> DataFrame:
    """The period of whole years that holds every ``time`` of ``df``, as one row."""
    first, last = F.date_trunc("year", F.min("time")), F.date_trunc("year", F.max("time"))
    end = last + F.expr("interval 1 year")
    micros = df.agg(F.unix_micros(first).alias("start"), F.unix_micros(end).alias("end")).head()
    return df.sparkSession.range(1).select(
        *(F.timestamp_micros(F.lit(micros[name]).cast("bigint")).alias(name) for name in ("start", "end"))
    )


def window_counts(df: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Events per request window over the years of ``df``, empty windows included.

    Two passes: one for the period, one for the counts. An event finds its window by
    arithmetic, so no range join is needed; the windows of a period are few and bounded by
    its length.
    """
    period = years_of(df)
    planned = plan_windows(period, days)
    start = period.select(F.unix_micros("start")).head()[0]
    if start is None:
        return planned.withColumn("quake_count", F.lit(0).cast("bigint"))
    width = days * 86_400_000_000
    window = F.floor((F.unix_micros("time") - start) / width).cast("int").alias("window_id")
    counts = df.groupBy(window).agg(F.count("*").alias("quake_count"))
    return planned.join(counts, "window_id", "left").withColumn(
        "quake_count", F.coalesce("quake_count", F.lit(0))
    )


def request_windows(
    start: datetime, end: datetime, days: int = WINDOW_DAYS
) -> list[tuple[datetime, datetime]]:
    """The same tiling as plain values, for the partitions of a collecting job."""
    step = timedelta(days=days)
    count = -(-(end - start) // step)
    return [(start + i * step, min(start + (i + 1) * step, end)) for i in range(count)]
