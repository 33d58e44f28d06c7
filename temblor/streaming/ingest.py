"""Raw documents as they land to valid events, without a rescan of what is already read.

Only steps that look at one row run on the stream: flattening, filters, country and derived
columns. There is no watermark and no state, so an event that arrives late, out of order or without
a time is kept like any other. Copies are merged where the table is read as a whole, by
``distinct_events``, since only the whole table knows all copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from temblor.operators.clean import dedup_events, derive_columns
from temblor.plans.agencies import Agency
from temblor.plans.stages import valid_events


def read_landed(spark: SparkSession, path: str, agency: Agency, fmt: str = "json") -> DataFrame:
    """Raw documents of an agency from files that keep arriving below ``path``."""
    return spark.readStream.format(fmt).schema(agency.raw_schema).load(path)


def valid_stream(raw: DataFrame, agency: Agency) -> DataFrame:
    """Valid events with derived columns; copies are still in."""
    return derive_columns(agency.with_country(valid_events(raw, agency)))


def write_valid_stream(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Appends valid events to a table partitioned by month; events without a time have their own."""
    months = events.withColumn("year_month", F.date_format("time", "yyyy-MM"))
    writer = (
        months.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("year_month")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)


def distinct_events(stored: DataFrame) -> DataFrame:
    """Each event of the stream's table once; copies inside a task merge before the shuffle."""
    return dedup_events(stored.drop("year_month"))
