"""An event catalogue derived from the ``events`` table, row for row.

It has out-of-range, null and blank values and other event types on purpose, spans all months
of a year, and is packed into each agency's nested document form for the raw-side queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.operators import clean
from temblor.plans.agencies import EMSC
from temblor.session import prepare

# Valid in Spark SQL and in DuckDB; {events} is the source table.
QUAKES_SQL = """
SELECT event_id AS id,
 CAST(concat('2025-', lpad(CAST(1 + event_id % 12 AS STRING), 2, '0'), '-',
             lpad(CAST(1 + event_id % 28 AS STRING), 2, '0'), ' ',
             lpad(CAST(event_id % 24 AS STRING), 2, '0'), ':00:00') AS TIMESTAMP) AS time,
 CAST((event_id * 7919) % 18101 AS DOUBLE) / 100 - 90.5 AS latitude,
 CAST((event_id * 104729) % 36101 AS DOUBLE) / 100 - 180.5 AS longitude,
 CASE WHEN event_id % 211 = 0 THEN NULL
      ELSE CAST((event_id * 31337) % 7301 AS DOUBLE) / 10 - 10 END AS depth,
 CASE WHEN event_id % 307 = 0 THEN NULL WHEN event_id % 977 = 0 THEN CAST(11 AS DOUBLE)
      WHEN value < 25 THEN value / 10 + 1.5 WHEN value < 150 THEN value / 50 + 3.5
      ELSE value / 160 + 5.5 END AS mag,
 CASE (event_id * 7 + user_id) % 20
   WHEN 0 THEN 'JAVA, INDONESIA' WHEN 1 THEN 'BANDA SEA' WHEN 2 THEN 'SOUTHERN CALIFORNIA'
   WHEN 3 THEN 'KURIL ISLANDS' WHEN 4 THEN 'OFF COAST OF NORTHERN CHILE'
   WHEN 5 THEN 'FIJI REGION' WHEN 6 THEN 'SOUTH OF FIJI ISLANDS'
   WHEN 7 THEN 'EASTERN NEW GUINEA REG., P.N.G.' WHEN 8 THEN 'VIRGIN ISLANDS'
   WHEN 9 THEN 'VIRGIN ISLANDS REGION' WHEN 10 THEN 'WESTERN TURKEY'
   WHEN 11 THEN 'GULF OF CALIFORNIA' WHEN 12 THEN '' WHEN 13 THEN NULL
   WHEN 14 THEN '10 km W of Ridgecrest, CA'
   WHEN 15 THEN 'NEAR EAST COAST OF HONSHU, JAPAN' WHEN 16 THEN 'SOUTHERN PERU'
   WHEN 17 THEN 'CRETE, GREECE' WHEN 18 THEN 'OAXACA, MEXICO'
   ELSE '5 km N of Volcano, Hawaii' END AS place,
 CASE event_type WHEN 'error' THEN 'sx' ELSE 'ke' END AS type
FROM {events}
"""

KEY = ["id"]


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue, unfiltered."""
    prepare(spark)
    return spark.sql(QUAKES_SQL, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def clean_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events with derived columns; ids are distinct, so nothing shuffles."""
    rows = clean.keep_event_type(quakes(spark, sf_dir), EMSC.event_type)
    return clean.derive_columns(clean.filter_ranges(clean.drop_missing(rows), EMSC.valid))


def placed_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with their country."""
    return EMSC.with_country(clean_quakes(spark, sf_dir))


def raw_usgs(df: DataFrame) -> DataFrame:
    """The catalogue as nested documents with epoch milliseconds and coordinate arrays.

    An event without a depth has a two-element coordinate array.
    """
    is_quake = F.col("type") == "ke"
    return df.select(
        F.col("id").cast("string").alias("id"),
        F.struct(
            F.unix_millis("time").alias("time"),
            "mag",
            "place",
            F.when(is_quake, "earthquake").otherwise("quarry blast").alias("type"),
        ).alias("properties"),
        F.struct(
            F.when(F.col("depth").isNull(), F.array("longitude", "latitude"))
            .otherwise(F.array("longitude", "latitude", "depth"))
            .alias("coordinates")
        ).alias("geometry"),
    )


def raw_emsc(df: DataFrame, auths: tuple[str, ...] = ("EMSC",)) -> DataFrame:
    """The catalogue as nested documents with ISO times, once per reporting agency."""
    reported = df.withColumn("auth", F.explode(F.array(*(F.lit(auth) for auth in auths))))
    return reported.select(emsc_document(F.col("auth")).alias("event")).select("event.*")


def emsc_document(auth: Column) -> Column:
    """One event as a nested document."""
    return F.struct(
        F.col("id").cast("string").alias("id"),
        F.struct(
            F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
            "depth",
            "mag",
            F.col("place").alias("flynn_region"),
            auth.alias("auth"),
            F.col("type").alias("evtype"),
            F.lit("mw").alias("magtype"),
            F.concat(F.lit("u"), F.col("id").cast("string")).alias("unid"),
        ).alias("properties"),
    )
