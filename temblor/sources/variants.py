"""Raw documents as they came, in Spark's VARIANT type, when not every field is known beforehand.

An explicit schema drops what it does not list. As a variant a document keeps all of its fields in a
binary form that Parquet stores; any of them can be asked for later, and an aggregate over a window
says what there is to ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACES = ("window_start", "window_end", "part_start", "part_end")


def parse_variants(collected: DataFrame) -> DataFrame:
    """Collected documents as a variant ``event``, with the window and part each came in. A text that
    is no JSON keeps its row, with a null event and the text in ``unparsed``."""
    event = F.try_parse_json("document")
    unparsed = F.when(event.isNull(), F.col("document"))
    documents = collected.where(F.col("document").isNotNull())
    return documents.select(*_PLACES, event.alias("event"), unparsed.alias("unparsed"))


def field(path: str, kind: str, event: str = "event") -> Column:
    """A field of the documents by its path, such as ``$.properties.mag``; null where a document has
    none or its value cannot be of the kind."""
    return F.try_variant_get(F.col(event), path, kind)


def typed(events: DataFrame, raw_schema: T.StructType, *others: Column) -> DataFrame:
    """The fields of an explicit schema, as ``parse_documents`` gives them, and ``others`` beside them.

    Each leaf is taken by its own path, so one value of a wrong kind costs that value, not its row.
    """
    columns = [_taken(raw_field, f"$['{raw_field.name}']").alias(raw_field.name) for raw_field in raw_schema]
    return events.select(*_PLACES, *columns, *others)


def _taken(raw_field: T.StructField, path: str) -> Column:
    if isinstance(raw_field.dataType, T.StructType):
        return F.struct(*(_taken(f, f"{path}['{f.name}']").alias(f.name) for f in raw_field.dataType))
    return field(path, raw_field.dataType.simpleString())


def shape_by_window(events: DataFrame) -> DataFrame:
    """What the documents of each window hold: their number, those that were no JSON, and the merged
    schema of the rest as DDL. One aggregate; schemas merge inside a task before anything is sent."""
    return events.groupBy("window_start", "window_end").agg(
        F.count("*").alias("documents"),
        F.count("unparsed").alias("unparsed"),
        F.schema_of_variant_agg("event").alias("shape"),
    )


def field_names(shape: Column) -> Column:
    """The distinct field names in a merged schema, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(shape, F.lit(r"(\w+): "), F.lit(1))))
