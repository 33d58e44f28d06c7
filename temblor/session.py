"""Session settings the engine relies on; each can be changed while a session runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Event times are UTC; month boundaries must not depend on where the job runs.
SETTINGS = {"spark.sql.session.timeZone": "UTC"}

# For a session of one's own, where the engine runs alone. HotSpot does not compile methods above
# 8000 bytes of bytecode; a generated stage that large would be interpreted, about ten times slower
# than without whole-stage codegen.
TUNING = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def prepare(spark: SparkSession) -> SparkSession:
    """Sets what results depend on, and nothing else, on the caller's session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
