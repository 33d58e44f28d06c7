"""A weighted sample that stands for all rows in a clustering by squared distances.

Half of a row's chance is the same for all, half grows with its squared distance from the mean, and
its weight is one over its chance (a lightweight coreset). Sums over the sample are then unbiased, and
far rows, which decide the cost of centres, are in it more often than in a plain sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.functions.hashing import sample_hash
from temblor.operators.features import vector_size

WEIGHT = "weight"
_HASH_BITS = 52  # of the row's hash; a double holds them exactly


def coreset(df: DataFrame, n: int, key: Sequence[str], features: str = "features", seed: int = 42) -> DataFrame:
    """About ``n`` rows of ``df``, at most that many on average, with their ``weight``.

    Two passes and no shuffle but of one row per task: one aggregate of the moments, then a filter by
    the hash of (seed, ``key``), so a task that runs again picks the same rows. Copies of a row are
    taken or left together. Rows that must be in anyway have weight one; ``df`` without rows, or of
    equal rows, is sampled evenly. ``weight`` replaces a column of that name.
    """
    if n < 1:
        raise ValueError("a coreset has at least one row")
    width = vector_size(df, features) if df.head() is not None else 0
    values = [F.get(vector_to_array(features), F.lit(i)) for i in range(width)]
    means = [F.avg(value).alias(f"m{i}") for i, value in enumerate(values)]
    spread = sum((F.var_pop(value) for value in values), F.lit(0.0))
    found = df.agg(F.count("*").alias("rows"), spread.alias("spread"), *means).head()
    rows, total = found["rows"], (found["spread"] or 0.0) * found["rows"]
    share = F.lit(1.0 / max(rows, 1))
    if total > 0:
        far = _squared_distance(values, [found[f"m{i}"] for i in range(width)])
        share = (share + far / total) / 2
    chance = F.least(F.lit(1.0), n * share)
    digits = F.substring(sample_hash(seed, key), 1, _HASH_BITS // 4)
    drawn = F.conv(digits, 16, 10).cast("double") / float(2**_HASH_BITS)
    return df.withColumn(WEIGHT, 1 / chance).where(drawn < 1 / F.col(WEIGHT))


def clustering_cost(rows: DataFrame, centres: Sequence[Sequence[float]], features: str = "features") -> float:
    """The summed squared distance of all rows to the nearest centre, in one pass."""
    width = len(centres[0])
    values = [F.get(vector_to_array(features), F.lit(i)) for i in range(width)]
    each = [_squared_distance(values, [float(x) for x in centre]) for centre in centres]
    nearest = each[0] if len(each) == 1 else F.least(*each)
    return rows.agg(F.sum(nearest).alias("cost")).head()["cost"] or 0.0


def _squared_distance(values: list[Column], place: Sequence[float]) -> Column:
    return sum(((value - x) * (value - x) for value, x in zip(values, place)), F.lit(0.0))
