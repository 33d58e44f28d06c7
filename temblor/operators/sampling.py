"""Reproducible samples that stay bounded whatever the input size.

A plain ``row_number() <= n`` lets every task send ``n`` rows to the one task that merges them, so
its load grows with the number of tasks. Samples up to the size to which Spark limits groups before
a shuffle are merged in a tree instead: every task keeps its first ``n`` per stratum, groups of tasks
keep theirs, then the strata do, all in one scan. For larger samples one cheap aggregate counts rows
per hash size, which gives an exact cut above which no row can be chosen; about twice the wanted
rows pass the cut in a second scan, and only those are ranked. Both choose the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temblor.functions.hashing import below_fraction, hash_size, sample_hash

_HASH, _SIZE, _CUT, _COPIES = "_sample_hash", "_hash_size", "_cut_size", "_copies"
_TASKS, _RANK = "_task_group", "_rank"
#: Groups of tasks in the tree: a group merges a thousandth of the tasks, a stratum a thousand groups.
_TASK_GROUPS = 1024


def undersample(
    df: DataFrame,
    strata: str | Sequence[str],
    cap: int,
    key: Sequence[str],
    seed: int = 42,
) -> DataFrame:
    """At most ``cap`` rows per stratum, the first by hash of (seed, key); null is a stratum.

    ``key`` must tell events apart; whole-row copies are taken into account one by one.
    With cuts, strata that exceed the cap get one row each. Spark joins them as their real size
    suggests: broadcast when small, else by shuffle, where AQE splits a skewed stratum.
    """
    names = [strata] if isinstance(strata, str) else list(strata)
    if _limited_before_shuffles(df, cap):
        return _first_by_tree(df, names, cap, key, seed)
    hashed = _hashed(df, key, seed)
    cuts = _cuts(hashed, names, cap)
    cuts = cuts.withColumnsRenamed({name: f"_cut_{name}" for name in names})
    same = reduce(
        lambda left, right: left & right,
        [hashed[name].eqNullSafe(cuts[f"_cut_{name}"]) for name in names],
    )
    near = hashed.join(cuts, same, "left").where(
        F.col(_CUT).isNull() | (F.col(_SIZE) <= F.col(_CUT))
    )
    return _first_by_hash(near, df.columns, names, cap, key)


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, or all when there are fewer; the first by hash of (seed, key)."""
    if _limited_before_shuffles(df, n):
        return _first_by_tree(df, [], n, key, seed)
    hashed = _hashed(df, key, seed)
    cut = _cuts(hashed, [], n).head()
    if cut is None:
        return df
    near = hashed.where(F.col(_SIZE) <= cut[_CUT])
    return _first_by_hash(near, df.columns, [], n, key)


def hash_sample(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Each key with probability ``fraction``, without replacement; needs no shuffle."""
    return df.where(below_fraction(sample_hash(seed, key), fraction))


def plot_sample(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    fraction: float = 0.2,
    limit: int = 5000,
    seed: int = 42,
) -> DataFrame:
    """A bounded sample of complete rows for a chart: a fraction, then at most ``limit``."""
    needed = list(dict.fromkeys([*columns, *key]))
    complete = df.select(*needed).dropna(subset=list(columns))
    sampled = hash_sample(complete, fraction, key, seed)
    return sample_n(sampled, limit, key, seed).select(*columns)


def _limited_before_shuffles(df: DataFrame, n: int) -> bool:
    """Whether Spark keeps only the first ``n`` of a group in each task before it sends rows."""
    limit = df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    return n <= int(limit)


def _first_by_tree(
    df: DataFrame, strata: list[str], n: int, key: Sequence[str], seed: int
) -> DataFrame:
    """The first ``n`` rows per stratum by (hash, key), per group of tasks and then of all."""
    rows = df.withColumn(_HASH, sample_hash(seed, key)).withColumn(
        _TASKS, F.pmod(F.spark_partition_id(), F.lit(_TASK_GROUPS))
    )
    for group in ([*strata, _TASKS], strata or [F.lit(1)]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(_HASH, *key))
        rows = rows.withColumn(_RANK, rank).where(F.col(_RANK) <= n)
    return rows.select(*df.columns)


def _hashed(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    return df.withColumn(_HASH, sample_hash(seed, key)).withColumn(_SIZE, hash_size(F.col(_HASH)))


def _cuts(hashed: DataFrame, strata: list[str], n: int) -> DataFrame:
    """Strata of more than ``n`` rows, with the smallest hash size that covers ``n`` of them.

    Per stratum the aggregate has at most 15 rows per hash digit, so the window is small.
    """
    one_group = [F.lit(1)] if not strata else strata
    sizes = hashed.groupBy(*strata, _SIZE).agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy(*one_group).orderBy(_SIZE))
    return (
        sizes.withColumn("_running", running)
        .groupBy(*strata)
        .agg(
            F.min(F.when(F.col("_running") >= n, F.col(_SIZE))).alias(_CUT),
            F.sum("_n").alias("_total"),
        )
        .where(F.col("_total") > n)
        .drop("_total")
    )


def _first_by_hash(
    near: DataFrame, columns: list[str], strata: list[str], n: int, key: Sequence[str]
) -> DataFrame:
    """The first ``n`` rows per stratum by (hash, key), copies of a row merged before ranking."""
    one_group = [F.lit(1)] if not strata else strata
    merged = near.groupBy(*columns, _HASH).agg(F.count("*").alias(_COPIES))
    earlier = Window.partitionBy(*one_group).orderBy(_HASH, *key).rowsBetween(
        Window.unboundedPreceding, -1
    )
    room = n - F.coalesce(F.sum(_COPIES).over(earlier), F.lit(0))
    return (
        merged.withColumn("_room", room)
        .where(F.col("_room") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(_COPIES, "_room"))))
        .select(*columns)
    )
