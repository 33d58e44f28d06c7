"""Helpers that the corpus operators share: reading tables, skew-proof look-ups, shared scratch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from temblor.lineage import scratch_path

#: Sub-keys a hot key is split into. A key with a third of all rows becomes this many keys. At most
#: 64, since the sub-keys that occur travel as the bits of one long.
SALTS = 64

#: Prefix of working columns, so that extra columns of the caller never clash with them.
OWN = "__temblor_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Scratch paths of the open blocks and of what lies outside of blocks, per thread or task of the
# caller: a block deletes only what its own caller wrote.
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())
_OUTSIDE: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("outside", default=None)


def _note(spark: SparkSession, path: str, blocks: tuple[list[str], ...]) -> None:
    """``path`` belongs to the innermost of ``blocks``, or goes with the next ``sweep``."""
    if blocks:
        blocks[-1].append(path)
        return
    if _OUTSIDE.get() is None:
        _OUTSIDE.set([])
    _OUTSIDE.get().append((spark, path))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into the shared folder and read back: the lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    _note(df.sparkSession, path, _BLOCKS.get())
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``written`` that nothing reads any more, before their block ends."""
    for stored in tables:
        if stored is not None:
            remove(stored.sparkSession, stored.scratch_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A block whose ``written`` tables go when it ends; it yields a writer for the block's result.

    The result belongs to the block around, if there is one, and else stays until ``sweep``.
    """
    own: list[str] = []
    around = _BLOCKS.get()
    _BLOCKS.set((*around, own))

    def result(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        _note(spark, path, around)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield result
    finally:
        _BLOCKS.set(around)
        for path in own:
            remove(spark, path)


def sweep() -> None:
    """Delete what was written outside of blocks and the results of ended ones; for callers that
    have stored what they made of them."""
    left = _OUTSIDE.get() or []
    while left:
        remove(*left.pop())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, a table read from Parquet, with each row's number from 0 on as ``name``.

    The order is that of the writing tasks' numbers, then of file names, then of rows in a file, so a
    table that was sorted and written is numbered in its sorted order, whatever partitions read it.
    """
    path, first = f"{OWN}path", f"{OWN}first"
    here = df.withColumns({path: F.col("_metadata.file_path"), name: F.col("_metadata.row_index")})
    files = here.groupBy(path).agg(F.count(F.lit(1)).alias("n"))
    task = F.regexp_extract(path, r"part-([0-9]+)[^/]*$", 1).try_cast("long")
    before = Window.orderBy(task, path).rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(F.col(path).alias(f"{path}_"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    both = here.join(starts, F.col(path) == F.col(f"{path}_"))
    return both.withColumn(name, F.col(name) + F.col(first)).select(*df.columns, name)


def group_values(
    df: DataFrame,
    keys: list[str],
    spread: Column,
    values: dict[str, Callable],
    having: Column | None = None,
) -> DataFrame:
    """``df`` with each column of ``values`` replaced by its ``F.min`` or ``F.max`` over the group.

    A plain join of rows with their group's aggregate sends all rows of a hot key to one task. Here
    rows take one of ``SALTS`` sub-keys; the aggregate, combined before its shuffle, also notes which
    sub-keys occur and comes back to exactly those, so the join's largest group is 1/SALTS of a hot
    key and its right side never has more rows than its left. Null keys form a group of their own.
    ``having`` keeps the groups for which it holds; it may use the replaced columns.
    """
    salt, other = f"{OWN}salt", f"{OWN}r_"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    merged = [least(name).alias(name) for name, least in values.items()]
    bits = F.bit_or(F.expr(f"shiftleft(1L, {salt})")).alias(salt)
    groups = salted.groupBy(*keys).agg(*merged, bits)
    groups = groups if having is None else groups.where(having)
    present = F.filter(
        F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.call_function("getbit", F.col(salt), s) == 1
    )
    right = groups.select(
        *[F.col(k).alias(other + k) for k in (*keys, *values)], F.explode(present).alias(other + salt)
    )
    on = F.col(salt) == F.col(other + salt)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(other + k))
    out = salted.join(right, on)
    return out.select(*[F.col(other + c).alias(c) if c in values else salted[c] for c in df.columns])


def group_value(
    df: DataFrame, keys: list[str], spread: Column, least: Callable, value: str, name: str
) -> DataFrame:
    """Every row with ``least`` of the column ``value`` over its group, as ``name``."""
    return group_values(df.withColumn(name, F.col(value)), keys, spread, {name: least})
