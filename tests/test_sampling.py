"""Samples: exact sizes, independence of partitioning, copies, skew."""

import hashlib
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from temblor.functions.hashing import hash_size, sample_hash
from temblor.operators import sampling

KEY = ["id"]


def expected_order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.fixture(scope="module")
def numbers(spark):
    """A hot stratum with a third of the rows, small ones and a null one."""
    stratum = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string")))
    )
    return spark.range(6000).withColumn("country", stratum).cache()


def test_hash_is_the_md5_of_seed_and_key(spark):
    row = spark.range(7, 8).select(sample_hash(42, KEY).alias("h")).head()
    assert row.h == hashlib.md5(b"42:7").hexdigest()


def test_hash_size_follows_the_hash_order(spark):
    df = spark.range(3000).select(sample_hash(1, KEY).alias("h"))
    rows = df.select("h", hash_size(F.col("h")).alias("s")).orderBy("h").collect()
    sizes = [row.s for row in rows]
    assert sizes == sorted(sizes)
    assert all(row.h.startswith(row.s) and row.s.lstrip("0") == row.s[-1] for row in rows)
    zeros = spark.range(1).select(hash_size(F.lit("0" * 32)).alias("s")).head().s
    assert zeros == "0" * 32


def per_stratum(rows):
    return Counter(row.country for row in rows)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_undersample_caps_each_stratum_whatever_the_partitions(numbers, partitions):
    sizes = per_stratum(numbers.collect())
    chosen = sampling.undersample(numbers.repartition(partitions), "country", 100, KEY).collect()
    assert per_stratum(chosen) == {name: min(100, size) for name, size in sizes.items()}
    hot = [row.id for row in numbers.collect() if row.country == "hot"]
    assert {row.id for row in chosen if row.country == "hot"} == set(expected_order(hot)[:100])


@contextmanager
def setting(spark, name, value):
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def in_order(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_undersample_by_cuts_and_either_join_gives_the_same(spark, numbers):
    by_tree = in_order(sampling.undersample(numbers, "country", 50, KEY))
    with setting(spark, LIMIT, "-1"):
        assert in_order(sampling.undersample(numbers, "country", 50, KEY)) == by_tree
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            assert in_order(sampling.undersample(numbers, "country", 50, KEY)) == by_tree


@pytest.mark.parametrize("limit", ["-1", "1000"])
def test_more_task_groups_than_tasks_and_fewer(spark, numbers, monkeypatch, limit):
    expected = in_order(sampling.undersample(numbers, "country", 40, KEY))
    monkeypatch.setattr(sampling, "_TASK_GROUPS", 3)
    with setting(spark, LIMIT, limit):
        assert in_order(sampling.undersample(numbers.repartition(11), "country", 40, KEY)) == expected
        assert {r.id for r in sampling.sample_n(numbers.repartition(11), 40, KEY).collect()} == set(
            expected_order(range(6000))[:40]
        )


def test_a_small_sample_scans_once_and_limits_before_it_sends(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).withColumn("country", F.col("id") % 7).write.parquet(path)
    chosen = sampling.undersample(spark.read.parquet(path), "country", 30, KEY)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("row_number(), 30, Partial") == 2
    assert per_stratum(chosen.collect()) == {name: 30 for name in range(7)}
    nothing = spark.read.parquet(path).where("id < 0")
    assert sampling.undersample(nothing, "country", 30, KEY).collect() == []
    assert sampling.sample_n(nothing, 30, KEY).collect() == []


def test_undersample_of_two_columns(numbers):
    df = numbers.withColumn("odd", F.col("id") % 2)
    chosen = sampling.undersample(df, ["country", "odd"], 20, KEY).collect()
    assert max(Counter((row.country, row.odd) for row in chosen).values()) == 20


def test_nothing_over_the_cap_keeps_all(numbers):
    chosen = sampling.undersample(numbers, "country", 10_000, KEY)
    assert chosen.exceptAll(numbers).isEmpty() and chosen.count() == numbers.count()


@pytest.mark.parametrize("limit", ["-1", "1000"])
def test_copies_count_one_by_one(spark, limit):
    df = spark.range(100).union(spark.range(5, 6).crossJoin(spark.range(300)).toDF("id", "n").select("id"))
    df = df.withColumn("country", F.lit("x"))
    order = expected_order(range(100))
    before = order.index(5)
    with setting(spark, LIMIT, limit):
        chosen = Counter(row.id for row in sampling.undersample(df, "country", before + 10, KEY).collect())
    assert sum(chosen.values()) == before + 10
    assert chosen[5] == 10 and set(chosen) == set(order[: before + 1])


def test_only_rows_near_the_cut_are_ranked(spark):
    """About twice the wanted rows pass the cut, of a table a thousand times as large."""
    df = spark.range(200_000)
    hashed = sampling._hashed(df, KEY, 42)
    cut = sampling._cuts(hashed, [], 200).head()[sampling._CUT]
    near = hashed.where(F.col(sampling._SIZE) <= cut).count()
    assert 200 <= near <= 600


@pytest.mark.parametrize("n", [1, 300, 6000, 7000])
def test_sample_n_is_exact(numbers, n):
    chosen = sampling.sample_n(numbers.repartition(5), n, KEY).collect()
    assert {row.id for row in chosen} == set(expected_order(range(6000))[:n])
    assert len(chosen) == min(n, 6000)


def test_other_seeds_choose_other_rows(numbers):
    first = {row.id for row in sampling.sample_n(numbers, 100, KEY, seed=1).collect()}
    second = {row.id for row in sampling.sample_n(numbers, 100, KEY, seed=2).collect()}
    assert first != second


def test_fraction(numbers):
    n = sampling.hash_sample(numbers, 0.2, KEY).count()
    assert 1000 < n < 1400
    again = sampling.hash_sample(numbers.repartition(9), 0.2, KEY).count()
    assert n == again
    assert sampling.hash_sample(numbers, 1.0, KEY).count() == 6000
    assert sampling.hash_sample(numbers, 0.0, KEY).count() == 0


def test_plot_sample_drops_incomplete_rows_and_is_bounded(numbers):
    df = numbers.withColumn("v", F.when(F.col("id") % 2 == 0, F.col("id")))
    chosen = sampling.plot_sample(df, ["v"], KEY, fraction=0.5, limit=100)
    assert chosen.columns == ["v"]
    rows = chosen.collect()
    assert len(rows) == 100 and all(row.v is not None for row in rows)
