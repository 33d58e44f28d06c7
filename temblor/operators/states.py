"""Month states: what descriptions need of a month, kept so that later months do not scan it again.

A state is one row per month: counts, means, squared deviations, extremes and a quantile sketch per
column, and co-moments per pair of columns. All of it merges, so a description of any months is made
from their few state rows, and only months that are new are read from the events.

Moments merge by their differences from the common mean, in the order of the months, so large means
lose no digits and the same states give the same sums. Counts, extremes and moments are those of a
full scan up to rounding; a quantile's rank is off by at most ``rank_error`` of the rows in 99 of 100
cases, whatever the number of months. The sketch draws at random, so quantiles vary inside that bound.

Null values count in no column; a pair takes rows in which none of the correlated columns is null.
Events without a time form a month of their own (null). Without events there are no states, and
descriptions of no states have no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.lineage import child_folders, remove_path
from temblor.operators.distribution import CORRELATED
from temblor.operators.eda import NUMERIC_COLUMNS
from temblor.sources.tables import write_table

MONTH = "year_month"  # of the clean table and of the states, both partitioned by it
SKETCH_SIZE = 800
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
#: A stored state.
STATE = f"""rows bigint, earliest_time timestamp, latest_time timestamp,
features array<struct<feature: string, n: bigint, mean: double, squares: double, minimum: double,
                      maximum: double, sketch: binary>>,
pairs array<struct<feature_a: string, feature_b: string, n: bigint, mean_a: double, mean_b: double,
                   squares_a: double, squares_b: double, products: double>>,
{MONTH} string"""


def rank_error(sketch_size: int = SKETCH_SIZE) -> float:
    """Share of the rows by which a quantile's rank may be off, with 99 % confidence."""
    return 2.296 / sketch_size**0.9723


def month_states(
    events: DataFrame,
    columns: Sequence[str] = NUMERIC_COLUMNS,
    correlated: Sequence[str] = CORRELATED,
    sketch_size: int = SKETCH_SIZE,
) -> DataFrame:
    """One state per month of ``events``: one aggregate, of which each task sends a row per month."""
    columns, correlated = list(columns), list(correlated)
    whole = F.lit(True)
    for name in correlated:
        whole = whole & F.col(name).isNotNull()
    values = {f"v{i}": F.col(name).cast("double") for i, name in enumerate(columns)}
    values |= {f"w{i}": F.when(whole, F.col(name).cast("double")) for i, name in enumerate(correlated)}
    month = F.date_format("time", "yyyy-MM").alias(MONTH)
    pairs = [(i, j) for i in range(len(correlated)) for j in range(i, len(correlated))]
    states = events.select(month, "time", *(value.alias(name) for name, value in values.items()))
    states = states.groupBy(MONTH).agg(
        F.count("*").alias("rows"),
        F.min("time").alias("earliest_time"),
        F.max("time").alias("latest_time"),
        *(
            F.struct(
                F.lit(name).alias("feature"),
                F.count(f"v{i}").alias("n"),
                F.avg(f"v{i}").alias("mean"),
                (F.var_pop(f"v{i}") * F.count(f"v{i}")).alias("squares"),
                F.min(f"v{i}").alias("minimum"),
                F.max(f"v{i}").alias("maximum"),
                F.kll_sketch_agg_double(f"v{i}", sketch_size).alias("sketch"),
            ).alias(f"f{i}")
            for i, name in enumerate(columns)
        ),
        *(
            F.struct(
                F.lit(correlated[i]).alias("feature_a"),
                F.lit(correlated[j]).alias("feature_b"),
                F.count(f"w{i}").alias("n"),
                F.avg(f"w{i}").alias("mean_a"),
                F.avg(f"w{j}").alias("mean_b"),
                (F.var_pop(f"w{i}") * F.count(f"w{i}")).alias("squares_a"),
                (F.var_pop(f"w{j}") * F.count(f"w{j}")).alias("squares_b"),
                (F.covar_pop(f"w{i}", f"w{j}") * F.count(f"w{i}")).alias("products"),
            ).alias(f"p{i}_{j}")
            for i, j in pairs
        ),
    )
    return states.select(
        MONTH,
        "rows",
        "earliest_time",
        "latest_time",
        F.array(*(f"f{i}" for i in range(len(columns)))).alias("features"),
        F.array(*(f"p{i}_{j}" for i, j in pairs)).alias("pairs"),
    )


def stored_months(spark: SparkSession, path: str) -> set[str | None]:
    """Months of a table partitioned by month, from the names of its folders."""
    found = {name.partition("=")[2] for name in child_folders(spark, path) if name.startswith(f"{MONTH}=")}
    return {None if month == _NO_MONTH else month for month in found}


def refresh(
    spark: SparkSession,
    clean: DataFrame,
    clean_path: str,
    path: str,
    again: Iterable[str | None] = (),
    **parameters,
) -> set[str | None]:
    """Brings the states at ``path`` up to the clean table, and gives the months that were read.

    These are the months without a state, the latest one that has one, since it may have gone on, and
    those named in ``again``, whose events were changed. The others' files are not read. States of
    months that the clean table has lost go. ``clean`` is the table at ``clean_path``, partitioned by
    month; ``parameters`` are those of ``month_states``, and must not change between refreshes.
    Each month's state is replaced as a whole, so a refresh that was stopped is simply run again.
    """
    present, done = stored_months(spark, clean_path), stored_months(spark, path)
    for month in done - present:
        remove_path(spark, f"{path.rstrip('/')}/{MONTH}={_NO_MONTH if month is None else month}")
    named = [month for month in done if month is not None]
    due = (present - done | set(again) | ({max(named)} if named else set())) & present
    if due:
        states = month_states(clean.where(_any_of(due)), **parameters)
        write_table(states, path, partition_by=[MONTH], partitionOverwriteMode="dynamic")
    return due


def _any_of(months: set[str | None]) -> Column:
    inside = F.col(MONTH).isin(sorted(month for month in months if month is not None))
    return inside | F.col(MONTH).isNull() if None in months else inside


def read_states(spark: SparkSession, path: str, since: str | None = None, before: str | None = None) -> DataFrame:
    """Stored states, of the months from ``since`` up to but without ``before`` if given (as 2025-07)."""
    stored = bool(stored_months(spark, path))
    states = spark.read.schema(STATE).parquet(path) if stored else spark.createDataFrame([], STATE)
    if since is not None:
        states = states.where(F.col(MONTH) >= since)
    return states if before is None else states.where(F.col(MONTH) < before)


def merged_features(states: DataFrame) -> DataFrame:
    """One row per feature over all months given: n, mean, squares, minimum, maximum and sketch."""
    parts = states.select(MONTH, F.inline("features")).where(F.col("n") > 0)
    moments = _in_order("n", "mean", "squares")
    start = "named_struct('n', 0L, 'mean', 0D, 'squares', 0D)"
    total = F.aggregate(moments, F.expr(start), _merged_moments)
    return (
        parts.groupBy("feature")
        .agg(
            total.alias("total"),
            F.min("minimum").alias("minimum"),
            F.max("maximum").alias("maximum"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
        .select("feature", "total.*", "minimum", "maximum", "sketch")
    )


def describe(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The description in long form: feature, metric, value; quantiles within ``rank_error``."""
    merged = merged_features(states)
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    shares = [float(p) for p in probabilities]
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares)))
    merged = merged.withColumn("found", found)
    values = {
        "count": F.col("n").cast("double"),
        "mean": F.col("mean"),
        "stddev": deviation,
        "min": F.col("minimum"),
        **{f"{100 * p:g}%": F.get("found", F.lit(i)) for i, p in enumerate(shares)},
        "max": F.col("maximum"),
    }
    metrics = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in values.items()]
    return merged.select("feature", F.inline(F.array(*metrics)))


def feature_stats(states: DataFrame, digits: int = 4) -> DataFrame:
    """Mean, minimum, maximum and deviation per feature, as ``eda.feature_stats`` gives them."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    merged = merged_features(states).withColumn("stddev", deviation)
    pieces = ("mean", "minimum", "maximum", "stddev")
    return merged.select("feature", *(F.round(piece, digits).alias(piece) for piece in pieces))


def correlation_matrix(states: DataFrame) -> DataFrame:
    """Pearson correlation of every pair, as ``distribution.correlation_matrix`` gives it."""
    parts = states.select(MONTH, F.inline("pairs")).where(F.col("n") > 0)
    moments = _in_order("n", "mean_a", "mean_b", "squares_a", "squares_b", "products")
    start = (
        "named_struct('n', 0L, 'mean_a', 0D, 'mean_b', 0D, 'squares_a', 0D, 'squares_b', 0D, 'products', 0D)"
    )
    total = F.aggregate(moments, F.expr(start), _merged_products)
    spread = F.sqrt(F.col("total.squares_a") * F.col("total.squares_b"))
    one_way = parts.groupBy("feature_a", "feature_b").agg(total.alias("total"))
    one_way = one_way.withColumn("correlation", F.try_divide("total.products", spread))
    names = ["feature_a", "feature_b"]
    both = F.when(F.col(names[0]) == F.col(names[1]), F.array(F.struct(*names))).otherwise(
        F.array(F.struct(*names), F.struct(F.col(names[1]).alias(names[0]), F.col(names[0]).alias(names[1])))
    )
    return one_way.select("correlation", F.inline(both)).select(*names, "correlation")


def monthly_trend(states: DataFrame, with_mag: bool = False, digits: int = 2) -> DataFrame:
    """Events per month, in order, as ``eda.monthly_trend`` gives them."""
    mag = F.get(F.filter("features", lambda part: part["feature"] == "mag"), F.lit(0))["mean"]
    extra = [F.round(mag, digits).alias("avg_magnitude")] if with_mag else []
    return states.select(F.col(MONTH).alias("month"), F.col("rows").alias("quake_count"), *extra).orderBy("month")


def time_range(states: DataFrame) -> DataFrame:
    """The first and last time and the number of events."""
    return states.agg(
        F.min("earliest_time").alias("earliest_time"),
        F.max("latest_time").alias("latest_time"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )


def _in_order(*names: str) -> Column:
    """The group's parts by month: one per month, so as few as there are months."""
    return F.array_sort(F.collect_list(F.struct(F.coalesce(MONTH, F.lit("")).alias("month"), *names)))


def _merged_moments(total: Column, part: Column) -> Column:
    n = total["n"] + part["n"]
    apart = part["mean"] - total["mean"]
    return F.struct(
        n.alias("n"),
        (total["mean"] + apart * part["n"] / n).alias("mean"),
        (total["squares"] + part["squares"] + apart * apart * total["n"] * part["n"] / n).alias("squares"),
    )


def _merged_products(total: Column, part: Column) -> Column:
    n = total["n"] + part["n"]
    apart_a, apart_b = part["mean_a"] - total["mean_a"], part["mean_b"] - total["mean_b"]
    weight = total["n"] * part["n"] / n
    return F.struct(
        n.alias("n"),
        (total["mean_a"] + apart_a * part["n"] / n).alias("mean_a"),
        (total["mean_b"] + apart_b * part["n"] / n).alias("mean_b"),
        (total["squares_a"] + part["squares_a"] + apart_a * apart_a * weight).alias("squares_a"),
        (total["squares_b"] + part["squares_b"] + apart_b * apart_b * weight).alias("squares_b"),
        (total["products"] + part["products"] + apart_a * apart_b * weight).alias("products"),
    )
