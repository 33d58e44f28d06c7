"""Exact quantiles without gathering a column in one task.

Spark's exact percentile keeps every distinct value in one aggregation buffer. Here a sketch
brackets each quantile, an exact count shows where in the bracket its rank lies, and the search
goes on inside the bracket, whose rows shrink by the sketch's accuracy each time. Only when a
bracket holds few rows are its values gathered. A value that fills a large part of the table
becomes an end of a bracket, and ends are counted, never gathered.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class _Search:
    """Looks for the value of 1-based ``rank`` among the ``rows`` values in (low, high)."""

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def done(self) -> bool:
        return self.value is not None

    def inside(self) -> Column:
        value = F.col(self.column)
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > self.low)
        if self.high is not None:
            test = test & (value < self.high)
        return test

    def ends(self, accuracy: int) -> list[float]:
        """Shares between which the wanted share of the interval lies."""
        slack, share = 2.0 / accuracy, self.rank / self.rows
        return [max(0.0, share - slack), min(1.0, share + slack)]

    def between(self, low: float, high: float) -> Column:
        value = F.col(self.column)
        return self.inside() & (value > low) & (value < high)

    def count(self, low: float, high: float) -> Column:
        value, inside = F.col(self.column), self.inside()
        parts = {
            "below": inside & (value < low),
            "at_low": inside & (value == low),
            "between": self.between(low, high),
            "at_high": inside & (value == high),
        }
        # count(when) rather than count_if: Spark computes the tests of many count_if in one
        # projection, whose generated method grows too long to be compiled.
        return F.struct(
            *(F.count(F.when(part, F.lit(1))).alias(name) for name, part in parts.items())
        )

    def narrow(self, low: float, high: float, seen) -> None:
        """Goes on in the part that holds the rank, given how many values lie in each."""
        rank = self.rank - seen["below"]
        if rank <= 0:
            self.high, self.rows = low, seen["below"]
            return
        if rank <= seen["at_low"]:
            self.value = low
            return
        rank -= seen["at_low"]
        if rank <= seen["between"]:
            self.low, self.high, self.rank, self.rows = low, high, rank, seen["between"]
            return
        rank -= seen["between"]
        if low < high and rank <= seen["at_high"]:
            self.value = high
            return
        upto = seen["below"] + seen["at_low"] + seen["between"]
        upto += seen["at_high"] if low < high else 0
        self.low, self.rank, self.rows = high, self.rank - upto, self.rows - upto


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = 10_000,
    gather_rows: int = 20_000,
) -> dict[tuple[str, float], float | None]:
    """The smallest value with at least that share of values at or below it, per column.

    Null values do not count; a column without values gives None. See ``quantiles_and_more``.
    """
    return quantiles_and_more(df, columns, probabilities, {}, accuracy, gather_rows)[0]


def quantiles_and_more(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    more: dict[str, Column],
    accuracy: int = 10_000,
    gather_rows: int = 20_000,
) -> tuple[dict[tuple[str, float], float | None], dict]:
    """Exact quantiles, and other aggregates that ride on their first pass.

    Tables of any size take the same way: one pass for sizes, the first sketch and ``more``, one
    that counts where the rank lies, and one that gathers what is left between two neighbours of
    the sketch. Only if more than ``gather_rows`` are left, beyond some hundred million rows, a
    sketch and a count of that interval come in between. A pass that neither finds nor narrows
    anything shows a source that answers differently each time, and raises.
    """
    slack = 2.0 / accuracy
    shares = [s for p in probabilities for s in (max(0.0, p - slack), min(1.0, p + slack))]
    first = df.agg(
        *(F.count(name).alias(f"n{i}") for i, name in enumerate(columns)),
        *(F.percentile_approx(name, shares, accuracy).alias(f"s{i}") for i, name in enumerate(columns)),
        *(column.alias(f"m{i}") for i, column in enumerate(more.values())),
    ).head()
    searches, brackets = {}, []
    for i, name in enumerate(columns):
        rows = first[f"n{i}"]
        for j, share in enumerate(probabilities):
            search = _Search(name, max(1, math.ceil(share * rows)), rows)
            searches[name, share] = search
            if rows:
                brackets.append((search, first[f"s{i}"][2 * j : 2 * j + 2]))
    while brackets:
        _narrow(df, brackets)
        small = [s for s, _ in brackets if not s.done and s.rows <= gather_rows]
        if small:
            _gather(df, small)
        large = [s for s, _ in brackets if not s.done]
        brackets = list(zip(large, _brackets(df, large, accuracy))) if large else []
    values = {key: search.value for key, search in searches.items()}
    return values, {name: first[f"m{i}"] for i, name in enumerate(more)}


def _narrow(df: DataFrame, brackets: list[tuple[_Search, list[float]]]) -> None:
    """One pass that counts around the brackets of all searches."""
    seen = df.agg(
        *(search.count(*ends).alias(f"c{i}") for i, (search, ends) in enumerate(brackets))
    ).head()
    for i, (search, ends) in enumerate(brackets):
        before = search.rows
        search.narrow(*ends, seen[i])
        if not search.done and search.rows >= before or search.value is None and search.rows <= 0:
            raise _changed(search)


def _changed(search: _Search) -> RuntimeError:
    return RuntimeError(
        f"the values of {search.column} changed between passes; write the table before describing it"
    )


def _brackets(df: DataFrame, searches: list[_Search], accuracy: int) -> list[list[float]]:
    """A bracket per search, from one sketch per distinct interval of a column."""
    intervals: dict[tuple, list[int]] = {}
    for i, search in enumerate(searches):
        intervals.setdefault((search.column, search.low, search.high), []).append(i)
    sketches = []
    for members in intervals.values():
        first = searches[members[0]]
        shares = [share for i in members for share in searches[i].ends(accuracy)]
        values = F.when(first.inside(), F.col(first.column))
        sketches.append(F.percentile_approx(values, shares, accuracy))
    found = df.agg(*(sketch.alias(f"s{i}") for i, sketch in enumerate(sketches))).head()
    brackets: list[list[float]] = [[]] * len(searches)
    for values, members in zip(found, intervals.values()):
        for place, i in enumerate(members):
            brackets[i] = values[2 * place : 2 * place + 2]
    return brackets


def _gather(df: DataFrame, searches: list[_Search]) -> None:
    """Finds the wanted value among the few that are left of each search."""
    near = [
        F.struct(
            F.lit(i).alias("search"),
            F.lit(search.rank).alias("rank"),
            F.when(search.inside(), F.col(search.column).cast("double")).alias("value"),
        )
        for i, search in enumerate(searches)
    ]
    any_inside = reduce(operator.or_, [search.inside() for search in searches])
    found = (
        df.where(any_inside)
        .select(F.inline(F.array(*near)))
        .where(F.col("value").isNotNull())
        .groupBy("search", "rank")
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
        .select("search", F.get("values", F.col("rank") - 1).alias("value"))
    )
    for row in found.collect():
        searches[row["search"]].value = row["value"]
    for search in searches:
        if search.value is None:
            raise _changed(search)
