"""Quality rules whose cutoffs are chosen on labelled documents with a bound on false rejections.

Each rule rejects documents whose measure is above a cutoff from a fixed grid. In every stratum
(by default a language) a cutoff may be used only if the labelled holdout proves, by an exact
binomial test, that it rejects at most ``risk / rules`` of the good documents. Testing goes from the
most lenient cutoff to the strictest and stops at the first that is not proven (fixed sequence),
and the error probability is divided by the number of rules and strata (Bonferroni). So with
probability ``1 - error`` all rules together reject at most ``risk`` of the good documents in every
stratum. Of the proven cutoffs, the one with the best balance of bad and good rejections is used;
since all of them are proven at once, this choice costs nothing. A stratum with too few labels gets
no cutoff and loses nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: The columns of a document's measures. The first five are the base of the contract.
MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("n_upper", T.LongType()),
        T.StructField("n_lower", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_marks", T.LongType()),
    ]
)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def measure_text(text: str | None) -> tuple[int, ...]:
    """All measures of one whole text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    lines, seen, filled, again = text.split("\n"), set(), 0, 0
    for line in lines:
        if line.strip(SPACES):
            filled += 1
            again += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        again,
        repeated_words(words),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LOWER)),
        filled,
        text.count("!") + text.count("?"),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first, covered = {}, bytearray(len(words))
    for at, window in enumerate(windows):
        before = first.setdefault(window, at)
        if before != at:
            covered[at : at + 3] = covered[before : before + 3] = b"\x01\x01\x01"
    return sum(covered)


@F.arrow_udf(MEASURES)
def measures(text: pa.Array) -> pa.Array:
    """One text at a time leaves the batch, so only the batch itself is held."""
    rows = [measure_text(t.as_py()) for t in text]
    columns = zip(*rows, strict=True) if rows else [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=MEASURES.names)


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``part / whole`` is above the cutoff."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[float, ...]

    def value(self, m: Column) -> Column:
        return m[self.part] / F.greatest(m[self.whole], F.lit(1))

    def step(self, m: Column) -> Column:
        """How many cutoffs, from the strictest on, the value is above."""
        value = self.value(m)
        return sum(((value > F.lit(c)).cast("int") for c in self.cutoffs), F.lit(0))


_SHARES = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9)
RULES = (
    Rule("symbols", "n_symbols", "n_words", (0.02, *_SHARES, 1.0, 1.5, 2.0, 2.5)),
    Rule("repeats", "n_repeat_words", "n_words", _SHARES),
    Rule("dup_lines", "n_dup_lines", "n_lines", _SHARES),
    Rule("upper", "n_upper", "n_lower", (*_SHARES, 1.0, 2.0, 5.0)),
    Rule("marks", "n_marks", "n_words", (0.02, *_SHARES, 1.0, 1.5)),
)


@dataclass(frozen=True)
class Risk:
    """Bound on the share of good documents rejected, its error probability, and the price of one
    good document rejected, in bad ones, when choosing among proven cutoffs."""

    risk: float = 0.05
    error: float = 0.05
    price: float = 20.0


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(Bin(n, p) <= k), all its terms summed; 1 for an empty holdout."""
    if n == 0:
        return 1.0
    if k >= n:
        return 1.0
    if not 0 < p < 1:
        return 1.0 if p <= 0 else 0.0
    last = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    # downwards from k, in units of the k-th term, until what is left is nil beside the sum
    total, term, scale = 1.0, 1.0, 0.0
    for i in range(k, 0, -1):
        ratio = i / (n - i + 1) * (1 - p) / p
        term *= ratio
        total += term
        if total > 1e250:
            total, term, scale = total / 1e250, term / 1e250, scale + math.log(1e250)
        if ratio < 1 and term < total * (1 - ratio) * 1e-17:
            break
    return min(1.0, math.exp(last + scale + math.log(total)))


def choose_cutoff(
    cutoffs: tuple[float, ...], good: list[int], bad: list[int], risk: float, error: float, price: float
) -> float | None:
    """``good[i]`` and ``bad[i]``: labelled documents above exactly ``i`` cutoffs."""
    n, best, chosen = sum(good), 0.0, None
    for i in range(len(cutoffs) - 1, -1, -1):  # from the most lenient
        false, true = sum(good[i + 1 :]), sum(bad[i + 1 :])
        if false > risk * n or binomial_tail(n, false, risk) > error:
            break
        if true - price * false > best:
            best, chosen = true - price * false, cutoffs[i]
    return chosen


def measured(docs: DataFrame, name: str = f"{OWN}m") -> DataFrame:
    """``docs`` with a struct column of measures of the whole ``text``."""
    return docs.withColumn(name, measures(F.col("text")))


def fit_cutoffs(
    table: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, risk: Risk = Risk(), m: str = f"{OWN}m"
) -> DataFrame:
    """``stratum`` and one nullable column per rule with its cutoff.

    ``table`` has ``doc_id``, the stratum and measures; ``labels`` ``doc_id`` and ``quality``. A
    document labelled more than once counts as good only if every label says so; rows without id
    or label do not count. The holdout is counted where it lies; only counts per stratum, rule and
    step meet, at most ``len(cutoffs) + 1`` rows a group.
    """
    key = f"{OWN}stratum"
    truth = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias(f"{OWN}good"))
    )
    held = table.select("doc_id", F.col(stratum).alias(key), F.col(m).alias(m)).join(truth, "doc_id")
    steps = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), r.step(F.col(m)).alias("step")) for r in rules])
    )
    counts = (
        held.select(key, f"{OWN}good", steps.alias("s"))
        .groupBy(key, "s.rule", "s.step")
        .agg(F.sum((F.col(f"{OWN}good") > 0).cast("long")).alias("good"), F.count(F.lit(1)).alias("n"))
    )
    counts = written(counts, "quality-counts")
    strata = max(1, counts.select(key).distinct().count())
    grid = {r.name: r.cutoffs for r in rules}
    per_rule, error = risk.risk / len(rules), risk.error / (len(rules) * strata)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        name = rows["rule"].iloc[0]
        good, bad = [0] * (len(grid[name]) + 1), [0] * (len(grid[name]) + 1)
        for step, g, n in zip(rows["step"], rows["good"], rows["n"], strict=True):
            good[step], bad[step] = int(g), int(n - g)
        cutoff = choose_cutoff(grid[name], good, bad, per_rule, error, risk.price)
        return pd.DataFrame({key: rows[key].iloc[:1], "rule": [name], "cutoff": pd.array([cutoff], dtype="Float64")})

    schema = T.StructType(
        [counts.schema[key], T.StructField("rule", T.StringType()), T.StructField("cutoff", T.DoubleType())]
    )
    chosen = counts.groupBy(key, "rule").applyInPandas(choose, schema)
    return written(
        chosen.groupBy(key).pivot("rule", [r.name for r in rules]).agg(F.min("cutoff")), "quality-cutoffs"
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def judged(
    table: DataFrame, cutoffs: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, m: str = f"{OWN}m", name: str = f"{OWN}kept"
) -> DataFrame:
    """``table`` with the verdict: false if the base fails or a rule of the stratum rejects.

    Cutoffs join by stratum, null being a stratum; Spark broadcasts them when their stored size is
    below its limit and otherwise splits hot strata.
    """
    key = f"{OWN}stratum"
    renamed = cutoffs.select(
        F.col(key), F.struct(*[F.col(r.name) for r in rules]).alias(f"{OWN}cut")
    )
    joined = table.join(renamed, table[stratum].eqNullSafe(renamed[key]), "left")
    rejected = F.lit(False)
    for r in rules:
        rejected = rejected | F.coalesce(r.value(F.col(m)) > F.col(f"{OWN}cut.{r.name}"), F.lit(False))
    return joined.withColumn(name, ~base_failed(F.col(m)) & ~rejected).select(*table.columns, name)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass, with their columns. Row by row: repeated rows stay repeated."""
    m = f"{OWN}m"
    # stored with its measures, so that every text is measured once, for the cutoffs and the verdict
    table = written(measured(docs, m), "measured")
    cutoffs = fit_cutoffs(table, labels, stratum)
    return judged(table, cutoffs, stratum).where(F.col(f"{OWN}kept")).select(*docs.columns)
