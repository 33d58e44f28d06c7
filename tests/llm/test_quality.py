import math
import random
from fractions import Fraction
from math import comb

import pytest
from brute import hard_documents, no_documents, quality_measures
from pyspark.sql import functions as F

from temblor.llm import quality
from temblor.llm.frames import OWN, written

LABELS = "doc_id long, quality int, toxic int"


def test_measures_equal_their_definition():
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice(["a ", "b ", "a\n", "é", "\t", "#", "A! ", " ", "x y z "]) for _ in range(r.randint(0, 60)))
        assert quality.measure_text(text)[:5] == quality_measures(text)
    assert quality.measure_text(None) == quality.measure_text("")


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.05), (200, 7, 0.01), (40, 40, 0.2)):
        expected = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(n, k, p) == pytest.approx(expected, rel=1e-9)


def test_a_cutoff_needs_proof():
    cutoffs = (0.1, 0.5)
    # 100 good documents cannot prove a risk of 1 %, 1000 can
    assert quality.choose_cutoff(cutoffs, [100, 0, 0], [0, 0, 50], 0.01, 0.05, 20) is None
    assert quality.choose_cutoff(cutoffs, [1000, 0, 0], [0, 0, 50], 0.01, 0.05, 20) == 0.5
    # the stricter cutoff would reject too many good ones, and testing stops there
    assert quality.choose_cutoff(cutoffs, [900, 100, 0], [0, 90, 50], 0.01, 0.05, 20) == 0.5
    assert quality.choose_cutoff(cutoffs, [1000, 0, 0], [0, 90, 50], 0.01, 0.05, 20) == 0.1


def test_false_rejections_stay_below_the_risk():
    """Over many holdouts, the true rate of the chosen cutoff is above the risk at most rarely."""
    r, bad = random.Random(5), 0
    cutoffs = tuple(i / 20 for i in range(20))
    for _ in range(200):
        good = [0] * 21
        for _ in range(800):
            value = r.random() ** 3
            good[sum(value > c for c in cutoffs)] += 1
        chosen = quality.choose_cutoff(cutoffs, good, [5] * 21, 0.1, 0.05, 0.01)
        if chosen is not None:
            bad += 1 - chosen ** (1 / 3) > 0.1  # the share of good documents above the cutoff
    assert bad <= 20


def test_junk_goes_and_good_documents_stay(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(3000):
        words = [f"w{r.randint(0, 5000)}" for _ in range(80)]
        junk = i % 10 == 0
        rows.append((i, " ".join(f"{w}%%%" if junk else w for w in words), "en", "a", 1, "x", 1))
        if i % 2 == 0:
            labels.append((i, 0 if junk else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, spans long")
    kept = {row.doc_id for row in quality.keep_good(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert kept == {i for i in range(3000) if i % 10}


def test_hard_rows(spark):
    docs = hard_documents(spark)
    for labels in ([], [(1, 1, 0), (1, 0, 0), (None, 1, 0), (10, None, None)]):
        out = quality.keep_good(docs, spark.createDataFrame(labels, LABELS))
        assert out.columns == docs.columns
        # without proof only the base rules reject: short, empty and repetitive texts
        assert sorted(str(row.doc_id) for row in out.collect()) == ["1", "1", "11", "2", "3", "None"]
    assert quality.keep_good(no_documents(spark), spark.createDataFrame([], LABELS)).count() == 0


def test_null_language_is_a_stratum(spark):
    m = f"{OWN}m"
    table = quality.measured(spark.createDataFrame([(1, "a b c", None), (2, "a b c", "en")], "doc_id long, text string, lang string"))
    cutoffs = spark.createDataFrame([(None, 0.1)], f"{OWN}stratum string, symbols double")
    for rule in quality.RULES[1:]:
        cutoffs = cutoffs.withColumn(rule.name, F.lit(None).cast("double"))
    assert quality.judged(table, written(cutoffs, "cut")).count() == 2
    assert m in table.columns


def test_binomial_tails_are_whole():
    for n, k, p in ((20, 3, 0.3), (1000, 5, 0.01), (5000, 60, 0.01), (300, 299, 0.9), (7, 0, 0.5), (10, 10, 0.5)):
        plain = sum(Fraction(math.comb(n, i)) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_tail(n, k, p) - float(plain)) < 1e-9
    # by the normal limit with continuity and skewness correction, far beyond 2,000 terms
    n, p = 10**9, 0.01
    sd = math.sqrt(n * p * (1 - p))
    z = (-1000 + 0.5) / sd
    phi = math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    limit = 0.5 * math.erfc(-z / math.sqrt(2)) - (1 - 2 * p) / (6 * sd) * (z * z - 1) * phi
    assert abs(quality.binomial_tail(n, int(n * p) - 1000, p) - limit) < 1e-4
