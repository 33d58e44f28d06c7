import random
from fractions import Fraction

import pytest
from brute import HARD, hard_documents, no_documents
from pyspark.sql import functions as F

from temblor.llm import mixing
from temblor.llm.frames import OWN, written


def test_every_prefix_deviates_by_less_than_a_block():
    for seed in range(100):
        r = random.Random(seed)
        weights = mixing.whole_weights({f"s{i}": r.random() ** 3 + 1e-6 for i in range(r.randint(1, 12))}, r.choice([1, 17, 100, 500]))
        period, got = sum(weights.values()), dict.fromkeys(weights, 0)
        for t, source in enumerate(mixing.schedule(weights), 1):
            got[source] += 1
            assert all(abs(got[s] - Fraction(w * t, period)) < 1 for s, w in weights.items())
        assert got == weights


def test_phases_place_every_block():
    blocks = {"a": 1000, "b": 30, None: 7, "": 1}
    plan = mixing.phases(blocks, mixing.targets(blocks, mixing.Mix(weights={"b": 0.5}, period=20)))
    assert [set(p.weights) for p in plan][0] == set(blocks) and plan[-1].weights == {"a": 1}
    assert plan[-1].placed["b"] == 30 and plan[-1].placed[""] == 1


@pytest.mark.parametrize(
    "given, chars",
    [
        ({"a": 0.0001, "b": 0.9989, "c": 0.001}, {"a": 1, "b": 1, "c": 1}),
        ({"a": 1 / 3, "b": 2 / 3}, {"a": 5, "b": 5}),
        ({"a": 0.0001}, {"a": 7, "b": 100, "c": 400, None: 1}),
        ({"a": 3, "b": 1}, {"a": 1, "b": 2}),
        ({"a": Fraction(2, 7), "b": 0.25}, {"a": 1, "b": 2, "c": 9}),
    ],
)
def test_given_weights_are_kept_exactly(given, chars):
    weights = mixing.targets(chars, mixing.Mix(weights=given))
    asked = {s: mixing.exact(w) for s, w in given.items()}
    whole = sum(asked.values()) if len(given) == len(chars) else 1
    period, got = sum(weights.values()), dict.fromkeys(weights, 0)
    for s, w in asked.items():
        assert Fraction(weights[s], period) == w / whole and (s == "c" or abs(float(w) - given[s]) < 1e-15)
    for t, source in enumerate(mixing.schedule(weights), 1):
        got[source] += 1
        assert all(abs(got[s] - w / whole * t) < 1 for s, w in asked.items())


def test_weights_that_need_too_long_a_period_are_refused():
    with pytest.raises(ValueError):
        mixing.exact(0.12345678901234)
    with pytest.raises(ValueError):
        mixing.targets({"a": 1, "b": 1, "c": 1}, mixing.Mix(weights={"a": Fraction(1, 999_983), "b": Fraction(1, 999_979), "c": 0.5}))


def test_equal_rows_spread_over_parts(spark):
    docs = written(spark.range(20_000).selectExpr("1L AS doc_id", "'same text' AS text", "'s' AS source"), "equal")
    rows = mixing.keyed(docs)
    assert rows.select(f"{OWN}order").distinct().count() == 20_000
    number = f"floor((`{OWN}order` + 9223372036854775808D) / 18446744073709551616D * 10)"
    assert max(r["count"] for r in rows.groupBy(F.expr(number)).count().collect()) < 2_300
    out = mixing.placed(rows, mixing.Mix(block_chars=900, part_rows=2_000))
    places = sorted((r[f"{OWN}block"], r[f"{OWN}offset"]) for r in out.collect())
    assert places == [(i // 100, i % 100 * 9) for i in range(20_000)]


def slots(df):
    return [(r[f"{OWN}slot"], r[f"{OWN}source"], r[f"{OWN}block"], r[f"{OWN}offset"], r[f"{OWN}size"]) for r in df.collect()]


def test_blocks_follow_the_schedule(spark):
    r = random.Random(3)
    rows = [(i, "x" * r.randint(0, 300), "abc"[min(2, i % 7)]) for i in range(2000)]
    mix = mixing.Mix(weights={"a": 0.5, "b": 0.3, "c": 0.2}, block_chars=1000, period=10, part_rows=100)
    placed = slots(mixing.placed(mixing.keyed(written(spark.createDataFrame(rows, "doc_id long, text string, source string"), "docs")), mix))
    assert len(placed) == 2000
    by_slot, at = {}, {}
    for slot, source, block, offset, _size in placed:
        assert by_slot.setdefault(slot, (source, block)) == (source, block) and 0 <= offset < 1000
    for source in {p[1] for p in placed}:  # a source's documents fill its blocks without gap or overlap
        own = sorted((block * 1000 + offset, size) for _, s, block, offset, size in placed if s == source)
        at = 0
        for start, size in own:
            assert start == at
            at += size
        assert [b for _, b in sorted({(slot, b) for slot, s, b, _, _ in placed if s == source})] == sorted({b for _, s, b, _, _ in placed if s == source})
    last_a = max(slot for slot, s, *_ in placed if s == "sa")
    got = {s: len({b for slot, t, b, *_ in placed if t == s and slot <= last_a // 10 * 10 - 1}) for s in ("sa", "sb", "sc")}
    assert abs(got["sa"] - last_a // 10 * 5) <= 1


def test_hard_rows(spark):
    docs = written(hard_documents(spark), "docs")
    out = mixing.in_order(docs, mixing.Mix(block_chars=500, period=7, part_rows=2))
    assert out.columns == docs.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, HARD))
    assert mixing.in_order(written(no_documents(spark), "docs")).count() == 0
