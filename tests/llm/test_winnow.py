import hashlib
import random

import pytest
from brute import hard_documents, no_documents

from temblor.llm import winnow
from temblor.llm.winnow import BASE, MIX, Winnow


def plain_fingerprint(text, how):
    points = [ord(c) for c in text]

    def hashed(run):
        value = 0
        for point in run:
            value = (value * BASE + point) % 2**64
        value = (value ^ (value >> 32)) * MIX % 2**64
        return value ^ (value >> 29)

    if not points:
        return []
    if len(points) < how.gram:
        return [(hashed(points), 0)]
    hashes = [hashed(points[i : i + how.gram]) for i in range(len(points) - how.gram + 1)]
    window, chosen = min(how.window, len(hashes)), []
    for low in range(len(hashes) - window + 1):
        at = max(range(low, low + window), key=lambda i: (-hashes[i], i))
        if not chosen or chosen[-1][1] != at:
            chosen.append((hashes[at], at))
    return chosen


def texts(r, alphabet="abé"):
    some = ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 300))) for _ in range(60)]
    return [*some, "", "a", "abc", "a" * 300, "ab" * 200, "x" * 2500, "\U0001f600" * 40]


@pytest.mark.parametrize("how", [Winnow(4, 5), Winnow(16, 128), Winnow(1, 3), Winnow(8, 1), Winnow(2, 64)])
@pytest.mark.parametrize("stretch", [64, 1000, 1 << 19])
def test_smallest_of_every_window_rightmost(monkeypatch, how, stretch):
    monkeypatch.setattr(winnow, "STRETCH", stretch)
    given = texts(random.Random(1))
    for text, found in zip(given, winnow.fingerprints(given, how), strict=True):
        assert list(zip(found[0].tolist(), found[1].tolist(), strict=True)) == plain_fingerprint(text, how)


def test_a_shared_run_of_the_guaranteed_length_shares_a_hash():
    r, how = random.Random(2), Winnow(8, 20)
    for _ in range(200):
        shared = "".join(r.choice("abcdefgh ") for _ in range(how.guarantee))
        a, b = ("".join(r.choice("ijklmnop ") for _ in range(r.randrange(200))) + shared + "q" * r.randrange(50) for _ in range(2))
        (x, at), (y, _) = winnow.fingerprints([a, b], how)
        inside = {h for h, p in zip(x.tolist(), at.tolist(), strict=True) if a.index(shared) <= p <= a.index(shared) + how.window - 1}
        assert inside & set(y.tolist())


def test_parameters_are_checked():
    for gram, window in ((0, 5), (3, 5), (4, 0)):
        with pytest.raises(ValueError):
            Winnow(gram, window)


def plain_rows(rows, how):
    out = []
    prints = [plain_fingerprint(t, how) for _, t in rows]

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    def shown(found):
        return ",".join(f"{h:016x}:{p}" for h, p in found)

    for i, (doc_id, text) in enumerate(rows):
        k = (i + 1) % len(rows)
        cut = len(text) // 4
        changed = text[: len(text) - cut] + rows[k][1][:cut]
        other = plain_fingerprint(changed, how)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), sha, shown(prints[i]), shown(other), near(prints[i], other), near(prints[i], prints[k])))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_every_document_meets_its_successor(spark, partitions):
    r, how = random.Random(3), Winnow(4, 8)
    rows = [(i * 3 - 50 if i else None, t) for i, t in enumerate(texts(r))]
    mixed = [*rows, (10**6, None), (2**53 + 1, "z" * 60), (2**53 + 2, "y" * 60)]
    r.shuffle(mixed)
    frame = spark.createDataFrame(mixed, "doc_id long, text string").repartition(partitions)
    frame = frame.selectExpr("*", "1 AS n_chars", "'p' AS part", "text AS fingerprint")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", partitions != 7)
    try:
        found = winnow.chained(frame, how).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    order = sorted(((i, t or "") for i, t in mixed), key=lambda x: (x[0] is not None, x[0] or 0))
    assert sorted((tuple(x) for x in found), key=str) == plain_rows(order, how)


def test_repeated_rows_follow_each_other(spark):
    how = Winnow(4, 8)
    same = [(5, "the same text again and again")] * 40
    frame = spark.createDataFrame([(1, "first of all, a text"), *same, (9, "and the last one here")], "doc_id long, text string")
    found = sorted(winnow.chained(frame.repartition(6), how).collect(), key=str)
    assert [tuple(x) for x in found] == plain_rows([(1, "first of all, a text"), *same, (9, "and the last one here")], how)


@pytest.mark.parametrize("rows", [[], [(3, "alone and its own successor")], [(None, None)]])
def test_smallest_tables(spark, rows):
    found = winnow.chained(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(x) for x in found), key=str) == plain_rows([(i, t or "") for i, t in rows], Winnow())


@pytest.mark.parametrize("docs", [hard_documents, no_documents])
def test_whole_documents(spark, docs):
    frame = docs(spark)
    found = winnow.chained(frame).collect()
    given = frame.collect()
    assert len(found) == len(given)
    by_text = {}
    lengths = sorted(len(row["text"] or "") for row in given)
    assert sorted(row["n_chars"] for row in found) == lengths
    for row in given:
        by_text.setdefault(row["text"] or "", set())
    prints = {winnow.written_out(f) for f in winnow.fingerprints(list(by_text))} if by_text else set()
    assert {row["fingerprint"] for row in found} == prints
