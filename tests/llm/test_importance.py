import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import HARD, hard_documents, no_documents

from temblor.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % importance.BUCKETS for run in runs]


def plain_draw(docs, target, percent, least_words):
    """Rows as multiset, by Python alone."""
    own = [(doc_id, *plain_features(text)) for doc_id, text in docs]
    s, t = Counter(), Counter()
    for _, _, buckets in own:
        s.update(buckets)
    for text in target:
        t.update(plain_features(text)[1])
    total_s, total_t, n = s.total(), t.total(), importance.BUCKETS
    rows = []
    for doc_id, n_words, buckets in own:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + n) / ((s[b] + 1) * (total_t + n)))) for b in buckets)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(buckets), weight, score, None, n_words >= least_words])
    fit = [r for r in rows if r[5]]
    for rank, row in enumerate(sorted((r for r in fit if r[3] is not None), key=lambda r: (-r[3], r[0]))[: percent * len(fit) // 100]):
        row[4] = rank + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_checksums_are_those_of_every_stretch(monkeypatch):
    r = random.Random(3)
    data = np.frombuffer(r.randbytes(5000), dtype=np.uint8)
    starts = np.array([r.randrange(0, 4000) for _ in range(800)])
    lengths = np.array([r.choice([1, 2, 3, 7, 8, 60, 900]) for _ in starts])
    expected = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]
    for few, cells in ((16, 1 << 22), (1, 1 << 22), (1, 50)):
        monkeypatch.setattr(importance, "FEW", few)
        monkeypatch.setattr(importance, "CELLS", cells)
        assert importance.checksums(data, starts, lengths).tolist() == expected
    assert importance.checksums(data, starts[:0], lengths[:0]).size == 0


@pytest.mark.parametrize("stretch", [1, 2, 5, 1 << 18])
def test_features_of_each_text_whatever_the_stretch(monkeypatch, stretch):
    monkeypatch.setattr(importance, "STRETCH", stretch)
    texts = ["Hello, World foo 9x", None, "", "éa—b C  d", "x" * 5000 + " y", "a.b.c a b c a b c", "中文 Ab", " . ", "İ ß É a\x00b"]
    words, found = importance.Words(pa.array(texts)), [[] for _ in texts]
    for buckets, text in words.buckets():
        for b, i in zip(buckets.tolist(), text.tolist(), strict=True):
            found[i].append(b)
    for text, n, own in zip(texts, words.count, found, strict=True):
        assert (n, sorted(own)) == (plain_features(text)[0], sorted(plain_features(text)[1]))


def test_parts_are_the_whole_in_order(monkeypatch):
    monkeypatch.setattr(importance, "PART", 10)
    texts = pa.array(["a" * 25, None, "", "bcd", "efghij", "k" * 11, "", None]).slice(0)
    assert sum((p.to_pylist() for p in importance.parts(texts)), []) == texts.to_pylist()
    assert list(importance.parts(texts.slice(3, 0))) == []


def test_draw_equals_brute_force_on_hard_rows(spark):
    r = random.Random(5)
    vocabulary = ["the", "Of", "é", "b2", "target", "word", "x" * 40]
    docs = [(i // 2 if i % 7 == 0 else i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 60)))) for i in range(150)]
    docs += HARD_ROWS
    target = ["target word the", None, "", "Target, word; target"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    frame = frame.selectExpr("*", "1 AS score", "'x' AS weight", "doc_id AS bucket", "text AS n")
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    rows = importance.draw(frame, goal, 20, 5).collect()
    assert sorted((tuple(x) for x in rows), key=str) == plain_draw(docs, target, 20, 5)
    assert importance.draw(frame, goal.limit(0), 20, 5).count() == len(docs)


HARD_ROWS = [(None, "target word target word target"), (2**53 + 1, "target " * 50), (2**53 + 1, "target " * 50), (7, None), (8, "")]


@pytest.mark.parametrize("docs", [hard_documents, no_documents])
def test_whole_documents(spark, docs):
    frame = docs(spark)
    rows = importance.draw(frame, frame.select("text"), 10).collect()
    given = [] if docs is no_documents else [(row["doc_id"], row["text"]) for row in frame.collect()]
    assert len(rows) == len(given)
    if given:
        assert sorted((tuple(x) for x in rows), key=str) == plain_draw(given, [t for _, t in given], 10, 20)
