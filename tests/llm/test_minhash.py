import random

import numpy as np
from brute import HARD, hard_documents, near_duplicate_rows, no_documents

from temblor.llm import minhash


def corpus():
    """Clusters of edited copies, chains, shared passages, and unrelated texts."""
    r = random.Random(7)
    rows, n = [], 0
    passage = [f"p{i}" for i in range(60)]
    for cluster in range(25):
        base = [f"c{cluster}w{r.randint(0, 400)}" for _ in range(r.randint(5, 200))]
        for _ in range(r.randint(1, 12)):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                words[r.randrange(len(words))] = f"e{r.randint(0, 9999)}"
            if r.random() < 0.3:
                words += passage
            rows.append((n, " ".join(words)))
            n += 1
    for _ in range(60):  # one very common passage with a few words of one's own
        rows.append((n, " ".join([*passage, *(f"u{n}x{i}" for i in range(r.randint(0, 60)))])))
        n += 1
    r.shuffle(rows)
    return rows


def test_components_equal_all_pairs(spark):
    rows = corpus()
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == sorted(near_duplicate_rows(rows))


def hot_buckets():
    """Passages that many documents share below the bound, and two of them, which share nothing else,
    above it. Documents with smaller sets are there too, so no hub is likely to be one of the two."""
    rows = []
    for g in range(12):
        passage = [f"g{g}p{i}" for i in range(60)]
        own = [10] * 30 + [6] + [10] * 15 + [6] + [10] * 30
        for i, words in enumerate(own):
            rows.append((len(rows), " ".join([*passage, *(f"g{g}d{i}x{j}" for j in range(words))])))
            if i % 3 == 0:
                rows.append((len(rows), " ".join([*passage[:45], *(f"g{g}s{i}x{j}" for j in range(9))])))
    return rows


def test_the_one_linked_pair_of_a_hot_bucket_is_found(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 20)
    rows = hot_buckets()
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = near_duplicate_rows(rows)
    assert sum(not kept for *_, kept in expected) == 12
    assert sorted(map(tuple, out.collect())) == sorted(expected)


def test_hard_rows(spark):
    out = [tuple(r) for r in minhash.near_duplicates(hard_documents(spark)).collect()]
    expected = near_duplicate_rows([(r[0], r[1]) for r in HARD])
    assert sorted(out, key=str) == sorted(expected, key=str)
    assert minhash.near_duplicates(no_documents(spark)).count() == 0


def test_one_of_a_group_stays(spark):
    docs = hard_documents(spark)
    out = minhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["1", "4", "5", "6", "7", "8", "10", "None"])


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        hits = []
        for _ in range(60):
            both = r.integers(0, 2**63, int(1000 * share)).astype(np.uint64)
            rest = (1000 - len(both)) // 2
            a, b = (np.concatenate([both, r.integers(0, 2**63, rest).astype(np.uint64)]) for _ in "ab")
            hits.append((minhash.signature(a, 128) == minhash.signature(b, 128)).mean())
        assert abs(np.mean(hits) - share) < 0.03


def test_densification_fills_every_bin_alike():
    small = np.array([5, 77, 123456789], dtype=np.uint64)
    sig = minhash.signature(small, 128)
    assert set(sig.tolist()) <= set(minhash.mix(small ^ np.uint64(0x5851F42D4C957F2D)).tolist())
    assert (sig == minhash.signature(small[::-1].copy(), 128)).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7)]
    out = minhash.components(spark.createDataFrame(edges, "hub long, member long"))
    found = {r.doc: r.component for r in out.collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and all(found[1000 + i] == 1000 for i in range(1, 60))


def test_a_repeated_id_links_by_its_largest_set_alone(spark):
    words = [f"w{i}" for i in range(477)]
    other = words[:415] + [f"v{i}" for i in range(60)]  # below 0.8 with all words, above with fewer
    rows = [(1, " ".join(words)), (2, " ".join(other)), (1, " ".join(words[:430])), *[(3, "a b c d e f")] * 50, (4, "a b c d e f")]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    found = {(r.doc_id, r.component_id, r.kept) for r in out}
    assert found == {(1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False)} and len(out) == len(rows)


def scattered_pairs():
    """Passages that many documents share below the bound; a few pairs of them have more in common."""
    rows = []
    for g in range(6):
        passage = [f"g{g}p{i}" for i in range(60)]
        for i in range(120):
            common = [f"g{g}c{i % 60}x{j}" for j in range(8)] if i % 60 < 8 else [f"g{g}d{i}x{j}" for j in range(8)]
            rows.append((len(rows), " ".join([*passage, *common, f"g{g}d{i}y", f"g{g}d{i}z"])))
    return rows


def test_rounds_end_when_they_link_little(spark, monkeypatch):
    rounds, plain = [], minhash.stars
    monkeypatch.setattr(minhash, "stars", lambda *a: rounds.append(a[-1]) or plain(*a))
    rows = scattered_pairs()
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = near_duplicate_rows(rows)
    assert sum(not kept for *_, kept in expected) == 48
    assert sorted(map(tuple, out.collect())) == sorted(expected)
    assert len(rounds) <= 2


def test_sets_made_together_equal_sets_made_alone(monkeypatch):
    texts = ["", None, "a", "A b", "a b c", "a b c d", "a a a a a a a", " É x\ty\x0bz w q ", None, "x" * 50, "b a b a b a b a b", ""]
    alone = [minhash.shingles(t) for t in texts]
    assert [len(s) for s in alone] == [0, 0, 1, 1, 1, 1, 1, 3, 0, 1, 2, 0]
    for most in (1, 10, 1 << 20):
        monkeypatch.setattr(minhash, "MOST_TOGETHER", most)
        found = list(minhash._each(minhash.pa.array(texts, minhash.pa.string()), 4))
        assert len(found) == len(alone) and all(np.array_equal(a, b) for a, b in zip(found, alone, strict=True))
    full = [s for s in alone if len(s)]
    together = minhash.signatures(np.concatenate(full), np.cumsum([0, *map(len, full)]), 128)
    assert all((row == minhash.signature(s, 128)).all() for row, s in zip(together, full, strict=True))
    assert (minhash.band_keys(together, 32, 4)[3] == minhash.band_keys(together[3], 32, 4)).all()
