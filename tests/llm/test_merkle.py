import hashlib
import random
import zlib

import pytest
from brute import hard_documents, no_documents

from temblor.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, i):
    path = []
    for level in levels[:-1]:
        run = i - i % 8
        path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 8])))
        i //= 8
    return path


def plain_leaf(row):
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS))


def lowered(row):
    text = row["text"]
    text = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return {**{c: row[c] for c in merkle.FIELDS}, "text": text}


def plain_manifest(rows, changed):
    """Rows as multiset, from whole levels."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = {}, []
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[lang] = plain_levels([plain_leaf(r) for r in groups[lang]])
    top = plain_levels([trees[lang][-1][0] for lang in langs]) if langs else []
    for j, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            path = plain_path(trees[lang], i) + plain_path(top, j)
            node = plain_leaf(lowered(row) if changed(row["doc_id"]) else row)
            for left, right in path:
                node = h(left + node + right)
            root = top[-1][0]
            out.append((row["doc_id"], plain_leaf(row), trees[lang][-1][0], root, h("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def third(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 73, 512, 513, 600, 4097])
def test_closed_form_positions_are_where_the_append_log_has_the_nodes(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = plain_levels(leaves)
    log = merkle.postorder(leaves, merkle.height(n))
    assert len(log) == sum(map(len, levels)) and merkle.height(n) == len(levels) - 1
    for level, nodes in enumerate(levels):
        for i, node in enumerate(nodes):
            assert log[merkle.position(level, i, n, merkle.height(n))] == node
    proofs = merkle.slice_proofs(log, n, merkle.height(n), [("up", "per")])
    for i in range(n):
        assert proofs[i] == [*plain_path(levels, i), ("up", "per")]
        assert merkle.fold(leaves[i], proofs[i][:-1]) == levels[-1][0]


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return frame.selectExpr("*", "1 AS tree", "text AS leaf", "lang AS digest", "doc_id AS at").repartition(3)


@pytest.mark.parametrize("steps", [1, 2, merkle.STEPS])
def test_manifest_equals_whole_trees(spark, steps):
    r = random.Random(steps)
    langs = [None, "", "en", "fr", "é", "zz", *[f"l{i}" for i in range(9)]]
    rows = []
    for i in range(700):
        text = r.choice([None, "", "Abc É", "lower only", f"Text {i}"])
        lang = "en" if i % 3 else r.choice(langs)
        rows.append((r.choice([i, i, i % 20, None, 2**53 + 1]), r.choice(["s", None]), lang, r.choice([None, 3]), text))
    rows += [(5, "s", "fr", 1, "SAME")] * 30 + [(9, "only", "alone", None, "One")]
    frame = documents(spark, rows)
    given = [{c: row[c] for c in merkle.FIELDS} for row in frame.collect()]
    found = merkle.manifest(frame, merkle.tampered(), steps).collect()
    assert sorted((tuple(x) for x in found), key=str) == plain_manifest(given, third)
    untouched = merkle.manifest(frame, steps=steps).collect()
    assert len(untouched) == len(rows) and all(x["verified"] for x in untouched)


@pytest.mark.parametrize("rows", [[], [(3, "s", "en", 1, "Alone")], [(1, None, None, None, None)]])
def test_smallest_tables(spark, rows):
    frame = documents(spark, rows)
    found = merkle.manifest(frame, merkle.tampered()).collect()
    given = [dict(zip(merkle.FIELDS, row, strict=True)) for row in rows]
    assert sorted((tuple(x) for x in found), key=str) == plain_manifest(given, third)
    if rows:
        assert found[0]["leaf"] == found[0]["subroot"] == found[0]["root"] and found[0]["proof_sha256"] == h("")


@pytest.mark.parametrize("docs", [hard_documents, no_documents])
def test_whole_documents(spark, docs):
    frame = docs(spark)
    for name in merkle.FIELDS:
        if name not in frame.columns:
            frame = frame.selectExpr("*", f"CAST(NULL AS STRING) AS {name}")
    found = merkle.manifest(frame, merkle.tampered()).collect()
    given = [{c: row[c] for c in merkle.FIELDS} for row in frame.collect()]
    assert sorted((tuple(x) for x in found), key=str) == plain_manifest(given, third)
