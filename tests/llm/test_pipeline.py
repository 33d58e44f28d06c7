import random
import zlib

import corpus_pipeline
import numpy as np
from brute import DOCS, HARD, LONG, near_duplicate_rows, quality_measures
from test_packing import plain_ids

from temblor.llm import pii


def tables(spark, folder, rows, labels=()):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def corpus():
    r = random.Random(2)
    rows = list(HARD)
    for i in range(100, 180):
        words = [f"v{r.randint(0, 3000)}" for _ in range(r.randint(60, 150))]
        if i % 5 == 0:
            words[30] = f"user{i}@mail.example.org"
        text = " ".join(words)
        rows.append((i, text, "en", r.choice("abc"), len(text), None, None))
        if i % 4 == 0:  # a near copy
            words[10] = "changed"
            rows.append((i + 1000, " ".join(words), "de", r.choice("abc"), 1, None, None))
    return rows


def plain_pipeline(rows):
    """Base quality rules (no label proves more), 5-word near duplicates, base redaction."""
    kept = []
    for row in rows:
        words, *_, repeated = quality_measures(row[1])
        if words >= 50 and 100 * repeated <= 50 * words:
            kept.append(row)
    near = near_duplicate_rows([(r[0], r[1]) for r in dict.fromkeys(kept)], size=5)
    stay = {i for i, _, _, k in near if k}
    out = {}
    for row in kept:
        if row[0] is None or row[0] in stay:
            out[row[0]] = None if row[1] is None else pii.redacted_text(row[1], pii.base_spans(row[1]))
    return out


def test_stages_equal_plain_versions(spark, tmp_path):
    rows = corpus()
    sf_dir = tables(spark, tmp_path, rows)
    docs, expected = spark.read.parquet(f"{sf_dir}/documents.parquet"), plain_pipeline(rows)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    mixed = docs.collect()
    assert {r.doc_id: r.text for r in mixed} == expected and len(mixed) == len(expected)
    pieces = []
    for doc_id, text in expected.items():
        ids = [*plain_ids(text), 1]
        pieces += [(str(doc_id), n, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for n, s in enumerate(range(0, len(ids), 4096))]
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in packed) == sorted(pieces)
    used = {}
    for r in packed:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 4096 and len(used) <= -(-sum(used.values()) // 4096) + 1
    assert LONG not in expected.values()


def test_an_empty_table_goes_through(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0


def test_prefixes_of_the_sequences_keep_the_mixture(spark, tmp_path):
    r = random.Random(5)
    rows = []
    for i in range(12_000):
        text = " ".join(f"v{r.randint(0, 3000)}" for _ in range(60))
        rows.append((i, text, "en", "b" if i % 10 == 0 else "a", len(text), None, None))
    sf_dir = tables(spark, tmp_path, rows)
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages["pfair_mixing"](spark, docs, sf_dir).write.parquet(f"{tmp_path}/mixed")
    packed = stages["best_fit_packing"](spark, spark.read.parquet(f"{tmp_path}/mixed"), sf_dir).collect()
    assert sorted(x.doc_id for x in packed) == list(range(12_000))
    # nine to one in characters is three to one in weights, until b runs out at 40 % of all
    for share in (0.1, 0.2, 0.3):
        first = sorted(packed, key=lambda x: (x.sequence_id, x.offset))[: int(share * len(packed))]
        assert abs(sum(x.doc_id % 10 == 0 for x in first) / len(first) - 0.25) < 0.05, share
    last = sorted(packed, key=lambda x: (x.sequence_id, x.offset))[8000:]
    assert all(x.doc_id % 10 for x in last)
