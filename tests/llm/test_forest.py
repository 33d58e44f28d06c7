import numpy as np

from temblor.llm import forest

SCHEMA = "vec_id long, embedding array<float>, score int, rank int"


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def brute(rows, k):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, *_ in rows]
    known = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in known:
        if q % 20 == 0:
            near = sorted((-product(v, w), i) for i, w in known if i != q)
            out += [(q, r, i, s) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted((q, r, i) for q, r, i, _ in out)


def test_exact_with_one_block(spark):
    r = np.random.default_rng(1)
    base = np.round(r.normal(size=8), 1).tolist()
    rows = [(i, np.round(r.normal(size=8) * (1 + i % 3), 1).tolist(), 1, 1) for i in range(300)]
    rows += [(1000 + i, base, 1, 1) for i in range(150)]  # one very common vector, and its ties
    rows += [(2000, None, 1, 1), (2001, [0.0] * 8, 1, 1), (2002, [float("nan")] * 8, 1, 1), (2003, [None] * 8, 1, 1), (2004, [float("inf")] * 8, 1, 1), (None, base, 1, 1), (2005, [], 1, 1)]
    rows += [rows[0], rows[40]]
    out = forest.nearest(spark.createDataFrame(rows, SCHEMA), forest=forest.Forest(trees=4, recall=1.0))
    assert sorted((x.query_id, x.rank, x.vec_id) for x in out.collect()) == brute(rows, 20)


def test_recall_on_clusters_and_short_tables(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.2 * r.normal(size=16)).tolist(), 1, 1) for i in range(4000)]
    out = forest.nearest(spark.createDataFrame(rows, SCHEMA), forest=forest.Forest(trees=8, block_rows=500))
    found = {(x.query_id, x.vec_id) for x in out.collect()}
    true = {(q, i) for q, _, i in brute(rows, 20)}
    assert len(found) == len(true) and len(found & true) / len(true) >= 0.9
    few = [(0, [1.0, 2.0], 1, 1), (3, [2.0], 1, 1), (4, [0.0, 1.0], 1, 1)]
    out = forest.nearest(spark.createDataFrame(few, SCHEMA))
    assert [tuple(x) for x in out.orderBy("rank").collect()] == [(0, 1, 3, 2.0), (0, 2, 4, 2.0)]
    for none in ([], [(1, [1.0], 1, 1)], [(0, [1.0], 1, 1)]):
        assert forest.nearest(spark.createDataFrame(none, SCHEMA)).count() == 0


def test_a_block_of_many_alike_vectors_is_dealt_out(spark):
    r = np.random.default_rng(3)
    centre = r.normal(size=6)
    rows = [(i, (centre + 1e-4 * r.normal(size=6)).tolist(), 1, 1) for i in range(400)]
    rows += [(1000 + i, r.normal(size=6).tolist(), 1, 1) for i in range(200)]
    out = forest.nearest(spark.createDataFrame(rows, SCHEMA), k=5, forest=forest.Forest(trees=3, block_rows=50, recall=1.0))
    assert sorted((x.query_id, x.rank, x.vec_id) for x in out.collect()) == brute(rows, 5)


def test_queries_outside_of_all_blocks_ascend(spark):
    r = np.random.default_rng(4)
    centre = r.normal(size=6)
    rows = [(i, (centre + 1e-3 * r.normal(size=6)).tolist(), 1, 1) for i in range(1, 400)]
    rows += [(1000 + i, r.normal(size=6).tolist(), 1, 1) for i in range(200)]
    rows.append((5001, (1000 * r.normal(size=6)).tolist(), 1, 1))  # all others point to one pole beside it
    out = forest.nearest(spark.createDataFrame(rows, SCHEMA), forest=forest.Forest(trees=2, block_rows=20))
    found = {(x.query_id, x.rank): x.vec_id for x in out.collect()}
    true = {(q, n): i for q, n, i in brute(rows, 20)}
    assert found.keys() == true.keys()
    assert len({(q, i) for (q, _), i in found.items()} & {(q, i) for (q, _), i in true.items()}) >= 0.8 * len(true)
