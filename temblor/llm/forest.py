"""Nearest neighbours by inner product with a hash-prefix forest.

Each of ``trees`` trees gives every vector a string of ``bits`` sign bits of random projections; a
tree is the array of these strings in sorted order, cut into blocks that share their first bits.
A query descends in every tree to its longest matching prefix and all trees ascend together, one
bit at a time, until the vectors below the matched prefixes are enough, and in one tree more than
``k``. Those are scored exactly. A query whose blocks hold too few ascends above them, if need be to
the empty prefix, with the sizes of blocks telling how far; so every query gets ``k`` rows if the
table has them.

How many are enough is measured: for a bounded sample of queries the true neighbours are found by
brute force, and the smallest number is taken with which the sample reaches ``recall``. On vectors
without structure that is a large share of the table, on clustered ones a small one. If whole
blocks do not reach it, blocks get one bit shorter, down to one block a tree, which is exact.
A block of more than twice ``block_rows`` vectors, as many alike ones make, is dealt out in parts:
its queries go to every part, and what the parts count and find is merged.

Inner products of vectors of unequal length are made angles by one more component, as usual:
rows become (x / m, sqrt(1 - |x|^2 / m^2)) with the largest length m, queries (q, 0).

Equal vectors are one entry of the forest with their ``k + 1`` smallest ids: since ties go to the
smaller id, no other copy can be among the nearest ``k``. That is exact, and a vector that fills a
third of the table costs what one does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import scratch, written


@dataclass(frozen=True)
class Forest:
    """Trees, bits a tree, mean vectors in a block, sampled queries and the recall they must reach."""

    trees: int = 16
    bits: int = 32
    block_rows: int = 16_384
    sample: int = 64
    recall: float = 0.95
    seed: int = 11


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of doubles; vectors shorter than ``width`` end in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def planes(width: int, forest: Forest) -> np.ndarray:
    return np.random.default_rng(forest.seed).normal(size=(width + 1, forest.trees * forest.bits))


def codes(rows: np.ndarray, longest: float, as_query: bool, forest: Forest) -> np.ndarray:
    """One integer of ``bits`` bits per row and tree, the first bit being the highest."""
    if as_query:
        extra = np.zeros(len(rows))
    else:
        extra = np.sqrt(np.maximum(0.0, longest * longest - (rows * rows).sum(axis=1)))
    signs = np.column_stack([rows, extra]) @ planes(rows.shape[1], forest) > 0
    powers = (1 << np.arange(forest.bits - 1, -1, -1)).astype(np.int64)
    return signs.reshape(len(rows), forest.trees, forest.bits) @ powers


def valid(vector: str) -> str:
    return (
        f"{vector} IS NOT NULL AND exists({vector}, x -> x <> 0) AND "
        f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )


def _below(ordered: np.ndarray, code: np.ndarray, depth: np.ndarray | int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of a sorted array that share the first ``depth`` bits with each code."""
    low = (code >> (bits - depth)) << (bits - depth)
    return np.searchsorted(ordered, low), np.searchsorted(ordered, low + (np.int64(1) << (bits - depth)))


def nearest(
    vectors: DataFrame, k: int = 20, forest: Forest = Forest(), is_query: str = "vec_id % 20 = 0"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found of every query.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Rows with a null id or
    an invalid vector take no part; a repeated row counts once. Without queries or candidates the
    result is empty.
    """
    spark = vectors.sparkSession
    with scratch(spark) as result:
        rows = vectors.select("vec_id", F.col("embedding").alias("v")).where("vec_id IS NOT NULL").where(valid("v")).distinct()
        rows = written(rows, "ann-rows")
        smallest = Window.partitionBy("v").orderBy("vec_id")
        first = rows.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
        entries = first.groupBy("v").agg(F.min("vec_id").alias("id"), F.array_sort(F.collect_set("vec_id")).alias("ids"))
        entries = written(entries, "ann-entries")
        facts = rows.agg(
            F.max(F.size("v")).alias("width"),
            F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("square"),
        ).first()
        n = entries.count()
        if not n:
            empty = "query_id long, rank int, vec_id long, score double"
            return spark.createDataFrame([], empty)
        width, longest = int(facts["width"]), float(facts["square"]) ** 0.5

        # A query stands for all queries with its vector.
        asked = rows.where(is_query).groupBy("v").agg(F.min("vec_id").alias("q"))
        coded = written(_with_codes(entries.select("id", "v"), "id", width, longest, False, forest), "ann-codes")
        queries = written(_with_codes(asked, "q", width, longest, True, forest), "ann-queries")
        bits = max(0, int(np.log2(max(1.0, n / forest.block_rows))))
        truth = _truth(coded, queries, width, k, forest)
        while True:
            parts = written(_parts(coded, bits, forest), "ann-parts")
            counts = written(_counts(coded, queries, parts, bits, forest), "ann-counts")
            enough = _enough(truth, counts, queries, parts, bits, k, forest)
            if enough is not None or bits == 0:
                break
            bits -= 1
        depth = written(_depths(counts, enough or n, bits, k), "ann-depths")
        found = written(_scored(coded, queries, parts, depth.where("depth IS NOT NULL"), bits, width, k, forest), "ann-found")
        short = queries.join(depth.where("depth IS NULL"), "q", "left_semi")
        if bits and not short.isEmpty():
            above = written(_depths(_above(short, parts, bits, forest), enough or n, 0, k), "ann-above")
            for level in sorted(r[0] for r in above.select("depth").distinct().collect()):
                own = above.where(F.col("depth") == level)
                blocks = _blocked(queries.join(own, "q", "left_semi"), level, forest).select("tree", "block").distinct()
                wide = written(_parts(coded, level, forest).join(blocks, ["tree", "block"], "left_semi"), "ann-parts")
                found = found.unionByName(written(_scored(coded, queries, wide, own, level, width, k, forest), "ann-found"))

        # Every query with the vector, and every copy of the neighbours.
        hits = found.dropDuplicates(["q", "id"])
        best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        hits = hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("q", "id", "score")
        copies = hits.join(entries.select("id", "ids"), "id").select("q", "score", F.explode("ids").alias("vec_id"))
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        copies = written(copies.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "ann-copies")
        same = rows.where(is_query).select("v", F.col("vec_id").alias("query_id")).join(asked, "v").select("q", "query_id")
        pairs = same.join(copies, "q").where("query_id <> vec_id")
        ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = pairs.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        return result(out.select("query_id", "rank", "vec_id", "score"), "ann-nearest")


def _with_codes(df: DataFrame, name: str, width: int, longest: float, as_query: bool, forest: Forest) -> DataFrame:
    """``name``, ``v`` and ``codes``, one per tree."""
    schema = T.StructType(
        [T.StructField(name, T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("codes", T.ArrayType(T.LongType()))]
    )

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = matrix(part.column("v").to_pylist(), width)
                own = codes(rows, longest, as_query, forest)
                yield pa.RecordBatch.from_arrays(
                    [part.column(name).cast(pa.int64()), pa.array(list(rows), pa.list_(pa.float64())), pa.array(list(own), pa.list_(pa.int64()))],
                    names=[name, "v", "codes"],
                )

    return df.select(name, "v").mapInArrow(run, schema)


def _truth(coded: DataFrame, queries: DataFrame, width: int, k: int, forest: Forest) -> pd.DataFrame:
    """For a fixed sample of queries (by a hash of their id), the codes of their true neighbours."""
    sample = queries.orderBy(F.xxhash64("q"), "q").limit(forest.sample).toPandas()
    asked, names = matrix(sample["v"].tolist(), width), sample["q"].to_numpy()
    schema = "q long, score double, codes array<long>"

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                scores = asked @ matrix(part.column("v").to_pylist(), width).T
                scores[names[:, None] == np.array(part.column("id").to_pylist())[None, :]] = -np.inf
                top = np.argsort(-scores, axis=1)[:, :k]
                who = np.repeat(np.arange(len(names)), top.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[who]), pa.array(scores[who, top.ravel()]), part.column("codes").take(pa.array(top.ravel()))],
                    names=["q", "score", "codes"],
                )

    best = Window.partitionBy("q").orderBy(F.desc("score"))
    found = coded.select("id", "v", "codes").mapInArrow(run, schema).where("score > double('-infinity')")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).select("q", "codes").toPandas()
    own = sample.set_index("q")["codes"]
    agree = []
    for q, theirs in zip(found["q"], found["codes"], strict=True):
        differ = np.asarray(own[q]) ^ np.asarray(theirs)
        agree.append(max(forest.bits - int(d).bit_length() for d in differ))
    return pd.DataFrame({"q": found["q"], "agree": agree})


def _blocked(df: DataFrame, bits: int, forest: Forest, *columns: str) -> DataFrame:
    """A row per tree with its ``tree``, ``code`` and ``block``, the code's first ``bits`` bits."""
    return df.select(*columns, F.posexplode("codes").alias("tree", "code")).withColumn(
        "block", F.shiftright("code", forest.bits - bits) if bits else F.lit(0).cast("long")
    )


_PART = ("tree", "block", "part")


def _parts(coded: DataFrame, bits: int, forest: Forest) -> DataFrame:
    """Per block, its vectors and in how many parts it is dealt out."""
    sizes = _blocked(coded, bits, forest).groupBy("tree", "block").agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("tree", "block", "n", F.ceil(F.col("n") / (2 * forest.block_rows)).cast("int").alias("parts"))


def _dealt(df: DataFrame, parts: DataFrame) -> DataFrame:
    """Vectors by block, each in one part of it."""
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return df.join(parts, ["tree", "block"]).withColumn("part", part).drop("parts", "n")


def _asked(df: DataFrame, parts: DataFrame) -> DataFrame:
    """Queries by block, once for every part of it."""
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return df.join(parts, ["tree", "block"]).withColumn("part", part).drop("parts", "n")


def _counts(coded: DataFrame, queries: DataFrame, parts: DataFrame, bits: int, forest: Forest) -> DataFrame:
    """Per query, the vectors below its prefix of each length from ``bits`` on: ``counts`` over all
    trees and the ``most`` in one. A query whose blocks are empty has zeros."""
    left = _dealt(_blocked(coded, bits, forest, "id"), parts).select(*_PART, "code")
    right = _asked(_blocked(queries, bits, forest, "q"), parts).select(*_PART, "q", "code")
    depths = np.arange(bits, forest.bits + 1)

    def one(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ordered, own = np.sort(rows["code"].to_numpy()), asked["code"].to_numpy()
        below = [np.subtract(*_below(ordered, own, int(d), forest.bits)[::-1]) for d in depths]
        return pd.DataFrame({"q": asked["q"], "tree": asked["tree"], **{f"d{d}": b for d, b in zip(depths, below, strict=True)}})

    schema = "q long, tree int, " + ", ".join(f"d{d} long" for d in depths)
    each = left.groupBy(*_PART).cogroup(right.groupBy(*_PART)).applyInPandas(one, schema)
    each = each.groupBy("q", "tree").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in depths])
    known = each.groupBy("q").agg(*[F.array(*[f(f"d{d}") for d in depths]).alias(c) for c, f in _MERGED.items()])
    none = F.array(*[F.lit(0).cast("long")] * len(depths))
    return queries.select("q").join(known, "q", "left").select("q", *[F.coalesce(c, none).alias(c) for c in _MERGED])


_MERGED = {"counts": F.sum, "most": F.max}


def _above(queries: DataFrame, parts: DataFrame, bits: int, forest: Forest) -> DataFrame:
    """What ``_counts`` gives, for the prefixes shorter than ``bits``, from the sizes of blocks."""
    depth = F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("depth")
    sizes = parts.select("tree", "block", "n", depth)
    sizes = sizes.groupBy("tree", "depth", F.expr(f"shiftright(block, {bits} - depth)").alias("block")).agg(F.sum("n").alias("n"))
    own = queries.select("q", F.posexplode("codes").alias("tree", "code")).select("q", "tree", "code", depth)
    own = own.withColumn("block", F.expr(f"shiftright(code, {forest.bits} - depth)"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    each = own.join(sizes, ["tree", "depth", "block"], "left").groupBy("q", "depth")
    each = each.agg(*[f(n).alias(c) for c, f in _MERGED.items()])
    ordered = each.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("depth", *_MERGED))).alias("o"))
    return ordered.select("q", *[F.col(f"o.{c}").alias(c) for c in _MERGED])


def _enough(
    truth: pd.DataFrame, counts: DataFrame, queries: DataFrame, parts: DataFrame, bits: int, k: int, forest: Forest
) -> int | None:
    """The smallest number of candidates with which the sample reaches the recall."""
    if truth.empty:
        return 1
    sampled = F.col("q").isin(truth["q"].unique().tolist())
    known = {r["q"]: np.array([r["counts"], r["most"]]) for r in counts.where(sampled).collect()}
    most = max(int(c[0].max()) for c in known.values())
    if bits:
        for r in _above(queries.where(sampled), parts, bits, forest).collect():
            known[r["q"]] = np.concatenate([np.array([r["counts"], r["most"]]), known[r["q"]]], axis=1)
    number = 32
    while True:
        depth = {q: _deepest(c, number, k) for q, c in known.items()}
        if np.mean([a >= depth[q] for q, a in zip(truth["q"], truth["agree"], strict=True)]) >= forest.recall:
            return number
        if number >= most:
            return None
        number = min(most, int(number * 1.1) + 1)


def _deepest(counts: np.ndarray, number: int, k: int) -> int:
    reach = np.flatnonzero((counts[0] >= number) & (counts[1] > k))
    return int(reach[-1]) if len(reach) else 0


def _depths(counts: DataFrame, enough: int, bits: int, k: int) -> DataFrame:
    """``q`` and the depth at which the synchronous ascent stops; null if that is above ``bits``."""
    reached = F.size(F.filter(F.arrays_zip("counts", "most"), lambda c: (c["counts"] >= enough) & (c["most"] > k)))
    if bits == 0:
        reached = F.greatest(reached, F.lit(1))
    return counts.select("q", F.when(reached > 0, F.lit(bits) + reached - 1).alias("depth"))


def _scored(
    coded: DataFrame, queries: DataFrame, parts: DataFrame, depth: DataFrame, bits: int, width: int, k: int, forest: Forest
) -> DataFrame:
    """``q``, ``id``, ``score``: the ``k + 1`` best below each query's prefix, per tree and part."""
    left = _dealt(_blocked(coded, bits, forest, "id", "v"), parts)
    right = _asked(_blocked(queries, bits, forest, "q", "v").join(depth, "q"), parts)

    def one(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({"q": [], "id": [], "score": []})
        order = np.argsort(rows["code"].to_numpy(), kind="stable")
        ordered, ids = rows["code"].to_numpy()[order], rows["id"].to_numpy()[order]
        vectors = matrix(rows["v"].to_numpy()[order], width)
        starts, ends = _below(ordered, asked["code"].to_numpy(), asked["depth"].to_numpy().astype(np.int64), forest.bits)
        questions, names = matrix(asked["v"].to_numpy(), width), asked["q"].to_numpy()
        out = []
        by_range: dict[tuple[int, int], list[int]] = {}
        for i, span in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            by_range.setdefault(span, []).append(i)
        for (start, end), members in by_range.items():
            if start == end:
                continue
            for at in range(0, len(members), 256):
                who = np.array(members[at : at + 256])
                scores = questions[who] @ vectors[start:end].T
                few = min(k + 1, end - start)
                top = np.argpartition(-scores, few - 1, axis=1)[:, :few] if few < end - start else np.tile(np.arange(few), (len(who), 1))
                asker, found = np.repeat(who, few), start + top.ravel()
                out.append(pd.DataFrame({"q": names[asker], "id": ids[found], "score": inner(questions[asker], vectors[found])}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "id": [], "score": []})

    schema = "q long, id long, score double"
    return left.groupBy(*_PART).cogroup(right.groupBy(*_PART)).applyInPandas(one, schema)
