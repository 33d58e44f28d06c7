"""Merkle manifest of a dataset: one tree per language, one above them, and a proof per document.

A document's leaf is a digest of its fields. The leaves of a language, in ascending ``doc_id``, form
a tree in which every eight consecutive nodes become one; the languages' roots form another.

Trees are kept as postorder append logs. A log holds a tree's nodes in the order in which an append
of leaf after leaf completes them, so a node's place follows from sizes alone (``position``) and no
pointers are stored. Leaves are dealt to builders in aligned stretches of ``FAN**STEPS``; what a builder
completes is one contiguous slice of the log, one row. The slices' last nodes are the leaves of the
next round, which is 4,096 times smaller, until each tree has one node.

Proofs go the other way. From the top, each round reads its slices, addresses the siblings of every
node by their positions, and hands the proof so far to the slice below that ends in this node.
Documents meet the slice of their own stretch, so nothing of a proof moves once per document.

Rows with null or repeated ``doc_id`` are leaves like others: null comes first, repeated ids go by
leaf. Equal rows give equal leaves side by side, each with its own proof. A null language is a tree
of its own, before the others. An empty table gives an empty result. Columns other than the five
fields are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, numbered, scratch, written

FAN = 8

#: Levels that one builder completes, so it takes ``FAN**STEPS`` nodes.
STEPS = 4

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PROOF = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` of them."""
    found = 0
    while n > 1:
        n, found = -(-n // FAN), found + 1
    return found


def position(level: int, index: int, n: int, levels: int) -> int:
    """Where the log of ``levels`` levels over ``n`` leaves holds a node: behind all that was complete
    before its first leaf came, and behind its own subtree."""
    first = index * FAN**level
    own = min(FAN**level, n - first)
    before = sum(first // FAN**j for j in range(levels + 1))
    return before + sum(-(-own // FAN**j) for j in range(level + 1)) - 1


def postorder(leaves: list[str], levels: int) -> list[str]:
    """The log of ``levels`` levels over ``leaves``, each node written when its last leaf is there."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def add(level: int, node: str) -> None:
        log.append(node)
        if level < levels:
            open_runs[level].append(node)
            if len(open_runs[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        add(level + 1, digest("".join(run)))

    for leaf in leaves:
        add(0, leaf)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return log


def slice_proofs(log: list[str], n: int, levels: int, above: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """For each of the ``n`` lowest nodes of a slice the siblings left and right of its path, level by
    level, followed by ``above``."""
    proofs = [above]
    for level in range(levels - 1, -1, -1):
        width = -(-n // FAN**level)
        here = [log[position(level, i, n, levels)] for i in range(width)]
        lower = []
        for i in range(width):
            run = i - i % FAN
            pair = ("".join(here[run:i]), "".join(here[i + 1 : run + FAN]))
            lower.append([pair, *proofs[i // FAN]])
        proofs = lower
    return proofs


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that ``leaf`` leads to with the siblings of a proof."""
    return reduce(lambda node, pair: digest(pair[0] + node + pair[1]), proof, leaf)


def leaf_digest(columns: dict[str, Column]) -> Column:
    """A field is ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    texts = [columns[name].cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def tampered() -> Column:
    """Which documents the registered query changes: by the checksum of the decimal id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf``, and ``now``: the leaf of the document as it is now, which where
    ``changed`` has its ASCII letters in lower case."""
    own = {name: F.col(name) for name in FIELDS}
    leaf = leaf_digest(own)
    now = leaf
    if changed is not None:
        lower = {**own, "text": F.translate("text", _UPPER, _UPPER.lower())}
        now = F.when(changed, leaf_digest(lower)).otherwise(leaf)
    return docs.select("doc_id", "lang", leaf.alias("leaf"), now.alias("now"))


def build(nodes: DataFrame, most: int, steps: int = STEPS) -> list[DataFrame]:
    """The logs of all trees, one table a round: ``tree``, ``block``, ``n`` (nodes of the tree in this
    round), ``log``.

    ``nodes`` has ``tree``, ``at`` (from 0 within the tree), ``n`` and ``digest``; ``most`` is the
    largest ``n``. A builder holds ``FAN**steps`` nodes, however large its tree is.
    """
    span = FAN**steps
    schema = T.StructType(
        [
            T.StructField("tree", T.LongType()),
            T.StructField("block", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("log", T.ArrayType(T.StringType())),
        ]
    )
    arrow = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("log", pa.list_(pa.string()))])

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        n = group.column("n")[0].as_py()
        log = postorder(group.column("digest").to_pylist(), min(steps, height(n)))
        row = [[group.column("tree")[0].as_py()], [group.column("block")[0].as_py()], [n], [log]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow, strict=True)], schema=arrow)

    rounds = []
    while True:
        blocks = nodes.select("tree", F.expr(f"at div {span}").alias("block"), "n", "at", "digest")
        log = written(blocks.groupBy("tree", "block").applyInArrow(one, schema), "merkle-log")
        rounds.append(log)
        if most <= span:
            return rounds
        most = -(-most // span)
        above = F.expr(f"(n + {span - 1}) div {span}")
        nodes = log.select("tree", F.col("block").alias("at"), above.alias("n"), F.element_at("log", -1).alias("digest"))
        nodes = nodes.where("n > 1")


def roots(rounds: list[DataFrame], steps: int = STEPS) -> DataFrame:
    """``tree`` and ``root``: the last node of the round in which a tree has one slice."""
    last = [log.where(f"n <= {FAN**steps}").select("tree", F.element_at("log", -1).alias("root")) for log in rounds]
    return reduce(DataFrame.unionAll, last)


def node_proofs(log: DataFrame, proofs: DataFrame, steps: int = STEPS) -> DataFrame:
    """``tree``, ``block``, ``proof``: each lowest node of the slices ``log`` with what lies above it,
    ``proofs`` having what lies above each slice. A node is a block of the round below."""
    schema = T.StructType(
        [T.StructField("tree", T.LongType()), T.StructField("block", T.LongType()), T.StructField("proof", _PROOF)]
    )
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                found = _row_proofs(row, steps)
                n, first = len(found), row["block"] * FAN**steps
                pairs = [[{"left": a, "right": b} for a, b in proof] for proof in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()), pa.array(pairs, kind)],
                    names=schema.names,
                )

    return log.join(proofs, ["tree", "block"]).mapInArrow(below, schema)


def _row_proofs(row: dict, steps: int) -> list[list[tuple[str, str]]]:
    n = min(FAN**steps, row["n"] - row["block"] * FAN**steps)
    upper = [(p["left"], p["right"]) for p in row["proof"]]
    return slice_proofs(row["log"], n, min(steps, height(row["n"])), upper)


def block_proofs(rounds: list[DataFrame], above: DataFrame, steps: int = STEPS) -> DataFrame:
    """``tree``, ``block``, ``proof``: what lies above each slice of the first round, up to ``above``,
    a table of ``tree`` and ``proof`` for the trees' roots."""
    proofs = None
    for log in reversed(rounds):
        whole = log.where(f"n <= {FAN**steps}").select("tree", "block").join(above, "tree")
        proofs = whole if proofs is None else proofs.unionByName(whole)
        if log is not rounds[0]:
            proofs = node_proofs(log, proofs, steps)
    return proofs


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("leaf", T.StringType()),
        T.StructField("subroot", T.StringType()),
        T.StructField("root", T.StringType()),
        T.StructField("proof_sha256", T.StringType()),
        T.StructField("folded_root", T.StringType()),
        T.StructField("verified", T.BooleanType()),
    ]
)


def _verified(docs: pa.Table, block: pa.Table, steps: int) -> pa.Table:
    """The documents of one stretch against the slice and the upper proof of their block."""
    [row] = block.to_pylist()
    docs = docs.sort_by("at")
    found = _row_proofs(row, steps)
    folded = [fold(now, proof) for now, proof in zip(docs.column("now").to_pylist(), found, strict=True)]
    proofs = [digest("".join(a + b for a, b in proof)) for proof in found]
    n, root = docs.num_rows, row["root"]
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "leaf": docs.column("digest"),
            "subroot": pa.array([row["subroot"]] * n, pa.string()),
            "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == root for f in folded], pa.bool_()),
        }
    )


def manifest(docs: DataFrame, changed: Column | None = None, steps: int = STEPS) -> DataFrame:
    """Every document's leaf, roots, proof and whether its present text still leads to the root.

    ``changed`` says which documents are to be checked with their ASCII letters in lower case, as
    if someone had altered them after the manifest was built; by default none.
    """
    at, first, lang = f"{OWN}at", f"{OWN}begin", f"{OWN}lang"
    spark = docs.sparkSession
    with scratch(spark) as result:
        # the row's own number keeps equal rows from falling into one range of the sort
        own = leaves(docs, changed).withColumn(at, F.monotonically_increasing_id())
        rows = numbered(written(own.orderBy("lang", "doc_id", "leaf", at).drop(at), "merkle-leaves"), at)
        trees = rows.groupBy("lang").agg(F.min(at).alias(first), F.count(F.lit(1)).alias("n")).orderBy("lang")
        trees = numbered(written(trees, "merkle-trees"), "tree").withColumnRenamed("lang", lang)
        n_trees, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(1))).first()
        nodes = rows.join(trees, F.col("lang").eqNullSafe(F.col(lang))).select(
            "doc_id", "now", "tree", "n", F.col("leaf").alias("digest"), (F.col(at) - F.col(first)).alias("at")
        )
        logs = build(nodes, most, steps)
        subroots = written(roots(logs, steps), "merkle-subroots")
        upper = subroots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("at"),
            F.lit(n_trees).cast("long").alias("n"),
            F.col("root").alias("digest"),
        )
        upper_logs = build(upper, n_trees, steps)
        top = roots(upper_logs, steps).first()
        nothing = spark.range(1).select(F.col("id").alias("tree"), F.array().cast(_PROOF).alias("proof"))
        languages = node_proofs(upper_logs[0], block_proofs(upper_logs, nothing, steps), steps)
        languages = written(languages.select(F.col("block").alias("tree"), "proof"), "merkle-languages")
        blocks = (
            logs[0]
            .join(block_proofs(logs, languages, steps), ["tree", "block"])
            .join(subroots.withColumnRenamed("root", "subroot"), "tree")
            .withColumn("root", F.lit(top["root"] if top else None).cast("string"))
        )
        dealt = nodes.withColumn("block", F.expr(f"at div {FAN**steps}"))
        both = dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
        checked = both.applyInArrow(lambda own, block: _verified(own, block, steps), RESULT)
        return result(checked, "merkle-manifest")
