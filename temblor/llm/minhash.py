"""Near-duplicate documents by one-permutation MinHash, bands, and star-shaped candidates.

A document is the set of its distinct word shingles, as 64-bit hashes. One permutation splits the
hash range into bins; the smallest value of each bin is the signature, and empty bins copy from
filled ones chosen by a universal hash of bin and attempt (optimal densification). Runs of
``rows`` bins form a band, and documents that agree on a band fall into one bucket.

A bucket of m documents gives at most 2 m candidate edges a round: from every member to the
bucket's hubs. First these are its first and last member in the order of document numbers, and
of its hubs a member tries the two it shares most buckets with. Edges whose set sizes allow the
similarity and whose signatures, kept to one byte a bin, do not rule it out by six standard
deviations are then checked on the full sets of both documents. What
remains are buckets whose members lie in several components. In further rounds the hubs are the
member with the smallest set and three drawn anew for each bucket and round, and only members of
another component than the hub's get an edge. Rounds end when the hubs drawn anew link less than one
in ``FEW`` of the edges they try: the pairs left are then mostly not similar, and the next step
compares all of them in one pass.

Rounds only join what is easily joined. After them every pair of members of a bucket that still holds
several components, and that are of different ones, is compared: buckets are cut into sub-blocks, and
pairs of sub-blocks sort out their pairs by set sizes and signature bytes, each pair in the first band
it shares. Texts go to the pairs of sub-blocks that need them, where the pairs left are checked on
full sets unless a link found there already joins them. So a pair is missed only if it shares no band
or its signatures rule it out.

Documents with equal sets are one class from the start; only its smallest document is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from temblor.llm.frames import OWN, SALTS, discard, group_value, group_values, scratch, written

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = values + _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


#: Bytes of text whose sets are made together; a longer text is alone.
MOST_TOGETHER = 1 << 20


def shingle_sets(texts: list[bytes | None], size: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word shingles of each whole text, one text after the other, and
    the borders between texts, one more than there are texts.

    A-Z are lowered; words are runs without white space (\\x20, \\x09-\\x0D). With fewer than
    ``size`` words the whole sequence is the one shingle; without words the set is empty.
    """
    words = [(text or b"").lower().split() for text in texts]
    counts = list(map(len, words))
    hashes = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(words)), dtype=np.uint64, count=sum(counts))
    del words
    windows = _windows(hashes, size)
    own, at = [], 0
    for count in counts:
        if count >= size:
            found = windows[at : at + count - size + 1]
            found.sort()
        else:
            found = _windows(hashes[at : at + count], count) if count else hashes[:0]
        own.append(found)
        at += count
    borders = np.cumsum([0, *map(len, own)])
    every = np.concatenate([*own, hashes[:0]])
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[1:] != every[:-1]
    new[borders[:-1][borders[:-1] < len(every)]] = True
    return every[new], np.concatenate([[0], np.cumsum(new)])[borders]


def _windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` hashes."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, np.uint64(width))
    for i in range(width if n else 0):
        out = mix(out ^ hashes[i : n + i])
    return out


def shingles(text: str | None, size: int = 4) -> np.ndarray:
    """The set of ``shingle_sets`` of one text."""
    return shingle_sets([(text or "").encode("utf-8", "replace")], size)[0]


def _together(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First text, end, and ``shingle_sets`` of stretches of ``texts`` (in UTF-8)."""
    lengths = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(texts):
        before = lengths[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(lengths, before + MOST_TOGETHER, side="right")))
        yield low, high, *shingle_sets(texts.slice(low, high - low).cast(pa.binary()).to_pylist(), size)
        low = high


def _each(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of every text."""
    for _, _, sets, borders in _together(texts, size):
        for start, end in pairwise(borders.tolist()):
            yield sets[start:end]


@dataclass(frozen=True)
class Bands:
    """Signature: ``bands`` bands of ``rows`` bins. The similarity to find is 0.8, in integers
    ``percent``. Two documents of similarity s share a band with probability 1-(1-s^rows)^bands:
    0.9999999 for the default at 0.8."""

    bands: int = 32
    rows: int = 4
    percent: int = 80
    shingle: int = 4


def signatures(sets: np.ndarray, borders: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signatures, densified, of sets one after the other, none of them empty."""
    values = mix(sets ^ np.uint64(0x5851F42D4C957F2D))
    # the permuted range in equal bins: the high bits give the bin, the whole value the order
    at = (((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    n = len(borders) - 1
    at += np.repeat(np.arange(n, dtype=np.int64) * bins, np.diff(borders))
    least = np.full(n * bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, at, values)
    filled = np.zeros(n * bins, dtype=bool)
    filled[at] = True
    empty = np.flatnonzero(~filled)
    out = least.copy()
    attempt = 1
    while len(empty):
        with np.errstate(over="ignore"):
            keys = np.arange(bins, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(attempt) * np.uint64(0x9E3779B1)
        own = empty % bins
        source = empty - own + (mix(keys) % np.uint64(bins)).astype(np.int64)[own]
        good = filled[source]
        out[empty[good]] = least[source[good]]
        empty = empty[~good]
        attempt += 1
    return out.reshape(n, bins)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The signature of one set that is not empty."""
    return signatures(hashes, np.array([0, len(hashes)]), bins)[0]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per signature and band, different from band to band."""
    out = np.arange(bands, dtype=np.uint64)
    grid = sig.reshape(*sig.shape[:-1], bands, rows)
    for i in range(rows):
        out = mix(out ^ grid[..., i])
    return out


SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("content", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("bytes", T.BinaryType()),
    ]
)


def sketches(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Per document its set size, a 128-bit digest of the set, a hash of the text, its band keys, and
    the lowest byte of every bin of its signature."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("content", pa.int64()), ("keys", pa.list_(pa.int64())), ("bytes", pa.binary())])

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in incoming:
            for low, high, sets, borders in _together(whole.column("text"), bands.shingle):
                batch = whole.slice(low, high - low)
                sizes, raw = np.diff(borders), sets.tobytes()
                cuts = pairwise((8 * borders).tolist())
                digests = [hashlib.blake2b(raw[start:end], digest_size=16).digest() for start, end in cuts]
                full = sizes > 0
                sigs = signatures(sets, np.concatenate([[0], borders[1:][full]]), bands.bands * bands.rows)
                keys = pa.array(band_keys(sigs, bands.bands, bands.rows).astype(np.int64).ravel(), pa.int64())
                ends = np.cumsum(np.concatenate([[0], bands.bands * full]), dtype=np.int32)
                row = iter(sigs.astype(np.uint8))
                low_bytes = [next(row).tobytes() if f else b"" for f in full.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), batch.column("content"),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys), pa.array(low_bytes, pa.binary()),
                    ],
                    schema=schema,
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("content")).mapInArrow(run, SKETCH)


def with_hubs(members: DataFrame, step: int = 0) -> DataFrame:
    """``bucket``, ``doc``, ``n``, ``c`` of the buckets with more than one component ``c``, and an
    array of their ``hubs``.

    At step 0 these are the first and the last document by number; later the one with the smallest
    set and three drawn by bucket and step. Hubs come from mergeable aggregates, and a hot bucket
    is split into sub-keys on the way back.
    """
    drawn = [F.xxhash64("doc", "bucket", F.lit(step), F.lit(i)) for i in range(3)]
    orders = [F.col("n"), *drawn] if step else [F.col("doc"), -F.col("doc")]
    hub = [F.col("doc").alias("d"), F.col("n").alias("m"), F.col("c").alias("c")]
    ends = {f"hub{i}": F.struct(order.alias("o"), *hub) for i, order in enumerate(orders)}
    ranked = members.withColumns({**ends, "c0": F.col("c"), "c1": F.col("c")})
    values = {**dict.fromkeys(ends, F.min), "c0": F.min, "c1": F.max}
    found = group_values(ranked, ["bucket"], F.col("doc"), values, F.col("c0") != F.col("c1"))
    hubs = [F.struct(F.lit(i).alias("end"), F.col(f"hub{i}.d"), F.col(f"hub{i}.m"), F.col(f"hub{i}.c")) for i in range(len(ends))]
    return found.select("bucket", "doc", "n", "c", F.array(*hubs).alias("hubs"))


def stars(hubs: DataFrame, sketched: DataFrame, bands: Bands, step: int) -> DataFrame:
    """Distinct candidate edges ``hub``, ``member`` between components.

    At step 0 a member tries the first and the last hub it shares most buckets with; later one of the
    hubs with the smallest sets and one of those drawn, again that it shares most buckets with. So a
    round has at most two edges a member, whatever its buckets hold.
    Set sizes and one-byte signatures of ``sketched`` (``doc``, ``n``, ``bytes``) sort out what
    cannot be similar enough before any text moves.
    """
    edges = hubs.select("doc", "n", "c", F.explode("hubs").alias("hub"))
    possible = 100 * F.least("n", "hub.m") >= bands.percent * F.greatest("n", "hub.m")
    edges = edges.where((F.col("c") != F.col("hub.c")) & possible).select(
        F.col("hub.d").alias("hub"), F.col("doc").alias("member"), (F.least("hub.end", F.lit(1)) if step else F.col("hub.end")).alias("end")
    )
    votes = edges.groupBy("hub", "member", "end").agg(F.count(F.lit(1)).alias("votes"))
    most = F.max(F.struct("votes", (-F.col("hub")).alias("hub")))
    edges = votes.groupBy("member", "end").agg(most.alias("m")).select((-F.col("m.hub")).alias("hub"), "member").distinct()
    own = sketched.select(F.col("doc").alias("member"), "n", "bytes")
    other = sketched.select(F.col("doc").alias("hub"), F.col("n").alias("hub_n"), F.col("bytes").alias("hub_bytes"))
    pairs = edges.join(own, "member").join(other, "hub")

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("bytes", "hub_bytes"))
            least = np.minimum(*(batch.column(c).to_numpy() for c in ("n", "hub_n")))
            yield batch.select(["hub", "member"]).filter(pa.array(_possible(a, b, least, bands)))

    return pairs.select("hub", "member", "n", "hub_n", "bytes", "hub_bytes").mapInArrow(run, "hub long, member long")


def _possible(a: np.ndarray, b: np.ndarray, least: np.ndarray, bands: Bands) -> np.ndarray:
    """Whether signature bytes, row by row, leave the similarity possible; ``least`` is the smaller set's size."""
    share = bands.percent / 100
    slack = 6 * np.sqrt(share * (1 - share) / np.minimum(least, a.shape[-1]))
    return (a == b).mean(axis=1) >= share - slack


#: A round is the last if fewer than one in so many of its edges are links.
FEW = 20

#: Members of a sub-block of a bucket; two sub-blocks meet in a task with their texts.
BLOCK = 256

_BLOCK = ["bucket", "low", "high"]


def _blocks(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each pair of sub-blocks, from batches sorted by ``_BLOCK``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in incoming:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in _BLOCK])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if held and tuple(keys[start]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = tuple(keys[start])
    if held:
        yield pa.Table.from_batches(held)


def partners(mixed: DataFrame, sketched: DataFrame, bands: Bands) -> DataFrame:
    """``bucket``, ``low``, ``high``, ``doc``, ``partners``: per pair of sub-blocks, the documents of
    every pair that is to be checked, each with those it is to be checked with there.

    ``mixed`` has ``bucket``, ``doc``, ``n``, ``c``. In each bucket one component, drawn by a member of
    it, so mostly the largest, is not compared with itself; a large component costs no square.
    """
    drawn = mixed.withColumn("top", F.struct(F.xxhash64("doc", "bucket").alias("o"), "c"))
    drawn = group_values(drawn, ["bucket"], F.col("doc"), {"top": F.min}).withColumn("minor", F.col("c") != F.col("top.c"))
    sized = drawn.withColumns({"minors": F.col("minor").cast("long"), "majors": (~F.col("minor")).cast("long")})
    sized = group_values(sized, ["bucket"], F.col("doc"), {"minors": F.sum, "majors": F.sum})
    minors, majors = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("minors", "majors"))
    at = F.when(F.col("minor"), F.pmod(F.xxhash64("doc"), minors)).otherwise(minors + F.pmod(F.xxhash64("doc"), majors))
    others = F.sequence(F.lit(0), F.when(F.col("minor"), minors + majors).otherwise(minors) - 1)
    placed = sized.withColumn("at", at.cast("int")).join(sketched.select("doc", "bytes", "keys"), "doc")
    met = placed.select("bucket", "doc", "n", "c", "bytes", "keys", "at", F.explode(others).alias("other"))
    met = met.withColumns({"low": F.least("at", "other"), "high": F.greatest("at", "other")}).drop("other")
    schema = T.StructType(
        [
            T.StructField("bucket", T.LongType()),
            T.StructField("low", T.IntegerType()),
            T.StructField("high", T.IntegerType()),
            T.StructField("doc", T.LongType()),
            T.StructField("partners", T.ArrayType(T.LongType())),
        ]
    )

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(incoming):
            doc, n, c, at = (rows.column(x).to_numpy() for x in ("doc", "n", "c", "at"))
            if c.min() == c.max():
                continue
            bucket, low, high = (rows.column(x)[0].as_py() for x in _BLOCK)
            sig = np.frombuffer(b"".join(rows.column("bytes").to_pylist()), np.uint8).reshape(len(doc), -1)
            keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(doc), -1)
            left = np.flatnonzero(at == low)
            right = left if low == high else np.flatnonzero(at == high)
            found: dict[int, list[int]] = {}
            for number, i in enumerate(left):
                js = right[number + 1 :] if low == high else right
                fit = 100 * np.minimum(n[i], n[js]) >= bands.percent * np.maximum(n[i], n[js])
                js = js[(c[js] != c[i]) & fit]
                js = js[_possible(sig[i], sig[js], np.minimum(n[i], n[js]), bands)]
                if len(js):  # a pair is checked in the first band it shares
                    js = js[keys[i][(keys[js] == keys[i]).argmax(axis=1)] == bucket]
                if len(js):
                    found.setdefault(int(doc[i]), []).extend(doc[js].tolist())
                    for j in doc[js].tolist():
                        found.setdefault(j, [])
            if found:
                k = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket] * k, pa.int64()), pa.array([low] * k, pa.int32()), pa.array([high] * k, pa.int32()), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))],
                    names=[*_BLOCK, "doc", "partners"],
                )

    return met.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK).mapInArrow(run, schema)


def remaining(pairs: DataFrame, docs: DataFrame, bands: Bands) -> DataFrame:
    """Links (``hub``, ``member``) that join what all similar pairs of ``partners`` join."""
    texts = pairs.join(docs.hint("merge"), "doc").select(*_BLOCK, "doc", "partners", "text")

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def with_sets() -> Iterator[pa.RecordBatch]:
            for batch in incoming:
                # some texts at a time; only sets are held
                for low, high, sets, borders in _together(batch.column("text"), bands.shingle):
                    raw = sets.tobytes()
                    own = [raw[start:end] for start, end in pairwise((8 * borders).tolist())]
                    rows = batch.slice(low, high - low).select([*_BLOCK, "doc", "partners"])
                    yield rows.append_column("set", pa.array(own, pa.binary()))

        for rows in _blocks(with_sets()):
            own: dict[int, np.ndarray] = {}
            for doc, raw in zip(rows.column("doc").to_pylist(), rows.column("set"), strict=True):
                found = np.frombuffer(raw.as_buffer(), np.uint64)
                if doc not in own or len(found) > len(own[doc]):
                    own[doc] = found
            parent = {d: d for d in own}

            def root(d: int, parent: dict[int, int] = parent) -> int:
                while parent[d] != d:
                    parent[d] = parent[parent[d]]
                    d = parent[d]
                return d

            hubs, members = [], []
            for doc, others in zip(rows.column("doc").to_pylist(), rows.column("partners").to_pylist(), strict=True):
                for other in others:
                    if root(doc) == root(other):
                        continue
                    both = len(np.intersect1d(own[doc], own[other], assume_unique=True))
                    if 100 * both >= bands.percent * (len(own[doc]) + len(own[other]) - both):
                        hubs.append(doc)
                        members.append(other)
                        parent[root(doc)] = root(other)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(members, pa.int64())], names=["hub", "member"])

    return texts.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK).mapInArrow(run, "hub long, member long")


def confirm(edges: DataFrame, docs: DataFrame, bands: Bands) -> DataFrame:
    """The edges whose full sets are similar enough; ``docs`` has distinct ``doc`` and ``text``.

    Texts of documents on an edge meet in sorted order: a hub's text, then its members'. Only the
    hub's set is held. A hub with many members is split into sub-keys, each with the hub's text.
    """
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(SALTS)).cast("int"))
    side = salted.select(F.col("member").alias("doc"), "hub", "salt", F.lit(1).alias("role")).union(
        salted.select("hub", "salt").distinct().select(F.col("hub").alias("doc"), "hub", "salt", F.lit(0).alias("role"))
    )
    # side by side at any size: beside texts a table of edges is small only where little is at stake
    texts = side.join(docs.hint("merge"), "doc").select("hub", "salt", "role", "doc", "text")
    sorted_texts = texts.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role")
    schema = T.StructType([T.StructField("hub", T.LongType()), T.StructField("member", T.LongType())])

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in incoming:
            hubs, members = [], []
            columns = [batch.column(c).to_pylist() for c in ("hub", "salt", "role", "doc")]
            for hub, salt, role, doc, found in zip(*columns, _each(batch.column("text"), bands.shingle), strict=True):
                if role == 0:
                    at, own = (hub, salt), found.copy()  # a view would hold the sets around it
                    continue
                assert at == (hub, salt)
                both = len(np.intersect1d(own, found, assume_unique=True))
                if 100 * both >= bands.percent * (len(own) + len(found) - both):
                    hubs.append(hub)
                    members.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(members, pa.int64())], names=["hub", "member"])

    return sorted_texts.mapInArrow(run, schema)


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``doc``, ``component``: the smallest document each one of ``edges`` (``hub``, ``member``)
    reaches.

    Each round every node takes one of its neighbours or itself, and the graph contracts to the
    nodes taken and the edges between them, until none is left; what was taken composes to the
    result. The first round takes the smallest document, which ends stars at once; later ones the
    first by a hash of node and round, so that chains in any order shrink by a constant factor. Labels
    and edges are stored tables, so Spark splits their joins where a node is hot; the driver sees
    whether edges are left.
    """
    rows = written(edges.select(F.col("hub").alias("u"), F.col("member").alias("v")).where("u <> v"), "edges")
    found = None
    for step in range(most_rounds):
        both = rows.union(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        order = (lambda c: F.xxhash64(c, F.lit(step))) if step else (lambda c: F.col(c))
        near = F.min(F.struct(order("v").alias("o"), F.col("v").alias("c")))
        own = F.struct(order("u").alias("o"), F.col("u").alias("c"))
        taken = written(both.groupBy("u").agg(F.least(near, own)["c"].alias("c")), "taken")
        before, found = found, (taken if found is None else written(_composed(found, taken), "labels"))
        ends = rows.join(taken, "u").select("v", F.col("c").alias("cu"))
        ends = ends.join(taken.withColumnRenamed("u", "v"), "v").where("cu <> c")
        ended, rows = rows, written(ends.select(F.greatest("cu", "c").alias("u"), F.least("cu", "c").alias("v")).distinct(), "edges")
        discard(before, ended, taken if step else None)
        if rows.isEmpty():
            if step:  # the node that was left need not be the smallest
                least = written(found.groupBy("c").agg(F.least(F.min("u"), F.col("c")).alias("d")), "least")
                found = _composed(found, least.select(F.col("c").alias("u"), F.col("d").alias("c")))
            return found.select(F.col("u").alias("doc"), F.col("c").alias("component"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _composed(first: DataFrame, then: DataFrame) -> DataFrame:
    """``u`` and ``c``: what ``first`` gives, or what ``then`` gives for that."""
    after = then.select(F.col("u").alias("c"), F.col("c").alias("d"))
    return first.join(after, "c", "left").select("u", F.coalesce("d", "c").alias("c"))


def near_duplicates(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``.

    A document without words is linked with nothing. A null ``doc_id`` takes no part in linking:
    its component is null and it is kept. Rows that share a ``doc_id`` are one document whose set
    is that of the row with the largest set (ties: the smallest digest); each row is returned with
    its own set size. Of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    with scratch(docs.sparkSession) as result:
        rows = written(sketches(docs, bands), "sketches")
        known = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
        whole = known.groupBy("doc_id").agg(
            F.max(F.struct("n_shingles", "set_key", "content", "keys", "bytes")).alias("s")
        ).select("doc_id", "s.*")
        # documents with equal sets: one class, stood for by its smallest document
        classes = written(group_value(whole, ["set_key"], F.col("doc_id"), F.min, "doc_id", "class"), "classes")
        leaders = classes.where(F.col("doc_id") == F.col("class"))
        members = leaders.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), F.explode("keys").alias("bucket"))
        sketched = leaders.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "bytes", "keys")
        texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), "text")
        if known.count() > classes.count():
            texts = _one_each(texts, leaders)
        # buckets of one leader give no candidates; most are, and go before hubs are looked for
        shared = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket"), "shared")
        members = members.join(shared, "bucket", "left_semi")
        hubs = written(with_hubs(members.withColumn("c", F.col("doc"))), "buckets")
        discard(shared)
        found, step = None, 0
        while True:
            edges = written(stars(hubs, sketched, bands, step), "candidates")
            new = written(confirm(edges, texts, bands), "links")
            tried, linked = edges.count(), new.count()
            discard(edges)
            if not linked:
                break
            before, found = found, written(_joined(new, found), "components")
            discard(before, new)
            step += 1
            own = hubs.drop("hubs", "c").join(found.withColumnRenamed("u", "doc"), "doc", "left")
            before, hubs = hubs, written(with_hubs(own.withColumn("c", F.coalesce("c", "doc")), step), "buckets")
            discard(before)
            if step == 1:  # from here on only texts of documents in buckets that are still mixed move
                still = hubs.select("doc").distinct()
                texts = written(texts.hint("merge").join(still, "doc", "left_semi"), "open-texts")
            elif FEW * linked < tried:
                break
        # hubs link nothing more: every other pair of a bucket that is still mixed
        left = written(partners(hubs.drop("hubs"), sketched, bands), "partners")
        new = written(remaining(left, texts, bands), "links")
        discard(left, hubs)
        if not new.isEmpty():
            found = written(_joined(new, found), "components")
        if found is not None:
            found = found.select(F.col("u").alias("doc"), F.col("c").alias("component"))
        named = classes.select("doc_id", F.col("class").alias("doc"))
        if found is not None:
            named = named.join(found, "doc", "left").select("doc_id", F.coalesce("component", "doc").alias("component"))
        else:
            named = named.withColumnRenamed("doc", "component")
        named = named.withColumnRenamed("doc_id", f"{OWN}id")
        out = rows.join(named, rows["doc_id"] == named[f"{OWN}id"], "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        out = out.select(
            "doc_id", "n_shingles", component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
        return result(out, "near-duplicates")


def _one_each(texts: DataFrame, leaders: DataFrame) -> DataFrame:
    """Of the texts of a repeated ``doc`` the one whose set stands for it, once however often it occurs.
    Copies merge before anything moves."""
    content = F.xxhash64("text").alias("content")
    once = texts.select("doc", content, "text").groupBy("doc", "content").agg(F.min("text").alias("text"))
    chosen = leaders.select(F.col("doc_id").alias("doc"), "content")
    return written(once.join(chosen, ["doc", "content"], "left_semi").select("doc", "text"), "texts")


def _joined(links: DataFrame, found: DataFrame | None) -> DataFrame:
    """``u`` and ``c`` after ``links`` join components of ``found``, whose labels compose with the new."""
    ends = links if found is None else _between_components(links, found)
    joined = components(ends).select(F.col("doc").alias("u"), F.col("component").alias("c"))
    if found is None:
        return joined
    return _composed(found, joined).unionByName(joined.join(found, "u", "left_anti"))


def _between_components(links: DataFrame, found: DataFrame) -> DataFrame:
    """Links as edges between the components of their ends so far."""
    for end in ("hub", "member"):
        label = found.select(F.col("u").alias(end), F.col("c").alias("label"))
        links = links.join(label, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    return links


def keep_one(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with their columns.

    Of rows that share a ``doc_id`` the smallest stays; rows with a null ``doc_id`` all stay.
    """
    result = near_duplicates(docs, bands).where("kept AND doc_id IS NOT NULL")
    ids = written(result.groupBy(F.col("doc_id").alias(f"{OWN}id")).agg(F.count(F.lit(1)).alias("n")), "kept")
    is_id = docs["doc_id"] == ids[f"{OWN}id"]
    out = docs.join(ids.where("n = 1"), is_id, "left_semi").unionByName(docs.where("doc_id IS NULL"))
    repeated = ids.where("n > 1")
    if not repeated.isEmpty():
        rows = docs.join(repeated, is_id, "left_semi")
        least = rows.groupBy(F.col("doc_id").alias(f"{OWN}id")).agg(F.min(F.struct(*docs.columns)).alias("row"))
        out = out.unionByName(least.select("row.*"))
    return out
