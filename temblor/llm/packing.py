"""Vector best-fit packing of documents into token sequences.

A bin has three residual capacities: tokens, documents, and attention cost (the sum of squared
piece lengths, what attention inside each document costs). A piece goes to an open bin that has
room in every dimension, chosen by

* ``dot``: the largest weighted dot product of the piece's needs and the bin's residuals, or
* ``norm``: the smallest weighted norm of what would remain of the residuals.

Both are over shares of the capacities, pieces are taken longest first, and a bin is opened only
when none fits. Pieces are dealt over groups of about ``group_pieces``, which pack independently;
the cost of packing apart is less than one open bin a group. A group's size depends on the
parameter, not on the table.

Documents that come with a place in an order, such as a mixture, are dealt by consecutive stretches
of it, and sequences are numbered along it: by group, then by the place of a bin's longest piece. So
a prefix of the sequences is a prefix of the order up to one group. Pieces of
documents without a place are dealt in turn by their numbers in the stored table, so equal rows,
which have numbers of their own, spread over groups too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, numbered, written
from temblor.llm.tokens import encoding, vocabulary_path

END_ID = 1

#: Sequence numbers that a group of pieces has for itself; it never has as many pieces.
SEQUENCES = 1 << 32


@dataclass(frozen=True)
class Bins:
    """Capacities of a sequence, the rule that selects one, and the weights of the dimensions."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def tokenised_pieces(
    docs: DataFrame, most_tokens: int = 4096, end_id: int = END_ID, path: str | None = None, place: str | None = None
) -> DataFrame:
    """Every document's ids and end id, cut into pieces of at most ``most_tokens``.

    A null or empty text is one piece that holds the end id alone. Repeated rows give repeated
    pieces; a null ``doc_id`` stays null. Columns other than ``doc_id`` and ``text`` are ignored,
    except ``place``, a column of whole numbers that pieces take from their document.
    """
    path = path or vocabulary_path()
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        + [(place, pa.int64())] * bool(place)
    )
    given = ("doc_id", place) if place else ("doc_id",)

    def cut(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding(path) as encode:
            for batch in incoming:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    rows = []
                    texts = encode.ids(part.column("text").cast(pa.binary()).to_pylist())
                    keys = zip(*(part.column(c).to_pylist() for c in given), strict=True)
                    for (doc_id, *at_place), ids in zip(keys, texts, strict=True):
                        ids += end
                        for piece, low in enumerate(range(0, len(ids), 4 * most_tokens)):
                            own = ids[low : low + 4 * most_tokens]
                            rows.append((doc_id, piece, low // 4, len(own) // 4, zlib.crc32(own), *at_place))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                    )

    out = T.StructType([*PIECES.fields, *([T.StructField(place, T.LongType())] if place else [])])
    return docs.select(*given, "text").mapInArrow(cut, out)


def best_fit(lengths: np.ndarray, bins: Bins = Bins()) -> np.ndarray:
    """The bin of each piece, by vector best-fit over pieces longest first.

    Full bins leave the list of open ones, which holds at most one entry per piece. Ties go to the
    bin opened first.
    """
    capacity = np.array([bins.tokens, bins.documents, bins.attention], dtype=float)
    weights = np.array(bins.weights, dtype=float)
    order = np.argsort(-lengths, kind="stable")
    chosen = np.empty(len(lengths), dtype=np.int64)
    rest = np.empty((256, 3))
    name = np.empty(256, dtype=np.int64)
    held, opened = 0, 0
    smallest = int(lengths.min()) if len(lengths) else 0
    for i in order:
        n = int(lengths[i])
        need = np.array([n, 1, n * n], dtype=float)
        if (need > capacity).any():
            raise ValueError(f"a piece of {n} tokens fits no bin")
        at = -1
        if held:
            room = rest[:held]
            fits = np.flatnonzero((room >= need).all(axis=1))
            if len(fits):
                shares = room[fits] / capacity
                if bins.rule == "dot":
                    score = -(shares * (need / capacity) * weights).sum(axis=1)
                else:
                    left = shares - need / capacity
                    score = (left * left * weights).sum(axis=1)
                at = int(fits[np.argmin(score)])
        if at < 0:
            if held == len(rest):
                rest = np.concatenate([rest, np.empty_like(rest)])
                name = np.concatenate([name, np.empty_like(name)])
            at, held = held, held + 1
            rest[at], name[at] = capacity, opened
            opened += 1
        chosen[i] = name[at]
        rest[at] -= need
        if rest[at, 0] < smallest or rest[at, 1] < 1 or rest[at, 2] < smallest * smallest:
            held -= 1
            rest[at : held] = rest[at + 1 : held + 1]
            name[at : held] = name[at + 1 : held + 1]
    return chosen


def pack(pieces: DataFrame, bins: Bins = Bins(), group_pieces: int = 4000, place: str | None = None) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length``) plus ``sequence_id`` and ``offset``.

    Groups are stretches of ``place``, a column that goes, and ``piece``; without it rows are dealt in
    turn by their number. Sequence numbers rise along the order. An empty table gives an empty one. ``pieces`` is
    read from Parquet, more than once.
    """
    total = pieces.count()
    groups = max(1, -(-total // group_pieces))
    group, at = f"{OWN}group", f"{OWN}at"
    if place:
        stored = written(pieces.orderBy(place, "piece").drop(place), "pieces-in-order")
        dealt = numbered(stored, at).withColumn(group, F.expr(f"{at} * {groups}L div {max(1, total)}L"))
    else:
        stored = pieces
        dealt = numbered(stored, at).withColumn(group, F.col(at) % groups)
    schema = T.StructType(
        [*stored.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    columns = stored.columns

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        # Arrow, since pandas would turn ids beside a null into floating-point numbers
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), (at, "ascending")])
        lengths = rows.column("length").to_numpy()
        chosen = best_fit(lengths, bins)
        # a bin's first row is its longest piece; its place gives the bin's number
        _, longest = np.unique(chosen, return_index=True)
        rank = np.argsort(np.argsort(rows.column(at).to_numpy()[longest], kind="stable"), kind="stable")
        order = np.argsort(chosen, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        opens = np.searchsorted(chosen[order], chosen[order])
        offset = np.empty_like(lengths)
        offset[order] = before - before[opens]
        places = {"sequence_id": key[0].as_py() * SEQUENCES + rank[chosen], "offset": offset}
        return pa.table({**{c: rows.column(c) for c in columns}, **{c: pa.array(v, pa.int64()) for c, v in places.items()}})

    return dealt.groupBy(group).applyInArrow(one, schema)


def pack_documents(
    docs: DataFrame, bins: Bins = Bins(), end_id: int = END_ID, path: str | None = None, group_pieces: int = 4000, place: str | None = None
) -> DataFrame:
    """Documents to pieces with their place in a sequence; ``place`` is their place in an order."""
    pieces = written(tokenised_pieces(docs, bins.tokens, end_id, path, place), "pieces")
    return pack(pieces, bins, group_pieces, place)
