"""Document fingerprints by winnowing: the smallest hash of every window of k-gram hashes.

Every run of ``gram`` code points is hashed by a rolling polynomial modulo 2^64, mixed. Of every
``window`` consecutive hashes the smallest is chosen, the rightmost if several are; chosen hashes with
their positions, each position once, are the fingerprint. So two texts that share
``Winnow.guarantee`` consecutive code points share a fingerprint hash, and no shared run shorter than
``gram`` ever makes one. Texts with fewer hashes than a window have the smallest of those they have,
texts shorter than a gram the hash of their whole, and empty ones none.

Hashes of a gram of 2^n code points are put together from those of its halves, for all positions of
many texts at once; smallest hashes of windows likewise, by halves that overlap. Longer texts go in
stretches that overlap by a window, which chooses the same positions.

``chained`` fingerprints every document of a table, the document edited (its last quarter replaced by
the beginning of the next one), and compares both with the next document. Documents are sorted by
``doc_id`` once and streamed, so each meets its successor in its own task; only the first and last
document of each task's stretch are stored and joined afterwards.

Null texts are empty. The order is by ``doc_id``, null first, then by a hash of the text; equal rows follow each
other and have each other as successor. The only document of a table is its own successor. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, written

#: Odd multiplier of the rolling hash, and of its mixing.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93

#: Code points that are hashed at once.
STRETCH = 1 << 19

_ALL = (1 << 64) - 1


@dataclass(frozen=True)
class Winnow:
    """Code points of a gram, a power of two, and hashes of a window."""

    gram: int = 16
    window: int = 128

    def __post_init__(self):
        if self.gram < 1 or self.gram & (self.gram - 1) or self.window < 1:
            raise ValueError("a gram is a power of two, a window at least one hash")

    @property
    def guarantee(self) -> int:
        """Texts that share this many consecutive code points share a fingerprint hash."""
        return self.gram + self.window - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """The mixed hash of every run of ``gram`` code points, the first code point weighing most."""
    h, power, length = points.astype(np.uint64), BASE, 1
    while length < gram:
        h = h[:-length] * np.uint64(power) + h[length:]
        power, length = power * power & _ALL, 2 * length
    return mixed(h)


def whole_hash(points: np.ndarray) -> int:
    """The hash of a text shorter than a gram: the same polynomial over all of it."""
    h = 0
    for point in points.tolist():
        h = (h * BASE + point) & _ALL
    return int(mixed(np.array([h], dtype=np.uint64))[0])


def window_minima(h: np.ndarray, window: int) -> np.ndarray:
    """The position of the smallest of every ``window`` hashes, the rightmost of equal ones."""
    at, length = np.arange(len(h), dtype=np.int32), 1
    while length < window:
        step = min(length, window - length)
        left, right = h[: len(h) - step], h[step:]
        later = right <= left
        at = np.where(later, at[step:], at[: len(at) - step])
        h, length = np.where(later, right, left), length + step
    return at


Fingerprint = tuple[np.ndarray, np.ndarray]
_NOTHING: Fingerprint = (np.empty(0, np.uint64), np.empty(0, np.int64))


def fingerprints(texts: list[str], how: Winnow = Winnow()) -> list[Fingerprint]:
    """Hashes and positions of each text, in order of position; many short texts at a time."""
    found: list[Fingerprint] = [_NOTHING] * len(texts)
    batch: list[tuple[int, np.ndarray]] = []
    held = 0
    for i, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if len(points) < how.gram:
            if len(points):
                found[i] = (np.array([whole_hash(points)], np.uint64), np.zeros(1, np.int64))
        elif len(points) > STRETCH:
            found[i] = _long(points, how)
        else:
            batch.append((i, points))
            held += len(points)
            if held > STRETCH:
                _short(batch, found, how)
                batch, held = [], 0
    if batch:
        _short(batch, found, how)
    return found


def _short(batch: list[tuple[int, np.ndarray]], found: list[Fingerprint], how: Winnow) -> None:
    """Texts side by side, each in a place that no window of a neighbour reaches into."""
    n = np.array([len(p) - how.gram + 1 for _, p in batch])
    room = np.maximum(n, how.window)
    starts = np.cumsum(room) - room
    joined = np.concatenate([p for _, p in batch])
    grams = gram_hashes(joined, how.gram)
    ends = np.cumsum([len(p) for _, p in batch])
    h = np.full(int(room.sum()), _ALL, dtype=np.uint64)
    # the hashes that lie within one text, moved to its place
    own = np.repeat(ends - n - (how.gram - 1), n) + _ranges(n)
    h[np.repeat(starts, n) + _ranges(n)] = grams[own]
    least = window_minima(h, how.window)
    windows = np.maximum(n - how.window + 1, 1)
    chosen = least[np.repeat(starts, windows) + _ranges(windows)]
    text = np.repeat(np.arange(len(batch)), windows)
    # the padding of a short text may tie with its largest hash, but lies to the right of it
    last = starts[text] + n[text] - 1
    chosen = np.minimum(chosen, last)
    new = np.ones(len(chosen), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    chosen, text = chosen[new], text[new]
    cuts = np.searchsorted(text, np.arange(len(batch) + 1))
    for k, (i, _) in enumerate(batch):
        at = chosen[cuts[k] : cuts[k + 1]]
        found[i] = (h[at], at.astype(np.int64) - starts[k])


def _ranges(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, in a row."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _long(points: np.ndarray, how: Winnow) -> Fingerprint:
    hashes, places = [], []
    n = len(points) - how.gram + 1
    for low in range(0, max(1, n - how.window + 1), STRETCH):
        high = min(n, low + STRETCH + how.window - 1)
        h = gram_hashes(points[low : high + how.gram - 1], how.gram)
        at = np.unique(window_minima(h, min(how.window, len(h))))
        hashes.append(h[at])
        places.append(at.astype(np.int64) + low)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], place


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Shared over all distinct hashes; texts without any are alike."""
    x, y = np.unique(a[0]), np.unique(b[0])
    both = len(np.intersect1d(x, y, assume_unique=True))
    either = len(x) + len(y) - both
    return both / either if either else 1.0


def written_out(found: Fingerprint) -> str:
    """``hash:position`` in order of position, hashes as 16 hexadecimal digits."""
    return ",".join([f"{h:016x}:{p}" for h, p in zip(found[0].tolist(), found[1].tolist(), strict=True)])


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


#: A document as it is stored: its fingerprint, and of its edited text's only what differs after the
#: first ``shared`` entries, in columns that take a third of the texts written out.
_STORED = {
    "doc_id": (T.LongType(), pa.int64()),
    "n_chars": (T.LongType(), pa.int64()),
    "edited_digest": (T.BinaryType(), pa.binary()),
    "hashes": (T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    "places": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "shared": (T.IntegerType(), pa.int32()),
    "new_hashes": (T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    "new_places": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "near_edited": (T.DoubleType(), pa.float64()),
    "near_next": (T.DoubleType(), pa.float64()),
}
STORED = T.StructType([T.StructField(name, kind) for name, (kind, _) in _STORED.items()])
_ARROW = pa.schema([(name, kind) for name, (_, kind) in _STORED.items()])


def _rows(ids: list, texts: list[str], after: list[str], own: list[Fingerprint], then: list[Fingerprint], how: Winnow) -> list[tuple]:
    changed = [edited(a, b) for a, b in zip(texts, after, strict=True)]
    rows = []
    for i, text, new, mine, other, next_one in zip(ids, texts, changed, own, fingerprints(changed, how), then, strict=True):
        most = min(len(mine[0]), len(other[0]))
        differ = np.flatnonzero((mine[0][:most] != other[0][:most]) | (mine[1][:most] != other[1][:most]))
        shared = int(differ[0]) if len(differ) else most
        sha = hashlib.sha256(new.encode()).digest()
        new_ones = other[0][shared:].view(np.int64), other[1][shared:]
        near = likeness(mine, other), likeness(mine, next_one)
        rows.append((i, len(text), sha, mine[0].view(np.int64), mine[1], shared, *new_ones, *near))
    return rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _shown(hashes: Column, places: Column) -> Column:
    """``written_out`` of stored columns."""
    pairs = F.transform(
        F.arrays_zip(hashes.alias("h"), places.alias("p")),
        lambda x: F.concat(F.lpad(F.lower(F.hex(x["h"])), 16, "0"), F.lit(":"), x["p"].cast("string")),
    )
    return F.array_join(pairs, ",")


def chained(docs: DataFrame, how: Winnow = Winnow()) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to it and to the
    next document's: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``."""
    part, end, text = f"{OWN}part", f"{OWN}end", f"{OWN}text"
    stored = T.StructType([*STORED.fields, T.StructField(part, T.IntegerType()), T.StructField(end, T.IntegerType()), T.StructField(text, T.StringType())])
    arrow = pa.schema([*_ARROW, (part, pa.int32()), (end, pa.int32()), (text, pa.string())])
    blank = [None] * (len(STORED) - 1)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its successor; first and last go on as they are, as ends 0 and 1."""
        here = TaskContext.get().partitionId()
        last = None
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                ids, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
                found = fingerprints(texts, how)
                ends = []
                if last is None:
                    ends = [(ids[0], *blank, here, 0, texts[0])]
                else:
                    ids, texts, found = [last[0], *ids], [last[1], *texts], [last[2], *found]
                last = (ids[-1], texts[-1], found[-1])
                rows = _rows(ids[:-1], texts[:-1], texts[1:], found[:-1], found[1:], how)
                yield _batch([*ends, *[(*row, None, None, None) for row in rows]], arrow)
        if last is not None:
            yield _batch([(last[0], *blank, here, 1, last[1])], arrow)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                ids, texts, after = (c.to_pylist() for c in batch.slice(low, 64).columns)
                yield _batch(_rows(ids, texts, after, fingerprints(texts, how), fingerprints(after, how), how), _ARROW)

    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # the row's own number keeps equal rows from falling into one range of the sort
    ranged = whole.withColumn(end, F.monotonically_increasing_id())
    order = ["doc_id", F.xxhash64("text"), "text", end]
    ranged = ranged.repartitionByRange("doc_id", F.xxhash64("text"), end).sortWithinPartitions(*order)
    found = written(ranged.select("doc_id", "text").mapInArrow(stream, stored), "winnowed")
    ends = found.where(F.col(end).isNotNull()).select("doc_id", part, end, text)
    # one number per task meets here, without texts
    firsts = ends.where(F.col(end) == 0).select(F.col(part).alias("p"))
    following = firsts.select("p", F.lead("p").over(Window.orderBy("p")).alias("q"))
    following = following.select("p", F.coalesce("q", F.min("p").over(Window.partitionBy())).alias("q"))
    heads = ends.where(F.col(end) == 0).select(F.col(part).alias("q"), F.col(text).alias("after"))
    last = ends.where(F.col(end) == 1).join(following, F.col(part) == F.col("p")).join(heads, "q")
    joined = last.select("doc_id", text, "after").mapInArrow(pairs, STORED)
    every = found.where(F.col(end).isNull()).select(*STORED.names).unionByName(joined)
    new = [F.concat(F.slice(a, F.lit(1), F.col("shared")), F.col(b)) for a, b in (("hashes", "new_hashes"), ("places", "new_places"))]
    return every.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_digest")).alias("edited_sha256"),
        _shown(F.col("hashes"), F.col("places")).alias("fingerprint"),
        _shown(*new).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
