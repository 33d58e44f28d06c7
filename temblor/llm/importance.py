"""Importance resampling towards a target distribution of hashed word runs.

Features of a text are its runs of one to three words, each hashed to one of ``BUCKETS`` by the CRC-32
of its UTF-8 bytes. A bucket's gain is the logarithm, in thousandths, of how much more frequent it is
in the target texts than in the corpus; a document's weight is the sum over its features. Adding
Gumbel noise drawn from the document's id and keeping the highest scores draws documents without
replacement in proportion to the exponential of their weights.

Checksums are computed for many features at once. The distinct features of a stretch of words are
grouped by length; each length is a two-dimensional array of bytes with one row per feature, whose
checksums advance column by column through the byte table; the results are scattered back to every
occurrence. A length that only a few features have goes feature by feature, since columns of a few
rows cost more than the rows do; both ways give the same number.

Two passes read the texts, one for the corpus' counts, one for the weights; only counts per bucket
and one narrow row per document travel.

Words are maximal runs of bytes that are ASCII digits or letters or not ASCII, after lower-casing
A-Z. A null or empty text, or one without words, has no features and weight 0. Repeated rows count
as often as they occur and are drawn one by one. A document without ``doc_id`` has no noise: its score
is null and it is never drawn, though it counts among the documents. Of equal scores the smaller
``doc_id`` goes first. An empty target leaves the gains to the corpus alone; an empty corpus gives an
empty result. Columns other than ``doc_id`` and the texts are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, numbered, scratch, written

BUCKETS = 10_000
LONGEST = 3

#: Words whose features are hashed at once, and text bytes taken out of a batch at once.
STRETCH = 1 << 18
PART = 1 << 22

#: Cells of one byte matrix at most, and features of a length that are worth one.
CELLS = 1 << 22
FEW = 16


def crc_table() -> np.ndarray:
    """What one byte does to the checksum, for the reflected polynomial of CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = crc_table()


def word_bytes() -> np.ndarray:
    """For each byte what it becomes, 0 for those between words."""
    bytes_ = np.arange(256, dtype=np.uint8)
    upper = (bytes_ >= ord("A")) & (bytes_ <= ord("Z"))
    lower = np.where(upper, bytes_ + 32, bytes_)
    digit = (lower >= ord("0")) & (lower <= ord("9"))
    letter = (lower >= ord("a")) & (lower <= ord("z"))
    return np.where(digit | letter | (lower >= 0x80), lower, 0).astype(np.uint8)


_WORD = word_bytes()


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each stretch of ``data``, by one matrix of bytes per length."""
    found = np.empty(len(starts), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for same in np.split(order, cuts) if len(order) else ():
        length = int(lengths[same[0]])
        if len(same) < FEW:
            for i in same:
                found[i] = zlib.crc32(data[starts[i] : starts[i] + length])
            continue
        for low in range(0, len(same), max(FEW, CELLS // length)):
            some = same[low : low + max(FEW, CELLS // length)]
            matrix = data[starts[some] + np.arange(length)[:, None]]
            crc = np.full(len(some), 0xFFFFFFFF, dtype=np.uint32)
            for column in matrix:
                crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
            found[some] = ~crc
    return found


class Words:
    """The words of some texts, joined by single spaces, and which text each is of."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, raw = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        sizes = np.diff(offsets)
        raw = np.frombuffer(raw or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        lower = _WORD[raw]
        inside = lower != 0
        text_starts = np.cumsum(sizes) - sizes
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        cut = text_starts[sizes > 0]
        opens[cut] = inside[cut]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | opens[1:]
        begins = np.flatnonzero(opens)
        self.lengths = np.flatnonzero(closes) + 1 - begins
        self.text = np.searchsorted(text_starts + sizes, begins, side="right")
        self.bytes = lower[inside]
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.data = np.full(len(self.bytes) + len(begins), 0x20, dtype=np.uint8)
        self.data[np.arange(len(self.bytes)) + np.repeat(np.arange(len(begins)), self.lengths)] = self.bytes
        self.count = np.bincount(self.text, minlength=len(sizes))

    def buckets(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Stretch by stretch, the bucket and the text of every feature."""
        total = len(self.starts)
        ends = np.cumsum(self.lengths)
        for low in range(0, total, STRETCH):
            high = min(total, low + STRETCH + LONGEST - 1)
            begin = ends[low] - self.lengths[low]
            offsets = np.concatenate([[0], ends[low:high] - begin]).astype(np.int64)
            words = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                high - low,
                [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.bytes[begin : begin + offsets[-1]]))],
            ).dictionary_encode()
            ids = words.indices.to_numpy().astype(np.int64)
            many = len(words.dictionary)
            starts, lengths, text = self.starts[low:high], self.lengths[low:high], self.text[low:high]
            run = ids
            for n in range(1, LONGEST + 1):
                first = np.arange(min(STRETCH, len(ids) - n + 1, total - low))
                if not len(first):
                    break
                if n > 1:
                    # a run of n words is one of n - 1, by its number, and a word
                    run = run[: len(ids) - n + 1] * many + ids[n - 1 :]
                    coded = pa.array(run).dictionary_encode()
                    run, distinct = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
                else:
                    distinct = many
                whole = first[text[first] == text[first + n - 1]]
                at = np.full(distinct, -1, dtype=np.int64)
                at[run[whole]] = whole
                used = np.flatnonzero(at >= 0)
                at = at[used]
                crc = checksums(self.data, starts[at], starts[at + n - 1] + lengths[at + n - 1] - starts[at])
                hashed = np.empty(distinct, dtype=np.int64)
                hashed[used] = crc % BUCKETS
                yield hashed[run[whole]], text[whole]


def parts(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in consecutive slices of about ``PART`` bytes, or of one longer text."""
    texts = texts.cast(pa.large_string())
    sizes = np.cumsum(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    low, base = 0, 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(sizes, base + PART, side="right")))
        yield texts.slice(low, high - low)
        low, base = high, int(sizes[high - 1])


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``bucket`` and ``n``, how often features of the whole table fall into it; empty ones are left
    out. A task gives at most ``BUCKETS`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in parts(batch.column(0)):
                for buckets, _ in Words(part).buckets():
                    total += np.bincount(buckets, minlength=BUCKETS)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    counted = texts.select(text).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> list[int]:
    """The gain of every bucket, from the ``bucket_counts`` of both sides."""
    own, other = corpus.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    spark = corpus.sparkSession
    both = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(own, "bucket", "left").join(other, "bucket", "left")
    both = both.fillna(0, ["s", "t"])
    # BUCKETS rows, so one task may hold them
    sums = both.agg(F.sum("s").alias("sums"), F.sum("t").alias("sumt"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    big_s, big_t = F.col("sums").cast("double"), F.col("sumt").cast("double")
    ratio = ((t + 1) * (big_s + BUCKETS)) / ((s + 1) * (big_t + BUCKETS))
    rows = both.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()
    return [row["gain"] for row in sorted(rows)]


def weighted(docs: DataFrame, gain: list[int]) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every document."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    )
    table = np.array(gain, dtype=np.float64)  # sums stay exact below 2^53

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in parts(batch.column(1)):
                words = Words(part)
                weight, n = np.zeros(len(part)), np.zeros(len(part), dtype=np.int64)
                for buckets, text in words.buckets():
                    weight += np.bincount(text, weights=table[buckets], minlength=len(part))
                    n += np.bincount(text, minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(words.count), pa.array(n), pa.array(weight.astype(np.int64))],
                    names=schema.names,
                )
                at += len(part)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weigh, schema)


def noise(seed: int = 42) -> F.Column:
    """A document's Gumbel noise in thousandths, rounded down, from a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """All documents with ``n_features``, ``weight``, ``score``, and the ``rank`` of those drawn.

    Of the documents of at least ``least_words`` words, ``percent`` in a hundred are drawn, rounded
    down. Ranks come from a distributed sort of the narrow rows, numbered where they lie.
    """
    at, fit = f"{OWN}at", f"{OWN}fit"
    with scratch(docs.sparkSession) as result:
        gain = gains(bucket_counts(docs), bucket_counts(target))
        rows = weighted(docs, gain).withColumn("score", F.col("weight") + noise(seed))
        rows = rows.withColumn(fit, F.col("n_words") >= least_words).drop("n_words")
        # the row's own number keeps equal rows from falling into one range of the sort
        rows = written(rows.withColumn(at, F.monotonically_increasing_id()), "weighted")
        order = [F.col(fit).desc(), F.col("score").desc_nulls_last(), F.col("doc_id"), F.col(at)]
        ranked = numbered(written(rows.orderBy(*order).drop(at), "by-score"), at)
        drawn = rows.where(fit).count() * percent // 100
        rank = F.when(F.col(fit) & F.col("score").isNotNull() & (F.col(at) < drawn), F.col(at) + 1)
        return result(ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank")), "drawn")
