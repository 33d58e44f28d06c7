"""Token counts of documents in flat token files without an index, by a scan for separators.

A token file is nothing but little-endian token ids, documents ended by one end-of-document id.
The scan deals fixed-size blocks of the files to tasks, whatever documents cross their borders;
each block is searched as one vector, and gives the places of its separators and nothing else. A
prefix scan over the blocks of a file then stitches: the running number of separators numbers the
documents, the running largest place says where the document began that a block ends first.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from temblor.lineage import scratch_path
from temblor.llm.frames import remove, scratch, written
from temblor.llm.tokens import encoding, vocabulary_path

#: The end-of-document id of the vocabulary; its text never gives it, being plain text there.
SEPARATOR = 49407


def _file_system(uri: str):
    """The Arrow file system of a URI or plain path, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + os.path.abspath(uri)
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write_token_files(
    docs: DataFrame, folder: str, separator: int = SEPARATOR, dtype: str = "<u2", path: str | None = None, file_bytes: int = 256 << 20
) -> DataFrame:
    """Write all documents' ids to flat files in ``folder``; give ``file``, ``ordinal``, ``doc_id``.

    Every task writes files of its own under names of their own, so a task that runs twice leaves
    files that no row names, and those do not count. A null or empty text is a separator alone.
    """
    path = path or vocabulary_path()
    end = narrowed(np.array([separator], dtype="<u4").tobytes(), dtype)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, ordinal = None, None, 0
        with encoding(path) as encode:
            try:
                for whole in incoming:
                    for at in range(0, whole.num_rows, 500):
                        batch = whole.slice(at, 500)
                        files, ordinals = [], []
                        for ids in encode.ids(batch.column("text").to_pylist()):
                            if out is None or out.tell() >= file_bytes:
                                if out is not None:
                                    out.close()
                                name, ordinal = f"{uuid.uuid4().hex}.bin", 0
                                out = system.open_output_stream(f"{base}/{name}")
                            out.write(narrowed(ids, dtype) + end)
                            files.append(name)
                            ordinals.append(ordinal)
                            ordinal += 1
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(files, pa.string()), pa.array(ordinals, pa.int64()), batch.column("doc_id").cast(pa.int64())], names=["file", "ordinal", "doc_id"]
                        )
            finally:
                if out is not None:
                    out.close()

    return docs.select("doc_id", "text").mapInArrow(run, "file string, ordinal long, doc_id long")


def narrowed(ids: bytes, dtype: str) -> bytes:
    """Unsigned 32-bit ids as ``dtype``; an id it has no room for fails the task."""
    wide = np.frombuffer(ids, dtype="<u4")
    if len(wide) and int(wide.max()) > np.iinfo(dtype).max:
        raise ValueError(f"id {wide.max()} does not fit {dtype}; choose a wider dtype for this vocabulary")
    return wide.astype(dtype).tobytes()


def separators(data: bytes, separator: int, dtype: str) -> np.ndarray:
    """The places of the separator in a block of ids."""
    return np.flatnonzero(np.frombuffer(data, dtype=dtype) == separator)


def scan(spark: SparkSession, folder: str, separator: int = SEPARATOR, dtype: str = "<u2", block_bytes: int = 8 << 20) -> DataFrame:
    """``file``, ``ordinal``, ``start``, ``n_tokens``, ``ended`` of every document in the files.

    Places are in tokens from the beginning of the file. What follows the last separator is a
    document too, with ``ended`` false, if it has a token. An empty file has no document.
    """
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    blocks = files.where("length > 0").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes))).alias("block")
    )
    dealt = blocks.repartition(max(1, 4 * spark.sparkContext.defaultParallelism), "path", "block")

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for row in batch.to_pylist():
                system, path = _file_system(row["path"])
                offset = row["block"] * block_bytes
                with system.open_input_file(path) as source:
                    data = source.read_at(min(block_bytes, row["length"] - offset), offset)
                places = separators(data, separator, dtype) + offset // width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]]), pa.array([row["block"]], pa.int64()),
                        pa.array([(offset + len(data)) // width], pa.int64()), pa.array([places.tolist()], pa.list_(pa.int64())),
                    ],
                    names=["path", "block", "end", "places"],
                )

    found = written(dealt.mapInArrow(run, "path string, block long, end long, places array<long>"), "separators")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Prefix scan over one narrow row per block: documents ended so far, and where the open one began.
    scanned = found.select("path", "block", F.size("places").alias("n"), F.array_max("places").alias("last")).select(
        "path", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("done"),
        F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("open"),
    )
    stitched = found.join(scanned, ["path", "block"])
    file = F.element_at(F.split("path", "/"), -1).alias("file")
    starts = F.slice(F.concat(F.array("open"), F.transform("places", lambda p: p + 1)), F.lit(1), F.size("places"))
    spans = F.posexplode(F.arrays_zip(starts.alias("start"), F.col("places").alias("place"))).alias("k", "span")
    length = F.col("span.place") - F.col("span.start")
    ended = stitched.select(file, "done", spans).select(
        "file", (F.col("done") + F.col("k")).alias("ordinal"), F.col("span.start").alias("start"), length.alias("n_tokens"), F.lit(True).alias("ended")
    )
    whole = found.groupBy("path").agg(
        F.sum(F.size("places")).cast("long").alias("ordinal"), F.coalesce(F.max(F.array_max("places")) + 1, F.lit(0)).alias("start"), F.max("end").alias("end")
    )
    rest = whole.where("end > start").select(file, "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.union(rest)


def token_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row, counted in the token files that are written of them."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    with scratch(spark) as result:
        order = written(write_token_files(docs, folder), "token-files")
        if order.isEmpty():
            return result(order.selectExpr("doc_id", "ordinal AS n_tokens", "ordinal AS start"), "token-counts")
        out = order.join(scan(spark, folder), ["file", "ordinal"]).select("doc_id", "n_tokens", "start")
        out = result(out, "token-counts")
    remove(spark, folder)
    return out
