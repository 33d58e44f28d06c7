"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is three records: the request, the response (or a revisit of an earlier, identical
payload) and a metadata record, tied by ``WARC-Concurrent-To``. Archives are gzipped WARC 1.1
files. Spark's text writer makes them, since a record ends with two line ends as a line of text
ends with one, so they go to any file system that Spark writes to, with its commit protocol.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, group_value, remove, scratch, written
from temblor.lineage import scratch_path

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line ends in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    size = F.octet_length(block).cast("string")
    lines = [F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), *[_line(n, v) for n, v in fields]]
    return F.concat(*lines, _line("Content-Length", size), F.lit("\r\n"), block)


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base 32 of 40 hexadecimal digits: five of them make four."""
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``html`` (null: empty) with ``digest`` and ``refers_to``.

    Of pages with equal payloads of at least ``least_bytes``, the smallest ``page_id`` is the
    response and ``refers_to`` is null; the others refer to it. Only ids and digests are grouped, a
    hot digest in sub-groups; payloads move once, to meet the decisions. Repeated rows of a page
    with equal payload get the same decision. A null ``page_id`` is larger than any other, so it
    revisits the page with the smallest id, and is a response where there is none.
    """
    plain = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keys = plain.select(
        "page_id", F.sha1(F.col("html").cast("binary")).alias("hex"), F.octet_length("html").alias("size")
    )
    keys = written(keys.distinct(), "warc-digests")
    first = group_value(keys, ["hex"], F.col("page_id"), F.min, "page_id", "first")
    decided = first.select(
        F.col("page_id").alias(f"{OWN}id"),
        F.col("hex").alias(f"{OWN}hex"),
        F.when((F.col("size") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )
    decided = written(decided, "warc-decisions")
    hexed = plain.withColumn("hex", F.sha1(F.col("html").cast("binary")))
    joined = hexed.join(
        decided, hexed["page_id"].eqNullSafe(decided[f"{OWN}id"]) & (hexed["hex"] == decided[f"{OWN}hex"])
    )
    return joined.select("page_id", "url", "html", base32_of_hex(F.col("hex")).alias("digest"), "refers_to")


def write_archives(
    pages: DataFrame, path: str, captures_per_file: int = 10_000, date: str = "2025-01-01T00:00:00Z"
) -> None:
    """Write a capture of each row of ``page_id, url, html, digest, refers_to`` to ``path``."""
    ids = pages.withColumn(f"{OWN}uuid", F.uuid())
    response = F.concat(F.lit("<urn:uuid:"), F.col(f"{OWN}uuid"), F.lit(">"))
    own = lambda part: F.concat(F.lit(f"<urn:temblor:{part}:"), F.col(f"{OWN}uuid"), F.lit(">"))
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    concurrent = ("WARC-Concurrent-To", response)
    host = F.coalesce(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#\r\n]*)", 1), F.lit(""))
    target = F.coalesce(F.regexp_replace("url", r"^[a-zA-Z]+://[^/?#]*|[\r\n]|#.*$", ""), F.lit(""))
    request = F.concat(
        F.lit("GET "), F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target)),
        F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END),
    )
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"), F.lit(END),
    )
    answer = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("html")))
    fields = F.concat(
        _line("pageId", F.col("page_id").cast("string")), _line("refersToPage", F.col("refers_to").cast("string"))
    )
    records = F.array(
        _record(F.lit("request"), [("WARC-Record-ID", own("request")), *common, concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))], request),
        _record(
            F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
            [
                ("WARC-Record-ID", response), *common,
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                ("WARC-Profile", F.when(is_revisit, F.lit(PROFILE))),
                ("Content-Type", F.lit("application/http; msgtype=response")),
            ],
            answer,
        ),
        _record(F.lit("metadata"), [("WARC-Record-ID", own("metadata")), *common, concurrent, ("Content-Type", F.lit("application/warc-fields"))], fields),
    )
    lines = ids.select("url", "page_id", "html", "digest", "refers_to", f"{OWN}uuid").select(F.explode(records).alias("value"))
    (
        lines.write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * captures_per_file)
        .text(path)
    )


RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)
_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.list_(pa.string())),
        ("target_uri", pa.string()), ("date", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
        ("fields", pa.map_(pa.string(), pa.string())),
    ]
)


class ArchiveError(ValueError):
    """A file that is not a sequence of whole WARC records."""


class _Stream:
    """Bytes of one archive, inflated piece by piece; gzip members may follow one another."""

    def __init__(self, data: bytes):
        self._data = memoryview(data)
        self._gzip = bytes(data[:2]) == b"\x1f\x8b"
        self._at, self._held, self._inflate = 0, bytearray(), None

    def _more(self) -> bool:
        piece = self._data[self._at : self._at + (1 << 18)]
        if not self._gzip:
            self._at += len(piece)
            self._held += piece
            return bool(piece)
        if self._inflate is None:
            if not piece:
                return False
            self._inflate = zlib.decompressobj(31)
        self._held += self._inflate.decompress(piece)
        self._at += len(piece)
        if self._inflate.eof:
            self._at -= len(self._inflate.unused_data)
            self._inflate = None
        elif not piece:
            raise ArchiveError("the archive ends inside a gzip member")
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        start = 0
        while (end := self._held.find(b"\n", start)) < 0:
            start = len(self._held)
            if not self._more():
                if self._held.strip():
                    raise ArchiveError("the archive ends inside a header")
                return None
        found = bytes(self._held[:end]).removesuffix(b"\r")
        del self._held[: end + 1]
        return found

    def take(self, size: int) -> bytes:
        while len(self._held) < size:
            if not self._more():
                raise ArchiveError("the archive ends inside a record")
        found = bytes(self._held[:size])
        del self._held[:size]
        return found


def _headers(lines: Iterator[bytes]) -> list[tuple[str, str]]:
    found: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in b" \t" and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.decode('utf-8', 'replace').strip()}")
        else:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def _http(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return _headers(iter(head.split(b"\r\n")[1:])), body


def parse_records(data: bytes, payloads: bool = True) -> Iterator[dict]:
    """The records of one archive in order. A revisit's payload size is that of its HTTP header."""
    stream = _Stream(data)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no WARC record starts with {line[:40]!r}")
        lines = []
        while line := stream.line():
            lines.append(line)
        headers = _headers(iter(lines))
        first = {name: value for name, value in reversed(headers)}
        block = stream.take(int(first.get("content-length", 0)))
        kind, body, http, fields = first.get("warc-type"), block, {}, []
        if first.get("content-type", "").startswith("application/http"):
            pairs, body = _http(block)
            http = dict(pairs)
        elif first.get("content-type", "").startswith("application/warc-fields"):
            fields = _headers(x for x in block.split(b"\r\n") if x)
        digest = first.get("warc-payload-digest", "").partition(":")[2] or None
        if kind != "revisit":
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        stated = http.get("content-length", "")
        size = int(stated if stated.isdigit() else 0) if kind == "revisit" else len(body)
        yield {
            "record_id": first.get("warc-record-id"),
            "record_type": kind,
            "concurrent_to": [value for name, value in headers if name == "warc-concurrent-to"],
            "target_uri": first.get("warc-target-uri"),
            "date": first.get("warc-date"),
            "headers": list(first.items()),
            "payload_bytes": size,
            "payload_digest": digest,
            "payload": body if payloads else None,
            "fields": list(dict(fields).items()),
        }


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives below ``path``. Without ``payloads`` only their size and digest
    leave the reading task, which inflates a file piece by piece and holds one record at a time."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in incoming:
            for content in batch.column("content"):
                for record in parse_records(content.as_py(), payloads):
                    held.append(record)
                    size += 1000 + len(record["payload"] or b"")
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request``, ``metadata`` and how
    many records of the latter two there were (of several, the smallest record id is taken).

    A request or metadata record belongs to the record its first ``WARC-Concurrent-To`` names. An
    identifier may point the other way: a response that names its request claims it. Records that
    name nobody and that nobody names are captures of their own. ``response`` holds responses and
    revisits. Only mergeable aggregates are used, so a capture id that many records name is
    combined before the shuffle.
    """
    answers = F.col("record_type").isin("response", "revisit")
    names = F.coalesce(F.get("concurrent_to", F.lit(0)), F.lit(None).cast("string"))
    claims = (
        records.where(answers)
        .select(F.explode("concurrent_to").alias(f"{OWN}claimed"), F.col("record_id").alias(f"{OWN}by"))
        .groupBy(f"{OWN}claimed")
        .agg(F.min(f"{OWN}by").alias(f"{OWN}by"))
    )
    kept = records.withColumn(f"{OWN}names", names)
    claimed = kept.join(claims, ~answers & kept["record_id"].eqNullSafe(claims[f"{OWN}claimed"]), "left")
    key = F.when(answers, F.col("record_id")).otherwise(F.coalesce(F.col(f"{OWN}by"), F.col(f"{OWN}names"), F.col("record_id")))
    body = F.struct(*[F.col(f.name) for f in RECORDS if f.name not in ("headers", "fields", "record_type", "concurrent_to")],
                    "record_type", F.to_json("fields").alias("fields"))
    is_type = lambda name: F.col("record_type") == name
    return (
        claimed.select(key.alias("capture_id"), "record_type", body.alias("body"))
        .groupBy("capture_id")
        .agg(
            F.min(F.when(answers, F.col("body"))).alias("response"),
            F.min(F.when(is_type("request"), F.col("body"))).alias("request"),
            F.min(F.when(is_type("metadata"), F.col("body"))).alias("metadata"),
            F.count(F.when(is_type("request"), 1)).alias("n_requests"),
            F.count(F.when(is_type("metadata"), 1)).alias("n_metadata"),
        )
    )


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write a capture of every page, read the archives back, and return a row per capture."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    with scratch(spark) as result:
        write_archives(with_revisits(pages, least_bytes), path)
        captures = assemble(read_records(spark, path, payloads=False))
        fields = F.from_json(F.col("metadata.fields"), "map<string,string>")
        out = captures.where(F.col("response").isNotNull()).select(
            fields["pageid"].cast("long").alias("page_id"),
            F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
            F.col("response.record_type").alias("record_type"),
            fields["referstopage"].cast("long").alias("refers_to"),
            F.col("response.target_uri").alias("url"),
        )
        out = result(out, "warc-captures")
    remove(spark, path)
    return out
