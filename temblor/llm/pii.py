"""Personal data: base patterns plus identifiers found by bootstrapped contextual patterns.

Base matches are seeds. Every identifier-shaped token of the corpus, matched or not, is an instance
with up to three lexical patterns: the two words before it, the word before it, and the words on
both sides. Numeric tokens that follow each other with a single space, or a bracket and one, are one
instance in place of their tokens if together they fit a kind; of a run that fits none, the longest
stretches that do are taken from the left. Spark aggregates the bipartite graph of patterns and instances and scores it in rounds, until one finds no new instance:

* a pattern's confidence for a kind is the share of its distinct instances believed to be of that
  kind, shrunk by ``prior`` unseen instances; an instance not yet believed, whose shape would fit,
  speaks against the pattern with ``doubt``, any other with full weight;
* an instance not yet believed becomes of a kind when the best of its patterns reaches
  ``least_pattern`` and its shape fits the kind, and so is a seed of the next round.

A pattern counts only with ``least_instances`` distinct instances, so copies of one document prove
nothing. In the end occurrences of accepted patterns that fit the kind become spans of that kind
unless a base span overlaps them. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.frames import OWN, scratch, written

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # rank of the kind, start, end

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# From the first digit of a run only: what fails there fails behind it, and matches end with a run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# An identifier-shaped token is free of white space and has a digit or an at sign.
_SIGN = re.compile(r"[0-9@]")
_WHITE = re.compile(r"[\x20\x09-\x0D]")
_SPACES = frozenset(" \t\n\x0b\x0c\r")
_BLANKS = frozenset(" \t")
_WORD_AFTER = re.compile(r"[\x20\x09]+([^\x20\x09-\x0D]+)")
# What a number written in groups consists of, and what may stand between two of its tokens.
_GROUP = re.compile(r"\+?[0-9](?:[().-]{0,2}[0-9])*")
_BETWEEN = frozenset([" ", ") ", " (", ") ("])
_EDGES = ".,;:!?\"'()[]{}<>"
#: Words and values beyond this many characters stand in the graph by their digest.
_NAME_CHARS = 64


def _named(word: str) -> str:
    return word if len(word) <= _NAME_CHARS else "#" + hashlib.sha256(word.encode()).hexdigest()


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign leftwards, which gives the leftmost matches without rescanning runs."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; failing matches are dropped, without retries."""
    found: list[Span] = []
    if "@" in text:
        found += [(0, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def _fits(kind: int, value: str) -> bool:
    """Whether an unseen token could be an identifier of the kind."""
    digits = sum("0" <= c <= "9" for c in value)
    if kind == 0:
        return "@" in value and len(value) >= 5
    if kind == 1:
        return digits >= 4 and bool(re.fullmatch(r"[0-9a-fA-F.:]+", value)) and ("." in value or ":" in value)
    if kind == 2:
        return 12 <= digits <= 19 and bool(re.fullmatch(r"[0-9 -]+", value))
    return 7 <= digits <= 15 and bool(re.fullmatch(r"[0-9+().\x20-]+", value))


def _word_before(text: str, at: int) -> int | None:
    """Where the word begins that ends before the blanks left of ``at``; without blanks, none."""
    end = at
    while end > 0 and text[end - 1] in _BLANKS:
        end -= 1
    start = end
    while start > 0 and text[start - 1] not in _SPACES:
        start -= 1
    return start if start < end < at else None


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lower-cased lexical patterns around a stretch of text."""
    before: list[str] = []
    at = start
    while at > 0 and text[at - 1] in _EDGES:
        at -= 1
    for _ in range(2):
        word = _word_before(text, at)
        if word is None:
            break
        before.append(_named(text[word:at].rstrip(" \t").lower()))
        at = word
    after = _WORD_AFTER.match(text, end)
    out = []
    if before:
        out.append(f"1|{before[0]}")
        if len(before) == 2:
            out.append(f"2|{before[1]} {before[0]}")
        if after:
            out.append(f"3|{before[0]} _ {_named(after.group(1).lower())}")
    return out


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Identifier-shaped tokens, each from white space to white space."""
    end = 0
    while sign := _SIGN.search(text, end):
        start = sign.start()
        while start > end and text[start - 1] not in _SPACES:
            start -= 1
        white = _WHITE.search(text, sign.end())
        end = white.start() if white else len(text)
        yield start, end


def occurrences(text: str, base: list[Span]) -> list[tuple[int, int, int, str, list[str]]]:
    """(kind or -1, start, end, value, patterns) of every base match and other candidate token."""
    found = [(k, s, e, text[s:e], _patterns(text, s, e)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    starts, reach, ends = [], 0, []
    for s, e in taken:
        reach = max(reach, e)
        starts.append(s)
        ends.append(reach)
    tokens: list[tuple[int, int]] = []
    for start, end in _tokens(text):
        value = text[start:end].lstrip(_EDGES)
        start, value = end - len(value), value.rstrip(_EDGES)
        if not value:
            continue
        before = bisect_left(starts, start + len(value)) - 1
        if before >= 0 and ends[before] > start:
            continue
        tokens.append((start, start + len(value)))
    for start, end in _grouped(text, tokens):
        found.append((-1, start, end, text[start:end], _patterns(text, start, end)))
    return found


#: Most digits of an identifier that ``_fits`` a kind written in groups.
_GROUP_DIGITS = 19


def _grouped(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """``tokens`` with runs of numeric ones that together fit a kind as one."""
    i = 0
    while i < len(tokens):
        start, end = tokens[i]
        best, j = i, i
        if _GROUP.fullmatch(text, start, end):
            digits = sum("0" <= c <= "9" for c in text[start:end])
            while j + 1 < len(tokens) and text[end : tokens[j + 1][0]] in _BETWEEN and _GROUP.fullmatch(text, *tokens[j + 1]):
                j += 1
                digits += sum("0" <= c <= "9" for c in text[slice(*tokens[j])])
                if digits > _GROUP_DIGITS:
                    break
                end = tokens[j][1]
                if any(_fits(k, text[start:end]) for k in (2, 3)):
                    best = j
        yield start, tokens[best][1]
        i = best + 1


_OCCURRENCE = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("value", T.StringType()),
        T.StructField("fits", T.ArrayType(T.IntegerType())),
        T.StructField("patterns", T.ArrayType(T.StringType())),
    ]
)
SCANNED = T.ArrayType(_OCCURRENCE)


@F.arrow_udf(SCANNED)
def scanned(text: pa.Array) -> pa.Array:
    """Every base match and candidate of one text; null counts as empty."""
    out = []
    for t in text:
        t = t.as_py() or ""
        rows = []
        for k, s, e, value, patterns in occurrences(t, base_spans(t)):
            fits = [k] if k >= 0 else [j for j in range(4) if _fits(j, value)]
            rows.append({"kind": k, "start": s, "end": e, "value": _named(value), "fits": fits, "patterns": patterns})
        out.append(rows)
    item = pa.struct(
        [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("fits", pa.list_(pa.int32())), ("patterns", pa.list_(pa.string()))]
    )
    return pa.array(out, type=pa.list_(item))


@dataclass(frozen=True)
class Bootstrap:
    """What a pattern needs to be trusted."""

    least_pattern: float = 0.8
    least_instances: int = 5
    prior: float = 1.0
    doubt: float = 0.5


def learn_patterns(found: DataFrame, boot: Bootstrap = Bootstrap()) -> DataFrame:
    """``pattern``, ``kind`` of the trusted patterns, from occurrences with a struct column ``o``.

    The graph has one row per distinct pattern and instance, made by partial aggregation, so copies
    of a document or a very common word add counts, not rows. Rounds go on until one finds no new
    instance; every other one believes an instance more, so they end. Each is written to the shared
    folder; joins of its stored tables can be split by Spark where a key is hot.
    """
    edges = written(
        found.where(F.size("o.fits") > 0)
        .select(F.explode("o.patterns").alias("pattern"), F.col("o.value").alias("value"), F.col("o.kind").alias("kind"), F.col("o.fits").alias("fits"))
        .groupBy("pattern", "value")
        .agg(F.max("kind").alias("kind"), F.max("fits").alias("fits")),
        "pii-edges",
    )
    others = found.where(F.size("o.fits") == 0).select(F.explode("o.patterns").alias("pattern"), F.col("o.value").alias("value")).distinct()
    noise = others.groupBy("pattern").agg(F.count(F.lit(1)).alias("noise"))
    noise = written(noise, "pii-noise")
    believed = edges.select("pattern", "value", "kind", "fits")
    while True:
        scores = (
            believed.groupBy("pattern")
            .agg(*[F.sum((F.col("kind") == k).cast("long")).alias(f"k{k}") for k in range(4)], F.sum(F.when(F.col("kind") >= 0, 1.0).otherwise(boot.doubt)).alias("n"))
            .join(noise, "pattern", "left")
        )
        best = F.greatest(*[F.col(f"k{k}") for k in range(4)])
        kind = F.lit(0)
        for k in (3, 2, 1, 0):
            kind = F.when(F.col(f"k{k}") == best, F.lit(k)).otherwise(kind)
        score = best / (F.col("n") + F.coalesce("noise", F.lit(0)) + boot.prior)
        trusted = written(
            scores.where((best >= boot.least_instances) & (score >= boot.least_pattern))
            .select("pattern", kind.cast("int").alias("kind"), score.alias("score")),
            "pii-patterns",
        )
        unseen = believed.where("kind = -1").alias("e")
        new = (
            unseen.join(trusted.alias("t"), F.expr("e.pattern = t.pattern AND array_contains(e.fits, t.kind)"))
            .groupBy("e.value")
            .agg(F.max(F.struct("t.score", (-F.col("t.kind")).alias("k"))).alias("b"))
            .select("value", (-F.col("b.k")).alias("found"))
        )
        new = written(new, "pii-instances")
        if new.isEmpty():
            return trusted
        believed = written(
            believed.join(new, "value", "left").select(
                "pattern", "value", F.when(F.col("kind") == -1, F.coalesce("found", "kind")).otherwise(F.col("kind")).alias("kind"), "fits"
            ),
            "pii-believed",
        )


def discovered(found: DataFrame, trusted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``more``: (kind, start, end) of occurrences that a trusted pattern claims."""
    loose = found.where((F.col("o.kind") == -1) & (F.size("o.fits") > 0)).select(
        *keys, F.col("o.start").alias("start"), F.col("o.end").alias("end"), F.col("o.fits").alias("fits"), F.explode("o.patterns").alias("pattern")
    )
    hit = loose.alias("e").join(trusted.alias("t"), F.expr("e.pattern = t.pattern AND array_contains(e.fits, t.kind)"))
    one = hit.groupBy(*keys, "start", "end").agg(F.max(F.struct("t.score", (-F.col("t.kind")).alias("k"))).alias("b"))
    span = F.struct((-F.col("b.k")).cast("int").alias("kind"), "start", "end")
    return one.groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("more"))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


FOUND = T.StructType(
    [
        *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)
_SPANS = "array<struct<kind:int,start:int,end:int>>"


@F.arrow_udf(FOUND)
def _digest(base: pa.Array, more: pa.Array) -> pa.Array:
    rows = []
    for own, extra in zip(base.to_pylist(), more.to_pylist(), strict=True):
        own = sorted((s["kind"], s["start"], s["end"]) for s in own or ())
        both = sorted({*own, *((s["kind"], s["start"], s["end"]) for s in extra or ())})
        row = {f"n_{k}": sum(s[0] == i for s in own) for i, k in enumerate(KINDS)}
        rows.append(row | {"base_sha256": hashlib.sha256(joined(own).encode()).hexdigest(), "spans": joined(both)})
    return pa.array(rows, type=pa.struct([*[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())]))


def with_spans(docs: DataFrame, boot: Bootstrap = Bootstrap(), id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """A stored table of ``doc_id``, a content hash, base spans and occurrences; and what was
    discovered, by both keys. Repeated rows share their keys and so their discoveries."""
    key, content = f"{OWN}id", f"{OWN}content"
    rows = written(
        docs.select(F.col(id_column).alias(key), F.xxhash64("text").alias(content), scanned(F.col("text")).alias("found")),
        "pii-scanned",
    )
    found = rows.where(F.size("found") > 0).select(key, content, F.explode("found").alias("o"))
    trusted = learn_patterns(found, boot)
    return rows, discovered(found, trusted, [key, content])


def same_document(left: DataFrame, right: DataFrame):
    """Join condition on both keys; a null id equals a null id."""
    key, content = f"{OWN}id", f"{OWN}content"
    return left[key].eqNullSafe(right[key]) & (left[content] == right[content])


def scan(docs: DataFrame, boot: Bootstrap = Bootstrap()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts and digest of base spans, all spans.

    Null and empty texts have no spans. Offsets are code points, ends exclusive. An empty table
    gives an empty result. Only ``doc_id`` and ``text`` are read.
    """
    with scratch(docs.sparkSession) as result:
        rows, extra = with_spans(docs, boot)
        base = F.filter("found", lambda o: o["kind"] >= 0)
        base = F.transform(base, lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")))
        slim = rows.select(f"{OWN}id", f"{OWN}content", base.cast(_SPANS).alias("base"))
        extra = extra.withColumn("more", F.col("more").cast(_SPANS))
        both = slim.join(extra, same_document(slim, extra), "left").select(slim[f"{OWN}id"].alias("doc_id"), "base", "more")
        return result(both.select("doc_id", _digest("base", "more").alias("f")).select("doc_id", "f.*"), "pii")


def redacted_text(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlaps merge into one."""
    out, at, open_end = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start < open_end:
            open_end = max(open_end, end)
            at = max(at, open_end)
            continue
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = open_end = end
    return "".join([*out, text[at:]])


@F.arrow_udf(T.StringType())
def _redact(text: pa.Array, more: pa.Array) -> pa.Array:
    out = []
    for t, extra in zip(text, more.to_pylist(), strict=True):
        t = t.as_py()
        if t is not None:
            t = redacted_text(t, base_spans(t) + [(s["kind"], s["start"], s["end"]) for s in extra or ()])
        out.append(t)
    return pa.array(out, pa.string())


def redact(docs: DataFrame, boot: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` with its columns, personal data in ``text`` replaced by ``<KIND>``.

    No row goes. Only documents with a discovered span are joined; the others are redacted where
    they lie. A null text stays null.
    """
    rows, extra = with_spans(docs, boot)
    extra = written(extra.withColumn("more", F.col("more").cast(_SPANS)), "pii-discovered")
    key, content = f"{OWN}id", f"{OWN}content"
    keyed = docs.withColumns({key: F.col("doc_id"), content: F.xxhash64("text")})
    if extra.isEmpty():
        return docs.withColumn("text", _redact("text", F.lit(None).cast(_SPANS)))
    joined_docs = keyed.join(extra, same_document(keyed, extra), "left")
    columns = [keyed[c] if c != "text" else _redact(keyed["text"], F.col("more")).alias("text") for c in docs.columns]
    return joined_docs.select(*columns)
