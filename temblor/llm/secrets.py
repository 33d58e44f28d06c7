"""Secrets in source, configuration and prose: base patterns plus an assignment-aware lexer.

The lexer finds name-literal pairs around assignment signs (``name = "x"``, ``"name": 'x'``,
``NAME=x``, ``name => x``): quoted literals with their escapes and prefix letters, triple-quoted ones,
several in a row or joined by a plus sign, in brackets on the next line, indented blocks after ``|``
or ``>``, bare values, names of dotted or bracketed targets, and names that one attribute of a tag
gives for the value in another. A bare value that is itself a name assigned a literal elsewhere in the text
stands for that literal (constant propagation, through chains), so the literal is judged by every
name it reaches. A literal is scored by the most sensitive of these names and by how random it
looks; at ``least_score`` or more it becomes a span of kind ``literal``, unless a base span
overlaps it: those always stay as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Span = tuple[int, str, int, int]  # rank of the kind, kind, start, end

KINDS = ("assign", "access", "hex", "literal")

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TARGETS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_SIGN = re.compile(r":=|=>|===?|[:=]")
# A bare value ends before an assignment sign; only padding at its end belongs to it.
_BARE = re.compile(r"[A-Za-z0-9+/_.$@!%^&*~-]+(?:={1,2}(?![A-Za-z0-9+/_.$@!%^&*~=-]))?")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")
_NAME = _LETTERS | frozenset("0123456789")

# A string with its prefix letters; what may stand between the parts of one value, on a line and
# inside brackets; the head of a block whose lines are the value.
_QUOTE = re.compile(r"""[bBfFrRuU]{0,2}(\"{3}|'{3}|["'`])""")
_CLOSED = {q: re.compile(rf"((?:[^{q}\\\n]|\\.)*){q}") for q in "\"'`"}
_BLANKS = re.compile(r"[\x20\t]*(?:\\\r?\n[\x20\t]*)*")
_SPACES = re.compile(r"(?:\s|\\\n)*")
_BLOCK = re.compile(r"[|>][+-]?[0-9]?[+-]?[\x20\t]*(?:#[^\n]*)?\r?\n")

#: Attributes that carry a name, and those that carry its value, within one tag.
_KEY_ATTRIBUTES = frozenset(["key", "name", "id", "property"])
_VALUE_ATTRIBUTES = frozenset(["value", "content"])

#: How strongly a part of a name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0,
    "authorization": 0.8, "auth": 0.6, "bearer": 0.8, "signature": 0.5, "salt": 0.5, "key": 0.4,
    "connectionstring": 0.7, "dsn": 0.6,
}


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; matches that fail their length test are dropped."""
    found: list[Span] = []
    if any(word in (low := text.lower()) for word in _TARGETS) or len(low) != len(text):
        found += [(0, "assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(1, "access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(2, "hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _name_parts(name: str) -> list[str]:
    words = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name).replace("_", " ").replace(".", " ").replace("-", " ")
    parts = words.lower().split()
    return parts + [a + b for a, b in zip(parts, parts[1:])]


def sensitivity(name: str) -> float:
    return max((SENSITIVE.get(part, 0.0) for part in _name_parts(name)), default=0.0)


def randomness(literal: str) -> float:
    """0 to 1: length, entropy per character, and a mix of character classes."""
    if len(literal) < 6 or " " in literal.strip():
        return 0.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    classes = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, len(literal) / 16) * 0.3 + min(1.0, entropy / 3.5) * 0.4 + (classes - 1) / 2 * 0.3


def _name_before(text: str, at: int, low: int) -> int | None:
    """Where the dotted or hyphenated name begins that ends at ``at``, not left of ``low``."""
    start = at
    while start > low:
        if text[start - 1] in _NAME:
            start -= 1
        elif start < at and text[start - 1] in ".-" and start - 1 > low and text[start - 2] in _NAME:
            start -= 1
        else:
            break
    while start < at and text[start] not in _LETTERS:
        start += 1
    return start if start < at else None


class _Strings:
    """String literals of one text. A delimiter that is not closed once is not sought again."""

    def __init__(self, text: str):
        self.text, self.open = text, set()

    def at(self, place: int) -> tuple[int, int, int] | None:
        """Start and end of the content of the literal at ``place``, and the place behind it."""
        quote = _QUOTE.match(self.text, place)
        if quote is None:
            return None
        mark, start = quote.group(1), quote.end()
        if len(mark) == 3:
            if mark not in self.open:
                end = self.text.find(mark, start)
                if end >= 0:
                    return start, end, end + 3
                self.open.add(mark)
            mark, start = mark[0], quote.start(1) + 1
        closed = _CLOSED[mark].match(self.text, start)
        return (start, closed.end(1), closed.end()) if closed else None

    def joined(self, place: int, inside: bool) -> tuple[str, int, int, int] | None:
        """The value of literals that follow each other, with or without a plus sign or full stop;
        ``inside`` brackets also across lines."""
        first = self.at(place)
        if first is None:
            return None
        gap = _SPACES if inside else _BLANKS
        parts, (start, end, behind) = [self.text[first[0] : first[1]]], first
        while True:
            at = gap.match(self.text, behind).end()
            if at < len(self.text) and self.text[at] in "+.":
                at = gap.match(self.text, at + 1).end()
            following = self.at(at)
            if following is None:
                return "".join(parts), start, end, behind
            parts.append(self.text[following[0] : following[1]])
            _, end, behind = following


def _block(text: str, line: int, place: int) -> tuple[str, int, int, int] | None:
    """The value of the lines after ``place`` that are indented deeper than the line at ``line``."""

    def indent(at: int) -> int:
        end = at
        while end < len(text) and text[end] in " \t":
            end += 1
        return end

    own, at = indent(line) - line, place
    lines, start, end = [], None, place
    while at < len(text):
        first = indent(at)
        stop = text.find("\n", first)
        stop = len(text) if stop < 0 else stop
        if text[first:stop].strip():
            if first - at <= own:
                break
            start = first if start is None else start
            end = first + len(text[first:stop].rstrip())
            lines.append(text[first:end])
        at = stop + 1
    return ("\n".join(lines), start, end, end) if lines else None


def assignments(text: str) -> list[tuple[str, str, int, int, bool]]:
    """(name, literal or bare value, start and end of it, whether it is quoted) in text order.

    From every assignment sign the name is read leftwards and the value rightwards, each to its real
    end, so the whole text is read about twice however long names, blanks and values are.
    """
    pairs = []
    if "=" not in text and ":" not in text:
        return pairs
    strings, end_of_last, line, read_to = _Strings(text), 0, 0, 0
    key: tuple[str, int] | None = None  # a name that an attribute gives, and where
    for sign in _SIGN.finditer(text):
        if sign.start() < end_of_last:
            continue
        left = sign.start()
        while left > end_of_last and text[left - 1] in " \t\"']":
            left -= 1
        begin = _name_before(text, left, end_of_last)
        if begin is None:
            continue
        name = text[begin:left]
        cut = text.rfind("\n", read_to, begin)
        line, read_to = (cut + 1 if cut >= 0 else line), begin
        place = _BLANKS.match(text, sign.end()).end()
        inside = place < len(text) and text[place] in "(["
        if inside:
            place = _SPACES.match(text, place + 1).end()
        found, quoted = strings.joined(place, inside), True
        if found is None and sign.group() == ":" and (head := _BLOCK.match(text, place)):
            found = _block(text, line, head.end())
        if found is None and not inside and (bare := _BARE.match(text, place)):
            found, quoted = (bare.group(), bare.start(), bare.end(), sign.end()), False
        if found is None:
            continue
        value, start, end, end_of_last = found
        low = name.lower()
        if quoted and low in _VALUE_ATTRIBUTES and key and not re.search("[<>]", text[key[1] : begin]):
            name = key[0]
        key = (value, end) if quoted and low in _KEY_ATTRIBUTES else None
        pairs.append((name, value, start, end, quoted))
    return pairs


def literal_spans(text: str, least_score: float = 0.7) -> list[Span]:
    """Literals whose best target name and randomness score high, after constant propagation."""
    pairs = assignments(text)
    defined = {name for name, *_ in pairs}
    sources: dict[str, list[str]] = {}  # by the name they are assigned to
    for name, value, _, _, quoted in pairs:
        if not quoted and value in defined and _IDENTIFIER.match(value):
            sources.setdefault(name, []).append(value)
    reach: dict[str, float] = {}  # how sensitive the names are that a constant flows into
    for score, name in sorted(((sensitivity(n), n) for n in defined), reverse=True):
        open_names = [name]
        while open_names:  # every name is settled once, by the most sensitive name it reaches
            at = open_names.pop()
            if at not in reach:
                reach[at] = score
                open_names += sources.get(at, ())
    found = []
    for name, value, start, end, quoted in pairs:
        if not quoted and (value in defined or not re.search("[0-9]", value)):
            continue  # a reference or a plain word
        if value and reach[name] * 0.5 + randomness(value) * 0.5 >= least_score:
            found.append((3, "literal", start, end))
    return found


def find_spans(text: str | None, least_score: float = 0.7) -> list[Span]:
    """All spans by start, then kind; null and empty texts have none."""
    text = text or ""
    base = base_spans(text)
    taken = _merged(base)
    starts = [start for start, _ in taken]
    more = []
    for span in literal_spans(text, least_score):
        before = bisect.bisect_left(starts, span[3]) - 1
        if before < 0 or taken[before][1] <= span[2]:
            more.append(span)
    return sorted({*base, *more}, key=lambda s: (s[2], s[0], s[3]))


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """Stretches of text that spans cover, in order and without overlap."""
    out: list[tuple[int, int]] = []
    for _, _, start, end in sorted(spans, key=lambda s: s[2]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for _, kind, start, end in spans)


FOUND = T.StructType(
    [
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def _row(text: str | None) -> tuple:
    spans = find_spans(text)
    base = [s for s in spans if s[0] < 3]
    counts = [sum(s[0] == k for s in base) for k in range(3)]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


@F.arrow_udf(FOUND)
def _found(text: pa.Array) -> pa.Array:
    rows = [_row(t.as_py()) for t in text]
    kinds = [pa.int64()] * 3 + [pa.string()] * 2
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=FOUND.names)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``secrets``: counts, digest of the base spans, and all spans.

    Offsets are code points, ends exclusive. Row by row without a shuffle, so repeated rows stay
    and other columns do not matter; a column named ``secrets`` is replaced.
    """
    return docs.withColumn("secrets", _found(F.col(text)))
