"""HTML pages as sequences of DOM leaf blocks, with the features a labeller needs.

A leaf block is the text between two boundaries of block-level elements; inline elements belong to
the block they stand in. The reader follows how browsers repair pages where it matters here:
paragraphs and list items close by themselves, a stray end tag is ignored, an end tag closes what is
open inside it, and text of scripts, styles and other unshown elements is not text.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

#: Elements that break a line of text when they begin or end. Fixed values of the HTML standard.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
#: Elements without content. Fixed values of the HTML standard.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose content is not markup, or is markup that is not shown.
RAW_TAGS = frozenset("script style textarea title noscript template iframe xmp noembed svg math".split())
#: Start tags that close an open element of the same family.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
_SCOPES = frozenset("ul ol dl table body html div article section aside nav header footer main form".split())

#: Words of class, id and role are told apart by a hash into so many numbers.
HINTS = 4096

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_WHITE = re.compile(r"\s+")


@dataclass
class Block:
    """Text of a leaf block, the innermost tag and all tags open around it, the words of their
    class, id and role, and how much of the text is in links."""

    text: str
    leaf: str
    path: frozenset
    hints: frozenset
    link_chars: int = 0
    inline: frozenset = field(default_factory=frozenset)


def leaf_blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a whole page that hold text, in page order; none for null or empty.

    Character references are decoded, runs of white space become one space, ends are trimmed.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    tags: Counter = Counter()  # open tags and hints with their numbers, so deep pages stay cheap
    near: Counter = Counter()
    inline: list[str] = []
    texts: list[str] = []
    links, seen, at = 0, set(), 0

    def flush() -> None:
        nonlocal links
        text = _WHITE.sub(" ", entities.unescape("".join(texts))).strip()
        if text:
            leaf = stack[-1][0] if stack else "-"
            out.append(Block(text, leaf, frozenset(tags), frozenset(near), min(links, len(text)), frozenset(seen)))
        texts.clear()
        seen.clear()
        seen.update(inline)
        links = 0

    def cut(depth: int) -> None:
        """Close what is open from a depth on."""
        while len(stack) > depth:
            tag, hints = stack.pop()
            for counter, names in ((tags, (tag,)), (near, hints)):
                for name in names:
                    counter[name] -= 1
                    if not counter[name]:
                        del counter[name]

    def add(text: str) -> None:
        nonlocal links
        if text:
            texts.append(text)
            seen.update(inline)
            if "a" in inline:
                links += len(text.strip())

    size = len(page)
    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            add(page[at:])
            break
        m = _MARKUP.match(page, sign)
        if m is None:  # a bare sign is text
            add(page[at : sign + 1])
            at = sign + 1
            continue
        add(page[at:sign])
        at = m.end()
        if m.group(2) is None:
            continue
        tag, ends = m.group(2).lower(), bool(m.group(1))
        if tag in RAW_TAGS and not ends:
            if m.group(3).rstrip().endswith("/") and tag in ("svg", "math"):
                continue
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else (size if tag not in ("noscript", "svg", "math") else at)
            if tag in BLOCK_TAGS:
                flush()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag not in BLOCK_TAGS:
            if tag in VOID_TAGS:
                continue
            if not ends:
                inline.append(tag)
            elif tag in inline:
                del inline[len(inline) - 1 - inline[::-1].index(tag)]
            continue
        flush()
        if ends:
            if tag in tags:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                cut(depth)
            if tag != "p":
                inline = [t for t in inline if t != "a"]
            continue
        if stack and stack[-1][0] == "p":
            cut(len(stack) - 1)
        family = CLOSES.get(tag, ())
        for i in range(len(stack) - 1, -1, -1) if family else ():
            if stack[i][0] in family:
                cut(i)
                break
            if stack[i][0] in _SCOPES:
                break
        if tag not in VOID_TAGS:
            hints: list[str] = []
            for a in _ATTRIBUTE.finditer(m.group(3)):
                if a.group(1).lower() in ("class", "id", "role", "itemprop"):
                    value = a.group(2) or a.group(3) or a.group(4) or ""
                    hints += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
            own = tuple({zlib.crc32(h.encode()) % HINTS for h in hints})
            stack.append((tag, own))
            tags[tag] += 1
            near.update(own)
    flush()
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block: its ancestors, their hints, and its text."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.split(" ")
        n, chars = len(words), len(b.text)
        stops = sum(b.text.count(c) for c in ".!?;:,")
        names = ["bias", f"leaf={b.leaf}"]
        names += [f"in={t}" for t in b.path]
        names += [f"hint={h}" for h in b.hints]
        names += [f"inline={t}" for t in b.inline if t in ("a", "b", "strong", "em", "time", "label", "code")]
        names.append(f"words={next((k for k in (1, 2, 4, 8, 16, 32, 64) if n <= k), 99)}")
        names.append(f"links={int(4 * b.link_chars / max(1, chars))}")
        names.append(f"stops={min(4, int(20 * stops / max(1, n)))}")
        names.append("ends=stop" if b.text[-1] in ".!?:…\"'" else "ends=none")
        names.append(f"digits={min(3, int(10 * sum(map(str.isdigit, b.text)) / max(1, chars)))}")
        if any(s in b.text for s in "©®»"):
            names.append("marks")
        names.append("first" if i == 0 else "last" if i == len(blocks) - 1 else "middle")
        out.append(names)
    return out
