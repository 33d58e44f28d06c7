"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

Every leaf block of a page gets the label content or boilerplate. Features are the block's
ancestor tags, the words of their class, id and role, and properties of its text. Training
maximises the penalised likelihood of labelled pages, by forward and backward sums over all chains
at once; decoding is Viterbi. The model is a few thousand numbers, fitted on a bounded number of
labelled pages, and goes to the tasks with their code.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm.htmlblocks import features, leaf_blocks

#: Feature names are hashed into so many weights for each label.
WIDTH = 2048


def feature_ids(names: list[str]) -> list[int]:
    return [zlib.crc32(n.encode()) % WIDTH for n in names]


@dataclass
class Model:
    """``emit[f, y]`` for a feature and a label, ``step[y, z]`` from a label to the next."""

    emit: np.ndarray
    step: np.ndarray

    def scores(self, blocks: list) -> np.ndarray:
        rows = [feature_ids(n) for n in features(blocks)]
        return np.array([self.emit[r].sum(axis=0) for r in rows])

    def decode(self, blocks: list) -> np.ndarray:
        """The most likely labels of a page's blocks, 1 for content (Viterbi)."""
        if not blocks:
            return np.empty(0, dtype=int)
        own = self.scores(blocks)
        best, back = own[0], []
        for t in range(1, len(own)):
            ways = best[:, None] + self.step
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + own[t]
        label = int(best.argmax())
        out = [label]
        for pointers in reversed(back):
            label = int(pointers[label])
            out.append(label)
        return np.array(out[::-1])


def train(pages: list[tuple[list, list[int]]], rounds: int = 120, penalty: float = 1e-3) -> Model:
    """Fit on (blocks, labels) of labelled pages. All chains are padded and summed together."""
    pages = [(b, y) for b, y in pages if b]
    longest = max(len(b) for b, _ in pages)
    n = len(pages)
    mask, gold = np.zeros((n, longest), dtype=bool), np.zeros((n, longest), dtype=int)
    rows, columns = [], []
    for i, (blocks, labels) in enumerate(pages):
        mask[i, : len(blocks)], gold[i, : len(blocks)] = True, labels
        for t, names in enumerate(features(blocks)):
            for f in set(feature_ids(names)):
                rows.append(i * longest + t)
                columns.append(f)
    used = sorted(set(columns))
    place = {f: j for j, f in enumerate(used)}
    x = np.zeros((n * longest, len(used)), dtype=np.float32)
    x[rows, [place[f] for f in columns]] = 1.0
    emit, step = np.zeros((len(used), 2)), np.zeros((2, 2))
    hot = np.eye(2)[gold] * mask[..., None]
    pairs = np.einsum("nti,ntj->ij", hot[:, :-1] * mask[:, 1:, None], hot[:, 1:])
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    for r in range(1, rounds + 1):
        own = (x @ emit.astype(np.float32)).astype(float).reshape(n, longest, 2)
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = own[:, 0]
        for t in range(1, longest):
            alpha[:, t] = own[:, t] + np.logaddexp.reduce(alpha[:, t - 1, :, None] + step, axis=1)
        for t in range(longest - 2, -1, -1):
            ahead = np.logaddexp.reduce(step + (own[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], ahead, 0.0)
        total = np.logaddexp.reduce(alpha + beta, axis=2)
        belief = np.exp(alpha + beta - total[..., None]) * mask[..., None]
        joint = np.exp(
            alpha[:, :-1, :, None] + step + (own[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, :-1, None, None]
        ) * mask[:, 1:, None, None]
        slopes = [
            x.T @ (hot - belief).reshape(-1, 2).astype(np.float32) / n - penalty * emit,
            (pairs - joint.sum(axis=(0, 1))) / n - penalty * step,
        ]
        for i, (weights, slope) in enumerate(zip((emit, step), slopes, strict=True)):
            first, second = moments[2 * i], moments[2 * i + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            weights += 0.1 * (first / (1 - 0.9**r)) / (np.sqrt(second / (1 - 0.99**r)) + 1e-8)
    full = np.zeros((WIDTH, 2))
    full[used] = emit
    return Model(full, step)


# Labelled pages. Each part is markup with the labels of its leaf blocks; pages combine parts of
# many sites' habits, so that no single mark decides.
_FILL = "the of and to in for on with by from that this was are over under new old time year people water house light road work".split()


def _words(r: random.Random, low: int, high: int, stop: bool = True) -> str:
    words = [r.choice(_FILL) + r.choice(("", "", "s", "ing", "ed", "er", "ly", "al")) for _ in range(r.randint(low, high))]
    for i in range(len(words)):
        if stop and r.random() < 0.12 and i + 1 < len(words):
            words[i] += r.choice((",", ",", "."))
    text = " ".join(words)
    return text[:1].upper() + text[1:] + (r.choice((".", ".", ".", "!", "?")) if stop else "")


def _menu(r: random.Random) -> tuple[str, list[int]]:
    n = r.randint(2, 8)
    items = "".join(f'<li><a href="/{i}">{_words(r, 1, 2, r.random() < 0.2)}</a></li>' for i in range(n))
    tag, name = r.choice((("nav", ""), ("nav", ' class="menu"'), ("div", ' class="menu"'), ("div", ' id="nav"'), ("header", ""), ("div", ' role="navigation"'), ("nav", "")))
    return f"<{tag}{name}><ul>{items}</ul></{tag}>", [0] * n


def _aside(r: random.Random) -> tuple[str, list[int]]:
    tag, name = r.choice((
        ("aside", ""), ("div", ' class="ad"'), ("div", ' class="advert"'), ("div", ' class="sidebar"'), ("div", ' id="cookie-notice"'),
        ("div", ' class="promo banner"'), ("section", ' class="related"'), ("div", ' class="social share"'), ("aside", ' class="newsletter"'),
        ("div", ' class="ad"'), ("div", ' class="cookie banner"'), ("div", ' role="complementary"'), ("div", ' class="notice"'),
    ))
    if r.random() < 0.4:
        return f"<{tag}{name}>{_words(r, 3, 25)}</{tag}>", [0]
    n = r.randint(1, 3)
    return f"<{tag}{name}>{''.join(f'<p>{_words(r, 3, 30)}</p>' for _ in range(n))}</{tag}>", [0] * n


def _comments(r: random.Random) -> tuple[str, list[int]]:
    n = r.randint(1, 4)
    tag, name = r.choice((("section", ' class="comments"'), ("div", ' id="comments"'), ("div", ' class="comment-list"'), ("ol", ' class="comments"')))
    inner = "li" if tag == "ol" else "div"
    body = "".join(f'<{inner} class="comment"><p>{_words(r, 5, 50)}</p></{inner}>' for _ in range(n))
    return f"<{tag}{name}>{body}</{tag}>", [0] * n


def _form(r: random.Random) -> tuple[str, list[int]]:
    return f'<form action="/s"><label>{_words(r, 1, 4, False)}</label><input name="q"><button>{_words(r, 1, 2, False)}</button></form>', [0, 0]


def _foot(r: random.Random) -> tuple[str, list[int]]:
    tag, name = r.choice((("footer", ""), ("footer", ""), ("div", ' class="footer"'), ("div", ' id="footer"')))
    text = f"&copy; {r.choice(('2019', 'site.example.com', 'm.news.example.net'))} &middot; {_words(r, 3, 12)}"
    if r.random() < 0.3:
        return f"<{tag}{name}><p>{text}</p><p><a href='/p'>{_words(r, 1, 3, False)}</a></p></{tag}>", [0, 0]
    return f"<{tag}{name}>{text}</{tag}>", [0]


def _article(r: random.Random) -> tuple[str, list[int]]:
    parts, labels = [], []
    tag, name = r.choice((("article", ""), ("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' id="post"'), ("div", ' class="article-body"'), ("section", ' class="entry"')))
    if r.random() < 0.9:
        parts.append(f"<h1>{_words(r, 2, 12, r.random() < 0.5)}</h1>")
        labels.append(1)
    for _ in range(r.randint(1, 14)):
        kind = r.random()
        if kind < 0.68:
            text = _words(r, 1, 9) if r.random() < 0.25 else _words(r, 8, 120, r.random() < 0.9)
            if r.random() < 0.15:  # prose of poor quality is content all the same
                text = r.choice((text.upper(), text.replace(" ", " | "), text.replace(" ", "%%% "), text.replace(" ", "!! ")))
            if r.random() < 0.2:
                text = text.replace(" ", " <a href='/x'>", 1).replace(",", "</a>,", 1) if "," in text else f"<em>{text}</em>"
            parts.append(f"<p>{text}" + ("</p>" if r.random() < 0.85 else ""))
            labels.append(1)
        elif kind < 0.78:
            parts.append(f"<p><b>{_words(r, 1, 14)}" + ("</b></p>" if r.random() < 0.4 else "<br>"))
            labels.append(1)
        elif kind < 0.85:
            parts.append(f"<h2>{_words(r, 1, 8, False)}</h2>")
            labels.append(1)
        elif kind < 0.90:
            n = r.randint(1, 4)
            parts.append("<ul>" + "".join(f"<li>{_words(r, 1, 20)}</li>" for _ in range(n)) + "</ul>")
            labels += [1] * n
        elif kind < 0.93:
            parts.append(f"<blockquote>{_words(r, 4, 40)}</blockquote>")
            labels.append(1)
        elif kind < 0.955:
            parts.append(f"<table><tr><td>{_words(r, 1, 4)}</td><td>{r.randint(1, 999)}</td></tr></table>")
            labels += [1, 1]
        elif kind < 0.97:
            parts.append(f"<pre>{_words(r, 3, 30)}</pre>")
            labels.append(1)
        else:
            body, own = _aside(r)
            parts.append(body)
            labels += own
    return f"<{tag}{name}>{''.join(parts)}</{tag}>", labels


def labelled_page(seed: int) -> tuple[str, list[int]]:
    """A page and the labels of its leaf blocks, 1 for content."""
    r = random.Random(seed)
    before = [p for p, often in ((_menu, 0.85), (_aside, 0.5), (_form, 0.2)) if r.random() < often]
    after = [p for p, often in ((_aside, 0.35), (_comments, 0.35), (_form, 0.2), (_foot, 0.85)) if r.random() < often]
    if r.random() < 0.3:
        r.shuffle(before)
    parts = [p(r) for p in [*before, _article, *after]]
    head = "<!DOCTYPE html><html><head><title>t</title><style>p{margin:0}</style><script>var a='<p>';</script></head><body>"
    return head + "".join(m for m, _ in parts) + "</body></html>", [y for _, own in parts for y in own]


@lru_cache(maxsize=4)
def trained(pages: int = 400, seed: int = 1) -> Model:
    """The model fitted on ``pages`` labelled pages; kept by the driver."""
    return train([(leaf_blocks(page), labels) for page, labels in (labelled_page(seed * 1_000_003 + i) for i in range(pages))])


def main_text(page: str | None, model: Model) -> str:
    """Content blocks of a page in order, joined by line feeds; empty if there are none."""
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, model.decode(blocks), strict=True) if y)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row; other columns are ignored.

    Null and empty pages give an empty text. Row by row without a shuffle, so repeated rows stay.
    """
    model = model or trained()
    schema = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())]
    )

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in incoming:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(h, model) for h in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, schema).withColumn("n_chars", F.char_length("text").cast("long"))
