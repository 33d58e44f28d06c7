"""Token ids of whole texts with a word-level vocabulary, memoised by white-space chunk.

The pre-tokeniser of a word-end vocabulary never joins characters across ASCII white space, so the
ids of a text are the ids of its chunks in a row. Each task keeps a bounded table from chunk to ids;
only chunks it has not seen go to the tokeniser, many in one call. The table goes when the task ends,
since a worker process outlives its task and would hold it while other work runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import compress, filterfalse, pairwise
from operator import not_

import numpy as np
import pyarrow as pa

VOCABULARY = "word_bpe_49k.json"

#: Chunks a task remembers; beyond that it keeps those of the present texts. About 250 bytes each.
MOST_CHUNKS = 300_000

#: Chunks in one call; larger calls took a little longer for each.
MOST_LEARNED = 1000

#: Bytes of text that are cut into chunks together; a longer text is alone.
MOST_TOGETHER = 1 << 21

# Stands between chunks in one call; chunks that hold it are encoded by themselves.
_MARK = "\x01"


_COMMA_OR_STOP = np.zeros(256, dtype=bool)
_COMMA_OR_STOP[[0x2C, 0x2E]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x61:0x7B] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def chunked(raws: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """White-space chunks of all texts in lower case, each distinct one once in the dictionary, and the
    borders between the texts' chunks, one more than there are texts.

    A comma or full stop alone between a letter and white space is a pre-token of its own; it becomes a
    chunk, so the word keeps the chunk that it has without it."""
    # the space after a text is what follows its last character
    data = np.frombuffer(b" ".join([*raws, b""]).lower(), dtype=np.uint8)
    space = _SPACE[data]
    at = np.flatnonzero(_COMMA_OR_STOP[data])
    at = at[space[at + 1] & (at > 0) & _LETTER[data[at - 1]]]
    # a chunk starts after white space and at those marks
    first = ~space
    first[1:] &= space[:-1]
    first[at] = True
    kept = data[~space]
    starts = np.append(np.flatnonzero(first[~space]), len(kept)).astype(np.int32)
    buffers = [None, pa.py_buffer(starts), pa.py_buffer(kept)]
    chunks = pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers).dictionary_encode()
    ends = np.cumsum([0, *(len(raw) + 1 for raw in raws)])
    return chunks, np.searchsorted(np.flatnonzero(first), ends)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """``ids(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, most_chunks: int = MOST_CHUNKS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self._known: dict[bytes, bytes] = {}
        self._most = most_chunks
        mark = self._encode(_MARK)
        self._mark = int(mark[0]) if len(mark) == 1 else None
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(1 + max(vocabulary.values()), dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # small Latin letters are their own normal form and one pre-token: only the merges are left to do
        self._merges = Tokenizer(self._tokenizer.model)
        self._merges.pre_tokenizer = WhitespaceSplit()

    def forget(self) -> None:
        self._known = {}

    def _encode(self, text: str) -> np.ndarray:
        [found] = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def _encode_small(self, text: str) -> np.ndarray:
        [found] = self._merges.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def _learn(self, chunks: list[bytes]) -> None:
        small = list(map(bytes.isalpha, chunks))  # Latin letters; chunks are in lower case
        left = self._learn_words(list(compress(chunks, small)), self._encode_small)
        chunks = list(compress(chunks, map(not_, small)))
        alone = list(map(str.isalpha, b" ".join(chunks).decode().split(" "))) if chunks else []
        left += self._learn_words(list(compress(chunks, alone)), self._encode)
        self._learn_marked([*left, *compress(chunks, map(not_, alone))])

    def _learn_words(self, words: list[bytes], encode: Callable[[str], np.ndarray]) -> list[bytes]:
        """Letters alone are one pre-token, which ends with the one id that ends a word. Returns the
        words if that does not tell them apart."""
        ids = encode(b" ".join(words).decode())
        ends = 4 * (np.flatnonzero(self._ends[ids]) + 1)
        if len(ends) != len(words):
            return words
        cuts = ends.tolist()
        self._known.update(zip(words, map(ids.tobytes().__getitem__, map(slice, [0, *cuts], cuts)), strict=True))
        return []

    def _learn_marked(self, chunks: list[bytes]) -> None:
        marked = _MARK.encode()
        joint = [c for c in chunks if self._mark is not None and marked not in c]
        if joint:
            ids = self._encode(f" {_MARK} ".join([c.decode() for c in joint]))
            cuts = np.flatnonzero(ids == self._mark)
            if len(cuts) == len(joint) - 1:
                raw = ids.tobytes()
                starts = [0, *(4 * (cuts + 1)).tolist()]
                ends = [*(4 * cuts).tolist(), len(raw)]
                for chunk, start, end in zip(joint, starts, ends, strict=True):
                    self._known[chunk] = raw[start:end]
        for chunk in chunks:
            if chunk not in self._known:
                self._known[chunk] = self._encode(chunk.decode()).tobytes()

    def ids(self, texts: list[str | bytes | None]) -> Iterator[bytes]:
        """One text at a time, in order; null counts as empty. Bytes are a text in UTF-8."""
        raw = [t.encode() if isinstance(t, str) else t or b"" for t in texts]
        lengths, low = np.cumsum([len(t) for t in raw]), 0
        while low < len(raw):
            before = lengths[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(lengths, before + MOST_TOGETHER, side="right")))
            yield from self._some(raw[low:high])
            low = high

    def _some(self, raw: list[bytes]) -> Iterator[bytes]:
        chunks, borders = chunked(raw)
        distinct = chunks.dictionary.to_pylist()
        if len(self._known) > self._most:
            both = [c for c in distinct if c in self._known]
            self._known = dict(zip(both, map(self._known.__getitem__, both), strict=True))
        new = list(filterfalse(self._known.__contains__, distinct))
        for at in range(0, len(new), MOST_LEARNED):
            self._learn(new[at : at + MOST_LEARNED])
        found = list(map(self._known.__getitem__, distinct))
        # the ids of all texts, gathered from those of the distinct chunks
        each = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        code = chunks.indices.to_numpy()
        size = sizes[code]
        ends = np.cumsum(size)
        at = np.arange(size.sum()) + np.repeat((np.cumsum(sizes) - sizes)[code] - (ends - size), size)
        ids = each[at].tobytes()
        for start, end in pairwise((4 * np.append(0, ends)[borders]).tolist()):
            yield ids[start:end]


_ENCODERS: dict[str, ChunkEncoder] = {}


@contextmanager
def encoding(path: str) -> Iterator[ChunkEncoder]:
    """The worker's encoder of a vocabulary file, for one task; its table goes at the end."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    try:
        yield _ENCODERS[path]
    finally:
        _ENCODERS[path].forget()
