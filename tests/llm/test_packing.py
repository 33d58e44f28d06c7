import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import HARD, hard_documents, no_documents
from tokenizers import Tokenizer

from temblor.llm import packing, tokens
from temblor.llm.tokens import ChunkEncoder


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TOKENIZER.encode_special_tokens = True


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_chunked_ids_equal_the_tokenizer():
    r = random.Random(2)
    bits = ["The", "don't", "é,", "...", "a.", "b,", " ", "\x01", "x́", "12", "'s", "<|endoftext|>", "İ", "\n", "\t", " ", " ", "ß!", "ﬁ", " ", "A.B", ",,"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(400)]
    encode = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), most_chunks=50)
    for text, raw in zip(texts, encode.ids(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain_ids(text), repr(text)


def test_texts_in_bytes_are_learned_in_bounded_calls(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_LEARNED", 3)
    ends = ["a,", "b.", ",", "", " ", ".", ",c", "d, ", "É,", "e\x00", "\n", "f"]
    texts = [f"{a} {i} {b}" * (i % 2) + b for i, (a, b) in enumerate((a, b) for a in ends for b in ends)]
    encode, calls = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json")), []
    plain = encode._encode
    monkeypatch.setattr(encode, "_encode", lambda text: calls.append(len(text.split())) or plain(text))
    given = [None if not t else t if i % 3 else t.encode() for i, t in enumerate(texts)]
    for text, raw in zip(texts, encode.ids(given), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain_ids(text), repr(text)
    assert max(calls) <= 5  # three chunks and a mark between them


def test_small_letters_need_no_normal_form_and_known_chunks_stay(monkeypatch):
    words = ["".join(p) for p in itertools.product("abcdefghij", repeat=3)]
    texts = [" ".join(words[i % 500 :: 7]) + f" {i} É. don't Éa" for i in range(40)]
    encode = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), most_chunks=600)
    whole, small, plain, merged = [], [], encode._encode, encode._encode_small
    monkeypatch.setattr(encode, "_encode", lambda text: whole.extend(text.split()) or plain(text))
    monkeypatch.setattr(encode, "_encode_small", lambda text: small.extend(text.split()) or merged(text))
    for text in texts:
        for _ in range(2):
            [raw] = encode.ids([text])
            assert np.frombuffer(raw, "<u4").tolist() == plain_ids(text)
        assert len(encode._known) <= 600 + len(text.split()) + 1
    assert not any(c.isascii() and c.isalpha() for c in whole)
    # common chunks are learned once, though the table was full in between
    assert len(small) > 600 and whole.count("Éa") == whole.count("don't") == 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_no_capacity_is_exceeded(rule):
    r = random.Random(1)
    for bins in (packing.Bins(100, 100, 10_000, rule), packing.Bins(100, 3, 6000, rule), packing.Bins(100, 100, 2501, rule)):
        lengths = np.array([r.randint(1, 50) for _ in range(500)])
        chosen = packing.best_fit(lengths, bins)
        for b in range(chosen.max() + 1):
            own = lengths[chosen == b]
            assert len(own) and own.sum() <= bins.tokens and len(own) <= bins.documents and (own**2).sum() <= bins.attention
    lengths = np.array([r.randint(1, 50) for _ in range(2000)])
    assert packing.best_fit(lengths, packing.Bins(100, 100, 10_000, rule)).max() + 1 <= -(-lengths.sum() // 100) * 1.01 + 1
    assert packing.best_fit(np.array([], dtype=int)).size == 0
    with pytest.raises(ValueError):
        packing.best_fit(np.array([5000]))


@pytest.mark.parametrize("docs", [hard_documents, no_documents])
def test_every_token_has_one_place(spark, docs):
    rows = packing.pack_documents(docs(spark), packing.Bins(256, 256, 256 * 256), group_pieces=100).collect()
    if docs is no_documents:
        assert rows == []
        return
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    pieces = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    expected = []
    for row in HARD:
        ids = [*plain_ids(row[1]), 1]
        for i, start in enumerate(range(0, len(ids), 256)):
            own = ids[start : start + 256]
            expected.append((str(row[0]), i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert pieces == sorted(expected)


def test_equal_rows_spread_over_groups(spark):
    docs = spark.createDataFrame([(None, "")] * 3000 + [(i, "") for i in range(500)], "doc_id long, text string")
    used = {}
    for row in packing.pack_documents(docs, packing.Bins(7, 7, 49), group_pieces=100).collect():
        used[row.sequence_id] = used.get(row.sequence_id, 0) + row.length
    # 35 groups of 100 pieces of one token: 14 full bins and one of two tokens each
    assert sorted(used.values()) == [2] * 35 + [7] * 490


def test_ids_beside_nulls_stay_exact(spark):
    given = [(2**53 + 1, "one two"), (None, "three"), (2**62 + 3, None), (-5, "four five six")]
    rows = packing.pack_documents(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == sorted((i for i, _ in given), key=str)
