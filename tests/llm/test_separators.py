import numpy as np
import pytest
from brute import HARD, hard_documents, no_documents
from test_packing import plain_ids

from temblor.llm import separators


def test_counts_equal_the_tokenizer(spark):
    out = separators.token_counts(hard_documents(spark)).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in out) == sorted((str(r[0]), len(plain_ids(r[1]))) for r in HARD)
    assert separators.token_counts(no_documents(spark)).count() == 0


def test_documents_across_blocks_of_any_size(spark, tmp_path):
    r = np.random.default_rng(4)
    files = {"a": [0, 5, 0, 0, 37, 1], "b": [3], "c": [], "d": [100, 2]}
    expected = set()
    for name, lengths in files.items():
        ids, at = [], 0
        for k, n in enumerate(lengths):
            ids += [*r.integers(0, 9, n).tolist(), 9]
            expected.add((f"{name}.bin", k, at, n, True))
            at += n + 1
        if name in "bd":  # a document that no separator ends
            ids += [1, 2, 3]
            expected.add((f"{name}.bin", len(lengths), at, 3, False))
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, "<u4").tobytes())
    for block in (4, 12, 40, 1 << 20):
        out = separators.scan(spark, str(tmp_path), separator=9, dtype="<u4", block_bytes=block)
        assert {tuple(x) for x in out.select("file", "ordinal", "start", "n_tokens", "ended").collect()} == expected


def test_ids_too_wide_for_the_files_are_refused():
    ids = np.array([1, 65_535], dtype="<u4")
    assert np.frombuffer(separators.narrowed(ids.tobytes(), "<u2"), "<u2").tolist() == [1, 65_535]
    with pytest.raises(ValueError):
        separators.narrowed((ids + 1).tobytes(), "<u2")
