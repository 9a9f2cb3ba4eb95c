import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gridlake.llm.packing import hilbert_keys, pack_documents, powers
from gridlake.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER, ENCODER = Tokenizer.from_file(PATH), Encoder(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab'  \n\tst<|endoftext|>12é"))))
def test_ids_equal_the_tokenizers_library(text):
    assert list(ENCODER(text)) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_a_text():
    text = "a<|endoftext|> b"
    assert list(ENCODER(text)) == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_powers():
    assert powers(1023) == [512, 256, 128, 64, 32, 16, 8, 4, 2, 1] and powers(0) == []


ROWS = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "word " * 3000, "x"), (None, "no id", "x"),
        (5, "same text", "x"), (5, "same text", "x"), (6, "same text", "x")]


@pytest.mark.parametrize("length", [8, 1024])
def test_each_token_lies_in_one_piece(spark, length):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids string")
    out = pack_documents(docs, PATH, length).collect()
    expected = sorted((str(d), zlib.crc32(np.array(
        TOKENIZER.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for d, t, _ in ROWS)
    docs_seen, parts = [], {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        parts.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.start + r.length <= r.doc_tokens
    for pieces in parts.values():
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at == length or at & (at - 1) == 0 and at < length
    whole = {}
    for r in out:
        if r.doc_id != 5:
            whole.setdefault(r.doc_id, {})[r.start] = r.ids
    for doc, pieces in whole.items():
        docs_seen.append((str(doc), zlib.crc32(b"".join(pieces[k] for k in sorted(pieces)))))
    assert sorted(docs_seen) == [e for e in expected if e[0] != "5"]
    assert sum(r.length for r in out if r.doc_id == 5) == 2 * next(r.doc_tokens for r in out if r.doc_id == 5)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
