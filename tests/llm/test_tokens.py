"""Encoding, decoding, piece counts and the token store against the tokenizers library and plain loops."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from offerwell.llm import bpe, text as tx, token_counts, token_store

ODD = " \n\t\r\x0b\x0c\xa0 　\x85\x1c\x1fabcABC019.,!'\"sStllé日本語🎉ßñ́²Ⅷ٣_-​﻿"
TEXTS = [
    "", None, " ", "  a", "a  b", "\n\n a\n", "a\n\n b \n c  ", "it's  'S don't 'll", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
    "x" * 20_000, "ab" * 3_000 + "!!" * 100, "\xa0b", "a\xa0\n b 　 c", "word " * 5_000, "word", "word",
]


@pytest.fixture(scope="module")
def coder(byte_bpe):
    return bpe.ByteBpe(tx.read_tokenizer(byte_bpe))


@pytest.fixture(scope="module")
def library(byte_bpe):
    return Tokenizer.from_file(byte_bpe)


def check(coder, library, texts):
    ids, bounds = coder.encode(tx.text_array(pa.array(texts, pa.string())))
    decoded = coder.decode(ids, bounds).to_pylist()
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want
        assert decoded[i] == library.decode(want, skip_special_tokens=False)


def test_segment_tree_equals_library(coder, library):
    check(coder, library, TEXTS)
    rng = random.Random(1)
    check(coder, library, ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(3_000)])
    check(coder, library, ["a" + chr(c) + " b" for c in range(0x3000)])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet=ODD, max_size=40), min_size=1, max_size=5))
def test_any_texts(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    check(_coder(path), Tokenizer.from_file(path), texts)


_CODERS = {}


def _coder(path):
    return _CODERS.setdefault(path, None) or _CODERS.__setitem__(path, bpe.ByteBpe(tx.read_tokenizer(path))) or _CODERS[path]


def test_bytes_that_are_no_text(coder, library):
    lone = coder.merger.byte_id[[0xC3, 0x28, 0xE2, 0x82]].astype("<u4")
    assert coder.decode(lone, np.array([0, 1, 4])).to_pylist() == ["�", "(�"]


def test_encode_decode_frame(docs, byte_bpe, library):
    rows = bpe.encode_decode(docs(list(enumerate(TEXTS)) + [(3, "  a")]), byte_bpe).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == want and r["decoded"] == (r["text"] or "") and r["row"] == r["doc_id"]
    assert bpe.encode_decode(docs([]), byte_bpe).collect() == []


def test_slices_bound_memory(monkeypatch, docs, byte_bpe, library):
    monkeypatch.setattr(tx, "SLICE_BYTES", 64)
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["a" * 30, "b" * 30, None, "c" * 200, "d"])})
    parts = [p.num_rows for p in tx.slices(batch, 0)]
    assert sum(parts) == 5 and len(parts) == 3


def greedy(pieces, word):
    n, at = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def test_longest_match_equals_greedy():
    rng = random.Random(2)
    for _ in range(200):
        pieces = {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        machine = token_counts.LongestMatch(pieces)
        for _ in range(30):
            word = bytes(rng.choices(b"abcd", k=rng.randint(0, 14)))
            assert machine.count(word) == greedy(pieces, word)


def test_counts_equal_library_word_pieces(docs, byte_bpe):
    vocabulary = json.load(open(byte_bpe))["model"]["vocab"]
    pieces = models.WordPiece(vocabulary, unk_token="!", continuing_subword_prefix="", max_input_chars_per_word=100_000)
    symbol = {b: c for c, b in tx.byte_symbols().items()}
    texts = [t for t in TEXTS if t and "<|" not in t]
    rows = token_counts.count_pieces(docs(list(enumerate(texts))), byte_bpe).collect()
    for r in rows:
        words = r["text"].encode().split()
        want = sum(len(pieces.tokenize("".join(symbol[b] for b in b" " + w))) for w in words)
        assert (r["n_words"], r["n_pieces"], r["n_unknown"]) == (len(words), want, 0)
    empty = token_counts.count_pieces(docs([(1, None), (2, "")]), byte_bpe).collect()
    assert [(r["n_words"], r["n_pieces"]) for r in empty] == [(0, 0), (0, 0)]
    assert token_counts.count_pieces(docs([]), byte_bpe).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), max_size=900))
def test_elias_fano(gaps):
    values = np.cumsum(np.array(gaps, np.int64))
    made = token_store.EliasFano.of(values)
    again = token_store.EliasFano(made.n, *made.parts())
    assert again.all().tolist() == values.tolist()
    for i in range(0, len(values), 37):
        assert again.select(i) == values[i]
    if len(values):
        bits = 8 * (len(made.low) + len(made.high))
        assert bits <= len(values) * (2 + max(1, np.log2(max(2, values[-1] / len(values))) + 1)) + 16
    with pytest.raises(IndexError):
        again.select(len(values))


def test_token_store(spark, docs, word_bpe, tmp_path):
    texts = TEXTS + ["Hello World", "É é", "a<|endoftext|>b <|startoftext|>"]
    rows = [(7 * i % 31, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, "again"), (7, "again")]
    token_store.write_tokens(docs(rows), str(tmp_path / "s"), word_bpe, end_id=1)
    got = token_store.documents(token_store.read_tokens(spark, str(tmp_path / "s"))).collect()
    library, at, want = Tokenizer.from_file(word_bpe), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_empty_store(spark, docs, word_bpe, tmp_path):
    token_store.write_tokens(docs([]), str(tmp_path / "e"), word_bpe)
    assert token_store.documents(token_store.read_tokens(spark, str(tmp_path / "e"))).collect() == []


def test_words_split_at_ascii_space_only():
    values, bounds = tx.words(pa.array(["a\tb\nc\x0bd\x0ce\rf g\x1ch\xa0i j", "", "  x "]))
    assert values.to_pylist() == ["a", "b", "c", "d", "e", "f", "g\x1ch\xa0i j", "x"] or [
        v.decode() for v in values.to_pylist()
    ] == ["a", "b", "c", "d", "e", "f", "g\x1ch\xa0i j", "x"]
    assert bounds.tolist() == [0, 7, 7, 8]


def test_cache_keeps_a_bounded_number():
    asked = []
    cache = tx.Cache(lambda keys: asked.extend(keys) or [len(k) for k in keys], entries=10)
    for i in range(50):
        key = str(i).encode()
        assert cache.many([key, b"hot"]) == [len(key), 3]
    assert len(cache.young) + len(cache.old) <= 14 and asked.count(b"hot") == 1
