"""Byte-level BPE against the rank library."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from crease.llm import byte_bpe
from crease.llm.queries import RANKS

PATH = public_tokenizers.path(RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.ByteCodec(byte_bpe.load_ranks(PATH))


def encoded(codec, texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    return [np.frombuffer(i, "<u4").tolist()
            for i in codec.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)]


PARTS = ["'s", "'ll", "'re", "'", "''", "a", "ve", "S", "é", "漢", "9", "²", "٣", " ", "  ", "\n",
         "\t", "\r\n", " ", "　", " ", "\x1c", "́", ".", "!?", "_", "😀", "\x00",
         "re", "t", "the", " the", "'d'm", "l"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), st.text()),
                max_size=6))
def test_ids_equal_the_library(library, own, texts):
    found = encoded(own, texts)
    assert found == [library.encode_ordinary(t) for t in texts]
    for text, ids in zip(texts, found, strict=True):
        offsets, raw = own.decode(np.array(ids, np.int64))
        assert raw == text.encode()
        assert [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)] \
            == [library.decode_single_token_bytes(i) for i in ids]


def test_every_character_is_cut_as_the_library_cuts_it(library, own):
    points = [p for p in range(byte_bpe.POINTS) if not 0xD800 <= p < 0xE000]
    texts = ["a" + " ".join(map(chr, points[i:i + 16])) + "1" for i in range(0, len(points), 16)]
    assert encoded(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_scan_composes_functions_whatever_the_block():
    product, value = byte_bpe._monoid()
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 2 * byte_bpe.SYMBOLS, 5000).astype(np.uint8)
    state, states = 0, []
    for number in numbers:
        state = value[number, state]
        states.append(state)
    for block in (2, 7, 64):
        assert value[byte_bpe.scan(numbers, block), 0].tolist() == states
    for a, b, c in rng.integers(0, len(product), (500, 3)):
        assert product[product[a, b], c] == product[a, product[b, c]]


def test_both_mergers_and_a_bounded_memory(library):
    ranks = byte_bpe.load_ranks(PATH)
    pieces = byte_bpe.Pieces(ranks, size=4000, longest=40)
    rng = random.Random(4)
    for _ in range(400):
        word = "".join(rng.choice("etaoinshrd é漢") for _ in range(rng.randint(2, 70))).encode()
        assert pieces.merge(word) == pieces.merge_short(word)
        pieces[word]
        assert len(pieces) < 40
        assert all(len(p) <= 40 for p in pieces)
    long = "ab" * 30_000 + "x" * 70_001
    assert np.frombuffer(pieces[long.encode()], "<u4").tolist() == library.encode_ordinary(long)


def test_frames_of_any_rows(spark, library, corpus, nothing, repeats):
    docs, texts = corpus
    got = {r.row.doc_id: r for r in byte_bpe.byte_bpe_encode(docs, PATH).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode_ordinary(text)
        sizes = [len(library.decode_single_token_bytes(t)) for t in ids]
        assert got[i].token_ids == ids
        assert got[i].token_offsets == np.cumsum([0, *sizes])[:-1].tolist()
        assert bytes(got[i].decoded) == text.encode()
        assert np.frombuffer(got[i].ids_bytes, "<u4").tolist() == ids
        assert got[i].row.row == "x"
    assert byte_bpe.byte_bpe_encode(nothing, PATH).count() == 0
    assert sorted(len(r.token_ids) for r in byte_bpe.byte_bpe_encode(repeats, PATH).collect()) \
        == sorted(len(library.encode_ordinary(r.text or "")) for r in repeats.collect())


def test_decoding_of_stored_ids(spark, library):
    rows = [(1, library.encode_ordinary("don't stop 漢字")), (2, None), (3, []),
            (4, [-1, None, 10 ** 9, 464])]
    coded = spark.createDataFrame(rows, "decoded int, token_ids array<int>").repartition(1)
    got = byte_bpe.byte_bpe_decode(coded.withColumnRenamed("decoded", "i"), PATH)
    assert {r.i: bytes(r.decoded) for r in got.collect()} == {
        1: "don't stop 漢字".encode(), 2: b"", 3: b"",
        4: library.decode_single_token_bytes(464)}
