"""Words that collide modulo 2^64 for any base, and rows that repeat."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crease.llm import _text, bpe, fm_index, minhash, quality, r_index, token_files
from crease.llm.pretokens import Memory, encode_plain
from crease.llm.queries import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)


def thue_morse(a, b, doublings=11):
    word, other = a, b
    for _ in range(doublings):
        word, other = word + other, other + word
    return word, other


ONE, TWO = thue_morse("a", "b")


def _hash(values, a, b):
    return _text.Rolling(values).of(np.array([a]), np.array([b]))[0]


def test_rolling_hash_of_structured_and_of_shifted_sequences():
    for a, b in (("a", "b"), ("ab", "ba"), ("x", "y")):
        one, two = (np.frombuffer(w.encode(), np.uint8) for w in thue_morse(a, b))
        hashes = [_text.byte_hashes(x).of(np.array([0]), np.array([len(x)]))[0]
                  for x in (one, two)]
        assert hashes[0] != hashes[1]
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    twice = np.concatenate([values, values[:7], values])
    assert _hash(twice, 0, 3000) == _hash(twice, 3007, 6007) == _hash(values, 0, 3000)
    assert _hash(values, 5, 9) == _text.Rolling(values).every(4)[5] != _hash(values, 6, 10)
    assert len(np.unique(_text.Rolling(values).every(3))) == 2998
    big = np.full(100, np.uint64((1 << 64) - 1))
    assert _hash(big, 0, 50) == _hash(big, 50, 100) != _hash(big, 0, 51)


def test_tokens_of_words_that_collided(spark):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    rows = [(0, ONE), (1, TWO), (2, f"{ONE} {TWO}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.row.doc_id: r.token_ids for r in bpe.bpe_encode(docs, PATH).collect()}
    expected = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert got == expected
    encode = token_files.LibraryEncoder(PATH)
    assert [x.tolist() for x in encode([t for _, t in rows])] == list(expected.values())


def test_pre_tokens_need_no_encoding_each(monkeypatch):
    """Plain words go to the library's model itself; only what the tables of characters do not
    reach is encoded as a text."""
    library = Tokenizer.from_file(PATH)
    texts = ["The cat, the CAT!! 12ab", "ÜBER straße ГОСТ βήτα -- ~`^|", "it's 中文", "",
             "x<|endoftext|>y", "z" * 500]
    asked = []
    encode = token_files.LibraryEncoder(PATH)
    whole = encode._encode
    monkeypatch.setattr(token_files.LibraryEncoder, "_encode",
                        lambda self, batch: asked.extend(batch) or whole(batch))
    encode.memory = type(encode.memory)(getattr(encode, "_words", encode._encode))
    got = [x.tolist() for x in encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted([texts[2], texts[4]])
    encode.direct = False  # a file that does more to a word before its model
    encode.memory.clear()
    assert [x.tolist() for x in encode(texts)] == got


def test_words_that_come_in_any_order_are_remembered():
    asked = []
    memory = Memory(lambda words: asked.extend(words) or [[ord(c) for c in w] for w in words])
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(400)]
    for _ in range(3):
        for part in np.array_split(rng.permutation(words), 20):
            text = " ".join(part)
            assert encode_plain([text], memory)[0].tolist() \
                == [ord(c) for c in text if c != " "]
    assert len(asked) == len(set(words))


def test_a_shared_hash_is_not_taken_for_the_same_word(monkeypatch):
    monkeypatch.setattr(_text.Rolling, "of",
                        lambda self, a, b: (b - a).astype(np.uint64))  # words of one length
    memory = Memory(lambda words: [[ord(c) for c in w] for w in words])
    texts = ["abc abc xy", "abd xy", "xy abc", "xz", "abd"]
    first = encode_plain(texts, memory)
    assert [None if x is None else "".join(map(chr, x)) for x in first] \
        == ["abcabcxy", None, "xyabc", None, None]
    again = encode_plain(["abd abd", "abc"], memory)
    assert again[0] is None and again[1].tolist() == [97, 98, 99]


def test_documents_of_words_that_collided(spark):
    pairs = [thue_morse(chr(97 + i // 12), chr(109 + i % 12)) for i in range(60)]

    def text(k):
        return " ".join(pair[k] for pair in pairs)

    docs = spark.createDataFrame([(0, text(0)), (1, text(1)), (2, "a b " * 9)],
                                 "doc_id long, text string")
    near = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert near == {0: 0, 1: 1, 2: 2}
    kept = {r.doc_id: r.spans for r in fm_index.substring_dedup(docs).collect()}
    assert not kept[1]
    both = " ".join([ONE, "c", "d", "e", "f", TWO, "c", "d", "e", "f"])
    rows = spark.createDataFrame([(0, both, "h")], "doc_id long, text string, source string")
    assert quality.quality_rules(rows).first().n_repeat_words == 0


@pytest.mark.parametrize("module,run,unit", [(fm_index, "substring_dedup", "words"),
                                             (r_index, "byte_dedup", "bytes")])
def test_repeated_rows_keep_their_text(spark, module, run, unit):
    rng = random.Random(8)
    words = [f"q{rng.randrange(10 ** 6)}" for _ in range(120)]
    half = " ".join(words[:60]) + " " + " ".join(f"z{i}" for i in range(60))
    once = [(1, " ".join(words)), (2, half), (None, " ".join(words[:40]))]

    def removed(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        return sorted((r.doc_id is None, r.doc_id, [(s["start"], s["end"]) for s in r.spans])
                      for r in getattr(module, run)(docs).collect())

    single = removed(once)
    assert removed(once * 2) == sorted(single * 2)
    spans = {i: s for _, i, s in single}
    # the row without an id is the earliest; 1 loses what it has of it, 2 what 1 has
    assert spans[None] == [] and len(spans[1]) == 1 and len(spans[2]) == 1
    assert removed([(1, once[0][1])] * 40) == [(False, 1, [])] * 40
