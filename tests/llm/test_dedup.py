"""Near, line and substring dedup against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crease.llm import fm_index, lines, minhash, r_index
from crease.llm.components import components
from crease.llm.suffixes import Suffixes

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = SPACED.findall(text.translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def linked_groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    low = {i: i for i in texts}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(texts)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * len(sets[i] | sets[j]):
                    a, b = root(i), root(j)
                    low[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_near_duplicates_equal_brute_force(corpus):
    docs, texts = corpus
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash.near_duplicates(docs).collect()}
    assert got == linked_groups(texts)
    assert sum(not kept for _, _, kept in got.values()) >= 6


def test_chain_of_near_copies_is_one_group(spark):
    """Ends of a chain are no link themselves; members in between join them."""
    words = [f"a{i}" for i in range(200)]
    rows = []
    for step in range(12):
        rows.append((step, " ".join(words)))
        for k in range(3):
            words[step * 15 + k * 5] = f"n{step}.{k}"
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = linked_groups(dict(rows))
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == expected
    assert {c for _, c, _ in expected.values()} == {0}


def test_one_of_each_group_stays_with_all_columns(corpus):
    docs, texts = corpus
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        i for i, (_, _, kept) in linked_groups(texts).items() if kept)


def test_of_rows_that_repeat_id_and_text_the_smallest_stays(spark):
    rows = [(1, "same text", lang, source) for lang, source in
            (("b", "x"), ("a", "z"), (None, "y"), ("a", "c"), (None, "k"))]
    for n in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        assert [tuple(r) for r in minhash.one_of_each(docs.repartition(n)).collect()] \
            == [(1, "same text", None, "k")]


def test_signature_coordinates_are_shifts_of_one_permutation():
    circle = minhash._circle(128)
    assert (circle[5, 1:] == circle[6, :-1]).all()
    assert (circle[minhash.SLOTS - 1, 1] == circle[0, 0]).all()
    one = np.arange(1, 400, dtype=np.uint64)
    assert (minhash.signature(one, 128) == minhash.signature(one[::-1].copy(), 128)).all()
    two = np.arange(40, 440, dtype=np.uint64)
    same = (minhash.signature(one, 128) == minhash.signature(two, 128)).mean()
    assert abs(same - 360 / 439) < 0.15


def test_components_of_a_path_and_a_star(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    edges = spark.createDataFrame(rows, "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(edges.where("a > 1000")).count() == 0


def removed_lines(texts):
    whole, variants, out = set(), {}, {}
    for i in sorted(texts):
        kept, body = [], texts[i].split("\n")
        for line in body:
            words = tuple(SPACED.findall(line))
            if len(words) < 5:
                if not words or words not in whole:
                    kept.append(line)
                whole.add(words)
                continue
            without = [words[:j] + words[j + 1:] for j in range(len(words))]
            seen = words in whole or words in variants or any(
                (v in whole and len(v) >= 5) or j in variants.get(v, ())
                for j, v in enumerate(without))
            whole.add(words)
            for j, v in enumerate(without):
                variants.setdefault(v, set()).add(j)
            if not seen:
                kept.append(line)
        out[i] = (len(body), len(body) - len(kept), "\n".join(kept))
    return out


def test_lines_equal_brute_force(spark, corpus):
    docs, texts = corpus
    more = {200: "a b c d e f\na b c d e g", 201: "x b c d e f\na b c d e\nq\nq",
            202: "a b c d f\n\na b c z d e f", 203: "p q r s t u\np q r s u t",
            204: "b c d e f a\n a  b c d e f ", 205: "k l\n k\tl \n\nk l m",
            206: "s t u v\ns t u v w\ns t u\n\n  \nk l"}
    extra = spark.createDataFrame(list(more.items()), "doc_id long, text string")
    got = lines.line_dedup(docs.select("doc_id", "text").unionByName(extra))
    assert {r.row.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in got.collect()} \
        == removed_lines(texts | more)


def test_lines_run_without_python(corpus):
    plan = lines.line_dedup(corpus[0])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_template_with_many_words_needs_no_pairs(spark):
    """Lines that differ in one word meet in one key; only the earliest stays."""
    rows = [(i, f"name {i} has signed the form") for i in range(3000)]
    got = lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.row.doc_id for r in got.where("n_removed = 0").collect()] == [0]


def repeated_ranges(parts, window):
    """Covered flags per document, in order of the ids."""
    seen, out = set(), {}
    for i, part in parts:
        flags = [False] * len(part)
        for at in range(len(part) - window + 1):
            key = tuple(part[at:at + window])
            if key in seen:
                flags[at:at + window] = [True] * window
            seen.add(key)
        out[i] = flags
    return out


def spans_of(flags):
    out = []
    for at, flag in enumerate(flags):
        if flag and (at == 0 or not flags[at - 1]):
            out.append([at, at])
        if flag:
            out[-1][1] = at + 1
    return [tuple(x) for x in out]


@pytest.mark.parametrize("hot", [256, 1])
def test_word_windows_equal_brute_force(corpus, hot):
    docs, texts = corpus
    parts = [(i, t.encode().split()) for i, t in sorted(texts.items())]
    flags = repeated_ranges(parts, 20)
    got = {r.doc_id: r for r in fm_index.substring_dedup(docs, hot=hot).collect()}
    assert sorted(got) == sorted(texts)
    for i, words in parts:
        assert [(s.start, s.end) for s in got[i].spans] == spans_of(flags[i])
        assert got[i].n_words == len(words)
        assert got[i].kept_text.encode() == b" ".join(
            w for w, f in zip(words, flags[i], strict=True) if not f)


@pytest.mark.parametrize("hot", [256, 1])
def test_byte_windows_equal_brute_force(corpus, hot):
    docs, texts = corpus
    parts = [(i, t.encode()) for i, t in sorted(texts.items())]
    flags = repeated_ranges(parts, 100)
    got = {r.doc_id: r for r in r_index.byte_dedup(docs, hot=hot).collect()}
    for i, raw in parts:
        assert [(s.start, s.end) for s in got[i].spans] == spans_of(flags[i])
        assert got[i].n_bytes == len(raw)
        assert bytes(got[i].kept) == bytes(
            b for b, f in zip(raw, flags[i], strict=True) if not f)


@pytest.mark.parametrize("index", [fm_index.FMIndex, r_index.RunIndex])
def test_index_steps_enumerate_all_suffixes(index):
    rng = np.random.default_rng(5)
    text = np.concatenate([rng.integers(2, 6, 300), [0], np.tile([2, 3, 2], 80), [1]])
    built = index(text, 8)
    order = Suffixes(text).order
    assert [list(text[p:]) for p in order] == sorted(list(text[p:]) for p in range(len(text)))
    row_of = np.empty(len(text), np.int64)
    row_of[order] = np.arange(len(text))
    at = np.array([i for i in range(len(text) - 1) if text[i] > 1 and text[i + 1] > 1])
    assert (built.step(text[at], row_of[at + 1]) == row_of[at]).all()
    shared = {}
    for p in at[at < len(text) - 9]:
        if (text[p:p + 8] > 1).all():
            shared.setdefault(tuple(text[p:p + 8]), set()).add(int(built.intervals.of(row_of[p])))
    assert all(len(x) == 1 for x in shared.values())
    assert len({min(x) for x in shared.values()}) == len(shared)


def test_a_document_longer_than_a_pass(spark, monkeypatch):
    """Windows across the cuts of a long document are neither lost nor doubled."""
    from crease.llm import _repeats

    monkeypatch.setattr(_repeats, "PASS", 500)
    rng = random.Random(3)
    base = [f"k{rng.randrange(900)}" for _ in range(3000)]
    texts = {0: " ".join(base), 1: " ".join(base[700:2600] + ["z"] + base[100:900])}
    symbols = _repeats.SpacedWords()
    found = {}
    for i, text in texts.items():
        raw = np.frombuffer(text.encode(), np.uint8)
        for values, bounds, _, first in symbols.sequences(raw, np.array([0, len(raw)])):
            seq = _repeats.Sequence(values, bounds, 20, 4)
            begin, n, key, digest = seq.pieces()
            part = np.searchsorted(bounds, begin, side="right") - 1
            at = begin - bounds[part] + first[part]
            for a, k in zip(at.tolist(), n.tolist(), strict=True):
                for x in range(a, a + k):
                    assert (i, x) not in found
                    found[i, x] = True
    assert len(found) == sum(len(t.split()) - 19 for t in texts.values())


def byte_pieces(texts):
    """``(text, first window, windows, key, digest)`` of the pieces of byte strings."""
    from crease.llm import _repeats

    symbols = _repeats.Bytes()
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    for values, bounds, doc, first in symbols.sequences(raw, offsets):
        seq = _repeats.Sequence(values, bounds, symbols.window, symbols.gram, symbols.halves)
        begin, n, key, digest = (x.tolist() for x in seq.pieces())
        for a, *rest in zip(begin, n, key, digest, strict=True):
            part = int(np.searchsorted(bounds, a, side="right")) - 1
            yield int(doc[part]), a - int(bounds[part]) + int(first[part]), *rest


def test_a_phrase_before_many_texts_is_no_key_of_their_pieces():
    rng = np.random.default_rng(11)
    phrase = b"as was said above and will be said"
    texts = [rng.bytes(150) + phrase + rng.bytes(150) for _ in range(400)]
    kinds = {}
    for _, _, _, key, digest in byte_pieces(texts):
        kinds.setdefault(key, set()).add(digest)
    assert max(map(len, kinds.values())) == 1


def test_equal_byte_windows_meet_under_one_key():
    rng = np.random.default_rng(12)
    base = rng.integers(97, 99, 4000, np.uint8).tobytes()  # two letters: many equal grams
    texts = [base[rng.integers(0, 1000):][:rng.integers(90, 3000)] for _ in range(20)]
    texts += [b"a" * 400, b"ab" * 200, b"", b"x" * 100, b"x" * 99]
    key_of, seen = {}, set()
    for doc, begin, n, key, _ in byte_pieces(texts):
        for at in range(begin, begin + n):
            assert (doc, at) not in seen
            seen.add((doc, at))
            assert key_of.setdefault(texts[doc][at:at + 100], key) == key
    assert len(seen) == sum(max(0, len(t) - 99) for t in texts)


def test_repeated_and_missing_ids(repeats):
    near = minhash.near_duplicates(repeats).collect()
    assert len(near) == 8
    assert sum(r.n_shingles == 0 for r in near) == 3
    assert {r.component_id for r in near if r.n_shingles > 30} == {1}
    assert lines.line_dedup(repeats).count() == 8
    words = fm_index.substring_dedup(repeats).collect()
    by_id = {}
    for r in words:
        by_id.setdefault(r.doc_id, []).append((r.n_words, sum(s.end - s.start for s in r.spans)))
    assert sorted(by_id[None]) == [(0, 0), (40, 0)]  # a NULL id is the earliest
    assert by_id[1] == [(40, 40), (40, 40)]
    assert sorted(by_id[2]) == [(5, 0), (41, 40)]
    assert r_index.byte_dedup(repeats).count() == 8
    kept = minhash.one_of_each(repeats)
    assert kept.where(F.col("doc_id") == 1).count() == 1


@pytest.mark.parametrize("hot", [256, 1])
def test_texts_without_id_are_told_apart_by_more_than_23_bits(spark, hot):
    """Two texts whose CRC-32 is equal in its low 23 bits, both with a NULL id; the
    words and bytes of the first repeat in it, the second has none twice."""
    twice = " ".join(f"r{i}" for i in range(40))
    clean = " ".join(f"c{i}" for i in range(90))
    low = {zlib.crc32(f"{twice} x{i} {twice}".encode()) % (1 << 23): i for i in range(20000)}
    j = next(j for j in range(20000)
             if zlib.crc32(f"{clean} y{j}".encode()) % (1 << 23) in low)
    clean = f"{clean} y{j}"
    i = low[zlib.crc32(clean.encode()) % (1 << 23)]
    other = " ".join(f"r{i}" for i in range(25)) + " z"  # a second kind of piece
    docs = spark.createDataFrame([(None, f"{twice} x{i} {twice}"), (None, clean), (1, other)],
                                 "doc_id long, text string")
    words = {r.kept_text for r in fm_index.substring_dedup(docs, hot=hot).collect()}
    assert words == {f"{twice} x{i}", clean, "z"}
    kept = {bytes(r.kept) for r in r_index.byte_dedup(docs, hot=hot).collect()}
    assert clean.encode() in kept and f"{twice} x{i} ".encode() in kept


def test_empty_tables(nothing):
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.one_of_each(nothing).count() == 0
    assert lines.line_dedup(nothing).count() == 0
    assert fm_index.substring_dedup(nothing).count() == 0
    assert r_index.byte_dedup(nothing).count() == 0
