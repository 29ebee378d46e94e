"""Language of each word and document by a linear-chain conditional random field.

The words of a text (runs of letters, lower-cased) are a chain of labels.  A
word's score for a language sums learned weights of hashed features: its
character n-grams with word-edge marks (the n-grams at the edges are its
prefixes and suffixes) and the word itself (the lexicon).  Learned transition
and start weights join neighbouring words, so a word that is at home in two
languages follows its neighbours, and code-switched text may change label
within a line.  Forward-backward gives each word's label distribution; the runs
of neighbouring words with the same likeliest label are the spans of a language.
A document's language is the one with the largest mean over its words, and that
mean is the score.

A text is one chain, however long.  It is worked off in columns of ``CHAIN``
words: forwards, where only the message at the edge of each column is held, then
backwards, where a column's messages are made again from its edge.

The model is trained on a bounded sample (the first ``sample_chars`` characters of
``per_language`` texts of each language, picked by a hash of id and text, as chains
of ``CHAIN`` words) and sent to the tasks; its size is fixed by ``BUCKETS`` and the
number of languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm import _text
from crease.llm._common import map_batches

BUCKETS = 1 << 18
#: words of one chain in training and of one column in prediction
CHAIN = 64
GRAMS = (2, 3, 4)
UNDETERMINED = "und"

#: spans of words of one language, in characters, end exclusive
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

_LETTER = regex.compile(r"\p{L}")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[ord("a"):ord("z") + 1] = True
_IS_WORD[128:] = True


def _lower(text: str) -> str:
    """Lower case, a character for each character, so that places stay."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in text))


def _lowered(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [_lower(t).encode("utf-8", "replace") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` for ``size[i]`` each, end to end."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of words given by byte ranges, and their ``n + 1`` bounds."""
    size = end - start
    marked = np.full(int((size + 2).sum()), ord("^"), np.uint8)
    begin = np.cumsum(size + 2) - (size + 2)
    marked[_spread(begin + 1, size)] = data[_spread(start, size)]
    marked[begin + size + 1] = ord("$")
    roll = _text.byte_hashes(marked)
    parts, counts = [], []
    for n in GRAMS:
        count = np.maximum(size + 2 - n + 1, 0)
        at = _spread(begin, count)
        parts.append(roll.of(at, at + n))
        counts.append(count)
    parts.append(roll.of(begin, begin + size + 2))
    counts.append(np.ones(len(size), np.int64))
    # lay the features of a word next to each other
    count = np.sum(counts, axis=0) if len(size) else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(bounds[-1], np.int64)
    at = bounds[:-1].copy()
    for part, c in zip(parts, counts, strict=True):
        out[_spread(at, c)] = (part >> np.uint64(46)).astype(np.int64)
        at += c
    return out, bounds


class Chains:
    """Words of documents, for training cut into chains of at most ``CHAIN`` words."""

    def __init__(self, texts: list[str]):
        data, offsets = _lowered(texts)
        words = _text.Words(data, offsets, _IS_WORD)
        self.doc_first = words.first
        self.data, self.offsets, self.start, self.end = data, offsets, words.start, words.end
        # each distinct word is scored once
        _, at, self.kind = np.unique(words.hash, return_index=True, return_inverse=True)
        self.features, self.bounds = features(data, words.start[at], words.end[at])
        counts = words.counts()
        pieces = -(-counts // CHAIN)
        self.doc = np.repeat(np.arange(len(counts)), pieces)
        self.first = _spread(np.zeros(len(counts), np.int64), pieces) * CHAIN \
            + words.first[:-1][self.doc]
        self.length = np.minimum(words.first[1:][self.doc] - self.first, CHAIN)

    def grid(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers, one column per chain, and which of them are there."""
        step = np.arange(CHAIN)[:, None]
        there = step < self.length
        return np.where(there, self.first + step, 0), there


    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word in its document, in characters."""
        # characters begin at every byte that continues none
        before = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        base = np.repeat(before[self.offsets[:-1]], np.diff(self.doc_first))
        return before[self.start] - base, before[self.end] - base


#: distinct words scored at once, and documents labelled at once
WORDS, DOCUMENTS = 4096, 256
#: bytes of text taken at once: few long documents beside each other make short columns
TEXT_BYTES = 2 << 20


def emissions(weights: np.ndarray, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Scores of each distinct word for each language."""
    out = np.empty((len(bounds) - 1, weights.shape[1]))
    for at in range(0, len(out), WORDS):
        cut = bounds[at:at + WORDS + 1]
        total = np.zeros((cut[-1] - cut[0] + 1, weights.shape[1]))
        np.cumsum(weights[found[cut[0]:cut[-1]]], axis=0, out=total[1:])
        out[at:at + WORDS] = total[cut[1:] - cut[0]] - total[cut[:-1] - cut[0]]
    return out


#: words between two scalings of a message.  The likeliest label of each word has weight
#: 1, so a message falls by the least transition weight at most, far from underflow.
SCALE = 8


def _shares(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _forward(local: np.ndarray, prior: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Messages ahead ``[word, chain, label]``, each up to a factor; ``prior`` weighs the
    labels of word 0."""
    ahead = np.empty_like(local)
    now = prior
    for t in range(len(local)):
        now = np.multiply(now @ move if t else now, local[t], out=ahead[t])
        if t % SCALE == 0:
            now /= now.sum(axis=1, keepdims=True)
    return ahead


def _local(score: np.ndarray) -> np.ndarray:
    return np.exp(score - score.max(axis=2, keepdims=True))


def _backward(ahead: np.ndarray, local: np.ndarray, there: np.ndarray, move: np.ndarray,
              back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label distributions and the message back out of word 0; ``back`` comes in after
    the last word, and a word whose follower is not ``there`` is the last of its chain."""
    posterior = np.empty_like(local)
    turned, absent = move.T.copy(), ~there[:, :, None]
    for t in range(len(local) - 1, -1, -1):
        np.multiply(ahead[t], back, out=posterior[t])
        back = (local[t] * back) @ turned
        if t % SCALE == 0:
            back /= back.sum(axis=1, keepdims=True)
        np.copyto(back, 1.0, where=absent[t])
    posterior /= posterior.sum(axis=2, keepdims=True)
    return posterior, back


def forward_backward(score: np.ndarray, there: np.ndarray, start: np.ndarray, step: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Label distributions ``[word, chain, label]`` of scores in the same order, and for
    each pair of labels the expected number of steps between them over all chains."""
    length, n, labels = score.shape
    local, move = _local(score), np.exp(step)
    ahead = _forward(local, np.broadcast_to(np.exp(start), (n, labels)), move)
    posterior, _ = _backward(ahead, local, there, move, np.ones((n, labels)))
    # the shares of a word's labels, dealt to the labels before it
    expected = np.zeros((labels, labels))
    for t in range(length - 1):
        later = posterior[t + 1] / (ahead[t] @ move)
        on = there[t + 1]
        expected += move * (ahead[t][on].T @ later[on])
    return posterior, expected


class Model:
    def __init__(self, labels: list[str]):
        n = len(labels)
        self.labels = labels
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.start = np.zeros(n)
        self.step = np.zeros((n, n))

    @classmethod
    def train(cls, texts: list[str], langs: list[str], rounds: int = 30, rate: float = 0.3,
              shrink: float = 1e-4) -> Model:
        """Maximum likelihood by full gradients with a step size per weight."""
        model = cls(sorted(set(langs)))
        n = len(model.labels)
        if n < 2:
            return model
        chains = Chains(texts)
        gold = np.array([model.labels.index(x) for x in langs])[chains.doc]
        grid, there = chains.grid()
        kinds = chains.kind[grid]
        words = int(there.sum())
        of_feature = np.repeat(np.arange(len(chains.bounds) - 1), np.diff(chains.bounds))
        # every language counts the same, whatever its share of the words
        per = np.bincount(gold, weights=chains.length, minlength=n)
        weight = (words / (n * np.maximum(per, 1)))[gold]
        seen = [np.full((BUCKETS, n), 1e-8), np.full(n, 1e-8), np.full((n, n), 1e-8)]
        for _ in range(rounds):
            each = emissions(model.weights, chains.features, chains.bounds)
            posterior, expected = forward_backward(each[kinds], there, model.start, model.step)
            error = -posterior
            error[:, np.arange(len(gold)), gold] += 1
            error *= there[:, :, None] * weight[:, None] / words
            by_kind = np.stack([np.bincount(kinds.ravel(), error[:, :, k].ravel(), len(each))
                                for k in range(n)], axis=1)
            emit = np.stack([np.bincount(chains.features, by_kind[of_feature, k], BUCKETS)
                             for k in range(n)], axis=1)
            stay = np.bincount(gold, weights=chains.length - 1, minlength=n)
            gradients = [emit - shrink / BUCKETS * model.weights, error[0].sum(0),
                         (np.diag(stay) - expected) / words - 1e-2 * model.step]
            for value, g, s in zip((model.weights, model.start, model.step), gradients, seen,
                                   strict=True):
                s += g * g
                value += rate * g / np.sqrt(s)
        return model

    def label(self, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
        """Per document the sum of its words' label distributions, per word the number
        of its likeliest label."""
        counts = np.diff(chains.doc_first)
        total = np.zeros((len(counts), len(self.labels)))
        likeliest = np.zeros(len(chains.kind), np.int32)
        local = emissions(self.weights, chains.features, chains.bounds)
        local = np.exp(local - local.max(axis=1, keepdims=True))  # of each distinct word
        move = np.exp(self.step)
        # long ones first: the documents of a column are the first of those before it
        order = np.argsort(-counts, kind="stable")
        order = order[:int((counts > 0).sum())]

        for at in range(0, len(order), DOCUMENTS):
            docs = order[at:at + DOCUMENTS]
            count, first = counts[docs], chains.doc_first[:-1][docs]

            def column(j: int, count: np.ndarray = count, first: np.ndarray = first):
                live = int((count > j * CHAIN).sum())
                place = j * CHAIN + np.arange(min(CHAIN, int(count[0]) - j * CHAIN))[:, None]
                there = place < count[:live]
                word = np.where(there, first[:live] + place, first[:live])
                return live, word, there, local[chains.kind[word]]

            columns = -(-int(count[0]) // CHAIN)
            priors = [np.broadcast_to(np.exp(self.start), (len(docs), len(self.labels)))]
            for j in range(columns - 1):
                _, _, _, weights = column(j)
                on = int((count > (j + 1) * CHAIN).sum())
                priors.append(_forward(weights[:, :on], priors[j][:on], move)[-1] @ move)
            back = np.ones((0, len(self.labels)))
            for j in range(columns - 1, -1, -1):
                live, word, there, weights = column(j)
                after = np.ones((live, len(self.labels)))
                after[:len(back)] = back
                found, back = _backward(_forward(weights, priors[j][:live], move), weights,
                                        there, move, after)
                total[docs[:live]] += (found * there[:, :, None]).sum(axis=0)
                likeliest[word[there]] = found.argmax(axis=2)[there]
        return total, likeliest

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, pa.Array]:
        """Language, score and runs of each text."""
        lang = [UNDETERMINED] * len(texts)
        score = np.zeros(len(texts))
        if not self.labels:
            return lang, score, pa.array([[]] * len(texts), RUNS)
        chains = Chains(texts)
        total, likeliest = self.label(chains)
        first = chains.doc_first
        mean = total / np.maximum(np.diff(first), 1)[:, None]
        best = mean.argmax(axis=1)
        judged = np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            if _LETTER.search(text):
                judged[i] = True
                lang[i] = self.labels[best[i]]
                score[i] = min(1.0, float(mean[i, best[i]]))
        # a run begins where the label or the document is another one
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        begins = np.ones(len(doc), bool)
        begins[1:] = (likeliest[1:] != likeliest[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(begins)
        last = np.append(at[1:], len(doc)) - 1
        at, last = at[judged[doc[at]]], last[judged[doc[at]]]
        start, end = chains.places()
        values = pa.StructArray.from_arrays(
            [pa.array(start[at]), pa.array(end[last]),
             pa.array(self.labels, pa.string()).take(pa.array(likeliest[at]))],
            fields=list(RUNS.value_type))
        bounds = np.searchsorted(doc[at], np.arange(len(texts) + 1)).astype(np.int32)
        return lang, score, pa.ListArray.from_arrays(pa.array(bounds), values, type=RUNS)


def held_out(id_col: str) -> F.Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", *, per_language: int = 150, languages: int = 200,
          sample_chars: int = 1 << 16) -> Model:
    """A model from at most ``per_language`` texts, their first ``sample_chars``
    characters, of each of the ``languages`` most frequent languages, among rows that
    are not held out and have text and language.

    The three parameters bound the sample, which is what the driver gets.  The draw
    is by a hash of id and text, so rows without an id are drawn as others are; of rows
    that repeat id, text and language one is drawn."""
    rows = docs.where(~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("draw")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")
    # the bound on languages bounds what the driver gets
    counts = {r.lang: r.m for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("draw").alias("m"))
        .orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return Model([])
    share = F.create_map(*[F.lit(x) for lang, m in sorted(counts.items())
                           for x in (lang, min(1.0, 2.2 * per_language / m))])
    # the same draw in each language: below 1 for about twice the sample
    rows = rows.withColumn("draw", F.struct(
        (F.pmod("draw", F.lit(1 << 30)) / F.lit(1 << 30) / F.try_element_at(share, F.col("lang")))
        .alias("at"), F.col("draw").alias("hash")))
    drawn = rows.where("draw.at < 1").groupBy("lang", "draw").agg(
        F.min(F.substring("text", 1, sample_chars)).alias("text"))
    # cut to the sample in the order of the draw
    sample = drawn.orderBy("draw", "lang").limit(2 * per_language * len(counts)).collect()
    taken: dict[str, list[str]] = {}
    for row in sample:
        texts = taken.setdefault(row.lang, [])
        if len(texts) < per_language:
            texts.append(row.text)
    pairs = [(text, lang) for lang, texts in sorted(taken.items()) for text in texts]
    return Model.train([t for t, _ in pairs], [x for _, x in pairs])


_SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("lang", T.StringType())]))


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``(row, lang_pred, score, runs)``; ``row`` is a struct of all columns of the input
    row, ``runs`` the array of ``(start, end, lang)`` of its spans of one language, in
    characters, end exclusive, from the first letter of a span to its last.

    ``und`` with score 0 and no runs for NULL texts and texts without a letter.  Without
    any labelled text the model has no languages and every text is ``und``;
    with one language every other text is of that language.  Repeated rows are
    judged one by one; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("runs", _SPANS)])

    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.struct_field(batch.column("row"), place).cast(pa.string())
            _, offsets = _text.utf8(text)
            for a, b in _text.groups(offsets, TEXT_BYTES):  # a bounded number of bytes at a time
                part = text.slice(a, b - a).fill_null("").to_pylist()
                langs, scores, runs = sent.value.predict(part)
                yield pa.record_batch({
                    "row": batch.column("row").slice(a, b - a),
                    "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores),
                    "runs": runs})

    return map_batches(rows, run, schema)
