"""Language identification of code-switched text by a linear-chain conditional random field.

Every word is labelled with a language. A word's features are its affixes, the n-grams of its
letters and the word itself as a lexicon entry, hashed to a table of weights; transitions
between languages are learned too. Forward-backward gives each word's posterior, and a
document's language is the one with the largest mean over its words.

The model is fitted on a bounded sample of the documents that are not held out: about
``docs_per_lang`` of each language, of each its first ``most_chars`` characters, in passages in
mixed order up to ``most_words`` words. Training sequences are spliced from passages of different
documents, so that transitions see the languages change. Prediction reads every whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain as chained

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, table
from .crf import Chain, fit
from .wordbpe import _Numbered, batches

BITS = 16


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of words, the word of each, and which words have a letter."""
    # letters only, in lower case; a blank before and behind each word
    bare = [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in words]
    text = " " + " ".join(bare).lower() + " "
    if len(text.split()) != sum(map(bool, bare)) or text.count(" ") != len(words) + 1:
        text = " " + " ".join("".join(filter(str.isalpha, b.lower())) for b in bare) + " "
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    gap = c == 32
    of = np.cumsum(gap) - 1
    mul = np.uint64(0x9E3779B97F4A7C15)

    def mixed(kind: int, *codes: np.ndarray) -> np.ndarray:
        h = np.full(len(codes[0]), kind, np.uint64)
        for x in codes:
            h = (h ^ x) * mul
            h ^= h >> np.uint64(29)
        return h >> np.uint64(64 - BITS)

    inside = ~gap
    hashes, owners = [], []

    def add(at: np.ndarray, h: np.ndarray) -> None:
        hashes.append(h)
        owners.append(of[at])

    one = np.flatnonzero(inside)
    add(one, mixed(1, c[one]))
    two = np.flatnonzero(inside[:-1] & inside[1:])
    add(two, mixed(2, c[two], c[two + 1]))
    mid = np.flatnonzero(inside[1:-1]) + 1  # trigrams, those with a blank are the short affixes
    add(mid, mixed(3, c[mid - 1], c[mid], c[mid + 1]))
    if len(c) > 3:
        head = np.flatnonzero(gap[:-3] & inside[1:-2] & inside[2:-1] & inside[3:])
        add(head + 1, mixed(4, c[head + 1], c[head + 2], c[head + 3]))
        tail = np.flatnonzero(inside[:-3] & inside[1:-2] & inside[2:-1] & gap[3:])
        add(tail, mixed(5, c[tail], c[tail + 1], c[tail + 2]))
    starts = np.flatnonzero(gap)[:-1]
    with np.errstate(over="ignore"):
        place = np.arange(len(c), dtype=np.int64) - starts[np.minimum(of, len(starts) - 1)]
        whole = np.add.reduceat(np.where(inside, (c + np.uint64(7)) * mul ** (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)), np.uint64(0)), starts) if len(starts) else c[:0]
    letters = np.add.reduceat(inside.astype(np.int64), starts) > 0 if len(starts) else np.zeros(0, bool)
    has = np.flatnonzero(letters)
    hashes.append(mixed(6, whole[has]))
    owners.append(has)
    return np.concatenate(hashes).astype(np.int64), np.concatenate(owners), letters


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray
    chain: Chain
    key: str


class Scorer:
    """Word scores of one model, looked up once for each distinct word; a full cache is dropped."""

    def __init__(self, model: Model, cache_words: int = 150_000):
        self.model, self.cache_words = model, cache_words
        self._drop()

    def _drop(self) -> None:
        k = len(self.model.langs)
        self.words, self.n = _Numbered(), 0
        self.scores, self.letters = np.zeros((1 << 14, k), np.float32), np.zeros(1 << 14, bool)

    def _learn(self) -> None:
        new, self.words.pending = self.words.pending, []
        if not new:
            return
        while self.n + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        for a in range(0, len(new), 50_000):
            part = new[a : a + 50_000]
            hashes, owner, letters = word_features(part)
            at = slice(self.n, self.n + len(part))
            # per word the mean of few and the sum of many features would differ by length: divide by the root of their number
            count = np.maximum(1, np.bincount(owner, minlength=len(part)))
            for j in range(self.scores.shape[1]):
                self.scores[at, j] = np.bincount(owner, self.model.weights[hashes, j], len(part)) / np.sqrt(count)
            self.letters[at] = letters
            self.n += len(part)

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the mean posterior of its words with letters, and the number of these."""
        if len(self.words) > self.cache_words:
            self._drop()
        split = [t.split() for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.words.__getitem__, chained.from_iterable(split)), np.int64, int(lengths.sum()))
        self._learn()
        used = self.letters[at]
        of = np.repeat(np.arange(len(texts)), lengths)[used]
        at = at[used]
        post = self.model.chain.marginals(self.scores[at], np.diff(of, prepend=-1) != 0)
        n = np.bincount(of, minlength=len(texts))
        total = np.stack([np.bincount(of, post[:, j], len(texts)) for j in range(post.shape[1])], 1)
        return total / np.maximum(n, 1)[:, None], n


def learn(sample: list[tuple[str, str]], *, passage: int = 60, most_words: int = 160_000, steps: int = 18, seed: int = 1) -> Model:
    """A model of (text, lang) rows: passages of about ``passage`` words follow each other in mixed order."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in sample})
    numbered, passages = _Numbered(), []
    for text, lang in sample:
        words = text.split()
        at = 0
        while at < len(words):
            size = 1 + int(rng.exponential(passage))
            passages.append((langs.index(lang), words[at : at + size]))
            at += size
    order, total, items, labels, first = rng.permutation(len(passages)), 0, [], [], []
    for n, i in enumerate(order):
        lang, words = passages[i]
        if total >= most_words:
            break
        items += [numbered[w] for w in words]
        labels += [lang] * len(words)
        # about four passages make a sequence
        first += [n % 4 == 0] + [False] * (len(words) - 1)
        total += len(words)
    items, labels, first = np.array(items, np.int64), np.array(labels, np.int64), np.array(first, bool)
    hashes, owner, letters = word_features(list(numbered))
    keep = letters[items]
    opened = np.cumsum(first)[keep]
    items, labels = items[keep], labels[keep]
    count = np.maximum(1, np.bincount(owner, minlength=len(letters)))
    weights, chain = fit(hashes, owner, 1 << BITS, items, labels, np.diff(opened, prepend=0) != 0, len(langs), steps=steps, values=(1 / np.sqrt(count))[owner])
    return Model(langs, weights, chain, hashlib.md5(weights.tobytes() + repr((langs, chain)).encode()).hexdigest())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, docs_per_lang: int = 300, most_chars: int = 20_000) -> list[tuple[str, str]]:
    """About ``docs_per_lang`` (text, lang) rows of each language, held-out rows left out.

    They are drawn by a hash of doc_id and text, equal rows as one; a text gives its first
    ``most_chars`` characters. At most twice the wanted number of rows reaches the driver, whatever
    repeats.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.create_map(*chained.from_iterable((F.lit(k), F.lit(min(1.0, docs_per_lang / n))) for k, n in sorted(counts.items())))
    number = F.xxhash64("doc_id", "text", F.lit(23))
    drawn = known.where(F.pmod(number, F.lit(1 << 20)) / (1 << 20) < share[F.col("lang")]).select("lang", number.alias("number"), F.substring("text", 1, most_chars).alias("text"))
    drawn = drawn.dropDuplicates(["lang", "number"]).orderBy("number", "lang").limit(2 * docs_per_lang * len(counts))
    return sorted((r.text, r.lang) for r in drawn.collect())


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row; ``und`` and 0 for a text that is null or has no letter.

    Without a model (no document to learn from) every text is ``und``. Rows with the same doc_id
    stay apart; columns besides doc_id and text play no part.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(("scorer", model.key), lambda: Scorer(model)) if model is not None else None
        for frame in frames:
            texts = [t or "" for t in frame.column(1).to_pylist()]
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            if model is not None:
                for a, b in batches(texts):
                    mean, n = scorer.posteriors(texts[a:b])
                    best = mean.argmax(1)
                    for i in np.flatnonzero(n):
                        pred[a + i] = model.langs[best[i]]
                    score[a:b] = np.clip(mean.max(1), 0, 1) * (n > 0)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def fitted(docs: DataFrame) -> Model | None:
    sample = training_sample(docs)
    return learn(sample) if sample else None


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fitted(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: Model | None, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a score of ``least_score`` or more.

    ``lang``, if there as a string, becomes that language. Texts without a letter, null texts and
    those in which no language has most of the words go; without a model no language is known and
    all texts with a letter stay as they are.
    """
    schema, at = docs.schema, docs.columns.index("text")
    lang = docs.columns.index("lang") if dict(docs.dtypes).get("lang") == "string" else None

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(("scorer", model.key), lambda: Scorer(model)) if model is not None else None
        for frame in frames:
            texts = [t or "" for t in frame.column(at).to_pylist()]
            keep, best = np.zeros(len(texts), bool), np.zeros(len(texts), np.int64)
            for a, b in batches(texts):
                if model is None:
                    keep[a:b] = [any(map(str.isalpha, t)) for t in texts[a:b]]
                else:
                    mean, n = scorer.posteriors(texts[a:b])
                    keep[a:b], best[a:b] = (n > 0) & (mean.max(1) >= least_score), mean.argmax(1)
            if model is not None and lang is not None:
                frame = frame.set_column(lang, frame.schema.field(lang), pa.array([model.langs[i] for i in best], frame.schema.field(lang).type))
            yield frame.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
