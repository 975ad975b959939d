"""Quality rules: Viterbi decoding of a linear-chain conditional random field over lines.

Each line with a word is marked content or boilerplate; a document is kept when enough of its
words are in content lines. Lines show their shares of capitals, digits, symbols, bars and
exclamation marks, their length, their words' length, and whether an earlier line is the same.
Weights and transitions are fitted on the lines of a bounded sample of ``labels`` (about
``docs_per_class`` documents of each quality), whose lines get labels of their own in ``learn``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain as chained

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .crf import Chain, fit
from .wordbpe import batches

#: The contract's symbols and white space.
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
_BLANK = SPACES.decode()
#: Classes of characters; what lies above the table counts as a small letter.
UPPER, LOWER, DIGIT, SYMBOL, BAR, MARK, OTHER, SPACE = range(8)


def _classes() -> np.ndarray:
    out = np.full(0x3000, OTHER, np.uint8)
    for i in range(len(out)):
        c = chr(i)
        out[i] = UPPER if c.isupper() else LOWER if c.isalpha() else DIGIT if c.isdigit() else OTHER
    for chars, kind in ((SYMBOLS, SYMBOL), (b"|", BAR), (b"!", MARK), (SPACES, SPACE)):
        out[list(chars)] = kind
    out[-1] = LOWER
    return out


_CLASSES = _classes()
#: Edges of the bins of each measure of a line; a bin is a feature.
_EDGES = {
    "upper": [0.0001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9],
    "digit": [0.0001, 0.02, 0.1, 0.25, 0.5, 0.8],
    "symbol": [0.0001, 0.05, 0.2, 0.5, 1.0, 2.0, 3.0],
    "bar": [0.0001, 0.05, 0.2, 0.4, 0.6],
    "mark": [0.0001, 0.05, 0.2, 0.5, 1.0, 1.8],
    "length": [2, 3, 4, 5, 6, 7, 9, 12, 20],
    "words": [2, 4, 8, 16, 32, 64, 128],
}
_FIRST = dict(zip(_EDGES, np.cumsum([0, *(len(e) + 1 for e in _EDGES.values())]).tolist()))
_SAME = _FIRST["words"] + len(_EDGES["words"]) + 1
N_FEATURES = _SAME + 2
FEATURES_PER_LINE = len(_EDGES) + 1


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines with a word, in order: feature ids (a row each), words, and the text they are in."""
    lines = [t.split("\n") for t in texts]
    of = np.repeat(np.arange(len(texts)), [len(x) for x in lines])
    c = np.frombuffer("\n".join(chained.from_iterable(lines)).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", np.uint32)
    kind = _CLASSES[np.minimum(c, len(_CLASSES) - 1)]
    starts = np.append(0, np.flatnonzero(c == 10)[:-1] + 1)
    blank = kind == SPACE
    n_words = np.add.reduceat((~blank & np.append(True, blank[:-1])).astype(np.int32), starts)
    count = {k: np.add.reduceat((kind == k).astype(np.int32), starts) for k in range(SPACE)}
    same = np.zeros(len(of), bool)
    at = 0
    for own in lines:
        if len(own) > 1:
            seen: set[str] = set()
            for i, line in enumerate(own):
                if line in seen:
                    same[at + i] = True
                else:
                    seen.add(line)
        at += len(own)
    keep = n_words > 0
    words, of = n_words[keep].astype(np.int64), of[keep]
    count = {k: v[keep] for k, v in count.items()}
    letters = np.maximum(1, count[UPPER] + count[LOWER])
    chars = sum(count.values())
    measures = {"upper": count[UPPER] / letters, "digit": count[DIGIT] / chars, "symbol": (count[SYMBOL] + count[BAR]) / words, "bar": count[BAR] / words, "mark": count[MARK] / words, "length": chars / words, "words": words}
    ids = [_FIRST[k] + np.searchsorted(_EDGES[k], measures[k], "right") for k in _EDGES]
    return np.stack([*ids, _SAME + same[keep]], 1), words, of


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five words that come up twice or more, the first time included."""
    n = len(words) - 4
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(5):
        mixed = (mixed ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(mixed, twice))
    windows = [tuple(words[i : i + 5]) for i in at.tolist()]
    times = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int32)
    at = at[[times[w] > 1 for w in windows]]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + 5, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = len(data) - len(data.translate(None, SPACES))
    lines = [x for x in text.split("\n") if x and x.strip(_BLANK)]
    return len(words), len(text) - blanks, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


@dataclass
class Model:
    weights: np.ndarray
    chain: Chain


def learn(sample: list[tuple[str, int]], steps: int = 60, rounds: int = 4, settled: float = 0.002, keep_good: float = 0.995) -> Model | None:
    """A model of (text, quality) rows; None when they do not hold both qualities.

    Only documents have a label, so lines get theirs in two steps. First the lines of good and of
    bad documents are contrasted one by one, without transitions: a line is boilerplate if its
    measures are found more in bad documents, and plain prose in a bad document is content. Then
    the field is fitted on these labels, decodes the same documents, and is fitted again on what
    it decoded, until at most ``settled`` of the lines change. As a good document lost costs more
    than a bad one kept, content lines get the least bonus at which ``keep_good`` of the sample's
    good documents have most of their words in content lines.
    """
    sample = [(t, q) for t, q in sample if t]
    if len({q for _, q in sample}) < 2:
        return None
    ids, _, of = line_features([t for t, _ in sample])
    doc = np.array([1 - q for _, q in sample])[of]
    # a few lines of the long documents repeat their type only
    types, items = np.unique(ids, axis=0, return_inverse=True)
    owner, items = np.repeat(np.arange(len(types)), types.shape[1]), items.ravel()
    first = np.diff(of, prepend=-1) != 0
    ends = np.searchsorted(of, np.arange(len(sample) + 1)).tolist()

    def fitted(labels: np.ndarray, starts: np.ndarray) -> Model:
        return Model(*fit(types.ravel(), owner, N_FEATURES, items, labels, starts, 2, steps=steps, decay=1e-3))

    alone = fitted(doc, np.ones(len(items), bool))
    score = alone.weights[ids].sum(1) + alone.chain.start
    labels = (score[:, 1] > score[:, 0]).astype(np.int64)
    for _ in range(rounds):
        model = fitted(labels, first)
        rows = model.weights[ids].sum(1).tolist()
        decoded = np.array(list(chained.from_iterable(model.chain.viterbi(rows[a:b]) for a, b in zip(ends, ends[1:]) if a < b)))
        changed, labels = (decoded != labels).mean(), decoded
        if changed <= settled:
            break
    good = [t for t, q in sample if q == 1]
    for bonus in (0.0, 0.25, 0.5, 1.0, 2.0, 4.0):
        lenient = Model(model.weights + np.array([bonus / FEATURES_PER_LINE, 0.0]), model.chain)
        if (content_shares(good, lenient) >= 0.5).mean() >= keep_good:
            break
    return lenient


def content_shares(texts: list[str], model: Model) -> np.ndarray:
    """The share of each text's words in lines that are marked content; 0 without words."""
    ids, words, of = line_features(texts)
    score = model.weights[ids].sum(1)
    inside = np.zeros(len(texts))
    ends = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
    total = np.bincount(of, words, len(texts))
    rows = score.tolist()
    for i in range(len(texts)):
        a, b = ends[i], ends[i + 1]
        if a < b:
            marks = np.array(model.chain.viterbi(rows[a:b]))
            inside[i] = words[a:b][marks == 0].sum()
    return inside / np.maximum(total, 1)


def training_sample(docs: DataFrame, labels: DataFrame, docs_per_class: int = 600, most_chars: int = 20_000) -> list[tuple[str, int]]:
    """About ``docs_per_class`` (text, quality) rows of each quality, drawn by a hash of doc_id; equal rows count as one.

    A text gives its first ``most_chars`` characters. At most four times ``docs_per_class`` rows
    reach the driver, whatever repeats in either table; rows without a doc_id have no label.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    share = [min(1.0, docs_per_class / max(1, counts.get(q, 0))) for q in (0, 1)]
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 20)) / (1 << 20)
    drawn = known.where(draw < F.when(F.col("quality") == 0, share[0]).otherwise(share[1])).select(F.col("doc_id").cast("long"), "quality")
    # at most twice the expected 1,200 ids, whatever the size of the table and however often an id repeats
    drawn = F.broadcast(drawn.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(4 * docs_per_class))
    number = F.xxhash64("doc_id", "text", F.lit(31))
    found = docs.select(F.col("doc_id").cast("long"), F.substring("text", 1, most_chars).alias("text")).join(drawn, "doc_id").withColumn("number", number)
    found = found.dropDuplicates(["number", "quality"]).orderBy("number", "quality").limit(4 * docs_per_class)
    return sorted((r.text, r.quality) for r in found.where("text is not null").select("text", "quality").collect())


COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double"


def measure(docs: DataFrame, model: Model | None) -> DataFrame:
    """The counts of every row and the share of its words in content lines (1 without a model).

    Null text has no words. Rows with the same doc_id stay apart.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [t or "" for t in frame.column(1).to_pylist()]
            counts = [base_counts(t) for t in texts]
            share = np.ones(len(texts))
            if model is not None:
                for a, b in batches(texts):
                    share[a:b] = content_shares(texts[a:b], model)
            columns = list(zip(*counts)) or [()] * 5
            yield pa.RecordBatch.from_arrays([frame.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(share)], [c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COLUMNS)


def verdicts(docs: DataFrame, model: Model | None, least_share: float = 0.5) -> DataFrame:
    """``measure`` with base_failed and kept."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measure(docs, model).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= least_share))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(training_sample(docs, table(spark, sf_dir, "labels")))
    return verdicts(docs, model)


def kept(docs: DataFrame, model: Model | None, least_share: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that ``verdicts`` keeps."""
    schema, at = docs.schema, docs.columns.index("text")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [t or "" for t in frame.column(at).to_pylist()]
            keep = np.ones(len(texts), bool)
            for a, b in batches(texts):
                if model is not None:
                    keep[a:b] = content_shares(texts[a:b], model) >= least_share
            for i in np.flatnonzero(keep):
                n, _, _, _, repeated = base_counts(texts[i])
                keep[i] = n >= 10 and 100 * repeated <= 20 * n
            yield frame.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
