"""Phrase collocations by mergeable Misra-Gries summaries.

An n-gram (1 to 4 words of a piece of text, within a language) is named by a 64-bit hash, and the
hash's leading bits are its partition. First pass: tasks give out, for each partition, a summary of
the n-grams of some millions of words; the summaries of a partition are merged into one of fixed
capacity, which is the partition's mass divided by the threshold, some times over. Each time a summary loses
its smallest counters, at least ``capacity + 1`` times what is taken off goes with them, so in all
less than the threshold is ever taken off one counter: every n-gram that comes up that often survives,
whatever the order of merging. Survivors set bits of a filter of fixed largest size. Second pass: the
n-grams of the texts that meet a bit are counted exactly, by their words; what a summary let through in
error, or the filter by a collision, ends below the threshold there.

Scores, cuts and the test against longer phrases work on the exact counts of frequent n-grams, joined
by their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table
from .scaled_sketch import mixed

LONGEST, LEAST, COVERED, SCALE, TOP = 4, 30, (100, 80), 2_000_000, 2000
#: Characters that end a piece; tabs and spaces separate words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FEED, _SPACE = 10, 32
_PLAIN = bytes.maketrans(_ENDS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * len(_ENDS) + b" abcdefghijklmnopqrstuvwxyz")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: The first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Text bytes of an array of words, n-grams of a summary, bytes of a word hashed by blocks, text bytes of a partition.
_CHUNK, _SUMMARY, _BLOCKS, _PART = 4_000_000, 12_000_000, 64, 16_000_000
#: Times the capacity that the guarantee needs: fewer n-grams below the threshold survive.
_ROOM = 8
#: Bits of the filter: 32 for each survivor, up to 128 MB.
_BITS_EACH, _MOST_BITS = 32, 30


@dataclass
class Words:
    """Words of some whole texts in a row: in ``data`` each stands at ``start``, ``size`` bytes long. Words of one piece
    have the same number ``piece``. ``lang`` is the place of a word's language in ``langs``, which has all of the texts'."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    langs: list[str]

    def phrases(self, first: np.ndarray, n: np.ndarray) -> pa.Array:
        """The ``n`` words from each place ``first`` on, joined by single spaces."""
        word = (self.data != _FEED) & (self.data != _SPACE)
        word[1:] |= word[:-1].copy()  # and the byte behind each
        joined = self.data[word]
        joined[joined == _FEED] = _SPACE
        ends = np.cumsum(self.size + 1)
        start = ends[first] - self.size[first] - 1
        sizes = ends[first + n - 1] - 1 - start
        offsets = np.append(0, np.cumsum(sizes))
        at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(joined[at])])


def words_of(texts: list[bytes], langs: list[str]) -> Words:
    """Lower-cased words of texts, each with its language."""
    data = np.frombuffer((b"\n".join(texts) + b"\n").translate(_PLAIN), np.uint8)
    end = data == _FEED
    edge = np.diff((~end & (data != _SPACE)).view(np.int8), prepend=np.int8(0))
    start = np.flatnonzero(edge == 1)
    behind = np.cumsum([len(t) + 1 for t in texts])
    names = {name: k for k, name in enumerate(dict.fromkeys(langs))}
    lang = np.repeat(np.array([names[x] for x in langs]), np.diff(np.searchsorted(start, behind), prepend=0))
    return Words(data, start, np.flatnonzero(edge == -1) - start, np.cumsum(end, dtype=np.int32)[start], lang, list(names))


def chunks(frames: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The texts' words, whole texts of some megabytes at a time."""
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0
    for frame in frames:
        for text, lang in zip(frame["text"], frame["lang"].to_pylist()):
            texts.append(text.as_py())
            langs.append(lang)
            size += len(texts[-1])
            if size > _CHUNK:
                yield words_of(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield words_of(texts, langs)


def word_hashes(words: Words) -> np.ndarray:
    """64 bits for each word, by blocks of 8 bytes for all words at once; the few long words go one by one."""
    from xxhash import xxh64_intdigest

    data = np.append(words.data, np.zeros(8, np.uint8))
    block = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # the 8 bytes from each byte on
    h = mixed(words.size.astype(np.uint64) * _FACTOR + (block[words.start] & _FIRST[np.minimum(words.size, 8)]))
    for done in range(8, _BLOCKS, 8):
        at = np.flatnonzero(words.size > done)
        h[at] = mixed(h[at] * _FACTOR + (block[words.start[at] + done] & _FIRST[np.minimum(words.size[at] - done, 8)]))
    for k in np.flatnonzero(words.size > _BLOCKS).tolist():
        h[k] = xxh64_intdigest(data[words.start[k] : words.start[k] + words.size[k]].tobytes())
    return h


def ngram_hashes(words: Words, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, starts, hashes) of the n-grams of 1 to ``longest`` words within pieces."""
    from xxhash import xxh64_intdigest

    h = word_hashes(words)
    total = np.array([xxh64_intdigest(name.encode(), 1) for name in words.langs], np.uint64)[words.lang]
    for n in range(1, min(longest, len(h)) + 1):
        size = len(h) - n + 1
        total = total[:size] * _FACTOR + h[n - 1 :]
        starts = np.flatnonzero(words.piece[:size] == words.piece[n - 1 :])
        yield n, starts, mixed(total[starts] + np.uint64(n))


def encoded(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys, as the first and the differences, and their counts: the bytes of each place that some number needs
    stand together. Spark compresses what it moves."""
    numbers = [np.diff(keys, prepend=keys[:1]).astype("<u8"), counts.astype("<u8")]
    used = [(int(x.max(initial=0)).bit_length() + 7) // 8 for x in numbers]
    used[1] = max(1, used[1])
    planes = [x.view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes() for x, n in zip(numbers, used)]
    return b"".join([keys[:1].astype("<u8").tobytes().ljust(8, b"\0"), bytes(used), *planes])


def decoded(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    used = list(data[8:10])
    planes = np.frombuffer(data, np.uint8, offset=10).reshape(sum(used), -1)
    both = []
    for own in (planes[: used[0]], planes[used[0] :]):
        whole = np.zeros((planes.shape[1], 8), np.uint8)
        whole[:, : len(own)] = own.T
        both.append(whole.view("<u8").ravel())
    return np.cumsum(both[0], dtype=np.uint64) + np.frombuffer(data, "<u8", 1), both[1].astype(np.int64)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ascending keys, and how often each stands there."""
    first = np.flatnonzero(np.append(np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))
    return keys[first], np.diff(first, append=len(keys))


def reduced(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A summary of at most ``capacity`` counters: the next largest count is taken off all. Also what was taken off."""
    if len(keys) <= capacity:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    kept = counts > off
    return keys[kept], counts[kept] - off, off


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several summaries' counters together, keys ascending."""
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    if not len(keys):
        return keys, counts
    least, bits = keys.min(), int(counts.max()).bit_length()
    if int(keys.max() - least).bit_length() + bits <= 64:  # key and count fit one number: much faster than an order of places
        both = (keys - least) << np.uint64(bits) | counts.astype(np.uint64)
        both.sort()
        keys, counts = (both >> np.uint64(bits)) + least, (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def summarized(parts: Iterable[tuple[np.ndarray, np.ndarray, int]], least: int, room: int = _ROOM, mass: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """The merged summary of (keys, counts, mass) with a capacity of ``room`` times the whole mass / least, plus one, and
    what at most was taken off a counter: less than least / room. Parts wait until they have more counters than the
    summary may hold, so that merging takes as long for many small parts as for a few large ones."""
    if mass is None:
        parts = list(parts)
        mass = sum(p[2] for p in parts)
    capacity = room * mass // least + 1
    held, off, waiting = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0, 0

    def merge() -> None:
        nonlocal held, off, waiting
        keys, counts, once = reduced(*added(held), capacity)
        held, off, waiting = [(keys, counts)], off + once, 0

    for more in parts:
        held.append(more[:2])
        waiting += len(more[0])
        if waiting > capacity:
            merge()
    merge()
    return *held[0], off


def summaries(rows: DataFrame, parts_log: int, longest: int, key_bits: int, size: int = _SUMMARY) -> DataFrame:
    """(part, mass, data): summaries of the n-grams of runs of texts. A key keeps ``key_bits`` of the hash, as keys that
    collide can only let more survive; they are exact within a run, so nothing is taken off yet."""

    def flush(keys: np.ndarray) -> pa.RecordBatch:
        keys.sort()
        bounds = np.searchsorted(keys, np.arange(1 << parts_log, dtype=np.uint64) << np.uint64(key_bits - parts_log))
        bounds = np.append(bounds, len(keys))
        parts = np.flatnonzero(np.diff(bounds))
        data = [encoded(*counted(keys[bounds[p] : bounds[p + 1]])) for p in parts]
        return pa.RecordBatch.from_arrays([pa.array(parts), pa.array(np.diff(bounds)[parts]), pa.array(data, pa.binary())], ["part", "mass", "data"])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.empty(size, np.uint64), 0
        for words in chunks(frames):
            for _, _, h in ngram_hashes(words, longest):
                h >>= np.uint64(64 - key_bits)
                while len(h):
                    fits = min(len(h), size - n)
                    held[n : n + fits] = h[:fits]
                    n, h = n + fits, h[fits:]
                    if n == size:
                        yield flush(held)
                        n = 0
        yield flush(held[:n])

    return rows.mapInArrow(run, "part long, mass long, data binary")


def partition_bits(spark: SparkSession, text_bytes: int) -> int:
    """Leading bits of a hash that make its partition: 2 partitions for a task or more, some million n-grams each at most."""
    at_least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(math.log2(max(at_least, text_bytes / _PART))))


def survivors(rows: DataFrame, least: int, longest: int, text_bytes: int) -> tuple[DataFrame, int]:
    """(part, keys, n): the keys of all n-grams that may come up ``least`` times, packed by partition; and the bits of a key."""
    parts_log = partition_bits(rows.sparkSession, text_bytes)
    key_bits = min(64, max(parts_log + 8, math.ceil(math.log2(max(2, text_bytes))) + 10))

    def merge(group: pa.Table) -> pa.Table:
        parts = ((*decoded(d.as_py()), m.as_py()) for d, m in zip(group["data"], group["mass"]))
        keys, counts, off = summarized(parts, least, mass=pc.sum(group["mass"]).as_py())
        keys = keys[counts + off >= least]
        return pa.table({"part": group["part"][:1], "keys": pa.array([keys.astype("<u8").tobytes()], pa.binary()), "n": pa.array([len(keys)], pa.int64())})

    found = summaries(rows, parts_log, longest, key_bits).groupBy("part").applyInArrow(merge, "part long, keys binary, n long")
    return stored(found), key_bits


def survivor_filter(found: DataFrame, key_bits: int, bits_each: int = _BITS_EACH, most_bits: int = _MOST_BITS) -> tuple[bytes, int]:
    """A bit for the leading ``bits`` of each survivor's key. It comes to the driver, 2^most_bits bits at most: with more
    survivors than that, more n-grams pass and the exact counts still decide."""
    n = found.agg(F.sum("n").alias("n")).first().n or 0
    bits = min(key_bits, most_bits, max(16, math.ceil(math.log2(max(1, n) * bits_each))))
    cells = 1 << max(0, bits - 19)  # of 2^19 bits, that is 64 KB, each

    def set_bits(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for frame in frames:
            for data in frame["keys"]:
                at = np.frombuffer(data.as_py(), "<u8") >> np.uint64(key_bits - bits)
                cell = (at >> np.uint64(19)).astype(np.int64)
                for c in np.unique(cell).tolist():
                    own = at[cell == c] & np.uint64((1 << 19) - 1)
                    bit = held.setdefault(c, np.zeros(1 << 16, np.uint8))
                    np.bitwise_or.at(bit, (own >> np.uint64(3)).astype(np.int64), np.uint8(1) << (own & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["cell", "data"])

    # a partition is a range of keys, so ranges of partitions have few cells in common
    spread = found.where("n > 0").select("part", "keys").repartitionByRange(F.col("part"))
    whole = np.zeros(cells << 16, np.uint8)
    for r in spread.mapInArrow(set_bits, "cell long, data binary").toLocalIterator():
        whole[r.cell << 16 : (r.cell + 1) << 16] |= np.frombuffer(r.data, np.uint8)
    return whole.tobytes(), bits


class _Counted:
    """N-grams and their counts by 64-bit hash: keys in ascending order with each one's place among the phrases,
    which stand in the order in which they came."""

    def __init__(self) -> None:
        self.keys, self.place, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.phrases: list[pa.Array] = []
        self.langs: list[pa.Array] = []

    def add(self, keys: np.ndarray, counts: np.ndarray, spelled) -> None:
        """Counts of distinct keys; ``spelled`` gives the languages and phrases of those at given places that are new."""
        at = np.searchsorted(self.keys, keys)
        old = at < len(self.keys)
        old[old] = self.keys[at[old]] == keys[old]
        self.counts[self.place[at[old]]] += counts[old]
        new = np.flatnonzero(~old)
        if len(new):
            langs, phrases = spelled(new)
            self.langs.append(langs)
            self.phrases.append(phrases)
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.place = np.insert(self.place, at[new], len(self.counts) + np.arange(len(new)))
            self.counts = np.append(self.counts, counts[new])

    def packed(self, parts_log: int) -> pa.RecordBatch:
        """(part, data): the languages, phrases and counts of each partition of hashes."""
        whole = lambda parts, kind: pa.concat_arrays(parts) if parts else pa.array([], kind)
        batch = pa.RecordBatch.from_arrays([whole(self.langs, pa.string()).dictionary_encode(), whole(self.phrases, pa.binary()), pa.array(self.counts)], ["lang", "phrase", "f"])
        part = (self.keys >> np.uint64(64 - parts_log)).astype(np.int64)
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        stops = np.append(starts[1:], len(part))
        data = [_stream(batch.take(pa.array(self.place[a:b]))) for a, b in zip(starts, stops)]
        return pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array(data, pa.binary())], ["part", "data"])


def _stream(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, the first place of each and how often it stands there."""
    bits = np.uint64(len(keys).bit_length())
    both = keys >> bits << bits | np.arange(len(keys), dtype=np.uint64)  # a key's leading bits and its place: faster than an order of places
    both.sort()
    place = (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = keys[place]
    if (ordered[1:] < ordered[:-1]).any():  # different keys have the same leading bits
        place = np.argsort(keys, kind="stable")
        ordered = keys[place]
    first = np.flatnonzero(np.append(np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]))
    return ordered[first], place[first], np.diff(first, append=len(keys))


def counts_with_words(rows: DataFrame, filter_bits: tuple[bytes, int], least: int, longest: int, text_bytes: int = 0, most: int = 3_000_000) -> DataFrame:
    """(lang, phrase, f): the n-grams of ``least`` occurrences that meet a bit of the filter, counted by their words; with an
    empty phrase, each language's number of words.

    A task hands its counts on once it holds ``most`` n-grams, packed by ranges of hashes; 64 bits tell these apart, and
    their words from then on.
    """
    parts_log = partition_bits(rows.sparkSession, text_bytes)
    shared = rows.sparkSession.sparkContext.broadcast(filter_bits[0])
    bits = filter_bits[1]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counted()
        totals: dict[str, int] = {}
        bit = np.frombuffer(shared.value, np.uint8)
        for words in chunks(frames):
            for name, n in zip(words.langs, np.bincount(words.lang, minlength=len(words.langs)).tolist()):
                totals[name] = totals.get(name, 0) + n
            first, sizes, hashes = [], [], []
            for n, starts, h in ngram_hashes(words, longest):
                at = h >> np.uint64(64 - bits)
                passed = np.flatnonzero((bit[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1))
                first.append(starts[passed])
                sizes.append(np.full(len(passed), n))
                hashes.append(h[passed])
            if not hashes:
                continue
            keys, places, counts = distinct(np.concatenate(hashes))
            start, size = np.concatenate(first)[places], np.concatenate(sizes)[places]

            def spelled(new: np.ndarray) -> tuple[pa.Array, pa.Array]:
                return pa.array(words.langs, pa.string()).take(pa.array(words.lang[start[new]])), words.phrases(start[new], size[new])

            held.add(keys, counts, spelled)
            if len(held.keys) > most:
                yield held.packed(parts_log)
                held = _Counted()
        yield held.packed(parts_log)
        own = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()).dictionary_encode(), pa.array([b""] * len(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], ["lang", "phrase", "f"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([_stream(own)], pa.binary())], ["part", "data"])

    def merge(group: pa.Table) -> pa.Table:
        found = pa.concat_tables([t.set_column(0, "lang", t["lang"].cast(pa.string())) for t in (pa.ipc.open_stream(d.as_buffer()).read_all() for d in group["data"])])
        found = found.group_by(["lang", "phrase"]).aggregate([("f", "sum")]).select(["lang", "phrase", "f_sum"]).rename_columns(["lang", "phrase", "f"])
        return found.filter(pc.or_(pc.equal(pc.binary_length(found["phrase"]), 0), pc.greater_equal(found["f"], least)))

    sums = rows.mapInArrow(run, "part long, data binary").groupBy("part").applyInArrow(merge, "lang string, phrase binary, f long")
    return sums.select("lang", F.col("phrase").cast("string").alias("phrase"), "f")


def exact_counts(rows: DataFrame, filter_bits: tuple[bytes, int], least: int, longest: int, most: int = 3_000_000) -> DataFrame:
    """(lang, phrase, f) of every n-gram of ``least`` occurrences that meets a bit of the filter."""
    return counts_with_words(rows, filter_bits, least, longest, most=most).where("phrase <> ''")


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every n-gram of up to ``longest`` words with ``least`` occurrences, and (lang, n), the words of each language.

    A null lang is ``und``; null and empty texts have no words; an empty table gives no rows. Rows count as often as they stand there.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.cast("binary").alias("text"))
    size = rows.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    found, key_bits = survivors(rows, least, longest, size)
    both = stored(counts_with_words(rows, survivor_filter(found, key_bits), least, longest, size))
    return both.where("phrase <> ''"), both.where("phrase = ''").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: tuple[int, int] = COVERED, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's first ``top`` phrases of 2 to ``longest`` words.

    A phrase's score is that of its lowest-scoring cut in two, scale * a / (l + r) rounded down; a
    phrase within a longer one that holds it ``covered`` (80 of 100) of its times is left out. Ties
    of scores go by a, then by the phrase's bytes. The report's length is the feature; everything
    before it covers all phrases.
    """
    counts, totals = frequent(docs, least, longest)
    words = F.split("phrase", " ", -1)
    sized = counts.withColumn("words", words)
    phrases = sized.where(F.size("words") > 1)
    part = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    cut = cut.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"]).join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"(cast({scale} as decimal(10, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    worst = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    # every shorter phrase within a phrase, with the largest count of those that hold it
    spans = [(i, n) for n in range(2, longest) for i in range(1, longest)]
    within = F.array(*(F.when(F.size("words") > n, F.when(F.size("words") >= i + n - 1, F.array_join(F.slice("words", i, n), " "))) for i, n in spans))
    held = phrases.select("lang", F.explode(F.array_distinct(within)).alias("phrase"), "f").where("phrase is not null").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    open_ = worst.join(held, ["lang", "phrase"], "left").where(f"longer is null or cast({covered[0]} as decimal(10, 0)) * longer < cast({covered[1]} as decimal(10, 0)) * a")
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    best = open_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = {
    "op12_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4)) v(k) WHERE len(words) >= k),
f AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS f, string_split(phrase, ' ') AS words FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (
  SELECT lang, phrase, f AS a, words, k, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[cut + 1:c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM f, (VALUES (2), (3)) v(m), (VALUES (1), (2), (3)) u(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b LEFT JOIN h USING (lang, phrase) JOIN t USING (lang)
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
"""
}
