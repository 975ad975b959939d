"""Document fingerprints by threshold-scaled sketches.

A sketch holds every shingle hash below a fixed fraction of the 64-bit range, so its size grows with
the text and sketches of texts of very unequal length can be compared: of a text's hashes below the
threshold, the share that another text has as well estimates how much of it the other contains. The
union of sketches is the sketch of the texts together. A text of at most ``WHOLE`` different shingles
keeps all of them, as a fraction of so few says nothing; its sketch is of scale 1, and two sketches
are compared at, or merged to, the coarser scale of both.

Shingles are five words, A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; a text of fewer words is one
shingle, one without words has none. A shingle's hash mixes its words' XXH64 (seed 0) as a
polynomial modulo 2^64 in whole arrays of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

WORDS, SCALE, WHOLE = 5, 8, 64
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
#: Words whose hash a Python worker remembers.
_MOST_WORDS = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= _MOST_WORDS:
            self.clear()
        found = self[word] = xxh64_intdigest(word)
        return found


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit of ``h``."""
    for factor in _MIX:
        h = (h ^ (h >> np.uint64(33))) * factor
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: bytes, known: dict, words: int = WORDS) -> np.ndarray:
    """The sorted, distinct hashes of a text's shingles."""
    w = text.lower().split()
    h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
    n = max(1, len(h) - words + 1) if len(h) else 0
    total = np.zeros(n, np.uint64)
    for i in range(min(words, len(h))):
        total = total * _FACTOR + h[i : i + n]
    return np.unique(mixed(total + np.uint64(min(words, len(h)))))


def sketch(hashes: np.ndarray, scale: int = SCALE, whole: int = WHOLE) -> tuple[int, np.ndarray]:
    """(scale, sorted hashes kept): all hashes of a short text at scale 1, else those below 2^64 / scale."""
    if len(hashes) <= whole:
        return 1, hashes
    return scale, hashes[: np.searchsorted(hashes, np.uint64((1 << 64) // scale))]


def containment(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of a's shingles that b has, at the coarser scale of both; equal sketches give 1, and where
    a has nothing below the threshold or neither has a shingle to compare, 0."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0
    scale = max(a[0], b[0])
    x, y = (s if scale == 1 or k == scale else s[: np.searchsorted(s, np.uint64((1 << 64) // scale))] for k, s in (a, b))
    return len(np.intersect1d(x, y, assume_unique=True)) / len(x) if len(x) else 0.0


def packed(s: tuple[int, np.ndarray]) -> bytes:
    """The sketch as bytes: hashes with their high byte first, so that equal sketches are equal."""
    return s[1].astype(">u8").tobytes()


def sketches(docs: DataFrame, scale: int = SCALE, whole: int = WHOLE) -> DataFrame:
    """doc_id, scale and hashes (array of unsigned 64-bit numbers, as longs, in ascending order) of every row; a null text is empty.
    Rows that repeat a doc_id keep a row each, an empty table gives none, other columns are left out."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for frame in frames:
            found = [sketch(shingle_hashes(t, known), scale, whole) for t in frame["text"].to_pylist()]
            hashes = pa.array([h.view(np.int64) for _, h in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([frame["doc_id"], pa.array([k for k, _ in found], pa.int32()), hashes], ["doc_id", "scale", "hashes"])

    return docs.select(F.col("doc_id").cast("long"), _bytes(F.col("text"))).mapInArrow(run, "doc_id long, scale int, hashes array<long>")


def _bytes(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("text")


def _below(hash_: Column, scale: Column) -> Column:
    """If an unsigned hash is below 2^64 / scale, a power of two; as longs, hashes from 2^63 on are negative."""
    half = F.when(scale == 1, F.lit(0)).otherwise(F.floor(F.lit(float(1 << 63)) / scale)).cast("long")
    return (scale == 1) | ((hash_ >= 0) & (F.shiftright(hash_, 1) < half))


def merged(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, scale, hash): the sketch of each group's texts together, a row per hash, as a group can hold most of the corpus.
    ``rows`` has ``by``, scale and hashes. Groups are as coarse as their coarsest member."""
    coarsest = rows.groupBy(*by).agg(F.max("scale").alias("scale"))
    each = rows.select(*by, F.explode("hashes").alias("hash")).distinct()
    met = each.alias("e").join(coarsest.alias("c"), [F.col(f"e.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by])
    kept = met.select(*(F.col(f"e.{c}").alias(c) for c in by), "scale", "hash")
    return kept.where(_below(F.col("hash"), F.col("scale")))


def contained(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """(doc_id, by, hits, n, containment): how much of each document of ``rows`` a merged sketch holds, where it holds any of it."""
    scales = groups.groupBy(*by).agg(F.max("scale").alias("group_scale"))
    hits = rows.select("doc_id", "scale", F.explode("hashes").alias("hash")).join(groups.select(*by, "hash"), "hash")
    # a document's own hashes below the threshold of both, for each scale that groups have: as few as were ever in use
    known = [r[0] for r in scales.select("group_scale").distinct().collect()]
    own = rows.withColumn("group_scale", F.explode(F.array(*map(F.lit, known)).cast("array<int>")))
    at = F.greatest("scale", "group_scale")
    own = own.select("doc_id", "group_scale", F.size(F.filter("hashes", lambda h: _below(h, at))).cast("long").alias("n"))
    found = hits.groupBy("doc_id", *by).agg(F.count(F.lit(1)).alias("hits")).join(scales, by).join(own, ["doc_id", "group_scale"])
    return found.select("doc_id", *by, "hits", "n", (F.col("hits") / F.col("n")).alias("containment"))


def codec() -> pa.Codec:
    return pa.Codec("zstd", 3)


_RESULT = "n_chars long, edited_sha256 string, scale int, fingerprint binary, edited_scale int, edited binary, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_KINDS = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.float64(), pa.float64()]


def _compared(text: str, own: tuple, next_text: str, other: tuple, known: dict, scale: int, whole: int) -> tuple:
    moved = len(text) // 3
    changed = (text[: len(text) - moved] + next_text[:moved]).encode()
    edited = sketch(shingle_hashes(changed, known), scale, whole)
    near = containment(own, edited), containment(own, other)
    return len(text), hashlib.sha256(changed).hexdigest(), own[0], packed(own), edited[0], packed(edited), *near


def _batch(keys: list, edge: list, results: list) -> pa.RecordBatch:
    rows = [r or (None,) * len(_NAMES) for r in results]
    columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()), pa.array(edge, pa.string()), pa.array([k[2] for k in keys], pa.binary())]
    return pa.RecordBatch.from_arrays(columns + [pa.array([r[i] for r in rows], t) for i, t in enumerate(_KINDS)], ["doc_id", "part", "edge", "text", *_NAMES])


def edited_documents(docs: DataFrame, scale: int = SCALE, whole: int = WHOLE) -> DataFrame:
    """doc_id and the columns of ``_RESULT`` of every row: its sketch, that of its edited text and how much of it the
    edited text and the next document contain.

    The edited text has the last third of its code points replaced by the first ones of the next
    document in descending doc_id, the first document after the last. Rows are dealt by ranges of
    (doc_id, text hash) and read in ascending order, so a row's next document is the one before it;
    the first row of a range meets the last one of the range before, which a task can only write
    beside its results. Rows that repeat a doc_id stand in the order of their texts' hashes; a null
    doc_id is the smallest; a null text is empty; a table of one row follows itself; an empty table
    gives no rows.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, known, before, held = TaskContext.get().partitionId(), _WordHashes(), None, 0
        keys, edge, results = [], [], []
        for frame in frames:
            for doc_id, data, size in zip(frame["doc_id"].to_pylist(), frame["text"], frame["size"].to_pylist()):
                data = codec().decompress(data.as_buffer(), size, asbytes=True) if size else b""
                text, own = data.decode(errors="replace"), sketch(shingle_hashes(data, known), scale, whole)
                if before is None:
                    keys.append((doc_id, part, data))
                    edge.append("first")
                    results.append(None)
                else:
                    keys.append((doc_id, part, None))
                    edge.append(None)
                    results.append(_compared(text, own, *before[:2], known, scale, whole))
                held += len(data)
                before = text, own, doc_id, data
                if held > 4_000_000:
                    yield _batch(keys, edge, results)
                    keys, edge, results, held = [], [], [], 0
        if before is not None:
            keys.append((before[2], part, before[3]))
            edge.append("last")
            results.append(None)
        yield _batch(keys, edge, results)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _bytes(F.col("text")), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumns({"digest": F.xxhash64("text"), "size": F.length("text")})

    def compress(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            small = pa.array([codec().compress(x.as_buffer(), asbytes=True) for x in frame["text"]], pa.binary())
            yield frame.set_column(frame.schema.names.index("text"), "text", small)

    # texts travel compressed; equal rows can be many, their place in the table deals them to several ranges, too
    order = ["doc_id", "digest", "size", "row"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.mapInArrow(compress, rows.schema).repartitionByRange(n, *order).sortWithinPartitions(*order)
    out = stored(dealt.select("doc_id", "text", "size").mapInArrow(run, f"doc_id long, part int, edge string, text binary, {_RESULT}"), "zstd")
    # a row or two for each range: numbers first, then their texts
    ends = out.where("edge is not null").select("part", "edge", "doc_id", "text")
    parts = [r.part for r in ends.where("edge = 'first'").select("part").collect()]
    follows = dict(zip(sorted(parts), sorted(parts)[-1:] + sorted(parts)[:-1]))
    pairs = docs.sparkSession.createDataFrame(sorted(follows.items()), "part int, other int")
    firsts = ends.where("edge = 'first'").join(pairs, "part").select("doc_id", "text", "other")
    lasts = ends.where("edge = 'last'").select(F.col("part").alias("other"), F.col("text").alias("next_text"))

    def meet(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for frame in frames:
            results = []
            for data, other in zip(frame["text"].to_pylist(), frame["next_text"].to_pylist()):
                own, near = (sketch(shingle_hashes(x, known), scale, whole) for x in (data, other))
                results.append(_compared(data.decode(errors="replace"), own, other.decode(errors="replace"), near, known, scale, whole))
            yield pa.RecordBatch.from_arrays([frame["doc_id"], *(pa.array([r[i] for r in results], t) for i, t in enumerate(_KINDS))], ["doc_id", *_NAMES])

    met = firsts.join(lasts, "other").select("doc_id", "text", "next_text").mapInArrow(meet, f"doc_id long, {_RESULT}")
    return out.where("edge is null").select("doc_id", *_NAMES).unionByName(met)


def op11_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint is the sketch's scale and its hashes in ascending order, 16 lowercase hex digits each."""
    found = edited_documents(table(spark, sf_dir, "documents"))
    name = lambda scale, data: F.concat(F.col(scale).cast("string"), F.lit(":"), F.lower(F.hex(data)))
    return found.select("doc_id", "n_chars", "edited_sha256", name("scale", "fingerprint").alias("fingerprint"), name("edited_scale", "edited").alias("edited_fingerprint"), "near_edited", "near_next")
