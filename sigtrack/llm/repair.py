"""Token-ID output: documents' ids in a grammar-compressed block format.

Re-Pair: frequent pairs of neighbouring symbols are repeatedly replaced by a nonterminal. Each
block (a run of documents in doc_id order) has its own grammar, so blocks are written and read
on their own. A round replaces all pairs that are frequent in the block at that time, and rounds
go on until none is; pairs never reach over a document's end. Stored are the rules, the number of ids below each
nonterminal, the symbols and each document's first symbol: a document is decoded without the
ones before it, and a range of ids without expanding what lies outside it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, table
from .wordbpe import encoded, tokenizer_path

MAGIC = b"RPB1"
TOKENIZER, END_ID = "word_bpe_49k.json", 1
_BITS, _END = 18, 0xFFFFFFFF


def _pair_hash(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    h = a.astype(np.uint32)
    h += np.uint32(salt)
    h *= np.uint32(0x9E3779B1)
    h ^= b
    h *= np.uint32(0x85EBCA77)
    h >>= np.uint32(32 - _BITS)
    return h


def _frequent_pairs(sym: np.ndarray, end_id: int, least: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a frequent pair starts, its hash bucket, and by bucket the start of the pair's first copy.

    One pair stands for each bucket; pairs that share its bucket wait for a round with another ``salt``.
    """
    h = _pair_hash(sym[:-1], sym[1:], salt)
    at = np.flatnonzero((np.bincount(h, minlength=1 << _BITS) >= least)[h])
    at = at[(sym[at] != end_id) & (sym[at + 1] != end_id)]
    h = h[at]
    model = np.zeros(1 << _BITS, np.int64)
    model[h[::-1]] = at[::-1]
    first = model[h]
    same = (sym[at] == sym[first]) & (sym[at + 1] == sym[first + 1])
    at, h = at[same], h[same]
    often = (np.bincount(h, minlength=1 << _BITS) >= least)[h]
    return at[often], h[often], model


def _without_overlap(at: np.ndarray) -> np.ndarray:
    """Of starts next to each other, every second one."""
    run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    return (np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0


def compress(sym: np.ndarray, base: int, end_id: int, least: int = 24, gain: float = 0.001) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (one row of two symbols for each nonterminal, numbered from ``base`` on).

    Each round replaces all pairs that come up ``least`` times; it goes on until two rounds with different
    hashes find none, or shorten the symbols by less than ``gain`` each. Of pairs that overlap the first goes,
    the others have the next round: by count it took 2.4 times the time for no better ratio.
    """
    sym, rules, n, salt, idle = sym.astype(np.uint32), [], 0, 0, 0
    while len(sym) >= 2 * least and idle < 2:
        at, h, model = _frequent_pairs(sym, end_id, least, salt)
        keep = _without_overlap(at)
        at, h, salt = at[keep], h[keep], salt + 1
        idle = idle + 1 if len(at) <= gain * len(sym) else 0
        if not len(at):
            continue
        often = np.bincount(h, minlength=1 << _BITS) > 0
        heads = model[often]
        rules.append(np.stack([sym[heads], sym[heads + 1]], 1))
        sym[at] = (base + n - 1 + np.cumsum(often))[h]
        kept = np.ones(len(sym), bool)
        kept[at + 1] = False
        sym = sym[kept]
        n += len(heads)
    return sym, np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """The number of ids below each nonterminal; a rule uses earlier ones only."""
    out = np.ones(len(rules), np.int64)
    todo = np.arange(len(rules))
    known = np.zeros(len(rules) + 1, bool)
    known[-1] = True
    while len(todo):
        at = np.where(rules[todo] >= base, rules[todo].astype(np.int64) - base, -1)
        ready = known[at].all(1)
        out[todo[ready]] = np.where(at[ready] < 0, 1, out[at[ready]]).sum(1)
        known[todo[ready]] = True
        todo = todo[~ready]
    return out


def expand(sym: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids below a run of symbols."""
    sym = sym.astype(np.uint32)
    while len(at := np.flatnonzero(sym >= base)):
        pair = rules[sym[at] - base]
        sym[at] = pair[:, 0]
        sym = np.insert(sym, at + 1, pair[:, 1])
    return sym


@dataclass
class Block:
    """A block read from its bytes; arrays are views of them."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    doc_ids: np.ndarray
    has_id: np.ndarray
    first_symbol: np.ndarray
    first_token: np.ndarray
    symbols: np.ndarray

    def document(self, k: int) -> np.ndarray:
        return expand(self.symbols[self.first_symbol[k] : self.first_symbol[k + 1]], self.rules, self.base)

    def tokens(self, start: int, length: int) -> np.ndarray:
        """Ids from ``start`` on, counted in the block, by the symbols that hold them only."""
        k = int(np.searchsorted(self.first_token, start, "right")) - 1
        at, out = int(self.first_token[k]), []
        for s in self.symbols[self.first_symbol[k] :]:
            if at >= start + length:
                break
            n = 1 if s < self.base else int(self.lengths[int(s) - self.base])
            if at + n > start:
                out.append(expand(np.array([s], np.uint32), self.rules, self.base)[max(0, start - at) : start + length - at])
            at += n
        return np.concatenate(out) if out else np.empty(0, np.uint32)


def write_block(doc_ids: list[int | None], ids: list[np.ndarray], base: int, end_id: int) -> bytes:
    flat, counts = np.concatenate(ids).astype(np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))
    flat[np.cumsum(counts) - 1] = _END  # the end id may also come up inside a text
    sym, rules = compress(flat, base, _END)
    small = base + len(rules) <= 1 << 16
    head = np.array([base, len(rules), len(ids), len(sym), 2 if small else 4], "<i8")
    ends = np.append(0, np.flatnonzero(sym == _END) + 1)
    sym[ends[1:] - 1] = end_id
    return b"".join(
        [MAGIC, head.tobytes(), rules.astype("<u4").tobytes(), rule_lengths(rules, base).astype("<u4").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], "u1").tobytes(), ends.astype("<i8").tobytes(), np.append(0, np.cumsum(counts)).astype("<i8").tobytes(), sym.astype("<u2" if small else "<u4").tobytes()]
    )


def read_block(data: bytes) -> Block:
    if data[:4] != MAGIC:
        raise ValueError("not a block of this format")
    base, n_rules, n_docs, n_sym, width = np.frombuffer(data, "<i8", 5, 4).tolist()
    at, out = 44, []
    for kind, n in (("<u4", 2 * n_rules), ("<u4", n_rules), ("<i8", n_docs), ("u1", n_docs), ("<i8", n_docs + 1), ("<i8", n_docs + 1), (f"<u{width}", n_sym)):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return Block(base, out[0].reshape(-1, 2), *out[1:])


_BLOCKS = "part int, seq int, n_docs long, n_tokens long, data binary"


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, block_tokens: int = 1 << 20, partitions: int | None = None) -> str:
    """Writes ids of ``docs`` (doc_id, text) and returns the folder, in the shared one.

    Rows are dealt by ranges of doc_id (null first; rows of one doc_id in the order of their
    texts), so files hold ascending documents. Blocks close at ``block_tokens`` ids; a longer
    document has a block of its own. The container is Parquet, for Spark's commit protocol: a
    task that is repeated leaves its files once. Null text counts as empty; an empty table gives
    no blocks; columns besides doc_id and text are left alone.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, part, seq = tokenizer_path(tokenizer), TaskContext.get().partitionId(), 0
        ids_of, docs_of, size, base = [], [], 0, 0
        from .wordbpe import encoder

        base = encoder(path).whole.get_vocab_size(with_added_tokens=True)

        def block():
            data = write_block(docs_of, ids_of, base, end_id)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(docs_of)], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], ["part", "seq", "n_docs", "n_tokens", "data"])

        for frame in frames:
            names = frame.column(0).to_pylist()
            for doc, ids in zip(names, encoded(path, frame.column(1).to_pylist(), end_id)):
                docs_of.append(doc)
                ids_of.append(ids)
                size += len(ids)
                if size >= block_tokens:
                    yield block()
                    ids_of, docs_of, size, seq = [], [], 0, seq + 1
        if docs_of:
            yield block()

    path = shared_dir(spark)
    rows.mapInArrow(write, _BLOCKS).write.option("compression", "zstd").parquet(path)
    return path


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a folder: doc_id, start, n_tokens and the checksum of its ids, decoded from the blocks."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for part, seq, data in zip(frame["part"].to_pylist(), frame["seq"].to_pylist(), frame["data"]):
                b = read_block(data.as_buffer())
                ids = expand(b.symbols, b.rules, b.base).astype("<u4")
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(b.first_token[:-1].tolist(), b.first_token[1:].tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(b.doc_ids, pa.int64(), mask=b.has_id == 0), pa.array(b.first_token[:-1]), pa.array(np.diff(b.first_token)), pa.array(crc, pa.int64())], ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = blocks.select("part", "seq", "data").mapInArrow(read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # one small row per block of a million ids
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op5_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_ids(spark, write_ids(docs, TOKENIZER, END_ID))
