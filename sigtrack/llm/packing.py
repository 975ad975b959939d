"""Packing documents into sequences of a fixed number of tokens.

First-fit decreasing with a tournament tree of bin capacities, in randomised groups of
documents that do not know of each other. Long documents are dealt out in runs of 16 sequences,
and there are as many groups as documents and bytes of text ask for, so a group holds about
``group_docs`` runs and ``group_bytes`` bytes. Documents are cut at multiples of the sequence
length; their last pieces are placed whole. What first-fit leaves open in a group is then filled
by cutting pieces of its emptiest sequences, so that at most one sequence of a group is not full.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .wordbpe import CACHE_WORDS, encoded, tokenizer_path

TOKENIZER, END_ID, LENGTH = "word_bpe_49k.json", 2, 4096


class Tournament:
    """The first of many bins that has room: each inner node holds the larger room of its two sides."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first bin with room for ``size``; the room is taken."""
        at = 1
        if self.best[1] < size:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if self.best[at] < size:
                at += 1
        self.best[at] -= size
        bin_, at = at - self.leaves, at // 2
        while at and self.best[at] != (top := max(self.best[2 * at], self.best[2 * at + 1])):
            self.best[at] = top
            at //= 2
        return bin_


def first_fit_decreasing(sizes: list[int], room: int) -> list[int]:
    """The bin of each size. Ties keep the order they came in."""
    tree, out = Tournament(len(sizes), room), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = tree.place(sizes[i])
    return out


def pack_group(rows: list[tuple[int, int]], length: int) -> list[tuple[int, int, int, int, int]]:
    """(row, start in it, length, sequence, offset) of pieces that hold all of rows (first token, tokens)."""
    full = [(r, a) for r, (_, n) in enumerate(rows) for a in range(0, n - n % length, length)]
    rest = [(r, n - n % length, n % length) for r, (_, n) in enumerate(rows) if n % length]
    bins: dict[int, list[list[int]]] = {}
    for (r, a, n), b in zip(rest, first_fit_decreasing([n for *_, n in rest], length)):
        bins.setdefault(b, []).append([r, a, n])
    filled = sorted(bins.values(), key=lambda b: -sum(n for *_, n in b))
    room = [length - sum(n for *_, n in b) for b in filled]
    i, j = 0, len(filled) - 1
    while i < j:
        if not room[i]:
            i += 1
        elif not filled[j]:
            j -= 1
        else:  # the last piece of the emptiest sequence gives its end to the open one
            r, a, n = filled[j][-1]
            part = min(n, room[i])
            filled[i].append([r, a + n - part, part])
            filled[j][-1][2] -= part
            if part == n:
                filled[j].pop()
            room[i] -= part
    out = [(r, a, length, k, 0) for k, (r, a) in enumerate(full)]
    for k, pieces in enumerate((b for b in filled if b), len(full)):
        at = 0
        for r, a, n in pieces:
            out.append((r, a, n, k, at))
            at += n
    return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, segment: int, cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id, start, doc_tokens, width and ids (little-endian, 16 or 32 bits each) in runs of at most ``segment`` ids,
    and ``copy``, how many rows of the same batch before it have the doc_id."""

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        for frame in frames:
            rows, seen = [], Counter()
            for doc, ids in zip(frame.column(0).to_pylist(), encoded(path, frame.column(1).to_pylist(), end_id, cache_words)):
                rows += [(doc, a, len(ids), ids.itemsize, ids[a : a + segment].tobytes(), seen[doc]) for a in range(0, len(ids), segment)]
                seen[doc] += 1
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "start", "doc_tokens", "width", "ids", "copy"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, start long, doc_tokens long, width int, ids binary, copy int")


def pack(
    docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, length: int = LENGTH, group_docs: int = 1024, group_bytes: int = 16 << 20, seed: int = 7, cache_words: int = 600_000
) -> DataFrame:
    """Pieces of all documents, with their ids as 32-bit integers.

    Runs are dealt to groups by a hash of doc_id, start, ``copy`` and ``seed``: rows that repeat a
    doc_id or have none are documents of their own and spread over the groups like others. Null
    text counts as empty: one sequence piece with the end id. An empty table gives no rows;
    further columns are left alone. ``cache_words`` bounds a Python worker's memory of words.
    ``docs`` is a table, or rows whose order a repeated task keeps.
    """
    size = docs.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text")).alias("bytes")).first()
    groups = max(1, -(-size.docs // group_docs), -(-(size.bytes or 0) // group_bytes))
    runs = tokenized(docs, tokenizer, end_id, 16 * length, cache_words)

    def pack_rows(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        doc, start, total, width = (rows[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "width"))
        ids = [np.frombuffer(x.as_buffer(), f"<u{w}") for x, w in zip(rows["ids"], width)]
        found = pack_group([(s, len(i)) for s, i in zip(start, ids)], length)
        first = key[0].as_py() << 32
        out = [(doc[r], start[r] + a, n, ids[r][a : a + n].astype("<u4").tobytes(), total[r], first + k, at) for r, a, n, k, at in found]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    group = F.pmod(F.xxhash64("doc_id", "start", F.lit(seed), F.when(F.col("copy") > 0, F.col("copy"))), F.lit(groups))
    # about eight groups to a task, so that tasks stay as large at any size
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups // 8)
    dealt = runs.withColumn("pack_group", group).drop("copy").repartition(tasks, "pack_group")
    return dealt.groupBy("pack_group").applyInArrow(pack_rows, PIECES)


def with_checksum(pieces: DataFrame, *more: str) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids, and the columns ``more``."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *more)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_checksum(pack(table(spark, sf_dir, "documents")))
