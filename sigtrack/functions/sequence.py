"""Nucleotide and quality expressions; all are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASES = "ACGT"


def base_code(base: Column) -> Column:
    """0 to 3 for A, C, G, T in either case, 4 for anything else."""
    at = F.instr(F.lit(BASES), F.upper(base))
    return F.when((F.length(base) == 1) & (at > 0), at - 1).otherwise(4).cast("int")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def kmer_code(kmer: Column) -> Column:
    """Base-4 number of a k-mer, first base most significant; -1 with any base that is none of the four."""
    codes = F.transform(F.split(F.upper(kmer), ""), base_code)
    value = F.aggregate(codes, F.lit(0).cast("long"), lambda acc, c: acc * 4 + c)
    return F.when(F.upper(kmer).rlike("^[ACGT]+$"), value).otherwise(-1)


def kmer_text(code: Column, k: int) -> Column:
    """The k-mer of a code."""
    digits = [F.substring(F.lit(BASES), (F.shiftright(code, 2 * (k - 1 - i)).bitwiseAND(F.lit(3)) + 1).cast("int"), F.lit(1)) for i in range(k)]
    return F.when(code >= 0, F.concat(*digits))


def kmers(seq: Column, k: int) -> Column:
    """Every k-mer of a sequence (of single-byte letters), in order; an array, empty for a shorter sequence.

    Cut from bytes: a string's substring is found by counting characters from its start.
    """
    data = seq.cast("binary")
    n = F.octet_length(seq) - k + 1
    cut = lambda i: F.substring(data, i, F.lit(k)).cast("string")
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), cut)).otherwise(F.array().cast("array<string>"))


def kmer_counts(rows: DataFrame, k: int, key: str = "doc_id", seq: str = "seq") -> DataFrame:
    """key, kmer and n of each row's different k-mers (sequences of single-byte letters); a null sequence has none.

    Letters become digits of a number, so a batch's k-mers are counted without a string for each.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i, text in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
                data = np.frombuffer((text or "").encode(), np.uint8)
                if len(data) < k:
                    continue
                letters = np.flatnonzero(np.bincount(data, minlength=256))
                digit = np.zeros(256, np.int64)
                digit[letters] = np.arange(len(letters))
                m, d = len(letters), digit[data]
                if m**k >= 1 << 62:
                    raise ValueError(f"{k}-mers of {m} letters are too many")
                code = np.zeros(len(d) - k + 1, np.int64)
                for j in range(k):
                    code = code * m + d[j : len(d) - k + 1 + j]
                found, n = np.unique(code, return_counts=True)
                text_of = np.stack([letters[found // m ** (k - 1 - j) % m] for j in range(k)], 1).astype(np.uint8)
                names = text_of.tobytes().decode()
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int64()), pa.array([names[a : a + k] for a in range(0, len(names), k)], pa.string()), pa.array(n.astype(np.int64))], [key, "kmer", "n"])

    return rows.select(F.col(key).cast("long").alias(key), seq).mapInArrow(run, f"{key} long, kmer string, n long")


def known_base(nt: Column) -> Column:
    """N for a missing or unknown nucleotide."""
    return F.when(F.upper(nt).isin(*"ACGTN"), F.upper(nt)).otherwise("N")


def phred_error(phred: Column) -> Column:
    return F.pow(F.lit(10.0), -phred / 10.0)


def padded_context(before: Column, sequence: Column, after: Column, width: int) -> Column:
    """``sequence`` with ``width`` bases of its neighbours on both sides; N where a contig ends."""
    left = F.lpad(F.right(F.coalesce(before, F.lit("")), F.lit(width)), width, "N")
    right = F.rpad(F.left(F.coalesce(after, F.lit("")), F.lit(width)), width, "N")
    return F.concat(left, sequence, right)


def quality_errors(quals: Column) -> Column:
    """Error probability of each character of an ASCII quality string."""
    return F.transform(F.filter(F.split(quals, ""), lambda c: c != ""), lambda c: phred_error(F.ascii(c) - 33))


def error_phred(error: Column) -> Column:
    """Phred value of a mean error; no bases count as error 1, so 0."""
    return -10 * F.log10(F.coalesce(error, F.lit(1.0)))


def read_half(read_id: Column) -> Column:
    """A or B by the parity of the read id's crc32."""
    return F.when(F.crc32(read_id.cast("string")) % 2 == 0, "A").otherwise("B")
