"""Data sources for record files that Spark has no reader for: FASTQ, FASTA, BAM.

A file is cut into byte ranges, each a partition, and a record belongs to the range that its first
byte lies in: whatever the cuts, every record is read once. A range finds its first record by itself:
FASTQ by the shape of four lines, BAM by the next BGZF block and the first place in it from which
records follow one another, FASTA by its index. Only a FASTQ file that is gzip as a whole, and a FASTA
file without an index, are one partition. Option ``splitBytes`` is the length of a range, the
least one where the files are long. Files are
opened through Arrow's file systems, so local paths and remote URIs work alike.
"""

from __future__ import annotations

import gzip
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

ALIGNMENT = "read_id string, flag int, chrom string, start long, mapq int, cigar array<struct<op:int,len:int>>, seq string, qual string, tags map<string,string>"
SPLIT_BYTES = 64 << 20
#: So many ranges are made of long files, which have ranges longer than this: short ones would become ever more tasks.
MOST_RANGES, SHORT_BYTES = 480, 1 << 16


def _range_bytes(wanted: int, total: int) -> int:
    """The length of a range of ``total`` bytes: the wanted one, or longer up to SPLIT_BYTES where there would be too many."""
    grown = min(SPLIT_BYTES, -(-total // MOST_RANGES))
    return max(1, wanted, grown if grown > SHORT_BYTES else 0)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str, endings: tuple[str, ...]) -> list[tuple[str, int]]:
    """The files at or below a path that end so, with their sizes."""
    from pyarrow import fs

    system, inner = _filesystem(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((path.rstrip("/") + f.path[len(inner.rstrip("/")) :], f.size) for f in found if f.path.endswith(endings))


def _open(path: str):
    """A file that can be read from any place."""
    system, inner = _filesystem(path)
    return system.open_input_file(inner)


def _stream(path: str) -> io.BufferedReader:
    system, inner = _filesystem(path)
    raw = system.open_input_stream(inner, compression=None)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if path.endswith(".gz") else raw


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    stop: int | None  # None: the file is read from end to end


class _FileReader(DataSourceReader):
    endings: tuple[str, ...] = ()

    def __init__(self, options: dict):
        self.options = options

    def wanted(self) -> int:
        return int(self.options.get("splitbytes", self.options.get("splitBytes", SPLIT_BYTES)))

    def splits(self, path: str, size: int, step: int) -> list[_Range]:
        return [_Range(path, a, min(size, a + step)) for a in range(0, max(1, size), step)]

    def files(self) -> list[tuple[str, int]]:
        """Option ``endings`` is of files that are named otherwise, as Spark's text files are."""
        named = self.options.get("endings")
        return _files(self.options["path"], tuple(named.split(",")) if named else self.endings)

    def partitions(self) -> list[_Range]:
        files = self.files()
        step = _range_bytes(self.wanted(), sum(size for _, size in files))
        return [s for path, size in files for s in self.splits(path, size, step)]


# ---- BGZF: blocks of at most 64 KB, each with its compressed size in its header


_MAGIC = b"\x1f\x8b\x08\x04"


def _block_size(head: bytes) -> int:
    """The compressed size that a block's header gives; 0 if this is no header of a BGZF block."""
    if len(head) < 18 or head[:4] != _MAGIC:
        return 0
    at, end = 12, min(len(head), 12 + struct.unpack_from("<H", head, 10)[0])
    while at + 4 <= end:
        name, length = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and length == 2 and at + 6 <= end:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + length
    return 0


def _is_bgzf(path: str) -> bool:
    with _open(path) as f:
        return _block_size(f.read(1 << 10)) > 0


def first_block(f, start: int) -> int | None:
    """Where the first BGZF block at or after ``start`` begins, None if there is none: its header gives a size, and
    another block or the file's end follows there, three times over."""
    end = f.size()

    def follows(at: int, times: int) -> bool:
        if at == end or not times:
            return True
        f.seek(at)
        size = _block_size(f.read(1 << 10))
        return bool(size) and at + size <= end and follows(at + size, times - 1)

    at, window = start, 1 << 17
    while at < end:
        f.seek(at)
        data = f.read(window)
        i = data.find(_MAGIC)
        while i >= 0:
            if follows(at + i, 4):
                return at + i
            i = data.find(_MAGIC, i + 1)
        at += max(1, len(data) - 3)
    return None


def blocks(f, at: int) -> Iterator[tuple[int, bytes]]:
    """(place in the file, contents) of the blocks from ``at`` on."""
    f.seek(at)
    while head := f.read(18):
        extra = struct.unpack_from("<H", head, 10)[0] if len(head) == 18 else 0
        head += f.read(max(0, extra - 6))
        size = _block_size(head)
        if not size:
            raise ValueError(f"no BGZF block at byte {at}")
        body = f.read(size - len(head))
        data = zlib.decompress(body[:-8], -15)
        if len(data) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError(f"the BGZF block at byte {at} is not as long as it says")
        yield at, data
        at += size


class _Contents:
    """The contents of blocks from a place on, as one row of bytes that grows as it is read."""

    def __init__(self, f, at: int, stop: int | None = None):
        self.blocks, self.stop = blocks(f, at), stop
        self.held, self.at = bytearray(), 0
        #: How many of the bytes read so far lie in blocks that begin before ``stop``.
        self.owned, self.read = 0, 0

    def fill(self, n: int) -> bool:
        """If there are ``n`` bytes more from here."""
        while len(self.held) - self.at < n:
            block = next(self.blocks, None)
            if block is None:
                return False
            if self.at > 1 << 20:
                del self.held[: self.at]
                self.at = 0
            self.held += block[1]
            self.read += len(block[1])
            if self.stop is None or block[0] < self.stop:
                self.owned = self.read
        return True

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = bytes(self.held[self.at : self.at + n])
        self.at += len(out)
        return out

    def mine(self) -> bool:
        """If the next byte lies in a block of this range."""
        return self.fill(1) and self.read - (len(self.held) - self.at) < self.owned

    def lines(self) -> Iterator[tuple[bool, bytes]]:
        """(if it begins in this range, line) of what follows."""
        while self.fill(1):
            mine = self.mine()
            while (end := self.held.find(b"\n", self.at)) < 0 and self.fill(len(self.held) - self.at + 1):
                pass
            yield mine, self.take((end if end >= 0 else len(self.held)) + 1 - self.at)


# ---- FASTQ


def _plain_lines(f, start: int, stop: int) -> Iterator[tuple[bool, bytes]]:
    """(if it begins in this range, line) from the first line that begins at or after ``start``."""
    at = max(0, start - 1)
    f.seek(at)
    rest, dropped = b"", start == 0
    while data := f.read(1 << 20):
        parts = (rest + data).split(b"\n")
        rest = parts.pop()
        for p in parts:
            if dropped:
                yield at < stop, p
            dropped = True
            at += len(p) + 1
    if rest and dropped:
        yield at < stop, rest


def fastq_records(lines: Iterator[tuple[bool, bytes]], where: str, inside: bool) -> Iterator[tuple[str, str, str]]:
    """The records whose first line begins in this range. ``inside``: the first line can be any of a record's four.

    A quality line can begin with @ and with +, but a sequence cannot: so the line that begins with @ and is the
    second before one with + is a record's first.
    """
    held: list[tuple[bool, bytes]] = []

    def more(n: int) -> bool:
        while len(held) < n and (line := next(lines, None)) is not None:
            held.append((line[0], line[1].rstrip(b"\r\n")))
        return len(held) >= n

    if inside:
        while more(3) and not (held[0][1].startswith(b"@") and held[2][1].startswith(b"+")):
            held.pop(0)
        if len(held) < 3:
            return
    while more(1) and held[0][0]:
        if not held[0][1] and not more(2):
            return
        more(4)
        head, seq, plus, qual = ([line for _, line in held] + [b""] * 3)[:4]
        if not head.startswith(b"@") or not plus.startswith(b"+") or len(seq) != len(qual):
            raise ValueError(f"{where}: no FASTQ record at {head[:40].decode(errors='replace')!r}")
        name = head[1:].split()
        yield (name[0].decode() if name else ""), seq.decode("ascii"), qual.decode("ascii")
        del held[:4]


class _Fastq(_FileReader):
    """Plain files and BGZF ones are split; one that is gzip as a whole is one partition."""

    endings = (".fastq", ".fq", ".fastq.gz", ".fq.gz")

    def splits(self, path: str, size: int, step: int) -> list[_Range]:
        return [_Range(path, 0, None)] if path.endswith(".gz") and not _is_bgzf(path) else super().splits(path, size, step)

    def read(self, r: _Range) -> Iterator[tuple]:
        if r.stop is None:
            with _stream(r.path) as f:
                yield from fastq_records(((True, line) for line in f), r.path, False)
            return
        with _open(r.path) as f:
            if not r.path.endswith(".gz"):
                yield from fastq_records(_plain_lines(f, r.start, r.stop), r.path, r.start > 0)
            elif (at := first_block(f, r.start)) is not None and at < r.stop:
                contents = _Contents(f, at, r.stop)
                if not at:
                    yield from fastq_records(contents.lines(), r.path, False)
                elif _ends_line(f, at):
                    yield from fastq_records(contents.lines(), r.path, True)
                else:
                    lines = contents.lines()
                    next(lines, None)  # began in the range before
                    yield from fastq_records(lines, r.path, True)


def _ends_line(f, at: int) -> bool:
    """If the block before the one at ``at`` ends a line. It lies at most 64 KB before."""
    begin = first_block(f, max(0, at - (1 << 16)))
    last = b""
    for place, data in blocks(f, begin):
        if place >= at:
            break
        last = data or last
    return last.endswith(b"\n")


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "read_id string, seq string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return _Fastq(self.options)


# ---- FASTA


PIECE = 1 << 20


@dataclass
class _Piece(InputPartition):
    """Pieces of contigs: (name, first base, bases, byte, bytes)."""

    path: str
    pieces: list[tuple[str, int, int, int, int]]


def _index(path: str) -> list[tuple[str, int, int, int, int]] | None:
    """name, size, offset, bases and bytes of a line, of each contig of ``path.fai``; None without that file."""
    from pyarrow import fs

    system, inner = _filesystem(path + ".fai")
    if path.endswith(".gz") or system.get_file_info(inner).type != fs.FileType.File:
        return None
    with system.open_input_stream(inner) as f:
        rows = [line.split("\t") for line in f.read().decode().splitlines() if line]
    return [(r[0], *map(int, r[1:5])) for r in rows]


def index_fasta(spark: SparkSession, path: str, endings: tuple[str, ...] = (".fa", ".fasta")) -> int:
    """Writes the index of each plain FASTA file at or below ``path`` beside it: a task for a file. All lines of a contig but
    the last must be equally long. Returns the number of contigs."""
    files = [p for p, _ in _files(path, endings)]

    def one(frames: Iterator) -> Iterator:
        import pyarrow as pa

        n = 0
        for frame in frames:
            for name in frame["path"].to_pylist():
                rows, at = [], 0
                with _stream(name) as f:
                    for line in io.BufferedReader(f, 1 << 20):
                        bare = line.rstrip(b"\r\n")
                        if line.startswith(b">"):
                            rows.append([bare[1:].split()[0].decode(), 0, at + len(line), 0, 0, False])
                        elif bare and rows:
                            r = rows[-1]
                            if r[5] or (r[3] and len(bare) > r[3]):
                                raise ValueError(f"{name}: lines of {r[0]} differ in length")
                            r[3], r[4] = r[3] or len(bare), r[4] or len(line)
                            r[5] = len(bare) < r[3]
                            r[1] += len(bare)
                        at += len(line)
                system, inner = _filesystem(name + ".fai")
                with system.open_output_stream(inner) as out:
                    out.write("".join("\t".join(map(str, r[:5])) + "\n" for r in rows).encode())
                n += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    if not files:
        return 0
    rows = spark.createDataFrame([(p,) for p in files], "path string").repartition(len(files), "path")
    return sum(r.n for r in rows.mapInArrow(one, "n long").collect())


class _Fasta(_FileReader):
    """Pieces of contigs: no row is longer than option ``pieceBases`` (2^20). With an index (``.fai``) a contig's pieces are
    read by ranges, ``splitBytes`` of them a task; option ``contigs`` names those to read, with commas between."""

    endings = (".fa", ".fasta", ".fa.gz", ".fasta.gz")

    def partitions(self) -> list[InputPartition]:
        piece = int(self.options.get("piecebases", self.options.get("pieceBases", PIECE)))
        files = self.files()
        most = _range_bytes(self.wanted(), sum(size for _, size in files))
        out: list[InputPartition] = []
        for path, _ in files:
            index = _index(path)
            if index is None:
                out.append(_Range(path, 0, None))
                continue
            held, size = [], 0
            for name, bases, offset, line, width in index:
                if not self._wanted(name):
                    continue
                byte = lambda b: offset + b // line * width + b % line if line else offset  # noqa: B023, E731
                for a in range(0, bases, piece):
                    n = min(piece, bases - a)
                    held.append((name, a, n, byte(a), byte(a + n - 1) + 1 - byte(a)))
                    size += n
                    if size >= most:
                        out.append(_Piece(path, held))
                        held, size = [], 0
            if held:
                out.append(_Piece(path, held))
        return out

    def _wanted(self, name: str) -> bool:
        return "contigs" not in self.options or name in self.options["contigs"].split(",")

    def read(self, part: InputPartition) -> Iterator[tuple]:
        if isinstance(part, _Piece):
            with _open(part.path) as f:
                for name, start, n, byte, size in part.pieces:
                    f.seek(byte)
                    seq = f.read(size).translate(None, b"\r\n")
                    if len(seq) != n:
                        raise ValueError(f"{part.path}: the index does not fit {name} at {start}")
                    yield name, start, seq.decode("ascii").upper()
            return
        piece = int(self.options.get("piecebases", self.options.get("pieceBases", PIECE)))
        name, start, held, size = None, 0, [], 0
        with _stream(part.path) as f:
            for line in f if part.path.endswith(".gz") else io.BufferedReader(f, 1 << 20):
                text = line.strip().decode("ascii")
                if text.startswith(">"):
                    if size and self._wanted(name):
                        yield name, start, "".join(held)
                    name, start, held, size = text[1:].split()[0], 0, [], 0
                    continue
                held.append(text.upper())
                size += len(text)
                while size >= piece:
                    whole = "".join(held)
                    if self._wanted(name):
                        yield name, start, whole[:piece]
                    start, held, size = start + piece, [whole[piece:]], size - piece
        if size and self._wanted(name):
            yield name, start, "".join(held)


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return "chrom string, start long, seq string"

    def reader(self, schema) -> DataSourceReader:
        return _Fasta(self.options)


# ---- BAM


#: The format's letters of bases, its letters of tag types and their widths.
_SEQ = "=ACMGRSVTWYHKDBN"
_TAG = {b"A": ("c", 1), b"c": ("b", 1), b"C": ("B", 1), b"s": ("h", 2), b"S": ("H", 2), b"i": ("i", 4), b"I": ("I", 4), b"f": ("f", 4)}
#: A byte holds two bases, as its two hexadecimal digits tell.
_BASES = str.maketrans("0123456789abcdef", _SEQ)
_HEX = str.maketrans(_SEQ, "0123456789abcdef")
_PHRED = bytes((q + 33) & 255 for q in range(256))
_LONGEST = 1 << 29


def _tags(data: bytes) -> dict[str, str]:
    out, at = {}, 0
    while at < len(data):
        key, kind, at = data[at : at + 2].decode(), data[at + 2 : at + 3], at + 3
        if kind in b"ZH":
            end = data.index(b"\0", at)
            out[key], at = data[at:end].decode(), end + 1
        elif kind == b"B":
            form, width = _TAG[data[at : at + 1]]
            n = struct.unpack_from("<I", data, at + 1)[0]
            out[key] = ",".join(map(str, struct.unpack_from(f"<{n}{form}", data, at + 5)))
            at += 5 + n * width
        else:
            form, width = _TAG[kind]
            value = struct.unpack_from("<" + form, data, at)[0]
            out[key], at = value.decode() if kind == b"A" else str(value), at + width
    return out


def _header(f, path: str) -> tuple[list[tuple[str, int]], int, int]:
    """The contigs (name, size) of a BAM file, and where its records begin: a block's place and the bytes before them in it."""
    at, sizes = 0, []

    def counted() -> Iterator[tuple[int, bytes]]:
        for place, data in blocks(f, 0):
            sizes.append((place, len(data)))
            yield place, data

    c = _Contents(f, 0)
    c.blocks = counted()
    if c.take(4) != b"BAM\1":
        raise ValueError(f"{path} is no BAM file")
    at = 12 + (text := struct.unpack("<i", c.take(4))[0])
    c.take(text)
    contigs = []
    for _ in range(struct.unpack("<i", c.take(4))[0]):
        n = struct.unpack("<i", c.take(4))[0]
        contigs.append((c.take(n)[:-1].decode(), struct.unpack("<i", c.take(4))[0]))
        at += n + 8
    c.fill(1)
    for place, n in sizes:
        if at < n:
            return contigs, place, at
        at -= n
    return contigs, f.size(), 0


def _plausible(r: bytes | bytearray, at: int, size: int, contigs: list[tuple[str, int]]) -> bool:
    """If a record of ``size`` bytes can stand at ``at``, of which at least its fixed part and its name are there."""
    ref, pos, n_name, _, _, n_cigar, _, n_seq, mate, mate_pos, _ = struct.unpack_from("<iiBBHHHiiii", r, at)
    n = len(contigs)
    if not (-1 <= ref < n and -1 <= mate < n and n_name and n_seq >= 0 and pos >= -1 and mate_pos >= -1):
        return False
    if 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq > size or (ref >= 0 and pos > contigs[ref][1]):
        return False
    name = r[at + 32 : at + 32 + n_name]
    return len(name) == n_name and name[-1] == 0 and all(33 <= b <= 126 for b in name[:-1])


def _first_record(c: _Contents, contigs: list[tuple[str, int]], chain: int = 4) -> bool:
    """Moves to the first record that begins in the range: from there records follow one another, four of them or up to the
    file's end. False if none begins here."""
    while c.mine():
        # lengths of records and their contigs at every place that this range owns of what is read
        c.fill(36)
        here = np.frombuffer(bytes(c.held[c.at :]), np.uint8).astype(np.int64)
        owned = c.owned - (c.read - len(here))
        n = min(owned, len(here) - 7)
        if n > 0:
            number = lambda i: here[i : i + n] | here[i + 1 : i + 1 + n] << 8 | here[i + 2 : i + 2 + n] << 16 | here[i + 3 : i + 3 + n] << 24  # noqa: B023, E731
            size, ref = number(0), number(4)
            able = (size >= 33) & (size < _LONGEST) & ((ref < len(contigs)) | (ref == 0xFFFFFFFF))
            del here
            for i in np.flatnonzero(able).tolist():
                at, found = i, 0
                while found < chain:
                    if not c.fill(at + 4):
                        break
                    length = struct.unpack_from("<i", c.held, c.at + at)[0]
                    if not 33 <= length < _LONGEST or not c.fill(at + 4 + min(length, 300)) or not _plausible(c.held, c.at + at + 4, length, contigs):
                        found = -1
                        break
                    at, found = at + 4 + length, found + 1
                # the file may end behind the last record, not within one
                if found == chain or (found > 0 and c.fill(at) and not c.fill(at + 1)):
                    c.at += i
                    return c.mine()
        if n <= 0:
            if not c.fill(len(c.held) - c.at + 1):
                return False
            continue
        c.at += n
    return False


class _Bam(_FileReader):
    """Options: ``mapq`` keeps primary alignments from that quality on, ``strand`` (for, rev) one strand; both before decoding."""

    endings = (".bam",)

    def read(self, r: _Range) -> Iterator[tuple]:
        with _open(r.path) as f:
            contigs, block, inner = _header(f, r.path)
            if r.stop <= block and r.stop < f.size():
                return
            if r.start <= block:
                c = _Contents(f, block, r.stop)
                c.take(inner)
            else:
                at = first_block(f, r.start)
                if at is None or at >= r.stop:
                    return
                c = _Contents(f, at, r.stop)
                if not _first_record(c, contigs):
                    return
            yield from self.records(c, [name for name, _ in contigs], r.path)

    def records(self, c: _Contents, names: list[str], path: str) -> Iterator[tuple]:
        least, strand = int(self.options.get("mapq", -1)), self.options.get("strand")
        while c.mine():
            size = struct.unpack("<i", c.take(4))[0]
            r = c.take(size)
            if len(r) < size:
                raise ValueError(f"{path} ends within a record")
            ref, pos, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", r)
            if (least >= 0 and (flag & 0x904 or mapq < least)) or (strand and (strand == "rev") != bool(flag & 16)):
                continue
            at = 32 + n_name
            cigar = [(x & 15, x >> 4) for x in struct.unpack_from(f"<{n_cigar}I", r, at)]
            at += 4 * n_cigar
            seq = r[at : at + (n_seq + 1) // 2].hex().translate(_BASES)[:n_seq] or "*"
            at += (n_seq + 1) // 2
            qual = "*" if not n_seq or r[at] == 255 else r[at : at + n_seq].translate(_PHRED).decode("latin-1")
            yield r[32 : 31 + n_name].decode(), flag, names[ref] if ref >= 0 else None, pos, mapq, cigar, seq, qual, _tags(r[at + n_seq :])


def _tag_bytes(tags: dict[str, str] | None) -> bytes:
    """Whole numbers as numbers, other values as text."""
    out = b""
    for key, value in sorted((tags or {}).items()):
        number = value.lstrip("-").isdigit() and abs(int(value)) < 1 << 31
        out += key.encode() + (b"i" + struct.pack("<i", int(value)) if number else b"Z" + value.encode() + b"\0")
    return out


def encoded_alignment(row, number: dict[str, int]) -> bytes:
    """A row of ALIGNMENT as a record of the format."""
    seq = "" if row["seq"] in (None, "*") else row["seq"]
    qual = bytes([255]) * len(seq) if row["qual"] in (None, "*") else bytes((b - 33) & 255 for b in row["qual"].encode("latin-1"))
    name, cigar = (row["read_id"] or "*").encode() + b"\0", row["cigar"] or []
    packed = bytes.fromhex((seq + "=" * (len(seq) % 2)).translate(_HEX))
    ref = number.get(row["chrom"], -1)
    fixed = struct.pack("<iiBBHHHiiii", ref, row["start"] if row["start"] is not None else -1, len(name), row["mapq"] or 0, 0, len(cigar), row["flag"] or 0, len(seq), -1, -1, 0)
    body = fixed + name + b"".join(struct.pack("<I", c["len"] << 4 | c["op"]) for c in cigar) + packed + qual + _tag_bytes(row["tags"])
    return struct.pack("<i", len(body)) + body


def bgzf_block(data: bytes) -> bytes:
    """Up to 64 KB as one block."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    head = _MAGIC + struct.pack("<I2BH", 0, 0, 255, 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


@dataclass
class _Written(WriterCommitMessage):
    staged: str
    name: str


class _BamWriter(DataSourceWriter):
    """A file for each task. Files get their names when all are written; option ``contigs`` is the header's, as ``name:size`` with commas between."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.contigs = [(n, int(s)) for n, s in (c.rsplit(":", 1) for c in options.get("contigs", "").split(",") if c)]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        system, inner = _filesystem(self.path)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam"
        system.create_dir(f"{inner}/_staged", recursive=True)
        head = b"BAM\1" + struct.pack("<ii", 0, len(self.contigs))
        for contig, size in self.contigs:
            head += struct.pack("<i", len(contig.encode()) + 1) + contig.encode() + b"\0" + struct.pack("<i", size)
        number = {contig: i for i, (contig, _) in enumerate(self.contigs)}
        with system.open_output_stream(f"{inner}/_staged/{name}") as out:
            held = head
            for row in rows:
                held += encoded_alignment(row, number)
                while len(held) > 65_000:
                    out.write(bgzf_block(held[:65_000]))
                    held = held[65_000:]
            out.write((bgzf_block(held) if held else b"") + bgzf_block(b""))
        return _Written(f"{inner}/_staged/{name}", f"{inner}/{name}")

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        system, inner = _filesystem(self.path)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                if f.path.endswith(".bam"):
                    system.delete_file(f.path)
        for m in messages:
            if m is not None:
                system.move(m.staged, m.name)
        if system.get_file_info(f"{inner}/_staged").type == fs.FileType.Directory:
            system.delete_dir(f"{inner}/_staged")

    def abort(self, messages: list) -> None:
        system, _ = _filesystem(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(m.staged)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return ALIGNMENT

    def reader(self, schema) -> DataSourceReader:
        return _Bam(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BamWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes spark.read.format("fastq"), ("fasta") and ("bam") known, and ("bam") to writers."""
    for source in (FastqSource, FastaSource, BamSource):
        spark.dataSource.register(source)


def write_fasta(contigs: DataFrame, path: str, line: int = 60) -> None:
    """Contigs (chrom, seq), a contig in one file, in lines of ``line`` bases; every task writes a file."""
    from pyspark.sql import functions as F

    lines = F.regexp_replace(F.regexp_replace("seq", f"(.{{{line}}})", "$1\n"), "\n$", "")
    contigs.select(F.concat(F.lit(">"), "chrom", F.lit("\n"), lines).alias("value")).write.mode("overwrite").text(path)


def write_fastq(reads: DataFrame, path: str) -> None:
    """Reads (read_id, seq, qual) as four lines each; every task writes a file."""
    from pyspark.sql import functions as F

    lines = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")
    reads.select(lines.alias("value")).write.mode("overwrite").text(path)
