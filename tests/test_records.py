import gzip
import random
import struct

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sigtrack.operators import perbase
from sigtrack.sources import records


def split(reader, path, step, **options):
    """How many splits a reader makes of a path, and all that they read."""
    r = reader({"path": str(path), "splitbytes": str(step), **options})
    parts = r.partitions()
    return len(parts), [row for p in parts for row in r.read(p)]


@pytest.fixture(scope="module")
def fastq():
    """Reads whose qualities look like names, separators and sequences."""
    rng = random.Random(1)
    made = []
    for i in range(250):
        n = rng.choice([0, 1, 2, 3, 60, 400])
        made.append((f"r{i}", "".join(rng.choice("ACGTN") for _ in range(n)), "".join(rng.choice("@@@+ACI") for _ in range(n))))
    text = "".join(f"@{a} c=1\n{s}\n+{a if i % 2 else ''}\n{q}{chr(13) if i % 5 == 0 else ''}\n" for i, (a, s, q) in enumerate(made))
    return made, text.encode()


@pytest.mark.parametrize("step", [1, 2, 13, 64, 1000, 7777, 1 << 30])
def test_fastq_is_the_same_for_any_split(tmp_path, fastq, step):
    made, text = fastq
    (tmp_path / "a.fastq").write_bytes(text)
    (tmp_path / "b.fq").write_bytes(text[:-1])  # no line feed at its end
    n, got = split(records._Fastq, tmp_path / "a.fastq", step)
    assert got == made and n == -(-len(text) // step)
    assert split(records._Fastq, tmp_path / "b.fq", step)[1] == made
    blocks = b"".join(records.bgzf_block(text[a : a + 83]) for a in range(0, len(text), 83)) + records.bgzf_block(b"")
    (tmp_path / "c.fastq.gz").write_bytes(blocks)
    assert split(records._Fastq, tmp_path / "c.fastq.gz", max(step, 50))[1] == made
    (tmp_path / "d.fastq.gz").write_bytes(gzip.compress(text))
    assert split(records._Fastq, tmp_path / "d.fastq.gz", step) == (1, made)


def test_faulty_fastq(tmp_path):
    for text in (b"@r\nACGT\n+\nII\n", b"@r\nACGT\n", b"r\nA\n+\nI\n", b"@a\nA\n+\nI\n@b\nAA\n-\nII\n"):
        (tmp_path / "x.fastq").write_bytes(text)
        with pytest.raises(ValueError, match="no FASTQ record"):
            split(records._Fastq, tmp_path / "x.fastq", 1 << 20)
    (tmp_path / "x.fastq").write_bytes(b"")
    assert split(records._Fastq, tmp_path / "x.fastq", 10)[1] == []


def alignments(n=300):
    rng = random.Random(2)
    for i in range(n):
        m = rng.choice([0, 1, 2, 33, 300, 5000])
        seq = "".join(rng.choice("ACGTN") for _ in range(m)) or "*"
        # zeros and small numbers among the qualities look like lengths and contigs
        qual = "".join(chr(33 + rng.choice([0, 0, 0, 1, 2, 60])) for _ in range(m)) or "*"
        cigar = [{"op": 4, "len": 1}, {"op": 0, "len": m - 1}] if m > 1 else []
        yield {"read_id": f"read-{i}" * rng.choice([1, 9]), "flag": rng.choice([0, 16, 4, 2048]), "chrom": rng.choice(["c1", "c2", None]), "start": rng.randrange(-1, 900), "mapq": rng.randrange(60), "cigar": cigar, "seq": seq, "qual": qual, "tags": {"NM": str(rng.randrange(-5, 9)), "RG": "run_barcode01"}}


def bam_bytes(made):
    head = b"BAM\1" + struct.pack("<ii", 0, 2)
    for name, size in (("c1", 1000), ("c2", 5000)):
        head += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size)
    return head + b"".join(records.encoded_alignment(r, {"c1": 0, "c2": 1}) for r in made)


@pytest.mark.parametrize("block", [41, 700, 65000])
def test_bam_is_the_same_for_any_split(tmp_path, block):
    made = list(alignments())
    data = bam_bytes(made)
    (tmp_path / "x.bam").write_bytes(b"".join(records.bgzf_block(data[a : a + block]) for a in range(0, len(data), block)) + records.bgzf_block(b""))
    want = [(r["read_id"], r["flag"], r["chrom"], r["start"], r["mapq"], [(c["op"], c["len"]) for c in r["cigar"]], r["seq"], r["qual"], r["tags"]) for r in made]
    size = (tmp_path / "x.bam").stat().st_size
    for parts in (1, 2, 7, 40, 150):
        n, got = split(records._Bam, tmp_path / "x.bam", size // parts + 1)
        assert got == want and n == parts


def test_bam_of_few_and_of_no_records(tmp_path):
    for made in (list(alignments(1)), []):
        data = bam_bytes(made)
        (tmp_path / "y.bam").write_bytes(b"".join(records.bgzf_block(data[a : a + 20]) for a in range(0, len(data), 20)) + records.bgzf_block(b""))
        for step in (30, 200, 1 << 20):
            assert len(split(records._Bam, tmp_path / "y.bam", step)[1]) == len(made)
    (tmp_path / "z.bam").write_bytes(records.bgzf_block(data[: len(data) // 2] + b"x"))
    with pytest.raises((ValueError, struct.error)):
        split(records._Bam, tmp_path / "z.bam", 1 << 20)


def test_bam_written_by_spark(spark, tmp_path):
    records.register(spark)
    made = list(alignments(80))
    df = spark.createDataFrame([tuple(r[c] for c in ("read_id", "flag", "chrom", "start", "mapq")) + ([(c["op"], c["len"]) for c in r["cigar"]], r["seq"], r["qual"], r["tags"]) for r in made], records.ALIGNMENT)
    path = f"file://{tmp_path}/out"
    df.repartition(3).write.format("bam").option("contigs", "c1:1000,c2:5000").mode("append").save(path)
    assert len(list((tmp_path / "out").glob("*.bam"))) == 3 and not (tmp_path / "out" / "_staged").exists()
    for step in (5000, 1 << 30):
        back = spark.read.format("bam").option("splitBytes", step).load(path)
        assert rows(back) == rows(df)
    df.limit(5).coalesce(1).write.format("bam").option("contigs", "c1:1000,c2:5000").mode("overwrite").save(path)
    assert spark.read.format("bam").load(path).count() == 5


def test_indexed_fasta(spark, tmp_path):
    records.register(spark)
    rng = random.Random(4)
    contigs = {f"c{i}": "".join(rng.choice("acgtN") for _ in range(n)) for i, n in enumerate((1, 59, 60, 61, 120, 3000, 4096))}
    df = spark.createDataFrame(list(contigs.items()), "chrom string, seq string")
    path = f"file://{tmp_path}/ref"
    records.write_fasta(df.repartition(2), path)
    load = lambda **o: spark.read.format("fasta").options(endings=".txt", **o).load(path)
    whole = rows(load(pieceBases=500))
    assert records.index_fasta(spark, path, (".txt",)) == len(contigs)
    for piece, step in ((500, 1), (500, 900), (1 << 20, 1 << 20)):
        got = load(pieceBases=piece, splitBytes=step)
        text = {}
        for r in sorted(got.collect()):
            assert len(r.seq) <= piece and r.start == len(text.get(r.chrom, ""))
            text[r.chrom] = text.get(r.chrom, "") + r.seq
        assert text == {k: v.upper() for k, v in contigs.items()}
    assert rows(load(pieceBases=500)) == whole
    assert load(splitBytes=900, pieceBases=500).rdd.getNumPartitions() > 5
    assert {r.chrom for r in load(contigs="c1,c5").collect()} == {"c1", "c5"}
    (tmp_path / "bad.fa").write_text(">x\nACG\nACGT\n")
    with pytest.raises(Exception, match="differ in length"):
        records.index_fasta(spark, str(tmp_path / "bad.fa"))


def test_reference_of_a_track(spark, tmp_path):
    records.register(spark)
    (tmp_path / "g.fa").write_text(">c1\n" + "ACGT" * 600 + "\n>c2\nnnRA\n")
    track = spark.createDataFrame([("c1", p) for p in (1, 2, 1024, 1025, 2400, 2401)] + [("c2", 3), ("c2", 4)] + [(f"lost{i}", 1) for i in range(1200)], "chrom string, pos long")
    with pytest.raises(ValueError, match="lost1199.*lost999"):
        perbase.reference(spark, str(tmp_path / "g.fa"), track)
    with pytest.warns(UserWarning, match="lost0"):
        pieces = perbase.reference(spark, str(tmp_path / "g.fa"), track, "warn")
    found = {(r.chrom, r.pos): r.nt for r in perbase.with_sequence_base(track, pieces).collect()}
    assert len(found) == 1208
    assert [found["c1", p] for p in (1, 2, 1024, 1025, 2400, 2401)] == ["A", "C", "T", "A", "T", "N"]
    assert found["c2", 3] == "N" and found["c2", 4] == "A" and found["lost7", 1] == "N"
    assert perbase.with_sequence_base(track, pieces.where(F.lit(False))).where("nt <> 'N'").count() == 0


@pytest.mark.parametrize("reader, ending", [(records._Fastq, ".fq"), (records._Fasta, ".fa")])
def test_ranges_grow_with_the_files(tmp_path, monkeypatch, reader, ending):
    """Short ranges of long files are no more tasks than MOST_RANGES, each byte or piece in one of them."""
    monkeypatch.setattr(records, "SHORT_BYTES", 1)
    if ending == ".fq":
        (tmp_path / "a.fq").write_bytes(b"@r\nACGT\n+\nIIII\n" * 20_000)
    else:
        (tmp_path / "a.fa").write_bytes(b">c\n" + b"A" * 300_000)
        (tmp_path / "a.fa.fai").write_text("c\t300000\t3\t300000\t300000\n")
    parts = reader({"path": str(tmp_path), "splitBytes": "10", "pieceBases": "10"}).partitions()
    assert 400 < len(parts) <= records.MOST_RANGES + 1
    if ending == ".fq":
        assert [p.start for p in parts] == [0, *(p.stop for p in parts[:-1])] and parts[-1].stop == 300_000
        assert sum(1 for p in parts for _ in reader({"path": str(tmp_path)}).read(p)) == 20_000
    else:
        assert [x[1] for p in parts for x in p.pieces] == list(range(0, 300_000, 10))
