import gzip
import struct
import zlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sigtrack.config import JobConfig
from sigtrack.operators.perbase import position_stats
from sigtrack.sources import records, sinks, tables
from sigtrack.streaming.positions import LateObservation, PositionStream, stream_stats


def write(path, text):
    path.write_text(text)
    return str(path)


def bgzf(data: bytes, size: int = 60) -> bytes:
    out = b""
    for a in [*range(0, len(data), size), None]:
        raw = b"" if a is None else data[a : a + size]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(raw) + c.flush()
        head = struct.pack("<4BI2BH", 31, 139, 8, 4, 0, 0, 255, 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
        out += head + body + struct.pack("<II", zlib.crc32(raw), len(raw))
    return out


def bam_record(name, flag, ref, pos, mapq, cigar, seq, tags=b""):
    packed = bytes((records._SEQ.index(a) << 4) | records._SEQ.index(b) for a, b in zip(seq[::2], seq[1::2] + "=" * (len(seq) % 2)))
    r = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
    r += b"".join(struct.pack("<I", n << 4 | op) for op, n in cigar) + packed + bytes([30] * len(seq)) + tags
    return struct.pack("<i", len(r)) + r


def test_bam(spark, tmp_path):
    head = b"BAM\1" + struct.pack("<i", 3) + b"@HD" + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    body = bam_record("r1", 0, 0, 7, 60, [(0, 3), (2, 1), (0, 2)], "ACGTN", b"RGZrun_barcode01\0NMi" + struct.pack("<i", 1) + b"MLBC" + struct.pack("<I", 2) + bytes([5, 250])) + bam_record("r2", 16, 0, 9, 3, [(0, 4)], "ACGT") + bam_record("r3", 4, -1, -1, 0, [], "")
    (tmp_path / "x.bam").write_bytes(bgzf(head + body))
    records.register(spark)
    got = {r.read_id: r for r in spark.read.format("bam").load(str(tmp_path / "x.bam")).collect()}
    assert got["r1"].seq == "ACGTN" and got["r1"].tags == {"RG": "run_barcode01", "NM": "1", "ML": "5,250"} and got["r1"].qual == "?????"
    assert [tuple(c) for c in got["r1"].cigar] == [(0, 3), (2, 1), (0, 2)] and got["r1"].start == 7
    assert (got["r3"].chrom, got["r3"].seq) == (None, "*")
    assert rows(spark.read.format("bam").option("mapq", 10).load(str(tmp_path)).select("read_id")) == [("r1",)]
    assert rows(spark.read.format("bam").option("strand", "rev").load(str(tmp_path)).select("read_id")) == [("r2",)]


def test_fastq_and_fasta(spark, tmp_path):
    records.register(spark)
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\n@@@@\n@r2\nAC\n+\n+@\n")
    assert rows(spark.read.format("fastq").load(str(tmp_path))) == [("r1", "ACGT", "@@@@"), ("r2", "AC", "+@")]
    write(tmp_path / "g.fa", ">c1 first\nacg\ntt\n>c2\nNN\n")
    assert rows(spark.read.format("fasta").load(str(tmp_path / "g.fa"))) == [("c1", 0, "ACGTT"), ("c2", 0, "NN")]
    write(tmp_path / "bad.fastq", "@r\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="no FASTQ record"):
        spark.read.format("fastq").load(str(tmp_path / "bad.fastq")).collect()


def test_text_tables(spark, tmp_path):
    mp = write(tmp_path / "m.tsv", 'c\t1\tA\t2\t..\t!"\nc\t2\tA\t0\t*\t\n')
    assert rows(tables.read_mpileup(spark, mp).select("pos", "quals")) == [(1, '!"')]
    bed = write(tmp_path / "f.bed", "c\t5\t9\nc\t1\t3\tn\t7\t-\n# x\n")
    assert rows(tables.read_bed(spark, bed).select("start", "strand")) == [(1, "-"), (5, "+")]
    re = write(tmp_path / "r.tsv", "c\t1\tA\t0.5\nc\t2\tA\t999999\nc\t3\tA\t-999999\nc\t4\tA\tx\nc\t5\n")
    assert rows(tables.read_reactivity(spark, re).select("pos", "reactivity")) == [(1, 0.5)]
    fai = write(tmp_path / "g.fai", "c2\t50\t4\t60\t61\nc1\t90\t70\t60\t61\n")
    assert rows(tables.read_chrom_sizes(spark, fai)) == [("c1", 90, 2), ("c2", 50, 1)]
    sam = write(tmp_path / "a.sam", "@HD\tx\nr\t16\tc\t8\t60\t3M1D2M\t*\t0\t0\tACGTA\tIIIII\tRG:Z:a:b\tNM:i:3\n")
    r = tables.read_sam(spark, sam).first()
    assert (r.start, [tuple(c) for c in r.cigar], r.tags) == (7, [(0, 3), (2, 1), (0, 2)], {"RG": "a:b", "NM": "3"})
    names = spark.createDataFrame([("/d/HG_for_vs_X.tsv.gz",)], "f string")
    assert tables.named_parts(names, "f").select("sample_of_name", "strand_of_name").first() == ("HG", "for")
    b = write(tmp_path / "b.txt", "# x\nmap | 1h / 2 / 30m 2s / 5MB / 9% | - / - / - / - / -\n")
    assert rows(tables.read_benchmarks(spark, b)) == [("map", 1802.0, None, 5)]


def test_models_and_histograms(spark, tmp_path):
    model = spark.createDataFrame([("ACG", 40, 1, 1.0, 0.5, 1.0, 0.3), ("CCC", 1, 0, 2.0, None, 2.0, 0.0)], "kmer string, n long, n_outlier long, mean double, sd double, median double, mad double")
    sinks.write_model(model, {"backend": "x", "kmer_len": 3}, str(tmp_path / "m"))
    back, meta = tables.read_kmer_model(spark, str(tmp_path / "m"))
    assert rows(back) == rows(model) and meta == {"backend": "x", "kmer_len": "3"}
    h = spark.createDataFrame([(3, 5), (10_000, 1), (7, 0)], "bin long, count long")
    for name, lag in (("h1", 1), ("h2", 1), ("h3", 0)):
        sinks.write_histogram(h, {"fisher_lag": lag}, str(tmp_path / name))
    paths = [str(tmp_path / n) for n in ("h1", "h2", "h3")]
    assert rows(tables.read_null_histograms(spark, paths[:2])) == [(10_000, 2), (3, 10)]
    with pytest.raises(ValueError):
        tables.read_null_histograms(spark, paths)


def test_sheets(spark, tmp_path):
    good = write(tmp_path / "s.tsv", "kit_barcode01\ta\nbarcode02\tb\n")
    assert rows(tables.read_sample_sheet(spark, good)) == [("barcode01", "a"), ("barcode02", "b")]
    with pytest.raises(ValueError):
        tables.read_sample_sheet(spark, write(tmp_path / "t.tsv", "barcode01\ta\nbarcode01\tb\n"))
    head = "\t".join(tables.SWEEP)
    row = "\t".join(["s1", "uncalled4", "0", "15", "0", "off", "sd", "30", "1", "p0.02"])
    assert tables.read_sweep(spark, write(tmp_path / "w.tsv", f"{head}\n{row}\n")).count() == 1
    for bad in (f"{head}\n{row}\n{row}\n", f"{head}\n{row.replace('p0.02', 'x')}\n", "set\nx\n"):
        with pytest.raises(ValueError):
            tables.read_sweep(spark, write(tmp_path / "v.tsv", bad))
    assert tables.threshold_tag("fpr0.02") == ("fpr", 0.02)


def test_sinks(spark, tmp_path):
    track = spark.createDataFrame([("c1", 2, 0.25), ("c1", 1, None), ("c2", 1, 1 / 3)], "chrom string, pos long, value double")
    sinks.write_track(track, str(tmp_path / "t"), partition_by=("chrom",))
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"chrom=c1", "chrom=c2"}
    back = spark.read.csv(str(tmp_path / "t"), sep="\t").collect()
    assert {tuple(r) for r in back} == {("2", "0.250000", "c1"), ("1", "NA", "c1"), ("1", "0.333333", "c2")}
    bg = spark.createDataFrame([("c", 0, 1, 0.5)], "chrom string, start long, end long, value double")
    sinks.write_bedgraph(bg, {"p05": 0.123456789}, str(tmp_path / "bg"))
    assert rows(tables.read_bedgraph(spark, str(tmp_path / "bg"))) == [("c", 0, 1, 0.5)]
    assert rows(tables.read_thresholds(spark, str(tmp_path / "bg"))) == [("p05", 0.1234568)]
    assert sinks.resumed(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")]) is None
    assert sinks.publish(track, str(tmp_path / "p1"), expected=3) == 3
    with pytest.raises(ValueError):
        sinks.publish(track, str(tmp_path / "p2"), expected=4)
    assert sinks.resumed(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")])[0] == 0
    sinks.write_per_read(spark.createDataFrame([("r", 2, 0.5, 1e-9), ("r", 1, None, 0.1)], "read_id string, pos long, z double, p double"), str(tmp_path / "pr"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "pr"), sep="\t", header=True).collect()] == [("r", "1", "NA", "0.1"), ("r", "2", "0.5000", "1e-09")]


def test_short_numbers(spark):
    values = [0.1, 1e-9, 123456.0, 1234567.0, 0.0, 0.12345678, -2.5, 100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(sinks.general("x", 6))
    assert [r.x for r in df.collect()] == ["NA" if v is None else f"{v:.6g}" for v in values]


OBS = "sample string, chrom string, strand string, read_start long, pos long, x double"


def stats(df):
    return position_stats(df, "x", mean_square=True)


def test_stream_equals_batch(spark, tmp_path):
    parts = [[("s", "c", "for", a + i, a + i + j, float(i * j)) for i in range(20) for j in range(5)] for a in (0, 20, 40)]
    for n, p in enumerate(parts):
        spark.createDataFrame(p, OBS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    want = rows(stats(spark.read.parquet(str(tmp_path / "in"))))
    for width in (7, 1000):
        stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        got = stream_stats(stream, str(tmp_path / f"run{width}"), stats, ["sample", "chrom", "strand"], width)
        assert rows(got) == want


def test_late_observation_is_an_error(spark, tmp_path):
    s = PositionStream(str(tmp_path / "late"), stats, ["sample", "chrom", "strand"], 10)
    s.batch(spark.createDataFrame([("s", "c", "for", 50, 55, 1.0)], OBS), 0)
    s.batch(spark.createDataFrame([("s", "d", "for", 1, 2, 1.0)], OBS), 1)
    with pytest.raises(LateObservation):
        s.batch(spark.createDataFrame([("s", "c", "for", 1, 2, 1.0)], OBS), 2)


def test_config():
    c = JobConfig.parse("# note\n^g\tx.fa.gz\n^f\tf.bed\t5\t20\n^f\tg.bed\n^w\t100\n^s\t2\n^r\ts\t/a/T1.bam\t/a/C1.fastq.gz\n^filter-mapq\t20\n^mod-calls\tremora\n^mod-pool p a b\n^igv-bam\n")
    assert c.genomes == ["x"] and c.features[0] == ("f", 5, 20) and c.features[1] == ("g", 1000, 10) and c.mapq == 20
    assert c.relationships[0][:3] == ("s", "T1", "C1") and c.pools == {"p": ["a", "b"]} and "igv-bam" in c.options
    for bad in ("^filter-mapq\t-1", "^mod-calls\tx", "^s\t9", "^mod-pool p a", "^r\ts\t/a/T.bam\t/b/T.bam"):
        with pytest.raises(ValueError):
            JobConfig.parse(bad)
