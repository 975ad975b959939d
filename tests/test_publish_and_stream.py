import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sigtrack.operators import qc
from sigtrack.operators.perbase import position_stats
from sigtrack.sources import sinks, tables
from sigtrack.streaming import keyed
from sigtrack.streaming.keyed import KeyedStream, on_genome
from sigtrack.streaming.positions import LateObservation

KEYS = ["sample", "chrom", "strand"]


def test_a_failed_publish_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/table"
    first, second = spark.range(5), spark.range(5, 12)
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, path)
    assert sinks.publish(first, path) == 5
    # while writing, at the count and between the rows and the pointer
    broken = second.select(F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    with pytest.raises(ValueError, match="7 rows were written, 8 expected"):
        sinks.publish(second, path, expected=8)

    def fails(*_):
        raise OSError("no rename")

    with monkeypatch.context() as m:
        m.setattr(sinks, "_point", fails)
        with pytest.raises(OSError, match="no rename"):
            sinks.publish(second, path)
    with pytest.raises(sinks.NoSpace):
        sinks.publish(second, path, need_bytes=1 << 62)
    assert rows(sinks.published(spark, path)) == rows(first)
    reader = sinks.published(spark, path)
    assert sinks.publish(second, path) == 7
    # who read the version before goes on with it; older ones are gone after the next
    assert rows(reader) == rows(first) and rows(sinks.published(spark, path)) == rows(second)
    sinks.publish(sinks.published(spark, path).where("id > 10"), path)
    assert rows(sinks.published(spark, path)) == [(11,)]
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("_v")]) == 2
    assert sinks.resumed(spark, [path, f"{path}2"])[1].count() == 1


def test_statistics_as_text(spark, tmp_path):
    flat = "raw total sequences:\t12\t# all\nSN\treads mapped:\t9\n"
    (tmp_path / "one.txt").write_text(f"# comment\nCHK\tx\ty\nSN\t{flat}SN\terror rate:\t1.5e-03\t# e\nRL\t80\t3\nMAPQ\t60\t2\nID\t4\t7\t1\nCOV\t[1-1]\t1\t30\nSN\todd:\tx\n")
    got = rows(tables.read_stats(spark, str(tmp_path / "one.txt")).drop("sample"))
    assert got == sorted([("SN", "raw total sequences", 12.0), ("SN", "reads mapped", 9.0), ("SN", "error rate", 0.0015), ("RL", "80", 3.0), ("MAPQ", "60", 2.0), ("INS", "4", 7.0), ("DEL", "4", 1.0), ("COV", "[1-1]", 1.0), ("SN", "odd", None)], key=repr)
    (tmp_path / "flag.txt").write_text("12 + 1 in total (QC-passed reads + QC-failed reads)\n9 + 0 primary mapped (75.00% : N/A)\n0 + 0 mapped (N/A : N/A)\n")
    assert rows(tables.read_flagstat(spark, str(tmp_path / "flag.txt")).drop("sample")) == [("in_total", 12, 1), ("mapped", 0, 0), ("primary_mapped", 9, 0)]
    hist = spark.createDataFrame([("a b", "RL", "5", 2), ("c", "INS", "1", 3), ("c", "DEL", "1", 4)], "sample string, var string, value string, count long")
    sinks.write_stats(spark.createDataFrame([("a b", 3, 1.5), ("c", 1, None)], "sample string, n long, rate double"), hist, str(tmp_path / "w"))
    assert rows(tables.read_stats(spark, str(tmp_path / "w"))) == sorted([("a b", "SN", "n", 3.0), ("a b", "SN", "rate", 1.5), ("a b", "RL", "5", 2.0), ("c", "SN", "n", 1.0), ("c", "SN", "rate", None), ("c", "INS", "1", 3.0), ("c", "DEL", "1", 4.0)], key=repr)
    counts = qc.flag_counts(spark.createDataFrame([("s", 0), ("s", 4), ("t", 16)], "sample string, flag int"), ["sample"])
    sinks.write_flagstat(counts, str(tmp_path / "f"))
    back = {(r.sample, r.name): r.passed for r in tables.read_flagstat(spark, str(tmp_path / "f")).collect()}
    assert back["s", "total"] == 2 and back["s", "mapped"] == 1 and back["t", "primary_mapped"] == 1


OBS = "sample string, chrom string, strand string, pos long, read_start long, x double"


def observations():
    """Reads of five positions in the order of the genome, on two contigs."""
    return [("s" if i % 3 else "t", c, "for", p + j, p, float(p * j)) for c in ("c1", "c2") for i, p in enumerate(range(0, 60, 2)) for j in range(5)]


def test_keyed_stream_carries_windows_on(spark, tmp_path):
    genome = spark.createDataFrame([("c1", 64, 1), ("c2", 64, 2)], "chrom string, size long, rank int")
    stats = lambda df: position_stats(df, "x")
    data = observations()
    want = rows(stats(spark.createDataFrame(data, OBS)))
    for width, cuts in ((7, (0, 101, 160, 223, 300)), (1000, (0, 150, 300))):
        root = f"file://{tmp_path}/{width}"
        schema = None
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            rows_ = on_genome(spark.createDataFrame(data[a:b], OBS), genome, width)
            schema = rows_.schema
            if b == 300:
                last = spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != "coordinate"), F.lit(10_000).cast("long").alias("coordinate"))
                rows_ = rows_.unionByName(last)
            rows_.repartition(3).write.mode("append").parquet(f"{root}/in")
            # another object each time: all that it goes on from is in the folder
            stream = KeyedStream(f"{root}/run", stats, KEYS, [*KEYS, "pos", "x"], width)
            stream.run(spark.readStream.schema(schema).parquet(f"{root}/in"))
            if b < 300:
                done = stream.results(spark).select("chrom", "pos").collect()
                start = {c: max((r[4] for r in data[a:b] if r[1] == c), default=None) for c in ("c1", "c2")}
                # given out is what lies in windows that the latest read is beyond: all of a contig once the next has begun
                assert all(r.chrom == "c1" or r.pos // width < start["c2"] // width for r in done)
                if width == 7:
                    assert len(done) > 0 and (start["c2"] is None or {r.pos for r in done if r.chrom == "c1"} == set(range(63)))
        assert rows(stream.results(spark)) == want


def test_late_observation_of_a_keyed_stream(spark, tmp_path):
    genome = spark.createDataFrame([("c1", 1000, 1)], "chrom string, size long, rank int")
    root, stats = f"file://{tmp_path}/late", lambda df: position_stats(df, "x")
    stream = KeyedStream(f"{root}/run", stats, KEYS, [*KEYS, "pos", "x"], 10)
    run = lambda: stream.run(spark.readStream.schema(schema).parquet(f"{root}/in"))
    for k, start in enumerate((500, 500, 20)):
        rows_ = on_genome(spark.createDataFrame([("s", "c1", "for", start + 1, start, 1.0)], OBS), genome, 10)
        schema = rows_.schema
        rows_.write.mode("append").parquet(f"{root}/in")
        if k < 2:  # a read that starts where the latest one did is not late
            run()
    with pytest.raises(LateObservation):
        run()
    with pytest.raises(LateObservation, match="earlier run"):
        run()


def test_observations_reach_the_state_packed_by_window():
    """Rows go to Python's state one by one, so a window's are one row: 2,000 observations of two windows are three rows."""
    import pyarrow as pa

    made = [("s", p // 1000, 1, p + 7, p, 0.5 * p) for p in range(2000)]
    random.Random(2).shuffle(made)
    names = ["k", "window", "due", "coordinate", "pos", "x"]
    rows_ = pa.table([list(c) for c in zip(*made)], names=names)
    end = pa.table([pa.array([v], f.type) for v, f in zip((None, None, 0, 5000, None, None), rows_.schema)], names=names)
    batches = pa.concat_tables([rows_, end]).combine_chunks().to_batches(300)
    (out,) = [b.to_pylist() for b in keyed._packer(["k"], ["k", "pos", "x"])(iter(batches))]
    assert [(r["k"], r["window"], r["due"], r["coordinate"]) for r in out] == [("s", 0, 1, 7), ("s", 1, 1, 1007), ("", -1, 0, 5000)]
    held = [pa.ipc.open_stream(r["observations"]).read_all().to_pylist() for r in out[:2]]
    assert sorted((r["pos"], r["x"]) for w in held for r in w) == [(p, 0.5 * p) for p in range(2000)] and out[2]["observations"] is None
    (only,) = keyed._packer(["k"], ["k", "pos", "x"])(iter(end.to_batches()))
    assert only.num_rows == 1
