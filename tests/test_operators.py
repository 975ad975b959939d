import math
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sigtrack.operators import calls, correlation, demux, kmer, perbase, planning, profile, qc, reactivity, reads, running, sweep, windows
from sigtrack.plans.queries import QUERIES

TRACK = "chrom string, pos long, strand string, cov long, value double"


def test_position_stats_interpolate(spark):
    df = spark.createDataFrame([("s", "c", 1, "for", x) for x in (1.0, 2.0, 4.0, 8.0)] + [("s", "c", 2, "for", None)], "sample string, chrom string, pos long, strand string, x double")
    r = perbase.position_stats(df, "x", mean_square=True).collect()
    assert len(r) == 1 and (r[0].cov, r[0].mean, r[0].q25, r[0].q75, r[0].mean_sq) == (4, 3.75, 1.75, 5.0, 21.25)
    assert abs(r[0].q025 - 1.075) < 1e-12


def test_pileup_stats_match_positions(spark):
    df = spark.createDataFrame([("c", 1, "A", '!+5"'), ("c", 2, "C", "I"), ("c", 3, "G", "")], "chrom string, pos long, ref string, quals string")
    got = {r.pos: r for r in perbase.pileup_stats(df).collect()}
    e = sorted(10 ** (-(ord(c) - 33) / 10) for c in '!+5"')
    assert got.keys() == {1, 2} and abs(got[1].error - statistics.mean(e)) < 1e-12 and abs(got[1].q25 - (e[0] + 0.75 * (e[1] - e[0]))) < 1e-12
    assert got[2].q025 == got[2].q975 == 10 ** (-4.0)


def test_reactivity_sides(spark):
    t = spark.createDataFrame([("c", 1, "for", 10, 0.5), ("c", 2, "for", 1, 0.5), ("c", 3, "for", 1, 0.5), ("d", 1, "for", 9, 0.5)], TRACK)
    c = spark.createDataFrame([("c", 1, "for", 10, 0.2), ("c", 2, "for", 10, 0.2), ("c", 4, "for", 1, 0.2)], TRACK)
    got = reactivity.with_sentinels(reactivity.reactivity(t, c, "value", 5))
    assert [(r.pos, r.status, round(r.reactivity, 9)) for r in got.orderBy("pos").collect()] == [(1, "both", 0.3), (3, "treatment", 999999.0), (4, "control", -999999.0)]
    assert reactivity.scored(got).count() == 1
    assert reactivity.reactivity(t, c.where("false"), "value", 5).count() == 0


def test_thresholds_and_density(spark):
    df = spark.createDataFrame([("c", i, "for", (i - 5) / 10, "both") for i in range(1, 13)], "chrom string, pos long, strand string, reactivity double, status string")
    thr = reactivity.null_thresholds(df)
    assert abs(thr.first().p05 - 0.385) < 1e-9
    sig = reactivity.significant(df, thr)
    genome = spark.createDataFrame([("c", 12, 1), ("d", 5, 2)], "chrom string, size long, rank int")
    assert rows(windows.density(sig, genome, 5).select("chrom", "start", "end", "count")) == [("c", 0, 5, 0), ("c", 10, 12, 2), ("c", 5, 10, 2)]
    assert reactivity.significant(df.where("reactivity > 0"), reactivity.null_thresholds(df.where("reactivity > 0"))).count() == 0
    means = windows.window_mean(df.where("pos < 6"), genome, 5).collect()
    assert {(r.start, round(r.mean, 6), r.n) for r in means} == {(0, -0.2, 5), (5, 0.0, 0), (10, 0.0, 0)}
    assert windows.gap_filled(df.select("chrom", "pos", "reactivity"), genome).count() == 17


def test_mod_reactivity_is_inner(spark):
    kind = "chrom string, pos long, strand string, cov long, frac double"
    t = spark.createDataFrame([("c", 1, "for", 10, 0.5), ("c", 2, "for", 10, 0.5)], kind)
    c = spark.createDataFrame([("c", 1, "for", 10, 0.25), ("c", 2, "for", 9, 0.25)], kind)
    assert rows(reactivity.mod_reactivity(t, c).select("pos", "reactivity")) == [(1, 0.25)]
    assert reactivity.repeated_positions(t.union(t)).count() == 2


def test_mad_model(spark):
    import random

    rng = random.Random(1)
    draws = [rng.gauss(5, 0.2) for _ in range(2000)]
    df = spark.createDataFrame([(11, x) for x in [*draws, 500.0, -500.0]] + [(42, 1.0), (43, None)], "kmer int, level double")
    got = {r.kmer: r for r in kmer.kmer_model(df).collect()}
    assert (got[11].n, got[11].n_outlier, got[42].n, got[42].n_outlier, got[42].sd) == (2000, 2, 1, 0, None)
    assert abs(got[11].mean - statistics.mean(draws)) < 1e-9 and abs(got[11].sd - statistics.stdev(draws)) < 1e-9
    model = kmer.kmer_model(df)
    assert rows(kmer.centre_and_spread(model).select("kmer")) == [(11,)]
    assert kmer.scored(df, model).count() == 2002
    with pytest.raises(ValueError):
        kmer.check_usable(kmer.model_coverage(df.withColumn("kmer", F.col("kmer") + 100), model))
    with pytest.raises(ValueError):
        kmer.check_compatible({"backend": "a"}, {"backend": "b"}, ("backend",))


def test_bounded_sample_is_uniform(spark):
    df = spark.range(100_000).select(F.lit("k").alias("kmer"), F.col("id"), F.col("id").cast("double").alias("level"))
    got = kmer.bounded_sample(df, "kmer", 500, [kmer.priority(1, "id"), F.col("id")])
    r = got.agg(F.count("level").alias("n"), F.avg("level").alias("m")).first()
    assert r.n == 500 and 40_000 < r.m < 60_000
    assert kmer.bounded_sample(df, "kmer", 0, []).count() == 100_000


def test_fisher_query_answers_full_windows(spark):
    class Dense:
        def obs(self):
            data = [(1, "c", i + 1, 1 + i % 50) for i in range(600)] + [(2, "c", 1, 51), (3, "c", 1, 1)]
            return spark.createDataFrame(data, "read_id long, chrom string, pos long, phred int")

    got = {(r.read_id, r.pos): r.combined for r in QUERIES["win01_fisher_window"](Dense()).collect()}
    assert len(got) == 602 and got[2, 1] == 1.0 and got[3, 1] == round(1 / 51, 6)
    for pos in (1, 7, 200, 300, 600):
        near = [i for i in range(600) if abs(i + 1 - pos) <= 200]
        s = -sum(math.log((1 + i % 50) / 51) for i in near)
        want = math.fsum(math.exp(k * math.log(s) - s - math.lgamma(k + 1)) for k in range(len(near)))
        assert abs(got[1, pos] - want) < 2e-6


def test_fisher_window(spark):
    from test_functions import gamma_tail

    data = [(3, 0.4), (5, 0.02), (6, 0.7), (8, 0.11), (30, 0.25)]
    df = spark.createDataFrame([("r", "c", q, p) for q, p in data], "read_id string, chrom string, pos long, p double")
    for lag in (1, 3):
        got = {r.pos: r.combined for r in calls.fisher_combined(df, lag).collect()}
        for q, _ in data:
            near = [p for x, p in data if abs(x - q) <= lag]
            assert abs(got[q] - gamma_tail(-sum(map(math.log, near)), len(near))) < 1e-10
    assert [r.combined for r in calls.fisher_combined(df, 0).orderBy("pos").collect()] == [p for _, p in data]


def test_error_mask_and_clean_context(spark):
    reference = "ACGT" * 5
    ref = spark.createDataFrame([("c", i + 1, b) for i, b in enumerate(reference)], "chrom string, pos long, nt string")
    read = [("r", "c", 0, [(0, 5), (1, 1), (0, 4), (2, 2), (0, 5)], "ACGAA" + "T" + "CGTA" + "TACGT", "I" * 15)]
    a = spark.createDataFrame(read, "read_id string, chrom string, start long, cigar array<struct<op:int,len:int>>, seq string, qual string")
    mask = reads.error_mask(a, ref, ["read_id", "chrom"])
    assert [r.pos - 1 for r in mask.where("is_error").orderBy("pos").collect()] == [3, 4, 5, 9, 10]
    assert [r.pos - 1 for r in calls.clean_context(mask, 1).where("clean").orderBy("pos").collect()] == [1, 7, 12, 13, 14]
    assert calls.clean_context(mask, -1).where("clean").count() == 16
    assert reads.pileup_errors(a, ["read_id", "chrom"]).count() == 14


def test_call_totals_and_cutoff(spark):
    df = spark.createDataFrame([("c1", 65536, -3.0, True), ("c1", 65536, -1.0, True), ("c2", 3, 4.0, True)], "chrom string, pos long, z double, called boolean")
    got = calls.call_totals(df, ["chrom", "pos"])
    assert rows(got.select("chrom", "pos", "cov", "n_mod", "mean_z", "mean_absz", "frac")) == [("c1", 65536, 2, 2, -2.0, 2.0, 1.0), ("c2", 3, 1, 1, 4.0, 4.0, 1.0)]
    h = spark.createDataFrame([(0, 90), (5, 8), (200, 2)], "bin long, count long")
    assert calls.cutoff(h, 0.02).first().cutoff == 0.06
    assert round(calls.cutoff(h, 0.019).first().cutoff, 9) == 2.01
    assert calls.cutoff(h.where("false"), 0.02).first().cutoff == float("inf")
    assert calls.cutoff(calls.pooled(h, h), 0.1).first().cutoff == 0.01


def test_profile_edges(spark):
    f = spark.createDataFrame([(1, "c", 10, 12, "+"), (2, "c", 10, 12, "-"), (3, "c", 10, 12, None)], "fid long, chrom string, start long, end long, strand string")
    track = spark.createDataFrame([("s", "c", p, "for", float(p)) for p in range(1, 40)], "sample string, chrom string, pos long, strand string, x double")
    got = {(r.fid, r.distance): r.x for r in profile.feature_profile(f, track, ["x"], 1, 4).collect()}
    assert got[1, 0] == 10 and got[1, 4] == 14 and got[1, -4] == 6 and got[2, -4] == 16 and got[2, 4] == 8 and got[3, 0] == 10
    assert profile.feature_windows(f, 1, 4).where("fid = 2 and distance = 4").select("low", "high").first() == (6, 10)
    flat = {r.distance: (r.x, r.n) for r in profile.average_profile(profile.feature_profile(f, track, ["x"], 1, 4), ["x"]).collect()}
    assert flat[0] == (pytest.approx((10 + 12 + 10) / 3), 3)


def test_weighted_halves(spark):
    df = spark.createDataFrame([("s", x, 0.1) for x in (5, 3, 2)], "sample string, length long, error double")
    assert qc.n50(df, ["sample"]).first().n50 == 5
    assert qc.n50(df.union(df.limit(0)).where("length < 5"), ["sample"]).first().n50 == 3
    assert qc.q50(df, ["sample"]).first().q50 == 10.0
    assert qc.read_totals(df, ["sample"]).first().giga_bp == 0.0
    assert qc.read_stats(df, ["sample"]).count() == 1
    with pytest.raises(ValueError):
        qc.check_has_reads(qc.read_stats(df.where("false"), ["sample"]))


def test_alignment_tables(spark):
    df = spark.createDataFrame([("s", f, q, 10, 1, {"MM": "x"}) for f, q in ((0, 60), (16, 3), (4, 0), (256, 60), (2048, 60))], "sample string, flag int, mapq int, length long, mismatches long, tags map<string,string>")
    assert qc.filtered(df, 10).count() == 1 and qc.primary(df).count() == 2
    with pytest.raises(ValueError):
        qc.filtered(df, -1)
    c = qc.flag_counts(df, ["sample"]).first()
    assert (c.total, c.primary, c.secondary, c.supplementary, c.mapped, c.reverse) == (5, 3, 1, 1, 4, 1)
    s = qc.alignment_summary(df, ["sample"])
    assert s.first().error_rate == pytest.approx(0.1)
    table = qc.pivoted(qc.stats_table(s, s, ["bases", "error_rate"], ["sample"]), ["bases", "error_rate"], ["sample"])
    assert table.count() == 2
    gone = reads.kept_tags(df, ["ML"])
    assert qc.tag_survival(df, gone, ["MM", "ML"]).where("lost").first().tag == "MM"


def test_winsorised(spark):
    df = spark.createDataFrame([("s", v, 1) for v in range(101)] + [("t", 7, 3)], "sample string, value long, count long")
    got = qc.winsorised(df, ["sample"])
    assert got.where("sample = 's'").agg(F.sum("count")).first()[0] == 101
    r = got.where("sample = 't'").first()
    assert (r.bin, r["count"]) == (1, 3)


def test_correlations(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 2.0, 9.0), ("a", None, 1.0), ("b", 1.0, 1.0), ("b", 2.0, 2.0)], "k string, x double, y double")
    got = {r.k: r for r in correlation.correlations(df, "x", "y", ["k"]).collect()}
    assert got["a"].n_points == 3 and round(got["a"].spearman, 6) == 0.866025 and got["b"].pearson is None


def test_coverage_runs_across_bins(spark):
    df = spark.createDataFrame([("c", 0, 10), ("c", 5, 12), ("c", 12, 15), ("c", 40, 41)], "chrom string, start long, end long")
    want = [(0, 5, 1), (10, 15, 1), (40, 41, 1), (5, 10, 2)]
    for width in (1, 4, 100):
        assert rows(running.coverage_runs(df, width=width).select("start", "end", "depth")) == want


def test_demux(spark):
    sheet = demux.sample_sheet(spark.createDataFrame([("kit_barcode01", "a"), ("barcode01", "a"), ("barcode02", "b")], "barcode string, sample string"))
    r = spark.createDataFrame([("run_x_barcode01", 5), ("run_x_barcode09", 7), (None, 0), ("", 1)], "read_group string, bases long")
    got = rows(demux.demux_counts(demux.assigned(r, sheet)))
    assert got == [("a", "barcode01", "run", 1, 5), ("unclassified", "NA", "NA", 2, 1), ("unclassified", "barcode09", "run", 1, 7)]
    demux.check_conserved(demux.conservation(r, demux.demux_counts(demux.assigned(r, sheet))))
    with pytest.raises(ValueError):
        demux.check_conserved(demux.conservation(r, demux.demux_counts(demux.assigned(r.limit(1), sheet))))
    bad = spark.createDataFrame([("barcode01", "a"), ("barcode01", "b"), ("barcode02", "unclassified")], "barcode string, sample string")
    assert {f.fault for f in demux.sheet_faults(bad).collect()} == {"two samples", "reserved name"}


def test_sweep(spark):
    rel = spark.createDataFrame([("r1", "t", "c"), ("r2", "t", "x")], "relationship string, treatment string, control string")
    pools = spark.createDataFrame([("p", ["c", "d"]), ("q", ["c", "gone"])], "pool string, members array<string>")
    have = spark.createDataFrame([("c",), ("d",), ("t",)], "sample string")
    assert rows(sweep.model_sets(rel, pools, have)) == [("r1", "matched"), ("r1", "p")]
    kind = "unit string, chr string, pos long, nt string, cov long, frac double"
    t = spark.createDataFrame([("u", "c", 1, "T", 9, 0.9), ("u", "c", 2, "A", 9, 0.9), ("u", "c", 3, "A", 1, 0.1), ("v", "c", 1, "A", 1, 0.5)], kind)
    c = spark.createDataFrame([("u", "c", 1, "T", 9, 0.1), ("u", "c", 2, "A", 9, 0.1)], kind)
    joined = sweep.unit_join(t, c, ["unit", "chr", "pos"])
    got = {r.unit: r for r in sweep.unit_summary(joined, ["unit", "chr"], 5).collect()}
    assert (got["u"].n, got["u"].max_pos, got["u"].n_t, got["u"].n_reactive) == (2, 1, 1, 2) and got["v"].n == 0 and got["v"].background is None


def test_planning(spark):
    df = spark.createDataFrame([("8h 35m 44.3s", "6953MB"), ("-", "-"), ("1.5s", "3MB")], "t string, m string").select(planning.seconds(F.col("t")), planning.megabytes(F.col("m")))
    assert [tuple(r) for r in df.collect()] == [(pytest.approx(30944.3), 6953), (None, None), (1.5, 3)]
    jobs = spark.createDataFrame([("a", 10), ("new", 5)], "rule string, count long")
    history = spark.createDataFrame([("a", 3600.0, 7200.0, 9)], "rule string, avg_1 double, avg_2 double, rss_mb long")
    r = planning.estimate(jobs, history, 2).first()
    assert (r.work_s, r.hours, r.rss_mb, r.rss_rule) == (72000.0, 12, 9, "a")


def test_nested_reads_round_trip(spark):
    df = spark.createDataFrame([("r", 3, 1), ("r", 1, 2), ("s", 5, 5)], "read_id string, pos long, x long")
    assert rows(reads.exploded(reads.nested(df, ["read_id"], ["pos", "x"]), ["read_id"])) == rows(df)
    signal = spark.createDataFrame([("p",)], "read_id string")
    r = spark.createDataFrame([("a", {"pi": "p"}), ("b", {})], "read_id string, tags map<string,string>")
    assert rows(reads.with_signal(r, signal).select("read_id", "has_signal")) == [("a", True), ("b", False)]


def test_sampled_positions(spark):
    genome = spark.createDataFrame([("c", 100, 1), ("d", 300, 2)], "chrom string, size long, rank int")
    got = correlation.sampled_positions(genome, 2000)
    assert got.count() == 2000 and got.where("pos < 1 or pos > 300").count() == 0
    assert 1350 < got.where("chrom = 'd'").count() < 1650
    assert correlation.sampled_positions(genome.where("false"), 10).count() == 0


def test_indels_coverage_and_brackets(spark):
    got = {(r.var, r.value): r["count"] for r in qc.indel_lengths(spark.createDataFrame([("3M2I4M1D",), ("2I",), (None,), ("*",)], "cigar string")).collect()}
    assert got == {("INS", "2"): 2, ("DEL", "1"): 1}
    runs = spark.createDataFrame([("c", 0, 5, 1), ("c", 5, 6, 7), ("c", 6, 9, 2000)], "chrom string, start long, end long, depth long")
    assert rows(qc.coverage_histogram(runs, ["chrom"])) == [("c", "COV", "[1-1]", 5), ("c", "COV", "[7-7]", 1), ("c", "COV", "[>=1000]", 3)]
    text = spark.createDataFrame([("[7-9]",), ("[>=1000]",), ("[1-1]",), ("x",), (None,)], "v string")
    assert [r[0] for r in text.select(qc.bracket_start(F.col("v"))).collect()] == [7.0, 1000.0, 1.0, None, None]


def test_pooled_model_widens(spark):
    side = lambda at: spark.createDataFrame([("AC", at + d) for d in (-1.0, 0.0, 1.0) * 12], "kmer string, level double")
    one, both = kmer.kmer_model(side(10.0)).first(), kmer.pooled_model([side(10.0), side(14.0)]).first()
    assert both.mean == 12.0 and both.sd > one.sd and both.n == 2 * one.n


def test_missing_contigs(spark):
    track, genome = spark.createDataFrame([("a",), ("b",), (None,)], "chrom string"), spark.createDataFrame([("a", 5)], "chrom string, size long")
    with pytest.raises(ValueError, match="b"):
        perbase.missing_contigs(track, genome)
    with pytest.warns(UserWarning, match="b"):
        assert perbase.missing_contigs(track, genome, "warn") == ["b"]
    assert perbase.missing_contigs(track.where("chrom = 'a'"), genome) == []


def test_tags_of_the_first_records(spark):
    df = spark.range(20, numPartitions=1).select(F.create_map(F.when(F.col("id") < 10, "mv").otherwise("MM"), F.lit("1")).alias("tags"))
    assert reads.tags_present(df, ["mv", "MM"], 10) == {"mv": True, "MM": False} and reads.tags_present(df, ["MM"]) == {"MM": True}
    assert reads.tags_present(df.limit(0), ["mv"]) == {"mv": False}


def test_exact_quantiles_of_groups(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    data = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 501), ("d", 40)) for v in np.round(rng.normal(size=n), 1)] + [("e", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: (r.lo, r.mid, r.hi) for r in running.group_quantiles(df, ["g"], "v", {"lo": 0.05, "mid": 0.5, "hi": 0.999}).collect()}
    assert set(got) == set("abcd")
    for g in got:
        assert np.allclose(got[g], np.quantile([v for k, v in data if k == g], [0.05, 0.5, 0.999]))
    ranks = {r.v: r.rank for r in correlation.average_rank(df.where("g = 'c'"), "v", ["g"], "rank").collect()}
    values = np.array([v for k, v in data if k == "c"])
    assert all(np.isclose(ranks[v], (values < v).sum() + ((values == v).sum() + 1) / 2) for v in ranks)


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    from sigtrack.streaming.positions import LateObservation, PositionStream

    batch = lambda data: spark.createDataFrame([("s", "c", "for", p, start, 1.0) for p, start in data], "sample string, chrom string, strand string, pos long, read_start long, x double")
    stats = lambda df: perbase.position_stats(df, "x")
    make = lambda: PositionStream(f"file://{tmp_path}/s", stats, ["sample", "chrom", "strand"], 10)
    make().batch(batch([(3, 1), (12, 5), (14, 5)]), 0)
    make().batch(batch([(12, 11), (25, 22)]), 1)
    make().batch(batch([(12, 11), (25, 22)]), 1)  # repeated after a crash
    with pytest.raises(LateObservation):
        make().batch(batch([(4, 23)]), 2)
    got = {r.pos: r.cov for r in make().finish(spark).collect()}
    assert got == {3: 1, 12: 2, 14: 1, 25: 1}
