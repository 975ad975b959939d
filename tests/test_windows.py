"""Windows that cross bins, against the same in one piece."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from sigtrack.operators import calls, kmer, profile, reactivity, running, signal, sweep, windows
from sigtrack.plans import queries, support_queries  # noqa: F401  the second registers its queries
from sigtrack.plans.views import Tables


@pytest.fixture(scope="module")
def long_read(spark):
    rng = random.Random(3)
    made = [("r1", "c", p, rng.random() < 0.05, rng.random()) for p in range(1, 700) if rng.random() < 0.8] + [("r2", "c", p, p == 40, 0.5) for p in (1, 39, 40, 41, 300)]
    made += [("r3", "d", 7, None, None)]
    return spark.createDataFrame(made, "read_id string, chrom string, pos long, is_error boolean, p double")


@pytest.mark.parametrize("partitions", [3, 11])
def test_clean_context_with_halos(spark, long_read, partitions):
    one = Window.partitionBy("read_id", "chrom")
    near = F.max(F.coalesce(F.col("is_error"), F.lit(False)).cast("int")).over(one.orderBy("pos").rangeBetween(-5, 5)) == 0
    inside = (F.col("pos") - 5 >= F.min("pos").over(one)) & (F.col("pos") + 5 <= F.max("pos").over(one))
    want = rows(long_read.withColumn("clean", near & inside))
    for width in (1, 64, 1 << 16):
        assert rows(calls.clean_context(long_read.repartition(partitions), 5, width=width)) == want


@pytest.mark.parametrize("width", [1, 100, 1 << 16])
def test_fisher_windows_with_halos(spark, long_read, width):
    want = {(r.read_id, r.pos): r.combined for r in calls.fisher_combined(long_read, 9, width=1 << 40).collect()}
    got = {(r.read_id, r.pos): r.combined for r in calls.fisher_combined(long_read, 9, width=width).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("partitions", [3, 11])
def test_places_across_bins(spark, partitions):
    rng = random.Random(1)
    made = [(rng.choice("ab"), rng.randrange(500), i) for i in range(900)]
    df = spark.createDataFrame(made, "chrom string, pos long, id long").repartition(partitions)
    want = sorted((c, p, i, place) for chrom in "ab" for place, (c, p, i) in enumerate(sorted(m for m in made if m[0] == chrom), 1))
    for width in (1, 7, 1 << 20):
        assert sorted(tuple(r) for r in running.places(df, ["chrom"], ["pos", "id"], width=width).collect()) == want


@pytest.mark.parametrize("width", [1, 16, 4096])
def test_range_sums(spark, width):
    rng = np.random.default_rng(5)
    track = [("c", p, s, float(rng.integers(100)) if rng.random() < 0.9 else None, int(rng.integers(9))) for s in ("for", "rev") for p in range(1, 200) if rng.random() < 0.7]
    track += [("c", 50, "for", 3.0, 1), ("d", 5, "for", 1.0, 1)]
    asked = [(i, "c", int(a), int(a + n)) for i, (a, n) in enumerate(zip(rng.integers(-30, 230, 60), rng.integers(0, 90, 60)))] + [(60, "c", -10, 500), (60, "c", -10, 500), (61, "x", 1, 5), (62, "d", 5, 5)]
    t = spark.createDataFrame(track, "chrom string, pos long, strand string, x double, cov int")
    w = spark.createDataFrame(asked, "id int, chrom string, low long, high long")
    got = rows(running.range_sums(w, t, ["x", "cov"], ["strand"], width=width))
    want = []
    for i, c, low, high in asked:
        for s in ("for", "rev"):
            own = [r for r in track if r[0] == c and r[2] == s and low <= r[1] <= high]
            xs = [r[3] for r in own if r[3] is not None]
            if own:
                want.append((i, c, low, high, s, len(own), sum(xs, 0.0), float(sum(r[4] for r in own)), len(xs), len(own)))
    assert got == sorted(want, key=repr)


def test_profiles_explode_no_positions(spark):
    """A window costs the same whatever its width: these hold 280 million positions."""
    features = spark.createDataFrame([(i, "c", 10_000_000 + i, 10_000_100 + i, "+") for i in range(20)], "fid long, chrom string, start long, end long, strand string")
    track = spark.createDataFrame([("s", "c", 10_000_000 + 50 * p, "for", 1.0 * p) for p in range(-100, 100)], "sample string, chrom string, pos long, strand string, x double")
    wide = profile.feature_profile(features, track, ["x"], 3, 2_000_000)
    assert {r.distance for r in wide.collect()} == {0} and wide.count() == 20


def test_kmer_model_from_counts(spark):
    rng = np.random.default_rng(6)
    made = [(k, float(x)) for k, n in (("A", 301), ("B", 40), ("C", 2), ("D", 1)) for x in rng.normal(90, 2, n).round(1)] + [("A", 500.0), ("A", None), (None, 1.0), ("E", 4.0), ("E", 4.0)]
    got = {r.kmer: r for r in kmer.kmer_model(spark.createDataFrame(made, "kmer string, level double"), mad=3.0).collect()}
    by = defaultdict(list)
    for k, x in made:
        if k is not None and x is not None:
            by[k].append(x)
    assert got.keys() == by.keys()
    for k, x in by.items():
        x = np.array(x)
        med = np.median(x)
        d = np.abs(x - med)
        kept = x[d <= 3 * np.median(d)]
        r = got[k]
        assert (r.n, r.n_outlier) == (len(kept), len(x) - len(kept)) and np.isclose(r.median, med) and np.isclose(r.mad, np.median(d)) and np.isclose(r.mean, kept.mean())
        assert r.sd is None if len(kept) < 2 else abs(r.sd - kept.std(ddof=1)) < 1e-9


def test_both_medians_of_a_unit(spark):
    both = spark.createDataFrame([("u", "c", p, 2 + p, 0.1 * p, 9 - p, 0.05, "ACGT"[p % 4], 0.1 * p - 0.05) for p in range(6)] + [("v", "c", 1, 1, 0.5, 1, 0.5, "A", 0.0)], "unit string, chrom string, pos int, cov_t int, frac_t double, cov_c int, frac_c double, nt string, reactivity double")
    got = {r.unit: r for r in sweep.unit_summary(both, ["unit", "chrom"], 2).collect()}
    assert (got["u"].median_cov_t, got["u"].median_cov_c, got["u"].n, got["u"].max_pos) == (4.5, 6.5, 6, 5)
    assert got["v"].n == 0 and got["v"].median_cov_t is None


def test_trimmed_levels_of_bases(spark):
    df = spark.createDataFrame([("r", [1.0, 9.0, 2.0, 4.0, 5.0, 6.0, 100.0], [0, 1, 3, 3, 7]), ("s", [1.0], [0]), ("t", [], [0, 0]), ("u", None, None)], "read_id string, samples array<double>, bounds array<int>")
    got = {(r.read_id, r.base): (r.dwell, r.level, r.level_sd) for r in signal.base_levels(df).collect()}
    assert got == {("r", 0): (1, 1.0, 0.0), ("r", 1): (2, 5.5, 3.5), ("r", 2): (0, None, None), ("r", 3): (4, 5.5, 0.5), ("t", 0): (0, None, None)}
    span = signal.base_levels(df.where("read_id = 'r'")).withColumns({"reverse": F.lit(True), "start": F.lit(10), "bases": F.lit(4)})
    assert sorted((r.base, r.pos) for r in signal.oriented(span).collect()) == [(0, 13), (1, 12), (2, 11), (3, 10)]
    assert [r.pos for r in signal.oriented(span.withColumn("reverse", F.lit(False))).orderBy("base").collect()] == [10, 11, 12, 13]


def test_zoom_levels(spark):
    track = spark.createDataFrame([("c", p, float(p)) for p in range(1, 70)] + [("d", 5, None), ("d", 6, -2.0)], "chrom string, pos long, x double")
    got = {(r.chrom, r.level, r.start): tuple(r)[3:] for r in windows.zoom_levels(track, "x", ["chrom"], base=4, factor=4, levels=3).collect()}
    assert got["c", 0, 0] == (4, 1.0, 4.0, 10.0, 30.0) and got["c", 2, 64] == (5, 65.0, 69.0, 335.0, sum(float(p * p) for p in range(65, 70)))
    assert sum(v[0] for k, v in got.items() if k[:2] == ("c", 1)) == 69 and got["d", 2, 0] == (1, -2.0, -2.0, -2.0, 4.0)


def test_ranges_are_not_sent_whole_to_executors(spark, tmp_path):
    """A few features make many windows: by the features' size Spark would send all windows to every executor."""
    track = spark.createDataFrame([("s", "c", 50 * p, "for", 1.0 * p) for p in range(100)], "sample string, chrom string, pos long, strand string, x double")
    spark.createDataFrame([(i, "c", 40 * i, 40 * i + 9, "+") for i in range(100)], "fid long, chrom string, start long, end long, strand string").write.parquet(str(tmp_path / "f"))
    made = profile.feature_profile(spark.read.parquet(str(tmp_path / "f")), track, ["x"], 3, 10)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"(\w+Join) ", plan)[:2] == ["SortMergeJoin"] * 2


def test_a_quantile_between_equal_values_is_that_value(spark):
    """A threshold that is off in its last digit loses the positions that tie with it."""
    values = [random.Random(i).random() for i in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values) for _ in range(20 + i % 20)], "g int, x double")
    got = {r.g: [r.p05, r.p01] for r in running.group_quantiles(df, ["g"], "x", {"p05": 0.95, "p01": 0.99}).collect()}
    assert got == {i: [v, v] for i, v in enumerate(values)}
    track = spark.createDataFrame([("c", "for", p, s * values[g]) for g in range(60) for p, s in enumerate([-1.0] * 27 + [1.0])], "chrom string, strand string, pos long, reactivity double").withColumn("chrom", F.concat("chrom", F.round(F.abs("reactivity"), 12)))
    assert reactivity.significant(track, reactivity.null_thresholds(track)).where("reactivity > 0").count() == 60


@pytest.mark.parametrize("cells", [1, 7, 4096])
def test_quantiles_put_few_values_in_order(spark, monkeypatch, cells):
    """Cells of values are counted first: only those in which the wanted ranks lie are sorted."""
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(0, 1, 4000), "b": np.append(rng.normal(5, 0.1, 500), 1e9), "c": np.array([3.0]), "d": np.full(9, 0.1), "e": np.array([-np.inf, 1.0, 2.0, np.inf]), "f": rng.integers(0, 5, 300) * 1.0}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None)], "g string, x double")
    sorted_rows, real = [], running.ordered_sum
    monkeypatch.setattr(running, "ordered_sum", lambda rows, *a, **k: sorted_rows.append(rows.where("g = 'a'").count()) or real(rows, *a, **k))
    got = {r.g: (r.q1, r.q2) for r in running.group_quantiles(df, ["g"], "x", {"q1": 0.5, "q2": 0.999}, cells=cells).collect()}
    for g, vs in groups.items():
        if g != "e":
            assert np.allclose(got[g], np.quantile(vs, [0.5, 0.999]), rtol=0, atol=1e-9)
    assert got["e"][0] == 1.5 and got.keys() == groups.keys()
    assert sorted_rows[0] < {1: 4001, 7: 2500, 4096: 20}[cells]


def test_profile_by_strand_reads_stored_statistics(spark):
    """Statistics that each branch made anew were aggregated once for every use."""
    made = queries.QUERIES["agg26_profile_by_strand"](Tables(spark, "/root/testdata/sf0.001"))
    assert not any("lineitem" in f for f in made.inputFiles())


@pytest.mark.parametrize("name", ["agg13_average_profile", "srt05_profile_order"])
def test_average_profiles_send_no_windows_through_the_driver(spark, name):
    """By the size of part, all windows were to go to every executor through the driver. Of what is planned before anything
    is measured, only the names of the tracks may, which are joined by chromosome."""
    made = queries.QUERIES[name](Tables(spark, "/root/testdata/sf0.001"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"BroadcastHashJoin (\[[^]]*\])", plan)
    assert {re.sub(r"#\d+L?", "", keys) for keys in sent} == {"[chrom]"}
    assert "NestedLoop" not in plan
