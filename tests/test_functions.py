import math
from collections import Counter
from statistics import NormalDist

from conftest import rows
from pyspark.sql import functions as F

from sigtrack.functions import sequence as S
from sigtrack.functions import statistics as stat


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def code_of(kmer):
    """Digits of base 4, the first base the highest."""
    return sum("ACGT".index(b) * 4**i for i, b in enumerate(reversed(kmer)))


def test_kmer_codes(spark):
    for kmer in ("T", "GATTACA", "CCCCCC", "TTTTTTTTTTTT"):
        assert one(spark, S.kmer_code(F.lit(kmer))) == code_of(kmer)
        assert one(spark, S.kmer_text(S.kmer_code(F.lit(kmer)), len(kmer))) == kmer
    codes = F.transform(S.kmers(F.lit("GATNTACAGAT"), 3), S.kmer_code)
    assert one(spark, codes) == [code_of("GAT"), -1, -1, -1, code_of("TAC"), code_of("ACA"), code_of("CAG"), code_of("AGA"), code_of("GAT")]
    assert one(spark, S.kmers(F.lit("GA"), 3)) == []


def test_bases(spark):
    found = spark.createDataFrame([("A",), ("c",), ("N",), ("",), ("AC",)], "b string").select(S.base_code(F.col("b"))).collect()
    assert [r[0] for r in found] == [0, 1, 4, 4, 4]
    assert one(spark, S.reverse_complement(F.lit("AACGN"))) == "NCGTT"
    assert one(spark, S.known_base(F.lit("x"))) == "N" and one(spark, S.known_base(F.lit(None).cast("string"))) == "N"


def test_quality(spark):
    errors = one(spark, S.quality_errors(F.lit('!+"5')))
    assert [round(e, 6) for e in errors] == [1.0, 0.1, 0.794328, 0.01]
    assert one(spark, S.error_phred(F.lit(None).cast("double"))) == 0
    assert one(spark, S.read_half(F.lit("read"))) in "AB"


def test_p_values(spark):
    levels = (0.5, 0.1, 0.003)
    z = [NormalDist().inv_cdf(1 - p / 2) for p in levels]
    got = [r.p for r in spark.createDataFrame([(x,) for x in [*z, *(-x for x in z)]], "z double").select(stat.two_sided_p("z").alias("p")).collect()]
    assert all(abs(g - p) < 1e-12 for g, p in zip(got, levels * 2))
    assert [abs(stat.z_threshold(p) - x) < 1e-12 for p, x in zip(levels, z)] == [True] * 3
    edges = spark.createDataFrame([(0.0,), (None,)], "z double").select(stat.two_sided_p("z").alias("p")).collect()
    assert edges[0].p == 1 and edges[1].p is None
    assert one(spark, stat.minus_log_p(F.lit(0.0))) == 300


def gamma_tail(s, m, steps=200_000, upto=80.0):
    """The upper tail of a gamma distribution of shape m by Simpson's rule, that is of chi-square with 2m degrees at 2s."""
    h = (upto - s) / steps
    f = lambda x: math.exp((m - 1) * math.log(x) - x - math.lgamma(m)) if x > 0 else float(m == 1)
    inner = math.fsum((4 if i % 2 else 2) * f(s + i * h) for i in range(1, steps))
    return (f(s) + inner + f(upto)) * h / 3


def test_chi2_tail(spark):
    for s, m in ((0.7, 1), (2.5, 2), (9.0, 4), (30.0, 25)):
        assert abs(one(spark, stat.chi2_survival(F.lit(s), F.lit(m))) - gamma_tail(s, m)) < 1e-10
    assert one(spark, stat.chi2_survival(F.lit(0.0), F.lit(3))) == 1.0


def test_z_score_needs_a_spread(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.5), (1.0, 0.0, 0.0), (1.0, 0.0, None)], "x double, c double, s double")
    assert rows(df.select(stat.z_score(F.col("x"), F.col("c"), F.col("s")))) == [(2.0,), (None,), (None,)]


def test_context_is_padded_at_contig_ends(spark):
    df = spark.createDataFrame([("ACGT", "GG", "TTA"), ("A", "GG", None), (None, "GG", "TTA")], "a string, s string, b string")
    got = [r[0] for r in df.select(S.padded_context(F.col("a"), F.col("s"), F.col("b"), 2)).collect()]
    assert got == ["GTGGTT", "NAGGNN", "NNGGTT"]


def test_kmer_counts(spark):
    """As the k-mers one by one, also of repeated ids, other letters, short, empty and null sequences."""
    made = [(1, "ACGTNACGTACGT" * 9), (1, "ACG"), (2, "xyzxyzx"), (3, "AAAA"), (4, ""), (5, None), (2, "ACGTA")]
    df = spark.createDataFrame(made, "doc_id long, seq string")
    for k in (1, 4, 6):
        want = [(i, s, n) for i, t in made for s, n in Counter((t or "")[a : a + k] for a in range(len(t or "") - k + 1)).items()]
        assert sorted(map(tuple, S.kmer_counts(df, k).collect())) == sorted(want)
