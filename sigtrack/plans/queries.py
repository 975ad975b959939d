"""One query for each operator, over the tables given, beside its SQL.

Floating results are rounded alike on both sides, as sums differ in their last digits by order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..functions import statistics as stat
from ..operators import calls, correlation, demux, kmer, perbase, planning, profile, qc, reactivity, reads, running, sweep, windows
from ..storage import stored
from .views import Tables, with_views

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_views(views, sql)
        return f

    return register


def r6(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


#: Quantiles of values with few decimals fall on the middle between two at six digits; not so at nine.
_Q = "round(q[1], 9) AS q25, round(q[2], 9) AS q75, round(q[3], 9) AS q025, round(q[4], 9) AS q975"


def _stats(t: Tables, value: str = "e", **more) -> DataFrame:
    return perbase.position_stats(t.obs(), value, **more)


def _react(t: Tables) -> DataFrame:
    # both sides, the chromosomes that they share and all that follows read the statistics, not the observations
    s = stored(_stats(t).select("sample", "chrom", "pos", "strand", "cov", "mean"))
    return stored(reactivity.reactivity(s.where("sample = 'treatment'"), s.where("sample = 'control'"), "mean", min_cov=2))


def _significant(t: Tables) -> DataFrame:
    track = _react(t)
    return reactivity.significant(track, reactivity.null_thresholds(track))


@query("agg01_perbase_error", "stats", f"SELECT sample, chrom, pos, strand, cov, round(mean, 9) AS error, {_Q} FROM stats")
def _(t):
    return r6(_stats(t, name="error"), "error", *perbase.QUANTILES, digits=9)


@query("agg02_perbase_signal", "obs", f"""SELECT sample, chrom, pos, strand, cov, round(mean_deviation, 9) AS mean_deviation, {_Q}, round(mean_sq, 5) AS mean_sq FROM (
  SELECT sample, chrom, pos, strand, count(level) AS cov, avg(level) AS mean_deviation, quantile_cont(level, [0.25, 0.75, 0.025, 0.975]) AS q, avg(level * level) AS mean_sq FROM obs GROUP BY ALL)""")
def _(t):
    return r6(_stats(t, "level", name="mean_deviation", mean_square=True), "mean_deviation", *perbase.QUANTILES, digits=9).withColumn("mean_sq", F.round("mean_sq", 5))


@query("agg03_grouped_quantiles", "obs", "SELECT chrom, sample, round(quantile_cont(level, 0.1), 6) AS q10, round(quantile_cont(level, 0.9), 6) AS q90 FROM obs GROUP BY ALL")
def _(t):
    return r6(running.group_quantiles(t.obs(), ["chrom", "sample"], "level", {"q10": 0.1, "q90": 0.9}), "q10", "q90")


@query("agg04_grouped_median", "obs", "SELECT chrom, strand, round(median(level), 6) AS median_level FROM obs GROUP BY ALL")
def _(t):
    return r6(running.group_quantiles(t.obs(), ["chrom", "strand"], "level", {"median_level": 0.5}), "median_level")


@query("flt06_min_coverage", "stats", "SELECT sample, chrom, pos, strand, cov, round(mean, 6) AS error FROM stats WHERE cov >= 3")
def _(t):
    return r6(_stats(t, name="error", min_cov=3), "error").select("sample", "chrom", "pos", "strand", "cov", "error")


@query("flt09_missing_values", "obs", "SELECT sample, chrom, count(v) AS n_valid, count(*) - count(v) AS n_missing FROM (SELECT *, nullif(value, 0.05) AS v FROM obs) GROUP BY ALL")
def _(t):
    return perbase.missing_values(t.obs().withColumn("v", F.expr("nullif(value, 0.05D)")), "v", ["sample", "chrom"])


@query("flt12_value_column", "stats", "SELECT sample, chrom, pos, strand, cov, round(q[2], 6) AS value FROM stats")
def _(t):
    return r6(perbase.value_column(_stats(t), "q75"), "value")


@query("j10_reference_base", "stats", """AND nts AS (SELECT p_partkey + 1 AS pos, upper(substr(p_name, 1, 1)) AS b FROM part)
SELECT sample, chrom, stats.pos, strand, cov, CASE WHEN b IN ('A', 'C', 'G', 'T', 'N') THEN b ELSE 'N' END AS nt FROM stats LEFT JOIN nts ON nts.pos = stats.pos AND chrom <> 'chr_R'""")
def _(t):
    names = t.table("part").select((F.col("p_partkey") + 1).alias("pos"), F.substring("p_name", 1, 1).alias("nt"))
    bases = names.withColumn("chrom", F.explode(F.array(F.lit("chr_A"), F.lit("chr_N"))))
    return perbase.with_reference_base(_stats(t), bases).select("sample", "chrom", "pos", "strand", "cov", "nt")


@query("j01_reactivity", "react", "SELECT chrom, pos, strand, cov_t, cov_c, status, round(CASE status WHEN 'treatment' THEN 999999 WHEN 'control' THEN -999999 ELSE reactivity END, 6) AS reactivity FROM react")
def _(t):
    return r6(reactivity.with_sentinels(_react(t)).select("chrom", "pos", "strand", "cov_t", "cov_c", "status", "reactivity"), "reactivity")


@query("flt05_sentinel_removal", "react", "SELECT chrom, pos, strand, round(reactivity, 6) AS reactivity FROM react WHERE status = 'both'")
def _(t):
    return r6(reactivity.scored(reactivity.with_sentinels(_react(t))).select("chrom", "pos", "strand", "reactivity"), "reactivity")


@query("flt07_status_counts", "react", """SELECT chrom, strand, count(*) FILTER (status = 'both') AS n_both, count(*) FILTER (status = 'treatment') AS n_treatment, count(*) FILTER (status = 'control') AS n_control FROM react GROUP BY ALL""")
def _(t):
    return reactivity.status_counts(_react(t), ["chrom", "strand"])


@query("flt14_bedgraph", "react", 'SELECT chrom, strand, pos - 1 AS start, pos AS "end", round(reactivity, 6) AS value FROM react WHERE status = \'both\'')
def _(t):
    return r6(reactivity.bedgraph(reactivity.scored(_react(t))), "value")


@query("flt16_empty_side", "stats", """AND t AS (SELECT * FROM stats WHERE sample = 'treatment' AND chrom <> 'chr_N'), c AS (SELECT * FROM stats WHERE sample = 'control' AND NOT (chrom = 'chr_A' AND strand = 'rev'))
SELECT chrom, pos, strand, t.cov AS cov_t, c.cov AS cov_c FROM t FULL JOIN c USING (chrom, pos, strand)
WHERE (chrom, strand) IN (SELECT (chrom, strand) FROM t) AND (chrom, strand) IN (SELECT (chrom, strand) FROM c) AND (t.cov IS NULL OR c.cov IS NULL OR (t.cov >= 2 AND c.cov >= 2))""")
def _(t):
    s = _stats(t)
    track = reactivity.reactivity(s.where("sample = 'treatment' and chrom <> 'chr_N'"), s.where("sample = 'control' and not (chrom = 'chr_A' and strand = 'rev')"), "mean", min_cov=2)
    return track.select("chrom", "pos", "strand", "cov_t", "cov_c")


@query("agg18_null_thresholds", "thr", "SELECT chrom, strand, round(q[1], 6) AS p05, round(q[2], 6) AS p01, round(q[3], 6) AS p001, round(q[4], 6) AS p0001 FROM thr")
def _(t):
    return r6(reactivity.null_thresholds(_react(t)), *reactivity.LEVELS)


@query("flt08_significant", "sig", "SELECT chrom, pos, strand, round(reactivity, 6) AS reactivity FROM sig")
def _(t):
    return r6(_significant(t).select("chrom", "pos", "strand", "reactivity"), "reactivity")


_SPINE = """AND spine AS (SELECT chrom, strand, s AS start, least(s + 100, size) AS "end" FROM genome, (SELECT unnest(generate_series(0, (SELECT max(size) FROM genome), 100)) AS s), (SELECT DISTINCT chrom AS c2, strand FROM {src}) u WHERE s < size AND u.c2 = chrom)"""


@query("agg10_window_density", "sig genome", _SPINE.format(src="sig") + """,
w AS (SELECT chrom, strand, ((pos - 1) // 100) * 100 AS start, count(*) AS n, sum(reactivity) AS s FROM sig GROUP BY ALL)
SELECT chrom, strand, start, "end", coalesce(n, 0) AS count, round(coalesce(s, 0), 6) AS sum FROM spine LEFT JOIN w USING (chrom, strand, start)""")
def _(t):
    return r6(windows.density(stored(_significant(t)), stored(t.genome()), 100), "sum")


@query("agg11_window_mean", "react genome", _SPINE.format(src="react WHERE status = 'both'") + """,
w AS (SELECT chrom, strand, ((pos - 1) // 100) * 100 AS start, count(*) AS n, avg(reactivity) AS m FROM react WHERE status = 'both' GROUP BY ALL)
SELECT chrom, strand, start, "end", round(coalesce(m, 0), 6) AS mean, coalesce(n, 0) AS n FROM spine LEFT JOIN w USING (chrom, strand, start)""")
def _(t):
    return r6(windows.window_mean(reactivity.scored(_react(t)), t.genome(), 100), "mean")


@query("win12_window_grid", "genome", """SELECT chrom, s AS start, least(s + 64, size) AS "end" FROM genome, (SELECT unnest(generate_series(0, (SELECT max(size) FROM genome), 64)) AS s) WHERE s < size""")
def _(t):
    return windows.spine(t.genome(), 64)


@query("win08_gap_fill", "stats genome", """AND u AS (SELECT DISTINCT sample, chrom, strand FROM stats),
e AS (SELECT u.*, p AS pos FROM genome JOIN u USING (chrom), (SELECT unnest(generate_series(1, (SELECT max(size) FROM genome))) AS p) WHERE p <= size)
SELECT e.sample, e.chrom, e.strand, e.pos, cov FROM e LEFT JOIN stats USING (sample, chrom, strand, pos)""")
def _(t):
    track = stored(_stats(t).select("sample", "chrom", "strand", "pos", "cov"))
    return windows.gap_filled(track, t.genome(), ["sample", "strand"], 256)


@query("flt15_chrom_universe", "genome sig", "SELECT chrom, size FROM genome WHERE chrom IN (SELECT chrom FROM sig)")
def _(t):
    return windows.restricted(t.genome(), _significant(t)).select("chrom", "size")


@query("srt02_genome_order", "react genome", """SELECT chrom, strand, count(*) AS n, rank FROM react JOIN genome USING (chrom) GROUP BY ALL""")
def _(t):
    n = _react(t).groupBy("chrom", "strand").agg(F.count(F.lit(1)).alias("n"))
    return windows.genome_order(n, t.genome().withColumn("rank_", F.col("rank")), "strand").join(t.genome().select("chrom", "rank"), "chrom")


@query("srt01_sorted_track", "sig", "SELECT chrom, pos, strand, row_number() OVER (PARTITION BY strand, chrom ORDER BY pos) AS place FROM sig")
def _(t):
    return running.places(_significant(t).select("chrom", "pos", "strand"), ["strand", "chrom"], ["pos"], width=256)


@query("agg05_kmer_model", "model", "SELECT kmer, n, n_outlier, round(mean, 6) AS mean, round(sd, 6) AS sd, round(median, 6) AS median, round(mad, 6) AS mad FROM model")
def _(t):
    return r6(kmer.kmer_model(t.kmer_obs().where("sample = 'control'"), mad=1.5), "mean", "sd", "median", "mad")


@query("set03_pooled_model", "kmer_obs", """AND med AS (SELECT kmer, median(level) AS median, count(*) AS n_all FROM kmer_obs GROUP BY kmer),
dev AS (SELECT kmer, level, median, n_all, abs(level - median) AS d FROM kmer_obs JOIN med USING (kmer)),
mads AS (SELECT kmer, median(d) AS mad FROM dev GROUP BY kmer)
SELECT kmer, count(*) AS n, any_value(n_all) - count(*) AS n_outlier, round(avg(level), 6) AS mean, round(stddev_samp(level), 6) AS sd, round(any_value(median), 6) AS median, round(any_value(mad), 6) AS mad
FROM dev JOIN mads USING (kmer) WHERE d <= 1.5 * mad GROUP BY kmer""")
def _(t):
    rows = t.kmer_obs()
    samples = [rows.where(F.col("sample") == s) for s in ("treatment", "control")]
    return r6(kmer.pooled_model(samples, mad=1.5), "mean", "sd", "median", "mad")


_ORDER = ["read_id", "line", "pos", "supp"]


def _sampled(t: Tables) -> DataFrame:
    order = [kmer.priority(1, *_ORDER), *map(F.col, _ORDER)]
    return kmer.bounded_sample(t.kmer_obs(), "kmer", 500, order)


@query("agg06_bounded_sample", "kmer_obs", """SELECT kmer, count(*) AS n, round(avg(level), 6) AS mean_level FROM (
  SELECT kmer, level, row_number() OVER (PARTITION BY kmer ORDER BY md5('1|' || read_id || '|' || line || '|' || pos || '|' || supp), read_id, line, pos, supp) AS rn FROM kmer_obs) WHERE rn <= 500 GROUP BY kmer""")
def _(t):
    return r6(_sampled(t).groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), F.avg("level").alias("mean_level")), "mean_level")


def _model(t: Tables) -> DataFrame:
    """A row per k-mer, stored: all who read it would fit it anew."""
    return stored(kmer.kmer_model(t.kmer_obs().where("sample = 'control'"), mad=1.5))


def _scored(t: Tables) -> DataFrame:
    return kmer.scored(t.kmer_obs(), _model(t))


@query("j06_kmer_lookup", "scored", "SELECT sample, chrom, pos, strand, read_id, line, supp, kmer, round(z, 5) AS z FROM scored")
def _(t):
    return r6(_scored(t).select("sample", "chrom", "pos", "strand", "read_id", "line", "supp", "kmer", "z"), "z", digits=5)


@query("j07_model_coverage", "kmer_obs", """AND m AS (SELECT kmer, count(*) AS n FROM kmer_obs WHERE sample = 'control' AND kmer < 'Brand#2' GROUP BY kmer)
SELECT count(*) AS n_obs, count(n) AS n_known, count(*) FILTER (n >= 600) AS n_scorable FROM kmer_obs LEFT JOIN m USING (kmer)""")
def _(t):
    m = t.kmer_obs().where("sample = 'control' and kmer < 'Brand#2'").groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))
    return kmer.model_coverage(t.kmer_obs(), m, 600)


@query("flt11_scorable_kmers", "model", "SELECT kmer, round(median, 6) AS centre, round(1.4826 * mad, 6) AS spread FROM model WHERE n >= 30 AND mad > 0")
def _(t):
    return r6(kmer.centre_and_spread(_model(t), "mad"), "centre", "spread")


def _called(t: Tables) -> DataFrame:
    return _scored(t).withColumn("called", calls.called(F.abs("z"), F.lit(stat.z_threshold(0.2))))


@query("agg07_call_totals", "scored", f"""SELECT sample, chrom, pos, strand, count(*) AS cov, count(*) FILTER (abs(z) > {stat.z_threshold(0.2)!r}) AS n_mod, round(avg(z), 5) AS mean_z, round(avg(abs(z)), 5) AS mean_absz,
  round(count(*) FILTER (abs(z) > {stat.z_threshold(0.2)!r}) / count(*), 6) AS frac FROM scored GROUP BY ALL""")
def _(t):
    return r6(r6(calls.call_totals(_called(t)), "mean_z", "mean_absz", digits=5), "frac")


@query("j02_mod_reactivity", "scored", f"""AND f AS (SELECT sample, chrom, pos, strand, count(*) AS cov, count(*) FILTER (abs(z) > {stat.z_threshold(0.2)!r}) / count(*) AS frac FROM scored GROUP BY ALL HAVING count(*) >= 3)
SELECT chrom, pos, strand, t.cov AS cov_t, round(t.frac, 6) AS frac_t, c.cov AS cov_c, round(c.frac, 6) AS frac_c, round(t.frac - c.frac, 6) AS reactivity
FROM (SELECT * FROM f WHERE sample = 'treatment') t JOIN (SELECT * FROM f WHERE sample = 'control') c USING (chrom, pos, strand)""")
def _(t):
    totals = stored(calls.call_totals(_called(t)))
    return r6(reactivity.mod_reactivity(totals.where("sample = 'treatment'"), totals.where("sample = 'control'"), 3), "frac_t", "frac_c", "reactivity")


@query("win11_unique_positions", "obs", "SELECT chrom, pos, strand, count(*) AS n FROM obs GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return reactivity.repeated_positions(t.obs())


@query("agg08_null_histogram", "scored", "SELECT sample, least(floor(abs(z) / 0.01), 10000)::BIGINT AS bin, count(*) AS count FROM scored GROUP BY ALL")
def _(t):
    return calls.null_histogram(_scored(t).withColumn("stat", F.abs("z")), "stat", ["sample"])


@query("src15_pooled_histogram", "scored", "SELECT least(floor(abs(z) / 0.01), 10000)::BIGINT AS bin, count(*) AS count FROM scored GROUP BY ALL")
def _(t):
    rows = _scored(t).withColumn("stat", F.abs("z"))
    parts = [calls.null_histogram(rows.where(F.col("sample") == s), "stat") for s in ("treatment", "control")]
    return calls.pooled(*parts)


@query("agg09_fpr_cutoff", "scored", """AND h AS (SELECT least(floor(abs(z) / 0.01), 10000)::BIGINT AS bin, count(*) AS n FROM scored WHERE sample = 'control' GROUP BY ALL),
c AS (SELECT bin, sum(n) OVER (ORDER BY bin DESC) AS tail, sum(n) OVER () AS total FROM h)
SELECT round((coalesce(max(bin) FILTER (tail > 0.02 * total), -1) + 1) * 0.01::DOUBLE, 6) AS cutoff FROM c""")
def _(t):
    h = calls.null_histogram(_scored(t).where("sample = 'control'").withColumn("stat", F.abs("z")), "stat")
    return r6(calls.cutoff(h, 0.02), "cutoff")


@query("win05_reverse_running_sum", "obs", "AND h AS (SELECT chrom, phred, count(*) AS n FROM obs GROUP BY ALL) SELECT chrom, phred, n, (sum(n) OVER (PARTITION BY chrom ORDER BY phred DESC))::BIGINT AS tail FROM h")
def _(t):
    h = t.obs().groupBy("chrom", "phred").agg(F.count(F.lit(1)).alias("n"))
    return h.withColumn("tail", F.sum("n").over(Window.partitionBy("chrom").orderBy(F.desc("phred"))))


def _read_p(t: Tables) -> DataFrame:
    return t.obs().groupBy("read_id", "chrom", "pos").agg(F.min(F.col("phred") / 51).alias("p"))


@query("win01_fisher_window", "obs", """AND r AS (SELECT read_id, chrom, pos, min(phred / 51) AS p FROM obs GROUP BY ALL),
w AS (SELECT *, -sum(ln(greatest(p, 1e-300))) OVER n AS s, count(*) OVER n AS m FROM r WINDOW n AS (PARTITION BY read_id, chrom ORDER BY pos RANGE BETWEEN 200 PRECEDING AND 200 FOLLOWING))
SELECT read_id, chrom, pos, round(CASE WHEN s > 0 THEN least(1.0, list_sum(list_transform(range(m), lambda i: exp(i * ln(s) - s - lgamma(i + 1))))) ELSE 1 END, 6) AS combined FROM w""")
def _(t):
    # positions are far apart in a read of this table, so the window is wide
    return r6(calls.fisher_combined(_read_p(t), 200).select("read_id", "chrom", "pos", "combined"), "combined")


@query("win02_clean_context", "obs", """AND r AS (SELECT sample || strand || supp AS read_id, chrom, pos, max((phred < 4)::INT) AS err FROM obs GROUP BY ALL),
w AS (SELECT *, max(err) OVER (PARTITION BY read_id, chrom ORDER BY pos RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near, min(pos) OVER (PARTITION BY read_id, chrom) AS lo, max(pos) OVER (PARTITION BY read_id, chrom) AS hi FROM r)
SELECT read_id, chrom, pos, near = 0 AND pos - 2 >= lo AND pos + 2 <= hi AS clean FROM w""")
def _(t):
    # a read of this table is a sample, strand and supplier: an order's few positions are too far apart
    rows = t.obs().groupBy(F.concat("sample", "strand", "supp").alias("read_id"), "chrom", "pos").agg(F.max((F.col("phred") < 4).cast("int")).alias("is_error"))
    return calls.clean_context(rows, 2).select("read_id", "chrom", "pos", "clean")


@query("win03_sliding_kmers", "sequences", """AND k AS (SELECT doc_id, unnest(list_transform(generate_series(1, length(seq) - 3), lambda i: substr(seq, i, 4))) AS kmer FROM sequences WHERE length(seq) >= 4)
SELECT kmer, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM k GROUP BY kmer""")
def _(t):
    by_doc = S.kmer_counts(t.sequences(), 4).groupBy("doc_id", "kmer").agg(F.sum("n").alias("n"))
    return by_doc.groupBy("kmer").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"))


_CODE = "CASE WHEN regexp_full_match({0}, '[ACGT]+') THEN list_reduce(list_transform(string_split({0}, ''), lambda b: (instr('ACGT', b) - 1)::BIGINT), lambda a, b: a * 4 + b) ELSE -1 END"


@query("sc05_kmer_codes", "sequences", f"""AND k AS (SELECT DISTINCT unnest(list_transform(generate_series(1, length(seq) - 5), lambda i: substr(seq, i, 6))) AS kmer FROM sequences WHERE length(seq) >= 6)
SELECT kmer, ({_CODE.format("kmer")})::BIGINT AS code, CASE WHEN regexp_full_match(kmer, '[ACGT]+') THEN kmer END AS decoded FROM k""")
def _(t):
    rows = S.kmer_counts(t.sequences(), 6).select("kmer").distinct()
    out = rows.withColumn("code", S.kmer_code(F.col("kmer")))
    return out.withColumn("decoded", S.kmer_text(F.col("code"), 6))


@query("sc04_reverse_complement", "sequences", "SELECT doc_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS digest, length(seq) AS n FROM sequences")
def _(t):
    return t.sequences().select("doc_id", F.md5(S.reverse_complement(F.col("seq")).cast("binary")).alias("digest"), F.length("seq").cast("long").alias("n"))


@query("sc03_base_codes", "sequences", """AND b AS (SELECT unnest(string_split(seq, '')) AS base FROM sequences) SELECT base, CASE WHEN base = '' THEN 4 WHEN instr('ACGT', base) > 0 THEN instr('ACGT', base) - 1 ELSE 4 END::INT AS code, count(*) AS n FROM b WHERE base <> '' GROUP BY ALL""")
def _(t):
    rows = t.sequences().select(F.explode(F.split("seq", "")).alias("base")).where("base <> ''")
    return rows.groupBy("base", S.base_code(F.col("base")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("sc02_mean_phred", "reads", "SELECT sample, read_id, round(-10 * log10(error), 6) AS phred FROM reads")
def _(t):
    return r6(t.reads().select("sample", "read_id", S.error_phred(F.col("error")).alias("phred")), "phred")


def _crc_entry(n: int) -> int:
    """An entry of the table of CRC-32: eight steps of division by its polynomial."""
    for _ in range(8):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


@query("flt04_read_half", "obs", f"""AND r AS (SELECT DISTINCT read_id FROM obs),
c AS (SELECT read_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(read_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: xor(c >> 8, ({[_crc_entry(n) for n in range(256)]}::BIGINT[])[(xor(c, b) & 255) + 1])) AS c FROM r)
SELECT sample, CASE WHEN xor(c, 4294967295::BIGINT) % 2 = 0 THEN 'A' ELSE 'B' END AS half, count(*) AS n, count(DISTINCT read_id) AS n_reads FROM obs JOIN c USING (read_id) GROUP BY ALL""")
def _(t):
    return t.obs().groupBy("sample", S.read_half(F.col("read_id")).alias("half")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("read_id").alias("n_reads"))


@query("sc08_two_sided_p", "scored", """AND x AS (SELECT sample, chrom, abs(z) / sqrt(2) AS x FROM scored),
p AS (SELECT *, CASE WHEN x > 0 THEN 1 - exp(-x * x) * list_sum(list_transform(range(90), lambda n: exp((2 * n + 1) * ln(x) - lgamma(n + 1.5)))) ELSE 1 END AS p FROM x)
SELECT sample, chrom, round(avg(p), 6) AS mean_p, round(avg(-log10(greatest(p, 1e-300))), 6) AS mean_stat FROM p GROUP BY ALL""")
def _(t):
    rows = _scored(t).withColumn("p", stat.two_sided_p(F.col("z")))
    return r6(rows.groupBy("sample", "chrom").agg(F.avg("p").alias("mean_p"), F.avg(stat.minus_log_p(F.col("p"))).alias("mean_stat")), "mean_p", "mean_stat")


@query("win13_feature_windows", "features", """SELECT fid, chrom, (i * 10 * CASE WHEN strand = '-' THEN -1 ELSE 1 END)::INT AS distance, ref + i * 10 - 5 AS low, ref + i * 10 + 5 AS high
FROM (SELECT *, CASE WHEN strand = '-' THEN "end" ELSE start END AS ref FROM features), (SELECT unnest(generate_series(-3, 3)) AS i)""")
def _(t):
    return profile.feature_windows(t.features(), 3, 10).withColumn("distance", F.col("distance").cast("int"))


def _profile(t: Tables) -> DataFrame:
    # the tracks' names, their rows and their bins' sums all read the statistics
    track = stored(_stats(t, name="error").select(*perbase.POSITION, F.col("cov").cast("double").alias("cov"), "error"))
    return profile.feature_profile(t.features(), track, ["cov", "error"], 3, 10)


_PROFILE = """AND w AS (SELECT fid, chrom, (i * 10 * CASE WHEN strand = '-' THEN -1 ELSE 1 END)::INT AS distance, ref + i * 10 - 5 AS low, ref + i * 10 + 5 AS high
  FROM (SELECT *, CASE WHEN strand = '-' THEN "end" ELSE start END AS ref FROM features), (SELECT unnest(generate_series(-3, 3)) AS i)),
prof AS (SELECT fid, distance, sample, s.strand, avg(cov) AS cov, avg(mean) AS error FROM w JOIN stats s ON s.chrom = w.chrom AND s.pos BETWEEN low AND high GROUP BY ALL)
"""


@query("agg12_feature_profile", "features stats", _PROFILE + "SELECT fid, distance, sample, strand, round(cov, 6) AS cov, round(error, 6) AS error FROM prof")
def _(t):
    return r6(_profile(t), "cov", "error")


@query("agg13_average_profile", "features stats", _PROFILE + "SELECT distance, sample, strand, round(avg(cov), 5) AS cov, round(avg(error), 6) AS error, count(*) AS n FROM prof GROUP BY ALL")
def _(t):
    return r6(r6(profile.average_profile(_profile(t), ["cov", "error"]), "cov", digits=5), "error")


@query("srt05_profile_order", "features stats", _PROFILE + "SELECT row_number() OVER (ORDER BY distance, sample, strand) AS place, distance, sample, strand, n FROM (SELECT distance, sample, strand, count(*) AS n FROM prof GROUP BY ALL)")
def _(t):
    rows = profile.in_output_order(profile.average_profile(_profile(t), ["cov", "error"])).select("distance", "sample", "strand", "n")
    # as few rows as a profile has distances
    return rows.withColumn("place", F.row_number().over(Window.orderBy("distance", "sample", "strand")).cast("long"))


@query("agg22_coverage_runs", "intervals", """AND e AS (SELECT chrom, start AS p, 1 AS step FROM intervals UNION ALL SELECT chrom, "end", -1 FROM intervals),
s AS (SELECT chrom, p, sum(step) AS step FROM e GROUP BY ALL HAVING sum(step) <> 0),
d AS (SELECT chrom, p, sum(step) OVER (PARTITION BY chrom ORDER BY p) AS depth, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS nxt FROM s)
SELECT chrom, p AS start, nxt AS "end", depth::BIGINT AS depth FROM d WHERE depth > 0""")
def _(t):
    return running.coverage_runs(t.intervals(), width=256)


@query("agg14_n50", "reads", """AND c AS (SELECT sample, length, sum(length) OVER (PARTITION BY sample ORDER BY length DESC) AS cum, sum(length) OVER (PARTITION BY sample) AS total FROM reads)
SELECT sample, max(length) AS n50 FROM c WHERE cum >= total / 2 GROUP BY sample""")
def _(t):
    return qc.n50(t.reads(), ["sample"])


@query("agg15_q50", "reads", """AND b AS (SELECT sample, floor(10 * (-10 * log10(error)) + 0.5)::BIGINT AS bin, sum(length) AS w FROM reads GROUP BY ALL),
c AS (SELECT *, sum(w) OVER (PARTITION BY sample ORDER BY bin DESC) AS cum, sum(w) OVER (PARTITION BY sample) AS total FROM b)
SELECT sample, max(bin) / 10 AS q50 FROM c WHERE cum >= total / 2 GROUP BY sample""")
def _(t):
    return qc.q50(t.reads(), ["sample"])


@query("agg16_read_totals", "reads", "SELECT sample, floor(sum(length) / 1e9 * 1e4) / 1e4 AS giga_bp, floor(count(*) / 1e6 * 1e4) / 1e4 AS reads_million FROM reads GROUP BY sample")
def _(t):
    return qc.read_totals(t.reads(), ["sample"])


@query("agg17_demux_counts", "barcoded", r"""AND sheet AS (SELECT 'barcode' || lpad(i::VARCHAR, 2, '0') AS barcode, 'sample_' || (i % 5) AS sample FROM (SELECT unnest(generate_series(0, 19)) AS i)),
b AS (SELECT regexp_extract(read_group, '(barcode[0-9]+)$', 1) AS barcode, split_part(read_group, '_', 1) AS run_id, bases FROM barcoded)
SELECT coalesce(sample, 'unclassified') AS sample, b.barcode, run_id, count(*) AS reads, sum(bases)::BIGINT AS bases FROM b LEFT JOIN sheet USING (barcode) GROUP BY ALL""")
def _(t):
    return demux.demux_counts(demux.assigned(t.barcoded(), _sheet(t)))


def _sheet(t: Tables) -> DataFrame:
    code = F.lpad(F.col("id").cast("string"), 2, "0")
    raw = t.spark.range(20).select(F.concat(F.lit("kit_barcode"), code).alias("barcode"), F.concat(F.lit("sample_"), F.col("id") % 5).alias("sample"))
    return demux.sample_sheet(raw)


@query("agg27_conservation", "barcoded", r"""AND sheet AS (SELECT 'barcode' || lpad(i::VARCHAR, 2, '0') AS barcode, 'sample_' || (i % 5) AS sample FROM (SELECT unnest(generate_series(0, 19)) AS i)),
b AS (SELECT regexp_extract(read_group, '(barcode[0-9]+)$', 1) AS barcode FROM barcoded),
o AS (SELECT coalesce(sample, 'unclassified') AS sample, count(*) AS reads FROM b LEFT JOIN sheet USING (barcode) GROUP BY ALL)
SELECT n_in, n_out, n_in = n_out AS conserved FROM (SELECT (SELECT count(*) FROM barcoded) AS n_in, (SELECT sum(reads)::BIGINT FROM o) AS n_out)""")
def _(t):
    rows = t.barcoded()
    return demux.conservation(rows, demux.demux_counts(demux.assigned(rows, _sheet(t))))


@query("src17_sheet_faults", "", """WITH s AS (SELECT 'barcode' || lpad((user_id % 30)::VARCHAR, 2, '0') AS barcode, CASE WHEN user_id % 30 = 7 THEN 'unclassified' WHEN user_id % 30 = 9 THEN 'a b' ELSE event_type END AS sample FROM events),
d AS (SELECT DISTINCT * FROM s)
SELECT barcode, CASE WHEN sample = 'unclassified' THEN 'reserved name' ELSE 'bad name' END AS fault FROM d WHERE sample IN ('unclassified', 'a b')
UNION ALL SELECT barcode, 'two samples' FROM d GROUP BY barcode HAVING count(*) > 1""")
def _(t):
    code = F.concat(F.lit("barcode"), F.lpad((F.col("user_id") % 30).cast("string"), 2, "0"))
    name = F.when(F.col("user_id") % 30 == 7, "unclassified").when(F.col("user_id") % 30 == 9, "a b").otherwise(F.col("event_type"))
    return demux.sheet_faults(demux.sample_sheet(t.table("events").select(code.alias("barcode"), name.alias("sample"))))


@query("flt01_strand_filter", "alignments", "SELECT sample, count(*) AS n, sum(length)::BIGINT AS bases FROM alignments WHERE flag & 16 <> 0 GROUP BY sample")
def _(t):
    return qc.by_strand(t.alignments(), "rev").groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bases"))


@query("flt02_alignment_filter", "alignments", "SELECT read_id, flag, mapq, sample, length, mismatches FROM alignments WHERE flag & 2308 = 0 AND mapq >= 20")
def _(t):
    return qc.filtered(t.alignments(), 20)


_FLAGS = """count(*) AS total, count(*) FILTER (m) AS "primary", count(*) FILTER (flag & 256 <> 0) AS secondary, count(*) FILTER (flag & 2048 <> 0 AND flag & 256 = 0) AS supplementary, count(*) FILTER (flag & 1024 <> 0) AS duplicates,
count(*) FILTER (flag & 1024 <> 0 AND m) AS primary_duplicates, count(*) FILTER (u = 0) AS mapped, count(*) FILTER (u = 0 AND m) AS primary_mapped, count(*) FILTER (p) AS paired, count(*) FILTER (p AND flag & 64 <> 0) AS read1,
count(*) FILTER (p AND flag & 128 <> 0) AS read2, count(*) FILTER (p AND flag & 2 <> 0 AND u = 0) AS properly_paired, count(*) FILTER (p AND u = 0 AND flag & 8 = 0) AS both_mapped, count(*) FILTER (p AND u = 0 AND flag & 8 <> 0) AS singletons,
count(*) FILTER (flag & 512 <> 0) AS qc_fail, count(*) FILTER (u = 0 AND flag & 16 <> 0) AS reverse"""


@query("agg21_flag_counts", "alignments", f"SELECT sample, {_FLAGS} FROM (SELECT *, flag & 2304 = 0 AS m, flag & 4 AS u, flag & 1 <> 0 AND flag & 2304 = 0 AS p FROM alignments) GROUP BY sample")
def _(t):
    return qc.flag_counts(t.alignments(), ["sample"])


_SUMMARY = """SELECT sample, count(*) AS sequences, sum(length)::BIGINT AS bases, count(*) FILTER (flag & 4 = 0) AS reads_mapped, coalesce(sum(length) FILTER (flag & 4 = 0), 0)::BIGINT AS bases_mapped,
coalesce(sum(mismatches) FILTER (flag & 4 = 0), 0)::BIGINT AS mismatches, avg(length) AS mean_length, avg(mapq) FILTER (flag & 4 = 0) AS mean_mapq FROM {src} WHERE flag & 2304 = 0 GROUP BY sample"""


@query("agg20_alignment_summary", "alignments", f"SELECT * EXCLUDE (mean_length, mean_mapq), round(mean_length, 6) AS mean_length, round(mean_mapq, 6) AS mean_mapq, round(mismatches / bases_mapped, 6) AS error_rate FROM ({_SUMMARY.format(src='alignments')})")
def _(t):
    return r6(qc.alignment_summary(t.alignments(), ["sample"]), "mean_length", "mean_mapq", "error_rate")


_METRICS = ["sequences", "bases", "reads_mapped", "bases_mapped", "mismatches", "mean_length", "mean_mapq", "error_rate"]


@query("piv01_alignment_table", "alignments", "\nUNION ALL\n".join(
    f"SELECT sample, '{name}' AS status, {', '.join(f'round({m}, 6)::DOUBLE AS {m}' for m in _METRICS[:-1])}, round(mismatches / bases_mapped, 6) AS error_rate FROM ({_SUMMARY.format(src=src)})"
    for name, src in (("Not_filtered", "alignments"), ("Filtered", "(SELECT * FROM alignments WHERE flag & 2308 = 0 AND mapq >= 20)"))))
def _(t):
    raw = t.alignments()
    long = qc.stats_table(qc.alignment_summary(raw, ["sample"]), qc.alignment_summary(qc.filtered(raw, 20), ["sample"]), _METRICS, ["sample"])
    return r6(qc.pivoted(long, _METRICS, ["sample"]), *_METRICS)


@query("agg23_histograms", "alignments", "SELECT 'RL' AS var, length::VARCHAR AS value, count(*) AS count FROM alignments GROUP BY ALL UNION ALL SELECT 'MAPQ', mapq::VARCHAR, count(*) FROM alignments GROUP BY ALL")
def _(t):
    return qc.histograms(t.alignments(), {"RL": "length", "MAPQ": "mapq"})


_CIGAR = "o_custkey % 50 + 1 || 'M' || (o_custkey % 5 + 1) || 'I' || (o_orderkey % 30 + 1) || 'M' || (o_orderkey % 4 + 1) || 'D9M'"


@query("agg23_indel_histograms", "", f"""WITH c AS (SELECT o_orderstatus AS sample, unnest(regexp_extract_all({_CIGAR}, '[0-9]+[ID]')) AS step FROM orders)
SELECT sample, CASE WHEN step LIKE '%I' THEN 'INS' ELSE 'DEL' END AS var, regexp_extract(step, '[0-9]+') AS value, count(*) AS count FROM c GROUP BY ALL""")
def _(t):
    return qc.indel_lengths(t.table("orders").select(F.col("o_orderstatus").alias("sample"), F.expr(_CIGAR).alias("cigar")), ["sample"])


_DEPTH = """AND e AS (SELECT chrom, start AS p, 1 AS step FROM intervals UNION ALL SELECT chrom, "end", -1 FROM intervals),
s AS (SELECT chrom, p, sum(step) AS step FROM e GROUP BY ALL HAVING sum(step) <> 0),
d AS (SELECT chrom, p, sum(step) OVER (PARTITION BY chrom ORDER BY p) AS depth, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS nxt FROM s)
"""


@query("agg23_coverage_histogram", "intervals", _DEPTH + """SELECT chrom, 'COV' AS var, CASE WHEN depth >= 40 THEN '[>=40]' ELSE '[' || depth::BIGINT || '-' || depth::BIGINT || ']' END AS value,
sum(nxt - p)::BIGINT AS count, least(depth, 40)::DOUBLE AS start FROM d WHERE depth > 0 GROUP BY ALL""")
def _(t):
    out = qc.coverage_histogram(running.coverage_runs(t.intervals(), width=256), ["chrom"], 40)
    return out.withColumn("start", qc.bracket_start(F.col("value")))


@query("agg24_winsorised_histogram", "alignments", """AND h AS (SELECT sample, length AS value, count(*) AS w FROM alignments GROUP BY ALL),
c AS (SELECT *, sum(w) OVER (PARTITION BY sample ORDER BY value) / sum(w) OVER (PARTITION BY sample) AS share FROM h),
e AS (SELECT *, min(CASE WHEN share >= 0.01 THEN value END) OVER (PARTITION BY sample) AS low, min(CASE WHEN share >= 0.99 THEN value END) OVER (PARTITION BY sample) AS high FROM c)
SELECT sample, CASE WHEN high > low THEN greatest(1, least(50, ceil((greatest(low, least(value, high)) - low) / ((high - low) / 50)))) ELSE 1 END::INT AS bin, low, high, sum(w)::BIGINT AS count FROM e GROUP BY ALL""")
def _(t):
    h = t.alignments().groupBy("sample", F.col("length").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return qc.winsorised(h, ["sample"])


def _pairs(t: Tables) -> DataFrame:
    s = _stats(t, name="error").where("cov >= 2")
    return s.where("sample = 'treatment'").select("chrom", "pos", "strand", F.round("error", 6).alias("x")).join(s.where("sample = 'control'").select("chrom", "pos", "strand", F.round("error", 6).alias("y")), ["chrom", "pos", "strand"])


@query("agg25_correlations", "stats", """AND p AS (SELECT chrom, round(t.mean, 6) AS x, round(c.mean, 6) AS y FROM stats t JOIN stats c USING (chrom, pos, strand) WHERE t.sample = 'treatment' AND c.sample = 'control' AND t.cov >= 2 AND c.cov >= 2),
r AS (SELECT *, rank() OVER (PARTITION BY chrom ORDER BY x) + (count(*) OVER (PARTITION BY chrom, x) - 1) / 2 AS rx, rank() OVER (PARTITION BY chrom ORDER BY y) + (count(*) OVER (PARTITION BY chrom, y) - 1) / 2 AS ry FROM p)
SELECT chrom, count(*) AS n_points, CASE WHEN count(*) >= 3 THEN round(corr(x, y), 6) END AS pearson, CASE WHEN count(*) >= 3 THEN round(corr(rx, ry), 6) END AS spearman FROM r GROUP BY chrom""")
def _(t):
    return r6(correlation.correlations(_pairs(t), "x", "y", ["chrom"]), "pearson", "spearman")


@query("win09_average_rank", "obs", "SELECT chrom, pos, n, rank() OVER (PARTITION BY chrom ORDER BY n) + (count(*) OVER (PARTITION BY chrom, n) - 1) / 2 AS rank FROM (SELECT chrom, pos, count(*) AS n FROM obs GROUP BY ALL)")
def _(t):
    rows = t.obs().groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"))
    return correlation.average_rank(rows, "n", ["chrom"], "rank")


@query("win07_genome_offsets", "genome", "SELECT chrom, size, coalesce(sum(size) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM genome")
def _(t):
    return correlation.genome_offsets(t.genome()).select("chrom", "size", "offset")


_POSITIONS = """AND g AS (SELECT *, coalesce(sum(size) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM genome),
d AS (SELECT id, ('0x' || substr(md5('1|' || id), 1, 12))::BIGINT % (SELECT sum(size)::BIGINT FROM genome) AS p FROM (SELECT unnest(generate_series(0, 9999)) AS id)),
s AS (SELECT id, chrom, p - off + 1 AS pos FROM d JOIN g ON p >= off AND p < off + size)
"""


@query("smp02_sampled_positions", "genome", _POSITIONS + "SELECT id, chrom, pos FROM s")
def _(t):
    return correlation.sampled_positions(t.genome(), 10_000)


def _looked_up(t: Tables) -> DataFrame:
    """Both samples' values on both strands at 10,000 drawn positions."""
    s = stored(_stats(t).select("sample", "chrom", "strand", "pos", "cov", "mean"))
    drawn = correlation.sampled_positions(stored(t.genome()), 10_000).withColumn("strand", F.explode(F.array(F.lit("for"), F.lit("rev"))))
    return correlation.at_positions(drawn, s.where("sample = 'treatment'"), s.where("sample = 'control'"), "mean", ["chrom", "strand", "pos"])


@query("j04_sampled_lookup", "genome stats", _POSITIONS + """SELECT id, s.chrom, s.pos, u.strand, a.cov AS cov_1, round(a.mean, 6) AS value_1, b.cov AS cov_2, round(b.mean, 6) AS value_2 FROM s, (VALUES ('for'), ('rev')) u(strand)
LEFT JOIN (SELECT * FROM stats WHERE sample = 'treatment') a ON a.chrom = s.chrom AND a.pos = s.pos AND a.strand = u.strand LEFT JOIN (SELECT * FROM stats WHERE sample = 'control') b ON b.chrom = s.chrom AND b.pos = s.pos AND b.strand = u.strand""")
def _(t):
    return r6(_looked_up(t), "value_1", "value_2")


@query("j15_sample_pairs", "alignments", "SELECT a.sample AS sample_1, b.sample AS sample_2 FROM (SELECT DISTINCT sample FROM alignments) a, (SELECT DISTINCT sample FROM alignments) b")
def _(t):
    return correlation.sample_pairs(t.alignments())


def _relationships(t: Tables) -> DataFrame:
    """Nations of a region stand as samples: the first of each region is the others' control."""
    nations = t.table("nation")
    control = nations.groupBy("n_regionkey").agg(F.min("n_name").alias("control"))
    return nations.join(control, "n_regionkey").where("n_name <> control").select(F.col("n_name").alias("relationship"), F.col("n_name").alias("treatment"), "control", "n_regionkey")


_REL = """AND rel AS (SELECT n_name AS relationship, n_name AS treatment, control, n_regionkey FROM nation JOIN (SELECT n_regionkey, min(n_name) AS control FROM nation GROUP BY ALL) USING (n_regionkey) WHERE n_name <> control),
pools AS (SELECT 'pool_' || (n_nationkey % 3) AS pool, n_name AS sample FROM nation),
avail AS (SELECT DISTINCT n_name AS sample FROM nation JOIN supplier ON s_nationkey = n_nationkey),
whole AS (SELECT pool FROM pools LEFT JOIN avail USING (sample) GROUP BY pool HAVING count(*) = count(avail.sample)),
sets AS (SELECT relationship, 'matched' AS model_set FROM rel WHERE control IN (SELECT sample FROM avail) UNION SELECT relationship, pool FROM rel JOIN pools ON pools.sample = control WHERE pool IN (SELECT pool FROM whole))
"""


def _sets(t: Tables) -> DataFrame:
    nations = t.table("nation")
    pools = nations.groupBy(F.concat(F.lit("pool_"), F.col("n_nationkey") % 3).alias("pool")).agg(F.collect_list("n_name").alias("members"))
    available = nations.join(t.table("supplier"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("sample"))
    return sweep.model_sets(_relationships(t), pools, available)


@query("j17_pool_membership", "", _REL.replace("AND rel", "WITH rel", 1) + "SELECT relationship, model_set FROM sets")
def _(t):
    return _sets(t)


@query("j14_relationships", "", _REL.replace("AND rel", "WITH rel", 1).split(",\npools")[0] + " SELECT relationship, treatment, control, n_regionkey FROM rel")
def _(t):
    return _relationships(t)


@query("j16_sweep_units", "", _REL.replace("AND rel", "WITH rel", 1) + """SELECT p."set", p.mad, r_name AS genome, relationship, treatment, control, n_regionkey, model_set, strand
FROM (SELECT DISTINCT 'set_' || (p_size % 4) AS "set", (p_size % 4 + 1) * 5.0::DOUBLE AS mad FROM part) p, region, rel JOIN sets USING (relationship), (SELECT unnest(['for', 'rev']) AS strand)""")
def _(t):
    parameters = t.table("part").select(F.concat(F.lit("set_"), F.col("p_size") % 4).alias("set"), ((F.col("p_size") % 4 + 1) * F.lit(5.0)).alias("mad")).distinct()
    return sweep.units(parameters, t.table("region").select(F.col("r_name").alias("genome")), _relationships(t), _sets(t))


def _unit_tracks(t: Tables) -> DataFrame:
    rows = t.obs().withColumn("unit", F.col("strand"))
    nt = F.substring(F.lit("ACGT"), (F.col("pos") % 4 + 1).cast("int"), F.lit(1))
    return rows.groupBy("unit", "sample", "chrom", "pos").agg(F.count(F.lit(1)).alias("cov"), F.avg((F.col("phred") > 25).cast("double")).alias("frac")).withColumn("nt", nt)


_UNITS = """AND u AS (SELECT strand AS unit, sample, chrom, pos, count(*) AS cov, avg((phred > 25)::INT::DOUBLE) AS frac, substr('ACGT', (pos % 4 + 1)::INT, 1) AS nt FROM obs GROUP BY ALL),
j AS (SELECT unit, chrom, pos, t.cov AS cov_t, t.frac AS frac_t, c.cov AS cov_c, c.frac AS frac_c, coalesce(t.nt, c.nt) AS nt, t.frac - c.frac AS reactivity
      FROM (SELECT * FROM u WHERE sample = 'treatment') t FULL JOIN (SELECT * FROM u WHERE sample = 'control') c USING (unit, chrom, pos))
"""


def _unit_join(t: Tables) -> DataFrame:
    rows = _unit_tracks(t)
    return sweep.unit_join(rows.where("sample = 'treatment'"), rows.where("sample = 'control'"), ["unit", "chrom", "pos"])


@query("j03_sweep_join", "obs", _UNITS + "SELECT unit, chrom, pos, cov_t, round(frac_t, 6) AS frac_t, cov_c, round(frac_c, 6) AS frac_c, nt, round(reactivity, 6) AS reactivity FROM j")
def _(t):
    return r6(_unit_join(t), "frac_t", "frac_c", "reactivity")


@query("agg19_sweep_summary", "obs", _UNITS + """, k AS (SELECT *, avg(frac_c) OVER (PARTITION BY unit, chrom) AS bg FROM j WHERE cov_t >= 2 AND cov_c >= 2)
SELECT unit, chrom, count(*) AS n, median(cov_t) AS median_cov_t, median(cov_c) AS median_cov_c, round(avg(frac_c), 6) AS background, round(avg(frac_t), 6) AS mean_frac_t, round(avg(reactivity), 6) AS mean_reactivity, round(max(reactivity), 6) AS max_reactivity,
  round(avg(reactivity) FILTER (nt = 'T'), 6) AS mean_t, round(avg(reactivity) FILTER (nt <> 'T'), 6) AS mean_not_t, round(stddev_samp(reactivity), 6) AS sd, first(pos ORDER BY reactivity DESC, pos) AS max_pos, first(nt ORDER BY reactivity DESC, pos) AS max_nt,
  count(*) FILTER (nt = 'T') AS n_t, count(*) FILTER (reactivity > 3 * bg) AS n_reactive FROM k GROUP BY ALL""")
def _(t):
    return r6(sweep.unit_summary(stored(_unit_join(t)), ["unit", "chrom"], 2), "background", "mean_frac_t", "mean_reactivity", "max_reactivity", "mean_t", "mean_not_t", "sd")


@query("agg29_run_estimate", "", """WITH h AS (SELECT p_type AS rule, avg(l_extendedprice) FILTER (l_linestatus = 'O') AS a, avg(l_extendedprice) FILTER (l_linestatus = 'F') AS b, max(l_quantity)::BIGINT + max(p_size) AS rss FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'SMALL' GROUP BY ALL),
j AS (SELECT p_type AS rule, count(*) AS n FROM part GROUP BY ALL)
SELECT round(sum(n * coalesce(greatest(coalesce(a, 0), coalesce(b, 0)), 0)), 3) AS work_s, greatest(1, least(336, ceil(sum(n * coalesce(greatest(coalesce(a, 0), coalesce(b, 0)), 0)) / 1000 * 1.2 / 3600)))::BIGINT AS hours, max(rss) AS rss_mb, max_by(rule, (rss, rule)) FILTER (rss IS NOT NULL) AS rss_rule FROM j LEFT JOIN h USING (rule)""")
def _(t):
    rows = t.table("lineitem").join(t.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    when: Callable[[str], Column] = lambda s: F.avg(F.when(F.col("l_linestatus") == s, F.col("l_extendedprice")))
    history = rows.where("p_type <> 'SMALL'").groupBy(F.col("p_type").alias("rule")).agg(when("O").alias("avg_1"), when("F").alias("avg_2"), (F.max("l_quantity").cast("long") + F.max("p_size")).alias("rss_mb"))
    jobs = t.table("part").groupBy(F.col("p_type").alias("rule")).agg(F.count(F.lit(1)).alias("count"))
    return r6(planning.estimate(jobs, history, 1000), "work_s", digits=3)


@query("j18_job_benchmarks", "", """WITH h AS (SELECT event_type AS rule, avg(value) AS avg_s FROM events WHERE event_type <> 'view' GROUP BY ALL) SELECT event_id, event_type AS rule, round(coalesce(avg_s, 0), 6) AS avg_s FROM events LEFT JOIN h ON h.rule = event_type""")
def _(t):
    e = t.table("events").select("event_id", F.col("event_type").alias("rule"), "value")
    h = e.where("rule <> 'view'").groupBy("rule").agg(F.avg("value").alias("avg_s"))
    return r6(e.select("event_id", "rule").join(h, "rule", "left").fillna({"avg_s": 0.0}), "avg_s")


@query("j19_feature_chroms", "features genome", "SELECT fid, chrom FROM features WHERE chrom IN (SELECT chrom FROM genome WHERE size > 10 AND chrom <> 'chr_N')")
def _(t):
    return t.features().join(t.genome().where("size > 10 and chrom <> 'chr_N'"), "chrom", "left_semi").select("fid", "chrom")


@query("j12_resume", "", "SELECT o_orderkey AS part FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(t):
    done = t.table("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("part"))
    return reads.still_to_do(t.table("orders").select(F.col("o_orderkey").alias("part")), done)


@query("piv02_nested_reads", "obs", "SELECT read_id, pos, line, phred FROM obs")
def _(t):
    packed = reads.nested(t.obs(), ["read_id"], ["pos", "line", "phred"])
    return reads.exploded(packed, ["read_id"])


@query("piv03_read_arrays", "obs", "SELECT read_id, count(*) AS n, arg_min(phred, (pos, line, phred)) AS first_phred, arg_max(phred, (pos, line, phred)) AS last_phred FROM obs GROUP BY read_id")
def _(t):
    packed = reads.nested(t.obs(), ["read_id"], ["pos", "line", "phred"])
    return packed.select("read_id", F.size("obs").cast("long").alias("n"), F.element_at("obs", 1)["phred"].alias("first_phred"), F.element_at("obs", -1)["phred"].alias("last_phred"))


@query("set01_merged_tracks", "stats", "SELECT sample, chrom, pos, strand, cov FROM stats WHERE sample = 'treatment' UNION ALL SELECT sample, chrom, pos, strand, cov FROM stats WHERE sample = 'control'")
def _(t):
    s = _stats(t).select("sample", "chrom", "pos", "strand", "cov")
    return reads.merged(s.where("sample = 'treatment'"), None, s.where("sample = 'control'"))


@query("set07_strand_pooling", "obs", "SELECT sample, chrom, pos, count(*) AS cov, round(avg(e), 6) AS error FROM obs GROUP BY ALL")
def _(t):
    out = perbase.position_stats(t.obs(), "e", name="error", keys=["sample", "chrom", "pos"])
    return r6(out.select("sample", "chrom", "pos", "cov", "error"), "error")


@query("agg28_duplicates", "", "SELECT c_mktsegment, c_nationkey, count(*) AS n, min(c_name) AS first_name FROM customer GROUP BY ALL HAVING count(*) > 1")
def _(t):
    rows = t.table("customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.min_by("c_name", "c_name").alias("first_name"))
    return rows.where("n > 1")
