"""Further queries: parsing, lookups, set operations, samples, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import calls, correlation, demux, kmer, perbase, planning, profile, qc, reactivity, reads, windows
from ..sources import tables
from ..storage import shared_dir, stored
from ..streaming.keyed import KeyedStream, on_genome
from .queries import _Q, _looked_up, _react, _scored, _significant, _stats, query, r6
from .views import Tables


@query("flt03_primary_only", "alignments", "SELECT read_id, flag, mapq FROM alignments WHERE flag & 2308 = 0")
def _(t):
    return qc.primary(t.alignments()).select("read_id", "flag", "mapq")


@query("flt10_clean_observations", "obs", """AND r AS (SELECT sample AS read_id, chrom, pos, max((phred < 3)::INT) AS err, count(*) AS n FROM obs GROUP BY ALL),
w AS (SELECT *, max(err) OVER (PARTITION BY read_id, chrom ORDER BY pos RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near, min(pos) OVER (PARTITION BY read_id, chrom) AS lo, max(pos) OVER (PARTITION BY read_id, chrom) AS hi FROM r)
SELECT read_id, chrom, count(*) AS positions, sum(n)::BIGINT AS observations FROM w WHERE near = 0 AND pos - 3 >= lo AND pos + 3 <= hi GROUP BY ALL""")
def _(t):
    rows = t.obs().groupBy(F.col("sample").alias("read_id"), "chrom", "pos").agg(F.max((F.col("phred") < 3).cast("int")).alias("is_error"), F.count(F.lit(1)).alias("n"))
    clean = calls.clean_context(rows, 3).where("clean")
    return clean.groupBy("read_id", "chrom").agg(F.count(F.lit(1)).alias("positions"), F.sum("n").alias("observations"))


@query("j05_position_semi_join", "stats sig", "SELECT sample, chrom, pos, strand, cov FROM stats WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM sig)")
def _(t):
    return _stats(t).join(_significant(t).select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi").select("sample", "chrom", "pos", "strand", "cov")


@query("j11_barcode_lookup", "barcoded", r"""AND sheet AS (SELECT 'barcode' || lpad(i::VARCHAR, 2, '0') AS barcode, 'sample_' || (i % 5) AS sample FROM (SELECT unnest(generate_series(0, 19)) AS i))
SELECT read_group, regexp_extract(read_group, '(barcode[0-9]+)$', 1) AS barcode, split_part(read_group, '_', 1) AS run_id, coalesce(sample, 'unclassified') AS sample, count(*) AS n
FROM barcoded LEFT JOIN sheet ON sheet.barcode = regexp_extract(read_group, '(barcode[0-9]+)$', 1) GROUP BY ALL""")
def _(t):
    code = F.lpad(F.col("id").cast("string"), 2, "0")
    sheet = t.spark.range(20).select(F.concat(F.lit("barcode"), code).alias("barcode"), F.concat(F.lit("sample_"), F.col("id") % 5).alias("sample"))
    return demux.assigned(t.barcoded(), sheet).groupBy("read_group", "barcode", "run_id", "sample").agg(F.count(F.lit(1)).alias("n"))


@query("j13_read_signal", "", """WITH s AS (SELECT DISTINCT 'r' || l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'),
r AS (SELECT 'r' || o_orderkey AS read_id, CASE WHEN o_orderstatus = 'P' THEN 'r' || o_custkey ELSE 'r' || o_orderkey END AS signal_id FROM orders)
SELECT read_id, signal_id, id IS NOT NULL AS has_signal FROM r LEFT JOIN s ON s.id = signal_id""")
def _(t):
    signal = t.table("lineitem").where("l_returnflag = 'R'").select(F.concat(F.lit("r"), "l_orderkey").alias("read_id")).distinct()
    pi = F.when(F.col("o_orderstatus") == "P", F.create_map(F.lit("pi"), F.concat(F.lit("r"), "o_custkey"))).otherwise(F.create_map().cast("map<string,string>"))
    r = t.table("orders").select(F.concat(F.lit("r"), "o_orderkey").alias("read_id"), pi.alias("tags"))
    return reads.with_signal(r, signal).select("read_id", "signal_id", "has_signal")


@query("agg26_profile_by_strand", "features stats", """AND w AS (SELECT (i * 10 * CASE WHEN strand = '-' THEN -1 ELSE 1 END)::INT AS distance, chrom, ref + i * 10 - 5 AS low, ref + i * 10 + 5 AS high
  FROM (SELECT *, CASE WHEN strand = '-' THEN "end" ELSE start END AS ref FROM features), (SELECT unnest(generate_series(-2, 2)) AS i))
SELECT distance, s.strand, round(avg(cov), 5) AS cov, count(*) AS n FROM w JOIN stats s ON s.chrom = w.chrom AND s.pos BETWEEN low AND high GROUP BY ALL""")
def _(t):
    windows = profile.feature_windows(t.features(), 2, 10).withColumn("distance", F.col("distance").cast("int"))
    # the tracks' names, their rows and their bins' sums all read the statistics
    track = stored(_stats(t).select("chrom", "pos", "strand", "cov"))
    return r6(profile.window_means(windows, track, ["cov"], ["distance"], ["strand"]), "cov", digits=5)


@query("agg31_tag_survival", "", """WITH b AS (SELECT o_orderstatus <> 'P' AS mm, o_orderpriority LIKE '1%' AS ml, o_totalprice > 0 AS mv, o_custkey % 2 = 0 AS kept FROM orders)
SELECT 'MM' AS tag, count(*) FILTER (mm) AS n_before, count(*) FILTER (mm AND kept) AS n_after, count(*) FILTER (mm) > 0 AND count(*) FILTER (mm AND kept) = 0 AS lost FROM b
UNION ALL SELECT 'ML', count(*) FILTER (ml), 0, count(*) FILTER (ml) > 0 FROM b
UNION ALL SELECT 'mv', count(*) FILTER (mv), count(*) FILTER (mv AND kept), count(*) FILTER (mv) > 0 AND count(*) FILTER (mv AND kept) = 0 FROM b""")
def _(t):
    entry = lambda name, cond: F.when(cond, F.array(F.struct(F.lit(name).alias("key"), F.lit("x").alias("value")))).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    o = t.table("orders")
    before = o.select("o_custkey", F.map_from_entries(F.concat(entry("MM", F.col("o_orderstatus") != "P"), entry("ML", F.col("o_orderpriority").startswith("1")), entry("mv", F.col("o_totalprice") > 0))).alias("tags"))
    return qc.tag_survival(before, reads.kept_tags(before.where("o_custkey % 2 = 0"), ["MM", "mv"]), ["MM", "ML", "mv"])


@query("sc14_read_group_parts", "barcoded", r"SELECT DISTINCT read_group, nullif(regexp_extract(read_group, '(barcode[0-9]+)$', 1), '') AS barcode, split_part(read_group, '_', 1) AS run_id FROM barcoded")
def _(t):
    rows = t.barcoded().select("read_group").distinct()
    return rows.withColumn("barcode", demux.barcode_of(F.col("read_group"))).withColumn("run_id", demux.run_of(F.col("read_group")))


@query("sc17_names_of_files", "", """SELECT DISTINCT lower(c_mktsegment) || '_' || CASE WHEN c_nationkey % 2 = 0 THEN 'for' ELSE 'rev' END || '_vs_' || c_nationkey || '.tsv.gz' AS file,
lower(c_mktsegment) AS sample_of_name, CASE WHEN c_nationkey % 2 = 0 THEN 'for' ELSE 'rev' END AS strand_of_name FROM customer""")
def _(t):
    strand = F.when(F.col("c_nationkey") % 2 == 0, "for").otherwise("rev")
    files = t.table("customer").select(F.concat(F.lower("c_mktsegment"), F.lit("_"), strand, F.lit("_vs_"), "c_nationkey", F.lit(".tsv.gz")).alias("file")).distinct()
    return tables.named_parts(files, "file").select("file", "sample_of_name", "strand_of_name")


@query("sc20_unit_parsing", "", """SELECT o_orderkey, (o_custkey % 30 * 3600 + o_custkey % 60 * 60 + round(o_totalprice % 60, 1))::DOUBLE AS seconds, o_custkey % 9000 AS rss_mb FROM orders""")
def _(t):
    o = t.table("orders")
    text = F.concat(F.col("o_custkey") % 30, F.lit("h "), F.col("o_custkey") % 60, F.lit("m "), F.round(F.col("o_totalprice") % 60, 1), F.lit("s"))
    return o.select("o_orderkey", F.round(planning.seconds(text), 6).alias("seconds"), planning.megabytes(F.concat(F.col("o_custkey") % 9000, F.lit("MB"))).alias("rss_mb"))


@query("sc21_known_base", "", "SELECT p_partkey, CASE WHEN upper(substr(p_name, 1, 1)) IN ('A', 'C', 'G', 'T', 'N') THEN upper(substr(p_name, 1, 1)) ELSE 'N' END AS nt FROM part")
def _(t):
    return t.table("part").select("p_partkey", S.known_base(F.substring("p_name", 1, 1)).alias("nt"))


@query("sc07_z_scores", "obs", """AND m AS (SELECT chrom, avg(level) AS c, stddev_samp(level) AS s FROM obs GROUP BY chrom) SELECT sample, chrom, count(*) FILTER (abs((level - c) / s) > 1.5) AS beyond, round(max((level - c) / s), 5) AS largest FROM obs JOIN m USING (chrom) GROUP BY ALL""")
def _(t):
    from ..functions.statistics import z_score

    m = t.obs().groupBy("chrom").agg(F.avg("level").alias("c"), F.stddev_samp("level").alias("s"))
    z = t.obs().join(m, "chrom").withColumn("z", z_score(F.col("level"), F.col("c"), F.col("s")))
    return r6(z.groupBy("sample", "chrom").agg(F.count_if(F.abs("z") > 1.5).alias("beyond"), F.max("z").alias("largest")), "largest", digits=5)


@query("win04_top_per_key", "kmer_obs", """SELECT kmer, read_id, line, pos, supp, level FROM (
  SELECT *, row_number() OVER (PARTITION BY kmer ORDER BY md5('7|' || read_id || '|' || line || '|' || pos || '|' || supp), read_id, line, pos, supp) AS rn FROM kmer_obs) WHERE rn <= 20""")
def _(t):
    keys = ["read_id", "line", "pos", "supp"]
    return kmer.bounded_sample(t.kmer_obs(), "kmer", 20, [kmer.priority(7, *keys), *map(F.col, keys)]).select("kmer", *keys, "level")


@query("win06_weighted_quantiles", "alignments", """AND h AS (SELECT sample, length, count(*) AS w FROM alignments GROUP BY ALL), c AS (SELECT *, sum(w) OVER (PARTITION BY sample ORDER BY length) / sum(w) OVER (PARTITION BY sample) AS share FROM h)
SELECT sample, min(length) FILTER (share >= 0.01) AS q01, min(length) FILTER (share >= 0.5) AS q50, min(length) FILTER (share >= 0.99) AS q99 FROM c GROUP BY sample""")
def _(t):
    h = t.alignments().groupBy("sample", "length").agg(F.count(F.lit(1)).alias("w"))
    up = Window.partitionBy("sample").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    c = h.withColumn("share", F.sum("w").over(up) / F.sum("w").over(Window.partitionBy("sample")))
    return c.groupBy("sample").agg(*(F.min(F.when(F.col("share") >= q, F.col("length"))).alias(n) for n, q in (("q01", 0.01), ("q50", 0.5), ("q99", 0.99))))


@query("win10_first_largest", "react", "SELECT chrom, strand, first(pos ORDER BY reactivity DESC, pos) AS pos, round(max(reactivity), 6) AS reactivity FROM react WHERE status = 'both' GROUP BY ALL")
def _(t):
    best = F.max_by(F.col("pos"), F.struct(F.col("reactivity"), -F.col("pos")))
    return r6(reactivity.scored(_react(t)).groupBy("chrom", "strand").agg(best.alias("pos"), F.max("reactivity").alias("reactivity")), "reactivity")


@query("set04_position_union", "stats", "SELECT chrom, pos FROM stats WHERE sample = 'treatment' UNION SELECT chrom, pos FROM stats WHERE sample = 'control'")
def _(t):
    s = _stats(t)
    return s.where("sample = 'treatment'").select("chrom", "pos").union(s.where("sample = 'control'").select("chrom", "pos")).distinct()


@query("set05_shared_positions", "stats", "SELECT chrom, pos, strand FROM stats WHERE sample = 'treatment' INTERSECT SELECT chrom, pos, strand FROM stats WHERE sample = 'control'")
def _(t):
    s = _stats(t)
    side = lambda k: s.where(F.col("sample") == k).select("chrom", "pos", "strand")
    return side("treatment").join(side("control"), ["chrom", "pos", "strand"], "left_semi")


@query("set06_deduplicated", "obs", "SELECT DISTINCT read_id, chrom, pos FROM obs")
def _(t):
    return t.obs().select("read_id", "chrom", "pos").dropDuplicates()


@query("smp01_sampled_rows", "react", "SELECT chrom, pos, strand FROM (SELECT *, row_number() OVER (ORDER BY md5('3|' || chrom || '|' || pos || '|' || strand), chrom, pos, strand) AS rn FROM react WHERE reactivity < 0) WHERE rn <= 1000")
def _(t):
    """A sample without replacement is the feature here."""
    keys = ["chrom", "pos", "strand"]
    return reactivity.scored(_react(t)).where("reactivity < 0").orderBy(kmer.priority(3, *keys), *keys).limit(1000).select(*keys)


@query("set02_windows_in_genome_order", "genome", """AND w AS (SELECT chrom, rank, s AS start, least(s + 200, size) AS "end" FROM genome, (SELECT unnest(generate_series(0, (SELECT max(size) FROM genome), 200)) AS s) WHERE s < size)
SELECT chrom, start, "end", row_number() OVER (ORDER BY rank, start) AS place FROM w""")
def _(t):
    ordered = windows.spine(t.genome(), 200).join(t.genome().select("chrom", "rank"), "chrom")
    offsets = correlation.genome_offsets(t.genome().withColumn("n", F.ceil(F.col("size") / 200)).select("chrom", F.col("n").alias("size"), "rank"))
    place = F.col("offset") + (F.col("start") / 200).cast("long") + 1
    return ordered.join(offsets.select("chrom", "offset"), "chrom").select("chrom", "start", "end", place.alias("place"))


def _stream(t: Tables, stats, columns: list[str], width: int, runs: int = 3) -> DataFrame:
    """The observations as a stream of files in the order of the genome: each run finds a share of them, goes on with the
    windows that the one before left open, and the last finds the end of the genome."""
    spark, root = t.spark, shared_dir(t.spark)
    keys = ["sample", "chrom", "strand"]
    genome = stored(t.genome())
    located = on_genome(t.obs().select(*keys, *columns, F.col("pos").alias("read_start")), genome, width)
    # files in the order of the genome, as a stream of sorted reads has them: a task then has few windows
    rows = stored(located.repartitionByRange("coordinate").sortWithinPartitions("coordinate"))
    last = rows.agg(F.max("window_end").alias("last")).first().last or 0
    keyed = KeyedStream(f"{root}/run", stats, keys, [*keys, *columns], width)
    for i in range(runs):
        share = rows.where((F.col("coordinate") > i * last // runs) & (F.col("coordinate") <= (i + 1) * last // runs))
        if i == runs - 1:
            end = spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "coordinate"), F.lit(last + 1).alias("coordinate"))
            share = share.unionByName(end)
        share.write.mode("append").parquet(f"{root}/in")
        keyed.run(spark.readStream.schema(rows.schema).parquet(f"{root}/in"))
    return keyed.results(spark)


@query("str01_signal_stream", "obs", f"""SELECT sample, chrom, pos, strand, cov, round(mean_deviation, 9) AS mean_deviation, {_Q} FROM (
  SELECT sample, chrom, pos, strand, count(level) AS cov, avg(level) AS mean_deviation, quantile_cont(level, [0.25, 0.75, 0.025, 0.975]) AS q FROM obs GROUP BY ALL)""")
def _(t):
    stats = lambda df: perbase.position_stats(df, "level", name="mean_deviation")
    return r6(_stream(t, stats, ["pos", "level"], 500), "mean_deviation", *perbase.QUANTILES, digits=9)


@query("str02_call_stream", "obs", "SELECT sample, chrom, pos, strand, count(*) AS cov, count(*) FILTER (phred > 25) AS n_mod, round(avg(phred - 25.5), 6) AS mean_z, round(avg(abs(phred - 25.5)), 6) AS mean_absz, round(count(*) FILTER (phred > 25) / count(*), 6) AS frac FROM obs GROUP BY ALL")
def _(t):
    def totals(df):
        return calls.call_totals(df.withColumn("z", F.col("phred") - F.lit(25.5)).withColumn("called", F.col("phred") > 25))

    return r6(_stream(t, totals, ["pos", "phred"], 1000), "mean_z", "mean_absz", "frac")


@query("agg25_correlation_of_sampled", "genome stats", """AND g AS (SELECT *, coalesce(sum(size) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM genome),
d AS (SELECT id, ('0x' || substr(md5('1|' || id), 1, 12))::BIGINT % (SELECT sum(size)::BIGINT FROM genome) AS p FROM (SELECT unnest(generate_series(0, 9999)) AS id)),
s AS (SELECT id, chrom, p - off + 1 AS pos FROM d JOIN g ON p >= off AND p < off + size),
v AS (SELECT a.strand, a.cov::DOUBLE AS x, b.cov::DOUBLE AS y FROM s JOIN stats a ON a.chrom = s.chrom AND a.pos = s.pos AND a.sample = 'treatment' JOIN stats b ON b.chrom = s.chrom AND b.pos = s.pos AND b.strand = a.strand AND b.sample = 'control')
SELECT strand, count(*) AS n_points, round(corr(x, y), 6) AS pearson FROM v GROUP BY strand""")
def _(t):
    out = correlation.correlations(_looked_up(t), "cov_1", "cov_2", ["strand"])
    return r6(out.select("strand", "n_points", "pearson"), "pearson")


@query("agg07_calls_by_threshold", "scored", """SELECT p::DOUBLE AS p, sample, count(*) FILTER (abs(z) > zt) AS n_called, count(*) AS n FROM scored, (VALUES (0.05, 1.959963984540054), (0.2, 1.2815515655446004), (0.5, 0.6744897501960817)) v(p, zt) GROUP BY ALL""")
def _(t):
    from ..functions.statistics import z_threshold

    levels = F.explode(F.array(*(F.struct(F.lit(p).alias("p"), F.lit(z_threshold(p)).alias("zt")) for p in (0.05, 0.2, 0.5)))).alias("v")
    rows = _scored(t).select("sample", "z", levels).select("sample", "z", "v.p", "v.zt")
    return rows.groupBy("p", "sample").agg(F.count_if(F.abs("z") > F.col("zt")).alias("n_called"), F.count(F.lit(1)).alias("n"))
