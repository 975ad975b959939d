"""Queries that write records from the given tables to the shared folder and read them back in splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import perbase, qc, signal, windows
from ..operators.reactivity import scored
from ..sources import records, sinks, tables
from ..storage import shared_dir, stored
from .queries import _FLAGS, _SUMMARY, _react, query, r6
from .views import Tables

#: Hexadecimal digits as bases, and as quality characters that begin like a record's first and third line do.
_BASES, _QUALS = ("0123456789abcdef", "ACGTACGTACGTNACG"), ("012", "@+#")


def _hashed(text, digits) -> F.Column:
    return F.translate(F.md5(text.cast("string").cast("binary")), *digits)


_READS = """SELECT 'r' || o_orderkey AS read_id, translate(md5(o_orderkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTNACG') AS seq,
translate(md5('q' || o_orderkey), '012', '@+#') AS qual FROM orders"""


def _reads(t: Tables):
    key = F.col("o_orderkey")
    return t.table("orders").select(F.concat(F.lit("r"), key).alias("read_id"), _hashed(key, _BASES).alias("seq"), _hashed(F.concat(F.lit("q"), key), _QUALS).alias("qual"), "o_orderkey", "o_custkey", "o_orderstatus")


@query("src01_fastq_split", "", _READS)
def _(t):
    path = f"{shared_dir(t.spark)}/reads"
    records.register(t.spark)
    records.write_fastq(_reads(t).select("read_id", "seq", "qual"), path)
    files = t.spark.read.format("fastq").option("splitBytes", 1 << 16)
    # Spark's text files have endings of their own
    return files.option("endings", ".txt").load(path)


@query("src02_bam_split", "", f"""SELECT read_id, (o_orderkey % 4096)::INT AS flag, 'chr_' || o_orderstatus AS chrom, o_custkey AS start, (o_custkey % 61)::INT AS mapq,
(o_orderkey % 9 + 1) || 'M2I' || (29 - o_orderkey % 9) || 'M' AS cigar, seq, qual, (o_custkey % 40)::VARCHAR AS nm, 'run_barcode' || (o_orderkey % 24) AS rg
FROM ({_READS}) JOIN orders ON read_id = 'r' || o_orderkey""")
def _(t):
    step = lambda op, n: F.struct(F.lit(op).alias("op"), n.cast("int").alias("len"))
    nine = F.col("o_orderkey") % 9
    tags = F.map_from_arrays(F.array(F.lit("NM"), F.lit("RG")), F.array((F.col("o_custkey") % 40).cast("string"), F.concat(F.lit("run_barcode"), F.col("o_orderkey") % 24)))
    rows = _reads(t).select(
        "read_id", (F.col("o_orderkey") % 4096).cast("int").alias("flag"), F.concat(F.lit("chr_"), "o_orderstatus").alias("chrom"), F.col("o_custkey").cast("long").alias("start"), (F.col("o_custkey") % 61).cast("int").alias("mapq"),
        F.array(step(0, nine + 1), step(1, F.lit(2)), step(0, 29 - nine)).alias("cigar"), "seq", "qual", tags.alias("tags"),
    )
    path = f"{shared_dir(t.spark)}/alignments"
    records.register(t.spark)
    rows.write.format("bam").option("contigs", ",".join(f"chr_{c}:{1 << 30}" for c in "FOP")).mode("append").save(path)
    got = t.spark.read.format("bam").option("splitBytes", 1 << 17).load(path)
    letters = F.transform("cigar", lambda c: F.concat(c["len"], F.substring(F.lit("MIDNSHP=X"), c["op"] + 1, F.lit(1))))
    return got.select("read_id", "flag", "chrom", "start", "mapq", F.array_join(letters, "").alias("cigar"), "seq", "qual", F.col("tags")["NM"].alias("nm"), F.col("tags")["RG"].alias("rg"))


def _reference(t: Tables) -> str:
    """The documents' sequences as an indexed FASTA folder."""
    path = f"{shared_dir(t.spark)}/reference"
    records.register(t.spark)
    records.write_fasta(t.sequences().select(F.concat(F.lit("doc_"), "doc_id").alias("chrom"), "seq"), path)
    records.index_fasta(t.spark, path, (".txt",))
    return path


@query("src05_fasta_ranges", "sequences", """SELECT 'doc_' || doc_id AS chrom, i * 1000 AS start, length(substr(seq, i * 1000 + 1, 1000))::BIGINT AS n, md5(substr(seq, i * 1000 + 1, 1000)) AS digest
FROM (SELECT doc_id, seq, unnest(range((length(seq) + 999) // 1000)) AS i FROM sequences)""")
def _(t):
    pieces = t.spark.read.format("fasta").options(pieceBases=1000, splitBytes=100_000, endings=".txt").load(_reference(t))
    return pieces.select("chrom", "start", F.length("seq").cast("long").alias("n"), F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("src05_reference_bases", "sequences", """AND p AS (SELECT DISTINCT 'doc_' || (l_orderkey % 1500) AS chrom, l_partkey % 4000 + 1 AS pos FROM lineitem),
b AS (SELECT p.chrom, pos, substr(seq, pos::INT, 1) AS b FROM p LEFT JOIN sequences ON p.chrom = 'doc_' || doc_id)
SELECT chrom, pos, CASE WHEN b IN ('A', 'C', 'G', 'T') THEN b ELSE 'N' END AS nt FROM b""")
def _(t):
    # some of these contigs are not in the reference: a warning, and N
    track = t.table("lineitem").select(F.concat(F.lit("doc_"), F.col("l_orderkey") % 1500).alias("chrom"), (F.col("l_partkey") % 4000 + 1).alias("pos")).distinct()
    pieces = perbase.reference(t.spark, _reference(t), track, on_missing="warn", endings=".txt")
    return perbase.with_sequence_base(track, pieces).select("chrom", "pos", "nt")


_SN = ["sequences", "bases", "reads_mapped", "bases_mapped", "mismatches"]


@query("src19_stats_text", "alignments", f"""AND s AS ({_SUMMARY.format(src="alignments")}),
f AS (SELECT sample, {_FLAGS} FROM (SELECT *, flag & 2304 = 0 AS m, flag & 4 AS u, flag & 1 <> 0 AND flag & 2304 = 0 AS p FROM alignments) GROUP BY sample)
SELECT sample, 'SN' AS section, name, value::DOUBLE AS value FROM (UNPIVOT (SELECT sample, {", ".join(_SN)} FROM s) ON {", ".join(_SN)})
UNION ALL SELECT sample, 'flagstat', name, value::DOUBLE FROM (UNPIVOT (SELECT sample, total, "primary", secondary, mapped FROM f) ON total, "primary", secondary, mapped)
UNION ALL SELECT sample, 'RL', length::VARCHAR, count(*)::DOUBLE FROM alignments GROUP BY ALL
UNION ALL SELECT sample, 'MAPQ', mapq::VARCHAR, count(*)::DOUBLE FROM alignments GROUP BY ALL""")
def _(t):
    rows, root = t.alignments(), shared_dir(t.spark)
    sinks.write_stats(qc.alignment_summary(rows, ["sample"]).select("sample", *_SN), qc.histograms(rows, {"RL": "length", "MAPQ": "mapq"}, ["sample"]), f"{root}/stats")
    sinks.write_flagstat(qc.flag_counts(rows, ["sample"]).select("sample", "total", "primary", "secondary", "mapped"), f"{root}/flagstat")
    stats = tables.read_stats(t.spark, f"{root}/stats")
    flags = tables.read_flagstat(t.spark, f"{root}/flagstat").select("sample", F.lit("flagstat").alias("section"), "name", F.col("passed").cast("double").alias("value"))
    return stats.unionByName(flags)


@query("src12_trimmed_levels", "obs", """AND s AS (SELECT read_id, list(level ORDER BY line, pos, supp) AS x FROM obs GROUP BY read_id),
b AS (SELECT read_id, x, unnest(range((len(x) + 2) // 3)) AS base FROM s),
c AS (SELECT read_id, base, x[base * 3 + 1:least(base * 3 + 3, len(x))] AS own FROM b),
d AS (SELECT read_id, base, len(own) AS dwell, CASE WHEN len(own) > 2 THEN own[2:len(own) - 1] ELSE own END AS own FROM c)
SELECT read_id, base::INT AS base, dwell::INT AS dwell, round(list_avg(own), 9) AS level, round(list_stddev_pop(own), 9) AS level_sd FROM d""")
def _(t):
    samples = t.obs().groupBy("read_id").agg(F.array_sort(F.collect_list(F.struct("line", "pos", "supp", "level"))).alias("s")).select("read_id", F.transform("s", lambda s: s["level"]).alias("samples"))
    n = F.size("samples")
    bounds = F.array_append(F.sequence(F.lit(0), n - 1, F.lit(3)), n)  # a base every three samples
    out = signal.base_levels(samples.withColumn("bounds", bounds)).select("read_id", "base", "dwell", "level", "level_sd")
    return r6(out, "level", "level_sd", digits=9)


@query("snk06_zoom_levels", "react", "\nUNION ALL\n".join(
    f"SELECT chrom, strand, {k} AS level, ((pos - 1) // {16 * 4**k}) * {16 * 4**k} AS start, count(*) AS n, round(min(reactivity), 6) AS least, round(max(reactivity), 6) AS largest, round(sum(reactivity), 6) AS total, round(sum(reactivity * reactivity), 6) AS squares FROM react WHERE status = 'both' GROUP BY ALL"
    for k in range(4)))
def _(t):
    zoom = windows.zoom_levels(scored(_react(t)), "reactivity", ["chrom", "strand"], base=16, factor=4, levels=4)
    return r6(zoom, "least", "largest", "total", "squares")


@query("snk13_published_track", "react", "SELECT chrom, pos, strand, status FROM react WHERE status = 'both'")
def _(t):
    track = _react(t).select("chrom", "pos", "strand", "status")
    path = f"{shared_dir(t.spark)}/track"
    # the second version takes the first one's place
    sinks.publish(track, path)
    sinks.publish(sinks.published(t.spark, path).where("status = 'both'"), path)
    return sinks.published(t.spark, path)


@query("snk01_text_track", "react", "SELECT chrom, pos, strand, round(reactivity, 6) AS reactivity FROM react WHERE status = 'both'")
def _(t):
    path = f"{shared_dir(t.spark)}/track"
    sinks.write_track(scored(_react(t)).select("chrom", "pos", "strand", "reactivity"), path, partition_by=("chrom",))
    rows = t.spark.read.schema("pos long, strand string, reactivity double, chrom string").options(sep="\t", quote="").csv(path)
    return rows.select("chrom", "pos", "strand", "reactivity")


@query("snk10_model_files", "model", "SELECT kmer, n, n_outlier, round(mean, 6) AS mean, round(sd, 6) AS sd, round(median, 6) AS median, round(mad, 6) AS mad FROM model")
def _(t):
    from .queries import _model

    path = f"{shared_dir(t.spark)}/model"
    sinks.write_model(_model(t), {"backend": "tables", "kmer_len": 8}, path)
    return tables.read_kmer_model(t.spark, path)[0]


@query("snk07_summary_table", "alignments", f"SELECT sample, sequences, bases, reads_mapped FROM ({_SUMMARY.format(src='alignments')})")
def _(t):
    path = f"{shared_dir(t.spark)}/summary"
    sinks.write_summary(qc.alignment_summary(t.alignments(), ["sample"]).select("sample", "sequences", "bases", "reads_mapped"), path)
    return t.spark.read.schema("sample string, sequences long, bases long, reads_mapped long").csv(path, header=True)


@query("snk11_per_read_table", "obs", "SELECT read_id, chrom, pos, strand, round(e, 4) AS error FROM obs")
def _(t):
    path = f"{shared_dir(t.spark)}/reads"
    sinks.write_per_read(t.obs().select("read_id", "chrom", "pos", "strand", F.col("e").alias("error")), path)
    return t.spark.read.schema("read_id long, chrom string, pos long, strand string, error double").options(sep="\t", quote="", header=True).csv(path)


@query("snk05_bedgraph_file", "sig", 'SELECT chrom, pos - 1 AS start, pos AS "end", round(reactivity, 6) AS value FROM sig WHERE strand = \'for\'')
def _(t):
    from ..operators.reactivity import bedgraph
    from .queries import _significant

    path = f"{shared_dir(t.spark)}/significant"
    sinks.write_bedgraph(bedgraph(stored(_significant(t)).where("strand = 'for'")), {"p05": 0.05}, path)
    return tables.read_bedgraph(t.spark, path)
