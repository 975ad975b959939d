"""Text tables of the field as DataFrames: splittable reads with fixed schemas, no inference."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATS = "q25 double, q75 double, q025 double, q975 double"
SCHEMAS = {
    "mpileup": "chrom string, pos long, ref string, depth int, bases string, quals string",
    "fai": "chrom string, size long, offset long, line_bases int, line_width int",
    "perbase_error": f"chrom string, pos long, nt string, cov long, error double, {STATS}",
    "perbase_signal": f"chrom string, pos long, nt string, cov long, mean_deviation double, {STATS}, mean_sq double",
    "mod_calls": "chrom string, pos long, nt string, cov long, frac double, n_mod long, mean_z double, mean_absz double",
    "density": "chrom string, start long, end long, count long, sum double",
}


def tsv(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    """Tab-separated rows; quotes are ordinary characters, as quality strings contain them."""
    return spark.read.schema(schema).options(sep="\t", quote="", mode="PERMISSIVE", **options).csv(path)


def read_mpileup(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, SCHEMAS["mpileup"]).where(F.length("quals") > 0)


def read_track(spark: SparkSession, path: str, kind: str = "perbase_error") -> DataFrame:
    """A per-position table, plain or compressed; rows with no coverage are faulty and left out."""
    return tsv(spark, path, SCHEMAS[kind]).where("chrom is not null and pos is not null and cov is not null")


def read_reactivity(spark: SparkSession, path: str) -> DataFrame:
    """Text reactivity; sentinels and what is no number are no values."""
    rows = tsv(spark, path, "chrom string, pos long, nt string, value string")
    value = F.expr("try_cast(value as double)")
    return rows.withColumn("reactivity", value).drop("value").where("reactivity is not null and abs(reactivity) <> 999999")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, size and rank; contigs stand in the index by their place in the sequence file."""
    from pyspark.sql import Window

    rows = tsv(spark, path, SCHEMAS["fai"])
    return rows.select("chrom", "size", F.row_number().over(Window.orderBy("offset")).alias("rank"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    rows = tsv(spark, path, "chrom string, start long, end long, name string, score string, strand string", comment="#")
    return rows.where("start is not null and end is not null").withColumn("score", F.expr("try_cast(score as double)")).withColumn("strand", F.coalesce("strand", F.lit("+")))


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    rows = tsv(spark, path, "chrom string, start long, end long, value double", comment="#")
    return rows.where("chrom is not null and start is not null")


_THRESHOLD = r"^#\s*(p[0-9]+)\s*=\s*([-+0-9.eE]+)"


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """(level, value) of a bedGraph's header lines."""
    lines = spark.read.text(path).where(F.col("value").startswith("#"))
    return lines.select(F.regexp_extract("value", _THRESHOLD, 1).alias("level"), F.expr(f"try_cast(regexp_extract(value, '{_THRESHOLD}', 2) as double)").alias("value")).where("level <> ''")


def read_meta(spark: SparkSession, path: str) -> dict[str, str]:
    """``#key=value`` lines: a few, so they come to the driver."""
    lines = spark.read.text(path).where(F.col("value").rlike("^#[^=]+=")).collect()
    return dict(r.value[1:].split("=", 1) for r in lines)


def read_kmer_model(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    rows = tsv(spark, path, "kmer string, n long, n_outlier long, mean double, sd double, median double, mad double", comment="#", nullValue="NA")
    return rows.where("n is not null"), read_meta(spark, path)


def read_null_histograms(spark: SparkSession, paths: list[str], expected: Mapping[str, str] | None = None) -> DataFrame:
    """(bin, count) of several files added up; all must be of the same statistic."""
    metas = [read_meta(spark, p) for p in paths]
    for p, m in zip(paths, metas):
        if m != metas[0] or any(m.get(k) != v for k, v in (expected or {}).items()):
            raise ValueError(f"{p} holds another statistic: {m}")
    rows = tsv(spark, paths, "bin_lower double, count long", comment="#").where("count is not null")
    return rows.groupBy(F.round(F.col("bin_lower") / 0.01).cast("long").alias("bin")).agg(F.sum("count").alias("count"))


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.demux import sample_sheet, sheet_faults

    sheet = sample_sheet(tsv(spark, path, "barcode string, sample string", comment="#"))
    if faults := sheet_faults(sheet).limit(5).collect():
        raise ValueError("sample sheet: " + "; ".join(f"{f.barcode}: {f.fault}" for f in faults))
    return sheet


SWEEP = ["set", "backend", "mapq", "mad", "max_obs", "flank", "scale", "min_kmer_obs", "fisher_lag", "threshold"]


def read_sweep(spark: SparkSession, path: str) -> DataFrame:
    """Parameter sets, checked: required columns, unique names, known words."""
    rows = spark.read.options(sep="\t", header=True, comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).csv(path)
    if missing := [c for c in SWEEP if c not in rows.columns]:
        raise ValueError(f"sweep table has no column {', '.join(missing)}")
    rows = rows.select(*SWEEP)
    bad = F.coalesce(*(F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(f"no {c}")) for c in SWEEP), F.when(~F.col("scale").isin("sd", "mad"), "scale"), F.when(~F.col("flank").rlike(r"^(default|off|\d+)$"), "flank"), F.when(~F.col("threshold").rlike(r"^(p|fpr)[0-9.eE-]+$"), "threshold"))
    faults = rows.select("set", bad.alias("fault")).where("fault is not null").unionByName(rows.groupBy("set").count().where("count > 1").select("set", F.lit("used twice").alias("fault")))
    if found := faults.limit(5).collect():
        raise ValueError("sweep table: " + "; ".join(f"{f.set}: {f.fault}" for f in found))
    return rows


def threshold_tag(tag: str) -> tuple[str, float]:
    """Kind and value of a tag like p0.02 or fpr0.02."""
    m = re.fullmatch(r"(p|fpr)([0-9.eE-]+)", tag)
    if not m:
        raise ValueError(f"threshold {tag!r} is neither p<value> nor fpr<value>")
    return m[1], float(m[2])


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text as alignment rows; header lines are left out, tags become a map."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(f.alias("f"))
    ops = F.expr("regexp_extract_all(f[5], '([0-9]+)([MIDNSHP=X])', 0)")
    cigar = F.transform(ops, lambda o: F.struct((F.position(F.right(o, F.lit(1)), F.lit("MIDNSHP=X")) - 1).cast("int").alias("op"), F.regexp_extract(o, "^([0-9]+)", 1).cast("int").alias("len")))
    tags = F.map_from_entries(F.transform(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.regexp_replace(t, "^..:.:", ""))))
    return rows.select(F.col("f")[0].alias("read_id"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("chrom"), (F.col("f")[3].cast("long") - 1).alias("start"), F.col("f")[4].cast("int").alias("mapq"), cigar.alias("cigar"), F.col("f")[9].alias("seq"), F.col("f")[10].alias("qual"), tags.alias("tags"))


_NAME = {"sample": r"^(.*?)(?:_(?:for|rev))?(?:_vs_.*)?$", "strand": r"_(for|rev)(?:[_.]|$)"}


def named_parts(df: DataFrame, column: str) -> DataFrame:
    """sample and strand that older files carry in their names."""
    base = F.regexp_replace(F.regexp_replace(column, "^.*/", ""), r"(\.(gz|fastq|fq|bam|fa|fasta|bed|tsv))+$", "")
    return df.withColumn("strand_of_name", F.regexp_extract(column, _NAME["strand"], 1)).withColumn("sample_of_name", F.regexp_extract(base, _NAME["sample"], 1))


def read_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    """rule, avg_1, avg_2 (seconds) and rss_mb of a pipe-separated table of two earlier runs.

    Each run's cell is ``total / n / avg / rss / load``.
    """
    from ..operators.planning import megabytes, seconds

    f = F.split("value", r"\s*\|\s*")
    cell = lambda i, k: F.trim(F.get(F.split(F.get("f", F.lit(i)), "/"), F.lit(k)))
    rows = spark.read.text(path).select(f.alias("f")).where((F.size("f") >= 3) & ~F.get("f", F.lit(0)).startswith("#"))
    return rows.select(F.trim(F.get("f", F.lit(0))).alias("rule"), seconds(cell(1, 2)).alias("avg_1"), seconds(cell(2, 2)).alias("avg_2"), F.greatest(megabytes(cell(1, 3)), megabytes(cell(2, 3))).alias("rss_mb"))


_SAMPLE = r"sample=([^/]*)/[^/]*$"


def _sample_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file, or of a folder of files with a folder for each sample; sample is null for a file alone."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).withColumn("file", F.url_decode(F.col("_metadata.file_path")))
    return lines.select(F.nullif(F.regexp_extract("file", _SAMPLE, 1), F.lit("")).alias("sample"), "value")


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """(sample, section, name, value) of the sectioned text of alignment statistics, all files in one long table.

    ``SN`` lines are named numbers, ``RL``, ``MAPQ`` and ``COV`` lines counts by value; an ``ID`` line
    has the insertions and the deletions of a length and gives a row for each, ``INS`` and ``DEL``.
    Other sections and comments are left out; what is no number is null.
    """
    f = F.split("value", "\t")
    rows = _sample_lines(spark, path).where(F.col("value").rlike(r"^(SN|RL|MAPQ|COV|ID|INS|DEL)\t")).select("sample", f.alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    item = lambda section, value: F.struct(section.alias("section"), F.regexp_replace(at(1), ":$", "").alias("name"), value.try_cast("double").alias("value"))
    items = F.when(at(0) == "ID", F.array(item(F.lit("INS"), at(2)), item(F.lit("DEL"), at(3)))).otherwise(F.array(item(at(0), at(2))))
    return rows.select("sample", F.explode(items).alias("i")).select("sample", "i.*")


def read_flagstat(spark: SparkSession, path: str) -> DataFrame:
    """(sample, name, passed, failed) of lines ``passed + failed class``; shares in brackets are left out."""
    line = r"^([0-9]+) \+ ([0-9]+) ([^(]*[^( ])"
    rows = _sample_lines(spark, path).where(F.col("value").rlike(line))
    part = lambda i: F.regexp_extract("value", line, i)
    return rows.select("sample", F.regexp_replace(part(3), " ", "_").alias("name"), part(1).cast("long").alias("passed"), part(2).cast("long").alias("failed"))
