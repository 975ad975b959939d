"""Quality-control tables of reads and alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import error_phred

#: Flag bits of alignment records.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, READ1, READ2, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = (1 << i for i in range(12))


def bit(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) != 0


def by_strand(alignments: DataFrame, strand: str) -> DataFrame:
    return alignments.where(bit(F.col("flag"), REVERSE) if strand == "rev" else ~bit(F.col("flag"), REVERSE))


def primary(alignments: DataFrame) -> DataFrame:
    return alignments.where(~bit(F.col("flag"), UNMAPPED | SECONDARY | SUPPLEMENTARY))


def filtered(alignments: DataFrame, mapq: int = 0) -> DataFrame:
    """Primary alignments of a mapping quality of ``mapq`` or more."""
    if mapq < 0 or mapq != int(mapq):
        raise ValueError("mapq is a whole number of 0 or more")
    return primary(alignments).where(F.col("mapq") >= mapq)


def weighted_half(rows: DataFrame, value: str, weight: str, by: list[str], name: str) -> DataFrame:
    """The first value, from the largest down, at which half of the weight is reached.

    Values are summed up first, so the running sum has a row for each distinct value.
    """
    sums = rows.groupBy(*by, value).agg(F.sum(weight).alias("w"))
    down = Window.partitionBy(*by).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("w").over(Window.partitionBy(*by))
    cum = sums.withColumn("cum", F.sum("w").over(down)).withColumn("total", total)
    return cum.where(F.col("cum") >= F.col("total") / 2).groupBy(*by).agg(F.max(value).alias(name))


def n50(reads: DataFrame, by: list[str]) -> DataFrame:
    return weighted_half(reads, "length", "length", by, "n50")


def q50(reads: DataFrame, by: list[str]) -> DataFrame:
    """Length-weighted median of reads' Phred values in steps of 0.1."""
    binned = reads.withColumn("bin", F.floor(10 * error_phred(F.col("error")) + 0.5).cast("long"))
    return weighted_half(binned, "bin", "length", by, "bin").select(*by, (F.col("bin") / 10).alias("q50"))


def read_totals(reads: DataFrame, by: list[str]) -> DataFrame:
    """Gigabases and million reads, cut (not rounded) to four decimals."""
    cut = lambda c: F.floor(c * 1e4) / 1e4
    sums = reads.groupBy(*by).agg(F.sum("length").alias("bases"), F.count(F.lit(1)).alias("reads"))
    return sums.select(*by, cut(F.col("bases") / 1e9).alias("giga_bp"), cut(F.col("reads") / 1e6).alias("reads_million"))


def read_stats(reads: DataFrame, by: list[str]) -> DataFrame:
    """Totals, N50 and Q50 in one row for each key."""
    return read_totals(reads, by).join(n50(reads, by), by).join(q50(reads, by), by)


def check_has_reads(stats: DataFrame) -> None:
    if stats.isEmpty():
        raise ValueError("there are no reads")


def flag_counts(alignments: DataFrame, by: list[str] = []) -> DataFrame:
    """Counts of the usual flag classes, one row for each key."""
    f = F.col("flag")
    mapped, main = ~bit(f, UNMAPPED), ~bit(f, SECONDARY | SUPPLEMENTARY)
    paired = bit(f, PAIRED) & main
    both = paired & mapped & ~bit(f, MATE_UNMAPPED)
    classes = {
        "total": F.lit(True), "primary": main, "secondary": bit(f, SECONDARY), "supplementary": bit(f, SUPPLEMENTARY) & ~bit(f, SECONDARY), "duplicates": bit(f, DUPLICATE),
        "primary_duplicates": bit(f, DUPLICATE) & main, "mapped": mapped, "primary_mapped": mapped & main, "paired": paired, "read1": paired & bit(f, READ1), "read2": paired & bit(f, READ2),
        "properly_paired": paired & bit(f, PROPER) & mapped, "both_mapped": both, "singletons": paired & mapped & bit(f, MATE_UNMAPPED), "qc_fail": bit(f, QC_FAIL), "reverse": mapped & bit(f, REVERSE),
    }
    return alignments.groupBy(*by).agg(*(F.count_if(c).alias(k) for k, c in classes.items()))


def alignment_summary(alignments: DataFrame, by: list[str]) -> DataFrame:
    """Sequences, bases, mapped reads and bases, mismatches, error rate, mean length and quality."""
    mapped = ~bit(F.col("flag"), UNMAPPED)
    a = alignments.where(~bit(F.col("flag"), SECONDARY | SUPPLEMENTARY)).groupBy(*by)
    out = a.agg(F.count(F.lit(1)).alias("sequences"), F.sum("length").alias("bases"), F.count_if(mapped).alias("reads_mapped"), F.sum(F.when(mapped, F.col("length")).otherwise(0)).alias("bases_mapped"), F.sum(F.when(mapped, F.col("mismatches")).otherwise(0)).alias("mismatches"), F.avg("length").alias("mean_length"), F.avg(F.when(mapped, F.col("mapq"))).alias("mean_mapq"))
    return out.withColumn("error_rate", F.when(F.col("bases_mapped") > 0, F.col("mismatches") / F.col("bases_mapped")))


def stats_table(raw: DataFrame, passed: DataFrame, metrics: list[str], by: list[str]) -> DataFrame:
    """Long statistics of both states side by side, and from there one row for each state."""
    both = raw.select(*by, F.lit("Not_filtered").alias("status"), *metrics).unionByName(passed.select(*by, F.lit("Filtered").alias("status"), *metrics))
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics)))
    return both.select(*by, "status", pairs.alias("p")).select(*by, "status", "p.*")


def pivoted(long: DataFrame, metrics: list[str], by: list[str]) -> DataFrame:
    return long.groupBy(*by, "status").pivot("metric", metrics).agg(F.first("value"))


def histograms(rows: DataFrame, columns: dict[str, str], by: list[str] = []) -> DataFrame:
    """(var, value, count) of several columns: exploded before one aggregate, so the table is read once."""
    items = F.explode(F.array(*(F.struct(F.lit(k).alias("var"), F.col(c).cast("string").alias("value")) for k, c in columns.items())))
    return rows.select(*by, items.alias("i")).select(*by, "i.*").where("value is not null").groupBy(*by, "var", "value").agg(F.count(F.lit(1)).alias("count"))


def indel_lengths(rows: DataFrame, by: list[str] = [], cigar: str = "cigar") -> DataFrame:
    """(var, value, count) of the lengths of insertions and deletions, INS and DEL."""
    steps = F.explode(F.regexp_extract_all(cigar, F.lit(r"([0-9]+[ID])"), 1))
    found = rows.select(*by, steps.alias("step")).withColumn("var", F.when(F.col("step").endswith("I"), "INS").otherwise("DEL"))
    return found.groupBy(*by, "var", F.regexp_extract("step", "[0-9]+", 0).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def coverage_histogram(runs: DataFrame, by: list[str] = [], most: int = 1000) -> DataFrame:
    """(var, value, count): positions by depth of ``coverage_runs``, in brackets [d-d], from ``most`` on [>=most]."""
    depth = F.col("depth")
    label = F.when(depth >= most, F.lit(f"[>={most}]")).otherwise(F.concat(F.lit("["), depth, F.lit("-"), depth, F.lit("]")))
    return runs.groupBy(*by, F.lit("COV").alias("var"), label.alias("value")).agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("count"))


def bracket_start(value: Column) -> Column:
    """The number that a coverage bracket starts with: [7-9] is 7, [>=1000] is 1000; null if it has none."""
    return F.regexp_extract(value, r"^\[?(?:>=)?([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def winsorised(histogram: DataFrame, by: list[str], value: str = "value", count: str = "count", bins: int = 50) -> DataFrame:
    """``bins`` equal bins between the weighted 1st and 99th percentiles; what lies outside is capped.

    Bins are closed on the right, the first also on the left; one value alone is one bin.
    """
    sums = histogram.groupBy(*by, value).agg(F.sum(count).alias("w"))
    up = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    cum = sums.withColumn("share", F.sum("w").over(up) / F.sum("w").over(whole))
    ends = cum.withColumn("low", F.min(F.when(F.col("share") >= 0.01, F.col(value))).over(whole)).withColumn("high", F.min(F.when(F.col("share") >= 0.99, F.col(value))).over(whole))
    width = (F.col("high") - F.col("low")) / bins
    capped = F.greatest("low", F.least(F.col(value), "high"))
    at = F.when(F.col("high") > F.col("low"), F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((capped - F.col("low")) / width)))).otherwise(1).cast("int")
    return ends.groupBy(*by, at.alias("bin"), "low", "high").agg(F.sum("w").alias("count"))


def tag_survival(before: DataFrame, after: DataFrame, tags: list[str]) -> DataFrame:
    """Records that have each tag before and after a step; ``lost`` where a tag class is gone."""
    count = lambda df, s: df.agg(*(F.count_if(F.map_contains_key("tags", t)).alias(t) for t in tags)).select(F.explode(F.array(*(F.struct(F.lit(t).alias("tag"), F.col(t).alias(s)) for t in tags)))).select("col.*")
    return count(before, "n_before").join(count(after, "n_after"), "tag").withColumn("lost", (F.col("n_before") > 0) & (F.col("n_after") == 0))
