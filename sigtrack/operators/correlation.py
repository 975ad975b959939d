"""Correlation of samples at common positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import ordered_sum


def genome_offsets(genome: DataFrame) -> DataFrame:
    """Positions before each contig in the genome's order: a row per contig."""
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return genome.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))


def sampled_positions(genome: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """``n`` positions drawn with replacement, uniform over the genome; draws come from a hash of (seed, number)."""
    offsets = genome_offsets(genome)
    total = offsets.agg(F.max(F.col("offset") + F.col("size")).alias("total")).first().total or 0
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("id")).cast("binary")), 1, 12), 16, 10).cast("long")
    rows = genome.sparkSession.range(n if total else 0).select("id", F.pmod(draw, F.lit(max(1, total))).alias("at"))
    # a range lookup as an equi-join: contigs are listed in each of 1,024 equal cells that they reach into
    cell = max(1, -(-total // 1024))
    spans = offsets.where("size > 0").select("chrom", "offset", "size", F.explode(F.sequence(F.floor(F.col("offset") / cell), F.floor((F.col("offset") + F.col("size") - 1) / cell))).alias("cell"))
    hit = rows.withColumn("cell", F.floor(F.col("at") / cell)).join(spans, "cell").where((F.col("at") >= F.col("offset")) & (F.col("at") < F.col("offset") + F.col("size")))
    return hit.select("id", "chrom", (F.col("at") - F.col("offset") + 1).alias("pos"))


def at_positions(positions: DataFrame, a: DataFrame, b: DataFrame, value: str, keys: list[str] = ["chrom", "pos"]) -> DataFrame:
    """Values and coverages of two tracks at given positions; a position drawn twice stays twice."""
    side = lambda df, i: df.select(*keys, F.col("cov").alias(f"cov_{i}"), F.col(value).alias(f"value_{i}"))
    return positions.join(side(a, 1), keys, "left").join(side(b, 2), keys, "left")


def average_rank(rows: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """Ranks within ``by``, ties at their mean; values are counted first, then ranked."""
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("ties_"))
    upto = ordered_sum(counts, by, value, "ties_", name="upto_")
    ranks = upto.withColumn(name, F.col("upto_") - F.col("ties_") + (F.col("ties_") + 1) / 2).drop("ties_", "upto_")
    return rows.join(ranks, [*by, value])


def correlations(pairs: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """n_points, pearson and spearman by key; rows without both values do not count, fewer than 3 give null."""
    rows = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).alias("x"), F.col(y).alias("y"))
    ranked = average_rank(average_rank(rows, "x", by, "rx"), "y", by, "ry")
    enough = F.count(F.lit(1)) >= 3
    return ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n_points"), F.when(enough, F.corr("x", "y")).alias("pearson"), F.when(enough, F.corr("rx", "ry")).alias("spearman"))


def sample_pairs(samples: DataFrame) -> DataFrame:
    """All ordered pairs of samples, each with itself too: a table of a few names."""
    names = samples.select("sample").distinct()
    return names.withColumnRenamed("sample", "sample_1").crossJoin(names.withColumnRenamed("sample", "sample_2"))
