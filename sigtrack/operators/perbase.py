"""Per-position statistics: coverage, mean, exact quantiles."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import known_base

QUANTILES = {"q25": 0.25, "q75": 0.75, "q025": 0.025, "q975": 0.975}
POSITION = ["sample", "chrom", "pos", "strand"]


def quantiles(value: Column, levels: dict[str, float] = QUANTILES) -> Column:
    """An array with linear interpolation between order statistics; one aggregate for all levels."""
    return F.percentile(value, [*map(float, levels.values())])


def position_stats(obs: DataFrame, value: str, *, name: str = "mean", keys: list[str] = POSITION, min_cov: int = 1, mean_square: bool = False) -> DataFrame:
    """cov, mean and quantiles of ``value`` by position; null values are no observations."""
    x = F.col(value)
    more = [F.avg(x * x).alias("mean_sq")] if mean_square else []
    out = obs.where(x.isNotNull()).groupBy(*keys).agg(F.count(x).alias("cov"), F.avg(x).alias(name), quantiles(x).alias("q"), *more)
    out = out.where(F.col("cov") >= min_cov)
    return out.select(*keys, "cov", name, *(F.col("q")[i].alias(q) for i, q in enumerate(QUANTILES)), *(["mean_sq"] if mean_square else []))


def pileup_stats(pileup: DataFrame) -> DataFrame:
    """Error statistics of mpileup rows (chrom, pos, ref, quals): each row is a position already, so
    nothing is shuffled; rows without qualities are left out."""
    from ..functions.sequence import quality_errors

    e = quality_errors(F.col("quals"))
    rows = pileup.where(F.length("quals") > 0).withColumn("e", F.array_sort(e))
    n = F.size("e")

    def at(q: float) -> Column:
        h = (n - 1) * F.lit(q)
        low = F.floor(h).cast("int")
        a, b = F.element_at("e", low + 1), F.element_at("e", F.least(low + 2, n))
        return a + (h - low) * (b - a)

    mean = F.aggregate("e", F.lit(0.0), lambda s, v: s + v) / n
    return rows.select("chrom", "pos", F.col("ref").alias("nt"), n.cast("long").alias("cov"), mean.alias("error"), *(at(q).alias(k) for k, q in QUANTILES.items()))


def missing_contigs(track: DataFrame, genome: DataFrame, on_missing: str = "error") -> list[str]:
    """The contigs of a track that the reference lacks: an error, or with "warn" a warning and bases N."""
    lacking = track.select("chrom").distinct().join(genome.select("chrom"), "chrom", "left_anti")
    found = sorted(r.chrom for r in lacking.where("chrom is not null").collect())  # contigs, not positions
    if found and on_missing == "error":
        raise ValueError(f"the reference has no contig {', '.join(found)}")
    if found:
        warnings.warn(f"the reference has no contig {', '.join(found)}: bases are N", stacklevel=2)
    return found


def reference(spark: SparkSession, path: str, track: DataFrame, on_missing: str = "error", **options: object) -> DataFrame:
    """The sequence (chrom, start, seq in pieces) of a FASTA file or folder, for a track. Contigs of the track that it lacks
    are an error, or with "warn" a warning, and have no pieces."""
    pieces = spark.read.format("fasta").options(**options).load(path)
    missing_contigs(track, pieces.select("chrom").distinct(), on_missing)
    return pieces


def with_sequence_base(track: DataFrame, pieces: DataFrame, tile: int = 1024) -> DataFrame:
    """nt of each position (from 1) of a track, from pieces (chrom, start from 0, seq); N where they have none.

    Pieces are cut to tiles and a position looks up its own: pieces begin at multiples of ``tile``.
    """
    number = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / tile).cast("int")))
    cut = pieces.where(F.length("seq") > 0).select("chrom", "start", "seq", number.alias("i"))
    tiles = cut.select("chrom", (F.floor(F.col("start") / tile) + F.col("i")).alias("tile_"), F.substring("seq", F.col("i") * tile + 1, F.lit(tile)).alias("tile_seq_"))
    at = track.withColumn("tile_", F.floor((F.col("pos") - 1) / tile)).join(tiles, ["chrom", "tile_"], "left")
    base = F.substring("tile_seq_", F.pmod(F.col("pos") - 1, F.lit(tile)).cast("int") + 1, F.lit(1))
    return at.withColumn("nt", known_base(base)).drop("tile_", "tile_seq_")


def with_reference_base(track: DataFrame, bases: DataFrame) -> DataFrame:
    """nt of each position by (chrom, pos); N where the reference has none."""
    return track.join(bases.select("chrom", "pos", "nt"), ["chrom", "pos"], "left").withColumn("nt", known_base(F.col("nt")))


def value_column(track: DataFrame, value: str, name: str = "value") -> DataFrame:
    """The common columns of a track and one of its values."""
    return track.select("sample", "chrom", "pos", "strand", "cov", F.col(value).alias(name))


def missing_values(obs: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """How many observations have a value and how many have none."""
    return obs.groupBy(*keys).agg(F.count(value).alias("n_valid"), F.count_if(F.col(value).isNull()).alias("n_missing"))
