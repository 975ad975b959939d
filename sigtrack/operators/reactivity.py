"""Treatment against control at each position, and what is derived from the difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import group_quantiles

SENTINEL = 999999.0
LEVELS = {"p05": 0.95, "p01": 0.99, "p001": 0.999, "p0001": 0.9999}
KEYS = ["chrom", "pos", "strand"]


def both_sides(treatment: DataFrame, control: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Only chromosomes that have rows on both sides; one empty side suppresses the other's positions."""
    shared = treatment.select(*by).distinct().join(control.select(*by).distinct(), by, "left_semi")
    return treatment.join(shared, by, "left_semi"), control.join(shared, by, "left_semi")


def reactivity(treatment: DataFrame, control: DataFrame, value: str, min_cov: int = 10) -> DataFrame:
    """Full outer join by position: reactivity, coverages, status (both, treatment, control).

    Positions of both sides below ``min_cov`` on either are dropped; positions of one side only
    stay, whatever their coverage, with reactivity null.
    """
    treatment, control = both_sides(treatment, control, ["chrom", "strand"])
    side = lambda df, s: df.select(*KEYS, F.col("cov").alias(f"cov_{s}"), F.col(value).alias(f"value_{s}"))
    both = side(treatment, "t").join(side(control, "c"), KEYS, "full_outer")
    status = F.when(F.col("cov_c").isNull(), "treatment").when(F.col("cov_t").isNull(), "control").otherwise("both")
    kept = (status != "both") | ((F.col("cov_t") >= min_cov) & (F.col("cov_c") >= min_cov))
    return both.withColumn("status", status).where(kept).withColumn("reactivity", F.col("value_t") - F.col("value_c"))


def with_sentinels(track: DataFrame) -> DataFrame:
    """The text form's value for positions of one side."""
    value = F.when(F.col("status") == "treatment", SENTINEL).when(F.col("status") == "control", -SENTINEL).otherwise(F.col("reactivity"))
    return track.withColumn("reactivity", value)


def scored(track: DataFrame) -> DataFrame:
    """Positions of both sides; a track in text form loses its sentinels."""
    return track.where(F.col("reactivity").isNotNull() & ~F.col("reactivity").isin(SENTINEL, -SENTINEL))


def mod_reactivity(treatment: DataFrame, control: DataFrame, min_cov: int = 10) -> DataFrame:
    """Difference of modified fractions at positions that both sides cover."""
    side = lambda df, s: df.where(F.col("cov") >= min_cov).select(*KEYS, F.col("cov").alias(f"cov_{s}"), F.col("frac").alias(f"frac_{s}"))
    both = side(treatment, "t").join(side(control, "c"), KEYS)
    return both.withColumn("reactivity", F.col("frac_t") - F.col("frac_c"))


def repeated_positions(track: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys that come up more than once: a track must have none."""
    return track.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_thresholds(track: DataFrame, by: list[str] = ["chrom", "strand"]) -> DataFrame:
    """Quantiles of the negative reactivities' size, the empirical null; no row where there is none."""
    size = scored(track).where("reactivity < 0").select(*by, (-F.col("reactivity")).alias("size_"))
    return group_quantiles(size, by, "size_", LEVELS)


def significant(track: DataFrame, thresholds: DataFrame, level: str = "p05", by: list[str] = ["chrom", "strand"]) -> DataFrame:
    """Scored positions at or above the threshold; without a null there is none. Level None keeps all."""
    if level is None:
        return scored(track)
    limit = thresholds.select(*by, F.col(level).alias("limit_"))  # a row for each chromosome and strand
    return scored(track).join(limit, by).where(F.col("reactivity") >= F.col("limit_")).drop("limit_")


def bedgraph(track: DataFrame, value: str = "reactivity") -> DataFrame:
    """Half-open intervals of one position each."""
    pos = F.col("pos")
    return track.select("chrom", "strand", (pos - 1).alias("start"), pos.alias("end"), F.col(value).alias("value"))


def status_counts(track: DataFrame, by: list[str]) -> DataFrame:
    return track.groupBy(*by).agg(*(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("both", "treatment", "control")))


def one_sided(status: Column) -> Column:
    return status.isin("treatment", "control")
