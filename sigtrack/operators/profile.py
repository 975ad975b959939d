"""Profiles of a track around features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import range_sums


def feature_windows(features: DataFrame, n: int, width: int) -> DataFrame:
    """2n + 1 windows around each feature (fid, chrom, start, end, strand): distance, low, high (inclusive).

    The reference point is the start, or the end on the minus strand, where distances change sign.
    Neighbouring windows share an edge position when ``width`` is even.
    """
    minus = F.coalesce("strand", F.lit("+")) == "-"
    ref = F.when(minus, F.col("end")).otherwise(F.col("start"))
    rows = features.select("fid", "chrom", ref.alias("ref"), minus.alias("minus"), F.explode(F.sequence(F.lit(-n), F.lit(n))).alias("i"))
    centre, half = F.col("ref") + F.col("i") * width, width // 2
    return rows.select("fid", "chrom", (F.col("i") * width * F.when(F.col("minus"), -1).otherwise(1)).alias("distance"), (centre - half).alias("low"), (centre + half).alias("high"))


def window_means(windows: DataFrame, tracks: DataFrame, values: list[str], keys: list[str], by: list[str]) -> DataFrame:
    """Mean of each value, and the rows n, over all windows (chrom, low, high) of the same ``keys``, by track; nulls do not count."""
    sums = range_sums(windows, tracks, values, by)
    mean = lambda v: F.try_divide(F.sum(f"sum_{v}"), F.sum(f"n_{v}")).alias(v)
    return sums.groupBy(*keys, *by).agg(*(mean(v) for v in values), F.sum("n").alias("n"))


def feature_profile(features: DataFrame, tracks: DataFrame, values: list[str], n: int, width: int, by: list[str] = ["sample", "strand"]) -> DataFrame:
    """Mean of each value by feature, window and track, from running sums at the windows' edges."""
    windows = feature_windows(features, n, width).withColumn("distance", F.col("distance").cast("int"))
    return window_means(windows, tracks, values, ["fid", "distance"], by).drop("n")


def in_output_order(profile: DataFrame) -> DataFrame:
    """A profile as it is written: by distance, then sample and strand."""
    return profile.orderBy("distance", "sample", "strand")


def average_profile(profile: DataFrame, values: list[str], by: list[str] = ["sample", "strand"]) -> DataFrame:
    """Mean over features by distance and track; a null is no observation."""
    return profile.groupBy("distance", *by).agg(*(F.avg(v).alias(v) for v in values), F.count(F.lit(1)).alias("n"))
