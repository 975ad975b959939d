"""Calls of modified positions from scored observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.statistics import P_FLOOR, chi2_survival
from .running import with_halo

BIN, BINS = 0.01, 10_000


def fisher_combined(obs: DataFrame, lag: int, *, p: str = "p", read: list[str] = ["read_id", "chrom"], pos: str = "pos", width: int = 1 << 16) -> DataFrame:
    """combined: p-values of a read within ``lag`` positions joined by Fisher's method.

    The window is by position, so gaps are simply absent; one row for each read and position. A
    read is cut into bins with a halo of ``lag`` positions, so a long one is no single task.
    """
    if lag == 0:
        return obs.withColumn("combined", F.col(p))
    near = Window.partitionBy(*read, "bin_").orderBy(pos).rangeBetween(-lag, lag)
    s = -F.sum(F.log(F.greatest(F.col(p), F.lit(P_FLOOR)))).over(near)
    rows = with_halo(obs, pos, lag, max(width, 4 * lag))
    rows = rows.withColumn("s_", s).withColumn("m_", F.count(p).over(near)).where("own_")
    return rows.withColumn("combined", chi2_survival(F.col("s_"), F.col("m_"))).drop("s_", "m_", "bin_", "own_")


def clean_context(obs: DataFrame, flank: int, *, error: str = "is_error", read: list[str] = ["read_id", "chrom"], pos: str = "pos", width: int = 1 << 16) -> DataFrame:
    """clean: no error within ``flank`` positions and that window inside the read's span; -1 turns it off.

    Bins of positions have a halo of the errors at their edges, and spans are a row per read: what
    is as long as a chromosome is spread over tasks like anything else.
    """
    if flank < 0:
        return obs.withColumn("clean", F.lit(True))
    wrong = F.coalesce(F.col(error).cast("boolean"), F.lit(False))
    rows = with_halo(obs, pos, flank, max(width, 4 * flank), wrong)
    near = Window.partitionBy(*read, "bin_").orderBy(pos).rangeBetween(-flank, flank)
    rows = rows.withColumn("none_", F.max(wrong.cast("int")).over(near) == 0).where("own_")
    spans = obs.groupBy(*read).agg(F.min(pos).alias("low_"), F.max(pos).alias("high_"))
    inside = (F.col(pos) - flank >= F.col("low_")) & (F.col(pos) + flank <= F.col("high_"))
    return rows.join(spans, read).withColumn("clean", F.col("none_") & inside).select(*obs.columns, "clean")


def call_totals(calls: DataFrame, by: list[str] = ["sample", "chrom", "pos", "strand"], min_cov: int = 1) -> DataFrame:
    """Coverage, called share and mean z by position; ``calls`` has z and called."""
    out = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("cov"), F.count_if("called").alias("n_mod"), F.avg("z").alias("mean_z"), F.avg(F.abs("z")).alias("mean_absz"))
    return out.where(F.col("cov") >= min_cov).withColumn("frac", F.col("n_mod") / F.col("cov"))


def called(statistic: Column, cutoff: Column) -> Column:
    return statistic > cutoff


def null_histogram(rows: DataFrame, statistic: str, by: list[str] = []) -> DataFrame:
    """Counts of a statistic's bins, the last for all beyond; histograms add up."""
    bin_ = F.least(F.floor(F.col(statistic) / BIN), F.lit(BINS)).cast("long").alias("bin")
    return rows.where(F.col(statistic).isNotNull()).groupBy(*by, bin_).agg(F.count(F.lit(1)).alias("count"))


def pooled(*histograms: DataFrame) -> DataFrame:
    out = histograms[0]
    for h in histograms[1:]:
        out = out.unionByName(h)
    return out.groupBy("bin").agg(F.sum("count").alias("count"))


def cutoff(histogram: DataFrame, fpr: float) -> DataFrame:
    """One row: the lowest bin edge with at most a share ``fpr`` of the null at or above it; infinite without a null.

    On sparse bins that is the edge behind the last bin whose tail is larger. At most 10,001 rows.
    """
    tail = F.sum("count").over(Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("count").over(Window.partitionBy())
    rows = histogram.withColumn("tail", tail).withColumn("total", total)
    last = rows.agg(F.max(F.when(F.col("tail") > fpr * F.col("total"), F.col("bin"))).alias("bin"), F.count(F.lit(1)).alias("n"))
    edge = (F.coalesce(F.col("bin") + 1, F.lit(0)) * BIN).cast("double")
    return last.select(F.when(F.col("n") == 0, F.lit(float("inf"))).otherwise(edge).alias("cutoff"))
