"""Levels of bases from the raw samples of a read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def base_levels(reads: DataFrame, *, samples: str = "samples", bounds: str = "bounds", trim: int = 1) -> DataFrame:
    """A row for each base of a read: base (from 0, in the order of the samples), dwell (its number of samples), and level and
    level_sd, mean and population deviation of the samples without ``trim`` at either end of the base.

    ``bounds`` has a base's first sample and, at the end, the number behind the last one, so one
    entry more than there are bases. A base that trimming would leave empty keeps its samples, one
    without samples has null levels. All is array arithmetic within the row: nothing is shuffled.
    """
    number = F.sequence(F.lit(0), F.size(bounds) - 2)
    first, stop = (lambda i: F.get(bounds, i)), (lambda i: F.get(bounds, i + 1))
    each = reads.where(F.size(bounds) > 1).withColumn("base", F.explode(number))
    i = F.col("base")
    dwell = stop(i) - first(i)
    cut = F.when(dwell > 2 * trim, trim).otherwise(0)
    own = F.slice(samples, first(i) + cut + 1, dwell - 2 * cut)
    each = each.withColumn("dwell", dwell.cast("int")).withColumn("own_", own)
    n = F.size("own_")
    mean = F.when(n > 0, F.aggregate("own_", F.lit(0.0), lambda s, x: s + x) / n)
    each = each.withColumn("level", mean)
    squares = F.aggregate("own_", F.lit(0.0), lambda s, x: s + (x - F.col("level")) * (x - F.col("level")))
    return each.withColumn("level_sd", F.when(n > 0, F.sqrt(squares / n))).drop("own_", samples, bounds)


def oriented(levels: DataFrame, *, reverse: str = "reverse", start: str = "start", bases: str = "bases") -> DataFrame:
    """pos (from 0) of each base of ``base_levels``: samples run along the molecule, so bases of a read on the reverse strand
    count from the end of its span of ``bases``."""
    pos = F.when(F.col(reverse), F.col(start) + F.col(bases) - 1 - F.col("base")).otherwise(F.col(start) + F.col("base"))
    return levels.withColumn("pos", pos.cast("long"))
