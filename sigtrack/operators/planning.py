"""Sizing of runs from earlier ones' benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK, MIN_HOURS, MAX_HOURS = 1.2, 1, 336


def seconds(text: Column) -> Column:
    """Seconds of a text like ``1h 2m 3.5s``; null for a dash."""
    part = lambda unit: F.coalesce(F.regexp_extract(text, rf"([0-9.]+)\s*{unit}\b", 1).try_cast("double"), F.lit(0.0))
    return F.when(F.trim(text).rlike("[0-9]"), 3600 * part("h") + 60 * part("m") + part("s"))


def megabytes(text: Column) -> Column:
    return F.regexp_extract(text, r"([0-9]+)\s*MB", 1).try_cast("long")


def estimate(jobs: DataFrame, history: DataFrame, cores: int) -> DataFrame:
    """One row: hours and memory of jobs (rule, count) by the larger average of two earlier runs.

    ``history`` has rule, avg_1, avg_2 (seconds) and rss_mb. Unknown rules count 0.
    """
    known = history.select("rule", F.greatest(F.coalesce("avg_1", F.lit(0.0)), F.coalesce("avg_2", F.lit(0.0))).alias("avg_s"), "rss_mb")
    rows = jobs.join(known, "rule", "left")
    work = F.coalesce(F.sum(F.col("count") * F.coalesce("avg_s", F.lit(0.0))), F.lit(0.0))
    hours = F.greatest(F.lit(MIN_HOURS), F.least(F.lit(MAX_HOURS), F.ceil(work / cores * SLACK / 3600))).cast("long")
    return rows.agg(work.alias("work_s"), hours.alias("hours"), F.max("rss_mb").alias("rss_mb"), F.max_by("rule", F.struct("rss_mb", "rule")).alias("rss_rule"))
