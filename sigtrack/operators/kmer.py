"""K-mer signal models: bounded samples, MAD-trimmed mean and deviation, lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.statistics import MAD_SCALE, z_score
from ..storage import stored
from .running import group_quantiles


def priority(seed: int, *keys: str) -> Column:
    """A random but repeatable order of observations."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)).cast("binary"))


def bounded_sample(obs: DataFrame, key: str, most: int, order: list[Column]) -> DataFrame:
    """The first ``most`` observations of each key in a random order; 0 keeps all.

    Spark limits each task's rows of a key before the shuffle, so a frequent key does not travel whole.
    """
    if not most:
        return obs
    return obs.withColumn("rn_", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rn_") <= most).drop("rn_")


def kmer_model(obs: DataFrame, *, kmer: str = "kmer", level: str = "level", mad: float = 15.0) -> DataFrame:
    """n, n_outlier, mean, sd, median and mad by k-mer; mean and sd leave out what is more than
    ``mad`` deviations off the median.

    Observations are read once, for their counts by k-mer and level; all that follows works on the
    counts, and medians by ranges of values, so no k-mer's levels meet in one buffer.
    """
    rows = obs.where(F.col(kmer).isNotNull() & F.col(level).isNotNull())
    counts = stored(rows.groupBy(F.col(kmer).alias("kmer"), F.col(level).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("w")))
    centre = group_quantiles(counts, ["kmer"], "x", {"median": 0.5}, "w")
    away = stored(counts.join(centre, "kmer").withColumn("d", F.abs(F.col("x") - F.col("median"))))
    spread = group_quantiles(away, ["kmer"], "d", {"mad": 0.5}, "w")
    y, w = F.col("x") - F.col("median"), F.col("w")
    met = away.join(spread, "kmer")
    kept = F.col("d") <= mad * F.col("mad")
    inside = lambda c: F.sum(F.when(kept, c))
    # moments about the median, which is near the mean
    sums = met.groupBy("kmer", "median", "mad").agg(F.sum("w").alias("n_all"), inside(w).alias("n"), inside(w * y).alias("s"), inside(w * y * y).alias("q"))
    mean, n = F.col("s") / F.col("n"), F.col("n")
    sd = F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("q") - F.col("s") * mean) / (n - 1)))
    return sums.select("kmer", "n", (F.col("n_all") - n).alias("n_outlier"), (F.col("median") + mean).alias("mean"), sd.alias("sd"), "median", "mad")


def pooled_model(samples: list[DataFrame], **more) -> DataFrame:
    """One model of the observations of several samples together: means shift and deviations widen."""
    rows = samples[0]
    for s in samples[1:]:
        rows = rows.unionByName(s)
    return kmer_model(rows, **more)


def centre_and_spread(model: DataFrame, scale: str = "sd", min_obs: int = 30) -> DataFrame:
    """The scorable k-mers: enough observations and a spread above 0."""
    if scale not in ("sd", "mad"):
        raise ValueError(f"scale {scale!r} is neither sd nor mad")
    centre, spread = (F.col("mean"), F.col("sd")) if scale == "sd" else (F.col("median"), MAD_SCALE * F.col("mad"))
    return model.where(F.col("n") >= min_obs).select("kmer", centre.alias("centre"), spread.alias("spread")).where("spread > 0")


def scored(obs: DataFrame, model: DataFrame, scale: str = "sd", min_obs: int = 30) -> DataFrame:
    """Observations of scorable k-mers with z."""
    return obs.join(centre_and_spread(model, scale, min_obs), "kmer").withColumn("z", z_score(F.col("level"), F.col("centre"), F.col("spread"))).drop("centre", "spread")


def model_coverage(obs: DataFrame, model: DataFrame, min_obs: int = 30) -> DataFrame:
    """Observations in all, of k-mers the model has, and of those it can score: one row."""
    known = model.select("kmer", F.lit(1).alias("known"), (F.col("n") >= min_obs).alias("enough"))
    found = obs.select("kmer").join(known, "kmer", "left")
    return found.agg(F.count(F.lit(1)).alias("n_obs"), F.count("known").alias("n_known"), F.count_if("enough").alias("n_scorable"))


def check_compatible(model_meta: Mapping[str, str], data_meta: Mapping[str, str], keys: tuple[str, ...] = ("backend", "kmer_len", "kmer_context", "levels")) -> None:
    """A model is used on data of its own kind only."""
    if bad := [k for k in keys if model_meta.get(k) != data_meta.get(k)]:
        raise ValueError("model and data differ in " + ", ".join(f"{k}: {model_meta.get(k)} and {data_meta.get(k)}" for k in bad))


def check_usable(coverage: DataFrame) -> None:
    """No observation's k-mer in the model is an error; known but thinly covered k-mers are not."""
    row = coverage.first()
    if row.n_obs and not row.n_known:
        raise ValueError("the model shares no k-mer with the data")
