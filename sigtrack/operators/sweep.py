"""Parameter sweeps: units of work, and a table of results for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import group_quantiles

def model_sets(relationships: DataFrame, pools: DataFrame, available: DataFrame) -> DataFrame:
    """(relationship, model_set): the matched control, and each pool that has it, if all members are available.

    ``pools`` has pool and members (array), ``available`` sample.
    """
    members = pools.select("pool", F.size("members").alias("n"), F.explode("members").alias("sample"))
    known = members.join(available.select("sample").distinct().withColumn("have", F.lit(True)), "sample", "left")
    whole = known.groupBy("pool").agg(F.every(F.coalesce("have", F.lit(False))).alias("all_have"), F.collect_set("sample").alias("names")).where("all_have")
    control = whole.select("pool", F.explode("names").alias("control"))
    matched = relationships.join(available.select(F.col("sample").alias("control")).distinct(), "control", "left_semi").select("relationship", F.lit("matched").alias("model_set"))
    return matched.unionByName(relationships.join(control, "control").select("relationship", F.col("pool").alias("model_set"))).distinct()


def units(parameters: DataFrame, genomes: DataFrame, relationships: DataFrame, sets: DataFrame) -> DataFrame:
    """Every parameter set for every genome, relationship, model set and strand: tables of a few rows each."""
    strands = genomes.sparkSession.createDataFrame([("for",), ("rev",)], "strand string")
    own = relationships.join(sets, "relationship")
    return parameters.crossJoin(genomes).crossJoin(own).crossJoin(strands)


def unit_join(treatment: DataFrame, control: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides' cov and frac by unit and position; reactivity where both have a row."""
    side = lambda df, s: df.select(*keys, *(F.col(c).alias(f"{c}_{s}") for c in ("cov", "frac")), F.col("nt").alias(f"nt_{s}"))
    both = side(treatment, "t").join(side(control, "c"), keys, "full_outer")
    return both.withColumn("nt", F.coalesce("nt_t", "nt_c")).withColumn("reactivity", F.col("frac_t") - F.col("frac_c")).drop("nt_t", "nt_c")


def unit_summary(joined: DataFrame, by: list[str], min_cov: int) -> DataFrame:
    """Numbers of each unit and contig over positions that both sides cover.

    The background, mean frac_c, joins back for the count of reactive positions: a row per unit and contig.
    ``joined`` is read four times: store it.
    """
    rows = joined.where((F.col("cov_t") >= min_cov) & (F.col("cov_c") >= min_cov))
    t = F.col("nt") == "T"
    # ties of the largest go to the first position
    best = F.max_by(F.struct("pos", "nt"), F.struct(F.col("reactivity"), -F.col("pos")))
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("frac_c").alias("background"), F.avg("frac_t").alias("mean_frac_t"),
        F.avg("reactivity").alias("mean_reactivity"), F.max("reactivity").alias("max_reactivity"), best.alias("best"), F.avg(F.when(t, F.col("reactivity"))).alias("mean_t"), F.avg(F.when(~t, F.col("reactivity"))).alias("mean_not_t"),
        F.count_if(t).alias("n_t"), F.stddev_samp("reactivity").alias("sd"),
    )
    # both sides' coverages in one column, so one order of values serves both medians
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"cov_{s}").alias("cov")) for s in ("t", "c"))))
    middle = group_quantiles(rows.select(*by, sides.alias("s")).select(*by, "s.*"), [*by, "side"], "cov", {"median": 0.5})
    of = lambda s: F.max(F.when(F.col("side") == s, F.col("median"))).alias(f"median_cov_{s}")
    out = out.join(middle.groupBy(*by).agg(of("t"), of("c")), by)
    reactive = rows.join(out.select(*by, "background"), by).groupBy(*by).agg(F.count_if(F.col("reactivity") > 3 * F.col("background")).alias("n_reactive"))
    every = joined.select(*by).distinct()
    out = every.join(out, by, "left").join(reactive, by, "left")
    return out.select(*by, F.coalesce("n", F.lit(0)).alias("n"), *(c for c in out.columns if c not in (*by, "n", "best", "n_t", "n_reactive")), F.col("best.pos").alias("max_pos"), F.col("best.nt").alias("max_nt"), "n_t", "n_reactive")
