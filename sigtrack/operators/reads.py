"""Reads as arrays and as rows, alignments walked to positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Alignment operations by number, M I D N S H P = X.
CIGAR_OPS = "MIDNSHP=X"
_ON_READ, _ON_REF = (0, 1, 4, 7, 8), (0, 2, 3, 7, 8)


def nested(obs: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """One row for each read with its observations in order of position."""
    return obs.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("obs"))


def exploded(reads: DataFrame, by: list[str]) -> DataFrame:
    return reads.select(*by, F.inline("obs"))


def _steps(cigar: Column) -> Column:
    """Operations with the read's and the reference's offset before each."""
    start = F.struct(F.array().cast("array<struct<op:int,len:int,q:int,r:int>>").alias("all"), F.lit(0).alias("q"), F.lit(0).alias("r"))

    def step(acc: Column, c: Column) -> Column:
        q, r = acc["q"], acc["r"]
        item = F.struct(c["op"].alias("op"), c["len"].alias("len"), q.alias("q"), r.alias("r"))
        on = lambda kinds: F.when(c["op"].isin(*kinds), c["len"]).otherwise(0)
        return F.struct(F.concat(acc["all"], F.array(item)).alias("all"), (q + on(_ON_READ)).alias("q"), (r + on(_ON_REF)).alias("r"))

    return F.aggregate(cigar, start, step)["all"]


def aligned_bases(alignments: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, pos 1-based, base, qual) of every aligned base, or base ``*`` for a deleted one.

    ``alignments`` has start (0-based), cigar (array of op number and length), seq and qual.
    """
    walk = alignments.select(*keep, "start", "seq", "qual", F.explode(_steps(F.col("cigar"))).alias("s")).where(F.col("s.op").isin(0, 2, 7, 8) & (F.col("s.len") > 0))
    each = walk.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("s.len") - 1)))
    at = (F.col("s.q") + F.col("k") + 1).cast("int")
    gone = F.col("s.op") == 2
    one = lambda c: F.substring(F.col(c), at, F.lit(1))
    return each.select(*keep, (F.col("start") + F.col("s.r") + F.col("k") + 1).cast("long").alias("pos"), F.when(gone, "*").otherwise(one("seq")).alias("base"), F.when(~gone, one("qual")).alias("qual"))


def pileup_errors(alignments: DataFrame, keep: list[str]) -> DataFrame:
    """Error probability of each aligned base: the observations that per-position statistics take."""
    bases = aligned_bases(alignments, keep)
    return bases.where(F.col("qual").isNotNull()).withColumn("error", F.pow(F.lit(10.0), -(F.ascii("qual") - 33) / 10.0))


def error_mask(alignments: DataFrame, reference: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, pos, is_error) over each read's reference span: mismatches, deletions, and both sides of an insertion."""
    bases = aligned_bases(alignments, keep).join(reference.select("chrom", "pos", F.upper("nt").alias("nt")), ["chrom", "pos"], "left")
    wrong = bases.select(*keep, "pos", ((F.col("base") == "*") | ~F.col("nt").eqNullSafe(F.upper("base"))).alias("is_error"))
    walk = alignments.select(*keep, "start", F.explode(_steps(F.col("cigar"))).alias("s"))
    sides = walk.where("s.op = 1").select(*keep, F.explode(F.array(F.col("start") + F.col("s.r"), F.col("start") + F.col("s.r") + 1)).alias("pos"), F.lit(True).alias("is_error"))
    skipped = walk.where("s.op = 3 and s.len > 0").select(*keep, F.explode(F.sequence(F.col("start") + F.col("s.r") + 1, F.col("start") + F.col("s.r") + F.col("s.len"))).alias("pos"), F.lit(True).alias("is_error"))
    span = wrong.unionByName(skipped)
    inside = sides.join(span.select(*keep, "pos").distinct(), [*keep, "pos"], "left_semi")
    return span.unionByName(inside).groupBy(*keep, "pos").agg(F.bool_or("is_error").alias("is_error"))


def tags_present(alignments: DataFrame, tags: list[str], first: int = 5000) -> dict[str, bool]:
    """Which tags any of the first records has: a look at ``first`` records, not at the table."""
    seen = alignments.limit(first).agg(*(F.coalesce(F.bool_or(F.map_contains_key("tags", t)), F.lit(False)).alias(t) for t in tags)).first()
    return {t: seen[t] for t in tags}


def kept_tags(alignments: DataFrame, tags: list[str]) -> DataFrame:
    return alignments.withColumn("tags", F.map_filter("tags", lambda k, _: k.isin(*tags)))


def with_signal(reads: DataFrame, signal: DataFrame) -> DataFrame:
    """Reads with the raw record of their parent, or else of their own name; has_signal tells those without."""
    key = F.coalesce(F.col("tags")["pi"], F.col("read_id"))
    found = signal.withColumnRenamed("read_id", "signal_id").withColumn("has_signal", F.lit(True))
    return reads.withColumn("signal_id", key).join(found, "signal_id", "left").fillna({"has_signal": False})


def still_to_do(parts: DataFrame, done: DataFrame, key: str = "part") -> DataFrame:
    return parts.join(done.select(key), key, "left_anti")


def merged(*tables: DataFrame | None) -> DataFrame:
    """Union by name; missing tables (None) are skipped."""
    found = [t for t in tables if t is not None]
    if not found:
        raise ValueError("nothing to merge")
    out = found[0]
    for t in found[1:]:
        out = out.unionByName(t)
    return out
