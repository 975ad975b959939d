"""Running sums over a long axis without one task per chromosome."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored


def running_sum(rows: DataFrame, by: list[str], pos: str, value: str, *, width: int = 1 << 16, name: str = "running") -> DataFrame:
    """Sum of ``value`` up to and including each row, by ``pos`` within ``by``.

    Sums of bins of ``width`` positions are run up first (a row for each bin), then rows within a bin.
    """
    binned = rows.withColumn("bin_", F.floor(F.col(pos) / width))
    whole = binned.groupBy(*by, "bin_").agg(F.sum(value).alias("bin_sum_"))
    before = Window.partitionBy(*by).orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("before_", F.coalesce(F.sum("bin_sum_").over(before), F.lit(0))).drop("bin_sum_")
    within = Window.partitionBy(*by, "bin_").orderBy(pos).rangeBetween(Window.unboundedPreceding, 0)
    inside = binned.withColumn("inside_", F.sum(value).over(within))
    return inside.join(whole, [*by, "bin_"]).withColumn(name, F.col("before_") + F.col("inside_")).drop("bin_", "before_", "inside_")


def places(rows: DataFrame, by: list[str], order: list[str], *, width: int = 1 << 16, name: str = "place") -> DataFrame:
    """The place of each row within ``by`` in the order of ``order``, from 1; the first of ``order`` is a position.

    Rows are numbered within bins of ``width`` positions, and a bin starts behind the rows of those before it.
    """
    binned = rows.withColumn("bin_", F.floor(F.col(order[0]) / width))
    whole = binned.groupBy(*by, "bin_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(*by).orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)  # a row per bin
    whole = whole.withColumn("before_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_")
    inside = binned.withColumn("inside_", F.row_number().over(Window.partitionBy(*by, "bin_").orderBy(*order)))
    return inside.join(whole, [*by, "bin_"]).withColumn(name, F.col("before_") + F.col("inside_")).drop("bin_", "before_", "inside_")


def with_halo(rows: DataFrame, pos: str, reach: int, width: int, halo: Column | None = None) -> DataFrame:
    """Rows dealt to bins of ``width`` positions (bin_), and again, with own_ false, to each other bin of which a position is
    within ``reach``: a window of positions around a row lies whole in the row's own bin. ``halo`` tells which rows others need."""
    own = F.floor(F.col(pos) / width)
    every = F.sequence(F.floor((F.col(pos) - reach) / width), F.floor((F.col(pos) + reach) / width))
    needed = every if halo is None else F.when(halo, every).otherwise(F.array(own))
    return rows.withColumn("bin_", F.explode(needed)).withColumn("own_", F.col("bin_") == own)


def range_sums(ranges: DataFrame, track: DataFrame, values: list[str], by: list[str], *, width: int = 1 << 12) -> DataFrame:
    """Sums over ranges of positions (chrom, low, high, inclusive) of each of the tracks that ``by`` tells apart: the columns
    of ``ranges``, ``by``, n (rows in the range, at least 1), and for each value v its sum sum_v and its number of values n_v.

    A range is the difference of running sums at its two edges. Edges stand among a bin's rows, each once for all ranges
    that share it, and take the bin's sum up to there; sums of whole bins are run up apart. So a range costs two rows for
    each track, whatever its length, and nothing is exploded to positions.
    """
    measures = {"n_": F.lit(1), **{f"s_{v}": F.coalesce(F.col(v).cast("double"), F.lit(0.0)) for v in values}, **{f"c_{v}": F.col(v).isNotNull().cast("long") for v in values}}
    rows = track.select("chrom", *by, "pos", *(c.alias(m) for m, c in measures.items()), F.lit(False).alias("edge_"))
    tracks = track.select("chrom", *by).distinct()  # as few as there are tracks and contigs
    edges = ranges.select("chrom", F.explode(F.array(F.col("low") - 1, F.col("high"))).alias("pos")).distinct().join(F.broadcast(tracks), "chrom")
    empty = edges.select("chrom", *by, F.col("pos").cast(track.schema["pos"].dataType), *(F.lit(0).alias(m) for m in measures), F.lit(True).alias("edge_"))
    both = rows.unionByName(empty).withColumn("bin_", F.floor(F.col("pos") / width))
    upto = Window.partitionBy("chrom", *by, "bin_").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    inside = both.withColumns({m: F.sum(m).over(upto) for m in measures}).where("edge_").drop("edge_")
    whole = both.groupBy("chrom", *by, "bin_").agg(*(F.sum(m).alias(m) for m in measures))
    before = Window.partitionBy("chrom", *by).orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)  # a row per bin
    whole = whole.select("chrom", *by, "bin_", *(F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}before") for m in measures))
    known = inside.join(whole, ["chrom", *by, "bin_"]).drop("bin_")
    side = lambda end, edge: known.select("chrom", *by, F.col("pos").alias(edge), *(F.struct(m, f"{m}before").alias(f"{m}{end}") for m in measures))
    # ranges are made from fewer rows, by whose size Spark would take them for small enough to be sent whole to every executor
    met = ranges.withColumn("edge_", F.col("low") - 1).hint("merge").join(side("low", "edge_"), ["chrom", "edge_"]).drop("edge_").join(side("high", "high").hint("merge"), ["chrom", *by, "high"])
    # within a bin the whole bins' sums cancel exactly
    between = lambda m: (F.col(f"{m}high.{m}before") - F.col(f"{m}low.{m}before")) + (F.col(f"{m}high.{m}") - F.col(f"{m}low.{m}"))
    out = met.select(*ranges.columns, *by, between("n_").alias("n"), *(between(f"s_{v}").alias(f"sum_{v}") for v in values), *(between(f"c_{v}").alias(f"n_{v}") for v in values))
    return out.where("n > 0")


def ordered_sum(rows: DataFrame, by: list[str], order: str, value: str, *, name: str = "running") -> DataFrame:
    """Sum of ``value`` up to and including each row, by ``order`` of any type within ``by``.

    Rows are dealt by ranges of (by, order) and written, so that ranges stay as they are; sums of
    ranges are run up first, then rows within a range: no group is one task.
    """
    dealt = stored(rows.repartitionByRange(*by, order).withColumn("part_", F.spark_partition_id()))
    whole = dealt.groupBy(*by, "part_").agg(F.sum(value).alias("part_sum_"))
    before = Window.partitionBy(*by).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("before_", F.coalesce(F.sum("part_sum_").over(before), F.lit(0))).drop("part_sum_")
    within = Window.partitionBy(*by, "part_").orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    inside = dealt.withColumn("inside_", F.sum(value).over(within))
    return inside.join(whole, [*by, "part_"]).withColumn(name, F.col("before_") + F.col("inside_")).drop("part_", "before_", "inside_")


def group_quantiles(rows: DataFrame, by: list[str], value: str, levels: Mapping[str, float], weight: str | None = None, *, cells: int = 1 << 12) -> DataFrame:
    """Exact quantiles with linear interpolation by group, a column for each of ``levels``; nulls do not count.
    A row stands for ``weight`` equal ones; rows that have one are read several times.

    Each group's span is cut into ``cells`` of equal width, and their counts tell in which cells the wanted ranks lie. Only
    these cells' values are put in order, by ranges, so neither a group's values nor its value counts meet in one task,
    as they do in ``percentile``, and most values are counted only. Cells keep the order of values, so any spread is exact.
    """
    x = F.col(value).cast("double").alias("x_")
    kept = rows.where(F.col(value).isNotNull())
    counts = kept.select(*by, x, F.col(weight).alias("w_")) if weight else stored(kept.groupBy(*by, x).agg(F.count(F.lit(1)).alias("w_")))
    span = counts.groupBy(*by).agg(F.min("x_").alias("least_"), F.max("x_").alias("most_"))  # a row per group
    width = F.col("most_") - F.col("least_")
    cell = F.least(F.floor((F.col("x_") - F.col("least_")) / width * cells), F.lit(cells - 1))
    # a span that is empty or not finite is one cell
    dealt = counts.join(span, by).withColumn("cell_", F.when((width > 0) & (width < float("inf")), cell).otherwise(0).cast("int")).drop("least_", "most_")
    group, within = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("cell_")  # at most a row per cell
    held = dealt.groupBy(*by, "cell_").agg(F.sum("w_").alias("n_"))
    held = held.withColumns({"all_": F.sum("n_").over(group), "below_": F.sum("n_").over(within) - F.col("n_")})
    h = {k: (F.col("all_") - 1) * F.lit(float(q)) for k, q in levels.items()}
    has = lambda rank: (F.col("below_") <= rank) & (rank < F.col("below_") + F.col("n_"))
    wanted = stored(held.where(reduce(or_, (has(f(r)) for r in h.values() for f in (F.floor, F.ceil)))).drop("n_"))
    few = dealt.join(wanted, [*by, "cell_"]).groupBy(*by, "cell_", "all_", "below_", "x_").agg(F.sum("w_").alias("w_"))
    upto = ordered_sum(few, [*by, "cell_"], "x_", "w_", name="upto_").withColumn("upto_", F.col("below_") + F.col("upto_"))
    least = lambda k: F.min(F.when(F.col("upto_") > k, F.col("x_")))
    ends = [least(f(h[k])).alias(f"{s}_{k}") for k in levels for s, f in (("low", F.floor), ("high", F.ceil))]
    found = upto.groupBy(*by, "all_").agg(*ends)
    share = lambda k: h[k] - F.floor(h[k])
    # between two equal values it is that value to the last digit, so that what ties with it still does
    at = lambda k: F.when(F.col(f"low_{k}") == F.col(f"high_{k}"), F.col(f"low_{k}")).otherwise(F.col(f"low_{k}") + share(k) * (F.col(f"high_{k}") - F.col(f"low_{k}")))
    return found.select(*by, *(at(k).alias(k) for k in levels))


def coverage_runs(intervals: DataFrame, by: list[str] = ["chrom"], *, width: int = 1 << 16) -> DataFrame:
    """Maximal intervals of equal depth above 0 of half-open intervals (by, start, end)."""
    edges = intervals.select(*by, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("step")))).alias("e"))
    # an edge that others cancel does not change the depth, so neighbours of equal depth merge by themselves
    steps = edges.select(*by, "e.*").groupBy(*by, "at").agg(F.sum("step").alias("step")).where("step <> 0")
    depth = running_sum(steps, by, "at", "step", width=width, name="depth")
    binned = depth.withColumn("bin_", F.floor(F.col("at") / width))
    heads = binned.groupBy(*by, "bin_").agg(F.min("at").alias("head_"))
    heads = heads.withColumn("next_", F.lead("head_").over(Window.partitionBy(*by).orderBy("bin_"))).drop("head_")
    inside = binned.withColumn("end", F.lead("at").over(Window.partitionBy(*by, "bin_").orderBy("at")))
    runs = inside.join(heads, [*by, "bin_"]).withColumn("end", F.coalesce("end", "next_"))
    return runs.where("depth > 0").select(*by, F.col("at").alias("start"), "end", "depth")
