"""Fixed windows along a chromosome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def spine(genome: DataFrame, width: int) -> DataFrame:
    """Windows of each chromosome (chrom, size), the last one clipped; 0-based, half-open."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size").cast("long") - 1, F.lit(width).cast("long")))
    return genome.where("size > 0").select("chrom", "size", starts.alias("start")).select("chrom", "start", F.least(F.col("start") + width, F.col("size")).cast("long").alias("end"))


def window_start(pos: Column, width: int) -> Column:
    """Start of the window that a 1-based position is in."""
    return (F.floor((pos - 1) / width) * width).cast("long")


def _by_window(track: DataFrame, genome: DataFrame, width: int, aggs: list[Column], fill: dict, by: list[str], universe: DataFrame) -> DataFrame:
    # only chromosomes of the input; positions are aggregated before they meet the spine
    present = universe.select("chrom", *by).distinct()
    grid = spine(genome, width).join(present, "chrom")
    sums = track.groupBy("chrom", *by, window_start(F.col("pos"), width).alias("start")).agg(*aggs)
    return grid.join(sums, ["chrom", *by, "start"], "left").fillna(fill)


def density(significant: DataFrame, genome: DataFrame, width: int, *, by: list[str] = ["strand"], universe: DataFrame | None = None) -> DataFrame:
    """Number and sum of significant positions by window, 0 where there is none."""
    aggs = [F.count(F.lit(1)).alias("count"), F.sum("reactivity").alias("sum")]
    return _by_window(significant, genome, width, aggs, {"count": 0, "sum": 0.0}, by, significant if universe is None else universe)


def window_mean(scored: DataFrame, genome: DataFrame, width: int, *, by: list[str] = ["strand"]) -> DataFrame:
    """Mean of all scored positions by window; an empty window has mean 0 and n 0."""
    aggs = [F.avg("reactivity").alias("mean"), F.count(F.lit(1)).alias("n")]
    return _by_window(scored, genome, width, aggs, {"mean": 0.0, "n": 0}, by, scored)


def gap_filled(track: DataFrame, genome: DataFrame, by: list[str] = [], width: int = 1 << 16) -> DataFrame:
    """Every position of each chromosome (and of each combination ``by`` that the track has there), null where
    the track has no row. Chromosomes unfold by cells of ``width`` positions, so none is one array."""
    spans = genome.where("size > 0").select("chrom", F.col("size").cast("long").alias("size_"))
    if by:
        spans = spans.join(track.select("chrom", *by).distinct(), "chrom")
    # the cells are spread over the tasks before they unfold
    cells = spans.withColumn("cell_", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size_") - 1) / width)))).repartition("chrom", *by, "cell_")
    last = F.least(F.col("size_"), (F.col("cell_") + 1) * width)
    every = cells.select("chrom", *by, F.explode(F.sequence(F.col("cell_") * width + 1, last)).alias("pos"))
    return every.join(track, ["chrom", *by, "pos"], "left")


def restricted(genome: DataFrame, track: DataFrame) -> DataFrame:
    """The chromosomes that a track has."""
    return genome.join(track.select("chrom").distinct(), "chrom", "left_semi")


def genome_order(rows: DataFrame, genome: DataFrame, *then: str) -> DataFrame:
    """Rows in the order of the genome's contigs."""
    return rows.join(genome.select("chrom", "rank"), "chrom").orderBy("rank", *then).drop("rank")


def zoom_levels(track: DataFrame, value: str, by: list[str], base: int = 1024, factor: int = 4, levels: int = 4) -> DataFrame:
    """A track at several resolutions, as browsers of genomes keep it: (by, level, start, n, least, largest, total, squares) of
    the positions of windows of base * factor^level; each level is made from the one below, so positions are read once."""
    start = lambda pos, width: (F.floor(pos / width) * width).cast("long").alias("start")
    x = F.col(value)
    rows = track.where(x.isNotNull()).groupBy(*by, start(F.col("pos") - 1, base))
    level = stored(rows.agg(F.count(x).alias("n"), F.min(x).alias("least"), F.max(x).alias("largest"), F.sum(x).alias("total"), F.sum(x * x).alias("squares")))
    out = level.withColumn("level", F.lit(0))
    for k in range(1, levels):
        sums = F.sum("n").alias("n"), F.min("least").alias("least"), F.max("largest").alias("largest"), F.sum("total").alias("total"), F.sum("squares").alias("squares")
        level = stored(level.groupBy(*by, start(F.col("start"), base * factor**k)).agg(*sums))
        out = out.unionByName(level.withColumn("level", F.lit(k)))
    return out.select(*by, "level", "start", "n", "least", "largest", "total", "squares")
