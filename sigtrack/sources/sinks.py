"""Writers of tracks and tables. Values keep full precision until here, where text gets its fixed formats."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text(column: str, digits: int | None) -> Column:
    """Fixed decimals; a null is NA."""
    value = F.col(column).cast("string") if digits is None else F.format_string(f"%.{digits}f", column)
    return F.when(F.col(column).isNull(), "NA").otherwise(value).alias(column)


def general(column: str, digits: int) -> Column:
    """Significant digits without trailing zeros, as C's %g writes them; a null is NA."""
    full = F.format_string(f"%.{digits}g", F.col(column))
    short = F.regexp_replace(F.regexp_replace(full, r"(\.[0-9]*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")
    return F.when(F.col(column).isNull(), "NA").when(F.col(column) == 0, "0").otherwise(short).alias(column)


def write_track(track: DataFrame, path: str, *, digits: int = 6, partition_by: tuple[str, ...] = (), short: tuple[str, ...] = ()) -> None:
    """Compressed text without a header, sorted by position within each chromosome's files.

    ``partition_by`` splits by columns, as by chrom or sample; stale partitions are replaced.
    Columns of ``short`` have six significant digits instead of fixed decimals.
    """
    kinds = dict(track.dtypes)
    order = [c for c in (*partition_by, "chrom", "pos", "start") if c in kinds]
    rows = track.repartitionByRange(*order).sortWithinPartitions(*order) if order else track
    out = rows.select(*(F.col(c) if c in partition_by else general(c, 6) if c in short else text(c, digits if kinds[c] == "double" else None) for c in track.columns))
    w = out.write.mode("overwrite").options(sep="\t", quote="", escapeQuotes=False, emptyValue="")
    (w.partitionBy(*partition_by) if partition_by else w).csv(path, compression="gzip")


def with_header(rows: DataFrame, meta: Mapping[str, object], columns: list[str]) -> DataFrame:
    """Lines of a file with ``#key=value`` lines first; ``place`` orders them."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(f"#{k}={v}",) for k, v in meta.items()] or [("#",)], "value string").where("value <> '#'").withColumn("place", F.lit(0))
    body = rows.select(F.concat_ws("\t", *columns).alias("value")).withColumn("place", F.lit(1))
    return head.unionByName(body)


def write_bedgraph(bedgraph: DataFrame, thresholds: Mapping[str, float], path: str, digits: int = 6) -> None:
    """Intervals below comment lines with the thresholds. The file is one, as its readers expect: for a
    chromosome and strand, not for a whole study, which stays a table."""
    rows = bedgraph.orderBy("chrom", "start").select("chrom", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"), text("value", digits))
    lines = with_header(rows, {k: f"{v:.7g}" for k, v in thresholds.items()}, ["chrom", "start", "end", "value"])
    lines.coalesce(1).select("value").write.mode("overwrite").text(path)


def write_model(model: DataFrame, meta: Mapping[str, object], path: str) -> None:
    """A k-mer model: at most 4^k rows, one file."""
    rows = model.orderBy("kmer").select("kmer", *(text(c, None) for c in ("n", "n_outlier")), *(text(c, 6) for c in ("mean", "sd", "median", "mad")))
    with_header(rows, meta, rows.columns).coalesce(1).select("value").write.mode("overwrite").text(path)


def write_histogram(histogram: DataFrame, meta: Mapping[str, object], path: str) -> None:
    """Bins with counts by their lower edge."""
    rows = histogram.where("count > 0").orderBy("bin").select(F.format_string("%.2f", F.col("bin") * 0.01).alias("bin_lower"), F.col("count").cast("string").alias("count"))
    with_header(rows, meta, rows.columns).coalesce(1).select("value").write.mode("overwrite").text(path)


def write_per_read(rows: DataFrame, path: str) -> None:
    """Long tables of observations: positions of a read follow each other in one file."""
    kinds = dict(rows.dtypes)
    columns = [general(c, 4) if c == "p" else text(c, 4 if kinds[c] == "double" else None) for c in rows.columns]
    rows.repartition("read_id").sortWithinPartitions("read_id", "pos").select(*columns).write.mode("overwrite").options(sep="\t", quote="", header=True).csv(path, compression="gzip")


def write_summary(rows: DataFrame, path: str) -> None:
    """A small table with a header, one file."""
    rows.coalesce(1).write.mode("overwrite").options(header=True).csv(path)


def write_stats(summary: DataFrame, histograms: DataFrame, path: str) -> None:
    """Statistics of samples as text, a folder for each sample: ``SN`` lines of ``summary`` (sample, numbers) and lines of
    ``histograms`` (sample, var, value, count). Insertions and deletions have lines of their own, ``INS`` and ``DEL``."""
    names = [c for c in summary.columns if c != "sample"]
    number = F.explode(F.array(*(F.concat(F.lit(f"SN\t{c}:\t"), F.coalesce(F.col(c).cast("string"), F.lit("NA"))) for c in names)))
    lines = summary.select("sample", F.lit(0).alias("part"), number.alias("value"))
    more = histograms.select("sample", F.lit(1).alias("part"), F.concat_ws("\t", "var", F.col("value").cast("string"), F.col("count").cast("string")).alias("value"))
    both = lines.unionByName(more)
    both.repartition("sample").sortWithinPartitions("sample", "part", "value").select("sample", "value").write.mode("overwrite").partitionBy("sample").text(path)


def write_flagstat(counts: DataFrame, path: str) -> None:
    """Flag counts as text, a folder for each sample: ``n + failed class``."""
    names = [c for c in counts.columns if c not in ("sample", "qc_fail")]
    line = F.explode(F.array(*(F.concat(F.col(c).cast("string"), F.lit(f" + 0 {c.replace('_', ' ')}")) for c in names)))
    counts.select("sample", line.alias("value")).repartition("sample").write.mode("overwrite").partitionBy("sample").text(path)


_POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """The JVM's path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointed(spark: SparkSession, path: str) -> str | None:
    pointer, system = _hadoop(spark, f"{path}/{_POINTER}")
    if not system.exists(pointer):
        return None
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(system.open(pointer)))
    try:
        return reader.readLine()
    finally:
        reader.close()


class NoSpace(OSError):
    pass


def publish(rows: DataFrame, path: str, *, expected: int | None = None, need_bytes: int = 0, keep: int = 1) -> int:
    """A new version of a table. Readers (``published``) see the version before until all of the new one is in place.

    First ``need_bytes`` must be free where it goes, else nothing is written. Rows go to a folder of
    their own; when their number is right, a pointer with its name is written beside the old one
    and moved over it, which is one step for the file system. A failure anywhere before leaves the
    old version as it was, and its folder: versions older than the last ``keep`` go only after the move.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    target, system = _hadoop(spark, path)
    system.mkdirs(target)
    if (free := system.getStatus(target).getRemaining()) < need_bytes:
        raise NoSpace(f"{path}: {need_bytes} bytes are needed, {free} are free")
    before, name = _pointed(spark, path), f"_v{uuid.uuid4().hex}"
    staged, _ = _hadoop(spark, f"{path}/{name}")
    rows.write.parquet(str(staged))
    n = spark.read.schema(rows.schema).parquet(str(staged)).count()
    if expected is not None and n != expected:
        system.delete(staged, True)
        raise ValueError(f"{n} rows were written, {expected} expected")
    _point(spark, path, name)
    others = [s.getPath() for s in system.listStatus(target) if s.isDirectory() and s.getPath().getName().startswith("_v")]
    old = sorted((p for p in others if p.getName() not in (name, before if keep else "")), key=lambda p: p.getName())
    for p in old:
        system.delete(p, True)
    return n


def _point(spark: SparkSession, path: str, name: str) -> None:
    """Moves a new pointer over the old one."""
    jvm = spark._jvm
    pointer, system = _hadoop(spark, f"{path}/{_POINTER}")
    fresh, _ = _hadoop(spark, f"{path}/{_POINTER}.{name}")
    out = system.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.makeQualified(pointer).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, pointer, options)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The version that the pointer names. A reader that has it goes on with it while the next one is published."""
    name = _pointed(spark, path.rstrip("/"))
    if name is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")


def resumed(spark: SparkSession, paths: list[str]) -> tuple[int, DataFrame] | None:
    """The latest step that has been published, and its rows; None if there is none."""
    for i in range(len(paths) - 1, -1, -1):
        if _pointed(spark, paths[i].rstrip("/")) is not None:
            return i, published(spark, paths[i])
    return None
