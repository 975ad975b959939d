"""Demultiplexing by barcode and sample sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNCLASSIFIED, BARCODE = "unclassified", r"(barcode[0-9]+)$"


def barcode_of(read_group: Column) -> Column:
    """The barcode at the end of a read group; null without one."""
    found = F.regexp_extract(read_group, BARCODE, 1)
    return F.when(found != "", found)


def run_of(read_group: Column) -> Column:
    """The run before the first underscore, NA for an empty one."""
    run = F.substring_index(read_group, "_", 1)
    return F.when((read_group == "") | read_group.isNull() | (run == ""), "NA").otherwise(run)


def sample_sheet(sheet: DataFrame) -> DataFrame:
    """barcode and sample, cleaned: repeated lines once, barcodes by their ending."""
    code = F.coalesce(barcode_of(F.trim("barcode")), F.trim("barcode"))
    return sheet.select(code.alias("barcode"), F.trim("sample").alias("sample")).where("barcode <> ''").distinct()


def sheet_faults(sheet: DataFrame) -> DataFrame:
    """(barcode, fault): bad names, the reserved name, a barcode with two samples."""
    name = F.when(F.col("sample") == UNCLASSIFIED, "reserved name").when(~F.col("sample").rlike(r"^[A-Za-z0-9._-]+$"), "bad name").when(~F.col("barcode").rlike(BARCODE), "bad barcode")
    faults = sheet.select("barcode", name.alias("fault")).where("fault is not null")
    twice = sheet.groupBy("barcode").agg(F.count_distinct("sample").alias("n")).where("n > 1").select("barcode", F.lit("two samples").alias("fault"))
    return faults.unionByName(twice)


def assigned(reads: DataFrame, sheet: DataFrame) -> DataFrame:
    """sample of each read; those without a barcode of the sheet are unclassified. The sheet's size lets Spark broadcast it."""
    rows = reads.withColumn("barcode", barcode_of(F.col("read_group"))).withColumn("run_id", run_of(F.col("read_group")))
    return rows.join(sheet, "barcode", "left").withColumn("sample", F.coalesce("sample", F.lit(UNCLASSIFIED)))


def demux_counts(reads: DataFrame) -> DataFrame:
    """Reads and bases of each sample, barcode and run."""
    code = F.coalesce("barcode", F.lit("NA"))
    return reads.groupBy("sample", code.alias("barcode"), "run_id").agg(F.count(F.lit(1)).alias("reads"), F.sum("bases").alias("bases"))


def conservation(inputs: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: reads in, reads counted, and whether they agree."""
    n = inputs.agg(F.count(F.lit(1)).alias("n_in"))
    return n.crossJoin(counts.agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("n_out"))).withColumn("conserved", F.col("n_in") == F.col("n_out"))


def check_conserved(table: DataFrame) -> None:
    row = table.first()
    if not row.conserved:
        raise ValueError(f"{row.n_in} reads came in and {row.n_out} were counted")
