"""Per-position statistics of a stream along the genome.

Positions are the time axis. Reads come sorted by start, so a window of positions is complete
once a read starts behind its end; an observation for a window already given out is an error and
never dropped. Each micro-batch aggregates with the batch operators; observations of open
windows wait in a table in the shared folder, and a repeated batch replaces its own output. What a
batch goes on from is found in that folder, so a restarted stream goes on where it stood.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class LateObservation(RuntimeError):
    pass


class PositionStream:
    """Give ``batch`` to ``writeStream.foreachBatch``; after the stream, ``finish`` gives out the rest.

    Rows have ``keys`` (as sample, chrom, strand), pos and read_start. ``stats`` turns
    observations of complete windows into rows. State and output lie below ``root``.
    """

    def __init__(self, root: str, stats: Callable[[DataFrame], DataFrame], keys: list[str], width: int = 10_000):
        self.root, self.stats, self.keys, self.width = root.rstrip("/"), stats, keys, width

    def _last(self, spark: SparkSession, below: int | None = None) -> int | None:
        """The last batch before ``below`` whose marks and open windows are written."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/open")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return None
        done = [s.getPath() for s in fs.listStatus(folder)]
        ids = [int(p.getName()) for p in done if p.getName().isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return max((i for i in ids if below is None or i < below), default=None)

    def _window_end(self) -> Column:
        return (F.floor(F.col("pos") / self.width) + 1) * self.width

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = rows.withColumn("end_", self._window_end())
        last = self._last(spark, batch_id)
        if last is not None:
            # marks: a row for each chromosome and strand
            late = rows.join(spark.read.parquet(f"{self.root}/marks/{last}"), self.keys).where("end_ <= mark_").limit(1).collect()
            if late:
                raise LateObservation(f"position {late[0].pos} came after its window was given out")
        marks = rows.groupBy(*self.keys).agg(F.max("read_start").alias("mark_"))
        held = rows
        if last is not None:
            held = held.unionByName(spark.read.parquet(f"{self.root}/open/{last}"))
            marks = marks.unionByName(spark.read.parquet(f"{self.root}/marks/{last}")).groupBy(*self.keys).agg(F.max("mark_").alias("mark_"))
        marks_path, open_path = f"{self.root}/marks/{batch_id}", f"{self.root}/open/{batch_id}"
        marks.write.mode("overwrite").parquet(marks_path)
        known = held.join(spark.read.parquet(marks_path), self.keys, "left")
        done = F.coalesce(F.col("end_") <= F.col("mark_"), F.lit(False))
        known.where(~done).drop("mark_").write.mode("overwrite").parquet(open_path)
        self.stats(known.where(done).drop("mark_", "end_")).write.mode("overwrite").parquet(f"{self.root}/out/{batch_id}")

    def finish(self, spark) -> DataFrame:
        """The rest given out, and all output."""
        last = self._last(spark)
        if last is not None:
            rest = spark.read.parquet(f"{self.root}/open/{last}")
            self.stats(rest.drop("end_")).write.mode("overwrite").parquet(f"{self.root}/out/rest")
        return spark.read.parquet(f"{self.root}/out/*")


def stream_stats(stream: DataFrame, root: str, stats: Callable[[DataFrame], DataFrame], keys: list[str], width: int = 10_000) -> DataFrame:
    """Runs a stream through to what is there now and returns all statistics."""
    sink = PositionStream(root, stats, keys, width)
    query = stream.writeStream.foreachBatch(sink.batch).option("checkpointLocation", f"{root}/stream").trigger(availableNow=True).start()
    query.awaitTermination()
    return sink.finish(stream.sparkSession)
