"""Per-position statistics of a sorted stream with keyed state in Spark's state store.

Reads come in the order of the genome, over all keys of a stream, so the start of the latest read is
an event time and Spark's watermark follows it. Observations wait in the state of their window (key,
contig, window of positions), packed by Arrow, as Spark hands state on row by row; a timer for each is set to the window's end, and a window leaves the
state when the watermark has passed it: by a later read of its contig or of any later one. A change
of contig therefore finishes what was open before. State, timers and watermark are in the stream's
checkpoint, so a stream that is started again goes on with its open windows. An observation behind the
watermark is an error: Spark leaves its pack out and counts that, and ``run`` does not return with such a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.correlation import genome_offsets
from .positions import LateObservation

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_time(coordinate: Column) -> Column:
    """A place in the genome as an event time: two milliseconds a position, so that a read that starts where the latest one
    did is not behind a watermark one millisecond before it, and none at the watermark that a stream begins with."""
    return F.timestamp_millis(coordinate.cast("long") * 2 + 2)


#: Rows of a stream's task that are dealt to windows at once.
_ROWS = 1 << 17


def _packer(keys: list[str], columns: list[str]) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: a row for each window among a task's next rows, with its observations as an Arrow stream and the
    least coordinate among them, so that one late observation makes it late; and a row without observations at the largest
    coordinate, which moves the watermark as far as the rows themselves would."""
    by = [*keys, "window"]

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        none = np.iinfo("int64").max

        def packs(held: list) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            latest = pc.max(table["coordinate"]).as_py()
            rows = table.filter(pc.is_valid(table["window"]))
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in by])).combine_chunks()
            n = rows.num_rows
            change = np.arange(n) == 0
            for c in by:
                codes = np.asarray(pc.dictionary_encode(rows[c].combine_chunks()).indices)
                change[1:] |= codes[1:] != codes[:-1]
            first = np.flatnonzero(change)
            least = np.minimum.reduceat(np.asarray(pc.fill_null(rows["coordinate"], none)), first) if n else np.array([], "int64")
            observed, payload = rows.select(columns), []
            for start, end in zip(first, np.append(first[1:], n)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, observed.schema) as out:
                    out.write_table(observed.slice(start, end - start))
                payload.append(sink.getvalue().to_pybytes())
            mark = lambda c: [{"window": -1, "due": 0}.get(c, "" if pa.types.is_string(rows[c].type) else -1)]
            made = {c: pa.concat_arrays([rows[c].take(pa.array(first)).combine_chunks(), pa.array(mark(c), rows[c].type)]) for c in [*by, "due"]}
            made["observations"] = pa.array([*payload, None], pa.binary())
            made["coordinate"] = pa.array([*(None if x == none else int(x) for x in least), latest], pa.int64())
            return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= _ROWS:
                yield packs(held)
                held, n = [], 0
        if n:
            yield packs(held)

    return pack


class _Windows(StatefulProcessor):
    """Holds a window's packs of observations until its timer; a window's are in memory together when it is given out."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("observations", "observations binary")
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
        for frame in rows:
            frame = frame[frame["observations"].notna()]
            if len(frame):
                if not self.due.exists():
                    at = int(frame["due"].iloc[0])
                    self.handle.registerTimer(at)
                    self.due.update((at,))
                self.held.appendList([(bytes(x),) for x in frame["observations"]])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
        import pyarrow as pa

        # read and cleared before it is given out, as Spark may ask for the rows when it is at another key
        out = [pa.ipc.open_stream(x).read_all() for (x,) in self.held.get()]
        self.held.clear()
        self.due.clear()
        return iter([pa.concat_tables(out).select(self.columns).to_pandas()])


class KeyedStream:
    """``run`` takes a stream through to what is there now; ``results`` is what was given out so far.

    Rows have ``keys``, pos, coordinate (the read's start, counted over the whole genome) and
    window_end (the end of the window of pos, counted alike); ``stats`` turns observations of
    complete windows into rows. A row without pos only moves the watermark, as the last one of a
    stream does; a row with pos that lacks a key or a value is no observation. Everything lies below ``root``, a folder that driver and executors share.
    """

    def __init__(self, root: str, stats: Callable[[DataFrame], DataFrame], keys: list[str], columns: list[str], width: int):
        self.root, self.stats, self.keys, self.columns, self.width = root.rstrip("/"), stats, keys, columns, width

    def complete(self, stream: DataFrame) -> DataFrame:
        """The observations of windows, each once its window is complete."""
        names = [*self.keys, *(c for c in self.columns if c not in self.keys)]
        kept = stream.where(F.col("pos").isNull() | ~F.greatest(*(F.col(c).isNull() for c in names)))
        window = F.floor(F.col("pos") / self.width).cast("long").alias("window")
        due = (F.coalesce("window_end", F.lit(0)).cast("long") * 2 + 1).alias("due")
        rows = kept.select(*names, window, due, F.col("coordinate").cast("long").alias("coordinate"))
        packed = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*self.keys, "window", "due"]), "observations binary", "coordinate long"])
        packs = rows.mapInArrow(_packer(self.keys, self.columns), packed).withColumn("at", event_time(F.col("coordinate"))).drop("coordinate")
        schema = StructType([f for f in rows.select(*self.columns).schema])
        return packs.withWatermark("at", "1 milliseconds").groupBy(*self.keys, "window").transformWithStateInPandas(_Windows(self.columns), schema, "Append", "EventTime")

    def run(self, stream: DataFrame) -> None:
        spark = stream.sparkSession
        if self._late(spark):
            raise LateObservation("an observation came after its window was given out, in an earlier run")
        name = "spark.sql.streaming.stateStore.providerClass"
        before = spark.conf.get(name, None)
        spark.conf.set(name, _ROCKS)
        try:
            # a batch that is repeated replaces its own output
            write = lambda rows, batch: self.stats(rows).write.mode("overwrite").parquet(f"{self.root}/out/{batch}")
            query = self.complete(stream).writeStream.foreachBatch(write).option("checkpointLocation", f"{self.root}/stream").trigger(availableNow=True).start()
            query.awaitTermination()
        finally:
            spark.conf.set(name, before) if before else spark.conf.unset(name)
        late = sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
        if late:
            spark.range(late).write.mode("overwrite").parquet(f"{self.root}/late")
            raise LateObservation(f"{late} packs of observations came after a later read: reads must be sorted by their start")

    def _late(self, spark: SparkSession) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/late")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/out/*")


def on_genome(rows: DataFrame, genome: DataFrame, width: int) -> DataFrame:
    """``rows`` (chrom, pos, read_start) with coordinate and window_end, counted over the contigs in the order of ``rank``."""
    # contigs begin at windows' edges, behind the whole last window of the one before
    whole = genome.withColumn("size", (F.floor(F.col("size") / width) + 1) * width)
    offsets = genome_offsets(whole).select("chrom", F.col("offset").alias("offset_"))
    met = rows.join(F.broadcast(offsets), "chrom")  # a row per contig
    end = (F.floor(F.col("pos") / width) + 1) * width
    return met.withColumn("coordinate", F.col("offset_") + F.col("read_start")).withColumn("window_end", F.col("offset_") + end).drop("offset_")
