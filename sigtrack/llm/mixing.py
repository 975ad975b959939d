"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents stand in a shuffled order (by md5), twice over at most, and are cut into
blocks of equally many words. Slot k of the mix goes to the source in whose share of [0, 1) the
k-th van der Corput point falls, so every stretch of the mix holds the sources in proportion.
The rank of a slot among its source's slots has a closed form, as any aligned run of 2^m points
is a shifted grid: no window over a source's slots is needed. Slot and block meet by
(source, rank). A source's last blocks can lack a slot (their number is off by the sequence's
discrepancy, a few blocks) and then follow behind the last slot, numbered on from it.
``blocks`` gives the mix itself, in slot order.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stored, table, word_count

#: The contract's weights by place in the order of sources, and its sizes.
WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2
BITS = 48
#: Name of a column that numbers the rows, where they are stored with it.
ROW = "_mix_row"
#: White space between words, in Java's syntax.
GAP = r"[\x20\x09-\x0D]+"
_WORD = re.compile(WORD)


def file_row() -> Column:
    """Names rows of files, for ``blocks``."""
    return F.struct("_metadata.file_path", "_metadata.row_index")


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


def _reversed_bits(n: Column) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(n), BITS, "0")), 2, 10).cast("long")


def points_below(n: Column, bits: int, bound: Column) -> Column:
    """How many of the first ``n`` van der Corput points (as integers of 48 bits) are below ``bound``."""
    rev = _reversed_bits(n)

    total = F.lit(0).cast("long")
    for m in range(bits):
        step, lead = 1 << (BITS - m), rev.bitwiseAND(F.lit((1 << (BITS - 1 - m)) - 1))
        inside = F.greatest(F.lit(0).cast("long"), F.least(F.lit(1 << m).cast("long"), F.shiftright(bound - lead + F.lit(step - 1), BITS - m)))
        total = total + F.when(n.bitwiseAND(F.lit(1 << m)) != 0, inside).otherwise(F.lit(0).cast("long"))
    return total


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, s (its place), source_size, target.

    Sources take SHARE of all sizes by their weights; a target stops at MOST_COPIES times the
    source's size, and what is beyond is shared again by weight among the others. The fixed
    point: in the order of cap by weight, the sources up to the first that the level of the
    remaining ones does not fill are at their caps.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").isNull(), "source")  # as few rows as there are sources
    w = by_source.withColumn("s", F.row_number().over(place) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("s") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    w = w.withColumn("cap", (MOST_COPIES * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("level", (SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    w = w.withColumn("level", F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(F.col("cap") / F.col("weight"), F.col("s"), F.col("level").alias("found")))).over(every)["found"])
    return w.select("source", "s", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def sized(docs: DataFrame, numbered: bool = False) -> DataFrame:
    """row, doc_id, source, size and shuffled place (the md5 that documents are ordered by). Texts count in it too, so that
    documents without a doc_id, or with the same one, are spread like others. ``numbered`` rows have a column ROW."""
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    key = F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), text)
    row = F.col(ROW) if numbered else F.monotonically_increasing_id()
    return docs.select(row.alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), F.md5(key.cast("binary")).alias("draw"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with its source's columns and ``start``, the words of its source before it.

    Running sums go by leading digits of the md5: sums of digits first, then rows within them, so
    a source with most rows is spread over all tasks.
    """
    n = sizes.count()
    digits = max(2, math.ceil(math.log(max(1, n / 100_000), 16)))
    rows = sizes.withColumn("cell", F.substring("draw", 1, digits)).join(sources, sizes.source.eqNullSafe(sources.source)).drop(sources.source)
    cells = rows.groupBy("s", "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy("s").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("s", "cell", F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("s", "cell").orderBy("draw", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    run = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return run.join(cells, ["s", "cell"]).withColumn("start", F.col("first") + F.col("inside")).drop("first", "inside", "cell")


def _needed() -> Column:
    return F.floor(F.col("target") + 0.5).cast("long")


def _shares(sources: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """s, blocks, low and high (its share of the points) of the sources with blocks; the number of all blocks."""
    blocks = F.ceil(_needed() / block_words).cast("long")
    total = sources.agg(F.sum(blocks).alias("n")).first().n or 0
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    part = sources.select("s", blocks.alias("blocks")).withColumn("above", F.sum("blocks").over(upto))
    bound = lambda c: F.floor(c.cast("double") / max(1, total) * float(1 << BITS)).cast("long")
    return part.where("blocks > 0").select("s", "blocks", bound(F.col("above") - F.col("blocks")).alias("low"), bound(F.col("above")).alias("high")), total


def tail(sources: DataFrame, block_words: int) -> DataFrame:
    """(slot, s, rank) of the blocks that the schedule has no slot for, numbered on behind it."""
    part, total = _shares(sources, block_words)
    n, bits = F.lit(total).cast("long"), max(1, int(total).bit_length())
    part = part.select("s", "blocks", (points_below(n, bits, F.col("high")) - points_below(n, bits, F.col("low"))).alias("held")).where("held < blocks")
    over = F.col("blocks") - F.col("held")
    part = part.withColumn("last", F.sum(over).over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)) - F.col("blocks"))
    return part.select("s", "last", F.explode(F.sequence("held", F.col("blocks") - 1)).alias("rank")).select((n + F.col("last") + F.col("rank")).alias("slot"), "s", "rank")


def slots(sources: DataFrame, block_words: int, cells: int = 1024) -> DataFrame:
    """(slot, s, rank) of the schedule: as many slots as there are blocks."""
    part, total = _shares(sources, block_words)
    bits = max(1, int(total).bit_length())
    part = part.select("s", "low", "high")
    shift = BITS - (cells - 1).bit_length()
    part = part.withColumn("cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))))
    spark = sources.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(total) // 250_000)
    k = spark.range(0, int(total), 1, parts).withColumnRenamed("id", "slot").withColumn("point", _reversed_bits(F.col("slot")))
    k = k.withColumn("cell", F.shiftright("point", shift)).join(part, "cell").where("point >= low and point < high")
    rank = points_below(F.col("slot"), bits, F.col("high")) - points_below(F.col("slot"), bits, F.col("low"))
    return k.select("slot", "s", rank.alias("rank"))


def schedule(docs: DataFrame, block_words: int = 256, numbered: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows (``placed``) and the pieces of the mix: row, slot, place, copy, first word and words.

    A piece is the part of a document that falls in one block, ``place`` the block's words before
    it; the few blocks behind the last slot have the numbers of ``tail``.
    """
    sizes = stored(sized(docs, numbered))
    sources = stored(targets(sizes))
    rows = stored(placed(sizes, sources))
    copy = F.explode(F.array(*(F.lit(c) for c in range(MOST_COPIES)))).alias("copy")
    runs = rows.where("size > 0").select("row", "s", "size", "start", "source_size", _needed().alias("needed"), copy)
    runs = runs.withColumn("at", F.col("copy") * F.col("source_size") + F.col("start")).withColumn("stop", F.least(F.col("at") + F.col("size"), "needed")).where("stop > at")
    first, last = F.floor(F.col("at") / block_words), F.floor((F.col("stop") - 1) / block_words)
    pieces = runs.withColumn("rank", F.explode(F.sequence(first, last)))
    low, high = F.greatest("at", F.col("rank") * block_words), F.least("stop", (F.col("rank") + 1) * block_words)
    pieces = pieces.select("row", "s", "rank", "copy", (low - F.col("rank") * block_words).alias("place"), (low - F.col("at")).alias("first_word"), (high - low).alias("words"))
    plan = slots(sources, block_words).unionByName(tail(sources, block_words))
    return rows, pieces.join(plan, ["s", "rank"], "left").select("row", "slot", "place", "copy", "first_word", "words")


def mix(docs: DataFrame, block_words: int = 256, numbered: bool = False) -> DataFrame:
    """row, doc_id, size, source_size, target, taken and the words taken of the first and second copy; and where they
    stand: first_slot, first_place (the words before it in that slot's block), last_slot and n_pieces, the number of parts.

    Null text has size 0 and is taken 0 times; a null source is a source of its own, the last.
    Rows that repeat a doc_id are rows of their own. An empty table gives no rows. What is taken
    of a copy is its leading words, as a source's last block may end inside a document.
    """
    rows, pieces = schedule(docs, block_words, numbered)
    part = lambda c: F.sum(F.when(F.col("copy") == c, F.col("words")).otherwise(0)).alias(f"taken_{c}")
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"), part(0), part(1), F.min(F.struct("slot", "place")).alias("first"), F.max("slot").alias("last_slot"), F.count(F.lit(1)).alias("n_pieces"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(taken, "row", "left").select("row", "doc_id", "size", "source_size", "target", zero("taken"), zero("taken_0"), zero("taken_1"), F.col("first.slot").alias("first_slot"), F.col("first.place").alias("first_place"), "last_slot", zero("n_pieces"))


def blocks(docs: DataFrame, block_words: int = 256, row: Column | None = None) -> DataFrame:
    """The mix in the order of its slots, a row per part of a document in a block: slot, place, source, doc_id, copy,
    first_word, words, text.

    Null texts have no parts; rows that repeat a doc_id, or have none, are rows of their own; an empty table gives no rows.
    ``place`` is the block's words before the part. Texts keep the white space behind their words, so a document's
    parts in order of first_word are its text. Blocks without a slot come last, with the next numbers.

    ``row`` names each row, the same in every reading (as ``file_row`` does for rows of files); without it the rows are
    stored with a number. Texts move twice: compressed to their parts, and cut to the range of slots that they belong to.
    """
    rows = docs.select("doc_id", "source", "text", (F.monotonically_increasing_id() if row is None else row).alias(ROW))
    if row is None:
        rows = stored(rows)
    _, pieces = schedule(rows, block_words, numbered=True)
    pieces = stored(pieces)
    parts = pieces.groupBy("row").agg(F.collect_list(F.struct("slot", "place", "copy", "first_word", "words")).alias("parts"))
    slots_used = (pieces.agg(F.max("slot").alias("n")).first().n or 0) + 1

    def compress(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            small = pa.array([_codec().compress(x.as_buffer(), asbytes=True) for x in frame["text"]], pa.binary())
            yield frame.set_column(frame.schema.names.index("text"), "text", small)

    full = rows.where("text is not null").select(ROW, F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string").cast("binary"))
    full = full.withColumn("size", F.length("text"))
    # a row's parts are the small side, so texts are not sorted
    whole = full.mapInArrow(compress, full.schema).join(parts.hint("shuffle_hash"), F.col(ROW) == F.col("row")).select("doc_id", "source", "text", "size", "parts")

    names = ("slot", "place", "copy", "first_word", "words")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(out: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["slot", "place", "source", "doc_id", "copy", "first_word", "words", "text"])

        out, held = [], 0
        for frame in frames:
            for i in range(frame.num_rows):
                doc_id, source, data, size, parts = (frame[c][i].as_py() for c in ("doc_id", "source", "text", "size", "parts"))
                text = _codec().decompress(data, size, asbytes=True).decode(errors="replace")
                starts = [m.start() for m in _WORD.finditer(text)]
                starts[0] = 0
                starts.append(len(text))
                for slot, place, copy, first, n in (tuple(p[c] for c in names) for p in parts):
                    piece = text[starts[first] : starts[first + n]]
                    out.append((slot, place, source, doc_id, copy, first, n, piece))
                    held += len(piece) + 100
                    if held > 4_000_000:
                        yield batch(out)
                        out, held = [], 0
        yield batch(out)

    texts = whole.mapInArrow(run, "slot long, place long, source string, doc_id long, copy int, first_word long, words long, text string")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # slots are numbered without gaps, so their ranges are known without a sample
    return texts.repartitionById(n, F.floor(F.col("slot") * n / F.lit(slots_used)).cast("int")).sortWithinPartitions("slot", "place")


def mixed(docs: DataFrame, block_words: int = 256) -> DataFrame:
    """The rows of ``docs`` that the mix takes words of, with the columns of ``docs``, in the order in which the mix comes to them.

    ``text`` is what is taken: the text, once or twice with a line feed between; where a source's
    last block ends inside a document, its leading words with single spaces. n_chars, if there, is
    counted anew. Rows that repeat a doc_id, or have none, are rows of their own; null texts have no
    words and go; an empty table gives no rows; columns of any other name stay as they are.
    """
    # columns go by their numbers meanwhile, so none can have a name that is used here
    named = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, named))
    rows = stored(docs.toDF(*named).withColumn(ROW, F.monotonically_increasing_id()))
    given = rows.select(ROW, *(F.col(at[c]).alias(c) for c in ("doc_id", "source", "text")))
    plan = mix(given, block_words, numbered=True).where("taken > 0").select(
        F.col("row").alias(ROW), F.col("size").alias("_mix_size"), F.col("taken_0").alias("_mix_0"), F.col("taken_1").alias("_mix_1"),
        F.col("first_slot").alias("_mix_slot"), F.col("first_place").alias("_mix_place"),
    )
    words = F.filter(F.split(at["text"], GAP), lambda w: w != "")
    part = lambda c: F.when(F.col(c) == F.col("_mix_size"), F.col(at["text"])).when(F.col(c) > 0, F.array_join(F.slice(words, F.lit(1), F.col(c).cast("int")), " "))
    out = rows.join(plan, ROW).withColumn(at["text"], F.concat_ws("\n", part("_mix_0"), part("_mix_1")))
    if "n_chars" in docs.columns:
        out = out.withColumn(at["n_chars"], F.length(at["text"]).cast(docs.schema["n_chars"].dataType))
    return out.orderBy("_mix_slot", "_mix_place").select(*(F.col(n).alias(c) for c, n in at.items()))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in the order in which the mix comes to them, then those it takes nothing of, with slots -1."""
    found = mix(table(spark, sf_dir, "documents")).orderBy(F.col("first_slot").asc_nulls_last(), "first_place", "doc_id", "row")
    known = lambda c: F.coalesce(c, F.lit(-1)).cast("long").alias(c)
    return found.select("doc_id", "size", "source_size", "target", "taken", known("first_slot"), known("first_place"), known("last_slot"), "n_pieces")


def op9_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(table(spark, sf_dir, "documents"), row=file_row())


#: The same in DuckDB's SQL: the points of the schedule by their bits, ranks by counting.
_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS s FROM s),
c AS (
  SELECT *, CASE s % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, (2 * source_size)::DOUBLE AS cap FROM w),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM c WINDOW b AS (ORDER BY cap / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level AS found FROM l WHERE cap / weight >= level ORDER BY cap / weight, s LIMIT 1),
t AS (SELECT source, s, source_size, least(cap, found * weight) AS target FROM l, f),
p AS (
  SELECT row_number() OVER () AS row, d.doc_id, d.size, t.s, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS needed,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT s, ceil(floor(target + 0.5) / {block})::BIGINT AS blocks FROM t),
h AS (SELECT s, blocks, sum(blocks) OVER (ORDER BY s) AS above, sum(blocks) OVER () AS total FROM b),
q AS (
  SELECT s, floor((above - blocks)::DOUBLE / total * 281474976710656)::BIGINT AS low, floor(above::DOUBLE / total * 281474976710656)::BIGINT AS high
  FROM h WHERE blocks > 0),
k AS (
  SELECT k AS slot, list_sum(list_transform(range(48), lambda i: ((k >> i) & 1) << (47 - i)))::BIGINT AS point
  FROM (SELECT unnest(range(coalesce((SELECT sum(blocks) FROM b), 0)::BIGINT)) AS k)),
g AS (SELECT slot, s, row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS rank FROM k JOIN q ON point >= low AND point < high),
r AS (SELECT s, unnest(range(blocks)) AS rank FROM b),
o AS (
  SELECT (SELECT sum(blocks) FROM b)::BIGINT + row_number() OVER (ORDER BY s, rank) - 1 AS slot, s, rank FROM r ANTI JOIN g USING (s, rank)),
x AS (SELECT slot, s, rank FROM g UNION ALL SELECT slot, s, rank FROM o),
u AS (
  SELECT row, s, copy * source_size + start AS pos, least(copy * source_size + start + size, needed) AS stop
  FROM p, (VALUES (0), (1)) c(copy) WHERE size > 0),
z AS (SELECT row, s, pos, unnest(range((pos // {block})::BIGINT, ((stop - 1) // {block} + 1)::BIGINT)) AS rank FROM u WHERE stop > pos),
y AS (
  SELECT row, min(slot) AS first_slot, arg_min(greatest(pos - rank * {block}, 0), slot * {block} + greatest(pos - rank * {block}, 0)) AS first_place, max(slot) AS last_slot, count(*) AS n_pieces
  FROM z JOIN x USING (s, rank) GROUP BY row)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, needed - start)) + greatest(0, least(size, needed - source_size - start)))::BIGINT AS taken,
       coalesce(first_slot, -1)::BIGINT AS first_slot, coalesce(first_place, -1)::BIGINT AS first_place, coalesce(last_slot, -1)::BIGINT AS last_slot, coalesce(n_pieces, 0)::BIGINT AS n_pieces
FROM p LEFT JOIN y USING (row)
"""


def oracle(block_words: int = 256) -> str:
    return _SQL.replace("{block}", str(block_words))


ORACLE = {"op9_mix": oracle()}
