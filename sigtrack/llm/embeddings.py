"""Near-duplicate embeddings by spherical k-means cells.

Vectors are compared only within their label, of whatever type. Unit vectors of a label are assigned to the cells
of spherical k-means centres, fitted on a bounded sample; a vector is also a guest of every cell
in which a partner could be at home: x and y with cosine >= t are at most the angle acos(t)
apart, so y can be nearer to centre c' than to x's own centre c only if x lies within that angle
of their bisecting plane, x.(c - c') / |c - c'| <= sin(acos(t)). A pair from two cells meets in
the one with the larger number. Within a cell, blocks of vectors are compared by matrix
products; dense cells are split into blocks by a hash, and pairs of blocks are tasks of their own.
Copies of a vector are one node with a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, FractionalType, MapType, StructType, VariantType

from .common import stored, table
from .simhash import _chain, components

THRESHOLD, CELL, SAMPLE, BLOCK = 0.98, 4000, 20_000, 4096
#: Rounding of a product of unit vectors in double precision stays below this.
_SLACK = 1e-9


def _chunks(n: int, width: int, cells: int = 4_000_000) -> range:
    """Starts of runs of rows, of which a matrix of ``width`` columns has about ``cells`` cells."""
    return range(0, n, max(1, cells // max(1, width)))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 4) -> np.ndarray:
    """k unit centres of unit vectors; fewer when there are fewer vectors."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    steps = _chunks(len(x), len(centres))
    for _ in range(rounds):
        near = np.concatenate([(x[a : a + steps.step] @ centres.T).argmax(1) for a in steps])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def cells_of(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, at home) of each vector's own cell and of the later cells that it visits, some rows at a time."""
    homes, rows, cells = [], [], []
    steps = _chunks(len(x), len(centres))
    for a in steps:
        dots = x[a : a + steps.step] @ centres.T
        home = dots.argmax(1)
        gap = np.sqrt(np.maximum(0, 2 - 2 * (centres[home] @ centres.T)))
        margin = dots[np.arange(len(dots)), home][:, None] - dots
        reach = margin <= (math.sqrt(1 - threshold * threshold) + _SLACK) * gap
        # a pair whose homes differ meets in the larger one: only guests from smaller cells go there
        reach &= np.arange(len(centres))[None, :] > home[:, None]
        r, c = np.nonzero(reach)
        homes.append(home)
        rows.append(a + r)
        cells.append(c)
    own = np.concatenate(homes) if homes else np.zeros(0, np.int64)
    guests = np.concatenate(rows) if rows else own
    return np.append(np.arange(len(x)), guests), np.append(own, np.concatenate(cells) if cells else own), np.append(np.ones(len(x), bool), np.zeros(len(guests), bool))


def compare(x: np.ndarray, y: np.ndarray | None, copies_x: np.ndarray, copies_y: np.ndarray, home_x: np.ndarray, home_y: np.ndarray, threshold: float, step: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of links of x's and of y's rows, and pairs (i, j) that connect what is linked.

    y None compares x with itself. Two guests are not compared; they meet where one is at home.
    """
    own = y is None
    if own:
        y, copies_y, home_y = x, copies_x, home_x
    n_x, n_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    parent = np.arange(len(x) + (0 if own else len(y)))
    shift = 0 if own else len(x)
    for a in range(0, len(x), step):
        for b in range(a if own else 0, len(y), step):
            hit = x[a : a + step] @ y[b : b + step].T >= threshold
            hit &= home_x[a : a + step, None] | home_y[None, b : b + step]
            if own and a == b:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            np.add.at(n_x, a + i, copies_y[b + j])
            np.add.at(n_x if own else n_y, b + j, copies_x[a + i])
            i, j = a + i, shift + b + j
            new = parent[i] != parent[j]
            if new.any():
                i, j = i[new], j[new]
                _chain(parent, i, j)
    at = np.flatnonzero(parent != np.arange(len(parent)))
    at = np.concatenate([np.unique(parent[at]), at])
    order = np.lexsort((at, parent[at]))
    at = at[order]
    same = parent[at[1:]] == parent[at[:-1]]
    return n_x, n_y, at[:-1][same], at[1:][same]


def _label(vectors: DataFrame) -> Column:
    """A label as text: numbers with a sign of zero have one zero, what is no plain value is JSON."""
    kind = vectors.schema["label"].dataType
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        return (F.col("label") + F.lit(0.0)).cast("string")
    return F.to_json("label") if isinstance(kind, (StructType, ArrayType, MapType, VariantType)) else F.col("label").cast("string")


def directions(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text that equal labels share) and unit (array of doubles) of every row; unit is null where a row cannot link.

    Vectors are divided by their largest component first, so that squares neither overflow nor vanish.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), _label(vectors).alias("label"), F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.withColumn("x", F.when(F.col("label").isNotNull() & (F.size("x") > 0) & finite, F.col("x")))
    rows = rows.withColumn("top", F.array_max(F.transform("x", F.abs)))
    rows = rows.withColumn("x", F.when(F.col("top") > 0, F.transform("x", lambda v: F.try_divide(v, F.col("top")))))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    return rows.withColumn("norm", norm).select("vec_id", "label", F.transform("x", lambda v: F.try_divide(v, F.col("norm"))).alias("unit"))


_ITEM = "label string, cell long, node long, copies long, home boolean, unit array<double>"


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row. Labels can be of any type; equal ones are one label.

    Vectors that are null, zero or hold a null or non-finite value, and those without a label,
    link with nothing. Vectors of different length do not link. Copies (equal after scaling to
    length 1) link with each other. An empty table gives no rows. Every row counts as a vector of
    its own: rows that repeat a vec_id stay apart and link by their own vectors; a row without a
    vec_id counts as a link of others, and its component_id is theirs, null if they have none.
    """
    # 96 bits name a direction where rows meet it again
    h = F.when(F.col("unit").isNotNull(), F.struct(F.xxhash64("label", "unit").alias("a"), F.hash("unit", "label").alias("b")))
    keyed = stored(directions(vectors).withColumn("h", h))
    # copies of a direction are one node; its number is fixed as it is written
    nodes = keyed.where("unit is not null").groupBy("h", "label", "unit").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "h", "label", F.size("unit").alias("dim"), "unit", "first", "copies"))
    # only labels with more than a cell have centres, and only what is drawn of them, and their counts, come to the driver
    sizes = stored(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")))
    whole = sizes.agg(F.sum("n").alias("n"), F.max("dim").alias("dim")).first()
    large = sizes.where(F.col("n") > cell)
    rng = F.pmod(F.xxhash64("unit", F.lit(31)), F.lit(1 << 20)) / (1 << 20)
    # the sample is bounded in numbers too, whatever the length of the vectors
    sample = min(sample, 2_000_000 // max(1, whole.dim or 1))
    drawn = nodes.where(rng < min(1.0, sample / max(1, whole.n or 0))).join(large, ["label", "dim"]).select("label", "dim", "unit", "n").collect()
    counts = {(r.label, r.dim): r.n for r in drawn}
    by: dict[tuple[int, int], list] = {}
    for r in drawn:
        by.setdefault((r.label, r.dim), []).append(r.unit)
    centres = {k: spherical_kmeans(np.array(v), -(-counts[k] // cell)) for k, v in sorted(by.items()) if len(v) > 1}

    def deal(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            label, dim = np.array(frame["label"].to_pylist()), np.array(frame["dim"].to_pylist())
            for key in sorted(set(zip(label.tolist(), dim.tolist()))):
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                own = frame.take(pa.array(at))
                if key in centres:
                    x = np.array(own["unit"].to_pylist())
                    r, c, home = cells_of(x, centres[key], threshold)
                else:
                    r, c, home = np.arange(len(at)), np.zeros(len(at), np.int64), np.ones(len(at), bool)
                own = own.take(pa.array(r))
                # vectors of other lengths are cells of their own
                yield pa.RecordBatch.from_arrays([own["label"], pa.array((c + key[1] * 1_000_003).astype(np.int64)), own["node"], own["copies"], pa.array(home), own["unit"]], ["label", "cell", "node", "copies", "home", "unit"])

    dealt = stored(nodes.select("label", "dim", "node", "copies", "unit").mapInArrow(deal, _ITEM))
    sizes = dealt.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"))
    # a cell of n items has b blocks; each item goes to the b pairs of blocks that hold its own
    parts = dealt.join(sizes, ["label", "cell"]).withColumn("b", F.ceil(F.col("n") / block).cast("long")).withColumn("own", F.pmod(F.xxhash64("node", F.lit(17)), F.col("b")))
    parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b") - 1)))
    parts = parts.select("label", "cell", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "copies", "home", "unit")

    def search(rows: pa.Table) -> pa.Table:
        x, node = np.array(rows["unit"].to_pylist()), rows["node"].to_numpy()
        copies, home, own = rows["copies"].to_numpy(), rows["home"].to_numpy(), rows["own"].to_numpy()
        if rows["p"][0] == rows["q"][0]:
            n, _, i, j = compare(x, None, copies, copies, home, home, threshold)
            names = node
        else:
            a, b = np.flatnonzero(own == rows["p"][0].as_py()), np.flatnonzero(own == rows["q"][0].as_py())
            n_a, n_b, i, j = compare(x[a], x[b], copies[a], copies[b], home[a], home[b], threshold)
            names, n = node[np.append(a, b)], np.append(n_a, n_b)
        at = np.flatnonzero(n)
        return pa.table({"a": np.append(names[at], names[i]), "b": np.append(names[at], names[j]), "n": np.append(n[at], np.zeros(len(i), np.int64))})

    found = stored(parts.groupBy("label", "cell", "p", "q").applyInArrow(search, "a long, b long, n long"))
    links = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("more"))
    roots = components(found.where("n = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    known = nodes.select("h", "node", "first", "copies").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(least, "root").select("h", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    rows = keyed.select("vec_id", "h")
    linked = rows.where("h is not null").join(known, "h").select("vec_id", "n_links", "component_id")
    alone = rows.where("h is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = {
    "op7_embeddings": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (
  SELECT a AS vec_id, b AS other FROM p UNION SELECT r.vec_id, p.b FROM r JOIN p ON r.other = p.a)
SELECT e.vec_id, (SELECT count(*) FROM p WHERE p.a = e.vec_id)::BIGINT AS n_links,
       least(e.vec_id, coalesce((SELECT min(other) FROM r WHERE r.vec_id = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce((SELECT min(other) FROM r WHERE r.vec_id = e.vec_id), e.vec_id)) AS kept
FROM embeddings e
"""
}
