"""Centroid clustering by dimension-sharded Lloyd rounds, in whole numbers.

Vectors stand in bands of rows, and a band is cut into blocks of columns; a block is a row of its
own, so neither vectors nor centroids need fit in a task as a whole. A round has three steps:
column-block tasks compute the exact partial squared distances of their rows to the centroids'
slices of those columns; the blocks of a band are added by its number and the nearest centroid is
taken; each shard sums its own columns by centroid and so updates its own slice. Sums and distances
are 64-bit integers, so the order of adding changes nothing. Assignments and centroids of a round
are written, so a lost executor costs running tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

CLUSTERS, ROUNDS, SEED, SCALE, DIMS = 40, 5, 2, 256, 64
#: Rows of a band and columns of a block.
BAND, BLOCK = 1024, 16
#: Beyond this, a component's squared differences summed over a vector could pass 64 bits.
_MOST = 1 << 27

_SHARDS = "band long, block int, cells binary"


def quantized(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and q (array of longs, floor(scale * x)) of the vectors of ``dims`` components, all of them finite."""
    x = vectors.select(F.col("vec_id").cast("long"), F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))))
    kept = x.where((F.size("x") == dims) & finite).select("vec_id", "x", q.alias("q"))
    large = F.exists("x", lambda v: F.abs(v) * scale >= _MOST)
    fault = F.raise_error(F.concat(F.lit("a component is too large for distances of 64 bits, vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    return kept.select("vec_id", F.when(large, fault.cast("array<bigint>")).otherwise(F.col("q")).alias("q"))


def shards(rows: DataFrame, dims: int, band: int = BAND, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The column blocks (band, block, cells) of ``rows`` (vec_id, q), and the vec_ids of each band, both stored."""

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for frame in frames:
            for a in range(0, frame.num_rows, band):
                part = frame.slice(a, band)
                x = part["q"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                cells = [np.ascontiguousarray(x[:, c : c + block]).astype("<i4").tobytes() for c in range(0, dims, block)]
                n = len(cells)
                ids = pa.array([part["vec_id"].to_pylist()] + [None] * (n - 1), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([number] * n), pa.array(range(n), pa.int32()), pa.array(cells, pa.binary()), ids], ["band", "block", "cells", "ids"])
                number += 1

    cut_up = stored(rows.select("vec_id", "q").mapInArrow(cut, _SHARDS + ", ids array<long>"))
    return cut_up.select("band", "block", "cells"), cut_up.where("block = 0").select("band", "ids")


def first_centroids(rows: DataFrame, k: int, seed: int, block: int) -> DataFrame:
    """(cluster, block, slice) of the k vectors whose sha256 of ``seed:vec_id`` comes first; equal ones in the order of their components, a null vec_id last."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(draw.alias("draw"), "q").orderBy(F.asc_nulls_last("draw"), "q").limit(k)
    # k rows: they are numbered in one array
    numbered = first.agg(F.array_sort(F.collect_list(F.struct(F.coalesce("draw", F.lit("~")).alias("draw"), "q"))).alias("all"))
    one = numbered.select(F.posexplode("all").alias("cluster", "c"))
    return _sliced(one.select("cluster", F.col("c.q").alias("q")), block)


def _sliced(centroids: DataFrame, block: int) -> DataFrame:
    starts = F.sequence(F.lit(0), F.floor((F.size("q") - 1) / block).cast("int"))
    cut = centroids.select("cluster", "q", F.explode(starts).alias("block"))
    return cut.select("cluster", "block", F.slice("q", F.col("block") * block + 1, F.lit(block)).alias("slice"))


def _with_slices(cells: DataFrame, centroids: DataFrame) -> DataFrame:
    """Each block beside the centroids' slices of its columns, in the order of their numbers: k times the block's columns, whatever the number of vectors."""
    slices = centroids.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("cluster", "slice"))).alias("c"))
    return cells.join(F.broadcast(slices.select("block", F.transform("c", lambda c: c["slice"]).alias("slices"))), "block")


def _cells(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(-1, width).astype(np.int64)


def partial_distances(cells: DataFrame, centroids: DataFrame) -> DataFrame:
    """(band, block, part): the squared distances of a block's rows to each slice, as a matrix of longs."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            out = []
            for data, slices in zip(frame["cells"], frame["slices"]):
                c = np.array(slices.as_py(), np.int64)
                x = _cells(data.as_py(), c.shape[1])
                part = np.empty((len(x), len(c)), "<i8")
                for j, y in enumerate(c):
                    d = x - y
                    part[:, j] = (d * d).sum(1)
                out.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([frame["band"], frame["block"], pa.array(out, pa.binary())], ["band", "block", "part"])

    joined = _with_slices(cells, centroids).select("band", "block", "cells", "slices")
    return joined.mapInArrow(run, "band long, block int, part binary")


def nearest(parts: DataFrame, k: int) -> DataFrame:
    """(band, clusters, distances) of each band: its blocks' parts added, the least taken, ties to the smaller number."""

    def add(group: pa.Table) -> pa.Table:
        total = None
        for data in group["part"]:
            part = np.frombuffer(data.as_py(), "<i8")
            total = part.copy() if total is None else np.add(total, part, out=total)
        d = total.reshape(-1, k)
        near = d.argmin(1)
        kinds = pa.list_(pa.int32()), pa.list_(pa.int64())
        return pa.table({"band": group["band"][:1], "clusters": pa.array([near.tolist()], kinds[0]), "distances": pa.array([d[np.arange(len(d)), near].tolist()], kinds[1])})

    return parts.groupBy("band").applyInArrow(add, "band long, clusters array<int>, distances array<long>")


def updated(cells: DataFrame, assigned: DataFrame, centroids: DataFrame, dims: int, block: int) -> DataFrame:
    """The centroids after a round: a slice is the floor of the mean of its shard's rows; an empty cluster's stays."""

    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for frame in frames:
            for b, data, clusters in zip(frame["block"].to_pylist(), frame["cells"], frame["clusters"]):
                x, near = _cells(data.as_py(), min(block, dims - b * block)), np.array(clusters.as_py())
                for c in np.unique(near).tolist():
                    own = x[near == c]
                    n, total = held.get((b, c), (0, 0))
                    held[b, c] = (n + len(own), total + own.sum(0))
        keys = sorted(held)
        names = ["block", "cluster", "n", "total"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        values = [[b for b, _ in keys], [c for _, c in keys], [held[x][0] for x in keys], [held[x][1].tolist() for x in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

    met = cells.join(assigned.select("band", "clusters"), "band").select("block", "cells", "clusters")
    part = met.mapInArrow(sums, "block int, cluster int, n long, total array<long>")
    by_column = part.select("block", "cluster", "n", F.posexplode("total").alias("at", "x"))
    mean = by_column.groupBy("block", "cluster", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    mean = mean.select("block", "cluster", "at", F.expr("(x - pmod(x, n)) div n").alias("x"))
    new = mean.groupBy("block", "cluster").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("s"))
    new = new.select("block", "cluster", F.transform("s", lambda s: s["x"]).alias("new"))
    return centroids.join(new, ["block", "cluster"], "left").select("cluster", "block", F.coalesce("new", "slice").alias("slice"))


def lloyd(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids (cluster, block, slice).

    Kept are vectors of exactly ``dims`` components, none null, NaN or infinite; the others have no
    row. Rows that repeat a vec_id, and those without one, are vectors of their own. Fewer vectors
    than ``k`` make as many centroids, none make empty tables. A component beyond 2^27 / scale is
    an error, as its distances can pass 64 bits.
    """
    rows = quantized(vectors, dims, scale)
    cells, ids = shards(rows, dims, block=block)
    centroids = stored(first_centroids(rows, k, seed, block))
    k = centroids.select("cluster").distinct().count()
    for _ in range(rounds if k else 0):
        assigned = stored(nearest(partial_distances(cells, centroids), k))
        centroids = stored(updated(cells, assigned, centroids, dims, block))
    found = nearest(partial_distances(cells, centroids), max(1, k)).join(ids, "band")
    each = found.select(F.explode(F.arrays_zip("ids", "clusters", "distances")).alias("r"))
    return stored(each.select(F.col("r.ids").alias("vec_id"), F.col("r.clusters").alias("cluster"), F.col("r.distances").alias("distance"))), centroids


def digest(values: Column) -> Column:
    return F.sha2(F.array_join(F.transform(values, lambda v: v.cast("string")), ","), 256)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = lloyd(table(spark, sf_dir, "embeddings"))
    # from here on a row per cluster
    whole = centroids.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("block", "slice"))).alias("s"))
    whole = whole.select("cluster", digest(F.flatten(F.transform("s", lambda s: s["slice"]))).alias("centroid_sha256"))
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia"))
    known = inertia.crossJoin(F.broadcast(total)).join(whole, "cluster")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> str:
    """The same in DuckDB's SQL, a pair of expressions for each round."""
    steps = [f"""WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
r AS (SELECT row_number() OVER () AS row, vec_id, q FROM v),
c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, q) - 1)::INT AS cluster, q AS c FROM r
  ORDER BY cluster LIMIT {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(q) AS q, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT row, vec_id, q, cluster, list_sum(list_transform(range(1, {dims + 1}), lambda i: (q[i] - c[i]) * (q[i] - c[i])))::BIGINT AS d FROM r, c{i})
  GROUP BY row)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT cluster, place, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, unnest(range(1, {dims + 1})) AS place FROM d{i}) GROUP BY ALL),
n{i} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS c FROM m{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(n{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN n{i} USING (cluster))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, d.cluster, distance, (sum(distance) OVER (PARTITION BY d.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM d{rounds} d JOIN c{rounds} c ON c.cluster = d.cluster"""


ORACLE = {"op13_centroids": oracle()}
