"""SimHash near-duplicates by vantage-point trees.

Fingerprints: 64 bits, one where more than half of a text's 3-word shingles have it set in
their XXH64. Two fingerprints within 3 bits of each other agree within 1 bit on their upper or
on their lower half, as 3 differing bits cannot be 2 and 2. Each half therefore has a
vantage-point tree of its own over Hamming distance with radius 1; its leaves are the shards of
the search. A fingerprint at distance ``mu`` of a node's vantage point, just inside the
boundary, is also handed to the outer side: by the triangle inequality a partner there is at
``mu + 1``, so no pair is lost, and no other branch need be searched. In a shard the tree is
carried on in memory with the exact 64-bit radius until a part is small, and parts are compared
in blocks. A shard reports a chain of links that connects what it found, never all pairs. A leaf
that no vantage point divides can be large; it is split into blocks by a hash, and each pair of
its blocks is a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

RADIUS, SHARD, SAMPLE = 3, 4096, 40_000


def fingerprint_of(words: list[bytes], chunk: int = 1 << 19) -> int:
    from xxhash import xxh64_intdigest

    if len(words) < 3:
        shingles, n = [b" ".join(words)] if words else [], min(1, len(words))
    else:
        shingles, n = map(b" ".join, zip(words, words[1:], words[2:])), len(words) - 2
    ones, shingles = np.zeros(64, np.int64), iter(shingles)
    for a in range(0, n, chunk):
        size = min(chunk, n - a)
        h = np.fromiter((xxh64_intdigest(s, 42) for s, _ in zip(shingles, range(size))), "<u8", size)
        ones += _bit_sums(h)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > n)))


def _bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set; 255 rows of bytes add up in a byte."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(0, dtype=np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a long) of every row.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have fingerprint 0.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            fp = np.array([fingerprint_of(t.encode().lower().split()) if t else 0 for t in frame.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _distance(x: np.ndarray, v: int) -> np.ndarray:
    return np.bitwise_count(x ^ np.uint64(v))


def fit_tree(sample: np.ndarray, leaves: int, rng: np.random.Generator) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, mu, inner child, outer child); a negative child -k is leaf k - 1.

    ``mu`` is the distance nearest the sample's median, moved to where few points lie on the
    boundary; a part that no vantage point divides stays a leaf.
    """
    nodes: list[list[int]] = []
    done, parts = 0, [(sample, leaves, -1, 0)]
    while parts:
        part, want, parent, side = parts.pop()
        best = None
        if want > 1 and len(part) > 8:
            for v in rng.choice(part, 6):
                d = _distance(part, v)
                for mu in {int(np.median(d)) + k for k in (-2, -1, 0, 1)}:
                    inner, edge = int((d <= mu).sum()), int((d == mu).sum())
                    if 0 < inner < len(part):
                        cost = max(inner, len(part) - inner + edge) + edge
                        if best is None or cost < best[0]:
                            best = cost, int(v), mu, d
        if best is None or best[0] >= 1.6 * len(part):
            done += 1
            if parent >= 0:
                nodes[parent][2 + side] = -done
            continue
        _, v, mu, d = best
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        share = (d <= mu).sum() / len(part)
        left = max(1, round(want * share))
        parts += [(part[d <= mu], left, len(nodes), 0), (part[d > mu], max(1, want - left), len(nodes), 1)]
        nodes.append([v, mu, 0, 0])
    return [tuple(n) for n in nodes]


def leaves_of(x: np.ndarray, nodes: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that a value's pairs of distance 1 can lie in: its own, and those
    across a boundary that it lies just inside of."""
    rows, out = np.arange(len(x)), []
    todo = [(0, rows)] if nodes else [(-1, rows)]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            out.append((rows, np.full(len(rows), -at - 1)))
            continue
        v, mu, inner, outer = nodes[at]
        d = _distance(x[rows], v)
        todo += [(inner, rows[d <= mu]), (outer, rows[d >= mu])]
    return (np.concatenate([r for r, _ in out]), np.concatenate([k for _, k in out])) if out else (rows[:0], rows[:0])


def _chain(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins i and j in a forest where a parent is never larger than its child."""
    while len(i):
        a, b = parent[i], parent[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(parent, high, low)
        while (up := parent[parent] != parent).any():
            parent[up] = parent[parent[up]]
        open_ = parent[i] != parent[j]
        i, j = i[open_], j[open_]


def connected(fp: np.ndarray, radius: int = RADIUS, small: int = 256, block: int = 2048) -> np.ndarray:
    """For each of the distinct fingerprints, the row of the least one that links within them reach."""
    order = np.argsort(fp)
    fp, parent = fp[order], np.arange(len(fp))
    todo, rng = [np.arange(len(fp))], np.random.default_rng(5)
    while todo:
        part = todo.pop()
        if len(part) > small:
            v = fp[rng.choice(part)]
            d = _distance(fp[part], v)
            mu = int(np.median(d))
            inner, outer = part[d <= mu], part[d > mu - radius]
            if max(len(inner), len(outer)) < 0.9 * len(part):
                todo += [inner, outer]
                continue
            # no vantage point divides a dense group; what is within the radius of one is connected through it
            ball, rest = part[d <= radius], part[d > radius]
            if 64 * len(ball) > len(part):
                _chain(parent, ball[:-1], ball[1:])
                open_ = part[(d > radius) & (d <= 2 * radius)]
                for a in range(0, len(ball), small):
                    near = (np.bitwise_count(fp[open_][:, None] ^ fp[ball[a : a + small]][None, :]) <= radius).any(1)
                    _chain(parent, open_[near], np.full(near.sum(), ball[0]))
                    open_ = open_[~near]
                todo.append(rest)
                continue
        for a in range(0, len(part), block):
            x = fp[part[a : a + block]]
            for b in range(a, len(part), block):
                i, j = np.nonzero(np.bitwise_count(x[:, None] ^ fp[part[b : b + block]][None, :]) <= radius)
                i, j = part[a + i], part[b + j]
                _chain(parent, i[i < j], j[i < j])
    root = np.empty(len(fp), np.int64)
    root[order] = order[parent]
    return root


def links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE, block: int = 16 * SHARD) -> DataFrame:
    """(a, b) with a < b that connect distinct fingerprints ``fps`` (fp) just as all pairs within ``radius`` do.

    The trees are fitted on about ``sample`` fingerprints, drawn by hash; every fingerprint is searched.
    No shard is much larger than two blocks.
    """
    if radius != 3:
        raise ValueError("two halves with radius 1 answer for radius 3")
    n = fps.count()
    draw = F.pmod(F.xxhash64("fp", F.lit(11)), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30))
    drawn = np.array([r.fp for r in fps.where(draw).select("fp").collect()], np.int64).view(np.uint64)
    rng, low = np.random.default_rng(3), np.uint64(0xFFFFFFFF)
    leaves = max(1, n // shard)
    trees = [fit_tree(drawn & low, leaves, rng), fit_tree(drawn >> np.uint64(32), leaves, rng)]

    def deal(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            fp = frame.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for t, (tree, half) in enumerate(zip(trees, (fp & low, fp >> np.uint64(32)))):
                rows, leaf = leaves_of(half, tree)
                yield pa.RecordBatch.from_arrays([pa.array(leaf * 2 + t), pa.array(fp[rows].view(np.int64))], ["shard", "fp"])

    def search(rows: pa.Table) -> pa.Table:
        fp = rows["fp"].to_numpy().view(np.uint64)
        root = connected(fp)
        at = np.flatnonzero(root != np.arange(len(fp)))
        # neighbours in a chain rather than a star: no fingerprint gets more than two links from a shard
        at = np.concatenate([np.flatnonzero(np.bincount(root[at], minlength=len(fp)) > 0), at]).astype(np.int64)
        group = root[at]
        order = np.lexsort((fp[at].view(np.int64), group))
        at, group = at[order], group[order]
        same = group[1:] == group[:-1]
        return pa.table({"a": fp[at[:-1][same]].view(np.int64), "b": fp[at[1:][same]].view(np.int64)})

    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), leaves // 16)
    dealt = stored(fps.select("fp").mapInArrow(deal, "shard long, fp long"))
    heavy = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    parts = dealt.join(heavy, "shard", "left").withColumn("own", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp", F.lit(17)), F.col("blocks")).cast("int")).otherwise(0))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    parts = parts.withColumn("other", other).select("shard", "fp", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    return parts.repartition(tasks, "shard", "p", "q").groupBy("shard", "p", "q").applyInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(node, root): the least node that each node of (a, b) reaches.

    Each round every node takes the least label among its neighbours, the label's own node takes
    it too, and labels are followed once. Rounds are written to the shared folder; their number
    grows with the logarithm of the longest chain. Aggregates combine before they shuffle.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    for _ in range(most_rounds):
        near = both.join(labels, both.a == labels.node).select(F.col("b").alias("node"), "root")
        own = near.groupBy("node").agg(F.min("root").alias("least")).join(labels, "node").select("node", "root", F.least("least", "root").alias("least"))
        hooked = own.select("node", "least").union(own.where("least < root").select(F.col("root").alias("node"), "least")).groupBy("node").agg(F.min("least").alias("least"))
        up = hooked.select(F.col("node").alias("up"), F.col("least").alias("above"))
        new = stored(hooked.join(up, hooked.least == up.up).select("node", F.col("above").alias("root")))
        moved = new.join(labels.withColumnRenamed("root", "was"), "node").where("root <> was").limit(1).count()
        labels = new
        if not moved:
            return labels
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, fp and component_id of every row; documents link at 3 or fewer differing bits.

    Copies of a fingerprint are one node of the search, so a group of copies costs its rows only.
    Rows with a repeated or null doc_id keep a row each. component_id is the smallest doc_id that
    links reach; documents without words share fingerprint 0 and are linked like others.
    """
    docs = docs.withColumn("doc_id", F.col(id_col)) if id_col != "doc_id" else docs
    rows = stored(fingerprints(docs))
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(fps))
    # every fingerprint with its group's least doc_id
    group = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = group.groupBy("root").agg(F.min("first").alias("component_id"))
    known = stored(group.join(least, "root").select("fp", "component_id"))
    return rows.join(known, "fp").select("doc_id", "fp", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with the smallest doc_id of each group of near-duplicates.

    Rows that repeat such a doc_id are one; rows without a doc_id cannot be named and stay.
    """
    found = stored(near_duplicates(docs))
    least = found.where("doc_id = component_id").select("doc_id")
    out = docs.join(least.distinct(), "doc_id", "left_semi")
    if not least.groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id"])
    return out.unionByName(docs.where("doc_id is null")).select(*docs.columns)
