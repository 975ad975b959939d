from decimal import Decimal

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from sigtrack.llm import embeddings, simhash


def closure(linked):
    comp = np.arange(len(linked))
    while True:
        new = np.where(linked | np.eye(len(linked), dtype=bool), comp[None, :], len(comp)).min(1)
        if (new == comp).all():
            return comp
        comp = new


def near_fingerprints(n=1500, seed=1):
    """Random ones, chains of neighbours and one dense group."""
    rng = np.random.default_rng(seed)
    x = list(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    flip = lambda v, k: v ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64))
    for _ in range(300):
        x.append(flip(x[rng.integers(len(x))], int(rng.integers(1, 6))))
    centre = x[0]
    x += [flip(centre, int(rng.integers(1, 4))) for _ in range(600)]
    return np.unique(np.array(x, np.uint64))


def test_fingerprints_within_a_shard():
    fp = near_fingerprints()
    want = closure(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    for small in (16, 256, 5000):
        assert (simhash.connected(fp, small=small, block=100) == want).all()


def test_trees_lose_no_pair():
    fp = near_fingerprints(seed=2)
    pairs = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3, 1))
    rng, low = np.random.default_rng(0), np.uint64(0xFFFFFFFF)
    met = np.zeros(len(pairs), bool)
    for half in (fp & low, fp >> np.uint64(32)):
        tree = simhash.fit_tree(half[:400], 40, rng)
        assert len(tree) > 5
        where = [set() for _ in fp]
        for r, leaf in zip(*simhash.leaves_of(half, tree)):
            where[r].add(leaf)
        met |= [bool(where[a] & where[b]) for a, b in pairs]
    assert met.all()


def test_links_and_components(spark):
    fp = near_fingerprints(700, 3)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df, shard=100, sample=500)).collect()}
    in_blocks = {r.node: r.root for r in simhash.components(simhash.links(df, shard=100, sample=500, block=60)).collect()}
    assert in_blocks == found
    want = closure(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    groups = {}
    for i, c in enumerate(want):
        groups.setdefault(c, []).append(int(fp.view(np.int64)[i]))
    for members in groups.values():
        if len(members) > 1:
            assert {found[m] for m in members} == {min(members)}
        else:
            assert members[0] not in found


def test_long_chains_settle(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert rows(simhash.components(edges).select("root").distinct()) == [(0,)]


WORDS = " ".join(f"w{i}" for i in range(400))


def test_documents(spark):
    data = [(4, WORDS), (2, WORDS.upper()), (9, WORDS + " tail"), (7, "one two"), (7, "one two"), (8, None), (3, ""), (11, " \t\n"), (None, "alone here now then"), (5, "Ä Ö"), (6, "Ä Ö")]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in data], "doc_id long, text string, fp string, node int, root int")
    got = simhash.near_duplicates(df).collect()
    comp = {r.doc_id: r.component_id for r in got}
    assert len(got) == len(data) and comp[4] == comp[2] == 2 and comp[8] == comp[3] == comp[11] == 3 and comp[7] == 7 and comp[5] == 5 and comp[6] == 6
    assert {r.doc_id: r.fp for r in got}[8] == 0
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df.drop("fp", "node", "root"))
    assert kept.columns == ["doc_id", "text"] and kept.where("doc_id = 7").count() == 1 and kept.where("doc_id is null").count() == 1


def test_fingerprints_against_the_contract(spark):
    import re

    import xxhash

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rng = np.random.default_rng(9)
    texts = [None, "", " \t", "One", "one TWO", "Ärger ÄRGER İi", "a b c", "a b c d", "x " * 400, "line\x0bfeed\x1cend\x85of\u00a0words\u2003here now"]
    texts += [" ".join(rng.choice(["Foo", "bar", "été", "日本", "Q"], int(n))) for n in rng.integers(1, 60, 40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.fp % (1 << 64) for r in simhash.fingerprints(df).collect()} == {i: plain(t) for i, t in enumerate(texts)}


def test_fingerprint_in_chunks():
    words = [b"a%d" % (i % 37) for i in range(5000)]
    assert simhash.fingerprint_of(words) == simhash.fingerprint_of(words, chunk=64)


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 16))
    x[100:220] = x[0] + 0.05 * rng.normal(size=(120, 16))
    x[300:330] = x[301]
    label = rng.integers(0, 2, 500)
    label[100:220] = label[0]
    data = [(int(i), [float(v) for v in x[i]], int(label[i])) for i in range(500)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, [float("inf")] * 16, 1), (905, data[0][1], None), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0), (908, [], 0), (909, [1e300] * 16, 0), (910, [1e-300] * 16, 0)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>, label int").withColumn("h", F.lit("x")).withColumn("node", F.lit(0))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    comp = closure(linked)
    for cell, block in ((2000, 4096), (40, 16)):
        got = {r.vec_id: r for r in embeddings.near_duplicates(df, cell=cell, block=block).collect()}
        assert len(got) == 511
        for i in range(500):
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (linked[i].sum(), comp[i], comp[i] == i), i
        assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903, 904, 905, 908))
        assert got[907].component_id == 906 and got[910].component_id == 909
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_with_null_and_repeated_ids(spark):
    u, v, w = [1.0, 0.0], [0.0, 1.0], [0.999, 0.001]
    data = [(5, v, 1), (5, u, 1), (6, w, 1), (None, u, 1), (None, [-1.0, 0.0], 1), (None, [-2.0, 0.0], 1), (7, None, 1), (7, v, 1), (8, [0.0, -1.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = sorted(embeddings.near_duplicates(df).collect(), key=repr)
    want = [(5, 1, 5, True), (5, 2, 5, True), (6, 2, 5, False), (None, 2, 5, False), (None, 1, None, True), (None, 1, None, True), (7, 0, 7, True), (7, 1, 5, False), (8, 0, 8, True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_cells_of_many_centres_in_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = embeddings.spherical_kmeans(x, 20)
    whole = sorted(zip(*map(list, embeddings.cells_of(x, centres, 0.98))))
    monkeypatch.setattr(embeddings, "_chunks", lambda n, width: range(0, n, 7))
    assert sorted(zip(*map(list, embeddings.cells_of(x, centres, 0.98)))) == whole and np.allclose(embeddings.spherical_kmeans(x, 20), centres)


def test_labels_of_any_type(spark):
    data = [(1, "1.2"), (2, "1.7"), (3, "x"), (4, "x"), (5, None), (6, "1.2")]
    for kind, label in (("string", str), ("double", lambda v: -0.0 if v == "x" else float(v)), ("decimal(3,1)", lambda v: Decimal("9") if v == "x" else Decimal(v)), ("struct<a:string>", lambda v: (v,)), ("boolean", lambda v: v != "x")):
        made = [(i, label(v) if v is not None else None, [1.0, 2.0]) for i, v in data]
        df = spark.createDataFrame(made, f"vec_id long, label {kind}, embedding array<float>")
        got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
        assert got[3] == got[4] == (1, 3) and got[5] == (0, 5)
        assert got[1] == got[6] == ((2, 1) if kind == "boolean" else (1, 1)) and got[2] == ((2, 1) if kind == "boolean" else (0, 2)), kind


def test_zeros_of_either_sign_are_one_label(spark):
    df = spark.createDataFrame([(1, 0.0, [1.0]), (2, -0.0, [1.0])], "vec_id long, label double, embedding array<float>")
    assert [r.n_links for r in embeddings.near_duplicates(df).collect()] == [1, 1]
