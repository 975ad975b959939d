import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sigtrack.llm import centroids, collocations, scaled_sketch


def brute_sketch(text, scale=8, whole=64):
    """The definition in Python's own integers."""
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    size, mask = min(5, len(words)), (1 << 64) - 1
    found = set()
    for i in range(len(words) - size + 1 if words else 0):
        h = 0
        for w in words[i : i + size]:
            h = (h * 0x9E3779B97F4A7C15 + xxh64_intdigest(w.encode())) & mask
        h = (h + size) & mask
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = ((h ^ (h >> 33)) * factor) & mask
        found.add(h ^ (h >> 33))
    if len(found) <= whole:
        return 1, found
    return scale, {h for h in found if h < (1 << 64) // scale}


def brute_containment(a, b):
    if a == b:
        return 1.0
    scale = max(a[0], b[0])
    x, y = ({h for h in s if h < (1 << 64) // scale} for _, s in (a, b))
    return len(x & y) / len(x) if x else 0.0


def texts():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    long = [" ".join(rng.choice(vocabulary, n)) for n in (3000, 400, 100, 30, 7, 3)]
    return long + [long[1], long[0][:6000], None, "", " \t\n", "É ÀB x y \U0001f600 z", "one\x0btwo", long[1]]


def documents(spark):
    made = [(i * 3, t, "s", 1, 2) for i, t in enumerate(texts())] + [(None, "no id here at all", "s", 1, 2), (3, "another third text", "s", 1, 2), (3, None, "s", 1, 2)]
    return spark.createDataFrame(made, "doc_id long, text string, edge string, part int, row int")


@pytest.mark.parametrize("partitions", [1, 7])
def test_fingerprints_of_documents_and_edited_texts(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = scaled_sketch.edited_documents(documents(spark).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = documents(spark).withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary"))).orderBy("doc_id", "h").collect()
    want = []
    for i, r in enumerate(order):
        text, after = r.text or "", order[i - 1].text or ""
        moved = len(text) // 3
        edited = text[: len(text) - moved] + after[:moved]
        own, changed, other = map(brute_sketch, (text, edited, after))
        as_bytes = lambda s: b"".join(h.to_bytes(8, "big") for h in sorted(s))
        want.append((r.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own[0], as_bytes(own[1]), changed[0], as_bytes(changed[1]), brute_containment(own, changed), brute_containment(own, other)))
    assert sorted(map(repr, want)) == sorted(repr(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)) for r in got)


def test_sketches_of_no_and_of_one_document(spark):
    docs = documents(spark)
    assert scaled_sketch.edited_documents(docs.limit(0)).count() == 0
    (one,) = scaled_sketch.edited_documents(docs.where("doc_id = 0")).collect()
    assert one.near_next == 1.0 and 0.4 < one.near_edited < 0.9


def test_merged_sketches_tell_what_they_contain(spark):
    docs = documents(spark)
    found = scaled_sketch.sketches(docs.where("doc_id <> 3")).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "even"))
    groups = scaled_sketch.merged(found, ["source"])
    union = defaultdict(lambda: (1, set()))
    plain = {}
    for r in docs.where("doc_id <> 3").collect():
        s = plain[r.doc_id] = brute_sketch(r.text or "")
        key = "even" if r.doc_id % 2 == 0 else None
        union[key] = max(union[key][0], s[0]), union[key][1] | s[1]
    union = {k: (s, {h for h in v if h < (1 << 64) // s}) for k, (s, v) in union.items()}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    assert rows(groups) == sorted(((k, s, signed(h)) for k, (s, v) in union.items() for h in v), key=repr)
    named = groups.where("source is not null")
    got = {r.doc_id: (r.hits, r.n) for r in scaled_sketch.contained(found, named, ["source"]).collect()}
    scale, held = union["even"]
    at = {d: {h for h in s if h < (1 << 64) // max(scale, k)} for d, (k, s) in plain.items()}
    assert got == {d: (len(s & held), len(s)) for d, s in at.items() if s & held}


def test_estimates_are_near_the_truth(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(5000)]
    base = list(rng.choice(words, 4000))
    part, whole = " ".join(base[:1000]), " ".join(base)
    known = scaled_sketch._WordHashes()
    a, b = (scaled_sketch.sketch(scaled_sketch.shingle_hashes(t.encode(), known)) for t in (part, whole))
    assert scaled_sketch.containment(a, b) == 1.0 and abs(scaled_sketch.containment(b, a) - 0.25) < 0.06


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    stream = np.concatenate([rng.zipf(1.3, 30_000).astype(np.uint64) % np.uint64(5000), rng.integers(0, 1 << 40, 20_000, dtype=np.uint64)])
    rng.shuffle(stream)
    keys, counts = np.unique(stream, return_counts=True)
    for pieces, room in ((1, 1), (3, 1), (17, 1), (400, 1), (17, 4), (400, 8)):
        parts = [(*(x.astype(t) for x, t in zip(np.unique(p, return_counts=True), (np.uint64, np.int64))), len(p)) for p in np.array_split(stream, pieces)]
        found, estimate, off = collocations.summarized(parts, 30, room)
        assert len(found) <= room * len(stream) // 30 + 1 and off * room < 30
        assert set(keys[counts >= 30].tolist()) <= set(found[estimate + off >= 30].tolist())
        true = dict(zip(keys.tolist(), counts.tolist()))
        assert all(true[k] - off <= e <= true[k] for k, e in zip(found.tolist(), estimate.tolist()))


def test_summaries_are_packed_without_loss():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64))
    counts = np.arange(len(keys)) ** 3
    for k, c in ((keys, counts), (keys[:0], counts[:0]), (np.array([(1 << 64) - 1], np.uint64), counts[:1])):
        got = collocations.decoded(collocations.encoded(k, c))
        assert (got[0] == k).all() and (got[1] == c).all()


def test_merging_many_summaries_takes_as_long_as_merging_a_few(monkeypatch):
    rng = np.random.default_rng(4)
    merged = []
    add = collocations.added
    monkeypatch.setattr(collocations, "added", lambda *parts: (out := add(*parts), merged.append(len(out[0])))[0])
    for n_parts in (10, 400):
        parts = [np.unique(rng.integers(0, 1 << 40, 40_000 // n_parts, dtype=np.uint64), return_counts=True) for _ in range(n_parts)]
        merged.clear()
        collocations.summarized([(k, c, int(c.sum())) for k, c in parts], 30)
        assert sum(merged) < 8 * 40_000


@pytest.mark.parametrize("top", [1 << 20, (1 << 64) - 1])
def test_added_summaries(top):
    rng = np.random.default_rng(6)
    keys = rng.integers(0, top, 50, dtype=np.uint64)
    parts = [np.unique(rng.choice(keys, 30), return_counts=True) for _ in range(5)] + [(keys[:0], np.zeros(0, np.int64)), (keys[:1], np.array([1 << 40]))]
    want = Counter()
    for k, c in parts:
        want.update(dict(zip(k.tolist(), c.tolist())))
    k, c = collocations.added(parts)
    assert list(zip(k.tolist(), c.tolist())) == sorted(want.items())


def test_hashes_of_words_of_any_length():
    low = "abcdefgh" * 30
    differ = [low[:n] for n in range(1, 240)] + [low[:n] + "\u00e9" + low[n:120] for n in range(120)]
    (words,) = collocations.chunks([pa.record_batch({"text": pa.array(["  ".join(differ).encode(), b"", "!".join(differ[::-1]).encode().upper()]), "lang": ["aa", "bb", "bb"]})])
    h = collocations.word_hashes(words)
    assert len(set(h.tolist())) == len(differ) and (h[: len(differ)] == h[len(differ) :][::-1]).all() and words.langs == ["aa", "bb"]
    spelled = words.phrases(np.array([0, 5, len(differ)]), np.array([2, 1, 1])).to_pylist()
    assert spelled == [b"a ab", b"abcdef", (low[:119] + "\u00e9" + low[119:120]).encode()]
    assert [len(s) for _, s, _ in collocations.ngram_hashes(words, 3)] == [2 * len(differ), len(differ) - 1, len(differ) - 2]


def phrase_rows():
    rng = np.random.default_rng(8)
    words = ["Alpha", "beta", "GAMMA", "delta", "é", "É", "x y", "(b)", "o'k"]
    made = []
    for i in range(400):
        text = "".join(rng.choice(words, p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"], p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.05, 0.03, 0.02]) for _ in range(rng.integers(0, 40)))
        made.append((i, text, [None, "und", "aa", "bb"][i % 4], 7))
    return made + [(None, None, "aa", 7), (5, "", None, 7), (6, "never again never again", "cc", 7), (7, None, "dd", 7)]


def brute_collocations(made, least, top, longest=4):
    count, total = Counter(), Counter()
    for _, text, lang, _ in made:
        low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    count[lang or "und", tuple(w[i : i + n])] += 1
    candidates = {k: a for k, a in count.items() if a >= least and len(k[1]) > 1}
    longer = Counter()
    for (lang, w), a in candidates.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                longer[lang, w[i : i + n]] = max(longer[lang, w[i : i + n]], a)
    out = defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * longer[lang, w] < 80 * a:
            score, k = min((2_000_000 * a // (count[lang, w[:k]] + count[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    return sorted(repr((lang, i + 1, p.decode(), -a, left, right, total[lang], -score)) for lang, found in out.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def test_collocations(spark, monkeypatch):
    made = phrase_rows()
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, f int")
    for least, top, partitions in ((3, 2000, 5), (30, 7, 1), (12, 40, 2)):
        got = collocations.collocations(docs.repartition(partitions), least=least, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == brute_collocations(made, least, top)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_exact_counts_need_no_filter(spark):
    docs = spark.createDataFrame(phrase_rows(), "doc_id long, text string, lang string, f int").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found, key_bits = collocations.survivors(docs, 12, 4, 20_000)
    with_filter = collocations.exact_counts(docs, collocations.survivor_filter(found, key_bits), 12, 4, most=50)
    narrow = collocations.exact_counts(docs, collocations.survivor_filter(found, key_bits, most_bits=3), 12, 4)
    without = collocations.exact_counts(docs, (b"\xff" * 4, 5), 12, 4)
    assert rows(with_filter) == rows(without) == rows(narrow) and with_filter.count() > 20


def brute_lloyd(made, k, rounds, dims=64):
    kept = [(i, [int(np.floor(256 * float(x))) for x in e]) for i, e in made if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda v: (hashlib.sha256(f"2:{v[0]}".encode()).hexdigest() if v[0] is not None else "~", v[1]))
    c = [q for _, q in order[:k]]
    near = lambda q: min((sum((x - y) ** 2 for x, y in zip(q, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, q in kept:
            own[near(q)[1]].append(q)
        for j, members in own.items():
            c[j] = [sum(col) // len(members) for col in zip(*members)]
    return [(i, near(q)[1], near(q)[0]) for i, q in kept], c


def vectors(spark, n=300):
    rng = np.random.default_rng(9)
    made = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 1, 64)]) for i in rng.permutation(n)]
    made += [made[0], (made[1][0], made[2][1]), (None, made[3][1]), (900, None), (901, [float("nan")] * 64), (902, made[4][1][:63]), (903, [None] * 64), (904, [float("inf")] * 64), (905, [0.0] * 64), (906, [])]
    return made, spark.createDataFrame([(*r, 1, "x") for r in made], "vec_id long, embedding array<float>, block int, cells string")


@pytest.mark.parametrize("k, block", [(40, 16), (7, 24), (400, 64)])
def test_lloyd_rounds(spark, k, block):
    made, df = vectors(spark)
    found, c = centroids.lloyd(df.repartition(3), k=k, block=block)
    want, slices = brute_lloyd(made, k, 5)
    assert rows(found) == sorted(want, key=repr)
    whole = defaultdict(list)
    for r in c.orderBy("cluster", "block").collect():
        whole[r.cluster] += r.slice
    assert [whole[j] for j in sorted(whole)] == slices


def test_lloyd_without_vectors(spark):
    _, df = vectors(spark, 5)
    found, c = centroids.lloyd(df.where("vec_id > 900"), k=3)
    assert found.count() == 1 and c.select("cluster").distinct().count() == 1
    found, c = centroids.lloyd(df.limit(0), k=3)
    assert found.count() == 0 and c.count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.lloyd(spark.createDataFrame([(1, [1e7] * 64)], "vec_id long, embedding array<double>"))
