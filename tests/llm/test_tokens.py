import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sigtrack.llm import packing, repair
from sigtrack.llm.wordbpe import encoded, encoder, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
EDGE = [(5, "Same text."), (5, "Same text."), (3, None), (None, "no id"), (7, ""), (9, 'quote " and <|endoftext|> a\x1cb\n\n'), (1, "long words " * 9000), (2, "ÀÉß ǅ ﬁ 日本 don't I'LL 12½")]
DOCS = "doc_id long, text string, ids string, part int, start long"


def edge(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in EDGE], DOCS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab 'sS.,\n\t\x1c\x85 ́Éß")), max_size=40), max_size=6))
def test_encoder_equals_the_library(texts):
    flat, lengths = encoder(PATH).encode(texts)
    got = np.split(flat, np.cumsum(lengths)[:-1]) if texts else []
    assert [list(g) for g in got] == [encoder(PATH).whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_go_through_the_library():
    path = tokenizer_path("byte_bpe_50k.json")
    assert [list(x) for x in encoded(path, ["a b", None], 7)] == [[*encoder(path).whole.encode("a b", add_special_tokens=False).ids, 7], [7]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=80), min_size=1, max_size=8))
def test_repair_round_trip(docs):
    ids = [np.array([*d, 1], np.uint16) for d in docs]
    b = repair.read_block(repair.write_block([*range(len(ids))], ids, 50, 1))
    flat = np.concatenate(ids)
    assert all((b.document(k) == x).all() for k, x in enumerate(ids))
    for start in range(0, len(flat), 7):
        assert (b.tokens(start, 11) == flat[start : start + 11]).all()
    sym, rules = repair.compress(flat, 50, 99, least=2)
    assert (repair.expand(sym, rules, 50) == flat).all()
    assert repair.rule_lengths(rules, 50).sum() == sum(len(repair.expand(np.array([50 + i]), rules, 50)) for i in range(len(rules)))


def test_repair_shortens():
    sym, rules = repair.compress(np.array([3, 4, 5, 6] * 500, np.uint16), 50, 1)
    assert len(sym) < 50 and len(rules)


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(3)
    flat = np.concatenate([np.tile(rng.integers(2, 40, 30), 60), rng.integers(2, 40, 4000)]).astype(np.uint32)
    sym, rules = repair.compress(flat, 50, 1, least=24)
    assert (repair.expand(sym, rules, 50) == flat).all()
    assert repair.rule_lengths(rules, 50).max() >= 8
    for pair, n in Counter(zip(sym.tolist(), sym[1:].tolist())).items():
        assert n < 24 or pair[0] == pair[1]  # a run's pairs overlap


def test_written_ids_read_back(spark):
    got = {}
    path = repair.write_ids(edge(spark), "word_bpe_49k.json", 1, block_tokens=50)
    for r in repair.read_ids(spark, path).orderBy("start").collect():
        got.setdefault(r.doc_id, []).append(r)
    want, at = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), 0
    flat = [r for rs in sorted(got.values(), key=lambda rs: rs[0].start) for r in rs]
    for (doc, text), r in zip(want, flat, strict=True):
        ids = np.array([*encoder(PATH).whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids), zlib.crc32(ids))
        at += len(ids)
    assert repair.read_ids(spark, repair.write_ids(edge(spark).limit(0), "word_bpe_49k.json", 1)).count() == 0


@pytest.mark.parametrize("sizes", [[], [5], [10, 10], [3, 7, 6, 4, 5, 5, 1]])
def test_first_fit_decreasing_equals_the_plain_one(sizes):
    plain, room = [0] * len(sizes), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        room += [10] * (b == len(room))
        room[b] -= sizes[i]
        plain[i] = b
    assert packing.first_fit_decreasing(sizes, 10) == plain


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=30))
def test_groups_hold_every_token_once(sizes):
    found = packing.pack_group([(0, n) for n in sizes], 16)
    for r, n in enumerate(sizes):
        own = sorted((a, a + k) for row, a, k, _, _ in found if row == r)
        assert own[0][0] == 0 and own[-1][1] == n and all(x[1] == y[0] for x, y in zip(own, own[1:]))
    fill = {}
    for _, _, n, s, at in sorted(found, key=lambda f: f[3:]):
        assert fill.get(s, 0) == at
        fill[s] = at + n
    assert sum(n < 16 for n in fill.values()) <= 1 and all(n <= 16 for n in fill.values())


def test_packed_documents(spark):
    pieces = packing.pack(edge(spark), group_docs=3).collect()
    texts = {}
    for d, t in EDGE:
        texts.setdefault(d, []).append(np.array([*encoder(PATH).whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    assert {p.doc_id for p in pieces} == set(texts)
    assert sum(p.length for p in pieces) == sum(len(x) for xs in texts.values() for x in xs)
    for p in pieces:
        assert any(len(x) == p.doc_tokens and x[p.start : p.start + p.length].tobytes() == bytes(p.ids) for x in texts[p.doc_id])
    assert packing.with_checksum(packing.pack(edge(spark).limit(0))).count() == 0


def test_groups_follow_bytes_and_spread_repeated_ids(spark):
    from pyspark.sql import functions as F

    long_docs = spark.createDataFrame([(i, "word list " * 40_000) for i in range(3)], "doc_id long, text string")
    out = packing.pack(long_docs, group_bytes=200_000).selectExpr("doc_id", "start", "length", "doc_tokens", "sequence_id >> 32 as g").collect()
    assert len({r.g for r in out}) > 3 and sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())
    for doc in (5, None):
        same = spark.range(0, 100_000, 1, 4).select(F.lit(doc).cast("long").alias("doc_id"), F.lit("a b").alias("text"))
        sizes = packing.pack(same, group_docs=5000).groupBy(F.expr("sequence_id >> 32").alias("g")).agg(F.sum("length").alias("n")).collect()
        assert sum(r.n for r in sizes) == 300_000 and len(sizes) > 15 and max(r.n for r in sizes) < 30_000
