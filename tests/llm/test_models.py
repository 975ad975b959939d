import itertools
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigtrack.llm import langid, quality
from sigtrack.llm.crf import Chain, fit


def brute(scores, chain):
    """All labellings of one sequence with their log-weights."""
    n, k = scores.shape
    for labels in itertools.product(range(k), repeat=n):
        w = chain.start[labels[0]] + sum(scores[i, y] for i, y in enumerate(labels)) + sum(chain.transitions[a, b] for a, b in zip(labels, labels[1:]))
        yield labels, w


@pytest.mark.parametrize("chunk", [1, 2, 3, 256])
def test_forward_backward_and_viterbi(chunk):
    rng = np.random.default_rng(chunk)
    chain = Chain(rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = [4, 1, 5, 2]
    scores = rng.normal(size=(sum(lengths), 3)) * 3
    first = np.zeros(len(scores), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    post, pairs = chain.marginals(scores, first, chunk=chunk, pairs=True)
    at, expected = 0, np.zeros((3, 3))
    for n in lengths:
        own = list(brute(scores[at : at + n], chain))
        z = np.exp([w for _, w in own]).sum()
        want = np.zeros((n, 3))
        for labels, w in own:
            for i, y in enumerate(labels):
                want[i, y] += np.exp(w) / z
            for a, b in zip(labels, labels[1:]):
                expected[a, b] += np.exp(w) / z
        assert np.allclose(post[at : at + n], want, atol=1e-4)
        assert tuple(chain.viterbi(scores[at : at + n].tolist())) == max(own, key=lambda x: x[1])[0]
        at += n
    assert np.allclose(pairs, expected, atol=1e-3)
    assert chain.viterbi([]) == [] and len(chain.marginals(scores[:0], first[:0])) == 0


def test_fit_learns_transitions():
    labels = np.array([0, 0, 0, 1, 1, 1] * 50)
    items = labels ^ (np.arange(300) % 7 == 0)
    first = np.arange(300) % 6 == 0
    w, chain = fit(np.array([0, 1]), np.array([0, 1]), 2, items, labels, first, 2, steps=60)
    assert w[0, 0] > w[0, 1] and chain.transitions[0, 0] > chain.transitions[1, 0]


TEXTS = {"aa": "alpha bravo anna ", "bb": "zulu xray yoyo "}


def corpus(spark, n=40):
    data = [(i, TEXTS[lang] * 5, lang) for i in range(n) for lang in [("aa", "bb")[i % 2]]]
    data += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !!", "bb"), (1003, "zulu " * 20, None), (1003, "zulu " * 20, None), (None, "alpha bravo", None), (1004, "ALPHA, bravo!" * 30000, "aa")]
    return spark.createDataFrame([(*r, "x", 0.5) for r in data], "doc_id long, text string, lang string, source string, score double")


def test_language_of_edge_texts(spark):
    docs = corpus(spark)
    model = langid.fitted(docs)
    assert model.langs == ["aa", "bb"]
    got = langid.identify(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and by[1000].score == 0
    assert by[1003].lang_pred == "bb" and by[1004].lang_pred == "aa" and by[None].lang_pred == "aa"
    assert all(by[i].lang_pred == ("aa", "bb")[i % 2] for i in range(40))
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert {r.lang for r in kept.where("doc_id = 1003").collect()} == {"bb"}  # the predicted one
    mixed = spark.createDataFrame([(1, "alpha bravo anna zulu xray yoyo zulu xray " * 9, "aa"), (2, "alpha bravo anna zulu " * 9, "bb")], "doc_id long, text string, lang string")
    assert {(r.doc_id, r.lang) for r in langid.accepted(mixed, model, 0.7).collect()} == {(2, "aa")}
    nothing = langid.fitted(docs.where("lang is null"))
    assert nothing is None and rows(langid.identify(docs, None).select("lang_pred").distinct()) == [("und",)]
    assert langid.accepted(docs, None).count() == docs.count() - 3
    assert langid.identify(docs.limit(0), model).count() == 0


def test_words_switch_language():
    model = langid.learn([(TEXTS[k] * 5, k) for k in TEXTS] * 20)
    s = langid.Scorer(model)
    mean, n = s.posteriors(["alpha bravo anna zulu", "zulu xray yoyo alpha", ""])
    assert mean.argmax(1)[:2].tolist() == [0, 1] and n.tolist() == [4, 4, 0]
    again, _ = s.posteriors(["alpha bravo anna zulu"])
    assert np.allclose(again[0], mean[0], atol=1e-5)


def test_held_out_is_not_learned_from(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(langid.held_out(F.col("id")), "out").otherwise("in").alias("lang"))
    sample = langid.training_sample(docs)
    assert {lang for _, lang in sample} == {"in"} and 200 < len(sample) < 330


def test_word_features_see_letters_only():
    h, owner, letters = langid.word_features(["the.", "THE", "12", "été", "x", ""])
    assert letters.tolist() == [True, True, False, True, True, False]
    own = lambda i: sorted(h[owner == i].tolist())
    assert own(0) == own(1) and own(0) != own(3) and own(2) == own(5) == []


def plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t#|é ", max_size=120))
def test_base_counts(text):
    assert quality.base_counts(text) == plain_counts(text)


GOOD, BAD = "A line of plain words that goes on like this one. ", "BUY!! NOW!! $$$ ### "


def test_lines_have_labels_of_their_own():
    rng = np.random.default_rng(2)
    prose = lambda: " ".join("abcdefghij"[int(k)] * int(k + 2) for k in rng.integers(0, 9, 12)) + "."
    junk = lambda: " ".join(f"{w}{m}" for w, m in zip(prose().upper().split(), ["$$$", "!!", "###"] * 4))
    good = ["\n".join(prose() for _ in range(6)) for _ in range(60)]
    bad = ["\n".join([prose(), *(junk() for _ in range(4)), prose()]) for _ in range(60)]
    model = quality.learn([(t, 1) for t in good[:40]] + [(t, 0) for t in bad[:40]])
    assert (quality.content_shares(good[40:], model) == 1).all()
    shares = quality.content_shares(bad[40:], model)
    assert ((shares > 0.2) & (shares < 0.5)).all()  # two of six lines are content
    assert (quality.content_shares(["\n".join(junk() for _ in range(5))], model) == 0).all()


def test_quality_sample_is_bounded(spark):
    docs = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(500).select((F.col("id") % 3).alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert 0 < len(quality.training_sample(docs, labels, 240)) <= 960
    long_only = spark.createDataFrame([(i, f"zz{i} " * 9000, "zz") for i in range(30)], "doc_id long, text string, lang string")
    assert {lang for _, lang in langid.training_sample(long_only)} == {"zz"}
    same = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 900).cast("string")).alias("text"), F.lit("a").alias("lang"))
    assert 5 < len(langid.training_sample(same, 50)) <= 100


def test_quality_verdicts(spark):
    texts = [(i, (GOOD * 3 + f"Unit {i} of it has words of its own kind so far.\n") if i % 2 else "\n".join(BAD + f"X{i}Y{k}!! Z{k}A{i}$$$" for k in range(6))) for i in range(60)]
    texts = [(i, "\n".join(f"{t} {a}" for a in ("now", "then")) if i % 2 else t) for i, t in texts]
    data = [*texts, (100, None), (101, ""), (102, "\n \n"), (103, "word " * 40000), (1, "one two"), (None, "some words without a name")]
    docs = spark.createDataFrame([(*r, 1.0, True) for r in data], "doc_id long, text string, content_share double, kept boolean")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5000, 0), (7, None)], "doc_id long, quality int")
    model = quality.learn(quality.training_sample(docs, labels))
    got = quality.verdicts(docs, model).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r for r in got if r.doc_id != 1}
    assert all(not by[i].base_failed or by[i].n_repeat_words for i in range(3, 60, 2))
    assert all(by[i].content_share == 1 for i in range(3, 60, 2)) and all(by[i].content_share == 0 and not by[i].kept for i in range(0, 60, 2))
    for i in (100, 101, 102):
        assert (by[i].n_words, by[i].n_dup_lines, by[i].base_failed, by[i].kept) == (0, 0, True, False)
    assert (by[103].n_words, by[103].n_repeat_words) == (40000, 40000)
    kept = quality.kept(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality.learn([("a", 1)]) is None and quality.verdicts(docs.limit(0), None).count() == 0
    assert quality.verdicts(docs, None).where("kept = base_failed").count() == 0
