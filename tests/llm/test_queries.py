import os
import zlib

import duckdb
import pytest

from sigtrack.llm import langid, registry
from sigtrack.llm.wordbpe import encoder, tokenizer_path

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the synthetic tables are not here")


def norm(columns, rows):
    """Rows in any order, columns by name."""
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([columns[i] for i in at] + [r[i] for i in at]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = registry.queries()[name](spark, DATA), con.sql(registry.oracle_sql()[name])
    assert norm(got.columns, got.collect()) == norm(want.columns, want.fetchall())


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs, langid.fitted(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    out = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(out) > 150 and sum(r.lang_pred == r.lang for r in out) / len(out) > 0.95


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from sigtrack.llm.common import stored

    docs = kept = spark.read.parquet(f"{DATA}/documents.parquet")
    first = docs
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA))
        if name != "packing":
            assert docs.columns == first.columns and 0 < docs.count() <= kept.count()
            kept = docs
    text = {r.doc_id: r.text for r in kept.collect()}
    enc = encoder(tokenizer_path("word_bpe_49k.json")).whole
    seen = dict.fromkeys(text, 0)
    for p in docs.collect():
        ids = [*enc.encode(text[p.doc_id], add_special_tokens=False).ids, 2][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        seen[p.doc_id] += p.length
    assert all(seen[d] == len(enc.encode(t, add_special_tokens=False).ids) + 1 for d, t in text.items())
