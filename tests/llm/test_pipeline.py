"""The queries and the pipeline on the smallest tables."""

import re

import corpus_pipeline
import pytest
from folioforge.llm.oracles import ORACLES
from folioforge.llm.queries import QUERIES

from ..test_catalogue import rows

KEYS = {
    "op1_embedding_dedup": ("embeddings", "vec_id"), "op2_quality": ("documents", "doc_id"), "op3_fingerprint": ("documents", "doc_id"), "op4_toxicity": ("documents", "doc_id"), "op5_sharding": ("documents", "doc_id"),
    "op7_warc": ("pages", "page_id"), "op8_ngram_join": ("documents", "doc_id"), "op9_mixing": ("documents", "doc_id"), "op10_extraction": ("pages", "page_id"),
}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_one_row_each(spark, sf, name):
    table, key = KEYS[name]
    ids = [r[0] for r in QUERIES[name](spark, sf).select(key).collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf, duck, name):
    df, found = QUERIES[name](spark, sf), duck.execute(ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in found.description], found.fetchall())


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    schema, kept = docs.schema, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == schema.names and [f.dataType for f in out.schema] == [f.dataType for f in schema]
        kept[name] = out
        docs = out
    ids = {n: {r[0] for r in df.select("doc_id").collect()} for n, df in kept.items()}
    assert ids["packing"] == ids["mixing"] <= ids["near_duplicates"] <= ids["toxicity"] <= ids["quality"]
    assert kept["near_duplicates"].count() == len(ids["near_duplicates"])
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[0])) for r in df.select("text").collect())
    assert abs(words(kept["mixing"]) - 1.5 * words(kept["near_duplicates"])) <= 30


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_stages_on_odd_tables(spark, sf, odd, none):
    """Null and odd texts, repeated rows and ids, clashing columns and an empty table go through every stage but packing's own columns."""
    docs = odd.union(odd.limit(3)).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert stage(spark, none, sf).count() == 0
        if name != "packing":
            assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_run_deletes_what_it_has_read(spark, sf):
    from folioforge.llm.shared import Scratch

    before = len(Scratch.opened)
    rows_ = corpus_pipeline.run(spark, sf)
    assert len(Scratch.opened) == before + 1 and rows_.count() > 0
