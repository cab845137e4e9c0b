"""The thin driver queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, embedding_dedup, extraction, fingerprint, mixing, ngram_join, packing, periodic_runs, quality, sharding, suffix_dedup, toxicity, warc
from .shared import Scratch

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op1"), threshold=0.93, recall=0.98)
    return out.withColumnRenamed("id", "vec_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint.probe(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_chars", F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents"), 16, Scratch(spark, "op5"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, with_bytes=False)
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.deduplicate(_table(spark, sf_dir, "pages"), Scratch(spark, "op7").path("archive"))
    return out.select(F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.join(_table(spark, sf_dir, "documents"), Scratch(spark, "op8"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"), Scratch(spark, "op9"))
    shards = F.array_join(F.transform("draws", lambda d: d["shard"].cast("string")), ",")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", shards.alias("shards"))


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extraction.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), Scratch(spark, "op11"), length=50)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words of a document: a tenth of them become periodic from some word on.  A null id has no decimal form and keeps its words."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit, rest = words[a : a + p], n - a
    return words[:a] + (unit * (rest // len(unit) + 1))[:rest]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), least=6, times=4, before=_planted)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    best = F.col("runs")[F.col("first_run")]
    milli = F.floor(best["length"].cast("decimal(19,0)") * 1000 / best["period"]).cast("long")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"), milli.alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), Scratch(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_embedding_dedup, op2_quality, op3_fingerprint, op4_toxicity, op5_sharding, op6_packing, op7_warc, op8_ngram_join, op9_mixing, op10_extraction, op11_suffix_dedup, op12_periodic_runs, op13_divergence)
}
