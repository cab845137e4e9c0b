"""A corpus pipeline: five operators, each on all that the one before it kept.

Every stage's result is written as Parquet and read again as the next one's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import mixing, ngram_join, packing, quality, toxicity
from folioforge.llm.queries import TOKENIZER
from folioforge.llm.shared import Scratch, bounded_batches


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good.  The model is fitted on labelled rows of ``docs``.

    Null and empty texts are scored like any other; null ids stay out of the fit
    only; rows with equal ids are scored each by its own text.
    """
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).where("predicted = 1").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not predict as toxic; odd rows as in ``keep_quality``."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(docs, labels).where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Null ids and texts without words stay; rows that share an id are judged each
    by its own text.
    """
    return ngram_join.keep_one(docs, Scratch(spark, "near"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; where a quota ends within a document, its first words.

    Null and blank texts have no words and are not taken; null sources are one
    source; rows with equal ids are mixed as rows of their own.
    """
    return mixing.rows_of_mix(docs, Scratch(spark, "mix"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a null or empty text is its end token."""
    bounded_batches(spark)
    out = packing.pack(docs, TOKENIZER, with_bytes=False)
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models and packing are not SQL: the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each is written to the shared folder and read again.

    What a stage has written for itself, and what it has read, is deleted when its result is written.
    """
    scratch, held = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before = list(Scratch.opened)
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        for own in [s for s in Scratch.opened if s not in before]:
            own.close()
        if held is not None:
            scratch.drop(held)
        held = docs
    return docs
