"""Search: exact vector top-k, post-filters, and BM25."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..functions.vectors import cosine
from .lineage import cut


def top_k(vectors: DataFrame, query: list[float], k: int, id_col: str, vector_col: str) -> DataFrame:
    """The k rows most similar to one query vector; the query is a literal, so only k rows of each task travel."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.withColumn("sim", cosine(F.col(vector_col), q)).orderBy(F.desc_nulls_last("sim"), id_col).limit(k)


def top_k_of_row(vectors: DataFrame, query_id: int, k: int, id_col: str, vector_col: str) -> DataFrame:
    """The k rows most similar to a row of the table (that row left out)."""
    q = vectors.where(F.col(id_col) == query_id).select(F.col(vector_col).alias("_q")).limit(1)
    near = vectors.where(F.col(id_col) != query_id).crossJoin(F.broadcast(q))  # one row
    return near.withColumn("sim", cosine(F.col(vector_col), F.col("_q"))).drop("_q").orderBy(F.desc_nulls_last("sim"), id_col).limit(k)


def then_filter(top: DataFrame, condition: Column) -> DataFrame:
    """A filter after the limit: it may leave fewer than k rows, and never lets others in."""
    return top.where(condition)


def bm25(docs: DataFrame, terms: list[str], k: int, *, id_col: str = "doc_id", text_col: str = "text", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best texts for the terms.

    Only the query's terms are counted; document frequencies and the mean length are
    one row of aggregates, joined as one row, and a text's own counts are made in its row
    and kept, so that the texts are read once.
    """
    words = [w.lower() for w in terms]
    t = tokens(F.lower(F.col(text_col)))
    hits = docs.select(id_col, t.alias("_t")).select(id_col, F.size("_t").alias("len"), F.filter("_t", lambda x: x.isin(words)).alias("_h"))

    def count_of(word: str) -> Column:
        return F.size(F.filter("_h", lambda x: x == word))

    counted = cut(hits.select(id_col, "len", *[count_of(w).alias(f"tf{i}") for i, w in enumerate(words)]))
    totals = counted.agg(F.count("*").alias("n"), F.avg("len").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        score = score + idf * F.col(f"tf{i}") * (k1 + 1) / (F.col(f"tf{i}") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    return counted.crossJoin(F.broadcast(totals)).withColumn("score", F.round(score, 6)).where("score > 0").orderBy(F.desc("score"), id_col).limit(k).select(id_col, "score")


def mean_vectors(vectors: DataFrame, by: str, vector_col: str) -> DataFrame:
    """Rows (by, pos, mean): mean of each component, with partial aggregation."""
    return vectors.select(by, F.posexplode(vector_col).alias("pos", "x")).groupBy(by, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def keyword_score(entries: DataFrame, by: str, text: Column, words: list[str]) -> DataFrame:
    """Share of entries that hold a word of the list, at most 1."""
    hit = F.greatest(*[F.lower(text).contains(w.lower()).cast("int") for w in words], F.lit(0))
    return entries.groupBy(by).agg(F.least(F.lit(1.0), F.sum(hit) / F.count("*")).alias("score"))


def resolve_citations(cited: DataFrame, entries: DataFrame) -> DataFrame:
    """In-text citations (paper, number) with the entry they point to, null where there is none."""
    return cited.join(entries, ["paper", "number"], "left")


def ranked(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
