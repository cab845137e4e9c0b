"""Queries on vectors and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import chunks as C
from ..operators import search as S
from .registry import query, table

_COS = "list_dot_product(a::DOUBLE[], b::DOUBLE[]) / (sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[])) * sqrt(list_dot_product(b::DOUBLE[], b::DOUBLE[])))"
_TOP = f"WITH s AS (SELECT e.vec_id, e.label, {_COS} AS sim FROM (SELECT vec_id, label, embedding AS a FROM embeddings WHERE vec_id <> 0) e, (SELECT embedding AS b FROM embeddings WHERE vec_id = 0) q), t AS (SELECT * FROM s ORDER BY sim DESC, vec_id LIMIT {{k}})"


@query(_TOP.format(k=10) + " SELECT vec_id, round(sim, 6) AS sim FROM t")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the ten vectors nearest to vector 0."""
    return S.top_k_of_row(table(spark, sf_dir, "embeddings"), 0, 10, "vec_id", "embedding").select("vec_id", F.round("sim", 6).alias("sim"))


@query(_TOP.format(k=40) + " SELECT vec_id, label, round(sim, 6) AS sim FROM t WHERE label <= 3")
def topk_postfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report, and then a filter that may leave fewer rows."""
    top = S.top_k_of_row(table(spark, sf_dir, "embeddings"), 0, 40, "vec_id", "embedding")
    return S.then_filter(top, F.col("label") <= 3).select("vec_id", "label", F.round("sim", 6).alias("sim"))


@query("SELECT vec_id, i::INT AS pos, round(v[i + 1] * (vec_id % 7 + 1) / sqrt(list_dot_product(w, w)), 6) AS x FROM (SELECT vec_id, embedding::DOUBLE[] AS v, list_transform(embedding::DOUBLE[], lambda y: y * (vec_id % 7 + 1)) AS w, unnest(generate_series(0, len(embedding) - 1)) AS i FROM embeddings)")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = table(spark, sf_dir, "embeddings").withColumn("w", F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 7 + 1)))
    return scaled.select("vec_id", F.posexplode(V.normalise(F.col("w"))).alias("pos", "x")).withColumn("x", F.round("x", 6))


@query("SELECT label, (i - 1)::INT AS pos, round(avg(v[i]), 6) AS mean FROM (SELECT label, embedding::DOUBLE[] AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY label, i")
def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mean_vectors(table(spark, sf_dir, "embeddings"), "label", "embedding").withColumn("mean", F.round("mean", 6))


_PAIRS = "SELECT e.vec_id, e.embedding AS a, f.embedding AS b FROM embeddings e JOIN embeddings f ON f.vec_id = e.vec_id + 1"


@query(f"""WITH p AS (SELECT vec_id, list_transform(generate_series(1, 64), lambda i: a[i]::DOUBLE * 0.7 + b[i]::DOUBLE * 0.3) AS m, {_COS} AS c, sqrt(list_sum(list_transform(generate_series(1, 64), lambda i: pow(a[i]::DOUBLE - b[i]::DOUBLE, 2)))) AS d FROM ({_PAIRS}))
SELECT vec_id, round(c, 6) AS cosine, round(d, 6) AS distance, round(m[1] / (sqrt(list_dot_product(m, m)) + 1e-8), 5) AS first, round(list_sum(m) / (sqrt(list_dot_product(m, m)) + 1e-8), 5) AS total FROM p""")
def weighted_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    p = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id")
    double = lambda c: F.transform(c, lambda x: x.cast("double"))
    m = p.withColumn("m", V.fuse(double("a"), double("b"), 64))
    return m.select("vec_id", F.round(V.cosine(F.col("a"), F.col("b")), 6).alias("cosine"), F.round(V.distance(F.col("a"), F.col("b")), 6).alias("distance"), F.round(F.col("m")[0], 5).alias("first"), F.round(F.aggregate("m", F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@query("""WITH t AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos, embedding::DOUBLE[] AS v FROM embeddings), n AS (SELECT label, max(pos) + 1 AS n FROM t GROUP BY label),
w AS (SELECT t.label, pos, v, unnest(generate_series(greatest(0, ceil((pos - 16 + 1) / 12.0)::BIGINT), least(pos // 12, CASE WHEN n <= 16 THEN 0 ELSE ceil((n - 16) / 12.0)::BIGINT END))) AS w FROM t JOIN n ON n.label = t.label),
m AS (SELECT label, w, i, avg(v[i]) AS m FROM (SELECT label, w, v, unnest(generate_series(1, 64)) AS i FROM w) GROUP BY label, w, i), s AS (SELECT label, w, sqrt(sum(m * m)) AS norm FROM m GROUP BY label, w)
SELECT m.label, m.w::INT AS chunk_index, count(DISTINCT m.w) OVER (PARTITION BY m.label) AS total_chunks, (m.w * 12)::BIGINT AS first_token, least(m.w * 12 + 16, n.n)::BIGINT AS end_token, (m.w * 60)::BIGINT AS start_char, (least(m.w * 12 + 16, n.n) * 5 - 1)::BIGINT AS end_char, i::INT AS dim, round(m.m / s.norm, 5) AS value
FROM m JOIN s ON s.label = m.label AND s.w = m.w JOIN n ON n.label = m.label""")
def late_chunk_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, sf_dir, "embeddings")
    pos = (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long")
    t = e.select("label", pos.alias("pos"), (pos * 5).alias("start"), (pos * 5 + 4).alias("end"), F.lit(0).alias("special"), F.col("embedding").alias("vec"))
    out = C.pooled_windows(t, size=16, overlap=4, by="label")
    one = out.select("label", "chunk_index", "total_chunks", "first_token", "end_token", "start_char", "end_char", F.posexplode("embedding").alias("dim", "value"))
    return one.withColumns({"dim": F.col("dim") + 1, "value": F.round("value", 5)})


@query(r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS t FROM documents), q AS (SELECT unnest(['that', 'under', 'para']) AS w),
f AS (SELECT doc_id, len(t) AS len, w, len(list_filter(t, lambda x: x = w)) AS tf FROM d, q), s AS (SELECT w, count(*) AS n, avg(len) AS mean, count(*) FILTER (tf > 0) AS df FROM f GROUP BY w),
r AS (SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score FROM f JOIN s USING (w) GROUP BY doc_id)
SELECT doc_id, score::DOUBLE AS score FROM r WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 20""")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the twenty best texts for three words."""
    return S.bm25(table(spark, sf_dir, "documents"), ["that", "under", "para"], 20)
