"""Queries on table functions, positional zips, guards of heartbeats and exponents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chunk_udtf
from ..operators import metrics, zipped
from ..streaming import guards
from .registry import SQL, query, table

_OWN = {"letters": (list, "")}


def _lateral(spark: SparkSession, sf_dir: str, call: str) -> DataFrame:
    chunk_udtf.register(spark, "token_chunks", _OWN)
    out = spark.sql(f"SELECT d.doc_id, c.* FROM {{docs}} d, LATERAL {call} c", docs=table(spark, sf_dir, "documents"))
    return out.select("doc_id", "chunk_index", "start_char", "first_token", "end_token", F.md5("text").alias("digest"))


@query(SQL["chunk_token"])
def chunk_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``chunk_token`` from SQL text: a table function called by LATERAL."""
    return _lateral(spark, sf_dir, "token_chunks(text => d.text, size => 100, overlap => 20)")


@query("""WITH n AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0), c AS (SELECT *, unnest(generate_series(0, CASE WHEN n <= 500 THEN 0 ELSE (n - 500 + 399) // 400 END)) AS chunk_index FROM n)
SELECT doc_id, chunk_index::INT AS chunk_index, (400 * chunk_index)::INT AS start_char, (400 * chunk_index)::INT AS first_token, least(400 * chunk_index + 500, n)::INT AS end_token, md5(substr(text, 400 * chunk_index + 1, 500)) AS digest FROM c""")
def chunk_own_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table function with a tokenizer of one's own, by characters."""
    return _lateral(spark, sf_dir, "token_chunks(text => d.text, size => 500, overlap => 100, tokenizer => 'letters')")


@query("""WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS k FROM documents), b AS (SELECT page_id, row_number() OVER (ORDER BY url, page_id) AS k FROM pages)
SELECT doc_id, page_id FROM a JOIN b USING (k)""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by length beside pages by address, place by place, as long as both have one."""
    docs, pages = table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "pages").select("page_id", "url")
    return zipped.zip_positional(docs, [F.col("n_chars"), F.col("doc_id")], pages, [F.col("url"), F.col("page_id")]).select("doc_id", "page_id")


@query("""WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS agent, event_id AS seq, epoch_us(ts) // 100000 AS t, event_type <> 'signup' AS beat FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY agent ORDER BY t, seq) AS k FROM e),
s AS (SELECT DISTINCT agent, 0::BIGINT AS k, 0::BIGINT AS seq, 0::BIGINT AS t, 0::BIGINT AS depth, 0::BIGINT AS began, 0::BIGINT AS until, []::BIGINT[] AS last, '' AS verdict FROM e
UNION ALL SELECT agent, k, seq, t, CASE verdict WHEN 'accepted' THEN depth + 1 WHEN 'cooling' THEN depth WHEN 'rate' THEN depth ELSE 0 END, CASE WHEN verdict = 'accepted' AND depth = 0 THEN t WHEN verdict IN ('accepted', 'cooling', 'rate') THEN began ELSE 0 END,
CASE WHEN verdict IN ('depth', 'duration') THEN t + 750000 ELSE until END, CASE WHEN verdict = 'accepted' THEN list_append(recent, t) WHEN verdict IN ('yielded', 'cooling') THEN last ELSE recent END, verdict
FROM (SELECT *, CASE WHEN NOT beat THEN 'yielded' WHEN t < until THEN 'cooling' WHEN len(recent) >= 3 THEN 'rate' WHEN depth >= 8 THEN 'depth' WHEN depth > 0 AND t - began > 60000000 THEN 'duration' ELSE 'accepted' END AS verdict
FROM (SELECT n.*, s.depth, s.began, s.until, s.last, list_filter(s.last, lambda x: x > n.t - 1000000) AS recent FROM s JOIN n ON n.agent = s.agent AND n.k = s.k + 1)))
SELECT agent, t AS at, seq, depth::INT AS depth, verdict FROM s WHERE k > 0""")
def heartbeat_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the events of each user as heartbeats (signups yield), against a recursive query; time is a hundred thousand times faster."""
    e = table(spark, sf_dir, "events")
    micros = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 100_000)
    return guards.guarded(e.select(F.col("user_id").cast("string").alias("agent"), micros.cast("long").alias("at"), F.col("event_id").alias("seq"), (F.col("event_type") != "signup").alias("heartbeat")))


@query("""WITH g AS (SELECT l_suppkey AS series, l_orderkey, l_linenumber, ln(l_extendedprice::DOUBLE) AS y, ln(l_quantity::DOUBLE) AS x FROM lineitem WHERE l_extendedprice > 0 AND l_quantity > 0),
s AS (SELECT *, y - lag(y) OVER w AS dy, x - lag(x) OVER w AS dx FROM g WINDOW w AS (PARTITION BY series ORDER BY l_orderkey, l_linenumber, y, x)), t AS (SELECT *, CASE WHEN dx <> 0 THEN dy / dx END AS slope FROM s)
SELECT series, count(*) AS points, count(slope) AS pairs, round(avg(slope), 6) AS by_pairs, round(regr_slope(y, x), 6) AS by_regression FROM t GROUP BY series""")
def context_exponents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exponent of price by quantity for each supplier, by pairs and by regression."""
    lines = table(spark, sf_dir, "lineitem")
    out = metrics.exponents(lines, "l_suppkey", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"], "l_extendedprice", "l_quantity")
    return out.select(F.col("l_suppkey").alias("series"), "points", "pairs", F.round("by_pairs", 6).alias("by_pairs"), F.round("by_regression", 6).alias("by_regression"))
