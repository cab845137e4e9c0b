"""Queries on chunkers and text functions, each with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chunks as C
from .registry import derived, duck, query, table

_TOKENS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"
_CHUNK = "doc_id, chunk_index::INT AS chunk_index, CASE WHEN s > 0 THEN length(array_to_string(t[1:s], ' ')) + 1 ELSE 0 END::INT AS start_char, s::INT AS first_token, least(s + {w}, n)::INT AS end_token, md5(array_to_string(t[s + 1:s + {w}], ' ')) AS digest"


def _digests(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "chunk_index", "start_char", "first_token", "end_token", F.md5("text").alias("digest"))


@query(f"""WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), n AS (SELECT *, len(t) AS n FROM d),
c AS (SELECT *, unnest(generate_series(0, CASE WHEN n = 0 THEN -1 WHEN n <= 100 THEN 0 ELSE ((n - 100 + 79) // 80) END)) AS chunk_index FROM n),
w AS (SELECT *, chunk_index * 80 AS s FROM c) SELECT {_CHUNK.format(w=100)} FROM w""")
def chunk_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(C.token_windows(table(spark, sf_dir, "documents"), size=100, overlap=20))


@query(f"""WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), n AS (SELECT *, len(t) AS n FROM d),
c AS (SELECT *, unnest(generate_series(0, (n - 1) // 80)) AS chunk_index FROM n WHERE n > 0),
w AS (SELECT *, chunk_index * 80 AS s FROM c) SELECT {_CHUNK.format(w=100)} FROM w""")
def chunk_traditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(C.stepped_windows(table(spark, sf_dir, "documents"), size=100, overlap=20))


@query(f"""WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), n AS (SELECT *, len(t) AS n FROM d WHERE len(t) > 0),
f AS (SELECT *, greatest((n - 100) // 40, 0) AS k FROM n),
c AS (SELECT *, unnest(generate_series(0, CASE WHEN n <= 100 THEN 0 WHEN k * 40 + 100 < n THEN k + 1 ELSE k END)) AS chunk_index FROM f),
w AS (SELECT *, CASE WHEN chunk_index <= k THEN chunk_index * 40 ELSE k * 40 + 100 END AS s FROM c) SELECT {_CHUNK.format(w=100)}, (chunk_index > k) AS remainder FROM w""")
def chunk_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.sliding_windows(table(spark, sf_dir, "documents"), window=100, step=40)
    return out.select("doc_id", "chunk_index", "start_char", "first_token", "end_token", F.md5("text").alias("digest"), "remainder")


@query(r"""WITH RECURSIVE d AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM documents),
n AS (SELECT *, len(list_filter(string_split(c, ' '), lambda x: x <> '')) AS n FROM d),
s AS (SELECT doc_id, n, list_filter(list_transform(string_split(regexp_replace(c, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM n WHERE n > 150),
e AS (SELECT doc_id, i, s[i] AS sent, len(string_split(s[i], ' ')) AS k FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM s)),
r AS (SELECT doc_id, i, sent, k AS run, 0 AS chunk FROM e WHERE i = 1
UNION ALL SELECT e.doc_id, e.i, e.sent, CASE WHEN r.run + e.k > 150 THEN e.k ELSE r.run + e.k END, CASE WHEN r.run + e.k > 150 THEN r.chunk + 1 ELSE r.chunk END FROM r JOIN e ON e.doc_id = r.doc_id AND e.i = r.i + 1),
packed AS (SELECT doc_id, chunk::INT AS chunk_index, string_agg(sent, ' ' ORDER BY i) AS text FROM r GROUP BY doc_id, chunk)
SELECT doc_id, chunk_index, md5(text) AS digest, len(string_split(text, ' '))::INT AS token_count FROM packed
UNION ALL SELECT doc_id, 0, md5(c), n::INT FROM n WHERE n BETWEEN 1 AND 150""")
def chunk_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sentence_packs(table(spark, sf_dir, "documents"), most=150).select("doc_id", "chunk_index", F.md5("text").alias("digest"), "token_count")


@query(r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(regexp_replace(text, '\s+', ' ', 'g')), '\s+'), lambda x: x <> '') AS t FROM documents)
SELECT doc_id, (s // 50)::INT AS chunk_index, md5(array_to_string(t[s + 1:s + 50], ' ')) AS digest FROM (SELECT doc_id, t, unnest(generate_series(0, len(t) - 1, 50)) AS s FROM d WHERE len(t) > 0)""")
def chunk_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sentence_packs(table(spark, sf_dir, "documents"), most=50, respect_sentences=False).select("doc_id", "chunk_index", F.md5("text").alias("digest"))


@query("""SELECT doc_id, (s // 900)::INT AS chunk_index, s::INT AS start_char, least(s + 1000, length(text))::INT AS end_char, md5(substring(text, s + 1, 1000)) AS digest FROM
(SELECT doc_id, text, unnest(generate_series(0, CASE WHEN length(text) <= 1000 THEN 0 ELSE ((length(text) - 1000 + 899) // 900) * 900 END, 900)) AS s FROM documents WHERE length(text) > 0)""")
def chunk_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.character_windows(table(spark, sf_dir, "documents"), size=1000, overlap=100).select("doc_id", "chunk_index", F.col("start_char").cast("int"), F.col("end_char").cast("int"), F.md5("text").alias("digest"))


@query(f"SELECT doc_id, len({_TOKENS})::INT AS tokens, (length(text) // 4)::BIGINT AS estimate FROM documents")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.token_count(F.col("text")).alias("tokens"), X.token_estimate(F.col("text")).alias("estimate"))


_OFFSETS = f"""WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), e AS (SELECT doc_id, i, length(t[i]) AS n FROM (SELECT doc_id, t, unnest(generate_series(1, len(t))) AS i FROM d WHERE len(t) > 0))
SELECT doc_id, (i - 1)::INT AS pos, (sum(n + 1) OVER (PARTITION BY doc_id ORDER BY i) - n - 1)::BIGINT AS start_char FROM e"""


@query(_OFFSETS)
def token_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every token of every text begins."""
    return C.token_offsets(table(spark, sf_dir, "documents"))


@query(_OFFSETS)
def token_offsets_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under the name that an earlier version gave it."""
    return token_offsets(spark, sf_dir)


@query(r"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(13))), lambda x: x <> '') AS s FROM documents)
SELECT doc_id, len(s)::INT AS n, md5(array_to_string(s, chr(2))) AS digest FROM s""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = X.sentences(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n"), F.md5(F.array_join(s, "\x02")).alias("digest"))


#: Every document with line ends in its text and a frame around it; ~ is a line end, # the letters of the text.
_PARAGRAPHS = "SELECT doc_id AS id, replace(replace(t, '#', replace(PLAIN(text), ' e', '~~ e')), '~', chr(10)) AS text FROM documents JOIN (VALUES (1, 'one~~#~~~~three'), (2, '#'), (3, ''), (4, '~~a b ~~  ~~#~d')) AS v(k, t) ON k = doc_id % 4 + 1"


@query(duck(rf"""WITH p AS (SELECT id, list_filter(list_transform(regexp_split_to_array(text, '\n\n+'), lambda x: trim(x, chr(32) || chr(10))), lambda x: x <> '') AS p FROM ({_PARAGRAPHS}))
SELECT id, i::INT AS pos, p[i + 1] AS paragraph FROM (SELECT id, p, unnest(generate_series(0, len(p) - 1)) AS i FROM p WHERE len(p) > 0)"""))
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _PARAGRAPHS).select("id", F.posexplode(X.paragraphs(F.col("text"))).alias("pos", "paragraph"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.clean(F.col("text"))).alias("digest"))


@query(r"SELECT page_id, translate(url, './', '__') AS key, array_extract(string_split(regexp_replace(regexp_replace(regexp_replace(url, '\?.*$', ''), '/+$', ''), '\.pdf$', ''), '/'), -1) AS segment FROM pages")
def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.store_key(F.col("url")).alias("key"), X.id_of_url(F.col("url")).alias("segment"))


#: An identifier for every document, of one of several forms.
_IDS = "SELECT replace(t, '#', lpad('' || doc_id % 1000000, 7, '0')) AS id FROM documents JOIN (VALUES (0, '2301.#'), (1, '#01.00303v2'), (2, 'cs/#'), (3, 'math.GT/#v1'), (4, 'cs.AI/#'), (5, 'bad #'), (6, '2301.123'), (7, 'hep-th/#v3'), (8, 'a.b/#'), (9, '2301.00303v#v2'), (10, '2301.00#')) AS v(k, t) ON k = doc_id % 11"


@query(rf"""SELECT id, CASE WHEN regexp_extract(id, '(v\d+)$', 1) = '' THEN 'v1' ELSE regexp_extract(id, '(v\d+)$', 1) END AS version, regexp_replace(id, 'v\d+$', '') AS base,
(regexp_matches(id, '^\d{{4}}\.\d{{4,5}}(v\d+)?$') OR regexp_matches(id, '^[a-z-]+(\.[A-Z]{{2}})?/\d{{7}}(v\d+)?$')) AS valid,
CASE WHEN regexp_matches(id, '^\d{{4}}\.\d{{4,5}}(v\d+)?$') THEN left(id, 4) WHEN regexp_matches(id, '^[a-z-]+(\.[A-Z]{{2}})?/\d{{7}}(v\d+)?$') THEN substring(string_split(id, '/')[2], 1, 4) ELSE '0000' END AS folder,
nullif(CASE WHEN id LIKE '%/%' THEN substring(regexp_extract(id, '^[a-z-]+(\.[A-Z]{{2}})?/(\d{{7}})(v\d+)?$', 2), 1, 4) ELSE regexp_extract(id, '^(\d{{4}})\.\d{{4,5}}(v\d+)?$', 1) END, '') AS yymm,
nullif(CASE WHEN id LIKE '%/%' THEN substring(regexp_extract(id, '^[a-z-]+(\.[A-Z]{{2}})?/(\d{{7}})(v\d+)?$', 2), 5, 3) ELSE regexp_extract(id, '^\d{{4}}\.(\d{{4,5}})(v\d+)?$', 1) END, '') AS number,
nullif(regexp_extract(id, '^([a-z-]+(\.[A-Z]{{2}})?)/\d{{7}}(v\d+)?$', 1), '') AS category,
regexp_matches(regexp_replace(id, 'v\d+$', ''), '^(\d{{4}}\.\d{{4,5}}|[a-z.-]+/\d{{7}})(v\d+)?$') AS valid_path FROM ({_IDS})""")
def id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("id")
    return derived(spark, sf_dir, _IDS).select("id", X.id_parts(c)["version"].alias("version"), X.id_parts(c)["base"].alias("base"), X.valid_id(c).alias("valid"), X.month_folder(c).alias("folder"), X.id_parts(c)["yymm"].alias("yymm"), X.id_parts(c)["number"].alias("number"), X.id_parts(c)["category"].alias("category"), X.valid_path_id(c).alias("valid_path"))
