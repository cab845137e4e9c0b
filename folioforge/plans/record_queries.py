"""Queries on records: pages of rows, payloads, summaries, filters, scores and queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as X
from ..functions import vectors as V
from ..operators import chunks as C
from ..operators import corpus as P
from ..operators import records as R
from ..operators import search as Q
from .registry import derived, query, table


@query("""WITH RECURSIVE w AS (SELECT doc_id, text, length(text) AS n, 0 AS i, 0 AS s, NULL::BIGINT AS e FROM documents WHERE length(text) > 0),
z AS (SELECT doc_id, text, n, i, s, CASE WHEN s + 1000 < n AND strpos(substring(text, s + 901, 100), '. ') > 0 THEN s + 900 + strpos(substring(text, s + 901, 100), '. ') + 1 ELSE least(s + 1000, n) END AS e FROM w
UNION ALL SELECT doc_id, text, n, i + 1, e - 100, CASE WHEN e - 100 + 1000 < n AND strpos(substring(text, e - 100 + 901, 100), '. ') > 0 THEN e - 100 + 900 + strpos(substring(text, e - 100 + 901, 100), '. ') + 1 ELSE least(e - 100 + 1000, n) END FROM z WHERE e < n)
SELECT doc_id, i::INT AS chunk_index, (max(i) OVER (PARTITION BY doc_id) + 1)::INT AS total_chunks, s::INT AS start_char, e::INT AS end_char, md5(substring(text, s + 1, e - s)) AS digest FROM z""")
def chunk_snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.snapped_windows(table(spark, sf_dir, "documents"), size=1000, overlap=100)
    return out.select("doc_id", "chunk_index", "total_chunks", "start_char", "end_char", F.md5("text").alias("digest"))


@query("""SELECT doc_id, (s // 900)::INT AS chunk_index, s::INT AS start_char, md5(substring(text, s + 1, 1000)) AS digest, md5(substring(text, greatest(s - 1000, 0) + 1, least(s + 1000, length(text)) + 1000 - greatest(s - 1000, 0))) AS context FROM
(SELECT doc_id, text, unnest(generate_series(0, CASE WHEN length(text) <= 1000 THEN 0 ELSE ((length(text) - 1000 + 899) // 900) * 900 END, 900)) AS s FROM documents WHERE length(text) > 0)""")
def chunk_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.context_windows(table(spark, sf_dir, "documents"), size=1000, overlap=100)
    return out.select("doc_id", "chunk_index", F.col("start_char").cast("int"), F.md5("text").alias("digest"), F.md5("context").alias("context"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 25 OFFSET 50")
def document_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of rows: the limit and the offset are the feature."""
    return R.page(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.col("n_chars"), F.col("doc_id")], 25, 50)


@query("""WITH o AS (SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 5), l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT o_orderkey, o_orderdate, l_partkey AS first_part, coalesce(l.n, 0) AS lines FROM o LEFT JOIN l ON l_orderkey = o_orderkey AND r = 1""")
def latest_with_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest orders, each with its first line and the number of its lines."""
    top = P.latest(table(spark, sf_dir, "orders"), F.col("o_orderdate"), 5, F.col("o_orderkey"))
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").join(F.broadcast(top.select("o_orderkey")), "o_orderkey", "left_semi")  # five keys
    first = P.first_child(top, lines, "o_orderkey", [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")], {"first_part": F.col("l_partkey")})
    return P.with_count(first, lines, "o_orderkey", "lines").select("o_orderkey", "o_orderdate", "first_part", "lines")


@query("SELECT (SELECT count(*) FROM customer) AS parents, (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS children, round((SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))::DOUBLE / nullif((SELECT count(*) FROM customer), 0), 6) AS average")
def average_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return R.average_children(table(spark, sf_dir, "customer"), orders, "c_custkey").withColumn("average", F.round("average", 6))


_PAPERS = """SELECT 'e' || event_id AS arxiv_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS title, CASE WHEN event_id % 4 > 1 THEN props WHEN event_id % 4 = 1 THEN '' END AS abstract, CASE WHEN event_id % 9 > 0 THEN ts END AS published, CASE WHEN event_id % 5 > 1 THEN 'Text of ' || props WHEN event_id % 5 = 1 THEN '' END AS full_text FROM events"""


@query(f"""SELECT arxiv_id, coalesce(title, 'ArXiv Paper ' || arxiv_id) AS title, coalesce(abstract, '') AS abstract, strftime(published, '%Y-%m-%dT%H:%M:%S') AS published, coalesce(nullif(full_text, ''), nullif(abstract, ''), title, '') AS text, '' AS comments FROM ({_PAPERS})""")
def paper_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults, ISO times and the first text that is not empty."""
    own = derived(spark, sf_dir, _PAPERS).withColumn("text", F.coalesce(X.first_nonempty(F.col("full_text"), F.col("abstract"), F.col("title")), F.lit("")))
    p = R.with_defaults(own, {"title": F.concat(F.lit("ArXiv Paper "), F.col("arxiv_id")), "comments": F.lit("")})
    return p.withColumns({"abstract": F.coalesce("abstract", F.lit("")), "published": F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss")}).select("arxiv_id", "title", "abstract", "published", "text", "comments")


@query(r"""WITH d AS (SELECT doc_id, text, regexp_split_to_array(text, '\n\n+') AS p FROM documents), c AS (SELECT doc_id, len(list_filter(list_transform(p, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')) AS n, len(regexp_extract_all(text, '\$([^$]{2,200})\$', 1)) > 0 AS e FROM d)
SELECT doc_id, coalesce(n, 0)::BIGINT AS chunk_count, coalesce(n, 0) > 0 AS success, CASE WHEN coalesce(n, 0) > 0 THEN '' ELSE 'Document produced no chunks' END AS error, coalesce(e, false) AS has_equations, coalesce(n, 0)::BIGINT AS in_payload, (coalesce(n, 0) > 0) AS payload_success FROM c""")
def processed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into paragraphs, as results with their payload; a document without any is an error row."""
    docs = table(spark, sf_dir, "documents")
    chunks = docs.select("doc_id", F.posexplode(X.paragraphs(F.col("text"))).alias("chunk_index", "text"))
    out = R.processed(docs, chunks, "doc_id", tables=F.array(), equations=F.regexp_extract_all("text", F.lit(r"\$([^$]{2,200})\$"), F.lit(1)))
    parsed = F.from_json("payload", "document_id string, chunks array<struct<chunk_index:int,text:string>>, processing_metadata struct<chunk_count:bigint>, success boolean")
    return out.withColumn("j", parsed).select("doc_id", "chunk_count", "success", F.coalesce(F.get("errors", F.lit(0)), F.lit("")).alias("error"), "has_equations", F.size("j.chunks").cast("long").alias("in_payload"), F.col("j.success").alias("payload_success"))


_RUNS = "SELECT user_id AS run, min(ts) AS start_time, max(ts) AS end_time, CAST(sum(CASE WHEN user_id % 6 > 0 AND event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS items_processed, CAST(sum(CASE WHEN user_id % 6 > 0 AND event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS items_failed FROM events GROUP BY user_id"


@query(f"SELECT run, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_seconds, CASE WHEN items_processed + items_failed = 0 THEN 0.0 ELSE items_processed * 100.0::DOUBLE / (items_processed + items_failed) END::DOUBLE AS success_rate FROM ({_RUNS})")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.run_summary(derived(spark, sf_dir, _RUNS)).select("run", "duration_seconds", F.col("success_rate").cast("double"))


@query("""SELECT source AS batch, string_agg(CASE WHEN n_chars >= 655 THEN doc_id END, ',' ORDER BY doc_id) AS succeeded, coalesce(string_agg(CASE WHEN n_chars < 655 THEN doc_id END, ',' ORDER BY doc_id), '') AS failed, sum(CASE WHEN n_chars >= 655 THEN n_chars // 655 ELSE 0 END)::BIGINT AS chunks_created FROM documents GROUP BY source""")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("batch"), "doc_id", (F.col("n_chars") >= 655).alias("success"), F.floor(F.col("n_chars") / 655).alias("num_chunks"))
    return R.batch_summary(rows, "batch", "doc_id").withColumns({c: F.array_join(c, ",") for c in ("succeeded", "failed")})


_TRACKERS = "SELECT 'u' || user_id AS tracker, count(*) + user_id % 3 * 10 AS total, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS completed, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS skipped, CASE WHEN user_id % 7 > 0 THEN min(ts) END AS started FROM events GROUP BY user_id"
_AS_OF = "2025-01-01 00:00:00"


@query(f"""WITH t AS (SELECT *, completed + failed + skipped AS done, (epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(started)) / 1e6 AS s FROM ({_TRACKERS})), r AS (SELECT *, CASE WHEN s > 0 THEN done / s END AS rate FROM t)
SELECT tracker, rate, CASE WHEN total > done AND rate > 0 THEN (total - done) / rate END AS seconds_left FROM r""")
def tracker_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_eta(derived(spark, sf_dir, _TRACKERS), F.col("started"), F.lit(_AS_OF).cast("timestamp_ntz")).select("tracker", "rate", "seconds_left")


@query("SELECT user_id, event_type AS first_type, n - 1 AS repeats FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE r = 1")
def first_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.registered(table(spark, sf_dir, "events"), "user_id", [F.col("ts"), F.col("event_id")]).select("user_id", F.col("event_type").alias("first_type"), "repeats")


_ERRORS = "SELECT 'u' || user_id AS component, 'E' || event_id % 5 AS kind, props AS message, ts FROM events WHERE event_type = 'error'"


@query(f"SELECT component || '_errors' AS series, 1.0::DOUBLE AS value, kind AS error_type, NULL AS message FROM ({_ERRORS}) UNION ALL SELECT component || '_last_error', epoch_us(ts)::DOUBLE, kind, message FROM ({_ERRORS})")
def error_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.error_points(derived(spark, sf_dir, _ERRORS)).select("series", "value", F.col("labels")["error_type"].alias("error_type"), F.try_element_at("labels", F.lit("message")).alias("message"))


@query("""SELECT user_id, arg_max(value, (ts, event_id)) FILTER (event_type = 'click' AND value IS NOT NULL) AS clicked, arg_max(value, (ts, event_id)) FILTER (event_type <> 'click' AND value IS NOT NULL) AS other FROM events GROUP BY user_id""")
def absolute_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each update sets one of two counters and leaves the other."""
    click = F.col("event_type") == "click"
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.when(click, F.col("value")).alias("clicked"), F.when(~click, F.col("value")).alias("other"))
    return R.absolute_counters(e, "user_id", ["ts", "event_id"], ["clicked", "other"])


@query("""SELECT doc_id FROM documents WHERE n_chars BETWEEN 500 AND 5000 AND list_has_any([lang, source], ['en', 'web']) AND (contains(lower(text), 'the') OR contains(lower(text), 'und')) AND contains(lower(text), 'in') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.array("lang", "source").alias("categories"), "text")
    out = R.search(docs, years=(500, 5000), categories=["en", "web"], any_of=["The", "und"], all_of=["in"], without=table(spark, sf_dir, "labels").where("toxic = 1"), key="doc_id", year="n_chars")
    return out.select("doc_id")


@query(r"SELECT doc_id FROM documents WHERE contains(' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''), ' ') || ' ', ' of the ')")
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(R.has_phrase(F.col("text"), "Of  the")).select("doc_id")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN round(l_discount * 10, 6) >= 0.8 THEN 'high' WHEN round(l_discount * 10, 6) >= 0.6 THEN 'medium' ELSE 'low' END AS band FROM lineitem")
def confidence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", R.bands(F.col("l_discount") * 10).alias("band"))


_TURNS = "conv_id, turn, length(text) AS size, role = 'system' AS pinned FROM conversations"


@query(f"""WITH m AS (SELECT {_TURNS}), s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id) AS load, sum(CASE WHEN pinned THEN 0 ELSE size END) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING) AS held FROM m), t AS (SELECT *, CASE WHEN load > 900 THEN 'flush' WHEN load > 700 THEN 'warn' ELSE 'ok' END AS state FROM s)
SELECT conv_id, turn, state, state <> 'flush' OR pinned OR held <= 500 AS kept FROM t""")
def queue_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "conversations")
    return R.pressure(m, "conv_id", "turn", F.length("text"), 1000, F.col("role") == "system").select("conv_id", "turn", "state", "kept")


@query("SELECT event_id, coalesce((epoch_us(TIMESTAMP '2024-06-01 00:00:00') - epoch_us(ts)) / 1e6 > 86400 * 30, true) AS expired FROM events")
def expired_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", R.expired(F.col("ts"), F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"), 86_400 * 30).alias("expired"))


_MAPS = "SELECT event_id AS id, CASE WHEN event_id % 4 > 0 THEN 'a=' || user_id || ',' || event_type || '=1' END AS x, CASE WHEN event_id % 3 > 0 THEN event_type || '=' || event_id || ',c=3' END AS y FROM events"
_DUCK_MAP = "coalesce(map_from_entries(list_transform(string_split({c}, ','), lambda e: (split_part(e, '=', 1), split_part(e, '=', 2)))), MAP {{}})"


@query(f"SELECT id, array_to_string(list_sort(list_transform(map_entries(map_concat({_DUCK_MAP.format(c='x')}, {_DUCK_MAP.format(c='y')})), lambda e: e.key || '=' || e.value)), ',') AS merged FROM ({_MAPS})")
def merged_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda c: F.str_to_map(F.col(c), F.lit(","), F.lit("="))
    entries = F.array_sort(F.transform(F.map_entries(R.merged(of("x"), of("y"))), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return derived(spark, sf_dir, _MAPS).select("id", F.array_join(entries, ",").alias("merged"))


_CONFIGS = """SELECT event_id AS id, replace(replace(t, '#', '' || event_id), '^', props) AS config FROM events JOIN (VALUES (0, '{"name":"x","size":#,"rate":0.5,"on":true,"list":[#,{"a":^}],"more":{}}'), (1, '{"name":1,"size":true,"rate":true,"list":^}'), (2, '{"size":1.5,"on":#,"more":[^]}'), (3, 'no json ^'), (4, '{}'), (5, '{"name":null,"x^":1}'), (6, '{"name":null,"more":^}')) AS v(k, t) ON k = event_id % 7"""
_TYPES = {"name": "string", "size": "integer", "rate": "number", "on": "boolean", "list": "array", "more": "object", "other": "unknown"}
_DUCK_TYPES = {"string": "'VARCHAR'", "integer": "'BIGINT', 'UBIGINT', 'BOOLEAN'", "number": "'BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN'", "boolean": "'BOOLEAN'", "array": "'ARRAY'", "object": "'OBJECT'"}


@query(f"""WITH j AS (SELECT id, CASE WHEN json_valid(config) THEN config::JSON END AS j FROM ({_CONFIGS}))
SELECT id, array_to_string(list_filter([{', '.join(f"CASE WHEN json_exists(j, '$.{n}') AND json_type(j, '$.{n}') NOT IN ({_DUCK_TYPES[t]}) THEN '{n}: expected {t}' END" for n, t in _TYPES.items() if t in _DUCK_TYPES)},
CASE WHEN NOT coalesce(json_exists(j, '$.name'), false) THEN 'name: missing' END, CASE WHEN NOT coalesce(json_exists(j, '$.size'), false) THEN 'size: missing' END], lambda x: x IS NOT NULL), '|') AS errors FROM j""")
def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _CONFIGS).select("id", F.array_join(R.schema_errors(F.col("config"), _TYPES, ["name", "size"]), "|").alias("errors"))


@query(f"""WITH RECURSIVE f AS ({_CONFIGS}), j AS (SELECT id AS doc, config FROM f WHERE json_valid(config)), t AS (SELECT doc, t.id AS node, t.parent, t.type FROM j, json_tree(j.config) AS t),
d AS (SELECT doc, node, type, 1 AS depth FROM t WHERE parent IS NULL UNION ALL SELECT t.doc, t.node, t.type, d.depth + 1 FROM d JOIN t ON t.doc = d.doc AND t.parent = d.node)
SELECT id, CASE WHEN json_valid(config) THEN (SELECT count(*) FROM t JOIN t AS p ON p.doc = t.doc AND p.node = t.parent WHERE p.type = 'OBJECT' AND t.doc = f.id) END AS key_count, (SELECT max(depth) FROM d WHERE type IN ('OBJECT', 'ARRAY') AND doc = f.id)::BIGINT AS depth FROM f""")
def json_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.json_shape(derived(spark, sf_dir, _CONFIGS), "config", ["id"])


@query("""WITH p AS (SELECT a.vec_id, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, coalesce(list_cosine_similarity(x, y) < 0.5, true) AS redo, CASE WHEN y IS NULL THEN 0.0 ELSE round(y[1], 6) END AS first FROM p""")
def summary_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the one after it; where there is none, a zero vector stands in and the summary is made again."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    p = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id", "left")
    return p.select("vec_id", R.drift(F.col("x"), F.col("y"), 0.5).alias("redo"), F.round(R.vector_or_zero(F.col("y"), 64)[0], 6).alias("first"))


@query("""WITH e AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS sec FROM events), c AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n FROM e)
SELECT event_id, n AS in_window, n > 3 AS limited, coalesce(sec - max(CASE WHEN n > 3 THEN sec END) OVER (PARTITION BY user_id ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 7200, false) AS cooling FROM c""")
def rate_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    return R.cooled(e, "user_id", "at", seconds=86_400, most=3, cooldown=7_200).select("event_id", "in_window", "limited", "cooling")


_METRICS = "SELECT DISTINCT replace(t, '#', event_type || '_' || user_id) AS metric FROM events JOIN (VALUES (0, 'documents_processed_#_total'), (1, 'GPU_utilization_#'), (2, '#_processing_latency_ms'), (3, 'network_hops_#'), (4, 'other_#'), (5, 'text_extracted_phase_duration_#')) AS v(k, t) ON k = event_id % 6"


@query(f"""SELECT metric, CASE {' '.join(f"WHEN {' OR '.join(f'''contains(lower(metric), '{p}')''' for p in parts)} THEN '{name}'" for name, parts in S.DIMENSIONS.items())} ELSE 'unknown' END AS dimension FROM ({_METRICS})""")
def metric_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _METRICS).select("metric", S.dimension_of(F.col("metric")).alias("dimension"))


_SCORES = "SELECT id, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(c AS DOUBLE) AS c, CAST(t AS DOUBLE) AS t, n, CAST(s AS DOUBLE) AS s FROM (SELECT event_id AS id, value / 100 AS a, user_id % 10 / 10.0 AS b, 0.9 AS c, event_id % 4 / 4.0 AS t, user_id % 20 AS n, CASE WHEN event_id % 5 > 0 THEN event_id % 9000 END AS s FROM events) AS v"


@query(f"""SELECT id, round(CASE WHEN t <= 0 THEN 0 ELSE a * b * c / t * pow(0.25 * (a + b + c + t), 1.8) END, 9) AS third, round(CASE WHEN s IS NULL THEN 0 ELSE a * (n / greatest(1, n + 1)) * ((n + 2) / greatest(1, 20)) / least(1.0, 3600.0 / greatest(1.0, s)) * pow(b, 1.8) END, 9) AS fourth,
round(0.4 * a + 0.6 * b, 9) AS context, round(CASE WHEN t > 0 THEN pow(a * b * c / t * 0.5, 1.5) END, 9) AS monolithic, round(CASE WHEN a * b > 0 THEN 2.0 * t / (a * b * pow(0.5, 1.5)) END, 9) AS who FROM ({_SCORES})""")
def score_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c, t, n, s = (F.col(x) for x in "abctns")
    half = F.lit(0.5)
    return derived(spark, sf_dir, _SCORES).select(
        "id", F.round(S.from_dimensions(a, b, c, t), 9).alias("third"), F.round(S.from_progress(a, n, F.lit(1), F.lit(1), F.lit(20), s, b), 9).alias("fourth"), F.round(S.context([a, b], [0.4, 0.6]), 9).alias("context"),
        F.round(F.when(t > 0, S.monolithic(a, b, c, F.when(t > 0, t), half, 1.5)), 9).alias("monolithic"), F.round(F.when(a * b > 0, S.inverse_who(F.lit(2.0), F.when(a * b > 0, a), b, t, half, 1.5)), 9).alias("who"),
    )


@query(r"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(13))), lambda x: x <> '') AS s FROM documents)
SELECT doc_id, len(s)::INT AS sentences, len(list_distinct(s))::INT AS different, len(s) = len(list_distinct(s)) AS all_different FROM s""")
def sentence_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.sentence_facts(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query("SELECT source, least(1.0, count(*) FILTER (contains(lower(text), 'the') OR contains(lower(text), 'und')) / count(*)) AS score FROM documents GROUP BY source")
def keyword_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.keyword_score(table(spark, sf_dir, "documents"), "source", F.col("text"), ["The", "und"])


@query("SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN len(embedding) ELSE 7 END::INT AS dim, abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) <= 0.1 AS valid FROM embeddings")
def stored_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of a stored vector, or the length that was noted where there is none."""
    e = table(spark, sf_dir, "embeddings")
    vector = F.when(F.col("vec_id") % 3 == 0, F.col("embedding"))
    return e.select("vec_id", V.stored_dim(vector, F.lit(7)).cast("int").alias("dim"), V.valid(F.col("embedding"), 64).alias("valid"))
