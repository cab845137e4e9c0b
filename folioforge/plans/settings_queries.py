"""Queries on settings, registrations, states and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import settings as E
from ..operators import corpus as C
from ..operators import metrics as M
from ..operators import records as R
from ..operators import score_log
from ..operators import status as T
from .registry import derived, query, table

_VALUES = "SELECT event_id AS id, user_id, 'APP_' || upper(event_type) || CASE WHEN event_id % 3 > 0 THEN '_K' || event_id % 3 ELSE '' END AS name, CASE event_id % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'off' WHEN 2 THEN '' || event_id WHEN 3 THEN '-' || user_id || '.5' WHEN 4 THEN '1' WHEN 5 THEN event_type WHEN 6 THEN '1.2.3' ELSE '+0' || user_id END AS value FROM events"
_KIND = "CASE WHEN lower(value) IN ('true', 'yes', '1', 'on', 'false', 'no', '0', 'off') THEN 'bool' WHEN regexp_matches(value, '^[+-]?[0-9]+[.][0-9]*$') THEN 'float' WHEN regexp_matches(value, '^[+-]?[0-9]+$') THEN 'int' ELSE 'str' END"
_JSON = f"CASE {_KIND} WHEN 'bool' THEN CASE WHEN lower(value) IN ('true', 'yes', '1', 'on') THEN 'true' ELSE 'false' END WHEN 'float' THEN value::DOUBLE::VARCHAR WHEN 'int' THEN value::BIGINT::VARCHAR ELSE '\"' || value || '\"' END"


@query(f"SELECT id, {_KIND} AS kind, {_JSON} AS json FROM ({_VALUES})")
def coerced_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _VALUES).select("id", E.coerced(F.col("value")).alias("v")).select("id", "v.kind", "v.json")


@query(f"""WITH v AS (SELECT user_id, id, lower(substr(name, 5)) AS name, {_JSON} AS leaf FROM ({_VALUES})), j AS (SELECT user_id, id, ('{{"' || CASE WHEN name LIKE '%\\_%' ESCAPE '\\' THEN split_part(name, '_', 1) || '": {{"' || split_part(name, '_', 2) || '": ' || leaf || '}}}}' ELSE name || '": ' || leaf || '}}' END)::JSON AS j FROM v),
m AS (SELECT user_id, list_reduce(list(j ORDER BY id), lambda a, b: json_merge_patch(a, b)) AS j FROM j GROUP BY user_id)
SELECT user_id, len(json_keys(j))::INT AS names, CASE WHEN json_type(j, '$.click') <> 'OBJECT' THEN j->>'$.click' END AS click, j->>'$.click.k1' AS k1, j->>'$.view.k2' AS k2 FROM m""")
def settings_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables of every user as one nested object."""
    out = T.nested_settings(derived(spark, sf_dir, _VALUES), "user_id", "id", "name", "value", "APP_")
    at = lambda path: F.get_json_object("merged", path)
    return out.select("user_id", F.size(F.json_object_keys("merged")).alias("names"), F.when(~at("$.click").startswith("{"), at("$.click")).alias("click"), at("$.click.k1").alias("k1"), at("$.view.k2").alias("k2"))


_BINDS = "SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN 'props : ' || props WHEN 1 THEN 'name: ' || event_type WHEN 2 THEN ':no key' WHEN 3 THEN 'only' || event_id ELSE 'n:' || event_id || ' ' END AS text FROM events"


@query(f"""SELECT id, trim(split_part(text, ':', 1)) AS key, CASE WHEN contains(text, ':') THEN trim(substr(text, strpos(text, ':') + 1)) ELSE '' END AS value, CASE WHEN contains(text, ':') THEN json_valid(trim(substr(text, strpos(text, ':') + 1))) ELSE false END AS is_json FROM ({_BINDS}) WHERE text NOT LIKE ':%'""")
def bind_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _BINDS).select("id", E.bind_variable(F.col("text")).alias("b")).where("b IS NOT NULL").select("id", "b.*")


_MODELS = "SELECT doc_id AS id, CASE doc_id % 8 WHEN 0 THEN 'Sentence-Transformers/' WHEN 1 THEN 'st-' WHEN 2 THEN 'org/transformers-' WHEN 3 THEN 'jina-v' WHEN 4 THEN 'OpenAI/' WHEN 5 THEN 'text-embedding-' WHEN 6 THEN 'cohere/' ELSE 'other/' END || lang || doc_id AS model FROM documents"


@query(f"SELECT id, CASE WHEN contains(m, 'sentence-transformers') OR contains(m, 'st-') THEN 'sentence' WHEN contains(m, 'transformers') OR contains(m, 'jina') THEN 'jina' WHEN contains(m, 'openai') OR contains(m, 'text-embedding') THEN 'openai' WHEN contains(m, 'cohere') THEN 'cohere' ELSE 'jina' END AS embedder FROM (SELECT id, lower(model) AS m FROM ({_MODELS}))")
def embedder_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _MODELS).select("id", E.embedder(F.col("model")).alias("embedder"))


_PATHS = "SELECT doc_id AS id, replace(CASE doc_id % 6 WHEN 0 THEN '2301.#' WHEN 1 THEN '2301.#v2' WHEN 2 THEN 'cs/06#' WHEN 3 THEN 'math.GT/03#v1' WHEN 4 THEN 'bad #' ELSE 'CS/#' END, '#', lpad('' || doc_id % 100000, 5, '0')) AS paper FROM documents"
_FILES = "CASE id % 4 WHEN 0 THEN [base || '.tex', 'a.tex', 'b.pdf'] WHEN 1 THEN ['z.tex', 'main.tex', 'paper.tex'] WHEN 2 THEN ['fig.pdf'] ELSE ['q.tex', 'c.tex'] END"


@query(rf"""WITH p AS (SELECT id, regexp_replace(paper, 'v\d+$', '') AS base FROM ({_PATHS})), f AS (SELECT *, {_FILES} AS files FROM p)
SELECT id, CASE WHEN regexp_matches(base, '^\d{{4}}\.\d{{4,5}}$') THEN '/pdf/' || left(base, 4) || '/' || base || '.pdf' WHEN regexp_matches(base, '^[a-z-]+(\.[A-Z]{{2}})?/\d{{7}}$') THEN '/pdf/' || substr(split_part(base, '/', 2), 1, 4) || '/' || replace(base, '/', '_') || '.pdf' END AS pdf,
CASE WHEN list_contains(files, 'main.tex') THEN 'main.tex' WHEN list_contains(files, base || '.tex') THEN base || '.tex' ELSE list_sort(list_filter(files, lambda x: x LIKE '%.tex'))[1] END AS source FROM f""")
def paper_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = derived(spark, sf_dir, _PATHS)
    named = lambda *files: F.array(*[f if not isinstance(f, str) else F.lit(f) for f in files])
    own, k = F.concat(E.base_id(F.col("paper")), F.lit(".tex")), F.col("id") % 4
    files = F.when(k == 0, named(own, "a.tex", "b.pdf")).when(k == 1, named("z.tex", "main.tex", "paper.tex")).when(k == 2, named("fig.pdf")).otherwise(named("q.tex", "c.tex"))
    return p.select("id", E.pdf_path(F.col("paper"), "/pdf/").alias("pdf"), E.main_source(F.col("paper"), files).alias("source"))


@query("SELECT t AS event_type, count(e.event_id) AS registrations FROM (VALUES ('click'), ('view'), ('session')) AS v(t) LEFT JOIN events e ON e.event_type = t GROUP BY t")
def registrations_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.by_scope(table(spark, sf_dir, "events"), "event_type", ["click", "view", "session"])


@query("SELECT user_id, count(*) AS access_count, max(ts) AS last_accessed FROM events GROUP BY user_id ORDER BY access_count DESC, user_id LIMIT 5")
def most_accessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("access_count"), F.max("ts").alias("last_accessed"))
    return T.most_accessed(counted, F.col("access_count"), "user_id")


@query("SELECT event_id, first_value(event_type) OVER w AS registered_kind, row_number() OVER w = 1 AS registers FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def metric_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.appended(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"]).select("event_id", "registered_kind", "registers")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, arg_max(event_id, (ts, event_id)) AS event_id, round(arg_max(coalesce(value, 0), (ts, event_id)) / arg_max(CASE WHEN event_id % 4 = 0 THEN 1.0 ELSE event_id % 4 END, (ts, event_id)) * 100, 6) AS memory_percent FROM events GROUP BY user_id")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", F.coalesce("value", F.lit(0.0)).alias("used"), (F.col("event_id") % 4).cast("double").alias("total"))
    return T.latest_status(e, "user_id", ["ts", "event_id"], "used", "total").select("user_id", F.col("event_type").alias("state"), "event_id", F.round("memory_percent", 6).alias("memory_percent"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN coalesce(length(text), 0) < 100 THEN 'text' END, CASE WHEN coalesce(trim(source), '') = '' THEN 'title' END, CASE WHEN doc_id % 3 = 0 THEN 'dimension' END, CASE WHEN n_chars // 655 NOT BETWEEN 1 AND 500 THEN 'chunks' END], lambda x: x IS NOT NULL), '|') AS reasons FROM documents""")
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    dim = F.when(F.col("doc_id") % 3 == 0, 1024).otherwise(2048)
    return d.select("doc_id", F.array_join(T.gate_reasons(F.col("text"), F.col("source"), dim, F.floor(F.col("n_chars") / 655)), "|").alias("reasons"))


@query("SELECT doc_id, CASE WHEN len(w) > 0 THEN len(w) END::INT AS symbols, CASE WHEN len(w) > 0 THEN lang END AS language, len(w) > 0 AS has_symbols FROM (SELECT doc_id, lang, list_distinct(regexp_extract_all(coalesce(text, ''), '[a-z]+_[a-z]+|[0-9]{4,}')) AS w FROM documents)")
def conditional_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct of facts only where a document has symbols (here: names with an underscore and long numbers)."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[a-z]+_[a-z]+|[0-9]{4,}"), F.lit(0)))
    out = T.paper_document(table(spark, sf_dir, "documents").select("doc_id", "lang", found.alias("symbols")), "symbols", ["lang"])
    return out.select("doc_id", F.size("code.symbols").alias("symbols"), F.col("code.lang").alias("language"), "has_symbols").withColumn("symbols", F.when(F.col("has_symbols"), F.col("symbols")))


@query("SELECT DISTINCT name FROM (SELECT source AS name FROM documents UNION ALL SELECT 'old_' || source FROM documents WHERE lang = 'en' UNION ALL SELECT source FROM documents WHERE lang = 'de') WHERE name IS NOT NULL")
def drop_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    aliases = d.where("lang = 'en'").select(F.concat(F.lit("old_"), "source").alias("a")).union(d.where("lang = 'de'").select("source"))
    return T.drop_targets(d.select("source"), aliases)


@query("SELECT lang, doc_id, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) AS rank FROM documents) WHERE rank <= 5")
def stratified_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: at most five documents of each language, drawn by a seed."""
    return C.stratified(table(spark, sf_dir, "documents"), ["lang"], "doc_id", 5, seed=7).select("lang", "doc_id", "rank")


@query("SELECT DISTINCT user_id % 9 + 1 AS step, user_id % 9 + 5 AS size, round(1 - (user_id % 9 + 1) / (user_id % 9 + 5), 9) AS overlap FROM events")
def overlap_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").select((F.col("user_id") % 9 + 1).alias("step"), (F.col("user_id") % 9 + 5).alias("size")).distinct()
    return s.withColumn("overlap", F.round(E.overlap_ratio(F.col("step"), F.col("size")), 9))


_RESULTS = "SELECT event_id AS id, user_id, event_type, ts, value, '{\"' || event_type || '\": {\"stats\": {\"p50\": ' || event_id || ', \"name\": \"x\"}}}' AS result, CASE event_id % 3 WHEN 0 THEN 'ms' WHEN 1 THEN 's' ELSE 'us' END AS unit FROM events WHERE value IS NOT NULL"


@query(f"""WITH r AS (SELECT *, greatest(id / CASE unit WHEN 's' THEN 1 WHEN 'ms' THEN 1000 ELSE 1000000 END, 1e-9)::DOUBLE AS s, 0.25 * (0.5 + value / 100 + 0.8 + user_id % 10 / 10.0::DOUBLE) AS ctx FROM ({_RESULTS})),
c AS (SELECT *, CASE WHEN value <= 0 OR user_id % 4 = 0 OR ctx <= 0 THEN 0 ELSE value / 100 * (user_id % 4) * 0.7::DOUBLE * pow(ctx, 1.7) END AS cap FROM r)
SELECT id, event_type AS label, id::DOUBLE AS time_value, s AS time_seconds, round(ctx, 9) AS context_score, round(cap, 9) AS capability, round(cap / s, 6) AS efficiency FROM c""")
def score_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for every event: its time read from a nested result, scaled, and scored."""
    d = derived(spark, sf_dir, _RESULTS)
    ctx = {"l": F.lit(0.5), "i": F.col("value") / 100, "a": F.lit(0.8), "g": (F.col("user_id") % 10) / 10.0}
    out = score_log.records(d, result="result", path=[F.col("event_type"), F.lit("stats"), F.lit("p50")], unit=F.col("unit"), what=F.col("value") / 100, where=F.col("user_id") % 4, who=F.lit(0.7), context=ctx, alpha=F.lit(1.7), label=F.col("event_type"), at=F.col("ts"))
    r = F.col("record")
    return out.select("id", r["label"].alias("label"), r["time_value"].alias("time_value"), r["time_seconds"].alias("time_seconds"), F.round(r["context_score"], 9).alias("context_score"), F.round(r["capability"], 9).alias("capability"), F.round(r["efficiency"], 6).alias("efficiency"))


@query("""WITH r AS (SELECT source AS batch, doc_id, n_chars >= 655 AS success, n_chars // 655 AS chunks FROM documents), n AS (SELECT *, (row_number() OVER (PARTITION BY batch, success ORDER BY doc_id) - 1) // 20 AS part FROM r),
t AS (SELECT batch, count(*) FILTER (success) AS items_succeeded, count(*) FILTER (NOT success) AS items_failed, coalesce(sum(chunks) FILTER (success), 0)::BIGINT AS chunks_created FROM r GROUP BY batch)
SELECT n.batch, success, part::INT AS part, string_agg(doc_id, ',' ORDER BY doc_id) AS items, any_value(items_succeeded) AS items_succeeded, any_value(items_failed) AS items_failed, any_value(chunks_created) AS chunks_created FROM n JOIN t ON t.batch = n.batch GROUP BY n.batch, success, part""")
def batch_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("batch"), "doc_id", (F.col("n_chars") >= 655).alias("success"), F.floor(F.col("n_chars") / 655).alias("num_chunks"))
    return R.batch_parts(rows, "batch", "doc_id", 20).withColumn("items", F.array_join("items", ","))


@query("""WITH c AS (SELECT max(ts) AS c FROM events) SELECT event_type, count(value) AS n, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean, count(value) FILTER (ts >= c - INTERVAL 1 DAY) AS n_recent, min(value) FILTER (ts >= c - INTERVAL 1 DAY) AS low_recent, max(value) FILTER (ts >= c - INTERVAL 1 DAY) AS high_recent, round(avg(value) FILTER (ts >= c - INTERVAL 1 DAY), 6) AS mean_recent FROM events, c GROUP BY event_type""")
def recent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of each series beside those of its last day."""
    e = table(spark, sf_dir, "events")
    as_of = F.lit(e.agg(F.max("ts")).first()[0])
    out = M.recent_stats(e, "event_type", as_of, 86_400)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "mean_recent")})
