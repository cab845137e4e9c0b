"""Queries on corpus rows: metadata, backlog, children, counts, upserts, sets, budgets, graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators import graph as G
from .registry import derived, duck, query, table

#: A line of metadata for every document, in one of several forms; # stands for the letters of its text, ^ for its number.
_LINES = """SELECT replace(replace(t, '#', PLAIN(text)), '^', '' || doc_id) AS value FROM documents JOIN (VALUES
(0, '{"id":"2301.^","title":"A #","abstract":"Some # text","authors":"Ann B.; Cy D, Ed F","categories":"cs.AI cs.LG","update_date":"2023-01-01"}'),
(1, '{"id":"cs/^","title":null,"abstract":"Other #","authors":["X Y","Z"],"categories":["cs.CL"],"update_date":"2006-01-02"}'),
(2, '{"id":"2301.^","title":"No abstract","abstract":""}'),
(3, '{"id":"2301.^","title":"Null abstract","abstract":null}'),
(4, 'not json at all #'),
(5, '{"id":"2301.^","title":"Bare","abstract":"#"}')) AS v(k, t) ON k = doc_id % 6"""


_FROM_JSON = """j AS (SELECT CASE WHEN json_valid(value) THEN value::JSON END AS j FROM ({lines})),
r AS (SELECT j->>'id' AS id, j->>'title' AS title, j->>'abstract' AS abstract, json_type(j, '$.authors') = 'ARRAY' AS many, j->'authors' AS a, j->>'authors' AS a1, json_type(j, '$.categories') = 'ARRAY' AS several, j->'categories' AS c, j->>'categories' AS c1, j->>'update_date' AS update_date FROM j WHERE j IS NOT NULL),
m AS (SELECT translate(id, './', '__') AS _key, id AS arxiv_id, coalesce(title, '') AS title, length(abstract)::INT AS abstract_length,
CASE WHEN many THEN array_to_string(from_json(a, '["VARCHAR"]'), '|') WHEN a1 IS NULL THEN '' ELSE array_to_string(list_filter(list_transform(regexp_split_to_array(a1, '[;,]\\s*'), lambda x: trim(x)), lambda x: x <> ''), '|') END AS authors,
CASE WHEN several THEN array_to_string(from_json(c, '["VARCHAR"]'), '|') WHEN c1 IS NULL THEN '' ELSE array_to_string(list_filter(regexp_split_to_array(c1, '\\s+'), lambda x: x <> ''), '|') END AS categories, update_date FROM r WHERE id IS NOT NULL AND coalesce(abstract, '') <> '')"""


@query(duck(f"WITH {_FROM_JSON.format(lines=_LINES)} SELECT * FROM m"))
def normalize_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = C.metadata_rows(derived(spark, sf_dir, _LINES))
    return m.select("_key", "arxiv_id", "title", "abstract_length", F.array_join("authors", "|").alias("authors"), F.array_join("categories", "|").alias("categories"), "update_date")


@query("SELECT d.doc_id, d.n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def unprocessed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.unprocessed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "n_chars")


@query("SELECT d.doc_id, d.n_chars FROM documents d WHERE d.n_chars >= 655 AND d.doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY n_chars, doc_id LIMIT 10")
def backlog_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the ten shortest of the backlog."""
    left = C.unprocessed(table(spark, sf_dir, "documents").where("n_chars >= 655"), table(spark, sf_dir, "labels"), "doc_id")
    return left.orderBy("n_chars", "doc_id").limit(10).select("doc_id", "n_chars")


@query("""WITH o AS (SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 5),
l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem)
SELECT o_orderkey, o_orderdate, l_partkey AS first_part, l_extendedprice AS first_price FROM o LEFT JOIN l ON l_orderkey = o_orderkey AND r = 1""")
def recent_with_first_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the five latest orders, each with its first line."""
    top = C.latest(table(spark, sf_dir, "orders"), F.col("o_orderdate"), 5, F.col("o_orderkey"))
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").join(F.broadcast(top.select("o_orderkey")), "o_orderkey", "left_semi")
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return C.first_child(top, lines, "o_orderkey", order, {"first_part": F.col("l_partkey"), "first_price": F.col("l_extendedprice")}).select("o_orderkey", "o_orderdate", "first_part", "first_price")


@query("SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def children_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return C.with_count(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey", "orders")


@query("SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 3600 SECOND AND ts <= TIMESTAMP '2024-01-15 00:00:00'")
def recent_activity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(C.recent(e, "ts", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), 3600)).agg(F.count("*").alias("n"))


@query("SELECT conv_id, md5(string_agg(text, ' ' ORDER BY turn)) AS digest, count(*) AS parts FROM conversations GROUP BY conv_id")
def reassemble_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reassemble(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text").select("conv_id", F.md5("text").alias("digest"), "parts")


@query("SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'missing', 0")
def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.counts(spark, {**{n: table(spark, sf_dir, n) for n in ("documents", "labels", "pages")}, "missing": None})


@query("SELECT lang, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS share FROM documents GROUP BY lang")
def group_count_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.group_counts(table(spark, sf_dir, "documents"), "lang")


@query("SELECT count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END)::BIGINT AS high, sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END)::BIGINT AS medium, sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END)::BIGINT AS low FROM labels")
def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return table(spark, sf_dir, "labels").agg(
        F.count("*").alias("n"), F.count_if(good).alias("good"), F.count_if(toxic).alias("toxic"), F.count_if(good & ~toxic).alias("high"), F.count_if(good & toxic).alias("medium"), F.count_if(~good).alias("low")
    )


_BATCHES = "SELECT CAST(floor(event_id / 100) AS INT) AS batch, 'p' || user_id AS paper, CASE WHEN event_id % 3 > 0 THEN event_type END AS entry, props AS val FROM events"


@query(f"SELECT batch, paper, entry, val FROM (SELECT *, row_number() OVER (PARTITION BY paper, entry ORDER BY batch DESC, val DESC) AS r FROM ({_BATCHES})) WHERE r = 1")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.latest_per_key(derived(spark, sf_dir, _BATCHES), ["paper", "entry"], [F.desc("batch"), F.desc("val")])


_A = "SELECT event_id AS pos, CASE WHEN event_id % 7 > 0 THEN 'u' || user_id END AS k FROM events"
_B = "SELECT CASE WHEN user_id % 2 > 0 THEN 'u' || user_id END AS k FROM events WHERE value > 60"


@query(f"SELECT pos, k FROM ({_A}) a WHERE NOT EXISTS (SELECT 1 FROM ({_B}) b WHERE b.k IS NOT DISTINCT FROM a.k)")
def set_difference_keep_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.unprocessed(derived(spark, sf_dir, _A), derived(spark, sf_dir, _B), "k")


@query("WITH d AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY conv_id, role) SELECT conv_id, string_agg(role, '>' ORDER BY t) AS roles FROM d GROUP BY conv_id")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(roles, ">").alias("roles"))


@query("SELECT lang, source, doc_id, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5(doc_id::VARCHAR), doc_id) AS rank FROM documents) WHERE rank <= 3")
def stratified_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: at most three documents of each language and source."""
    return C.stratified(table(spark, sf_dir, "documents"), ["lang", "source"], "doc_id", 3).select("lang", "source", "doc_id", "rank")


@query("""SELECT conv_id, turn, size, held::BIGINT AS held, (role = 'system' OR held <= 100) AS kept FROM (SELECT *, sum(CASE WHEN role = 'system' THEN 0 ELSE size END) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING) AS held
FROM (SELECT *, (length(text) // 4)::BIGINT AS size FROM conversations))""")
def fifo_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.within_budget(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.floor(F.length("text") / 4), 100, F.col("role") == "system")
    return out.select("conv_id", "turn", "size", "held", "kept")


@query("SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations")
def message_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chained(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "role", "previous")


@query("""SELECT doc_id, concat_ws(',', CASE WHEN n_chars >= 100 THEN NULL ELSE 'length' END, CASE WHEN lang IN ('en', 'de') THEN NULL ELSE 'language' END) AS reasons FROM documents""")
def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.quality_gates(table(spark, sf_dir, "documents"), {"length": F.col("n_chars") >= 100, "language": F.col("lang").isin("en", "de")})
    return out.select("doc_id", F.array_join("reasons", ",").alias("reasons"))


_EDGES = """SELECT 'r' || r_regionkey AS src, 'n' || n_nationkey AS dst FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT 'n' || n_nationkey, 'c' || c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey UNION ALL SELECT 'c1', 'r0'"""


@query(f"""WITH RECURSIVE e AS ({_EDGES}), w AS (SELECT 'r0' AS node, 0 AS depth UNION ALL SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.node WHERE w.depth < 3)
SELECT node, min(depth)::INT AS depth FROM w GROUP BY node""")
def graph_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, customer = (table(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = region.join(nation, F.col("n_regionkey") == F.col("r_regionkey")).select(name("r", "r_regionkey").alias("src"), name("n", "n_nationkey").alias("dst"))
    edges = edges.union(nation.join(customer, F.col("c_nationkey") == F.col("n_nationkey")).select(name("n", "n_nationkey"), name("c", "c_custkey")))
    edges = edges.union(spark.createDataFrame([("c1", "r0")], "src string, dst string"))
    return G.reach(edges, spark.createDataFrame([("r0",)], "node string"), 3)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
