"""Queries on source code, outlines, configuration texts and layers of objects, made from the tables in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layers, structure, symbols
from .registry import query, table

#: The words that begin a document or follow a full stop; the source made of them is a class with a method for each, its docstring is the text.
_NAMES = r"(?:^|\. )([A-Za-z]+)"


def _python(text: Column, names: Column) -> Column:
    """Python source of a document: an import, a class named by its first word, its text as docstring, and a method for each first word of a sentence."""
    safe = F.replace(F.replace(text, F.lit("\\"), F.lit("/")), F.lit('"'), F.lit("'"))
    methods = F.transform(names, lambda n, i: F.concat(F.lit("    def m_"), n, F.lit("(self, a: int, b=1):\n        # if x: for y: while z\n        if a:\n            return 'else: def f'\n        else:\n            for c in b:\n                pass\n\n")))
    first = F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("x"))
    return F.concat(F.lit("import os\nfrom a import (b,\n    c)\n\nclass C_"), first, F.lit('(Base, metaclass=M):\n    """'), safe, F.lit('"""\n'), F.array_join(methods, ""), F.lit("LIMIT = 1\n"))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python source made of each whole document."""
    named = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", F.regexp_extract_all("text", F.lit(_NAMES), F.lit(1)).alias("names"))
    return named.select("doc_id", _python(F.col("text"), F.col("names")).alias("content"), F.lit("python").alias("language"))


@query(rf"""WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '{_NAMES}', 1) AS w, len(regexp_extract_all(text, chr(10))) AS n FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, 1 AS line, 1 AS end_line, 'import' AS kind, NULL AS name, 'module' AS scope FROM d UNION ALL SELECT doc_id, 2, 2, 'import', NULL, 'module' FROM d
UNION ALL SELECT doc_id, 5, 5 + n + 1 + 8 * len(w) - CASE WHEN len(w) > 0 THEN 1 ELSE 0 END, 'class', 'C_' || coalesce(w[1], 'x'), 'module' FROM d
UNION ALL SELECT doc_id, 7 + n + 8 * i, 7 + n + 8 * i + 6, 'function', 'm_' || w[i + 1], 'module.C_' || w[1] FROM (SELECT doc_id, w, n, unnest(range(0, len(w))) AS i FROM d)
UNION ALL SELECT doc_id, 7 + n + 8 * len(w), 7 + n + 8 * len(w), 'constant', 'LIMIT', 'module' FROM d)
SELECT doc_id, line::INT AS line, end_line::INT AS end_line, kind, name, scope FROM s""")
def code_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols of Python source made of each whole document: names, lines and scopes."""
    code = symbols.extract(_sources(spark, sf_dir), "content", "language", fields=["symbols"], symbol_fields=["line", "end_line", "kind", "name", "scope"], keep=["doc_id"])
    return code.select("doc_id", F.explode("code.symbols").alias("s")).select("doc_id", "s.line", "s.end_line", "s.kind", "s.name", "s.scope")


@query(rf"""WITH d AS (SELECT doc_id, len(regexp_extract_all(text, '{_NAMES}', 1)) AS w, len(regexp_extract_all(text, chr(10))) AS n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, (n + 8 * w + 8)::INT AS lines_of_code, (1 + 3 * w)::INT AS complexity, CASE WHEN w > 0 THEN 4 ELSE 1 END AS max_depth, (23 + 26 * w)::INT AS node_count, 1 AS top_level FROM d""")
def code_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, complexity, depth and tokens of the same source: what strings and comments say does not count."""
    code = symbols.extract(_sources(spark, sf_dir), "content", "language", fields=["lines_of_code", "complexity", "max_depth", "node_count", "top_level"], keep=["doc_id"]).select("doc_id", "code.*")
    return code.select("doc_id", "lines_of_code", "complexity", "max_depth", "node_count", F.size("top_level").alias("top_level"))


@query(r"""WITH s AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<script\b[^>]*>(.*?)</script\s*>', 1)) AS js FROM pages),
b AS (SELECT page_id, js, regexp_replace(regexp_replace(js, '//[^\n]*', ' ', 'g'), '"(\\.|[^"\\\n])*"?|''(\\.|[^''\\\n])*''?', ' ', 'g') AS code FROM s)
SELECT page_id, (length(js) - length(replace(js, chr(10), '')) + 1)::INT AS lines_of_code, (1 + len(regexp_extract_all(code, '\b(if|else|while|try|with)\b')))::INT AS complexity, len(regexp_extract_all(code, '[A-Za-z0-9_$]+|=>|[^\sA-Za-z0-9_$]'))::INT AS node_count FROM b""")
def script_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of every script of the pages (SQL blanks strings and comments first)."""
    scripts = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), F.lit(1))).alias("js"), F.lit("javascript").alias("language"))
    return symbols.extract(scripts, "js", "language", fields=["lines_of_code", "complexity", "node_count"], keep=["page_id"]).select("page_id", "code.lines_of_code", "code.complexity", "code.node_count")


_HEAD = r"(?is)<h([1-6])\b[^>]*>(.*?)</h[1-6]\s*>"
#: Every sentence-like piece of a document as a heading whose level follows its length.
_PIECES = r"list_filter(string_split(text, '. '), lambda x: length(x) > 0)"


@query(rf"""WITH RECURSIVE p AS (SELECT doc_id, {_PIECES} AS p FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, i::INT AS number, (length(p[i + 1]) % 6 + 1)::INT AS level, md5(p[i + 1]) AS title FROM (SELECT doc_id, p, unnest(range(0, len(p))) AS i FROM p)),
a AS (SELECT *, (SELECT max(b.number) FROM h b WHERE b.doc_id = h.doc_id AND b.number < h.number AND b.level < h.level) AS parent FROM h),
r AS (SELECT doc_id, number, 1 AS depth, md5(title) AS path FROM a WHERE parent IS NULL UNION ALL SELECT a.doc_id, a.number, r.depth + 1, md5(r.path || a.title) FROM r JOIN a ON a.doc_id = r.doc_id AND a.parent = r.number)
SELECT a.doc_id, a.number, a.level, a.parent, r.depth, r.path AS chain FROM a JOIN r ON r.doc_id = a.doc_id AND r.number = a.number""")
def outline_of_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading tree of every document (its pieces as headings): parent, depth and the chain of titles, against a recursive query."""
    pieces = F.filter(F.split("text", r"\. "), lambda x: F.length(x) > 0)
    rows = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.posexplode(pieces).alias("number", "piece")).select("doc_id", "number", (F.length("piece") % 6 + 1).alias("level"), F.md5("piece").alias("title"))
    out = structure.outline(rows, ["doc_id"], "number", "level", "title")
    chain = F.aggregate(F.split("path", " > "), F.lit(""), lambda acc, t: F.md5(F.concat(acc, t)))
    return out.select("doc_id", "number", "level", "parent", "depth", chain.alias("chain"))


@query(rf"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '{_HEAD}', 1)) AS level, unnest(regexp_extract_all(html, '{_HEAD}', 2)) AS body, generate_subscripts(regexp_extract_all(html, '{_HEAD}', 1), 1) - 1 AS number FROM pages),
t AS (SELECT page_id, number::INT AS number, level::INT AS level, trim(regexp_replace(regexp_replace(body, '(?s)<[^>]*>', '', 'g'), '[ \t\r\n]+', ' ', 'g')) AS title FROM h)
SELECT *, (SELECT max(b.number) FROM t b WHERE b.page_id = t.page_id AND b.number < t.number AND b.level < t.level) AS parent FROM t""")
def page_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of every page with their parents."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(structure.headings(F.col("html"))).alias("number", "h")).select("page_id", "number", "h.level", "h.title")
    return structure.outline(rows, ["page_id"], "number", "level", "title").select("page_id", "number", "level", "title", "parent")


@query("""WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), k AS (SELECT user_id, n, unnest(['json', 'yaml', 'toml', 'xml']) AS format FROM u)
SELECT user_id, format, CASE WHEN user_id % 7 <> 0 THEN CASE WHEN format = 'xml' THEN 1 + 2 * n ELSE 2 + 4 * n END END::BIGINT AS key_count, CASE WHEN user_id % 7 <> 0 THEN CASE WHEN format = 'xml' THEN 3 ELSE 4 END END::BIGINT AS depth FROM k""")
def config_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and depth of configuration texts in four formats, one for each user with all events; a seventh of them is malformed."""
    e = table(spark, sf_dir, "events")
    value = F.get_json_object("props", "$.k")
    lines = {
        "json": F.concat(F.lit('{"type": "'), "event_type", F.lit('", "at": '), "event_id", F.lit(', "props": '), "props", F.lit("}")),
        "yaml": F.concat(F.lit("  - type: "), "event_type", F.lit("\n    at: '"), "event_id", F.lit("' # a: b\n    props: {k: "), value, F.lit("}\n")),
        "toml": F.concat(F.lit("[[events]]\ntype = \""), "event_type", F.lit("\"\nat = "), "event_id", F.lit("\nprops = {k = "), value, F.lit("}\n")),
        "xml": F.concat(F.lit('<event type="'), "event_type", F.lit('"><k>'), value, F.lit("</k></event>")),
    }

    def whole(kind: str, own: Column) -> Column:
        user, broken = F.col("user_id").cast("string"), F.col("user_id") % 7 == 0
        if kind == "json":
            return F.concat(F.lit('{"user": '), user, F.lit(', "events": ['), F.array_join(own, ", "), F.when(broken, "}").otherwise("]}"))
        if kind == "yaml":
            return F.concat(F.lit("# user\nuser: "), user, F.lit("\nevents:\n"), F.array_join(own, ""), F.when(broken, "  broken: [1\n").otherwise(""))
        if kind == "toml":
            return F.concat(F.lit("user = "), user, F.lit("\n"), F.array_join(own, ""), F.when(broken, "no value =\n").otherwise(""))
        return F.concat(F.lit("<user>"), F.array_join(own, ""), F.when(broken, "<open></user>").otherwise("</user>"))

    parts = [e.groupBy("user_id").agg(F.collect_list(line).alias("own")).select("user_id", F.lit(kind).alias("format"), whole(kind, F.col("own")).alias("text")) for kind, line in lines.items()]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return structure.shapes(every, "text", "format").select("user_id", "format", "key_count", "depth")


_LAYER = """'{"k": ' || CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN '{"at": {"' || event_type || '": ' || event_id || '}}' ELSE event_id::VARCHAR END || ', "by": {"' || event_type || '": ' || CASE WHEN event_id % 5 = 0 THEN '[1, {"a": 2}]' WHEN event_id % 5 = 1 THEN '{}' WHEN event_id % 5 = 2 THEN '"text"' ELSE props END || '}}'"""


@query(f"""WITH l AS (SELECT user_id, event_id, ({_LAYER})::JSON AS j FROM events), m AS (SELECT user_id, list_reduce(list(j ORDER BY event_id), lambda a, b: json_merge_patch(a, b)) AS j FROM l GROUP BY user_id),
t AS (SELECT *, j->'$.k' AS k FROM m)
SELECT user_id, CASE WHEN json_type(k) <> 'OBJECT' THEN k::VARCHAR END AS number, k->>'$.k' AS k, k->>'$.at.view' AS at_view, json_extract_string(j, '$.by.click') AS click, json_extract_string(j, '$.by.view') AS view, len(json_keys(j, '$.by'))::INT AS kinds, coalesce(len(json_keys(j, '$.k.at')), 0)::INT AS at_keys FROM t""")
def layers_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects made of the events' properties, merged over all events of a user: scalars against objects, lists, empty objects."""
    e = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    kind = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"at": {"'), "event_type", F.lit('": '), number, F.lit("}}"))).otherwise(number)
    by = F.when(F.col("event_id") % 5 == 0, '[1, {"a": 2}]').when(F.col("event_id") % 5 == 1, "{}").when(F.col("event_id") % 5 == 2, '"text"').otherwise(F.col("props"))
    rows = e.select("user_id", "event_id", F.concat(F.lit('{"k": '), kind, F.lit(', "by": {"'), "event_type", F.lit('": '), by, F.lit("}}")).alias("layer"))
    out = layers.deep_merge(rows, "user_id", "event_id", "layer")
    at = lambda path: F.get_json_object("merged", path)
    number = F.when(~at("$.k").startswith("{"), at("$.k"))
    return out.select("user_id", number.alias("number"), at("$.k.k").alias("k"), at("$.k.at.view").alias("at_view"), at("$.by.click").alias("click"), at("$.by.view").alias("view"), F.size(F.json_object_keys(at("$.by"))).alias("kinds"), F.coalesce(F.size(F.json_object_keys(at("$.k.at"))), F.lit(0)).alias("at_keys"))
