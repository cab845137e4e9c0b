"""Queries on LaTeX, bibliographies and code, made of every document in Spark and in SQL alike: its text stands in one of several frames.

In the frames @ is a backslash, ~ a line end and # the letters of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bibliography as B
from ..functions import code as K
from ..functions import latex as L
from ..operators import search as S
from .registry import derived, duck, query, table

_TEX = """SELECT doc_id AS id, replace(replace(replace(t, '@', chr(92)), '~', chr(10)), '#', PLAIN(text)) AS tex FROM documents JOIN (VALUES
(1, 'A @begin{equation}@label{eq:a} x^2 # @end{equation} and @begin{equation*} y @end{equation*} with $xy$ and $z$ @cite{k1, k2} @citep{k2,k3} @cite[p. 3]{no}'),
(2, '@section{Intro} # ~@subsection{More} @begin{align} a &= b # @label{eq:b}~@end{align} @paragraph{P}'),
(3, '@begin{table}@caption{A {nested #} one}@label{t:1}@begin{tabular}{ll} a & b @end{tabular}@end{table} @begin{table*}@begin{array}{c} q @end{array}@end{table*}'),
(4, '#'), (5, '# @subsubsection{Deep} @section{A} @section{B}@paragraph{é}@section*{no} @begin{table}@label{only}#@end{table}')) AS v(k, t) ON k = doc_id % 5 + 1"""


@query(duck(rf"""WITH f AS ({_TEX}), e AS (
SELECT id, 0 AS g, 'display' AS type, unnest(regexp_extract_all(tex, '(?s)\\begin\{{equation\}}(.*?)\\end\{{equation\}}', 1)) AS x FROM f UNION ALL
SELECT id, 1, 'display_unnumbered', unnest(regexp_extract_all(tex, '(?s)\\begin\{{equation\*\}}(.*?)\\end\{{equation\*\}}', 1)) FROM f UNION ALL
SELECT id, 2, 'align', unnest(regexp_extract_all(tex, '(?s)\\begin\{{align\*?\}}(.*?)\\end\{{align\*?\}}', 1)) FROM f UNION ALL
SELECT id, 3, 'inline', unnest(regexp_extract_all(tex, '\$([^$]{{2,200}})\$', 1)) FROM f)
SELECT id, type, CASE WHEN g = 3 THEN x ELSE trim(regexp_replace(x, '\\label\{{[^}}]+\}}', '', 'g'), ' ' || chr(10)) END AS latex, CASE WHEN g IN (0, 2) THEN nullif(regexp_extract(x, '\\label\{{([^}}]+)\}}', 1), '') END AS label FROM e"""))
def latex_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _TEX).select("id", F.explode(L.equations(F.col("tex"))).alias("e")).select("id", "e.type", "e.latex", "e.label")


@query(duck(rf"""WITH f AS ({_TEX}), c AS (SELECT id, list_transform(flatten(list_transform(regexp_extract_all(tex, '\\cite[pt]?\{{([^}}]+)\}}', 1), lambda x: string_split(x, ','))), lambda y: trim(y)) AS k FROM f)
SELECT id, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i), '|') AS keys FROM c"""))
def latex_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _TEX).select("id", F.array_join(L.citations(F.col("tex")), "|").alias("keys"))


@query(duck(rf"""WITH f AS ({_TEX}), m AS (SELECT id, tex, unnest(regexp_extract_all(tex, '\\(section|subsection|subsubsection|paragraph)\{{[^}}]+\}}')) AS m FROM f)
SELECT id, regexp_extract(m, '^.([a-z]+)', 1) AS level, regexp_extract(m, '\{{([^}}]+)', 1) AS title, (strpos(tex, m) - 1)::INT AS position FROM m"""))
def latex_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _TEX).select("id", F.explode(L.sections(F.col("tex"))).alias("s")).select("id", "s.level", "s.title", "s.position")


@query(duck(rf"""WITH f AS ({_TEX}), a AS (SELECT id, regexp_extract_all(tex, '(?s)\\begin\{{table\*?\}}(.*?)\\end\{{table\*?\}}', 1) AS a FROM f), t AS (SELECT id, i - 1 AS pos, a[i] AS x FROM (SELECT id, a, unnest(generate_series(1, len(a))) AS i FROM a))
SELECT id, pos::INT AS pos, nullif(regexp_extract(x, '\\caption\{{((?:[^{{}}]|\{{[^}}]*\}})*)\}}', 1), '') AS caption, nullif(regexp_extract(x, '\\label\{{([^}}]+)\}}', 1), '') AS label,
nullif(coalesce(nullif(regexp_extract(x, '\\begin\{{tabular\}}\{{([^}}]+)\}}', 1), ''), regexp_extract(x, '\\begin\{{array\}}\{{([^}}]+)\}}', 1)), '') AS column_spec FROM t"""))
def latex_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _TEX).select("id", F.posexplode(L.tables(F.col("tex"))).alias("pos", "t")).select("id", "pos", "t.caption", "t.label", "t.column_spec")


@query(duck(rf"""WITH f AS ({_TEX}), a AS (SELECT id, regexp_extract_all(tex, '(?s)\\begin\{{table\*?\}}(.*?)\\end\{{table\*?\}}', 1) AS a FROM f), t AS (SELECT id, i - 1 AS pos, a[i] AS x FROM (SELECT id, a, unnest(generate_series(1, len(a))) AS i FROM a))
SELECT id, pos::INT AS pos, md5(x) AS full_content, md5(coalesce(nullif(regexp_extract(x, '(?s)\\begin\{{tabular\}}(.*?)\\end\{{tabular\}}', 0), ''), nullif(regexp_extract(x, '(?s)\\begin\{{array\}}(.*?)\\end\{{array\}}', 0), ''), x)) AS latex FROM t"""))
def latex_table_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = derived(spark, sf_dir, _TEX).select("id", F.posexplode(L.tables(F.col("tex"))).alias("pos", "t"))
    return out.select("id", "pos", F.md5("t.full_content").alias("full_content"), F.md5("t.latex").alias("latex"))


@query(duck(rf"""WITH f AS ({_TEX}) SELECT id, regexp_matches(tex, '(?s)\\begin\{{table\*?\}}.*?\\end\{{table\*?\}}') AS has_tables, regexp_matches(tex, '(?s)\\begin\{{(equation\*?|align\*?)\}}|\$[^$]{{2,200}}\$') AS has_equations FROM f"""))
def content_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document has tables and equations."""
    out = derived(spark, sf_dir, _TEX)
    return out.select("id", (F.size(L.tables(F.col("tex"))) > 0).alias("has_tables"), (F.size(L.equations(F.col("tex"))) > 0).alias("has_equations"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '\$([^$]{2,200})\$', 1))::INT AS n, md5(array_to_string(regexp_extract_all(text, '\$([^$]{2,200})\$', 1)[1:100], '|')) AS digest FROM documents")
def inline_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.regexp_extract_all("text", F.lit(L.INLINE), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(every).alias("n"), F.md5(F.array_join(F.slice(every, 1, L.INLINE_LIMIT), "|")).alias("digest"))


_BIB = """SELECT 'd' || doc_id AS id, replace(replace(t, '~', chr(10)), '#', PLAIN(text)) AS text FROM documents JOIN (VALUES
(1, 'References~[1] Smith, J. and Doe, A. "A long title about graphs". In Conference on Graphs, 2019. arXiv:1901.12345~[2] Too short~[3] Brown, B. Study of numbers and their many uses. Journal 2020. doi: 10.1145/12345.678~[4] # in all of it, 2011'),
(2, 'Bibliography~Knuth, D. The art of programming in several volumes. 1968.~~Smith et al. _An italic title here for all_ Proceedings of Something Big 2001~~tiny~~# and so on, 1999'),
(3, 'Works Cited~Alpha and Beta wrote a long paper of~many words that goes on and on for a while, 1999~Gamma wrote another~of them in a very long line indeed that lasts, 2005~And # last'),
(4, ''), (5, 'Literature Cited~[7] PMID: 12345 exactly twenty~[8] exactly twenty-one!!~[9] Lee et al. *Starred titles are read as well here* SSRN: 998877, Proceedings of The Tenth Meeting, 2011~[10] #'),
(6, 'No header here, but a paragraph of well over thirty characters.~~exactly thirty characters, ok!~~thirty-one characters this is!!~~#')) AS v(k, t) ON k = doc_id % 6 + 1"""

_HEADER = "'(?i)^(References|Bibliography|Works Cited|Literature Cited)\\s*\\n?'"


def _entries_sql(source: str) -> str:
    """Tables up to ``entry`` (paper, number, raw): numbered entries, else paragraphs, else lines folded one after the other."""
    return rf"""body AS (SELECT id AS paper, regexp_replace(text, {_HEADER}, '') AS b FROM {source}),
numbered AS (SELECT paper, n[i] AS number, trim(p[i + 1], ' ' || chr(10)) AS raw FROM (SELECT paper, n, p, unnest(generate_series(1, len(n))) AS i FROM (SELECT paper, regexp_extract_all(b, '\[(\d+)\]', 1) AS n, regexp_split_to_array(b, '\[\d+\]') AS p FROM body))),
blocks AS (SELECT paper, row_number() OVER (PARTITION BY paper ORDER BY i)::VARCHAR AS number, x AS raw FROM (SELECT paper, i, trim(p[i], ' ' || chr(10)) AS x FROM (SELECT paper, p, unnest(generate_series(1, len(p))) AS i FROM (SELECT paper, string_split(b, chr(10) || chr(10)) AS p FROM body))) WHERE length(x) > 30),
line AS (SELECT paper, row_number() OVER (PARTITION BY paper ORDER BY i) AS i, x FROM (SELECT paper, i, trim(p[i]) AS x FROM (SELECT paper, p, unnest(generate_series(1, len(p))) AS i FROM (SELECT paper, string_split(b, chr(10)) AS p FROM body))) WHERE x <> ''),
fold AS (SELECT paper, i, ' ' || x AS cur, 0 AS e FROM line WHERE i = 1
UNION ALL SELECT l.paper, l.i, CASE WHEN n THEN l.x ELSE f.cur || ' ' || l.x END, CASE WHEN n THEN f.e + 1 ELSE f.e END FROM (SELECT l.*, f.cur, f.e, regexp_matches(l.x, '^([A-Z]|\d+\.)') AND length(f.cur) > 50 AS n FROM fold f JOIN line l ON l.paper = f.paper AND l.i = f.i + 1) AS l JOIN fold f ON f.paper = l.paper AND f.i = l.i - 1),
grouped AS (SELECT paper, row_number() OVER (PARTITION BY paper ORDER BY e)::VARCHAR AS number, arg_max(cur, i) AS raw FROM fold GROUP BY paper, e HAVING length(arg_max(cur, i)) > 50),
entry AS (SELECT * FROM numbered WHERE length(raw) > 20
UNION ALL SELECT * FROM blocks WHERE paper NOT IN (SELECT paper FROM numbered)
UNION ALL SELECT * FROM grouped WHERE length(trim(raw)) >= 20 AND paper NOT IN (SELECT paper FROM numbered UNION SELECT paper FROM blocks))"""


_FIELDS_SQL = r"""found AS (SELECT *, nullif(regexp_extract(raw, '(?i)arXiv:(\d{4}\.\d{4,5})', 1), '') AS arxiv_id, nullif(regexp_extract(raw, '(?i)doi:?\s*(10\.\d{4,9}/[^\s,]+)', 1), '') AS doi, nullif(regexp_extract(raw, '(?i)PMID:?\s*(\d+)', 1), '') AS pmid, nullif(regexp_extract(raw, '(?i)SSRN[:\s]*(\d+)', 1), '') AS ssrn_id,
nullif(regexp_extract(raw, '\b((?:19|20)\d{2})\b', 1), '')::INT AS year,
trim(coalesce(nullif(regexp_extract(raw, '["]([^"]{15,200})["]', 1), ''), nullif(regexp_extract(raw, '_([^_]{15,200})_', 1), ''), nullif(regexp_extract(raw, '\*([^*]{15,200})\*', 1), ''), nullif(regexp_extract(raw, '(?:^|\. )([A-Z][^.]{15,150})\.', 1), ''))) AS title,
trim(coalesce(nullif(regexp_extract(raw, 'In\s+([A-Z][^,\n]{10,50})', 1), ''), nullif(regexp_extract(raw, '([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s+\d{4}', 1), ''), nullif(regexp_extract(raw, 'Proceedings\s+of\s+([^,\n]{10,50})', 1), ''))) AS venue,
list_filter(list_transform(string_split(coalesce(nullif(regexp_extract(raw, '^([^.]+(?:[A-Z]\.[^.]*\.)+)', 1), ''), nullif(regexp_extract(raw, '^([A-Z][a-z]+(?:\s+[A-Z]\.[^,]*,\s*)*[A-Z][a-z]+)', 1), ''), regexp_extract(raw, '([A-Z][a-z]+\s+et\s+al\.?)', 1)), ','), lambda x: trim(x)), lambda x: length(x) > 2 AND NOT regexp_matches(x, '^\d+$'))[1:5] AS authors FROM entry),
sure AS (SELECT *, round(least(1.0::DOUBLE, 0.3 + CASE WHEN coalesce(arxiv_id, doi, pmid, ssrn_id) IS NOT NULL THEN 0.4 ELSE 0 END + CASE WHEN length(title) > 10 THEN 0.2 ELSE 0 END + CASE WHEN len(authors) > 0 THEN 0.2 ELSE 0 END + CASE WHEN year IS NOT NULL THEN 0.1 ELSE 0 END + CASE WHEN venue IS NOT NULL THEN 0.1 ELSE 0 END), 2)::DOUBLE AS confidence FROM found)"""
_FIELD_NAMES = ("arxiv_id", "doi", "pmid", "ssrn_id", "year", "title", "venue", "confidence")


@query(duck(f"""WITH RECURSIVE f AS ({_BIB}), {_entries_sql('f')}, {_FIELDS_SQL}
SELECT paper, number, {', '.join(_FIELD_NAMES)}, array_to_string(authors, '|') AS authors FROM sure"""))
def biblio_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = derived(spark, sf_dir, _BIB).select(F.col("id").alias("paper"), F.explode(B.entries(F.col("text"))).alias("e")).select("paper", "e.number", B.fields(F.col("e.raw")).alias("f"))
    return e.select("paper", "number", *[f"f.{n}" for n in _FIELD_NAMES], F.array_join("f.authors", "|").alias("authors"))


_CITED = "SELECT 'd' || doc_id AS paper, replace(t, '#', PLAIN(text)) AS body FROM documents JOIN (VALUES (1, 'As shown in [1] and [3, 2], but see [9]. #'), (2, '# Only [2].'), (3, 'None here [x]. #')) AS v(k, t) ON k = doc_id % 3 + 1"


@query(duck(rf"""WITH RECURSIVE f AS ({_BIB}), {_entries_sql('f')}, cited AS (SELECT paper, trim(unnest(flatten(list_transform(regexp_extract_all(body, '\[(\d+(?:\s*,\s*\d+)*)\]', 1), lambda x: string_split(x, ','))))) AS number FROM ({_CITED}))
SELECT c.paper, c.number, e.raw IS NOT NULL AS found FROM cited c LEFT JOIN entry e ON e.paper = c.paper AND e.number = c.number"""))
def cite_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = derived(spark, sf_dir, _CITED).select("paper", F.explode(B.in_text(F.col("body"))).alias("number"))
    entries = derived(spark, sf_dir, _BIB).select(F.col("id").alias("paper"), F.explode(B.entries(F.col("text"))).alias("e")).select("paper", "e.number", "e.raw")
    return S.resolve_citations(cited, entries).select("paper", "number", F.col("raw").isNotNull().alias("found"))


_SECTIONS = """SELECT 'd' || doc_id AS id, replace(replace(t, '~', chr(10)), '#', PLAIN(text)) AS text FROM documents JOIN (VALUES (1, '# Body text.~References~[1] One entry that is long enough to be counted here.~~Appendix follows'), (2, 'No such part #'), (3, '# ~~References short'),
(4, '# Text.~Works Cited~[1] Alpha, A. "A title that is long enough" In Some Long Venue Name, 2001.~[2] short one~[3] Beta, B. Another study of things and their many uses. Nature 1999. doi: 10.1000/xyz'),
(5, '#~Bibliography: a heading whose rest goes on until the end of the text, with 2003 in it'), (6, '#' || repeat('word ', 30) || '~[1] ' || repeat('first entry text ', 8) || '~[2] ' || repeat('second entry text ', 8)),
(7, '# ' || repeat('x ', 20) || '~Adams, 1990 one~Brown, 1991 two~Clark, 1992 three~Davis et al., 1993 four~Evans, 1994 five~tail')) AS v(k, t) ON k = doc_id % 7 + 1"""

#: The section by its headings (a look-ahead at the next paragraph is a match that is cut off again), then by its numbers, then by authors and years.
_SECTION_SQL = r"""try1 AS (SELECT id, text, regexp_replace(regexp_extract(text, '(?is)\b(References|Bibliography|Works Cited|Literature Cited)\b.*?(\n\n[a-z][a-z]+|\z)', 0), '(?s)\n\n[A-Za-z]{2,}$', '') AS s1, regexp_replace(regexp_extract(text, '(?is)\b(References|Bibliography)\b(.*?)(\n\n|\z)', 0), '(?s)\n\n$', '') AS s2,
regexp_replace(regexp_extract(right(text, 8000), '(?s)\[\d+\].*?(\n\n[A-Z][a-z]+|\z)', 0), '(?s)\n\n[A-Z][a-z]+$', '') AS s3, regexp_extract(right(text, 5000), '(?s)((?:[A-Z][a-z]+(?:\s+et\s+al\.?)?,\s+\d{4}.*?\n){5,})', 0) AS s4 FROM papers),
section AS (SELECT id, CASE WHEN length(s1) > 50 THEN s1 WHEN length(s2) > 50 THEN s2 WHEN length(s3) > 200 THEN s3 ELSE nullif(s4, '') END AS section FROM try1)"""


@query(duck(f"WITH papers AS ({_SECTIONS}), {_SECTION_SQL} SELECT id, section FROM section"))
def biblio_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _SECTIONS).select("id", B.section(F.col("text")).alias("section"))


@query(duck(f"""WITH RECURSIVE papers AS ({_SECTIONS}), {_SECTION_SQL}, headed AS (SELECT id, coalesce(section, '') AS text FROM section), {_entries_sql('headed')}, {_FIELDS_SQL}
SELECT paper, number, {', '.join(_FIELD_NAMES)} FROM sure"""))
def biblio_of_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section, entries and fields of each paper, one after the other."""
    e = derived(spark, sf_dir, _SECTIONS).select(F.col("id").alias("paper"), F.explode(B.of_paper(F.col("text"))).alias("e"))
    return e.select("paper", "e.number", *[f"e.fields.{n}" for n in _FIELD_NAMES])


_CODE = """SELECT 'p' || doc_id || '/' || path AS path, replace(replace(t, '~', chr(10)), '#', PLAIN(text)) AS content FROM documents JOIN (VALUES (0, 'a/x.py', 'import os~from a import b~~class A:~    def f(self):~        pass~def g():~    return "#"~'),
(1, 'b/y.ts', 'import x from "y"~function a() { return (z) => z }~class B { } // #'), (2, 'C.java', 'import java.util.List;~public class C { class D { } } /* # */~class E~{ }'), (3, 'noext', '# plain'), (4, 'e.py', ''),
(5, 'd/z.JS', '  class X {~const f = require("f"); let import = 1~subclass Y~'), (6, 'f.py', 'x = \"\"\"doc #\"\"\"~  importing~  import z'), (7, 'g.cs', 'class Z { }'), (8, '.env', 'A=1'), (9, 'k/m.env', 'A=#~~'), (10, 'q.jl', 'import X #')) AS v(k, path, t) ON k = doc_id % 11"""


@query(duck(rf"""WITH c AS (SELECT path, content, lower(regexp_extract(path, '[^/]\.([^./]+)$', 1)) AS x, CASE WHEN content = '' THEN [] ELSE string_split(regexp_replace(content, '\n$', ''), chr(10)) END AS l FROM ({_CODE})),
k AS (SELECT *, x IN ('js', 'jsx', 'ts', 'tsx') AS script FROM c)
SELECT path, [{', '.join(f"'{v}'" for v in K.LANGUAGES.values())}][list_position([{', '.join(f"'{v}'" for v in K.LANGUAGES)}], x)] AS language, len(l)::INT AS lines, length(content)::INT AS chars,
CASE WHEN x = 'py' THEN len(list_filter(l, lambda y: regexp_matches(y, '^\s*(import|from) '))) WHEN script THEN len(list_filter(l, lambda y: contains(y, 'import ') OR contains(y, 'require('))) WHEN x = 'java' THEN len(list_filter(l, lambda y: regexp_matches(y, '^\s*import '))) ELSE 0 END::INT AS imports,
CASE WHEN x = 'py' THEN len(list_filter(l, lambda y: regexp_matches(y, '^\s*def '))) WHEN script THEN len(regexp_extract_all(content, 'function ')) + len(regexp_extract_all(content, '=>')) ELSE 0 END::INT AS functions,
CASE WHEN x = 'py' OR script THEN len(list_filter(l, lambda y: regexp_matches(y, '^\s*class '))) WHEN x = 'java' THEN len(list_filter(l, lambda y: contains(y, 'class ') AND contains(y, '{{'))) ELSE 0 END::INT AS classes,
x = 'py' AND (contains(content, repeat(chr(34), 3)) OR contains(content, repeat(chr(39), 3))) AS has_docstring FROM k"""))
def code_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _CODE).select("path", K.metadata(F.col("path"), F.col("content")).alias("m")).select("path", "m.*")


@query(duck(r"""WITH w AS (SELECT path, regexp_extract_all(content, '\b([A-Za-z_][A-Za-z0-9_]{2,})\b', 1) AS k FROM (""" + _CODE + r""")) SELECT path, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i)[1:100], '|') AS names FROM w"""))
def code_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _CODE).select("path", F.array_join(K.identifiers(F.col("content")), "|").alias("names"))
