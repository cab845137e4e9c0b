"""Column functions on LaTeX sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The environments and commands looked for.
DISPLAY = r"(?s)\\begin\{equation\}(.*?)\\end\{equation\}"
DISPLAY_STAR = r"(?s)\\begin\{equation\*\}(.*?)\\end\{equation\*\}"
ALIGN = r"(?s)\\begin\{align\*?\}(.*?)\\end\{align\*?\}"
INLINE = r"\$([^$]{2,200})\$"
LABEL = r"\\label\{([^}]+)\}"
TABLE = r"(?s)\\begin\{table\*?\}(.*?)\\end\{table\*?\}"
CAPTION = r"\\caption\{((?:[^{}]|\{[^}]*\})*)\}"
TABULAR = r"(?s)\\begin\{tabular\}(.*?)\\end\{tabular\}"
ARRAY = r"(?s)\\begin\{array\}(.*?)\\end\{array\}"
COLUMNS = r"\\begin\{(?:tabular|array)\}\{([^}]+)\}"
CITE = r"\\cite[pt]?\{([^}]+)\}"
SECTION = r"\\(section|subsection|subsubsection|paragraph)\{([^}]+)\}"
INLINE_LIMIT = 100


def _all(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _labelled(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("type"), F.trim(F.regexp_replace(x, LABEL, ""), F.lit(" \t\r\n")).alias("latex"), _first(x, LABEL).alias("label")))


def _plain(found: Column, kind: str, trim: bool) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("type"), (F.trim(x, F.lit(" \t\r\n")) if trim else x).alias("latex"), F.lit(None).cast("string").alias("label")))


def equations(c: Column) -> Column:
    """array<struct<type, latex, label>>: display, starred display, align, and the first 100 inline ones."""
    inline = F.slice(_all(c, INLINE), 1, INLINE_LIMIT)
    return F.concat(_labelled(_all(c, DISPLAY), "display"), _plain(_all(c, DISPLAY_STAR), "display_unnumbered", True), _labelled(_all(c, ALIGN), "align"), _plain(inline, "inline", False))


def tables(c: Column) -> Column:
    """array<struct<caption, label, latex, column_spec, full_content>>; full_content is all that the environment holds."""

    def one(x: Column) -> Column:
        body = F.coalesce(_first(x, TABULAR, 0), _first(x, ARRAY, 0), x)
        return F.struct(_first(x, CAPTION).alias("caption"), _first(x, LABEL).alias("label"), body.alias("latex"), _first(body, COLUMNS).alias("column_spec"), x.alias("full_content"))

    return F.transform(_all(c, TABLE), one)


def citations(c: Column) -> Column:
    """Citation keys, each once, in the order of their first use."""
    return F.array_distinct(F.transform(F.flatten(F.transform(_all(c, CITE), lambda x: F.split(x, ","))), lambda k: F.trim(k, F.lit(" \t\r\n"))))


def sections(c: Column) -> Column:
    """array<struct<level, title, position>>: position in code points.

    The text between matches is what a split by the pattern leaves, so positions
    are running sums of lengths.
    """
    marks = F.arrays_zip(_all(c, SECTION, 0).alias("whole"), _all(c, SECTION, 1).alias("level"), _all(c, SECTION, 2).alias("title"), F.slice(F.split(c, SECTION, -1), 1, F.greatest(F.size(_all(c, SECTION, 0)), F.lit(1))).alias("before"))
    start = F.struct(F.array().cast("array<struct<level:string,title:string,position:int>>").alias("out"), F.lit(0).alias("at"))

    def add(acc: Column, m: Column) -> Column:
        here = acc["at"] + F.length(m["before"])
        return F.struct(F.concat(acc["out"], F.array(F.struct(m["level"].alias("level"), m["title"].alias("title"), here.cast("int").alias("position")))).alias("out"), (here + F.length(m["whole"])).cast("int").alias("at"))

    return F.aggregate(F.filter(marks, lambda m: m["whole"].isNotNull()), start, add, lambda acc: acc["out"])
