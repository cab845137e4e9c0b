"""Column functions on source code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, count_of

#: File suffixes and their languages.
LANGUAGES = {
    "py": "python", "js": "javascript", "jsx": "javascript", "ts": "typescript", "tsx": "typescript", "java": "java", "go": "go", "rs": "rust", "cpp": "cpp", "cc": "cpp", "cxx": "cpp",
    "c": "c", "h": "c", "hpp": "cpp", "cs": "c_sharp", "rb": "ruby", "php": "php", "swift": "swift", "kt": "kotlin", "scala": "scala", "r": "r", "lua": "lua", "jl": "julia", "m": "objc", "mm": "objc",
    "sh": "bash", "bash": "bash", "zsh": "bash", "yaml": "yaml", "yml": "yaml", "json": "json", "xml": "xml", "html": "html", "css": "css", "scss": "scss", "sql": "sql", "md": "markdown",
    "markdown": "markdown", "toml": "toml", "ini": "ini", "cfg": "ini", "conf": "ini", "properties": "ini", "env": "ini",
}
#: Fixed value: what ends a line of source.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def suffix(path: Column) -> Column:
    """The suffix of a file's name in lower case; a name that only begins with a dot has none."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))


def language(path: Column) -> Column:
    """Language by the file's suffix, null if unknown."""
    table = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return table[suffix(path)]


def metadata(path: Column, content: Column) -> Column:
    """struct of line and character counts, and of imports, functions and classes by simple signs.

    Signs are those of Python, of scripts (js, jsx, ts, tsx) and of Java; files of
    other kinds count 0 of each.  A null content counts as empty.
    """
    text, ext = F.coalesce(content, F.lit("")), suffix(path)
    python, script, java = ext == "py", ext.isin("js", "jsx", "ts", "tsx"), ext == "java"
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(text, rf"({LINE_END})\z", ""), LINE_END))

    def lines_where(test) -> Column:
        return F.size(F.filter(lines, test))

    def begins(*words: str) -> Column:
        return lines_where(lambda x: x.rlike(f"^(?:{WS})?(?:{'|'.join(words)})"))

    imports = F.when(python, begins("import ", "from ")).when(script, lines_where(lambda x: x.contains("import ") | x.contains("require("))).when(java, begins("import ")).otherwise(0)
    functions = F.when(python, begins("def ")).when(script, count_of(text, "function ") + count_of(text, "=>")).otherwise(0)
    classes = F.when(python | script, begins("class ")).when(java, lines_where(lambda x: x.contains("class ") & x.contains("{"))).otherwise(0)
    docstring = python & (text.contains('"""') | text.contains("'''"))
    return F.struct(language(path).alias("language"), F.size(lines).alias("lines"), F.length(text).alias("chars"), imports.alias("imports"), functions.alias("functions"), classes.alias("classes"), F.coalesce(docstring, F.lit(False)).alias("has_docstring"))


def identifiers(content: Column, most: int = 100) -> Column:
    """The first distinct identifiers of more than two characters."""
    return F.slice(F.array_distinct(F.regexp_extract_all(content, F.lit(r"\b([A-Za-z_][A-Za-z0-9_]{2,})\b"), F.lit(1))), 1, most)


def symbol_digest(symbols: Column) -> Column:
    """SHA-256 of a map category -> names, in the order of the categories and names."""
    entries = F.array_sort(F.map_entries(symbols))
    return F.sha2(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), F.array_join(F.array_sort(e["value"]), ","), F.lit(";"))), ""), 256)
