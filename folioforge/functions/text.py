"""Column functions on text: white space, tokens, sentences, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the code points that count as white space in the texts' own language (Unicode, and \x1c-\x1f).
WS = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
#: Fixed value: the same code points one by one.
SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

#: arXiv identifiers, new style and old style.
NEW_ID = r"^\d{4}\.\d{4,5}(v\d+)?$"
OLD_ID = r"^[a-z-]+(\.[A-Z]{2})?/\d{7}(v\d+)?$"
#: Fixed value: the old style as the store's own paths have it, in lower case only.
OLD_ID_LOWER = r"^[a-z\-.]+/\d{7}(v\d+)?$"


def _nonempty(parts: Column) -> Column:
    return F.filter(parts, lambda x: x != "")


def strip(c: Column) -> Column:
    """Trim white space of any kind, not only spaces."""
    return F.btrim(c, F.lit(SPACES))


def tokens(c: Column) -> Column:
    """White-space tokens; null and blank texts have none."""
    return _nonempty(F.split(F.coalesce(c, F.lit("")), WS))


def token_count(c: Column) -> Column:
    return F.size(tokens(c))


def token_estimate(c: Column) -> Column:
    """Four characters to a token."""
    return F.floor(F.length(c) / 4)


def clean(c: Column) -> Column:
    """Runs of white space become one space, then NULs go, then the ends are trimmed."""
    return F.trim(F.replace(F.regexp_replace(c, WS, " "), F.lit("\x00"), F.lit("")))


def clean_tokens(c: Column) -> Column:
    """The tokens of a clean text, whose only white space is the space."""
    return _nonempty(F.split(c, " "))


def sentences(c: Column) -> Column:
    """Split behind . ! or ? and white space; blank parts are dropped."""
    return _nonempty(F.transform(F.split(c, r"(?<=[.!?])" + WS), strip))


def paragraphs(c: Column) -> Column:
    """Split at blank lines; blank parts are dropped."""
    return _nonempty(F.transform(F.split(c, "\n\n+"), strip))


def store_key(c: Column) -> Column:
    """A key for the store: dots and slashes become underscores (so a.b and a/b meet)."""
    return F.translate(c, "./", "__")


def author_list(c: Column) -> Column:
    return _nonempty(F.transform(F.split(c, r"[;,]\s*"), lambda x: F.trim(x)))


def category_list(c: Column) -> Column:
    return tokens(c)


def id_of_url(c: Column) -> Column:
    """The last path segment without query, trailing slash and .pdf."""
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\?.*$", ""), "/+$", ""), r"\.pdf$", "")
    return F.element_at(F.split(path, "/"), -1)


def id_parts(c: Column) -> Column:
    """struct(base, version, yymm, number, category, style) of an arXiv id; the version is v1 if none is given, style null if invalid."""
    version = F.regexp_extract(c, r"(v\d+)$", 1)
    base = F.regexp_replace(c, r"v\d+$", "")
    new, old = c.rlike(NEW_ID), c.rlike(OLD_ID)
    return F.struct(
        base.alias("base"),
        F.when(version == "", "v1").otherwise(version).alias("version"),
        F.when(new, F.substring(base, 1, 4)).when(old, F.substring(F.element_at(F.split(base, "/"), -1), 1, 4)).alias("yymm"),
        F.when(new, F.element_at(F.split(base, r"\."), -1)).when(old, F.substring(F.element_at(F.split(base, "/"), -1), 5, 3)).alias("number"),
        F.when(old, F.element_at(F.split(base, "/"), 1)).alias("category"),
        F.when(new, "new").when(old, "old").alias("style"),
    )


def valid_id(c: Column) -> Column:
    return c.rlike(NEW_ID) | c.rlike(OLD_ID)


def valid_path_id(c: Column) -> Column:
    """The store's own grammar: the version is taken off first, and an old category is in lower case with dots anywhere."""
    base = F.regexp_replace(c, r"v\d+$", "")
    return base.rlike(NEW_ID) | base.rlike(OLD_ID_LOWER)


def month_folder(c: Column) -> Column:
    """YYMM of an id, 0000 where there is none."""
    return F.coalesce(id_parts(c)["yymm"], F.lit("0000"))


def first_nonempty(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def fenced(code: Column, language: Column) -> Column:
    """A fenced markdown block."""
    return F.concat(F.lit("```"), language, F.lit("\n"), code, F.lit("\n```"))


def page_join(pages: Column) -> Column:
    """Pages joined with numbered separators."""
    return F.array_join(F.transform(pages, lambda p, i: F.concat(F.lit("--- Page "), (i + 1).cast("string"), F.lit(" ---\n"), p)), "\n\n")


def count_of(c: Column, part: str) -> Column:
    """How often a fixed string occurs."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("int")
