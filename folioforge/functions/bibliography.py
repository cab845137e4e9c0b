"""Column functions on bibliographies: section, entries, fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: How sections, entries and fields are recognised.
HEADER = r"(?i)^(References|Bibliography|REFERENCES|BIBLIOGRAPHY|Works Cited|Literature Cited)\s*\n?"
SECTIONS = (
    r"(?is)\b(References|Bibliography|REFERENCES|BIBLIOGRAPHY|Works Cited|Literature Cited)\b.*?(?=\n\n[A-Z][a-z]+|\z)",
    r"(?is)\b(References|Bibliography)\b(.*?)(?=\n\n|\z)",
    r"(?is)## References(.*?)(?=\n##|\z)",
    r"(?is)# References(.*?)(?=\n#|\z)",
)
NUMBERED_TAIL = r"(?s)(\[\d+\].*?)(?=\n\n[A-Z][a-z]+|\z)"
AUTHOR_YEAR_TAIL = r"(?s)((?:[A-Z][a-z]+(?:\s+et\s+al\.?)?,\s+\d{4}.*?\n){5,})"
ENTRY = r"(?s)\[(\d+)\]\s*(.*?)(?=\[\d+\]|\z)"
ARXIV = r"(?i)arXiv:(\d{4}\.\d{4,5})"
DOI = r"(?i)doi:?\s*(10\.\d{4,9}/[^\s,]+)"
PMID = r"(?i)PMID:?\s*(\d+)"
SSRN = r"(?i)SSRN[:\s]*(\d+)"
YEAR = r"\b((?:19|20)\d{2})\b"
TITLES = (r'["]([^"]{15,200})["]', r"_([^_]{15,200})_", r"\*([^*]{15,200})\*", r"(?:^|\. )([A-Z][^.]{15,150})\.")
AUTHORS = (r"^([^.]+(?:[A-Z]\.[^.]*+\.)++)", r"^([A-Z][a-z]+(?:\s+[A-Z]\.[^,]*,\s*)*[A-Z][a-z]+)", r"([A-Z][a-z]+\s+et\s+al\.?)")
#: Possessive, which changes no match: a run of very many names would be a recursion of the engine for each of them.
VENUES = (r"In\s+([A-Z][^,\n]{10,50})", r"([A-Z][a-z]++(?:\s++[A-Z][a-z]++)*+)\s++\d{4}", r"Proceedings\s+of\s+([^,\n]{10,50})")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return _once(F.regexp_extract(c, pattern, group), lambda x: F.when(x != "", x))


def section(text: Column) -> Column:
    """The references section of a paper, null if there is none."""
    longer = lambda c, pattern, n: _once(F.regexp_extract(c, pattern, 0), lambda x: F.when(F.length(x) > n, x))
    return F.coalesce(*[longer(text, p, 50) for p in SECTIONS], longer(F.right(text, F.lit(8000)), NUMBERED_TAIL, 200), _found(F.right(text, F.lit(5000)), AUTHOR_YEAR_TAIL, 0))


def _grouped_lines(body: Column) -> Column:
    """Lines folded into entries: a line that begins with a capital or a number ends an entry of over 50 characters."""
    lines = F.filter(F.transform(F.split(body, "\n"), strip), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def add(acc: Column, line: Column) -> Column:
        new = line.rlike(r"^([A-Z]|\d+\.)") & (F.length(acc["cur"]) > 50)
        return F.struct(F.when(new, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"]).alias("done"), F.when(new, line).otherwise(F.concat(acc["cur"], F.lit(" "), line)).alias("cur"))

    return F.aggregate(lines, start, add, lambda acc: F.when(F.length(acc["cur"]) > 50, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"]))


def entries(text: Column) -> Column:
    """array<struct<number, raw>>: numbered entries, else paragraphs, else grouped lines; short ones are left out."""
    count = lambda parts: F.transform(parts, lambda x, i: F.struct((i + 1).cast("string").alias("number"), x.alias("raw")))

    def numbered(body: Column, numbers: Column) -> Column:
        texts = F.regexp_extract_all(body, F.lit(ENTRY), F.lit(2))
        return F.filter(F.transform(F.arrays_zip(numbers.alias("n"), texts.alias("t")), lambda x: F.struct(x["n"].alias("number"), strip(x["t"]).alias("raw"))), lambda x: F.length(x["raw"]) > 20)

    def lines(body: Column) -> Column:
        return F.filter(count(_grouped_lines(body)), lambda x: F.length(strip(x["raw"])) >= 20)

    def plain(body: Column) -> Column:
        blocks = count(F.filter(F.transform(F.split(body, "\n\n"), strip), lambda x: F.length(x) > 30))
        return _once(blocks, lambda b: F.when(F.size(b) > 0, b).otherwise(lines(body)))

    def of_body(body: Column) -> Column:
        return _once(F.regexp_extract_all(body, F.lit(ENTRY), F.lit(1)), lambda n: F.when(F.size(n) > 0, numbered(body, n)).otherwise(plain(body)))

    return _once(F.regexp_replace(text, HEADER, ""), of_body)


def fields(raw: Column) -> Column:
    """struct of an entry's identifiers, year, title, authors, venue and confidence; each pattern goes over the entry once at most."""
    found = {
        **{n: _found(raw, p) for n, p in (("arxiv_id", ARXIV), ("doi", DOI), ("pmid", PMID), ("ssrn_id", SSRN))},
        "year": _found(raw, YEAR).cast("int"),
        "title": strip(F.coalesce(*[_found(raw, p) for p in TITLES])),
        "names": F.coalesce(*[_found(raw, p) for p in AUTHORS]),
        "venue": strip(F.coalesce(*[_found(raw, p) for p in VENUES])),
    }
    has = lambda c, w: F.when(c, F.lit(w)).otherwise(F.lit(0.0))

    def rated(x: Column) -> Column:
        authors = F.coalesce(F.slice(F.filter(F.transform(F.split(x["names"], ","), strip), lambda a: (F.length(a) > 2) & ~a.rlike(r"^\d+$")), 1, 5), F.array().cast("array<string>"))
        sure = 0.3 + has(F.coalesce(*[x[n] for n in ("arxiv_id", "doi", "pmid", "ssrn_id")]).isNotNull(), 0.4) + has(F.length(x["title"]) > 10, 0.2) + has(F.size(authors) > 0, 0.2) + has(x["year"].isNotNull(), 0.1) + has(x["venue"].isNotNull(), 0.1)
        return F.struct(*[x[n].alias(n) for n in ("arxiv_id", "doi", "pmid", "ssrn_id", "year", "title")], authors.alias("authors"), x["venue"].alias("venue"), F.round(F.least(F.lit(1.0), sure), 2).alias("confidence"))

    return _once(F.struct(*[c.alias(n) for n, c in found.items()]), rated)


def of_paper(text: Column) -> Column:
    """array<struct<number, raw, fields>>: the entries of a paper's references section with their fields, empty where it has none."""
    found = entries(F.coalesce(section(text), F.lit("")))
    return F.transform(found, lambda e: F.struct(e["number"].alias("number"), e["raw"].alias("raw"), fields(e["raw"]).alias("fields")))


def in_text(text: Column) -> Column:
    """array<string>: the numbers cited in a text as [1] or [1, 2-4 ...] (ranges stay as they are written)."""
    return F.filter(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(r"\[(\d+(?:\s*,\s*\d+)*)\]"), F.lit(1)), lambda x: F.split(x, r"\s*,\s*"))), lambda x: x != "")
