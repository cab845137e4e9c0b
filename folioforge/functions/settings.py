"""Column functions on settings: values of environment variables, bind variables, names of models and paths of papers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that are true, and false, before anything is taken for a number.
TRUE, FALSE = ("true", "yes", "1", "on"), ("false", "no", "0", "off")
_INT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
_FLOAT = r"^\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
#: Parts of a model's name, in this order, and the kind of embedder they stand for.
EMBEDDERS = (("sentence-transformers", "sentence"), ("st-", "sentence"), ("transformers", "jina"), ("jina", "jina"), ("openai", "openai"), ("text-embedding", "openai"), ("cohere", "cohere"))
#: The two forms of a paper's identifier without its version.
_NEW, _OLD = r"^([0-9]{4})\.[0-9]{4,5}$", r"^[a-z-]+(\.[A-Z]{2})?/([0-9]{4})[0-9]{3}$"


def coerced(value: Column) -> Column:
    """struct<kind, json>: what a setting's text stands for (bool, int, float or str), and that as JSON; null is null."""
    low = F.lower(value)
    plain = F.regexp_replace(F.trim(value, F.lit(" \t\r\n")), "_", "")
    integer = F.regexp_replace(plain, "^\\+", "")
    return (
        F.when(value.isNull(), F.struct(F.lit(None).cast("string").alias("kind"), F.lit("null").alias("json")))
        .when(low.isin(*TRUE), F.struct(F.lit("bool").alias("kind"), F.lit("true").alias("json")))
        .when(low.isin(*FALSE), F.struct(F.lit("bool").alias("kind"), F.lit("false").alias("json")))
        .when(value.rlike(_FLOAT), F.struct(F.lit("float").alias("kind"), plain.cast("double").cast("string").alias("json")))
        .when(value.rlike(_INT), F.struct(F.lit("int").alias("kind"), F.regexp_replace(integer, "^(-?)0+(?=[0-9])", "$1").alias("json")))
        .otherwise(F.struct(F.lit("str").alias("kind"), F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'^\{"v":(.*)\}$', 1).alias("json")))
    )


def bind_variable(text: Column) -> Column:
    """struct<key, value, is_json> of ``key:value``; null where nothing is before the colon."""
    at = F.instr(text, ":")
    key = F.trim(F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text))
    value = F.when(at > 0, F.trim(F.substring(text, at + 1, F.length(text)))).otherwise("")
    return F.when((F.length(text) > 0) & (at != 1), F.struct(key.alias("key"), value.alias("value"), F.try_parse_json(value).isNotNull().alias("is_json")))


def embedder(model: Column) -> Column:
    """The kind of embedder that a model's name stands for; jina where nothing is known."""
    out = F.lit("jina")
    for part, kind in reversed(EMBEDDERS):
        out = F.when(F.lower(model).contains(part), kind).otherwise(out)
    return out


def base_id(id_: Column) -> Column:
    return F.regexp_replace(id_, r"v[0-9]+$", "")


def pdf_path(id_: Column, folder: str) -> Column:
    """Where a paper's PDF is: by month, a slash of the identifier as an underscore; null for what is no identifier."""
    base = base_id(id_)
    month = F.when(base.rlike(_NEW), F.regexp_extract(base, _NEW, 1)).when(base.rlike(_OLD), F.regexp_extract(base, _OLD, 2))
    return F.concat(F.lit(folder.rstrip("/") + "/"), month, F.lit("/"), F.replace(base, F.lit("/"), F.lit("_")), F.lit(".pdf"))


def main_source(id_: Column, files: Column) -> Column:
    """The main one of a paper's source files: main.tex, paper.tex, the identifier's own, else the first by name; null without any."""
    sources = F.array_sort(F.filter(files, lambda f: f.endswith(".tex")))
    wanted = F.array(F.lit("main.tex"), F.lit("paper.tex"), F.concat(base_id(id_), F.lit(".tex")))
    return F.coalesce(F.get(F.filter(wanted, lambda w: F.array_contains(sources, w)), F.lit(0)), F.get(sources, F.lit(0)))


def overlap_ratio(step: Column, window: Column) -> Column:
    """The share of a window that the one before it has too."""
    return F.lit(1.0) - F.try_divide(step.cast("double"), window.cast("double"))
