"""Operators on records of papers, runs, metrics and messages: projections, payloads, summaries, filters."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sentences, tokens
from ..functions.vectors import cosine
from .lineage import totals_before


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of an order; with an order that has no ties the same rows each time."""
    return df.orderBy(*order).offset(offset).limit(limit)


def average_children(parents: DataFrame, children: DataFrame, key: str, name: str = "average") -> DataFrame:
    """One row: parents, children, and children for each parent (null without parents)."""
    n = parents.agg(F.count("*").alias("parents"))
    m = children.join(parents.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("children"))
    return n.join(F.broadcast(m)).withColumn(name, F.try_divide(F.col("children").cast("double"), F.col("parents")))  # one row each


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Nulls of the named columns replaced; columns that are missing are added."""
    return df.withColumns({n: F.coalesce(F.col(n), d) if n in df.columns else d for n, d in defaults.items()})


def processed(docs: DataFrame, chunks: DataFrame, key: str, *, tables: Column, equations: Column) -> DataFrame:
    """A row for each document: chunk_count, success, errors, warnings, flags and the payload as JSON.

    A document without chunks is an error row.  Chunks: rows (key, chunk_index,
    text and others); they travel without the documents' texts.
    """
    inside = chunks.groupBy(key).agg(F.count("*").alias("chunk_count"), F.array_sort(F.collect_list(F.struct("chunk_index", *[c for c in chunks.columns if c not in (key, "chunk_index")]))).alias("chunks"))
    flags = docs.select(key, (F.coalesce(F.size(tables), F.lit(0)) > 0).alias("has_tables"), (F.coalesce(F.size(equations), F.lit(0)) > 0).alias("has_equations"))
    out = flags.join(inside, key, "left").withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0)))
    good = F.col("chunk_count") > 0
    none = F.array().cast("array<string>")
    out = out.withColumns({"success": good, "errors": F.when(good, none).otherwise(F.array(F.lit("Document produced no chunks"))), "warnings": F.when(good, none).otherwise(F.array(F.lit("Empty or unprocessable document")))})
    meta = F.struct("chunk_count", "has_tables", "has_equations")
    return out.withColumn("payload", F.to_json(F.struct(F.col(key).cast("string").alias("document_id"), F.coalesce("chunks", F.array().cast(dict(inside.dtypes)["chunks"])).alias("chunks"), meta.alias("processing_metadata"), "success", "errors", "warnings"))).drop("chunks")


def run_summary(runs: DataFrame) -> DataFrame:
    """Duration and success in percent of runs (start_time, end_time, items_processed, items_failed): 0 where nothing was done."""
    total = F.col("items_processed") + F.col("items_failed")
    span = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6
    return runs.withColumns({"duration_seconds": span, "success_rate": F.when(total == 0, 0.0).otherwise(F.try_divide(F.col("items_processed") * 100.0, total))})


def batch_parts(results: DataFrame, batch: str, item: str, size: int = 1000) -> DataFrame:
    """Per batch and success: the items in order, in numbered parts of at most ``size``, with the batch's totals.

    Items are numbered by ranges of the order, so that a batch may have any number
    of them: no task and no row holds more than a part.
    """
    totals = results.groupBy(batch).agg(F.count_if("success").alias("items_succeeded"), F.count_if(~F.col("success")).alias("items_failed"), F.coalesce(F.sum(F.when(F.col("success"), F.col("num_chunks"))), F.lit(0)).alias("chunks_created"))
    numbered = totals_before(results.select(batch, item, "success"), [batch, "success"], [F.col(item)], {"_number": F.lit(1)}).withColumn("part", F.floor(F.col("_number") / size).cast("int"))
    parts = numbered.groupBy(batch, "success", "part").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return parts.join(totals, batch)


def batch_summary(results: DataFrame, batch: str, item: str) -> DataFrame:
    """Per batch: the items that succeeded and failed, in order, and the chunks that were made of those that succeeded.

    For batches that fit a row each; ``batch_parts`` is for those that do not.
    """
    named = lambda good: F.array_sort(F.collect_list(F.when(F.col("success") == good, F.col(item))))
    return results.groupBy(batch).agg(named(True).alias("succeeded"), named(False).alias("failed"), F.coalesce(F.sum(F.when(F.col("success"), F.col("num_chunks"))), F.lit(0)).alias("chunks_created"))


def with_eta(overall: DataFrame, started: Column, as_of: Column) -> DataFrame:
    """Rate and estimated end of trackers (total, completed, failed, skipped): null where nothing has been done, or nothing is left."""
    done = F.col("completed") + F.col("failed") + F.col("skipped")
    seconds = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))) / 1e6
    rate = F.when(seconds > 0, done / seconds)
    left = F.col("total") - done
    return overall.withColumn("rate", rate).withColumn("seconds_left", F.when((left > 0) & (F.col("rate") > 0), left / F.col("rate")))


def registered(metrics: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Of registrations with one name the first counts; ``repeats`` is how many others there were."""
    w = Window.partitionBy(name)
    return metrics.withColumns({"_n": F.row_number().over(w.orderBy(*order)), "repeats": F.count("*").over(w) - 1}).where("_n = 1").drop("_n")


def error_points(errors: DataFrame) -> DataFrame:
    """Two points for each error (component, kind, message, ts): one more on its counter, and the last error with its labels."""
    label = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)])
    one = F.struct(F.concat(F.col("component"), F.lit("_errors")).alias("series"), F.lit(1.0).alias("value"), label(error_type=F.col("kind")).alias("labels"))
    last = F.struct(F.concat(F.col("component"), F.lit("_last_error")).alias("series"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("value"), label(error_type=F.col("kind"), message=F.col("message")).alias("labels"))
    return errors.select("ts", F.explode(F.array(one, last)).alias("p")).select("ts", "p.*")


def absolute_counters(updates: DataFrame, key: str, order: list[str], counters: list[str]) -> DataFrame:
    """The newest value of each counter that was given: a null leaves the one before it."""
    return updates.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in counters])


def search(papers: DataFrame, *, years: tuple[int, int] | None = None, categories: list[str] | None = None, any_of: list[str] | None = None, all_of: list[str] | None = None, phrase: str | None = None, without: DataFrame | None = None, key: str = "id", year: str = "year", category: str = "categories", text: str = "text") -> DataFrame:
    """Papers within years, of categories, with any, all or a phrase of words, and not among the keys of ``without``."""
    tests = []
    if years:
        tests.append(F.col(year).between(*years))
    if categories:
        tests.append(F.arrays_overlap(F.col(category), F.array(*map(F.lit, categories))))
    low = F.lower(F.col(text))
    if any_of:
        tests.append(functools.reduce(lambda a, b: a | b, [low.contains(w.lower()) for w in any_of]))
    tests += [low.contains(w.lower()) for w in all_of or []]
    if phrase:
        tests.append(has_phrase(F.col(text), phrase))
    out = papers.where(functools.reduce(lambda a, b: a & b, tests, F.lit(True)))
    return out if without is None else out.join(without.select(key).distinct(), key, "left_anti")


def has_phrase(text: Column, phrase: str) -> Column:
    """Whether the words of a phrase stand side by side in a text, whatever their case and the white space between."""
    words = F.concat(F.lit(" "), F.array_join(tokens(F.lower(text)), " "), F.lit(" "))
    return words.contains(" " + " ".join(phrase.lower().split()) + " ")


def bands(confidence: Column) -> Column:
    """high from 0.8 on, medium from 0.6 on, else low; rounded first, so that sums of tenths fall where they should."""
    c = F.round(confidence, 6)
    return F.when(c >= 0.8, "high").when(c >= 0.6, "medium").when(c.isNotNull(), "low")


def pressure(messages: DataFrame, key: str, position: str, size: Column, budget: float, pinned: Column, *, warn: float = 0.7, flush: float = 0.9, target: float = 0.5) -> DataFrame:
    """First in, first out: a queue over ``flush`` of its budget keeps its newest messages within ``target`` of it; pinned ones always stay.

    state: ok, warn (over ``warn``) or flush, by all of a key's messages.
    """
    newest = Window.partitionBy(key).orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(pinned, 0).otherwise(F.col("size"))
    sized = messages.withColumn("size", size).withColumn("load", F.sum("size").over(Window.partitionBy(key))).withColumn("_held", F.sum(own).over(newest))
    state = F.when(F.col("load") > flush * budget, "flush").when(F.col("load") > warn * budget, "warn").otherwise("ok")
    return sized.withColumn("state", state).withColumn("kept", (F.col("state") != "flush") | pinned | (F.col("_held") <= target * budget)).drop("_held")


def expired(ts: Column, as_of: Column, seconds: float) -> Column:
    """Whether a time lies more than ``seconds`` before ``as_of``; an unknown time has expired."""
    return F.coalesce((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / 1e6 > seconds, F.lit(True))


def merged(base: Column, override: Column) -> Column:
    """Two maps as one: the override's entry wins, nulls count as empty maps."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(base, none), F.coalesce(override, none)
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


#: Names of types in a schema, and the variant types that pass as them (a boolean passes as a number).
SCHEMA_TYPES = {"string": "^STRING", "integer": "^(BIGINT|BOOLEAN)", "number": "^(BIGINT|DOUBLE|DECIMAL|FLOAT|BOOLEAN)", "boolean": "^BOOLEAN", "array": "^ARRAY", "object": "^OBJECT"}


def schema_errors(text: Column, types: dict[str, str], required: list[str]) -> Column:
    """array<string>: fields of a JSON object of another type than the schema says (unknown types pass), and required ones that are missing."""
    v = F.try_parse_json(text)
    has = lambda n: F.coalesce(F.array_contains(F.json_object_keys(text), n), F.lit(False))
    kind = lambda n: F.schema_of_variant(F.try_variant_get(v, f"$.{n}", "variant"))
    wrong = [F.when(has(n) & ~F.coalesce(kind(n).rlike(SCHEMA_TYPES[t]), F.lit(False)), F.lit(f"{n}: expected {t}")) for n, t in types.items() if t in SCHEMA_TYPES]
    missing = [F.when(~has(n), F.lit(f"{n}: missing")) for n in required]
    return F.array_compact(F.array(*wrong, *missing))


def json_shape(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """How many keys a JSON document has and how deep its objects and lists are nested; null for what is no JSON."""

    def shape(value) -> tuple[int, int]:
        keys, depth, level = 0, 0, [value]
        while level:
            inside = [x for x in level if isinstance(x, (dict, list))]
            keys += sum(len(x) for x in inside if isinstance(x, dict))
            level = [y for x in inside for y in (x.values() if isinstance(x, dict) else x)]
            depth += bool(inside)
        return keys, depth

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(text).to_pylist():
                try:
                    found.append(shape(json.loads(t)) if t is not None else (None, None))
                except (ValueError, RecursionError):
                    found.append((None, None))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))], names=[*keep, "key_count", "depth"])

    kinds = dict(df.dtypes)
    return df.select(*keep, text).mapInArrow(each, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "key_count long", "depth long"]))


def drift(before: Column, after: Column, least: float = 0.85) -> Column:
    """Whether a summary has to be made again: its vector has turned from the one before, or there is none."""
    return F.coalesce(cosine(before, after) < least, F.lit(True))


def vector_or_zero(vector: Column, dim: int) -> Column:
    return F.coalesce(vector, F.array_repeat(F.lit(0.0), dim))


def cooled(events: DataFrame, key: str, at: str, *, seconds: float, most: int, cooldown: float) -> DataFrame:
    """Flags events beyond ``most`` in the seconds up to them, and those within the cool-down behind a flagged one.

    ``at``: a column of seconds.
    """
    w = Window.partitionBy(key).orderBy(at)
    counted = events.withColumn("in_window", F.count("*").over(w.rangeBetween(-seconds, 0))).withColumn("limited", F.col("in_window") > most)
    last = F.max(F.when(F.col("limited"), F.col(at))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("cooling", F.coalesce(F.col(at) - last < cooldown, F.lit(False)))


def sentence_facts(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Sentences and different sentences of a text, and whether none repeats."""
    s = sentences(F.col(text))
    return df.select(*keep, F.size(s).alias("sentences"), F.size(F.array_distinct(s)).alias("different"), (F.size(s) == F.size(F.array_distinct(s))).alias("all_different"))
