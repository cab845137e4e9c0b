"""Records of composite scores: a metric read from a benchmark's result by its path, scaled, scored and logged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..sources.sinks import append_lines


def at_path(text: Column, path: list[Column]) -> Column:
    """The number at a nested path of a JSON object; a step that is not there, and a value that is no number, are errors that name it."""
    here, walked = text, F.lit("$")
    for name in path:
        walked = F.concat(walked, F.lit("."), name)
        found = F.array_contains(F.coalesce(F.json_object_keys(here), F.array().cast("array<string>")), name)
        here = F.when(found, F.from_json(here, "map<string,string>")[name]).otherwise(F.raise_error(F.concat(F.lit("no such key: "), walked)))
    number = here.try_cast("double")
    return F.when(number.isNotNull(), number).otherwise(F.raise_error(F.concat(F.lit("no number at "), walked)).cast("double"))


def records(df: DataFrame, *, result: str, path: list[Column], unit: Column, what: Column, where: Column, who: Column, context: dict[str, Column], weights: dict[str, float] | None = None, alpha: Column, label: Column, at: Column) -> DataFrame:
    """``df`` with a struct ``record`` for each row: label, time, factors, context and both scores.

    The exponent has to be within its range and the unit known, else it is an error.
    Weights are equal if none are given.
    """
    shares = weights or {n: 1.0 / len(context) for n in context}
    raw = at_path(F.col(result), path)
    parts = {"what": what.cast("double"), "where": where.cast("double"), "who": who.cast("double")}
    row = df.withColumns({"_raw": raw, "_unit": unit, "_alpha": S.checked_alpha(alpha), "_ctx": S.context(list(context.values()), [shares[n] for n in context]), **{f"_{n}": c for n, c in parts.items()}})
    row = row.withColumn("_seconds", S.seconds(F.col("_raw"), F.col("_unit")))
    c = {n: F.col(f"_{n}") for n in ("what", "where", "who", "seconds", "ctx", "alpha")}
    record = F.struct(
        label.alias("label"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), F.col("_unit").alias("time_units"), F.col("_raw").alias("time_value"), c["seconds"].alias("time_seconds"),
        *[c[n].alias(n) for n in parts], c["alpha"].alias("alpha"), F.struct(*[v.alias(n) for n, v in context.items()]).alias("context"), c["ctx"].alias("context_score"),
        S.efficiency(c["what"], c["where"], c["who"], c["seconds"], c["ctx"], c["alpha"]).alias("efficiency"), S.capability(c["what"], c["where"], c["who"], c["ctx"], c["alpha"]).alias("capability"),
    )
    return row.withColumn("record", record).drop(*[f"_{n}" for n in ("raw", "unit", "alpha", "ctx", "seconds", *parts)])


def log(scored: DataFrame, folder: str, *, dry_run: bool = False) -> DataFrame:
    """Append the records as JSON lines unless it is a dry run; returns them."""
    out = scored.select("record.*")
    if not dry_run:
        append_lines(out, folder)
    return out
