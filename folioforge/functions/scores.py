"""Column functions for composite scores, clamps, units and resource lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unit factors to seconds, the floor of a time, and the allowed exponents.
UNITS = {"s": 1.0, "ms": 1_000.0, "us": 1_000_000.0}
FLOOR = 1e-9
ALPHA = (1.5, 2.0)


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def context(parts: list[Column], weights: list[Column | float] | None = None) -> Column:
    """Weighted sum of the parts (equal weights by default)."""
    weights = weights or [1.0 / len(parts)] * len(parts)
    out = F.lit(0.0)
    for p, w in zip(parts, weights):
        out = out + p * w
    return out


def capability(what: Column, where: Column, who: Column, ctx: Column, alpha: Column | float) -> Column:
    """(what * where * who) * ctx ** alpha; 0 if any factor is not positive."""
    gate = (what <= 0) | (where <= 0) | (who <= 0) | (ctx <= 0)
    return F.when(gate, 0.0).otherwise(what * where * who * F.pow(F.when(gate, F.lit(1.0)).otherwise(ctx), alpha if isinstance(alpha, Column) else F.lit(alpha)))


def efficiency(what: Column, where: Column, who: Column, time: Column, ctx: Column, alpha: Column | float) -> Column:
    """Capability per time; 0 if any factor or the time is not positive."""
    gate = time <= 0
    return F.when(gate, 0.0).otherwise(capability(what, where, who, ctx, alpha) / F.when(gate, F.lit(1.0)).otherwise(time))


def gated(what: Column, where: Column, who: Column, time: Column, ctx: Column, alpha: float = 1.7) -> Column:
    """A second variant: 0 only where what, where or who is exactly 0; the time has a floor."""
    return F.when((what == 0) | (where == 0) | (who == 0), 0.0).otherwise(what * where * who / F.greatest(time, F.lit(FLOOR)) * F.pow(ctx, F.lit(alpha)))


def seconds(raw: Column, unit: Column) -> Column:
    """A raw time in seconds, at least the floor; an unknown unit is an error."""
    scaled = F.raise_error(F.concat(F.lit("unknown time unit: "), unit))
    for name, factor in UNITS.items():
        scaled = F.when(unit == name, raw / factor).otherwise(scaled)
    return F.greatest(scaled.cast("double"), F.lit(FLOOR))


def checked_alpha(alpha: Column) -> Column:
    return F.when(alpha.between(*ALPHA), alpha).otherwise(F.raise_error(F.concat(F.lit("alpha out of range: "), alpha.cast("string")))).cast("double")


def monolithic(what: Column, where: Column, who: Column, time: Column, ctx: Column, alpha: Column | float) -> Column:
    return F.pow(what * where * who / time * ctx, alpha if isinstance(alpha, Column) else F.lit(alpha))


def inverse_who(score: Column, what: Column, where: Column, time: Column, ctx: Column, alpha: float) -> Column:
    """The who that gives a score under the efficiency form."""
    return score * time / (what * where * F.pow(ctx, F.lit(alpha)))


def gigabytes(b: Column, binary: bool = True) -> Column:
    return b / (1024.0**3 if binary else 1000.0**3)


def gpu_line(line: Column) -> Column:
    """struct(index, name, used_gb, total_gb, load) of a comma-separated status line; fields that are not numbers are null, short lines give null."""
    p = F.transform(F.split(line, ","), lambda x: F.trim(x))
    number = lambda i: F.when(F.try_element_at(p, F.lit(i)).rlike(r"^\d+(\.\d+)?$"), F.try_element_at(p, F.lit(i))).cast("double")
    mb = lambda i: number(i).cast("double") / 1024.0
    return F.when(F.size(p) >= 4, F.struct(number(1).cast("int").alias("index"), F.try_element_at(p, F.lit(2)).alias("name"), mb(3).alias("used_gb"), mb(4).alias("total_gb"), number(5).cast("double").alias("load")))


#: Warning and critical thresholds of resource alerts, in percent.
THRESHOLDS = {"cpu": (80.0, 95.0), "memory": (85.0, 95.0), "gpu_memory": (90.0, 95.0)}


def alerts(values: dict[str, Column], thresholds: dict[str, tuple[float, float]] | None = None) -> Column:
    """array<struct<resource, level, value>>; critical takes the place of warning."""
    limits = {**THRESHOLDS, **(thresholds or {})}
    kind = "struct<resource:string,level:string,value:double>"
    one = [
        F.when(v >= limits[n][1], F.struct(F.lit(n).alias("resource"), F.lit("critical").alias("level"), v.cast("double").alias("value")))
        .when(v >= limits[n][0], F.struct(F.lit(n).alias("resource"), F.lit("warning").alias("level"), v.cast("double").alias("value")))
        .cast(kind)
        for n, v in values.items()
    ]
    return F.array_compact(F.array(*one))


#: Parts of metric names and the dimension they belong to, in the order of the search.
DIMENSIONS = {
    "where": ("file_paths_processed", "component_transitions", "storage_locations", "network_hops", "processing_stages"),
    "what": ("documents_processed", "text_extracted", "embeddings_generated", "validation_success_rate", "content_quality_score"),
    "who": ("cpu_utilization", "memory_usage", "gpu_utilization", "worker_efficiency", "resource_availability"),
    "time": ("processing_latency", "throughput_rate", "phase_duration", "queue_wait_time", "response_time"),
}


def dimension_of(metric: Column) -> Column:
    """The first dimension with a part of the metric's name, else unknown."""
    out = F.lit("unknown")
    for name in reversed(DIMENSIONS):
        hit = F.lit(False)
        for part in DIMENSIONS[name]:
            hit = hit | F.lower(metric).contains(part)
        out = F.when(hit, name).otherwise(out)
    return out


def from_dimensions(where: Column, what: Column, who: Column, time: Column, alpha: float = 1.8) -> Column:
    """A third variant: the context is the mean of the four scores; 0 where the time's score is not positive."""
    ctx = 0.25 * (where + what + who + time)
    gate = time <= 0
    return F.when(gate, 0.0).otherwise(where * what * who / F.when(gate, F.lit(1.0)).otherwise(time) * F.pow(ctx, F.lit(alpha)))


def from_progress(where: Column, completed: Column, failed: Column, skipped: Column, total: Column, elapsed: Column, ctx: Column, alpha: float = 1.8) -> Column:
    """A fourth variant: success for what, use of capacity for who, an hour over the elapsed seconds (1 at most) for time."""
    time = F.least(F.lit(1.0), 3600.0 / F.greatest(F.lit(1.0), elapsed))
    what = completed / F.greatest(F.lit(1), completed + failed)
    who = (completed + failed + skipped) / F.greatest(F.lit(1), total)
    return F.when(elapsed.isNull(), 0.0).otherwise(where * what * who / time * F.pow(ctx, F.lit(alpha)))
