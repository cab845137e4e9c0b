"""Operators on metric series in long form: (series, ts, seq, value); every clock is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut, totals_before


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def stats(df: DataFrame, series: str, value: str = "value", ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Count of all points; min, max, mean and total of the numeric ones; the latest value."""
    return df.groupBy(series).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"), F.sum(value).alias("total"), F.max_by(value, F.struct(ts, seq)).alias("latest"))


def recent_stats(df: DataFrame, series: str, as_of: Column, seconds: int = 300, value: str = "value", ts: str = "ts") -> DataFrame:
    """Per series: count, min, max and mean of all points, and of those of the last seconds before ``as_of``, in one pass."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 1e6
    new = F.when((age >= 0) & (age <= seconds), F.col(value))
    of = lambda c, name: [F.count(c).alias(f"n{name}"), F.min(c).alias(f"low{name}"), F.max(c).alias(f"high{name}"), F.avg(c).alias(f"mean{name}")]
    return df.groupBy(series).agg(*of(F.col(value), ""), *of(new, "_recent"))


def rate(df: DataFrame, series: str, value: str = "value", ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Change per second between the first and the last point; null for fewer than two points, no span or an end that is no number."""
    ends = df.groupBy(series).agg(F.count("*").alias("n"), F.min(F.struct(ts, seq, value)).alias("a"), F.max(F.struct(ts, seq, value)).alias("b"))
    span = _seconds(F.col("b")[ts]) - _seconds(F.col("a")[ts])
    return ends.select(series, "n", F.when((F.col("n") >= 2) & (span > 0), (F.col("b")[value] - F.col("a")[value]) / span).alias("rate"))


def running(df: DataFrame, series: str, value: Column, ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Running counter of each series; a long series is spread over many tasks."""
    out = totals_before(df.withColumn("_value", value), [series], [F.col(ts), F.col(seq)], {"counter": F.col("_value")})
    return out.withColumn("counter", F.col("counter") + F.coalesce("_value", F.lit(0))).drop("_value")


def trailing(df: DataFrame, series: str, seconds: int, value: str = "value", ts: str = "ts") -> DataFrame:
    """Count and mean over the seconds up to each point."""
    w = Window.partitionBy(series).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("n_window", F.count("*").over(w)).withColumn("mean_window", F.avg(value).over(w))


def quantiles(df: DataFrame, by: list[str], value: str, at: tuple[float, ...] = (0.5, 0.95, 0.99), buckets: int = 256) -> DataFrame:
    """Exact quantiles by linear interpolation, and min, max and mean; nulls do not count.

    Values are counted in buckets between approximate quantiles of their group, and
    only the buckets that hold a wanted rank are ordered, by distinct value, so
    that no task holds a group.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v"))
    known = rows.where("_v is not null")
    heads = rows.groupBy(*by).agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.avg("_v").alias("mean"), F.count("_v").alias("_n"), F.percentile_approx("_v", [i / buckets for i in range(1, buckets)], 20 * buckets).alias("_m"))
    heads = cut(heads)
    keys = [F.col(c).alias(f"_by_{c}") for c in by]

    def same() -> Column:
        cond = F.lit(True)
        for c in by:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        return cond

    placed = known.join(heads.select(*keys, "_m"), same()).select(*by, "_v", F.size(F.filter("_m", lambda m: m <= F.col("_v"))).alias("_b"))
    values = cut(placed.groupBy(*by, "_b", "_v").agg(F.count("*").alias("_c")))
    sizes = values.groupBy(*by, "_b").agg(F.sum("_c").alias("_c"))
    first = F.coalesce(F.sum("_c").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("_start", first).select(*keys, F.col("_b").alias("_at"), "_start", (F.col("_start") + F.col("_c")).alias("_end"))
    ranks = [F.floor(q * (F.col("_n") - 1)) + d for q in map(F.lit, at) for d in (0, 1)]
    wanted = heads.select(*by, "_n", F.array_distinct(F.array(*[F.least(r, F.col("_n") - 1).cast("long") for r in ranks])).alias("_ranks"))
    needed = starts.join(wanted, same()).where(F.exists("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_end")))).select(*[f"_by_{c}" for c in by], "_at", "_start", "_ranks")
    inside = values.join(needed, same() & (F.col("_b") == F.col("_at")))
    through = F.col("_start") + F.sum("_c").over(Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = inside.withColumn("_through", through).withColumn("_hit", F.filter("_ranks", lambda r: (r < F.col("_through")) & (r >= F.col("_through") - F.col("_c")))).where(F.size("_hit") > 0)
    of_rank = found.groupBy(*by).agg(F.map_from_entries(F.flatten(F.collect_list(F.transform("_hit", lambda r: F.struct(r.alias("k"), F.col("_v").alias("v")))))).alias("_q")).select(*keys, "_q")
    out = heads.join(of_rank, same(), "left")

    def one(q: float) -> Column:
        place = F.lit(q) * (F.col("_n") - 1)
        lo = F.floor(place)
        a, b = (F.element_at("_q", F.least(lo + d, F.col("_n") - 1).cast("long")) for d in (0, 1))
        return F.when(a == b, a).otherwise((lo + 1 - place) * a + (place - lo) * b)

    return out.select(*by, "low", "high", "mean", *[one(q).alias(f"p{round(100 * q)}") for q in at])


def dimension_scores(df: DataFrame, dimension: str, series: str, value: str = "value", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Mean over a dimension's series of the latest value / 100, clamped to 0..1; series whose latest is no number do not count."""
    last = df.groupBy(dimension, series).agg(F.max_by(value, F.struct(ts, seq)).alias("latest"))
    return last.groupBy(dimension).agg(F.coalesce(F.avg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("latest") / 100))), F.lit(0.0)).alias("score"))


def timers(events: DataFrame, timer: str, kind: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Durations: each end with the last start before it that has no end yet; an end without a start has null."""
    before = Window.partitionBy(timer).orderBy(ts, seq)
    out = events.withColumn("_k", F.lag(kind).over(before)).withColumn("_t", F.lag(ts).over(before)).where(F.col(kind) == "end")
    return out.withColumn("seconds", F.when(F.col("_k") == "start", _seconds(F.col(ts)) - _seconds(F.col("_t")))).drop("_k", "_t")


def tumbling(df: DataFrame, ts: str, seconds: int, *aggregates: Column, by: list[str] | None = None) -> DataFrame:
    """Aggregates over fixed windows of time."""
    return df.groupBy(*(by or []), F.window(ts, f"{seconds} seconds").alias("w")).agg(*aggregates).withColumn("window_start", F.col("w.start")).drop("w")


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Sessions: runs of events with no gap longer than the limit."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(ts).cast("timestamp")))
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    new = F.when(at - F.lag(at).over(w) > gap_seconds * 1_000_000, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0))).groupBy(key, "session").agg(F.count("*").alias("events"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def rate_limited(df: DataFrame, key: str, ts: str, seconds: int, most: int) -> DataFrame:
    """Flags the events beyond ``most`` in the seconds up to them."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("in_window", F.count("*").over(w)).withColumn("limited", F.col("in_window") > most)


def exponents(df: DataFrame, series: str, order: list[str], score: str, context: str) -> DataFrame:
    """The exponent of a power law between two values of each series, from pairs of neighbours and from all points.

    by_pairs is the mean of the slopes between neighbours in ``order`` on logarithmic
    scales, by_regression the slope of least squares.  Points with a value that is
    missing or not positive are left out, pairs whose contexts are equal too; null
    where nothing is left.
    """
    good = df.where((F.col(score) > 0) & (F.col(context) > 0)).withColumns({"_y": F.ln(F.col(score).cast("double")), "_x": F.ln(F.col(context).cast("double"))})
    w = Window.partitionBy(series).orderBy(*order)
    steps = good.withColumns({"_dy": F.col("_y") - F.lag("_y").over(w), "_dx": F.col("_x") - F.lag("_x").over(w)})
    slope = F.when(F.col("_dx") != 0, F.col("_dy") / F.col("_dx"))
    return steps.groupBy(series).agg(F.count("*").alias("points"), F.count(slope).alias("pairs"), F.avg(slope).alias("by_pairs"), F.regr_slope("_y", "_x").alias("by_regression"))
