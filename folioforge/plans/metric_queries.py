"""Queries on metric series, progress, alerts and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..operators import corpus as C
from ..operators import metrics as M
from ..operators import progress as P
from .registry import derived, query, table


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


@query("SELECT user_id, count(*) AS n, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean, round(sum(value), 4) AS total, arg_max(value, (ts, event_id)) AS latest FROM events GROUP BY user_id")
def series_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_rounded(M.stats(table(spark, sf_dir, "events"), "user_id"), "mean"), "total", digits=4)


@query("""WITH e AS (SELECT user_id, count(*) AS n, arg_min(value, (ts, event_id)) AS a, arg_max(value, (ts, event_id)) AS b, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS s FROM events GROUP BY user_id)
SELECT user_id, n, CASE WHEN n >= 2 AND s > 0 THEN round((b - a) / s, 9) END AS rate FROM e""")
def series_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(M.rate(table(spark, sf_dir, "events"), "user_id"), "rate", digits=9)


@query("SELECT event_id, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS counter FROM events")
def running_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.running(table(spark, sf_dir, "events"), "event_type", F.get_json_object("props", "$.k").cast("long")).select("event_id", "counter")


@query("""SELECT event_id, count(*) OVER w AS n_window, round(avg(value) OVER w, 6) AS mean_window FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECOND PRECEDING AND CURRENT ROW)""")
def trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(M.trailing(table(spark, sf_dir, "events"), "user_id", 86_400).select("event_id", "n_window", "mean_window"), "mean_window")


@query("SELECT event_type, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type")
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(M.quantiles(table(spark, sf_dir, "events"), ["event_type"], "value"), "mean", "p50", "p95", "p99")


@query("SELECT user_id, event_id, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 10")
def last_n_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ring buffer: the ten latest events of each user."""
    return C.last_n(table(spark, sf_dir, "events"), "user_id", [F.desc("ts"), F.desc("event_id")], 10).select("user_id", "event_id", "rank")


@query("SELECT event_type, round(avg(greatest(0, least(1, latest / 100))), 6) AS score FROM (SELECT event_type, user_id, arg_max(value, (ts, event_id)) AS latest FROM events GROUP BY ALL) GROUP BY event_type")
def dimension_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(M.dimension_scores(table(spark, sf_dir, "events"), "event_type", "user_id", seq="event_id"), "score")


_TIMERS = "SELECT 'u' || user_id AS timer, event_id AS seq, CASE WHEN event_type IN ('click', 'view') THEN 'start' ELSE 'end' END AS kind, ts FROM events"


@query(f"""SELECT timer, seq, CASE WHEN k = 'start' THEN (epoch_us(ts) - epoch_us(t)) / 1e6 END AS seconds FROM (SELECT *, lag(kind) OVER w AS k, lag(ts) OVER w AS t FROM ({_TIMERS}) WINDOW w AS (PARTITION BY timer ORDER BY ts, seq)) WHERE kind = 'end'""")
def timer_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.timers(derived(spark, sf_dir, _TIMERS), "timer", "kind").select("timer", "seq", "seconds")


@query("SELECT event_type, time_bucket(INTERVAL 60 SECOND, ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.tumbling(table(spark, sf_dir, "events"), "ts", 60, F.count("*").alias("n"), F.sum("value").alias("total"), by=["event_type"])
    return _rounded(out.select("event_type", "window_start", "n", "total"), "total", digits=4)


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 3600000000 THEN 1 ELSE 0 END AS b FROM events),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM g) SELECT user_id, session::BIGINT AS session, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY user_id, session""")
def session_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sessions(table(spark, sf_dir, "events"), "user_id", "ts", 3600)


@query("SELECT event_id, n AS in_window, n > 3 AS limited FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) AS n FROM events)")
def rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rate_limited(table(spark, sf_dir, "events"), "user_id", "ts", 60, 3).select("event_id", "in_window", "limited")


_STEPS = """SELECT tracker, step, n + CASE WHEN user_id % 5 = 0 THEN 0 - n ELSE user_id % 3 END AS total, CASE WHEN user_id % 5 = 0 THEN 0 ELSE done END AS completed, bad AS failed, CAST(0 AS BIGINT) AS skipped,
CASE user_id % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' ELSE CASE WHEN step = 'click' THEN 'pending' ELSE 'cancelled' END END AS state, first_ts AS start_time, CASE WHEN user_id % 4 <> 1 THEN last_ts END AS end_time
FROM (SELECT user_id, 'u' || user_id AS tracker, event_type AS step, count(*) AS n, CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS done, CAST(sum(CASE WHEN value > 50 AND user_id % 4 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS bad, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id, event_type) AS g"""
_CLOCK = "TIMESTAMP '2025-01-01 00:00:00'"


@query(f"""WITH s AS (SELECT *, (epoch_us(coalesce(end_time, {_CLOCK})) - epoch_us(start_time)) / 1e6 AS sec, completed + failed + skipped AS p FROM ({_STEPS})), r AS (SELECT *, CASE WHEN sec > 0 THEN p / sec END AS rate FROM s)
SELECT tracker, step, CASE WHEN total = 0 THEN 100.0 ELSE completed * 100.0 / total END::DOUBLE AS completion, CASE WHEN completed + failed = 0 THEN 100.0 ELSE completed * 100.0 / (completed + failed) END::DOUBLE AS success,
round(rate, 6)::DOUBLE AS rate, CASE WHEN state = 'running' THEN round(CASE WHEN total - p <= 0 THEN 0 ELSE (total - p) / nullif(rate, 0) END, 6) END::DOUBLE AS seconds_left FROM r""")
def progress_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.steps(derived(spark, sf_dir, _STEPS), F.expr(_CLOCK))
    return _rounded(out.select("tracker", "step", F.col("completion").cast("double"), F.col("success").cast("double"), "rate", "seconds_left"), "rate", "seconds_left")


@query(f"""SELECT tracker, sum(total)::BIGINT AS total, sum(completed)::BIGINT AS completed, count(*) FILTER (state = 'failed') AS steps_failed, round(CASE WHEN sum(total) = 0 THEN 0 ELSE sum(completed) * 100.0 / sum(total) END, 6)::DOUBLE AS completion,
round(sum(completed) * 100.0 / greatest(1, sum(completed) + sum(failed)), 6)::DOUBLE AS success,
CASE WHEN NOT bool_and(state IN ('completed', 'failed', 'cancelled')) THEN 'running' WHEN bool_or(state = 'failed') THEN 'failed' WHEN bool_or(state = 'cancelled') THEN 'cancelled' ELSE 'completed' END AS state FROM ({_STEPS}) GROUP BY tracker""")
def progress_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(P.overall(derived(spark, sf_dir, _STEPS), "tracker").select("tracker", "total", "completed", "steps_failed", "completion", "success", "state"), "completion", "success")


_EVENTS = "SELECT 'u' || user_id AS step, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, CASE event_type WHEN 'click' THEN 'start' WHEN 'view' THEN 'pause' WHEN 'purchase' THEN 'resume' WHEN 'signup' THEN CASE WHEN event_id % 4 = 0 THEN 'complete' ELSE 'pause' END ELSE CASE WHEN event_id % 9 = 0 THEN 'fail' WHEN event_id % 9 = 1 THEN 'cancel' ELSE 'start' END END AS event FROM events"


@query(f"""WITH RECURSIVE e AS (SELECT * FROM ({_EVENTS})), r AS (SELECT DISTINCT step, 0 AS seq, 'pending' AS state FROM e UNION ALL
SELECT r.step, e.seq, CASE WHEN e.event = 'start' AND r.state = 'pending' THEN 'running' WHEN e.event = 'pause' AND r.state = 'running' THEN 'paused' WHEN e.event = 'resume' AND r.state = 'paused' THEN 'running'
WHEN e.event = 'complete' AND r.state IN ('running', 'paused') THEN 'completed' WHEN e.event = 'fail' THEN 'failed' WHEN e.event = 'cancel' THEN 'cancelled' ELSE r.state END FROM r JOIN e ON e.step = r.step AND e.seq = r.seq + 1)
SELECT step, arg_max(state, seq) AS state, max(seq)::INT AS events FROM r GROUP BY step""")
def progress_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.states(derived(spark, sf_dir, _EVENTS), ["step"], ["seq"])


_LOADS = "SELECT event_id AS id, value AS cpu, user_id % 100 + 0.5 AS memory, CASE WHEN event_id % 5 > 0 THEN value / 2 END AS gpu FROM events"


@query(f"""SELECT id, resource, CASE WHEN v >= c THEN 'critical' ELSE 'warning' END AS level, v::DOUBLE AS value FROM (SELECT id, 'cpu' AS resource, cpu AS v, 80 AS w, 95 AS c FROM ({_LOADS}) UNION ALL SELECT id, 'memory', memory, 85, 95 FROM ({_LOADS})
UNION ALL SELECT id, 'gpu_memory', gpu, 90, 95 FROM ({_LOADS})) WHERE v >= w""")
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = derived(spark, sf_dir, _LOADS).select("id", F.explode(S.alerts({"cpu": F.col("cpu"), "memory": F.col("memory"), "gpu_memory": F.col("gpu")})).alias("a"))
    return out.select("id", "a.resource", "a.level", "a.value")


_SCORES = """SELECT id, CAST(a AS DOUBLE) AS what, CAST(b AS DOUBLE) AS place, CAST(c AS DOUBLE) AS who, CAST(t AS DOUBLE) AS t, CAST(x AS DOUBLE) AS ctx, CAST(al AS DOUBLE) AS alpha
FROM (SELECT event_id AS id, value / 100 AS a, user_id % 11 - 1 AS b, 0.7 AS c, event_id % 5 AS t, event_id % 7 AS x, 1.5 + event_id % 4 / 10.0 AS al FROM events) AS v"""


@query(f"""SELECT id, round(CASE WHEN what <= 0 OR place <= 0 OR who <= 0 OR ctx <= 0 OR t <= 0 THEN 0 ELSE what * place * who * pow(ctx, alpha) / t END, 9) AS efficiency,
round(CASE WHEN what <= 0 OR place <= 0 OR who <= 0 OR ctx <= 0 THEN 0 ELSE what * place * who * pow(ctx, alpha) END, 9) AS capability,
round(CASE WHEN what = 0 OR place = 0 OR who = 0 THEN 0 ELSE what * place * who / greatest(t, 1e-9) * pow(ctx, 1.7) END, 3) AS gated FROM ({_SCORES})""")
def composite_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = {n: F.col(n) for n in ("what", "place", "who", "t", "ctx", "alpha")}
    out = derived(spark, sf_dir, _SCORES).select(
        "id", S.efficiency(c["what"], c["place"], c["who"], c["t"], c["ctx"], c["alpha"]).alias("efficiency"), S.capability(c["what"], c["place"], c["who"], c["ctx"], c["alpha"]).alias("capability"), S.gated(c["what"], c["place"], c["who"], c["t"], c["ctx"]).alias("gated")
    )
    return _rounded(_rounded(out, "efficiency", "capability", digits=9), "gated", digits=3)


_UNITS = "SELECT event_id AS id, value AS raw, CASE event_id % 3 WHEN 0 THEN 'ms' WHEN 1 THEN 's' ELSE 'us' END AS unit FROM events"


@query(f"SELECT id, greatest(raw / CASE unit WHEN 's' THEN 1 WHEN 'ms' THEN 1000 ELSE 1000000 END, 1e-9)::DOUBLE AS seconds FROM ({_UNITS})")
def unit_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _UNITS).select("id", S.seconds(F.col("raw").cast("double"), F.col("unit")).alias("seconds"))


_LINES = "SELECT event_id AS id, CASE event_id % 7 WHEN 0 THEN 'broken ' || props WHEN 1 THEN event_id || ',C,' || user_id || ',2048' WHEN 2 THEN event_id || ', Card ' || event_type || ', N/A, 49152, 5' ELSE event_id || ', Card ' || event_type || ', ' || user_id * 10 || ', 49152, ' || user_id % 100 END AS line FROM events"


@query(f"""WITH p AS (SELECT id, list_transform(string_split(line, ','), lambda x: trim(x)) AS p FROM ({_LINES})), n AS (SELECT id, p, len(p) >= 4 AS ok FROM p)
SELECT id, CASE WHEN ok THEN try_cast(p[1] AS INT) END AS index, CASE WHEN ok THEN p[2] END AS name, CASE WHEN ok THEN try_cast(p[3] AS DOUBLE) / 1024 END AS used_gb, CASE WHEN ok THEN try_cast(p[4] AS DOUBLE) / 1024 END AS total_gb, CASE WHEN ok THEN try_cast(p[5] AS DOUBLE) END AS load FROM n""")
def gpu_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _LINES).select("id", S.gpu_line(F.col("line")).alias("g")).select("id", "g.*")
