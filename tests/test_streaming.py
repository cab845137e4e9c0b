from pyspark.sql import functions as F

from folioforge.sources.store import Store
from folioforge.streaming import jobs


def run(df, mode, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_windows_equal_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    run(jobs.windowed(stream, 86_400, 0, ["event_type"]), "complete", "w", tmp_path)
    got = {(r.event_type, r.window_start): (r.n, round(r.total, 4)) for r in spark.table("w").collect()}
    batch = jobs.windowed(events, 86_400, 0, ["event_type"]).collect()
    assert got == {(r.event_type, r.window_start): (r.n, round(r.total, 4)) for r in batch} and got


def test_sessions_and_sliding(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    for name, f in (("s", lambda e: jobs.session_counts(e, "user_id", 3600, 0)), ("g", lambda e: jobs.sliding(e, 86_400, 43_200, 0, ["event_type"]))):
        run(f(stream), "complete", name, tmp_path)
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, f(events).collect()))


def test_states(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("a", 1, "start"), ("a", 2, "pause"), ("a", 3, "complete"), ("b", 1, "complete"), ("c", 1, "cancel")]
    spark.createDataFrame(rows[:2] + rows[3:], "step string, seq int, event string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("step string, seq int, event string").parquet(str(tmp_path / "in"))
    out = jobs.progress_states(stream)
    seen = {}
    sink = lambda b, _: seen.update({r.step: (r.state, r.events) for r in b.collect()})
    start = lambda: out.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    start()
    assert seen == {"a": ("paused", 2), "b": ("pending", 1), "c": ("cancelled", 1)}
    spark.createDataFrame(rows[2:3], "step string, seq int, event string").write.mode("append").parquet(str(tmp_path / "in"))
    start()
    assert seen["a"] == ("completed", 3)


def test_ingest_resumes(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    store = Store(spark, str(tmp_path / "store"))
    for i, text in enumerate(('{"id":"a","abstract":"x"}\n{"id":"b","abstract":"y"}\n', '{"id":"b","abstract":"again"}\n{"id":"c","abstract":"z"}\n')):
        (tmp_path / f"lines/{i}.jsonl").write_text(text)
        jobs.ingest(spark, str(tmp_path / "lines"), store, "meta", str(tmp_path / "cp")).awaitTermination()
    assert {(r._key, r.abstract) for r in store.table("meta").select("_key", "abstract").collect()} == {("a", "x"), ("b", "y"), ("c", "z")}
    assert store.table("meta").where(F.col("abstract_length") != 1).count() == 0
