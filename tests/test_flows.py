"""Listener, staged jobs, replace by parent, clean-up, table functions and positional zip."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from folioforge.functions import chunk_udtf
from folioforge.functions.vectors import normalise
from folioforge.operators import metrics, zipped
from folioforge.sources import staging
from folioforge.sources.sinks import Checkpoints
from folioforge.sources.store import Store, write_papers
from folioforge.streaming import jobs, tracking


def wait_for(test, seconds=20):
    done = threading.Event()
    for _ in range(seconds * 10):
        if test():
            return True
        done.wait(0.1)
    return False


def test_listener(spark, tmp_path):
    """States and counts of a query; a failing callback stops nothing; only ends are saved."""
    store = Store(spark, str(tmp_path / "store"))
    marks = Checkpoints(store)
    tracker = tracking.Tracker("counts", save=marks.save)
    seen, updates = [], []

    def broken(_):
        raise ValueError("no")

    for state in ("running", "completed", "failed"):
        tracker.on_state(state, broken)
        tracker.on_state(state, lambda s: seen.append((s["query"], s["state"], s["rows"], s["failed"])))
    tracker.on_update(broken)
    tracker.on_update(updates.append)
    spark.streams.addListener(tracker)
    try:
        (tmp_path / "in").mkdir()
        spark.range(10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = tracking.observed(spark.readStream.schema("id long").parquet(str(tmp_path / "in")), "counts", F.col("id") > 6)
        stream.writeStream.queryName("good").foreachBatch(lambda b, _: b.count()).option("checkpointLocation", str(tmp_path / "a")).trigger(availableNow=True).start().awaitTermination()
        assert wait_for(lambda: "good" in marks.names())
        assert ("good", "running", 0, 0) in seen and ("good", "completed", 10, 3) in seen and updates[-1]["rows"] == 10

        def fails(batch, _):
            raise RuntimeError("sink is gone")

        bad = stream.writeStream.queryName("bad").foreachBatch(fails).option("checkpointLocation", str(tmp_path / "b")).trigger(availableNow=True).start()
        with pytest.raises(Exception, match="sink is gone"):
            bad.awaitTermination()
        assert wait_for(lambda: "bad" in marks.names())
        assert marks.load("bad")["state"] == "failed" and marks.load("good")["failed"] == 3 and "running" not in {marks.load(n)["state"] for n in marks.names()}
        assert tracker.remove(broken) and not tracker.remove(broken)
    finally:
        spark.streams.removeListener(tracker)


def test_alerting(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("a", 96.0), ("b", 10.0), ("c", 85.0)], "host string, cpu double").write.mode("append").parquet(str(tmp_path / "in"))
    got = []
    stream = spark.readStream.schema("host string, cpu double").parquet(str(tmp_path / "in"))
    jobs.alerting(stream, lambda d: d.where("cpu > 80"), lambda b, _: got.extend(sorted(r.host for r in b.collect())), str(tmp_path / "cp")).awaitTermination()
    assert got == ["a", "c"]


def papers(spark, **chunks):
    p = spark.createDataFrame([(k, f"title {k}") for k in chunks], "_key string, title string")
    c = spark.createDataFrame([(k, i, f"{k} {n} {i}", [1.0, float(i)]) for k, n in chunks.items() for i in range(n)], "_key string, chunk_index int, text string, embedding array<double>")
    return p, c


def test_a_paper_that_shrinks(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    s = spark.createDataFrame([("p", "equation", i, "x") for i in range(4)], "_key string, kind string, position int, content string")
    write_papers(store, *papers(spark, p=5, q=2), s)
    assert store.counts(["papers", "chunks", "embeddings", "structures"]) == {"papers": 2, "chunks": 7, "embeddings": 7, "structures": 4}
    write_papers(store, *papers(spark, p=3), s.where("position < 1"))
    assert store.counts(["papers", "chunks", "embeddings", "structures"]) == {"papers": 2, "chunks": 5, "embeddings": 5, "structures": 1}
    assert sorted(r.text for r in store.table("chunks").where("_key = 'p'").collect()) == ["p 3 0", "p 3 1", "p 3 2"]
    write_papers(store, *papers(spark, p=0))
    assert store.counts(["chunks", "structures"]) == {"chunks": 2, "structures": 0}
    store.compact("chunks")
    assert store.counts(["chunks"]) == {"chunks": 2}


def test_a_failed_commit_leaves_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    write_papers(store, *papers(spark, p=2))
    before = sorted(map(str, tmp_path.glob("tables/*/*")))
    p, c = papers(spark, p=1)
    broken = c.withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        write_papers(store, p, broken)
    assert sorted(map(str, tmp_path.glob("tables/*/*"))) == before and store.counts(["chunks"]) == {"chunks": 2}
    with pytest.raises(RuntimeError):
        store.commit({"papers": (p, ["_key"])}, expected=-1)
    assert sorted(map(str, tmp_path.glob("tables/*/*"))) == before


def test_vacuum(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for n in range(4):
        store.commit({"t": (spark.range(n, n + 2), ["id"])})
    store.compact("t")
    assert store.vacuum(keep=1) == 0  # too young
    assert store.vacuum(keep=1, seconds=-1) == 4 and len(list(tmp_path.glob("tables/t/*"))) == 1 and store.table("t").count() == 5


def test_two_writers_lose_no_count(spark, tmp_path):
    a, b = (Checkpoints(Store(spark, str(tmp_path))) for _ in range(2))
    a.save("job", {"n": 0})
    load, other = a.load, [3]

    def late(name, default=None):
        found = load(name, default)
        if other:
            b.add("job", n=other.pop())  # comes between what a has read and what it writes
        return found

    a.load = late
    assert a.add("job", n=2)["n"] == 5 and b.load("job") == {"n": 5}


def test_two_phases(spark, tmp_path):
    """Killed between and within the phases, then run again: the same tables, and each document was extracted once."""
    docs = spark.createDataFrame([(f"d{k}", None if k == 3 else "one. two. three" if k % 2 else "") for k in range(12)] + [(None, "no key")], "_key string, text string")
    calls = spark.sparkContext.accumulator(0)

    def extract(part):
        calls.add(part.count())
        return part.select("_key", "text", F.when(F.col("text").isNull(), "no text").alias("error"))

    def process(part):
        good = part.where("text <> ''")
        chunks = good.select("_key", F.posexplode(F.split("text", r"\. ")).alias("chunk_index", "text")).withColumn("embedding", F.array(F.lit(1.0)))
        return good.select("_key"), chunks

    def finished(folder, job):
        store = Store(spark, str(tmp_path / folder))
        counts = job(store)
        rows = {r._key: (r.status, r.error) for r in store.table("staging").collect()}
        return counts, rows, sorted(r.chunk_key for r in store.table("chunks").collect())

    make = lambda store, process=process: staging.TwoPhase(store, extract, process, groups=3)
    whole = finished("whole", lambda s: make(s).run(docs))
    assert whole[0] == {"stored": 5, "failed": 7} and whole[1]["d3"] == ("failed", "no text") and whole[1]["d0"] == ("failed", "nothing was made of it") and len(whole[2]) == 15
    assert calls.value == 12

    def killed(store):
        seen = []

        def dies(part):
            seen.append(1)
            if len(seen) == 2:
                raise KeyboardInterrupt
            return process(part)

        make(store).first(docs)
        with pytest.raises(KeyboardInterrupt):
            make(store, dies).second()
        assert len(list((tmp_path / "cut/tables/staging").glob("*"))) == 4
        return make(store).run(docs)

    assert finished("cut", killed) == whole and calls.value == 24
    again = finished("whole", lambda s: make(s).run(docs, retry=True))
    assert again == whole and calls.value == 31  # only what had failed


def test_overridden(spark):
    base = spark.createDataFrame([("a", "x", [1]), ("b", "y", [2]), ("c", "z", [3])], "_key string, body string, eq array<int>")
    tex = spark.createDataFrame([("a", " ", [7, 8]), ("b", "Y", []), ("d", "w", [1])], "_key string, body string, eq array<int>")
    assert sorted(map(tuple, staging.overridden(base, tex, "_key", ["body", "eq"]).collect())) == [("a", "x", [7, 8]), ("b", "Y", [2]), ("c", "z", [3])]


def test_table_function(spark):
    chunk_udtf.register(spark, "own_chunks", {"pairs": (lambda t: [t[i : i + 2] for i in range(0, len(t), 2)], "")})
    rows = spark.sql("SELECT * FROM VALUES (1, 'a b c d e'), (2, ''), (3, NULL), (4, '  x ') AS v(id, t), LATERAL own_chunks(t, 2, 1)").collect()
    assert [(r.id, r.chunk_index, r.text, r.start_char, r.end_char) for r in rows] == [(1, 0, "a b", 0, 3), (1, 1, "b c", 2, 5), (1, 2, "c d", 4, 7), (1, 3, "d e", 6, 9), (4, 0, "x", 0, 1)]
    assert [r.text for r in spark.sql("SELECT * FROM own_chunks('abcdefg', 2, 0, 'pairs')").collect()] == ["abcd", "efg"]
    for bad in ("own_chunks('a', 2, 2)", "own_chunks(1)", "own_chunks('a', 2, 0, 'none')"):
        with pytest.raises(Exception, match="overlap|string|tokenizer"):
            spark.sql(f"SELECT * FROM {bad}").collect()


def test_zip(spark):
    r = random.Random(5)
    a, b = list(range(3000)), list(range(1700))
    r.shuffle(a)
    left = spark.createDataFrame([(k,) for k in a], "x int").repartition(200)
    right = spark.createDataFrame([(k * 10,) for k in b], "y int").repartition(3)
    out = zipped.zip_positional(left, [F.col("x").desc()], right, [F.col("y")])
    assert sorted(map(tuple, out.collect())) == sorted((2999 - k, k * 10) for k in range(1700))
    assert "SinglePartition" not in out._jdf.queryExecution().toString()
    assert zipped.zip_positional(left, [F.col("x")], right.limit(0), [F.col("y")]).count() == 0


def test_exponents(spark):
    rows = [("a", k, 3.0 * x**1.5, x) for k, x in enumerate((1.0, 2.0, 4.0, 4.0, 8.0))] + [("b", 0, 1.0, 1.0), ("b", 1, -1.0, 2.0), ("b", 2, None, 3.0), ("b", 3, 2.0, 0.0)]
    out = {r.s: r for r in metrics.exponents(spark.createDataFrame(rows, "s string, k int, c double, x double"), "s", ["k"], "c", "x").collect()}
    assert abs(out["a"].by_pairs - 1.5) < 1e-12 and abs(out["a"].by_regression - 1.5) < 1e-12 and (out["a"].points, out["a"].pairs) == (5, 3)
    assert (out["b"].points, out["b"].pairs, out["b"].by_pairs, out["b"].by_regression) == (1, 0, None, None)


def test_normalise_binds_its_norm(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,), ([],)], "v array<double>")
    assert [r[0] for r in df.select(normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0], None, []]
    assert df.select(normalise(F.col("v"), 1.0)).first()[0] == [0.5, 4 / 6]
