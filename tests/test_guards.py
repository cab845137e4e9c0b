"""Stateful guards: equal to their batch twins after every batch was taken and over a restart."""

import random
import time

import pytest
from pyspark.sql import functions as F

from folioforge.streaming import guards
from folioforge.streaming.guards import Limits

pytest.importorskip("google.protobuf")
SCHEMA = "agent string, at long, seq long, heartbeat boolean"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def events(n=400, seed=3):
    r, at, rows = random.Random(seed), 0, []
    for k in range(n):
        at += r.choice((1_000, 100_000, 200_000, 400_000, 3_000_000, 20_000_000))
        rows.append((r.choice("abc") if r.random() < 0.9 else None, at, k, r.random() < 0.93))
    return rows


def test_judge():
    limits = Limits(per_second=3, depth=4, length=5_000_000, cooldown=750_000)
    said, state = [], guards.START
    for at, beat in [(0, 1), (1, 1), (2, 1), (3, 1), (1_100_000, 1), (1_200_000, 1), (1_300_000, 1), (1_949_999, 1), (1_950_000, 1), (2_000_000, 0), (2_100_000, 1), (8_000_000, 1), (9_000_000, 1)]:
        state, verdict = guards.judge(state, at, bool(beat), limits)
        said.append(verdict)
    assert said == ["accepted"] * 3 + ["rate", "accepted", "depth", "cooling", "cooling", "accepted", "yielded", "accepted", "duration", "accepted"]


def test_batch_equals_fold(spark):
    rows, want, state = events(), [], {}
    for agent, at, seq, beat in rows:
        state[agent], verdict = guards.judge(state.get(agent, guards.START), at, beat, Limits())
        want.append((agent, at, seq, state[agent][0], verdict))
    found = [tuple(r) for r in guards.guarded(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr) and {w[4] for w in want} >= {"accepted", "rate", "yielded"}
    assert guards.guarded(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stream_equals_batch(rocks, tmp_path):
    rows = [r for r in events(200) if r[0]]
    limits = Limits(depth=3, length=10_000_000)
    (tmp_path / "in").mkdir()
    stream = guards.guard_stream(rocks.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), limits)

    def run():
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    for a, b in ((0, 50), (50, 110)):
        rocks.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    rocks.createDataFrame(rows[110:], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()  # a restart: the state is that of the first run
    found = sorted(map(tuple, rocks.read.schema(guards.VERDICT).parquet(str(tmp_path / "out")).collect()))
    assert found == sorted(map(tuple, guards.guarded(rocks.createDataFrame(rows, SCHEMA), limits).collect()))
    assert {f[4] for f in found} >= {"accepted", "depth", "rate"}


def test_log_forgets(rocks, tmp_path):
    schema = "agent string, ts timestamp, seq long"
    (tmp_path / "in").mkdir()
    stream = guards.forgotten(rocks.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), 60)

    def add(rows):
        rocks.createDataFrame(rows, "agent string, s long, seq long").select("agent", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"), "seq").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    add([("a", 0, 1), ("a", 30, 2), ("b", 10, 3)])
    add([("c", 75, 4)])  # the watermark is 75 now: entries up to 15 have expired
    add([("c", 100, 5)])
    got = rocks.read.schema("agent string, seq long, expired timestamp").parquet(str(tmp_path / "out"))
    found = sorted((r.agent, r.seq, r.e - 1_700_000_000) for r in got.select("agent", "seq", F.unix_seconds("expired").alias("e")).collect())
    assert found == [("a", 1, 60), ("a", 2, 90), ("b", 3, 70)]


def test_time_to_live(rocks, tmp_path, request):
    rocks.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    request.addfinalizer(lambda: rocks.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled"))
    (tmp_path / "in").mkdir()
    schema, seen = "agent string, seq long", []
    stream = guards.held(rocks.readStream.schema(schema).parquet(str(tmp_path / "in")), 4_000)

    def add(rows):
        rocks.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(lambda b, _: seen.append(sorted(map(tuple, b.collect())))).option("checkpointLocation", str(tmp_path / "cp")).outputMode("update").trigger(availableNow=True).start().awaitTermination()

    add([("a", 1), ("a", 2), ("b", 3)])
    time.sleep(5)
    add([("a", 4)])
    assert [x for x in seen if x] == [[("a", 2, 1), ("b", 1, 3)], [("a", 1, 4)]]
