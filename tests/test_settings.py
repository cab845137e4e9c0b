"""Settings, states and gates on edges."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.functions import settings as E
from folioforge.operators import status as T


def as_python(value):
    """What a setting's text stands for, by Python's own conversions."""
    if value.lower() in E.TRUE:
        return True
    if value.lower() in E.FALSE:
        return False
    try:
        return float(value) if "." in value else int(value)
    except ValueError:
        return value


def test_coerced(spark):
    values = ["true", "YES", "1", "On", "0", "off", "No", "2", "-3", "+4", "007", "1_000", " 5 ", "1.5", "-.5", "3.", "1.5e3", ".", "1e5", "", "a b", "1.2.3", 'say "x"', "back\\slash", "é", "true ", "--1", "0.0"]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", E.coerced(F.col("v")).alias("c")).collect()
    for r in rows:
        want = as_python(r.v)
        assert json.loads(r.c.json) == want and type(json.loads(r.c.json)) is type(want), r
        assert r.c.kind == {bool: "bool", int: "int", float: "float", str: "str"}[type(want)]


def test_nested_settings(spark):
    rows = [("x", 1, "APP_A_B", "1.5"), ("x", 2, "APP_A_C", "on"), ("x", 3, "OTHER", "z"), ("x", 4, "APP_D", "text"), ("x", 5, "APP_A_B", "7"), ("y", 1, "APP_A", "5"), ("y", 2, "APP_A_B", "6"), ("z", 1, "APP_", "5"), (None, 1, "APP_Q", None)]
    out = {r.key: json.loads(r.merged) for r in T.nested_settings(spark.createDataFrame(rows, "key string, seq int, name string, value string"), "key", "seq", "name", "value", "APP_").collect()}
    assert out["x"] == {"a": {"b": 7, "c": True}, "d": "text"} and out["y"] == {"a": {"b": 6}} and "z" not in out


def test_bind_variables(spark):
    rows = [("a:1",), ("b: [1, 2]",), (" c :x:y",), (":z",), ("",), ("d",), (None,), ("e:",)]
    got = [r.b and (r.b.key, r.b.value, r.b.is_json) for r in spark.createDataFrame(rows, "t string").select(E.bind_variable(F.col("t")).alias("b")).collect()]
    assert got == [("a", "1", True), ("b", "[1, 2]", True), ("c", "x:y", False), None, None, ("d", "", False), None, ("e", "", False)]


def test_paths(spark):
    rows = [("2301.00001v3", ["b.tex", "paper.tex"]), ("cs/0601001", ["cs.tex"]), ("math.GT/0309136v1", []), ("nothing", None), ("2301.00001", ["2301.00001.tex", "a.tex"]), (None, ["main.tex"])]
    got = [tuple(r) for r in spark.createDataFrame(rows, "i string, f array<string>").select(E.pdf_path(F.col("i"), "/p/"), E.main_source(F.col("i"), F.col("f"))).collect()]
    assert got[:5] == [("/p/2301/2301.00001.pdf", "paper.tex"), ("/p/0601/cs_0601001.pdf", "cs.tex"), ("/p/0309/math.GT_0309136.pdf", None), (None, None), ("/p/2301/2301.00001.pdf", "2301.00001.tex")]
    assert got[5][0] is None


def test_states_and_gates(spark):
    rows = [("a", 1, 4.0, 8.0), ("a", 2, 2.0, None), ("b", 1, 3.0, 0.0)]
    last = {r.d: (r.t, r.memory_percent) for r in T.latest_status(spark.createDataFrame(rows, "d string, t int, used double, total double"), "d", ["t"], "used", "total").collect()}
    assert last == {"a": (2, 200.0), "b": (1, 300.0)}
    gates = spark.createDataFrame([("x" * 100, "t", 2048, 1), ("x", None, 7, 501), (None, " ", None, None)], "x string, t string, d int, c int")
    assert [r[0] for r in gates.select(T.gate_reasons(F.col("x"), F.col("t"), F.col("d"), F.col("c"))).collect()] == [[], ["text", "title", "dimension", "chunks"], ["text", "title", "dimension", "chunks"]]
    code = T.paper_document(spark.createDataFrame([(1, ["f"], "py"), (2, [], "py"), (3, None, None)], "id int, s array<string>, lang string"), "s", ["lang"]).orderBy("id").collect()
    assert code[0].code.lang == "py" and [r.has_symbols for r in code] == [True, False, False] and code[1].code is None


def test_score_records(spark, tmp_path):
    from folioforge.operators import score_log

    df = spark.createDataFrame([(1, '{"b": {"stats": {"p50": 1500, "s": "x"}}}')], "id int, result string").withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    make = lambda path=("b", "stats", "p50"), alpha=1.7, unit="ms": score_log.records(df, result="result", path=[F.lit(p) for p in path], unit=F.lit(unit), what=F.lit(1), where=F.lit(1), who=F.lit(1), context={"l": F.lit(0.5), "i": F.lit(1.0)}, alpha=F.lit(alpha), label=F.lit("run"), at=F.col("at"))
    r = score_log.log(make(), str(tmp_path / "log"), dry_run=True).first()
    assert (r.time_seconds, r.context_score, r.timestamp) == (1.5, 0.75, "2024-01-01T00:00:00.000000") and abs(r.efficiency - 0.75**1.7 / 1.5) < 1e-12
    assert not (tmp_path / "log").exists()
    for _ in range(2):
        score_log.log(make(), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    for bad, says in (({"path": ("b", "none", "p50")}, r"\$\.b\.none"), ({"path": ("b", "stats", "s")}, "no number"), ({"alpha": 1.4}, "alpha"), ({"unit": "h"}, "time unit")):
        with pytest.raises(Exception, match=says):
            make(**bad).collect()


def test_batch_parts(spark):
    from folioforge.operators.records import batch_parts

    rows = [("a", k, k % 3 > 0, 2) for k in range(50)] + [("b", 1, False, 1), (None, 2, True, 4)]
    out = batch_parts(spark.createDataFrame(rows, "batch string, item int, success boolean, num_chunks int").repartition(5), "batch", "item", 7).collect()
    good = [i for r in sorted(out, key=lambda r: r.part) if r.batch == "a" and r.success for i in r["items"]]
    assert good == [k for k in range(50) if k % 3 > 0] and max(len(r["items"]) for r in out) == 7
    assert {(r.items_succeeded, r.items_failed, r.chunks_created) for r in out if r.batch == "a"} == {(33, 17, 66)}
    assert {(r.success, r.chunks_created) for r in out if r.batch == "b"} == {(False, 0)}


def test_recent_stats(spark):
    from folioforge.operators.metrics import recent_stats

    rows = [("s", f"2024-01-01 00:0{k}:00", float(k)) for k in range(8)] + [("t", "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "series string, at string, value double").withColumn("ts", F.col("at").cast("timestamp_ntz"))
    out = {r.series: r for r in recent_stats(df, "series", F.lit("2024-01-01 00:06:00").cast("timestamp_ntz")).collect()}
    assert (out["s"].n, out["s"].n_recent, out["s"].low_recent, out["s"].high_recent, out["s"].mean_recent) == (8, 6, 1.0, 6.0, 3.5)
    assert (out["t"].n, out["t"].n_recent, out["t"].mean_recent) == (0, 0, None)
