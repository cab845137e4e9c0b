import gzip
import hashlib
import io
import json
import tarfile
import time

import pytest
from pyspark.sql import functions as F

from folioforge.functions import scores as S
from folioforge.functions import text as X
from folioforge.operators import chunks as C
from folioforge.operators import graph as G
from folioforge.operators import metrics
from folioforge.operators import progress as P
from folioforge.sources import readers
from folioforge.sources.store import Store, read_only
from folioforge.sources.store import chunk_tables as S_chunk_tables


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


@pytest.mark.parametrize("block", [3, 256])
def test_token_offsets_of_every_token(spark, block):
    long = " ".join("w" * (i % 7 + 1) for i in range(1000))
    values = [long, None, " \n", "one", "é  日本語\ttwo\n", long]
    want = []
    for i, t in enumerate(values):
        at = 0
        for k, w in enumerate((t or "").split()):
            want.append((i % 5, k, at))
            at += len(w) + 1
    df = spark.createDataFrame([(i % 5, t) for i, t in enumerate(values)], "doc_id long, text string")  # an id may come twice
    assert sorted(tuple(r) for r in C.token_offsets(df, block=block).collect()) == sorted(want)
    assert len(want) > 2 * 200


def test_token_offsets_of_a_very_long_text(spark):
    """A million tokens with every kind of white space; folding arrays token by token took 17 seconds for as many."""
    import re
    import sys

    spaces = [c for c in map(chr, range(sys.maxunicode + 1)) if re.fullmatch(X.WS.replace(r"\s", r" \t\n\x0b\f\r"), c)]
    assert spaces == [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    text = "".join(f"{'é' * (i % 9 + 1)}{spaces[i % len(spaces)]}" for i in range(1_000_000))
    began = time.perf_counter()
    out = C.token_offsets(texts(spark, text, None, "a b").withColumn("kind", F.lit("k")), keep=["kind", "doc_id"])
    assert out.columns == ["kind", "doc_id", "pos", "start_char"]
    one = out.where("doc_id = 0").agg(F.count("*"), F.max("pos"), F.max("start_char"), F.min(F.expr("start_char >= 2 * pos"))).first()
    assert tuple(one) == (1_000_000, 999_999, sum(i % 9 + 2 for i in range(999_999)), True)
    assert out.where("doc_id > 0").count() == 2
    assert time.perf_counter() - began < 12


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 17, 18, 26, 34])
def test_token_windows_cover_all(spark, n):
    out = C.token_windows(texts(spark, " ".join(f"w{i}" for i in range(n))), size=10, overlap=2).orderBy("chunk_index").collect()
    assert len(out) == (0 if n == 0 else 1 if n <= 10 else -(-(n - 10) // 8) + 1)
    assert {w for r in out for w in r.text.split()} == {f"w{i}" for i in range(n)}
    if out:
        assert out[-1].end_token == n


def test_windows_of_nothing(spark):
    df = texts(spark, None, "", " \t\n")
    for f in (C.token_windows, C.stepped_windows, C.sliding_windows, C.sentence_packs, C.character_windows):
        assert f(df.where("text is null or trim(text) = ''").limit(2)).count() == 0


def test_sliding_remainder(spark):
    out = C.sliding_windows(texts(spark, " ".join("abcdefghijk")), window=4, step=2).orderBy("chunk_index").collect()
    assert [r.text for r in out] == ["a b c d", "c d e f", "e f g h", "g h i j", "k"] and [r.remainder for r in out] == [False] * 4 + [True]


def test_bad_windows(spark):
    with pytest.raises(ValueError):
        C.token_windows(texts(spark, "a"), size=5, overlap=5)
    with pytest.raises(ValueError):
        C.sliding_windows(texts(spark, "a"), window=5, step=6)
    with pytest.raises(ValueError):
        C.chunk(texts(spark, "a"), "other")
    assert C.chunk(texts(spark, "a b"), "Token", size=2, overlap=0).count() == 1


def test_long_sentence_is_a_chunk(spark):
    out = C.sentence_packs(texts(spark, "one two. " + "x " * 8 + "end. last one."), most=4).orderBy("chunk_index").collect()
    assert [r.token_count for r in out] == [2, 9, 2]


def test_runs_split_a_text_once(spark):
    values = [" ".join(f"w{i}" for i in range(101)), "a\x00b \x00 c\u2003d\x1ce  f g", "one", None, " \x00 "]
    out = C.sentence_packs(texts(spark, *values), most=4, respect_sentences=False).select("doc_id", "chunk_index", "text")
    want = []
    for i, t in enumerate(values):
        c = " ".join((t or "").split()).replace("\x00", "").strip(" ")
        w = c.split()
        want += [(i, 0, c)] if 0 < len(w) <= 4 else [(i, a // 4, " ".join(w[a : a + 4])) for a in range(0, len(w), 4)]
    assert sorted(tuple(r) for r in out.collect()) == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_pooled_windows_skip_special(spark):
    rows = [(1, p, p * 3, p * 3 + 2, int(p in (0, 5)), [float(p), 1.0]) for p in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, pos long, start long, end long, special int, vec array<double>")
    out = C.pooled_windows(df, size=4, overlap=1).orderBy("chunk_index").collect()
    assert [(r.first_token, r.end_token, r.start_char, r.end_char, r.total_chunks) for r in out] == [(1, 4, 3, 11, 2), (3, 5, 9, 14, 2)]
    assert abs(sum(x * x for x in out[0].embedding) - 1) < 1e-12


def test_unicode_space(spark):
    df = texts(spark, "a b\x1cc　d  e")
    assert df.select(X.token_count(F.col("text")).alias("n")).first().n == 5


def test_clean_drops_nul_last(spark):
    assert texts(spark, " a \x00 b\n").select(X.clean(F.col("text")).alias("c")).first().c == "a  b"


def test_unit_error(spark):
    with pytest.raises(Exception, match="unknown time unit"):
        spark.createDataFrame([(1.0, "h")], "raw double, unit string").select(S.seconds(F.col("raw"), F.col("unit"))).collect()
    with pytest.raises(Exception, match="alpha out of range"):
        spark.createDataFrame([(3.0,)], "a double").select(S.checked_alpha(F.col("a"))).collect()


def test_reach_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    out = {r.node: r.depth for r in G.reach(edges, spark.createDataFrame([("a",)], "n string"), 10).collect()}
    assert out == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_phases(spark):
    rows = [("x", 1, "start", "2024-01-01 00:00:00", None, 10), ("x", 2, "update", "2024-01-01 00:00:05", 4, None), ("x", 3, "end", "2024-01-01 00:00:10", 8, None), ("y", 1, "start", "2024-01-01 00:00:00", None, None)]
    df = spark.createDataFrame(rows, "phase string, seq int, kind string, ts string, processed int, total int").withColumn("ts", F.to_timestamp("ts"))
    out = {r.phase: r for r in P.phases(df).collect()}
    assert (out["x"].processed, out["x"].rate, out["x"].completion) == (8, 0.8, 80.0) and out["y"].rate is None and out["y"].completion is None


def test_store_commits_all_or_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert store.commit({"a": (a, ["k"]), "b": (a, ["k"])}) == {"a": 2, "b": 2}
    assert store.commit({"a": (spark.createDataFrame([(2, "z"), (3, "w"), (None, "n")], "k int, v string"), ["k"])}) == {"a": 4}
    assert {(r.k, r.v) for r in store.table("a").collect()} == {(1, "x"), (2, "z"), (3, "w"), (None, "n")}
    before = store.manifest()
    with pytest.raises(Exception):
        store.commit({"b": (a, ["k"]), "a": (a.withColumn("v", F.raise_error(F.lit("no"))), ["k"])})
    assert store.manifest() == before
    with pytest.raises(ValueError):
        store.append("a", a, ["k"])
    assert store.drop("b") and not store.drop("b") and store.counts(["a", "b"]) == {"a": 4, "b": 0}


def test_read_only(spark):
    assert read_only(spark, "select 1 as x").first().x == 1
    for bad in ("drop table t", "INSERT INTO t VALUES (1)"):
        with pytest.raises(PermissionError):
            read_only(spark, bad)


def test_readers(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps(x) for x in ({"id": "a.1", "abstract": "one"}, {"id": "a.1", "abstract": "two"})) + "\nbroken\n")
    assert [r.abstract for r in readers.metadata_cache(spark, str(tmp_path / "m.jsonl")).collect()] == ["two"]
    assert readers.metadata(spark, str(tmp_path / "m.jsonl")).count() == 2
    (tmp_path / "t").mkdir()
    (tmp_path / "t/p1.txt").write_text("body")
    assert [tuple(r) for r in readers.texts(spark, str(tmp_path / "t")).collect()] == [("p1", "body")]
    (tmp_path / "z").mkdir()
    (tmp_path / "z/one.gz").write_bytes(gzip.compress(b"plain source"))
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        for name, data in (("a.tex", b"short"), ("b.tex", b"much longer"), ("r.bbl", b"refs")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (tmp_path / "z/two.gz").write_bytes(gzip.compress(buf.getvalue()))
    (tmp_path / "z/bad.gz").write_bytes(b"no gzip")
    out = {r.path.rsplit("/", 1)[1]: r for r in readers.latex_archives(spark, str(tmp_path / "z")).collect()}
    assert out["one.gz"].source == "plain source" and (out["two.gz"].source, out["two.gz"].bibliography) == ("much longer", "refs") and out["bad.gz"].error


def test_feed(spark):
    xml = '<feed><entry><id>http://x/abs/2301.1v2</id><title> A\n B </title><summary>s</summary><published>2023-01-01T00:00:00Z</published><updated>2023-01-02T00:00:00Z</updated><author><name>N</name></author></entry></feed>'
    entries = readers.feed_entries(spark.createDataFrame([(xml,)], "payload string"))
    out = readers.requested(spark.createDataFrame([("2301.1v3",), ("9999.9",)], "arxiv_id string"), entries).orderBy("arxiv_id").collect()
    assert [(r.arxiv_id, r.title, r.authors) for r in out] == [("2301.1v3", "A B", ["N"]), ("9999.9", None, None)]


def test_store_two_writers(spark, tmp_path):
    """A commit that others overtake is added to theirs; nothing is lost."""
    one, two = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    row = lambda k, v: spark.createDataFrame([(k, v)], "k int, v string")
    one.commit({"t": (row(1, "a"), ["k"])})
    read = one._read
    late = [lambda: two.commit({"t": (row(2, "b"), ["k"])})]

    def overtaken():
        found = read()
        if late:
            late.pop()()
        return found

    one._read = overtaken
    assert one.commit({"t": (row(3, "c"), ["k"])}) == {"t": 3}
    one._read = read
    assert {(r.k, r.v) for r in two.table("t").collect()} == {(1, "a"), (2, "b"), (3, "c")}
    late.append(lambda: two.commit({"t": (row(4, "d"), ["k"])}))
    one._read = overtaken
    number = read()[0]
    with pytest.raises(RuntimeError):  # what was checked against an older manifest is not published
        one.commit({"t": (row(5, "e"), ["k"])}, expected=number - 1)
    with pytest.raises(ValueError):
        two.commit({"t": (row(5, "e"), ["v"])})


def test_store_keys(spark, tmp_path, monkeypatch):
    from folioforge.sources import store as S

    monkeypatch.setattr(S, "COMPACT", 4)
    store = Store(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("a1", 1, "x"), ("a1", 3, "b"), ("a1", 2, "z"), ("b1", 1, "y"), ("a2", 1, None)], "k string, at int, v string")
    assert store.commit({"t": (rows, ["k"], ["at"])}) == {"t": 3}
    assert store.retrieve("t", k="a1").first().v == "b" and store.retrieve("t", k="no").count() == 0  # the last written, not the largest
    assert store.exists("t", k="b1") and not store.exists("t", k="b") and not store.exists("u", k="b1")
    assert sorted(r.k for r in store.keys("t", "a").collect()) == ["a1", "a2"]
    store.delete("t", spark.createDataFrame([("b1",), ("none",)], "k string"))
    assert not store.exists("t", k="b1")
    store.commit({"t": (spark.createDataFrame([("b1", 9, "again", 1.5)], "k string, at int, v string, more double"), ["k"])})
    assert store.retrieve("t", k="b1").first().more == 1.5 and store.retrieve("t", k="a1").first().more is None
    for i in range(6):
        store.commit({"t": (spark.createDataFrame([("c", i, str(i))], "k string, at int, v string"), ["k"])}, counted=False)
    assert len(store.manifest()["t"]["parts"]) < 4 and store.retrieve("t", k="c").first().v == "5" and store.counts(["t"]) == {"t": 4}
    assert store.clear("t", "a") == 2 and store.clear("t", "zz") == 0 and store.clear("t") == 2 and store.counts(["t"]) == {"t": 0}
    with pytest.raises(KeyError):
        store.retrieve("u", k=1)


def test_chunk_tables(spark, tmp_path):
    papers = spark.createDataFrame([("p1", "T"), ("p2", "U"), (None, "V")], "_key string, title string")
    chunks = spark.createDataFrame([("p1", 0, "a", [1.0, 2.0]), ("p1", 1, "b", None), ("p9", 0, "c", [1.0])], "_key string, chunk_index int, text string, embedding array<double>")
    store = Store(spark, str(tmp_path / "s"))
    assert store.commit(S_chunk_tables(papers, chunks)) == {"papers": 2, "chunks": 2, "embeddings": 1}
    assert store.commit(S_chunk_tables(papers, chunks)) == {"papers": 2, "chunks": 2, "embeddings": 1}
    assert store.table("embeddings").first().asDict() == {"chunk_key": "p1_chunk_0", "_key": "p1", "embedding": [1.0, 2.0], "dim": 2}


def test_files_and_cache(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for name, data in {"a.pdf": b"%PDF-1.4", "b.PDF": b"text", "c.txt": b"hello", "d.pdf": b""}.items():
        (tmp_path / "f" / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.problem) for r in readers.checked_files(spark, str(tmp_path / "f")).collect()}
    assert got == {"a.pdf": (8, None), "b.PDF": (4, "no PDF header"), "c.txt": (5, None), "d.pdf": (0, "empty")}
    line = '{"id":"%s","abstract":"%s"}\n'
    (tmp_path / "m1.jsonl").write_text("".join(line % (i % 50, f"{i:06d}") for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:  # several pieces of one file
        cache = readers.metadata_cache(spark, str(tmp_path / "m1.jsonl")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.abstract for r in cache} == {f"{i:06d}" for i in range(3950, 4000)}
    kinds = spark.createDataFrame([("x/a.PDF",), ("b.tex",), ("c.md",), ("d.py",), ("e",)], "p string").select(readers.kind_of(F.col("p")).alias("k")).collect()
    assert [r.k for r in kinds] == ["pdf", "latex", "text", "code", "unknown"]


def test_small_functions(spark):
    from folioforge.functions import code as K
    from folioforge.functions import scores as N
    from folioforge.functions import text as X
    from folioforge.functions import vectors as V

    one = spark.sql("SELECT '' AS e, 'x' AS x, array('p', 'q') AS pages, map('b', array('2', '1'), 'a', array('z')) AS symbols, CAST(NULL AS ARRAY<DOUBLE>) AS v, array(0.6D, 0.8D) AS u")
    r = one.select(
        X.first_nonempty(F.col("e"), F.lit(None).cast("string"), F.col("x")).alias("first"),
        X.fenced(F.lit("a = 1"), F.lit("python")).alias("fenced"),
        X.page_join(F.col("pages")).alias("pages"),
        K.symbol_digest(F.col("symbols")).alias("digest"),
        V.stored_dim(F.col("v"), F.lit(5)).alias("dim"),
        V.valid(F.col("u"), 2).alias("valid"),
        V.fuse(F.col("u"), F.col("v"), 2).alias("one_side"),
        V.fuse(F.col("v"), F.col("v"), 2).alias("none"),
        N.inverse_who(N.efficiency(F.lit(0.5), F.lit(0.5), F.lit(0.7), F.lit(2.0), F.lit(0.4), 1.5), F.lit(0.5), F.lit(0.5), F.lit(2.0), F.lit(0.4), 1.5).alias("who"),
        K.language(F.lit("a/b.CS")).alias("cs"),
        K.language(F.lit("a/.env")).alias("hidden"),
    ).first()
    assert (r.first, r.fenced, r.pages) == ("x", "```python\na = 1\n```", "--- Page 1 ---\np\n\n--- Page 2 ---\nq")
    assert r.digest == hashlib.sha256(b"a:z;b:1,2;").hexdigest() and (r.dim, r.valid, r.none) == (5, True, [0.0, 0.0])
    assert abs(r.one_side[0] - 0.6) < 1e-6 and abs(r.who - 0.7) < 1e-9 and (r.cs, r.hidden) == ("c_sharp", None)


def test_quantiles_with_ties_and_nulls(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [("t", 1.0)] * 500 + [("t", 2.0)] * 3 + [("u", float(x)) for x in rng.normal(size=777)] + [("n", None), ("o", 5.0)] + [(None, 1.0), (None, 2.0)]
    got = {r.k: r for r in metrics.quantiles(spark.createDataFrame(rows, "k string, v double").repartition(5), ["k"], "v", buckets=8).collect()}
    for k in ("t", "u", "o", None):
        values = [v for x, v in rows if x == k]
        assert np.allclose([got[k].p50, got[k].p95, got[k].p99], np.quantile(values, [0.5, 0.95, 0.99])) and got[k].high == max(values)
    assert got["n"].p50 is None and got["n"].mean is None


def test_late_rows_are_dropped(spark, tmp_path):
    """A row that comes after the watermark has passed its window does not count."""
    from folioforge.streaming import jobs

    def put(i, rows):
        spark.createDataFrame(rows, "k string, ts string, value double").selectExpr("k", "CAST(ts AS timestamp) AS ts", "value").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = jobs.windowed(spark.readStream.schema("k string, ts timestamp, value double").parquet(str(tmp_path / "in")), 60, 10, ["k"])
        out.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    put(0, [("a", "2024-01-01 00:00:05", 1.0), ("a", "2024-01-01 00:05:00", 1.0)])
    put(1, [("a", "2024-01-01 00:00:06", 1.0), ("a", "2024-01-01 00:20:00", 1.0)])
    put(2, [("a", "2024-01-01 00:40:00", 1.0)])
    got = sorted((str(r.window_start), r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("2024-01-01 00:00:00", 1), ("2024-01-01 00:05:00", 1), ("2024-01-01 00:20:00", 1)]


def test_sinks_and_checkpoints(spark, tmp_path):
    from folioforge.sources import sinks

    rows = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, v double")
    for _ in range(2):
        sinks.payloads(rows, str(tmp_path / "p"), "k")
        sinks.append_lines(rows, str(tmp_path / "l"))
    (tmp_path / "l" / "bad.json").write_text("{broken\n")
    assert [tuple(r) for r in sinks.read_lines(spark, str(tmp_path / "p"), "k string, v double").collect()] == [("a", 1.0)]
    assert sorted(r.v for r in sinks.read_lines(spark, str(tmp_path / "l"), "k string, v double").collect()) == [1.0, 1.0, 2.0, 2.0]
    sinks.summary(rows, "k", "v", str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 2
    points = sinks.Checkpoints(Store(spark, str(tmp_path / "store")))
    assert points.load("x") is None and points.names() == [] and points.load("x", {"n": 1}) == {"n": 1}
    points.save("x", {"done": ["p1"], "n": 1})
    points.save("y", {})
    assert points.add("x", n=2, m=1) == {"done": ["p1"], "n": 3, "m": 1} and points.load("x")["m"] == 1
    points.remove("y")
    assert points.names() == ["x"]
