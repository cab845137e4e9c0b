"""Repeated byte strings against a brute-force version."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge.llm import suffix_dedup
from folioforge.llm.shared import Scratch

from .conftest import ODD, documents


def brute(rows, length=50):
    """{(id, text): (bytes, spans, kept)} from (id, text); a null id is the greatest."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    of = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        for a in range(len(t) - length + 1):
            w = t[a : a + length]
            first[w] = min(first.get(w, float("inf")), of(i))
    out = {}
    for i, t in rows:
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if first[t[a : a + length]] < of(i):
                gone[a : a + length] = b"\1" * length
        spans, at = [], 0
        while (a := gone.find(1, at)) >= 0:
            at = gone.find(0, a)
            at = len(t) if at < 0 else at
            spans.append((a, at))
        out.setdefault((i, t), (len(t), spans, bytes(x for x, g in zip(t, gone) if not g)))
    return out


def found(spark, docs, **options):
    rows = suffix_dedup.remove_repeats(docs, Scratch(spark, "test"), **options).collect()
    return [(r["id"], (r["n_bytes"], [(s["from"], s["to"]) for s in r["spans"]], bytes(r["kept"]))) for r in rows]


def same(spark, rows, length=50):
    docs = documents(spark, *[t for _, t in rows], ids=[i for i, _ in rows])
    want = brute(rows, length)
    wanted = [(i, want[i, (t or "").encode()]) for i, t in rows]
    assert sorted(found(spark, docs, length=length), key=repr) == sorted(wanted, key=repr)


def corpus(seed, n=80):
    """Texts with shared passages of lengths around the bound, at their ends too, cut anywhere, and fillers."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    some = [" ".join(word() for _ in range(60)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(1, 5)):
            kind = r.random()
            if kind < 0.5:
                p = r.choice(some)
                a = r.randint(0, len(p) - 60)
                parts.append(p[a : a + r.randint(40, 70)])
            elif kind < 0.7:
                parts.append(r.choice("x- ") * r.randint(20, 90))
            elif kind < 0.8:
                parts.append(r.choice(("ab", "abc", "a b ")) * r.randint(10, 40))
            else:
                parts.append(" ".join(word() for _ in range(r.randint(1, 30))))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("length", [50, 33, 64])
def test_brute_force(spark, seed, length):
    same(spark, list(enumerate(corpus(seed))), length)


@pytest.mark.parametrize("sizes", [(64, 300, 3), (200, 1000, 1)])
def test_small_pieces_and_groups(spark, monkeypatch, sizes):
    """Texts over several pieces, batches and groups too large to hold."""
    S = suffix_dedup
    for name, value in zip(("_PIECE", "_BATCH", "GROUP"), sizes):
        monkeypatch.setattr(S, name, value)
    rows = list(enumerate(corpus(5, 40)))
    # the functions of the tasks are called here on one batch after the other, with small steps
    texts = pa.array([t for _, t in rows])
    ids = np.arange(len(rows))

    def anchors(b):
        o, d = S.column_bytes(b.column("text"))
        return S._rows_of_anchors(o, d, b.column("doc").to_numpy(), b.column("tag").to_numpy(), 50)

    def run(rows_of, batches, halfway):
        out = pa.Table.from_batches(list(S._batched(rows_of)(iter(batches)))).sort_by([(c, "ascending") for c in ("key", "next", "doc", "tag", "place")])
        return pa.Table.from_batches(list(S._scan(halfway)(iter(out.to_batches(max_chunksize=7)))))

    whole = pa.record_batch({"doc": ids, "tag": np.zeros(len(ids), np.int64), "text": texts})
    first = run(anchors, [whole], True).to_pylist()
    kinds = {f["kind"] for f in first}
    assert 1 in kinds and kinds & {2, 4, 6}
    own = [[{k: f[k] for k in ("at", "run", "kind")} for f in first if f["doc"] == i and f["kind"] != 1] for i in ids]
    some = [i for i in ids if own[i]]
    lists = pa.array([own[i] for i in some], pa.list_(pa.struct([("at", pa.int64()), ("run", pa.int32()), ("kind", pa.int32())])))
    batch = pa.record_batch({"doc": np.array(some), "tag": np.zeros(len(some), np.int64), "text": pa.array([rows[i][1] for i in some]), "facts": lists})
    second = run(lambda b: S._rows_of_strings(b, 50), [batch], False).to_pylist()
    want = brute(rows)
    for i, t in rows:
        facts = [(f["at"], f["run"], 1) for f in first if f["doc"] == i and f["kind"] == 1] + [(f["at"], f["run"], 0) for f in second if f["doc"] == i]
        a, b = S._spans(len(t.encode()), *(np.array([f[k] for f in facts], np.int64) for k in range(3)), 50)
        assert list(zip(a.tolist(), b.tolist())) == want[i, t.encode()][1]


def test_ids(spark):
    """Equal ids lose nothing to each other; null ids come last; negative ids and copies."""
    p = " ".join(f"passage{k}" for k in range(12))
    same(spark, [(5, p), (5, p), (5, "a " + p), (3, "short"), (None, p + " tail"), (None, "head " + p), (7, p + p), (-2, p[10:80])])


def test_odd_and_empty(spark, odd, none):
    same(spark, [*enumerate(ODD), *((100 + k, t) for k, t in enumerate(ODD))])
    assert len(found(spark, odd)) == len(ODD)
    assert found(spark, none) == []


def test_long_text(spark):
    r = random.Random(9)
    long = " ".join(f"w{r.randint(0, 10**6)}" for _ in range(120_000))  # over several pieces
    mid = long[400_000:600_000]
    rows = [(1, mid), (2, long), (3, "x" * 300_000), (4, "y" + "x" * 1000)]
    got = dict(found(spark, documents(spark, *[t for _, t in rows], ids=[i for i, _ in rows])))
    assert got[1][1] == [] and got[2][1] == [(400_000, 600_000)] and got[3][1] == [] and got[4][1] == [(1, 1001)]
    assert got[2][2] == (long[:400_000] + long[600_000:]).encode()


def test_digest(spark):
    docs = documents(spark, "z" * 60, "z" * 55 + "end")
    row = suffix_dedup.remove_repeats(docs, Scratch(spark, "test")).withColumn("sha", F.sha2("kept", 256)).where("id = 1").first()
    assert row["sha"] == hashlib.sha256(b"end").hexdigest()
