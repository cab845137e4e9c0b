"""Each operator against a brute-force version, a round trip or held-out labels, and on odd tables."""

import hashlib
import math
import random
import re
import sys
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm import embedding_dedup, extraction, fingerprint, mixing, ngram_join, packing, quality, shared, sharding, toxicity, warc
from folioforge.llm import words as W
from folioforge.llm.labelled import training_sample
from folioforge.llm.shared import Scratch, running

from .conftest import ODD, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# words


@pytest.mark.parametrize("step", [7, 1 << 20])
def test_word_hashes(monkeypatch, step):
    import pyarrow as pa

    monkeypatch.setattr(W, "_STEP", step)
    bounds, found = W.word_hashes(pa.array(ODD * 2)[3:])
    hashes = {}
    for i, t in enumerate((ODD * 2)[3:]):
        mine = [w for w in re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))]
        assert bounds[i + 1] - bounds[i] == len(mine)
        for w, h in zip(mine, found[bounds[i] : bounds[i + 1]].tolist()):
            assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


# 1


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_links(rows, threshold):
    good = {}
    for k, (i, v, lab) in enumerate(rows):
        if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(np.asarray(v, np.float32), np.float64)
            good[k] = (lab, x / np.linalg.norm(x))
    link = {k: {j for j in good if j != k and good[j][0] == good[k][0] and len(good[j][1]) == len(good[k][1]) and good[j][1] @ good[k][1] >= threshold} for k in good}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in link.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, len(link.get(k, ())), min(rows[j][0] for j in seen)))
    return sorted(out)


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = []
    for i in range(400):
        v = base[i % 60] + rng.normal(size=16) * (0.15 if i % 3 else 0.3)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 60) % 4))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(300)]  # one large group of equal vectors
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] + [1.0] * 15, 1), (2004, rows[0][1], None), (2005, [float("inf")] + [1.0] * 15, 1), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1)]
    out = embedding_dedup.near_duplicates(vectors(spark, rows), Scratch(spark, "t"), recall=0.99)
    got = sorted((r.id, r.n_links, r.component_id) for r in out.collect())
    want = brute_links(rows, 0.93)
    assert len(got) == len(want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want) and sum(g != w for g, w in zip(got, want)) <= 0.03 * len(want)


def clumps(size):
    """Two tight clumps of distinct vectors whose members also reach each other's."""
    rng, angle = np.random.default_rng(5), np.arccos(0.95)
    ends = np.eye(32)[0], np.cos(angle) * np.eye(32)[0] + np.sin(angle) * np.eye(32)[1]
    out = [e + np.r_[0, 0, rng.normal(size=30) * 0.008] for _ in range(size) for e in ends]
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(out)]


@pytest.mark.parametrize("size", [20, 100])
def test_embedding_dedup_joins_clumps(spark, size):
    rows = clumps(size)
    want = brute_links(rows, 0.93)
    assert all(w[1:] == (2 * size - 1, 0) for w in want)
    out = embedding_dedup.near_duplicates(vectors(spark, rows), Scratch(spark, "t"), recall=0.98)
    assert sorted((r.id, r.n_links, r.component_id) for r in out.collect()) == want


def test_cells_are_exact(spark):
    """Nodes in groups of their own, through many cells: the components are those of all links."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 16))
    x = np.concatenate([base + rng.normal(size=base.shape) * 0.2 for _ in range(10)])
    rows = [(i, [float(v) for v in x[i]], i % 2) for i in range(len(x))]
    nodes = spark.createDataFrame([(i, lab, 16, i, v) for i, v, lab in rows], "node long, label long, dim int, group long, vec array<double>")
    edges = embedding_dedup.between(embedding_dedup.cells(nodes, False, most=7), 0.93, Scratch(spark, "t")).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i, j in zip(*np.nonzero(u @ u.T >= 0.93)) if i < j and i % 2 == j % 2}
    assert {(min(e.a, e.b), max(e.a, e.b)) for e in edges} == want and len(want) > 300


def test_saturated_lists_grow(spark):
    """Nearly all of 300 vectors reach one another: lists double as far as they may, and the links are all of them."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in np.eye(24)[0] + rng.normal(size=24) * 0.05], 0) for i in range(300)]
    report = {}
    out = embedding_dedup.near_duplicates(vectors(spark, rows), Scratch(spark, "t"), recall=0.9, report=report)
    want = brute_links(rows, 0.93)
    assert sum(w[1] for w in want) > 200 * len(want)
    assert sorted((r.id, r.n_links, r.component_id) for r in out.collect()) == want
    assert report["longest_list"] == 64 and report["found"] == report["pairs"] > 0


def test_embedding_dedup_odd_rows(spark):
    """Repeated ids, clashing columns, and cosines at the threshold (0.6 of exact values, and just below it)."""
    rows = [(1, [1.0, 0.0, 0.0], 0), (1, [1.0, 0.0, 0.0], 0), (2, [3.0, 4.0, 0.0], 0), (3, [0.0, 0.0, 1.0], 0), (3, [0.0, 3.0, 4.000001], 0), (4, [1e30, 0.0, 0.0], 0), (None, [0.0, 0.0, -1.0], 0), (5, [1.0, 0.0, 0.0], 1)]
    df = vectors(spark, rows).withColumns({c: F.lit(c) for c in ("id", "node", "vec", "h1", "rep", "group", "dim")})
    out = embedding_dedup.near_duplicates(df, Scratch(spark, "t"), threshold=0.6, recall=0.9)
    got = sorted(((r.id, r.n_links, r.component_id) for r in out.collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 1, 3), (3, 1, 3), (4, 3, 1), (None, 0, None), (5, 0, 5)], key=str)


def test_embedding_dedup_empty(spark):
    assert embedding_dedup.near_duplicates(vectors(spark, []), Scratch(spark, "t")).count() == 0


def test_labels_of_any_type(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.02], "b"), (5, [1.0, 0.0], None), (6, [1.0, 0.0], "1"), (7, [1.0, 0.0], "1.0")]
    out = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string"), Scratch(spark, "t"), recall=0.98).collect()
    assert {r.id: (r.n_links, r.component_id) for r in out} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (0, 6), 7: (0, 7)}
    halves = spark.createDataFrame([(1, [1.0], 1.2), (2, [1.0], 1.5), (3, [1.0], 1.5)], "vec_id long, embedding array<float>, label double")
    assert {r.id: r.n_links for r in embedding_dedup.near_duplicates(halves, Scratch(spark, "t")).collect()} == {1: 0, 2: 1, 3: 1}


# 2 and 4


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_classifier_on_held_out(spark, name):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    texts, labels = [], []
    for i in range(700):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        bad = rng.random() < 0.3
        if name == "toxicity":
            if bad:
                for _ in range(4):
                    words.insert(rng.randrange(len(words)), rng.choice(["zornkopf", "quatschnase", "wuthirn"]))
            label = (i, 1, int(bad))
        else:
            words = [w.upper() + "!!" for w in words] if bad else words
            label = (i, int(not bad), 0)
        texts.append(" ".join(words))
        labels.append(label)
    docs, table = documents(spark, *texts), spark.createDataFrame(labels + [(3, None, None), (4, 7, 7), (None, 1, 1)], "doc_id long, quality int, toxic int")
    module = {"quality": quality, "toxicity": toxicity}[name]
    parts, held = (4, 2) if name == "quality" else (3, 1)
    out = module.classify(docs, table).select("doc_id", "held_out", "score", "predicted").collect()
    assert {r.doc_id: r.held_out for r in out} == {i: zlib.crc32(str(i).encode()) % parts == held for i in range(700)}
    truth = {i: q if name == "quality" else t for i, q, t in labels}
    tested = [r for r in out if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_on_odd_tables(spark, odd, none, module):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(14)], "doc_id long, quality int, toxic int")
    out = module.classify(odd, labels)
    assert out.count() == len(ODD) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert set(odd.columns) - {"score", "held_out", "predicted"} <= set(out.columns)
    same = {r.text: r.score for r in out.select("text", "score").collect()}
    assert len(same) == len(set(ODD))
    assert module.classify(none, labels).count() == 0
    flat = module.classify(odd, labels.where("quality = 1"))  # one class only: a constant score
    assert flat.select("score").distinct().count() == 1


def naive_grams(text, bits):
    """Each n-gram's hash by itself, with Python integers."""
    padded, found = f" {text.lower()} ", set()
    for n in toxicity.GRAMS:
        for at in range(len(padded) - n + 1):
            h = 0
            for i, c in enumerate(padded[at : at + n]):
                h = (h + ord(c) * toxicity._MULT[i]) & 0xFFFFFFFF
                h ^= h >> 15
            found.add((h * 0x2C1B3C6D & 0xFFFFFFFF) >> (32 - bits))
    return found


def test_toxicity_against_brute_force(spark):
    """n-grams, class counts, log-count ratios and margins against a naive count."""
    rng, bits = random.Random(21), 12
    texts = ["".join(rng.choice("abc é.") for _ in range(rng.randint(0, 40))) + (" vile" if i % 3 == 0 else "") for i in range(120)]
    for t in texts[:30]:
        assert set(toxicity.grams(t, bits).tolist()) == naive_grams(t, bits)
    sample = spark.createDataFrame([(t, int(i % 3 == 0)) for i, t in enumerate(texts)], "text string, y int").repartition(5)
    p, q = toxicity._class_counts(sample, bits)
    counts = [Counter(g for i, t in enumerate(texts) if (i % 3 == 0) == bad for g in naive_grams(t, bits)) for bad in (True, False)]
    for have, want in zip((p, q), counts):
        assert {int(g): int(have[g]) for g in np.flatnonzero(have)} == dict(want)
    r = toxicity.ratios(p, q, len(texts), 2, 1 << bits)
    total = [sum(c.values()) + (1 << bits) for c in counts]
    for g in range(1 << bits):
        a, b = counts[0][g], counts[1][g]
        assert math.isclose(r[g], math.log(((a + 1) / total[0]) / ((b + 1) / total[1])) if a + b >= 2 else 0, abs_tol=1e-9)
    model = toxicity.fit_ratio([toxicity.grams(t, bits) for t in texts], np.array([i % 3 == 0 for i in range(120)], float), r, bits)
    for t in texts[:20]:
        assert math.isclose(model.margin(t), model.b + sum(float(model.weights[g]) for g in naive_grams(t, bits)), abs_tol=1e-6)


def test_quality_features_against_brute_force():
    import pyarrow as pa

    texts = ["", "A b, b  1!\n\u00e9", "x y x"]
    rows, dense = quality.features(pa.array([None, *texts]), [pa.array([None, 3, -1, 9])], 16)
    assert len(rows[0][0]) == 0 and not dense[0].any() and math.isclose(dense[3, -1], math.log1p(9))
    for k, t in enumerate(texts, 1):
        words, raw = WORD.findall(lower(t)), t.encode()
        if not words:
            continue
        n = Counter(words)
        weights = sorted(math.log1p(c) for c in n.values())
        norm = math.sqrt(sum(w * w for w in weights))
        assert np.allclose(sorted(rows[k][1]), [w / norm for w in weights], atol=1e-6)
        assert math.isclose(dense[k, 0], sum(chr(b).isupper() and b < 128 for b in raw) / len(raw)) and math.isclose(dense[k, 2], sum(48 <= b < 58 for b in raw) / len(raw))
        assert np.allclose(dense[k, 8:14], [math.log1p(len(raw)), math.log1p(len(words)), len(raw) / len(words), len(n) / len(words), max(n.values()) / len(words), sum(a == b for a, b in zip(words, words[1:])) / len(words)])


def test_training_sample_is_bounded(spark):
    """Rows with equal ids do not pass the bound."""
    docs = documents(spark, *[f"text {i}" for i in range(200)], ids=[i % 4 for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(4)], "doc_id long, quality int, toxic int")
    got = training_sample(docs, labels, "toxic", 4, 1000, 999, "doc_id", "text").collect()
    assert sorted(r["_id"] for r in got) == [0, 1, 2, 3] and {r.text for r in got} == {"text 0", "text 1", "text 10", "text 103"}
    assert toxicity.classify(docs, labels).count() == 200 and quality.classify(docs, labels).count() == 200


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    bits, d, rank = 4, 3, 5
    m = quality.FactorisationMachine(bits, 0.3, rng.normal(size=16 + d), rng.normal(size=(16 + d, rank)), np.zeros(d), np.ones(d))
    at, x, dense = np.array([1, 4, 9]), np.array([0.5, 0.2, 0.7]), rng.normal(size=(1, d))
    full = np.zeros(16 + d)
    full[at], full[16:] = x, dense[0]
    want = 0.3 + full @ m.w + sum(m.v[i] @ m.v[j] * full[i] * full[j] for i in range(16 + d) for j in range(i))
    assert abs(m.margins([(at, x)], dense)[0] - want) < 1e-9


# 3


def brute_phrases(text):
    symbols = [x for w in text.split() for x in ([w] if len(w) <= fingerprint.LONG else w)]
    seen, run = [], []
    for s in symbols:
        run.append(s)
        if tuple(run) not in seen:
            seen.append(tuple(run))
            run = []
    return set(seen) | ({tuple(run)} if run else set())


@pytest.mark.parametrize("span_bytes", [200, 64 << 20])
def test_fingerprint(spark, odd, span_bytes):
    got = {r.id: r for r in fingerprint.probe(odd, span_bytes=span_bytes).collect()}
    texts = [t or "" for t in ODD]
    for i, t in enumerate(texts):
        following, r = texts[(i + 1) % len(texts)], got[i]
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        assert (r.n_chars, r.edited_text) == (len(t), edited)
        a, b, e = (brute_phrases(x) for x in (t, following, edited))
        if max(map(len, (a, b, e))) < fingerprint.K // 2:  # small enough to be exact
            assert r.near_edited == (len(a & e) / len(a | e) if a or e else 1.0)
            assert r.near_next == (len(a & b) / len(a | b) if a or b else 1.0)
        assert (fingerprint.signature(t) == fingerprint.Parsed(t).signature).all() and r.fingerprint == fingerprint._hex(fingerprint.signature(t)) and r.edited_fingerprint == fingerprint._hex(fingerprint.signature(edited))
    assert got[12].fingerprint == got[13].fingerprint and got[12].near_next == 1.0


@pytest.mark.parametrize("cuts", [0, 1, 150, 1234])
def test_spans(spark, cuts):
    """The number of cuts at or below an id, with one run of cuts or many."""
    marks = sorted(random.Random(cuts).sample(range(5000), cuts))
    got = spark.range(0, 5000, 37).select("id", fingerprint._span("id", marks).alias("n")).collect()
    assert all(r.n == sum(m <= r.id for m in marks) for r in got)
    assert spark.sql("SELECT CAST(NULL AS LONG) AS id").select(fingerprint._span("id", marks)).first()[0] == 0


def test_fingerprint_repeats(spark, none):
    docs = documents(spark, "a b", "c d", "a b", None, ids=[5, 5, 5, None])
    assert fingerprint.probe(docs).count() == 4
    assert fingerprint.probe(none).count() == 0
    one = fingerprint.probe(documents(spark, "abcdefgh")).first()
    assert one.edited_text == "abcdefab" and one.near_next == 1.0


# 5


def best_capacity(sizes, shards):
    fits = lambda c: __import__("functools").reduce(lambda s, x: (s[0], s[1] + x) if s[1] + x <= c else (s[0] + 1, x), sizes, (1, 0))[0] <= shards
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("seed,blocks,shards", [(1, 2000, 16), (2, 5, 4), (3, 3, 7)])
def test_sharding(spark, monkeypatch, seed, blocks, shards):
    rng = random.Random(seed)
    texts = ["x" * rng.randint(0, 40) if rng.random() < 0.5 else str(rng.randint(0, 10**9)) * rng.randint(1, 9) for _ in range(300)] + [None, "", "dup"] + ["dup"] * 90
    monkeypatch.setattr(sharding, "BLOCKS", blocks)
    plain = sharding.cut_points
    monkeypatch.setattr(sharding, "cut_points", lambda g, s, x: plain(g, s, x, blocks))
    got = {r.id: r for r in sharding.shard(documents(spark, *texts), shards, Scratch(spark, "t")).collect()}
    first, size = {}, Counter()
    for i, t in enumerate(texts):
        t = t or ""
        first.setdefault(t, i)
        size[t] += len(t.encode()) + 1
        assert (got[i].size, got[i].text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
        assert got[i].shard == got[first[t]].shard
    order = sorted(first, key=first.get)
    shard_of = [got[first[t]].shard for t in order]
    assert shard_of == sorted(shard_of) and max(shard_of) < shards
    load = Counter()
    for t in order:
        load[got[first[t]].shard] += size[t]
    assert max(load.values()) == best_capacity([size[t] for t in order], shards)
    for s in load:
        slots = sorted(r.slot for r in got.values() if r.shard == s)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("key", [None, 7])
def test_sharding_of_one_key(spark, monkeypatch, key):
    """Half of the groups have one id or none: they are divided by their digests, a few blocks at a time."""
    plain = sharding.cut_points
    monkeypatch.setattr(sharding, "cut_points", lambda g, s, x: plain(g, s, x, 6))
    rng = random.Random(31)
    rows = [(key, f"t{i}" * rng.randint(1, 30)) for i in range(150)] + [(i + 10, f"u{i}" * rng.randint(1, 30)) for i in range(150)]
    got = sharding.shard(documents(spark, *[t for _, t in rows], ids=[i for i, _ in rows]), 5, Scratch(spark, "t")).collect()
    order = sorted(got, key=lambda r: (r.id is not None, r.id or 0, r.digest))
    assert len(got) == 300 and [r.shard for r in order] == sorted(r.shard for r in got)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) == best_capacity([r.size for r in order], 5)
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in load)


def test_sharding_odd(spark, odd, none):
    assert sharding.shard(odd, 16, Scratch(spark, "t")).count() == len(ODD)
    assert sharding.shard(none, 16, Scratch(spark, "t")).count() == 0
    repeated = documents(spark, *["t%d" % i for i in range(20)], ids=[7] * 19 + [None])
    out = sharding.shard(repeated, 4, Scratch(spark, "t")).collect()
    assert len(out) == 20 and {r.shard for r in out} == {0, 1, 2, 3}


# 6


def test_packing(spark, odd):
    out = packing.pack(odd.repartition(3), TOKENIZER, tokens=256, segments=4).orderBy("id", "start").collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for i, t in enumerate(ODD):
        want = np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert b"".join(r.token_bytes for r in out if r.id == i) == want
        assert all(r.ids_crc32 == zlib.crc32(r.token_bytes) for r in out if r.id == i)
        assert all(r.doc_tokens == len(want) // 4 and r.length == len(r.token_bytes) // 4 for r in out if r.id == i)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        total = sum(r.length for r in pieces)
        assert total <= 256 and len(pieces) <= 4 and total & (total - 1) == 0


@pytest.mark.parametrize("store, piece", [(200_000, 1 << 20), (50, 40)])
def test_encoder_is_exact(monkeypatch, store, piece):
    """Also where texts go through in slices and the store of units changes its generation again and again."""
    monkeypatch.setattr(packing, "_STORE", store)
    monkeypatch.setattr(packing, "_SLICE", piece)
    rng = random.Random(2)
    encode = packing.CachedEncoder(TOKENIZER)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    letters = list("aBcéÉΣσ İſ    \x1c\x1f\t\n'sT1٣中🎉é́<|>-.,_K\x85​") + [chr(i) for i in range(256)]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 16))) + rng.choice(["", "<|endoftext|>", " don't I'LL"]) for _ in range(3000)]
    texts += ["".join(rng.choice("ab c's1.- \n") for _ in range(700)), "x" * 300, ""]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for t, ids in zip(part, encode(part)):
            assert ids == np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_idle_workers_let_their_stores_go(monkeypatch):
    monkeypatch.setattr(packing, "_IDLE", 0.2)
    encode = packing.CachedEncoder(TOKENIZER)
    packing._let_go()
    packing._hold()
    time.sleep(0.5)
    assert TOKENIZER in packing._STORES
    packing._let_go()
    time.sleep(1)
    assert not packing._STORES and len(encode(["a b"])[0]) == 8


def test_packer_takes_the_largest_dot_product():
    """Every choice is compared with all items that wait and fit whole; a cut piece is only taken where none fits."""
    rng = random.Random(9)
    items = [(i, 0, rng.randint(1, 60), rng.randint(0, 60)) for i in range(120)]
    limits = np.array([128.0, 5, 90])
    done, _ = packing.Packer(128, 5, 90).pack(items, False)
    waits = {i: (0, n, f) for i, _, n, f in items}  # start, length, loss from
    need = lambda a, n, f: np.array([n, 1, max(0, a + n - max(a, f))], float)
    checked = 0
    for pieces in done:
        left, full = limits.copy(), sum(n for _, _, n in pieces) == 128
        for row, start, n in pieces:
            at, length, free = waits[row]
            fits = {r: (need(*x) / limits) @ (left / limits) for r, x in waits.items() if (need(*x) <= left).all()}
            if full and n == length:
                assert fits[row] == max(fits.values())
                checked += 1
            elif full:
                assert not fits
            left -= need(start, n, free)
            waits[row] = (start + n, length - n, free)
            if n == length:
                del waits[row]
    assert checked > 30


def test_packer_limits():
    rng = random.Random(4)
    items = [(i, 0, rng.randint(1, 300), rng.randint(0, 200)) for i in range(200)]
    packer, frees = packing.Packer(128, 5, 64), {}
    for i, _, _, f in items:
        frees[i] = f
    done, wait = [], []
    for a in range(0, 200, 37):
        more, wait = packer.pack(wait_items(wait, frees) + items[a : a + 37], a + 37 >= 200)
        done += more
    assert not wait
    covered = Counter()
    for pieces in done:
        assert sum(n for _, _, n in pieces) <= 128 and len(pieces) <= 5
        assert sum(max(0, s + n - max(s, frees[r])) for r, s, n in pieces) <= 64
        for r, s, n in pieces:
            covered.update((r, x) for x in range(s, s + n))
    assert covered == Counter((r, x) for r, _, n, _ in items for x in range(n))


def wait_items(wait, frees):
    return [(r, s, n, frees[r]) for r, s, n, _ in wait]


def test_packing_empty(spark, none):
    assert packing.pack(none, TOKENIZER).count() == 0


# 7


def test_warc(spark, tmp_path):
    long = "<p>" + "text\r\n\r\nWARC/1.1 é " * 20
    pages = [(3, "http://a", long), (1, "http://b\r\nX: y", long), (2, None, long), (4, "http://c", "short"), (5, "http://d", "short"), (6, "http://e", None), (7, "http://f", ""), (None, "http://g", long), (8, "u", "z" * 99), (9, "u", "z" * 99), (10, "u", "z" * 100), (11, "u", "z" * 100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("refers_to", F.lit(5)).withColumn("payload", F.lit("x")).repartition(3)
    got = warc.deduplicate(df, str(tmp_path / "w")).collect()
    assert len(got) == len(pages)
    firsts = {}
    for i, _, h in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        h = (h or "").encode()
        r = next(x for x in got if x.page_id == str(i))
        assert (r.payload_bytes, r.payload_digest) == (len(h), hashlib.sha256(h).hexdigest())
        original = firsts.setdefault(h, i) if len(h) >= 100 else i
        assert (r.record_type, r.refers_to) == (("response", None) if original == i else ("revisit", str(original)))
    back = {r.page_id: bytes(r.payload) for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert back["1"] == long.encode() and back["2"] == b"" and back["10"] == b"z" * 100 and back[None] == long.encode()


def test_warc_repeated_ids(spark, tmp_path):
    x, y, z = "x" * 200, "y" * 300, "z" * 150
    pages = [(3, x), (5, x), (5, y), (4, z), (5, z)]
    df = spark.createDataFrame([(i, f"u{k}", h) for k, (i, h) in enumerate(pages)], "page_id long, url string, html string")
    out = warc.deduplicate(df, str(tmp_path / "a")).collect()
    digest = lambda h: hashlib.sha256(h.encode()).hexdigest()
    want = [("3", 200, digest(x), None), ("5", 200, digest(x), "3"), ("5", 300, digest(y), None), ("4", 150, digest(z), None), ("5", 150, digest(z), "4")]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in out) == sorted(want, key=lambda w: w[:3])


def test_warc_record_ids(spark, tmp_path):
    """Every record has an id of its own, and what a revisit names is the record of its payload."""
    x, y = "x" * 200, "y" * 300
    pages = [(5, "u", x), (5, "u", y), (5, "u", x), (5, "v", x), (7, "u", x), (8, "u", y), (None, "u", x), (None, "u", x), (None, "u", y), (9, "u", None), (None, "u", None)]
    warc.deduplicate(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), str(tmp_path / "a")).count()
    heads = [h for f in (tmp_path / "a").glob("*.gz") for h, _ in warc._records(warc._unzip(f.read_bytes()))]
    named = {h["WARC-Record-ID"]: h for h in heads}
    assert len(heads) == len(named) == len(pages) and all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", i) for i in named)
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert {h["X-Page-ID"] for h in revisits} == {"7", "8"}
    for h in revisits:
        original = named[h["WARC-Refers-To"]]
        assert original["WARC-Type"] == "response" and original["X-Page-ID"] == h["X-Refers-To-Page-ID"] == "5" and original["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_warc_files_are_bounded(spark, tmp_path, monkeypatch):
    """Small and large payloads are written apart, so many to a file as its bytes allow, and all are read back."""
    monkeypatch.setattr(warc, "FILE_BYTES", 4_000)
    monkeypatch.setattr(warc, "CLASSES", (100, 1_000))
    pages = [(i, "u", f"{i} " + "x" * n) for i, n in enumerate([5, 50, 500, 900, 2_500, 9_000] * 12)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    records = warc.headers(df)
    warc.write(records, warc.resolve(records), str(tmp_path / "w"))
    sizes = [sum(len(p) for _, p in warc._records(warc._unzip(f.read_bytes()))) for f in (tmp_path / "w").glob("*.gz")]
    assert len(sizes) > 10 and max(s for s in sizes if s < 9_000) <= 4_000 and all(s < 9_010 for s in sizes)
    assert sorted(bytes(r.payload).decode() for r in warc.read(spark, str(tmp_path / "w")).collect()) == sorted(p[2] for p in pages)


def test_warc_empty(spark, tmp_path):
    assert warc.deduplicate(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w")).count() == 0


# 8


def brute_join(rows, p, q):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)), key=lambda k: (rows[k][0], k))
                comp[b] = a
    return sorted(((rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("few,block", [(32, 1024), (2, 3)])
def test_ngram_join(spark, monkeypatch, few, block):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(200)]
    texts = list(ODD)
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 4, 5, 6, 7, 9, 13, 30, 80, 200]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append((" " * rng.randint(1, 3)).join(copy) + rng.choice(["", "\n", " extra"]))
    ids = [i * 3 % 1009 for i in range(len(texts))]
    rows = list(zip(ids, texts)) + [(None, texts[20]), (2000, texts[20])]
    docs = documents(spark, *[t for _, t in rows], ids=[i for i, _ in rows]).repartition(5)
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in ngram_join.join(docs, Scratch(spark, "t"), buckets=7).collect()), key=str)
    assert got == brute_join(rows, 80, 100)


def test_overlapping_groups_are_no_family(spark, monkeypatch):
    """Texts that only share passages are not moved to be compared, however many large groups they overlap in."""
    monkeypatch.setattr(ngram_join, "FEW", 2)
    moved, verify = [], ngram_join._verify_blocks
    monkeypatch.setattr(ngram_join, "_verify_blocks", lambda members, *rest: (moved.append(members.count()), verify(members, *rest))[1])
    rng = random.Random(3)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [some(60) for _ in range(3)]
    texts = [" ".join(passages[k % 3] + some(20) + passages[(k + 1) % 3][:30] + some(20)) for k in range(36)]
    docs = documents(spark, *texts)
    found = ngram_join.groups(docs, 5, 80, 100, 0, 7, id_col="doc_id", text_col="text").groupBy("gid").count().where("count > 2")
    assert found.count() > 3
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in ngram_join.join(docs, Scratch(spark, "t"), buckets=7).collect()), key=str)
    assert got == brute_join(list(enumerate(texts)), 80, 100)
    assert moved == [0]


def test_release_gives_memory_back(spark, monkeypatch):
    """Shuffle files and the driver's memory go, its Python's too; near duplicates let go after every large step."""
    given, steps = [], []
    monkeypatch.setattr(shared, "give_back", lambda: given.append(1))
    shared.release(spark)
    assert given == [1]
    monkeypatch.setattr(ngram_join, "release", steps.append)
    ngram_join.join(documents(spark, "one two three four five six", "one two three four five six seven"), Scratch(spark, "t"), buckets=3)
    assert len(steps) >= 5


@pytest.mark.parametrize("block", [3, 2048])
def test_likely_blocks(spark, monkeypatch, block):
    """They connect the sets that brute force over the sketches of each group connects."""
    monkeypatch.setattr(ngram_join, "SKETCHES", block)
    rng, sets = np.random.default_rng(5), []
    for size in (1, 3, 40, 60, 66, 130, 300):
        base = rng.integers(0, 1 << 62, size, dtype=np.uint64)
        for _ in range(6):
            changed = int(rng.integers(0, size // 5 + 1))
            sets.append(np.unique(np.r_[base[changed:], rng.integers(0, 1 << 62, changed + size // 12, dtype=np.uint64)]))
    rows = [(k, len(x), bytearray(ngram_join.sketch(x))) for k, x in enumerate(sets)]
    of = [int(c) for c in rng.integers(0, 9, len(sets))]
    groups_ = [sorted({int(x) for x in rng.integers(0, len(sets), 25)}) for _ in range(4)] + [list(range(12, 36))]
    many = spark.createDataFrame([(g, k, of[k], len(ks)) for g, ks in enumerate(groups_) for k in ks], "gid long, key long, component long, n long")
    got = ngram_join._likely_blocks(many, spark.createDataFrame(rows, "key long, n long, sketch binary"), 80, 100).collect()

    def parts(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return label

    every = {(a, b) for ks in groups_ for a in ks for b in ks if a < b and of[a] != of[b] and ngram_join.may_link(bytes(rows[a][2]), rows[a][1], bytes(rows[b][2]), rows[b][1], 80, 100)}
    pairs = {(min(r), max(r)) for r in got}
    assert 10 < len(every) and pairs <= every and {frozenset(i for i, x in enumerate(parts(pairs)) if x == y) for y in parts(pairs)} == {frozenset(i for i, x in enumerate(parts(every)) if x == y) for y in parts(every)}
    assert {x for pair in pairs for x in pair} == {x for pair in every for x in pair}


def test_pigeonhole():
    """Two sets at the threshold always share a signature that one of them probes by."""
    rng, limits = np.random.default_rng(0), ngram_join.bands(80, 100, 1 << 40)
    checked = 0
    for k in range(4000):
        n = int(rng.integers(1, 25 if k % 2 else 300))
        base = rng.integers(0, 1 << 62, n, dtype=np.uint64)
        b = int(rng.integers(max(1, int(n * 0.78)), n + 1))
        common = int(rng.integers(int(b * 0.8), b + 1))
        r, s = np.unique(base), np.unique(np.r_[base[:common], rng.integers(0, 1 << 62, b - common, dtype=np.uint64)])
        both = len(np.intersect1d(r, s))
        if 100 * both < 80 * (len(r) + len(s) - both):
            continue
        checked += 1
        (a, pa), (c, pc) = ngram_join.signatures(r, 80, 100, limits), ngram_join.signatures(s, 80, 100, limits)
        assert any(pa[a == x].any() or pc[c == x].any() for x in np.intersect1d(a, c))
    assert checked > 500


def test_ngram_join_empty(spark, none):
    assert ngram_join.join(none, Scratch(spark, "t")).count() == 0
    assert ngram_join.keep_one(none, Scratch(spark, "t")).count() == 0


def test_one_row_of_each_group_stays(spark, odd):
    """Rows with equal ids are judged by their own texts; null ids and texts without words stay."""
    a, y, z = (" ".join(f"{w}{i}" for i in range(60)) for w in "ayz")
    rows = [(1, a), (5, a), (5, z), (7, y), (7, y), (9, y + " end"), (None, a), (None, a), (8, ""), (8, ""), (8, None), (8, z + " end"), (3, "b c"), (4, "B  c\n")]
    df = documents(spark, *[t for _, t in rows], ids=[i for i, _ in rows]).withColumns({c: F.lit(c) for c in ("id", "key", "_key", "rows", "component")}).repartition(3)
    for docs in (df, df.drop("_key")):
        out = ngram_join.keep_one(docs, Scratch(spark, "t"))
        assert out.columns == docs.columns
        got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        assert got == sorted([(1, a), (5, z), (7, y), (None, a), (None, a), (8, ""), (8, ""), (8, None), (3, "b c")], key=str)
    groups = {r.component_id for r in ngram_join.join(odd, Scratch(spark, "t")).where("key is not null").collect()}
    kept = ngram_join.keep_one(odd, Scratch(spark, "t")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(groups | {i for i, t in enumerate(ODD) if not WORD.findall(t or "")})


# 9


def test_mixing(spark):
    rng = random.Random(9)
    texts = [" ".join("w" for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, ""]
    sources = [rng.choice(["b", "B", "é", None, "z", "𝄞", "～"]) if i > 150 else "hot" for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(zip(texts, sources))], "doc_id long, text string, source string")
    got = {r.id: r for r in mixing.mix(df, Scratch(spark, "t"), shards=5).collect()}
    again = {r.id: r for r in mixing.mix(df.repartition(7), Scratch(spark, "t"), shards=5).collect()}
    assert got == again and len(got) == len(texts)
    total, size = Counter(), Counter()
    for i, (t, s) in enumerate(zip(texts, sources)):
        n = len(WORD.findall(t or ""))
        assert got[i].size == n and 0 <= got[i].taken <= 2 * n and sum(d.words for d in got[i].draws) == got[i].taken
        assert all(d.shard is not None and 0 <= d.shard < 5 for d in got[i].draws)
        total[s] += got[i].taken
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    full, want = set(), {}
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        want = {s: 2 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        more = {s for s in order if want[s] > 2 * size[s] and s not in full}
        if not more:
            break
        full |= more
    for s in order:
        mine = [got[i] for i in range(len(texts)) if sources[i] == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == size[s] for r in mine) and abs(total[s] - want[s]) <= 1
    words = Counter(d.shard for r in got.values() for d in r.draws for _ in range(d.words))
    assert max(words.values()) < 2 * min(words.values())


@pytest.mark.parametrize("case", ["no ids", "one id", "copies", "two sources"])
def test_mixing_of_equal_rows(spark, case):
    """A quota that ends among rows with equal ids, or equal rows, takes as many of them as fit and one in part."""
    words = [" ".join(f"w{k if case != 'copies' else 0}x{j}" for j in range(10)) for k in range(100)]
    ids = {"no ids": [None] * 100, "one id": [7] * 100, "copies": [7] * 50 + [None] * 50, "two sources": [None] * 100}[case]
    source = ["a" if k % 3 or case != "two sources" else "b" for k in range(100)]
    df = spark.createDataFrame(list(zip(ids, words, source)), "doc_id long, text string, source string").repartition(6)
    rows = mixing.mix(df, Scratch(spark, "t")).collect()
    assert len(rows) == 100 and all(r.taken <= 20 for r in rows)
    for s in set(source):
        assert abs(sum(r.taken for r in rows if r.source == s) - next(r.target for r in rows if r.source == s)) <= 1
    again = mixing.mix(df, Scratch(spark, "t")).collect()
    assert sorted((r.source, r.taken) for r in rows) == sorted((r.source, r.taken) for r in again)
    drawn = Counter()
    for r in mixing.rows_of_mix(df, Scratch(spark, "t")).collect():
        drawn[r.source] += len(WORD.findall(r.text))
    assert drawn == Counter({s: sum(r.taken for r in rows if r.source == s) for s in set(source)})


def test_split_tree_is_exact(spark):
    blocks = spark.createDataFrame([(s, 0, b) for s in range(3) for b in range(40)], "source_rank int, pass int, range int")
    out = mixing.split_tree(blocks, 6, "seed", Scratch(spark, "t")).collect()
    assert len(out) == 120 and Counter(r.shard for r in out) == {i: 20 for i in range(6)}
    assert len({(r.source_rank, r.range) for r in out}) == 120
    assert mixing.split_tree(blocks.limit(0), 6, "seed", Scratch(spark, "t")).count() == 0


def test_running_totals(spark):
    rows = [(i * 7919 % 1000, i % 5) for i in range(1000)] + [(None, 3)]
    got = running(spark.createDataFrame(rows, "k int, v int").repartition(5), [F.col("k").asc_nulls_last()], {"n": F.lit(1), "t": F.col("v")}, Scratch(spark, "t")).collect()
    before, total = 0, 0
    for r in sorted(got, key=lambda r: (r.k is None, r.k)):
        assert (r.n, r.t) == (before, total)
        before, total = before + 1, total + r.v
    assert before == 1001


def test_sketches_never_hide_a_link():
    rng = np.random.default_rng(3)
    kept = 0
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.choice([0.2, 0.8, 0.9, 1])], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 2))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        guess = ngram_join.may_link(ngram_join.sketch(a), len(a), ngram_join.sketch(b), len(b), 80, 100)
        assert guess or 100 * both < 80 * (len(a) + len(b) - both)
        kept += guess
    assert kept < 250


def test_mix_rows(spark, odd, none):
    rows = mixing.rows_of_mix(odd, Scratch(spark, "t"))
    plan = {r.id: r.taken for r in mixing.mix(odd, Scratch(spark, "t")).collect()}
    assert rows.columns == odd.columns and [f.dataType for f in rows.schema] == [f.dataType for f in odd.schema]
    found = Counter()
    for r in rows.collect():
        found[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert {i: n for i, n in plan.items() if n} == dict(found)
    assert mixing.mix(none, Scratch(spark, "t")).count() == 0 and mixing.rows_of_mix(none, Scratch(spark, "t")).count() == 0


def test_mix_rows_are_dealt(spark):
    df = documents(spark, *[" ".join(["w"] * (i % 9 + 1)) for i in range(300)])
    draws = [(d.shard, d.place, r.id, d.words) for r in mixing.mix(df, Scratch(spark, "t")).collect() for d in r.draws]
    got = [(r.doc_id, len(WORD.findall(r.text))) for r in mixing.rows_of_mix(df, Scratch(spark, "t")).collect()]
    assert got == [d[2:] for d in sorted(draws)] and len(got) > 300
    assert sum(a[0] == b[0] for a, b in zip(got, got[1:])) < 10  # the passes of a document are apart


def test_taken_is_what_the_tree_dealt(spark, monkeypatch):
    df = documents(spark, *["one two three"] * 200)
    tree = mixing.split_tree
    whole = sum(r.taken for r in mixing.mix(df, Scratch(spark, "t")).collect())
    monkeypatch.setattr(mixing, "split_tree", lambda *a: tree(*a).where("range % 2 = 0"))
    lost = mixing.mix(df, Scratch(spark, "t")).collect()
    assert sum(r.taken for r in lost) < 0.8 * whole and all(r.taken == sum(d.words for d in r.draws) for r in lost)


# 10

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><div class="site-nav menu"><ul><li><a href="#">Home</a><li><a href="#">About</a></ul></div>
<div class="cookie-notice">We use cookies</div>%s<h1>Title &amp; more</h1><p>First <b>para</b>graph of&nbsp;the   text,
on two lines with enough words to count.<p>Short.<p><i>Unclosed<br>line<p>Last paragraph of the article with some more words &#233;.
<form>Mail <input><button>Go</button></form>%s<aside>Sidebar words that are long enough to be a paragraph</aside>
<div id="comments"><p>A reader comment that is as long as a paragraph of text is.</p></div><footer>Copyright</footer></body></html>"""
TEXT = "Title & more First paragraph of the text, on two lines with enough words to count. Short. Unclosed line Last paragraph of the article with some more words é."


@pytest.mark.parametrize("a,b", [("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>")])
def test_main_text(a, b):
    assert extraction.main_text(PAGE % (a, b)) == TEXT


def test_extraction_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p></p><script>x</script>"), (4, "plain text"), (5, "<![weird <p>a</p>"), (6, "<div><p>one<div>two</div>"), (7, "<article>" + "word " * 50_000)]
    out = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("old"))).collect()}
    assert [out[i] for i in (1, 2, 3, 4, 6)] == ["", "", "", "plain text", "one two"] and len(out[7]) == 249_999


def test_smoothing():
    assert np.allclose(extraction.smooth(np.ones(7), 1.0), 1) and extraction.smooth(np.array([0, 0, 9.0, 0, 0]), 1.0).argmax() == 2


def words_of(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "to"]) for _ in range(n))


def soup(rng, paragraphs):
    """A page without landmarks: links, paragraphs (some short), links."""
    menu = lambda: "<div><ul>" + "".join(f'<li><a href="/{i}">{words_of(rng, 2)}</a></li>' for i in range(6)) + "</ul></div>"
    return f"<html><body>{menu()}<div><div>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div></div>{menu()}</body></html>"


def test_pages_without_landmarks_need_the_threshold():
    """With no article, element, role or class to go by, ratio, smoothing and threshold find the text; a changed threshold loses it."""
    rng = random.Random(12)
    found = {share: 0 for share in (0.0, 0.85, 1.7)}
    for _ in range(60):
        paragraphs = [words_of(rng, rng.choice([3, 20, 60, 90])) for _ in range(rng.randint(4, 12))] + [words_of(rng, 50)]
        page = soup(rng, paragraphs)
        for share in found:
            found[share] += extraction.main_text(page, share=share) == " ".join(paragraphs)
    assert found[0.85] >= 57 and found[0.0] == 0 and found[1.7] == 0


def test_ratios_decide_without_landmarks(monkeypatch):
    rng = random.Random(13)
    pages = [soup(rng, [words_of(rng, 60) for _ in range(5)]) for _ in range(10)]
    right = [extraction.main_text(p) for p in pages]
    monkeypatch.setattr(extraction, "ratios", lambda found: np.ones(len(found)))
    assert all(extraction.main_text(p) != r for p, r in zip(pages, right))


def naive_text(html, sigma, share, least):
    found = extraction.lines(html)
    if not found:
        return ""
    ratio = [math.log(1 + (max(0, len(t) - link) + (extraction.RAISE if inside and len(t) > link else 0)) / (max(1, tags) + marks)) for t, tags, link, _, marks, inside in found]
    reach = max(1, int(3 * sigma))
    kernel = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    even = []
    for i in range(len(found)):
        near = [(ratio[i + d], k) for d, k in zip(range(-reach, reach + 1), kernel) if 0 <= i + d < len(found)]
        even.append(sum(r * k for r, k in near) / sum(k for _, k in near))
    threshold = share * sum(e * len(x[0]) for e, x in zip(even, found)) / sum(len(x[0]) for x in found)
    chosen = {i for i in range(len(found)) if even[i] >= threshold and ratio[i] >= least * threshold and (found[i][4] < extraction.FULL or ratio[i] >= extraction.WHOLE)}
    for box in {x[3] for x in found if x[3] >= 0}:
        inside = [i for i, x in enumerate(found) if x[3] == box]
        if 2 * sum(len(found[i][0]) for i in inside if i in chosen) >= sum(len(found[i][0]) for i in inside):
            chosen |= {i for i in inside if found[i][4] < extraction.FULL and found[i][2] <= 0.6 * len(found[i][0])}
    return " ".join(found[i][0] for i in sorted(chosen))


def test_extraction_against_brute_force():
    rng = random.Random(14)
    bits = ["<p>", "</p>", "<div>", "</div>", '<div class="ad">', "<article>", "</article>", "<ul><li>", "</ul>", "<a href=x>", "</a>", "<h2>", "</h2>", "<br>", "<nav>", "</nav>", "<table><tr><td>", "</table>", "<b>", "</b>"]
    for _ in range(300):
        page = "".join(rng.choice(bits) + (words_of(rng, rng.choice([1, 4, 30])) if rng.random() < 0.7 else "") for _ in range(rng.randint(1, 40)))
        assert extraction.main_text(page) == naive_text(page, 0.6, 0.85, 0.4)


def test_adverts_inside_the_article():
    page = "<article><p>%s</p><div class='ad promo'>Buy this thing now, it is as long as a paragraph of text can be, and even longer.</div><p>cut<span class='share'>tweet</span> here</p><div class='x'><p>Tail.</p></div></article>"
    body = "First words of the text, of which there are many, and more and more of them."
    assert extraction.main_text(page % body) == body + " cut here Tail."


def test_landmarks_do_not_decide_alone():
    """A part of a class name, or one beside the name of a content, loses to what it holds; a menu without a class has no ratio."""
    dense = words_of(random.Random(1), 400)
    assert extraction.main_text(f'<div class="related-work"><p>{dense}</p></div>') == dense
    forty = words_of(random.Random(2), 40)
    assert forty in extraction.main_text(f'<div class="header-notice content">{forty}</div><div>one</div>')
    menu = "<div>" + "".join(f"<p><a href=x>{w} {w}</a></p>" for w in "abcdefgh") + "</div>"
    assert extraction.main_text(f'{menu}<div class="related-work"><p>{dense}</p><p>{forty}</p></div>{menu}') == f"{dense} {forty}"


def words_overlap(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return 2 * sum((x & y).values()) / max(1, sum(x.values()) + sum(y.values()))


def test_ablation_on_pages(spark, sf, monkeypatch):
    """On the given pages the share, the smoothing and the ratios decide; without any landmark most of the text is found still."""
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").where("html is not null").select("html").collect()]
    right = [extraction.main_text(p) for p in pages]
    changed = lambda f: sum(f(p) != r for p, r in zip(pages, right)) / len(pages)
    assert changed(lambda p: extraction.main_text(p, share=1.7)) > 0.1
    bare = [re.sub(r'\s(class|id|role)="[^"]*"', "", re.sub(r"<(/?)(article|main|nav|header|footer|aside)\b[^>]*>", r"<\1div>", p)) for p in pages]
    overlap = lambda **o: sum(words_overlap(extraction.main_text(p, **o), r) for p, r in zip(bare, right)) / len(pages)
    assert overlap() > 0.94 > overlap(share=0.3) and overlap() > overlap(sigma=4.0) + 0.005
    monkeypatch.setattr(extraction, "ratios", lambda found: np.ones(len(found)))
    assert changed(extraction.main_text) > 0.9


def test_page_lines():
    found = extraction.lines("<body><h1>A <b>b</b></h1>one<br>two <a href=x>link</a><div class='ad'>buy</div><article>x</article></body>")
    assert [(t, *rest) for t, _, *rest in found] == [("A b", 0, 0, 0, False), ("one", 0, 0, 0, False), ("two link", 4, 0, 0, False), ("buy", 0, 1, extraction.FULL, False), ("x", 0, 2, 0, True)]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<!-- c --><p>Hi there</p><![weird[x]]>", "Hi there"),
        ("<p>ok</p><!-- open <p>x</p>", "ok"),
        ("<p>a<![CDATA[ b > c ]]>d</p>", "ad"),
        ("<nav><a href=x>menu</a><article><p>Long enough text here.</p></article>", "Long enough text here."),
        ("<form><select><option>a<article>Text.</article>", "Text."),
        ("<aside><main>All of it.</main>", "All of it."),
        ('<div class="comments"><article class="comment">Nice read!</article></div>', ""),
        ("<p>cut <b", "cut"),
        ("<nav>only a menu</nav>", ""),
        ("a &amp; b &lt;c&gt; &#233; &nosuch;", "a & b <c> é &nosuch;"),
    ],
)
def test_broken_pages(html, text):
    assert extraction.main_text(html) == text


def test_nesting_is_linear():
    def work(page):
        """Lines of Python that run for a page."""
        n, before = 0, sys.gettrace()

        def count(frame, event, arg):
            nonlocal n
            n += 1
            return count

        sys.settrace(count)
        extraction.main_text(page)
        sys.settrace(before)
        return n

    for page in ("<div>a %s", "<p><div>%s<span>", "<li>%s</p>"):
        one, two = (work("".join(page % "" for _ in range(n))) for n in (1_000, 2_000))
        assert two < 2.3 * one
